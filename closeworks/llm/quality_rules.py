"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a text. Expectation-maximisation over the counts
of all vote patterns estimates how often each rule is right on good and on bad texts; the posterior
probability of a good text replaces filtering by all rules at once. Only DataFrame functions are used.
The pattern table has at most 3 ** (number of rules) rows, whatever the size of the corpus.

Defined cases: a null text is an empty one; an empty text fails the base rules; rows are judged one by
one, so repeated rows and null ids keep their rows; an empty table gives an empty result and the
starting accuracies; columns of the input keep their names, added ones step aside.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import native
from closeworks.llm.names import fresh
from closeworks.llm.store import written
from closeworks.operators.schema import quoted

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

RULES = (
    "length",
    "word_size",
    "symbols_per_word",
    "symbol_share",
    "repeated_lines",
    "repeated_words",
    "capitals",
    "shouting",
    "variety",
)
ROUNDS = 30
SETTLED = 1e-4
#: Bounds of the estimates. A rule calls few good texts bad; it finds at least some bad texts, and it
#: may abstain on all others, as each rule knows one kind of defect.
WRONG_ON_GOOD = (0.0005, 0.02)
RIGHT_ON_BAD = (0.2, 0.9)
PRIOR = (0.5, 0.97)


@dataclass(frozen=True)
class Model:
    """Share of good texts; for each rule the probabilities of (bad, good) votes on good and on bad texts."""

    prior: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]


START = Model(0.8, ((0.02, 0.6),) * len(RULES), ((0.4, 0.2),) * len(RULES))


def _covered(places: Column) -> Column:
    """Words that windows at these sorted places cover."""
    after = F.slice(places, F.lit(2), F.size(places))
    return F.aggregate(
        F.zip_with(places, after, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )


def _repeated(runs: Column) -> Column:
    """Words in windows whose hash is found twice or more; neighbours in sorted order show them."""
    sorted_runs = F.array_sort(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of(found: Column) -> Column:
        same_as_next = F.zip_with(found, F.slice(found, F.lit(2), F.size(found)), lambda a, b: a["h"] == b["h"])
        same_as_last = F.concat(F.array(F.lit(False)), same_as_next)
        marks = F.zip_with(same_as_next, same_as_last, lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)))
        pairs = F.zip_with(found, marks, lambda x, m: F.when(m, x["i"]))
        return _covered(F.array_sort(F.filter(pairs, lambda i: i.isNotNull())))

    # bind the sorted array once
    return F.element_at(F.transform(F.array(sorted_runs), of), 1)


def measures(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """The rows with one struct of measures, and the name of that column."""
    name = fresh(docs, "measures")
    words, runs, body = (fresh(docs, x) for x in ("words_", "runs_", "body_"))
    lines = F.filter(F.split(F.col(body), "\n", -1), lambda x: F.length(native.without(x, native.SPACES)) > 0)
    n = F.size(F.col(words)).cast("long")
    windows = F.transform(
        F.sequence(F.lit(1), F.size(F.col(words)) - WINDOW + 1), lambda i: F.xxhash64(F.slice(F.col(words), i, WINDOW))
    )
    none = F.array().cast("array<bigint>")
    measured = docs.withColumn(body, native.whole(text)).withColumn(words, native.words(F.col(body)))
    measured = measured.withColumn(runs, F.when(n > WINDOW, windows).otherwise(none))
    size = F.length(F.col(body)).cast("long")
    lines_struct = F.element_at(
        F.transform(
            F.array(lines),
            lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("same")),
        ),
        1,
    )
    measured = measured.withColumn(
        name,
        F.struct(
            n.alias("n_words"),
            F.length(native.without(F.col(body), native.SPACES)).cast("long").alias("word_chars"),
            (size - F.length(native.without(F.col(body), SYMBOLS))).alias("n_symbols"),
            lines_struct.alias("lines"),
            F.when(F.size(F.array_distinct(F.col(runs))) < F.size(F.col(runs)), _repeated(F.col(runs)))
            .otherwise(F.lit(0).cast("long"))
            .alias("n_repeat_words"),
            (size - F.length(native.without(F.col(body), CAPITALS))).alias("n_capitals"),
            (size - F.length(native.without(F.col(body), "!"))).alias("n_shouts"),
            F.size(F.array_distinct(F.col(words))).cast("long").alias("n_different"),
        ),
    )
    return measured.drop(words, runs, body), name


def votes(measured: str) -> list[Column]:
    """One vote per rule of RULES on a struct of measures."""
    m = F.col(measured)
    n = m["n_words"]

    def vote(bad: Column, good: Column | None = None) -> Column:
        found = F.when(bad, -1)
        return (found if good is None else found.when(good, 1)).otherwise(0)

    return [
        vote(n < MIN_WORDS, n >= 50),
        vote((m["word_chars"] < 2 * n) | (m["word_chars"] > 14 * n)),
        vote(10 * m["n_symbols"] > n),
        vote(20 * m["n_symbols"] > m["word_chars"]),
        vote(2 * m["lines"]["same"] > m["lines"]["n"]),
        vote(5 * m["n_repeat_words"] > n),
        vote(10 * m["n_capitals"] > 4 * m["word_chars"]),
        vote(2 * m["n_shouts"] > n),
        vote((n >= 40) & (10 * m["n_different"] < n), 10 * m["n_different"] > 3 * n),
    ]


def posterior(model: Model, found: list[Column]) -> Column:
    """Probability that a text with these votes is good."""
    odds = F.lit(log(model.prior / (1 - model.prior)))
    for vote, good, bad in zip(found, model.on_good, model.on_bad, strict=True):
        odds = odds + (
            F.when(vote < 0, log(good[0] / bad[0]))
            .when(vote > 0, log(good[1] / bad[1]))
            .otherwise(log((1 - sum(good)) / (1 - sum(bad))))
        )
    return 1 / (1 + F.exp(-odds))


def _bounded(x: float, bounds: tuple[float, float]) -> float:
    return min(max(x, bounds[0]), bounds[1])


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over a table of vote patterns (columns of RULES) and their `count`."""
    model, found = START, [F.col(r) for r in RULES]
    p, n = F.col("p"), F.col("count")
    sums = [F.sum(n * p).alias("good"), F.sum(n).alias("all")]
    for r in RULES:
        for vote, name in ((-1, "bad"), (1, "good")):
            voted = F.when(F.col(r) == vote, n)
            sums += [F.sum(voted * p).alias(f"{r}_{name}_good"), F.sum(voted * (1 - p)).alias(f"{r}_{name}_bad")]
    for _ in range(rounds):
        row = patterns.withColumn("p", posterior(model, found)).agg(*sums).first()
        if not row["all"]:
            break
        then = _maximised(row.asDict())
        moved = max(abs(a - b) for a, b in zip(_figures(then), _figures(model), strict=True))
        model = then
        if moved < SETTLED:
            break
    return model


def _figures(model: Model) -> list[float]:
    return [model.prior, *(x for pair in model.on_good + model.on_bad for x in pair)]


def _maximised(sums: dict[str, float | None]) -> Model:
    """The most likely model for these expected counts; one made-up text per outcome keeps it off 0 and 1."""
    total = {"good": sums["good"], "bad": sums["all"] - sums["good"]}

    def rates(rule: str, kind: str, bounds: tuple[float, float]) -> tuple[float, float]:
        bad, good = (((sums[f"{rule}_{vote}_{kind}"] or 0.0) + 1) / (total[kind] + 3) for vote in ("bad", "good"))
        bad = _bounded(bad, bounds)
        return bad, min(good, 0.98 * (1 - bad))

    return Model(
        _bounded(total["good"] / sums["all"], PRIOR),
        tuple(rates(r, "good", WRONG_ON_GOOD) for r in RULES),
        tuple(rates(r, "bad", RIGHT_ON_BAD) for r in RULES),
    )


def fit(measured: DataFrame, name: str) -> Model:
    """Accuracies from the votes on all rows; one small counting shuffle."""
    rows = measured.select(*(v.alias(r) for v, r in zip(votes(name), RULES, strict=True)))
    return estimate(written(rows.groupBy(*RULES).count().coalesce(1), "patterns"))


def base_failed(name: str) -> Column:
    m = F.col(name)
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def judge(measured: DataFrame, name: str, model: Model) -> tuple[Column, Column]:
    """Probability of a good text, and the verdict: the base rules hold and good is likelier than bad."""
    good = posterior(model, votes(name))
    return good, ~base_failed(name) & (good >= 0.5)


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with their own columns.

    The measures are written with the rows, so that texts are measured once and the filter reads plain columns.
    """
    measured, name = measures(docs, text)
    measured = written(measured, "measured")
    _, kept = judge(measured, name, fit(measured, name))
    return measured.where(kept).select(*map(quoted, docs.columns))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its measures, base_failed, kept and the probability of a good text."""
    measured, name = measures(docs.select(key, text), text)
    measured = written(measured.select(key, name), "measures")
    good, kept = judge(measured, name, fit(measured, name))
    m = F.col(name)
    return measured.select(
        key,
        *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols")),
        m["lines"]["same"].cast("long").alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"),
        base_failed(name).alias("base_failed"),
        kept.alias("kept"),
        F.round(good, 6).alias("quality"),
    )
