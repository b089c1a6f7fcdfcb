"""URL filter: rules by host and path, and a classifier of segmented names for all other urls.

Names of hosts are split into words by the likeliest path through a unigram model (Viterbi), whose counts are
those of the words in the visible text of all pages. Multinomial naive Bayes then scores the words of the host and
the tokens of the path; the urls that a rule decides are its labelled rows, all of them. The model stays a table:
the parts of a name are joined with the word counts, tokens with their likelihoods.

Defined cases: a null url, or one without "://", has an empty host and path, no tokens, and gets the likelier
class; repeated rows and null ids keep their rows; without labelled rows, or without pages, all is allowed;
of two rules of equal length that fit, which needs equal rules, block wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import native
from closeworks.llm.names import fresh
from closeworks.llm.store import written
from closeworks.operators.schema import quoted


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


#: The list of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Longest word that a name is split into.
LONGEST = 24
#: Number tokens are alike.
NUMBER = "#"


def host(url: Column) -> Column:
    """After the first :// up to the path, query or fragment; A-Z lower-cased."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, letters, letters.lower())


def path(url: Column) -> Column:
    """After the host up to the query or fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host_: Column, path_: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (size, blocks, rule), or null."""
    found = [
        F.when(
            ((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path),
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"),
                F.lit(r.verdict == "block").alias("blocks"),
                F.lit(r.host + r.path).alias("rule"),
            ),
        )
        for r in rules
    ]
    return F.array_max(F.array_compact(F.array(*found))) if found else F.lit(None)


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """How often each word occurs in the visible text of all pages: (word, count)."""
    text = F.regexp_replace(native.whole(html), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = F.split(F.lower(text), r"[^\p{L}]+")
    return (
        pages.select(F.explode(words).alias("word"))
        .where((F.col("word") != "") & (F.length("word") <= LONGEST))
        .groupBy("word")
        .count()
    )


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """Words of distinct names: (name, words), the likeliest split by the word counts (word, count)."""
    total = counts.agg(F.sum("count")).first()[0] or 1
    ends = F.transform(
        F.sequence(F.lit(1), F.length("name")),
        lambda a: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - a + 1)),
            lambda n: F.struct(a.alias("at"), n.alias("size"), F.substring("name", a, n).alias("word")),
        ),
    )
    parts = names.where("name <> ''").select("name", F.explode(F.flatten(ends)).alias("p"))
    known = parts.join(counts, parts["p.word"] == counts["word"]).select("name", "p.at", "p.size", "count")
    found = known.groupBy("name").agg(F.collect_list(F.struct("at", "size", "count")).alias("known"))
    joined = names.where("name <> ''").join(found, "name", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            split = [viterbi(r["name"], {(k["at"], k["size"]): k["count"] for k in r["known"] or []}, total) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(split, pa.list_(pa.string()))], ["name", "words"]
            )

    return joined.select("name", "known").mapInArrow(run, "name string, words array<string>")


def viterbi(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a name. known: counts by (place from 1, size); unknown words are less likely the longer."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for size in range(1, min(LONGEST, end) + 1):
            count = known.get((end - size + 1, size))
            one = log(count / total) if count else log(10 / total) - size * log(10)
            options.append((best[end - size][0] + one, -size))
        score, size = max(options)
        best.append((score, -size))
    out, end = [], len(name)
    while end:
        size = best[end][1]
        out.append(name[end - size : end])
        end -= size
    return out[::-1]


def _path_tokens(path_: Column) -> Column:
    tokens = F.array_remove(F.split(F.lower(path_), r"[^\p{L}\p{N}]+"), "")
    return F.transform(tokens, lambda t: F.when(t.rlike("^[0-9]+$"), NUMBER).otherwise(F.concat(F.lit("/"), t)))


def _features(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words): the words of a host's names, digits and signs aside."""
    names = hosts.select("host", F.explode(F.array_distinct(F.split("host", r"[^\p{L}]+"))).alias("name"))
    split = segment(names.select("name").distinct(), counts)
    words = F.sort_array(F.flatten(F.collect_list("words")))
    return names.join(split, "name").groupBy("host").agg(words.alias("words"))


def judge_urls(pages: DataFrame, url: str = "url", html: str = "html", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with host, path, rule, verdict and block_probability (null where a rule decides).

    Added columns that the rows have already get underscores.
    """
    names = {k: fresh(pages, k) for k in ("host", "path", "rule", "verdict", "block_probability")}
    urls = pages.select(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    urls = urls.withColumn("tokens", F.sort_array(_path_tokens(F.col("path"))))
    urls = urls.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    kinds = written(urls.groupBy("host", "tokens", F.col("found.blocks").alias("blocks")).count(), "urls")

    hosts = kinds.select("host").distinct()
    words = written(_features(hosts, written(word_counts(pages, html), "words")), "hosts")
    both = F.concat(F.coalesce("words", F.array().cast("array<string>")), "tokens")
    seen = kinds.join(words, "host", "left").select("host", "tokens", "blocks", "count", both.alias("all"))
    seen = written(seen, "seen")
    model, prior = _bayes(seen.where("blocks is not null"))
    scored = (
        seen.where("blocks is null")
        .select("host", "tokens", F.explode("all").alias("token"))
        .join(model, "token")
        .groupBy("host", "tokens")
        .agg(F.sum("weight").alias("score"))
    )

    own = pages.withColumn(names["host"], host(F.col(url))).withColumn(names["path"], path(F.col(url)))
    tokens, found = fresh(own, "tokens_"), fresh(own, "found_")
    own = own.withColumn(tokens, F.sort_array(_path_tokens(F.col(names["path"]))))
    own = own.withColumn(found, rule_of(F.col(names["host"]), F.col(names["path"]), rules))
    host_key, tokens_key = fresh(own, "host_key"), fresh(own, "tokens_key")
    scored = scored.select(
        F.col("host").alias(host_key), F.col("tokens").alias(tokens_key), F.col("score").alias(names["block_probability"])
    )
    # null-safe, so that the small side is shuffled for the join and a host of very many pages can be split
    on = F.col(names["host"]).eqNullSafe(F.col(host_key)) & F.col(tokens).eqNullSafe(F.col(tokens_key))
    judged = own.join(scored, on, "left")
    probability = F.round(1 / (1 + F.exp(-(F.coalesce(names["block_probability"], F.lit(0.0)) + F.lit(prior)))), 6)
    blocks = F.coalesce(F.col(found)["blocks"], probability > 0.5)
    return judged.select(
        *map(quoted, pages.columns),
        names["host"],
        names["path"],
        F.col(found)["rule"].alias(names["rule"]),
        F.when(blocks, "block").otherwise("allow").alias(names["verdict"]),
        F.when(F.col(found).isNull(), probability).alias(names["block_probability"]),
    )


def _bayes(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Naive Bayes of labelled rows (all, blocks, count): (token, weight), log odds of block, and those of the class."""
    n = F.col("count")
    row = labelled.agg(
        F.sum(F.when(F.col("blocks"), n).otherwise(0)).alias("block"),
        F.sum(F.when(~F.col("blocks"), n).otherwise(0)).alias("allow"),
        F.sum(F.when(F.col("blocks"), n * F.size("all")).otherwise(0)).alias("block_tokens"),
        F.sum(F.when(~F.col("blocks"), n * F.size("all")).otherwise(0)).alias("allow_tokens"),
    ).first()
    tokens = (
        labelled.select(F.explode("all").alias("token"), "blocks", "count")
        .groupBy("token")
        .agg(
            F.sum(F.when(F.col("blocks"), n).otherwise(0)).alias("block"),
            F.sum(F.when(~F.col("blocks"), n).otherwise(0)).alias("allow"),
        )
    )
    tokens = written(tokens, "tokens")
    size = tokens.count()
    block, allow = row["block"] or 0, row["allow"] or 0
    # a class without rows says nothing
    prior = log((block + 1) / (allow + 1)) if block and allow else (1.0 if block else -1.0)
    rest = log(((row["allow_tokens"] or 0) + size + 1) / ((row["block_tokens"] or 0) + size + 1))
    weight = F.log((F.col("block") + 1) / (F.col("allow") + 1)) + F.lit(rest)
    return tokens.select("token", weight.alias("weight")), prior
