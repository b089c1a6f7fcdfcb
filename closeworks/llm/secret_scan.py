"""Secret scan with links between the parts of a credential. Only DataFrame functions are used.

Strong kinds (assign, access, hex) are reported wherever they match. Weak parts (identifier, secret,
endpoint) are reported only where parts that complete them start within their scope: a secret needs an
identifier or an endpoint, an identifier needs a secret, an endpoint needs both. Scopes are intervals of
code points around a part. They are joined with the parts through blocks of a text, and each block keeps
only the first and last start of a kind, so that many parts close together never make pairs.

Defined cases: a null text is an empty one, without spans; rows are judged one by one, and rows with equal
id and text share their links; a null id is an id like any other; an empty table gives an empty result;
columns of the input keep their names, added ones step aside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.llm import native
from closeworks.llm.names import fresh
from closeworks.llm.store import written
from closeworks.operators.schema import quoted

SEPARATOR = r"[\"']?\x20*[:=]\x20*[\"']?"
LABEL = "(?i:password|passwd|secret|token|api_?key)"
MIN_VALUE = 6
ASSIGN = LABEL + SEPARATOR + "[A-Za-z0-9+/_.=-]+"
#: A run is matched as a whole, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
STRONG = ("assign", "access", "hex")

IDENTIFIER = r"\b(?i:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)" + SEPARATOR + "[A-Za-z0-9._@+-]{3,}"
SECRET_LABELLED = r"\b(?i:pwd|pass|auth|key|credential)" + SEPARATOR + r"[^\s\"',;]{4,}"
SECRET_BARE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"\b(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{3,}"
WEAK = ("identifier", "secret", "endpoint")
KINDS = STRONG + WEAK

#: Code points before and after a part that belong to its scope.
SCOPE = 200
#: Kinds of part that a strong find counts as.
STANDS_FOR = {"assign": "secret", "access": "identifier", "hex": "secret"}
MASK = "[SECRET]"

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _of_kind(found: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end")))


def strong_spans(text: Column) -> Column:
    """Spans of the strong kinds, in no particular order."""
    assigned = F.filter(
        native.spans(text, ASSIGN),
        lambda s: F.length(F.regexp_replace(s["hit"], "^" + LABEL + SEPARATOR, "")) >= MIN_VALUE,
    )
    return F.concat(
        _of_kind(assigned, "assign"),
        _of_kind(native.spans(text, ACCESS), "access"),
        _of_kind(native.spans(text, HEX), "hex"),
    )


def weak_spans(text: Column) -> Column:
    """Spans that may be parts of a credential."""
    bare = F.filter(
        native.spans(text, SECRET_BARE),
        lambda s: s["hit"].rlike("[0-9]") & s["hit"].rlike("[A-Z]") & s["hit"].rlike("[a-z]"),
    )
    return F.array_distinct(
        F.concat(
            _of_kind(native.spans(text, IDENTIFIER), "identifier"),
            _of_kind(native.spans(text, SECRET_LABELLED), "secret"),
            _of_kind(bare, "secret"),
            _of_kind(native.spans(text, ENDPOINT), "endpoint"),
        )
    )


def _kind_is(part: Column, kinds: list[str]) -> Column:
    return part.isin([KINDS.index(k) for k in kinds])


def _part(kind: Column) -> Column:
    """The part of a credential that a kind stands for."""
    strong = reduce(
        lambda done, item: done.when(kind == KINDS.index(item[0]), KINDS.index(item[1])), STANDS_FOR.items(), F
    )
    return strong.otherwise(kind)


def linked(found: DataFrame) -> DataFrame:
    """Weak parts that others complete: (row, weak spans), from (row, strong, weak) with unique rows.

    The interval join goes through blocks of SCOPE code points. Of the parts of a kind in a block only the
    first and the last start are kept: they tell whether any lies in a scope that covers one end of the block,
    and blocks in between lie in the scope as a whole.
    """
    some = found.where(F.size("weak") > 0)
    parts = some.select("row", F.explode(F.concat("strong", "weak")).alias("s")).select(
        "row", _part(F.col("s.kind")).alias("part"), F.col("s.start").alias("start")
    )
    blocks = (
        parts.withColumn("block", F.floor(F.col("start") / SCOPE))
        .groupBy("row", "block", "part")
        .agg(F.min("start").alias("first"), F.max("start").alias("last"))
    )
    scopes = (
        some.select("row", F.explode("weak").alias("s"))
        .withColumn("from", F.greatest(F.col("s.start") - SCOPE, F.lit(0)))
        .withColumn("to", F.col("s.end") + SCOPE)
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / SCOPE), F.floor(F.col("to") / SCOPE))))
    )
    inside = (F.col("last") >= F.col("from")) & (F.col("first") <= F.col("to"))
    # a block at both ends of a scope can hold its first start before and its last start after it
    met = scopes.join(blocks, ["row", "block"]).where(inside).groupBy("row", "s")
    has = {k: F.max(_kind_is(F.col("part"), [k])).alias(k) for k in WEAK}
    kind = F.col("s.kind")
    complete = (
        (_kind_is(kind, ["secret"]) & (F.col("identifier") | F.col("endpoint")))
        | (_kind_is(kind, ["identifier"]) & F.col("secret"))
        | (_kind_is(kind, ["endpoint"]) & F.col("identifier") & F.col("secret"))
    )
    return met.agg(*has.values()).where(complete).groupBy("row").agg(F.collect_list("s").alias("linked"))


def _row(docs: DataFrame, key: str, text: str) -> Column:
    """Names a row by its id and text."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), native.whole(text)))


def _scanned(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = native.whole(text)
    return docs.select(
        F.col(key), _row(docs, key, text).alias("row"), strong_spans(body).alias("strong"), weak_spans(body).alias("weak")
    )


def _with_links(scanned: DataFrame) -> DataFrame:
    """The scanned rows with all their spans, sorted by start and kind."""
    weak = scanned.where(F.size("weak") > 0).select("row", "strong", "weak").dropDuplicates(["row"])
    joined = scanned.join(linked(weak), "row", "left")
    none = F.array().cast(SPAN)
    return joined.withColumn("spans", F.array_sort(F.concat("strong", F.coalesce("linked", none)))).drop("linked")


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    )


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the strong kinds, digest of their spans, and all spans."""
    found = _with_links(written(_scanned(docs.select(key, text), key, text), "secrets"))
    strong = F.array_sort("strong")

    def count(kind: str) -> Column:
        return F.size(F.filter("strong", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return found.select(
        key,
        *(count(k).alias(f"n_{k}") for k in STRONG),
        native.sha256_of(_listed(strong)).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """A text with its spans, sorted by start, replaced by MASK; overlapping spans are replaced as one."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast("array<string>").alias("done"))

    def step(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")), F.lit(MASK))
        new = F.when(s["start"] >= state["at"], F.concat(state["done"], F.array(piece))).otherwise(state["done"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), new.alias("done"))

    cut = F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(
            F.concat_ws("", state["done"]),
            F.substring(text, (state["at"] + 1).cast("int"), F.lit(2**31 - 1)),
        ),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def mask_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all reported spans of their text masked; other columns stay as they are."""
    row, spans = fresh(docs, "row_"), fresh(docs, "spans_")
    found = written(_scanned(docs.select(key, text), key, text).where(F.size(F.concat("strong", "weak")) > 0), "secrets")
    hits = (
        _with_links(found).where(F.size("spans") > 0).dropDuplicates(["row"])
        .select(F.col("row").alias(row), F.col("spans").alias(spans))
    )
    joined = docs.withColumn(row, _row(docs, key, text)).join(hits, row, "left")
    return joined.withColumn(
        text, F.when(F.col(spans).isNotNull(), masked(F.col(text), F.col(spans))).otherwise(F.col(text))
    ).select(*map(quoted, docs.columns))
