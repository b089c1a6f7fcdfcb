"""Dialogues of several parties, rendered once from the view of each. Only DataFrame functions are used.

For every participant all turns are rendered: that speaker's turns as the assistant's, which are trained on,
those of others as named users, system turns as they are. The mask lists the trained spans of a text in code
points. A long dialogue is rendered in parts of TURNS turn numbers, so that no task holds a dialogue as a whole;
every part is cut further after each MOST turns of its order, which most parts don't reach. Turns within a part, and its cuts,
follow the turn number, then speaker and text. A system turn is in the first part that has it, and not repeated in later ones.

Defined cases: a null role is a speaker called "unknown", a null text is empty; null turns come last, in a part of
their own; a null conversation id is one conversation; repeated rows are repeated turns; a dialogue of system turns only
has no participants, and so no rows, as does an empty table; further columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closeworks.llm import native
from closeworks.operators.windows import Windowed, per_key

TURNS = 64
#: Turns of a part that are rendered together.
MOST = 1024
#: Letters of a text that block it while a big part is numbered, coarse to fine.
FIRST = (2, 8)
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"


def _escaped(text: Column) -> Column:
    """Text that can't be mistaken for a marker."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _cut(rows: DataFrame) -> DataFrame:
    """The rows with `cut`: the turns of big parts in order, MOST by MOST.

    Equal turns are one row with a count while they are numbered. Blocks are the turn number and, within it, the
    role and then the first letters of the text, so that no task holds a part as a whole.
    """
    small = rows.where("big is null").drop("big").withColumn("cut", F.lit(0).cast("long"))
    keys, order = ["conv_id", "part"], ["last", "turn", "role", "text"]
    big = rows.where("big").drop("big").withColumn("last", F.col("turn").isNull())
    once = big.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("copies"))
    block = [F.col("turn"), F.col("role"), *(F.substring("text", 1, n) for n in FIRST)]
    before = Windowed(local=lambda w: F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, 0)), size=F.sum("copies"))
    placed = per_key(once, keys, order, block, {"upto": before})
    copy = F.explode(F.sequence(F.col("upto") - F.col("copies"), F.col("upto") - 1))
    each = placed.select(*rows.drop("big").columns, copy.alias("place"))
    return small.unionByName(each.withColumn("cut", F.floor(F.col("place") / MOST)).drop("place"))


def parts(turns: DataFrame) -> DataFrame:
    """(conv_id, part, cut, turns): the sorted turns of each part, from (conv_id, turn, role, text)."""
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / TURNS).alias("part"),
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
        native.whole("text").alias("text"),
    )
    many = rows.groupBy("conv_id", "part").count().where(F.col("count") > MOST)
    many = many.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.lit(True).alias("big"))
    same = rows["conv_id"].eqNullSafe(many["c"]) & rows["part"].eqNullSafe(many["p"])
    cut = _cut(rows.join(many, same, "left").drop("c", "p"))
    one = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text")
    return cut.groupBy("conv_id", "part", "cut").agg(F.array_sort(F.collect_list(one)).alias("turns"))


def _header(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == SYSTEM, F.lit("<|system|>\n"))
        .when(role == speaker, F.lit("<|assistant|>\n"))
        .otherwise(F.concat(F.lit("<|user name="), F.replace(_escaped(role), F.lit("\n"), F.lit(" ")), F.lit("|>\n")))
    )


def rotate(turns: DataFrame) -> DataFrame:
    """One row per participant and part: its text, the trained spans, and how many turns are the participant's."""
    speakers = (
        turns.select(F.col("conv_id").alias("c"), F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"))
        .where(F.col("speaker") != SYSTEM)
        .distinct()
    )
    cut = parts(turns)
    seen = cut.join(speakers, cut["conv_id"].eqNullSafe(speakers["c"]))
    speaker = F.col("speaker")
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == speaker).alias("own"),
            _header(t["role"], speaker).alias("header"),
            F.concat(_escaped(t["text"]), F.lit(END)).alias("body"),
        ),
    )
    seen = seen.withColumn("pieces", pieces)

    def spans(places: Column) -> Column:
        marked = F.transform(
            "pieces",
            lambda p, i: F.when(
                p["own"],
                F.struct(
                    (F.get(places, i) + F.length(p["header"])).alias("start"),
                    (F.get(places, i) + F.length(p["header"]) + F.length(p["body"])).alias("end"),
                ),
            ),
        )
        return F.array_compact(marked)

    sizes = F.transform("pieces", lambda p: (F.length(p["header"]) + F.length(p["body"])).cast("long"))
    return seen.select(
        "conv_id",
        "part",
        "cut",
        "speaker",
        F.size("pieces").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).alias("n_own"),
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["header"], p["body"]))).alias("text"),
        native.bind(native.sums_before(sizes), spans).alias("mask"),
    )
