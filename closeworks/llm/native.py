"""Text measures as Column expressions, for operators that run without Python on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that separates words.
SPACES = " \t\n\x0b\x0c\r"

#: Matches whose positions are added up in one go; keeps the work in proportion to their number.
STEP = 256


def whole(text: Column | str) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), "")


def without(text: Column, letters: str) -> Column:
    """A text without some letters."""
    return F.translate(text, letters, "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times, evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(part: Column, zero: Column) -> Column:
    """The sums of 0, 1, 2, ... numbers of a short array, on top of a first one."""
    return F.aggregate(part, F.array(zero), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))


def sums_before(values: Column) -> Column:
    """For each number of an array the sum of those before it, and the total as one more item."""
    zero = F.lit(0).cast("long")

    def of(cut: Column) -> Column:
        totals = F.transform(cut, lambda part: F.aggregate(part, zero, lambda a, x: a + x))
        return bind(
            _running(totals, zero),
            lambda starts: F.concat(
                F.flatten(
                    F.transform(
                        cut, lambda part, i: F.slice(_running(part, F.get(starts, i)), F.lit(1), F.size(part))
                    )
                ),
                F.array(F.element_at(starts, -1)),
            ),
        )

    def parts(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(x) + 1, F.lit(STEP)), lambda i: F.slice(x, i, F.lit(STEP)))

    return bind(values, lambda x: bind(parts(x), of))


def spans(text: Column, pattern: str) -> Column:
    """Each match of a pattern, leftmost first and apart from each other, as (start, end, hit) in code points.

    The pattern must not match an empty text.
    """

    def of(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))

        def placed(gap: Column) -> Column:
            # hit k starts after the first gap, and the hits before it with the gaps that follow them
            first = F.element_at(gap, 1)
            after = F.slice(gap, F.lit(2), F.size(hits))
            return bind(
                sums_before(F.zip_with(hits, after, lambda h, g: F.length(h) + g)),
                lambda before: F.transform(
                    hits,
                    lambda h, i: F.struct(
                        (first + F.get(before, i)).alias("start"),
                        (first + F.get(before, i) + F.length(h)).alias("end"),
                        h.alias("hit"),
                    ),
                ),
            )

        return bind(gaps, placed)

    found = bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def sha256_of(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text in UTF-8."""
    return F.sha2(text, 256)
