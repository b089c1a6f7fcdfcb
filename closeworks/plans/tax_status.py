"""Monthly roll of the tax status of cases."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.functions.rules import carried_status
from closeworks.operators import aggregates, filters, ordered
from closeworks.operators.joins import lookup
from closeworks.operators.schema import quoted

STATUS = "STATUS"


def repeated_cases(closing: DataFrame) -> DataFrame:
    """Rows of cases that the closing holds more than once, for instance under two companies."""
    return aggregates.repeated_keys(closing, ["ID_PROCESSO"])


def roll_status(previous: DataFrame, closing: DataFrame, month: date | str, order: list[Column | str]) -> DataFrame:
    """Status of every known case in the new month, in long form.

    `previous` has ID_PROCESSO, STATUS and any amounts of the month before; `closing` has
    ID_PROCESSO, STATUS_M, MOTIVO_MOVIMENTACAO, PROVISAO_TOTAL_M. Of several rows of a case the
    first in `order` counts.
    """
    current = aggregates.keep_one(filters.has_key(closing, "ID_PROCESSO"), ["ID_PROCESSO"], order)
    columns = {"STATUS_M": "__status", "MOTIVO_MOVIMENTACAO": "__motive", "PROVISAO_TOTAL_M": "__provision"}
    found = lookup(previous, current, "ID_PROCESSO", columns, derived=True)
    rolled = carried_status(F.col("__status"), F.col(STATUS), F.col("__motive"), F.col("__provision"))
    return found.withColumns({STATUS: rolled, "MES_FECH": F.lit(month).cast("date")}).drop(*columns.values())


def roll_months(known: DataFrame, closings: DataFrame, months: Sequence[date | str], order: list[Column | str]) -> DataFrame:
    """Status of every known case at the end of each of the months, in long form, as `roll_status` gives it month after month.

    `known` has ID_PROCESSO, the STATUS at the end of its MES_FECH and any amounts; a case may have several, of which the last before a
    month counts, and has no row for months before its first. `closings` has the columns that `roll_status` names and MES_FECH, of any
    months, with gaps of any length; of several rows of a case and month the first in `order` counts.

    A closing or a settlement sets a status that later months only replace by another of these. The one that is known last is
    therefore the status, from one sort per case and without a pass per month. Only a status given in `known` can be open, so it alone is
    written off by a later month without provision.
    """
    current = aggregates.keep_one(filters.has_key(closings, "ID_PROCESSO"), ["ID_PROCESSO", "MES_FECH"], order)
    motive, status = F.col("MOTIVO_MOVIMENTACAO"), F.col("STATUS_M")
    month = F.col("MES_FECH").cast("date")
    new = F.when(motive == V.SETTLEMENT_MOTIVE, motive).when(~status.isin(*V.OPEN_STATUSES), status)

    def event(value: Column, given: bool) -> Column:
        return F.struct(value.alias("status"), month.alias("month"), F.lit(given).alias("given"))

    columns = [quoted(c) for c in known.columns if c != "MES_FECH"]
    listed = F.array(*[F.lit(m).cast("date") for m in months])
    # amounts are those that were given last
    asked = aggregates.keep_one(known, ["ID_PROCESSO"], [F.desc("MES_FECH")])
    asked = asked.select(*columns, F.explode(listed).alias("MES_FECH"), F.lit(2).alias("__kind"))
    given = known.select("ID_PROCESSO", month.alias("MES_FECH"), F.lit(1).alias("__kind"), event(F.col(STATUS), True).alias("__event"))
    happened = current.where(new.isNotNull() | (F.col("PROVISAO_TOTAL_M") == 0)).select(
        "ID_PROCESSO",
        month.alias("MES_FECH"),
        F.lit(0).alias("__kind"),
        F.when(new.isNotNull(), event(new, False)).alias("__event"),
        F.when(F.col("PROVISAO_TOTAL_M") == 0, month).alias("__zero"),
    )
    rows = asked.unionByName(given, allowMissingColumns=True).unionByName(happened, allowMissingColumns=True)
    seen = ordered.ordered(
        rows, ["ID_PROCESSO"], ["MES_FECH", "__kind"], {"__last": ordered.known("__event"), "__empty": ordered.known("__zero")}
    )
    last = F.col("__last.status")
    written_off = F.col("__last.given") & last.isin(*V.OPEN_STATUSES) & (F.col("__empty") > F.col("__last.month"))
    rolled = F.when(written_off, F.concat(last, F.lit(V.WRITE_OFF_SUFFIX))).otherwise(last)
    return seen.where("__kind = 2 AND __last IS NOT NULL").withColumn(STATUS, rolled).select(*columns, "MES_FECH")


def status_columns(history: DataFrame, months: list[str]) -> DataFrame:
    """Wide report: one status column per listed month (`yyyyMM`)."""
    labelled = history.withColumn("__month", F.date_format("MES_FECH", "yyyyMM"))
    wide = labelled.groupBy("ID_PROCESSO").pivot("__month", months).agg(F.min(STATUS))
    return wide.withColumnsRenamed({m: f"STATUS_{m}" for m in months})


def open_amount(rolled: DataFrame, value: str) -> DataFrame:
    """Amount of cases that are still open, per month."""
    is_open = F.col(STATUS).isin(*V.OPEN_STATUSES)
    return aggregates.sum_where(rolled, ["MES_FECH"], is_open, value, value)
