"""Phase roll-forward: how cases move between phases from month to month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.functions import rules
from closeworks.functions import fixed_values as V
from closeworks.operators import aggregates, filters, joins, windows


def phase_history(snapshots: DataFrame, book: DataFrame, since: str) -> DataFrame:
    """Phase group per case and month, ENCERRADO in the month the case was closed.

    `snapshots` has ID_PROCESSO, MES_FECH, FASE; only cases that the book shows open since
    the given month are kept.
    """
    recent = filters.in_period(book, "MES_FECH", start=since)
    closed = filters.flagged(recent, "ENCERRADOS").groupBy("ID_PROCESSO").agg(
        F.min("MES_FECH").alias("MES_ENCERRADO")
    )
    open_cases = filters.not_flagged(recent, "ENCERRADOS")
    grouped = snapshots.withColumn("DP_FASE", rules.group_phase(F.col("FASE"), null_label="DEMAIS"))
    found = joins.lookup(grouped, closed, "ID_PROCESSO", ["MES_ENCERRADO"], derived=True)
    is_closed = F.col("MES_FECH") == F.col("MES_ENCERRADO")
    phases = found.withColumn("DP_FASE", F.when(is_closed, V.CLOSED_PHASE).otherwise(F.col("DP_FASE")))
    return joins.known_only(phases, open_cases, ["ID_PROCESSO"]).select("ID_PROCESSO", "MES_FECH", "DP_FASE")


def roll_forward(history: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Transition code and label of each case and month against its previous snapshot.

    `counted` may be a cheaper table in which to look for hot cases, with ID_PROCESSO, MES_FECH and DP_FASE (see `ordered`).
    """
    return windows.phase_transitions(history, "ID_PROCESSO", ["MES_FECH", "DP_FASE"], "DP_FASE", counted)


def transition_matrix(rolled: DataFrame, provisions: DataFrame) -> DataFrame:
    """Cases and provision movement by month and transition.

    `provisions` holds ID_PROCESSO, MES_FECH, PROVISAO_MOV_M, once per case and month.
    """
    distinct = rolled.select("ID_PROCESSO", "MES_FECH", "MUDOU_FASE", "DP_FASE_MES").distinct()
    found = joins.lookup(distinct, provisions, ["ID_PROCESSO", "MES_FECH"], ["PROVISAO_MOV_M"])
    return found.groupBy("MES_FECH", "MUDOU_FASE", "DP_FASE_MES").agg(
        F.sum("PROVISAO_MOV_M").alias("PROVISAO_MOV_M"), F.count("ID_PROCESSO").alias("QTDE")
    )


def transition_pivot(rolled: DataFrame, months: Sequence[str]) -> DataFrame:
    """One row per case with code and label columns for each listed month (`yyyyMM`), OUTROS for all others."""
    labelled = rolled.withColumn("__month", F.date_format("MES_FECH", "yyyyMM"))
    wide = aggregates.pivot_first(
        labelled, ["ID_PROCESSO"], "__month", months, MUDOU_FASE="MUDOU_FASE", DP_FASE="DP_FASE_MES"
    )
    names = {f"{m}_{c}": f"{c}_{m}" for m in (*months, aggregates.OTHERS) for c in ("MUDOU_FASE", "DP_FASE")}
    return wide.withColumnsRenamed(names)
