"""Installment plans: numbers, remaining parts, schedules and provisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeworks.functions import fixed_values as V
from closeworks.operators.joins import lookup

PLAN = "PARCELAMENTO_CONDENACAO"


def part_number(plan: Column) -> Column:
    """Number in `n ª PARCELA`; 0.5 for the 30 % down payment."""
    number = F.regexp_extract(plan, r"(\d+)\s*ª\s*PARCELA", 1).try_cast("int")
    return F.when(plan == V.COURT_PLAN, F.lit(0.5)).otherwise(number.cast("double"))


def plan_amounts(df: DataFrame) -> DataFrame:
    """Add VALOR_TOTAL and VALOR_RESTANTE, which a down payment of 30 % implies."""
    down_payment = F.contains(F.col(PLAN), F.lit(V.COURT_PLAN))
    whole = F.col("VALOR") / V.COURT_PLAN_DOWN_PAYMENT
    return df.withColumns(
        {
            "VALOR_TOTAL": F.when(down_payment, whole).otherwise(F.col("VALOR")),
            "VALOR_RESTANTE": F.when(down_payment, whole - F.col("VALOR")).otherwise(F.lit(0.0)),
        }
    )


def highest_part(df: DataFrame, case: str = "PROCESSO_ID") -> DataFrame:
    """Add NUMERO_PARCELA, the highest of the case as MAIOR_PARCELA, and a SIM/NÃO mark on it."""
    numbered = df.withColumn("NUMERO_PARCELA", part_number(F.col(PLAN)))
    highest = numbered.groupBy(case).agg(F.max("NUMERO_PARCELA").alias("__highest"))
    found = lookup(numbered, highest, case, {"__highest": "MAIOR_PARCELA"}, derived=True)
    is_highest = F.col("MAIOR_PARCELA") == F.col("NUMERO_PARCELA")
    return found.withColumn("E_MAIOR_PARCELA", F.when(is_highest, "SIM").otherwise("NÃO"))


def remaining_parts(df: DataFrame) -> DataFrame:
    """Add PARCELAS_FALTANTES and VALOR_POR_PARCELA on rows from `highest_part`."""
    last = F.col("E_MAIOR_PARCELA") == "SIM"
    number = F.col("NUMERO_PARCELA")
    missing = (
        F.when((number == 0.5) & last, F.lit(float(V.COURT_PLAN_LATER_PARTS)))
        .when(last & (number >= 1), V.COURT_PLAN_LATER_PARTS - number)
        .otherwise(F.lit(0.0))
    ).cast("int")
    counted = df.withColumn("PARCELAS_FALTANTES", missing)
    rest = F.col("VALOR_RESTANTE")
    return counted.withColumn(
        "VALOR_POR_PARCELA",
        F.when(rest > 0, F.try_divide(rest, F.col("PARCELAS_FALTANTES"))).otherwise(F.col("VALOR")),
    )


def expand_parts(df: DataFrame, remaining: str = "PARCELAS_FALTANTES", number: str = "NUMERO_PARCELA"):
    """One row per remaining part; rows without any drop out."""
    parts = F.explode(F.sequence(F.lit(1), F.col(remaining)))
    return df.filter(F.col(remaining) >= 1).withColumn(number, parts)


def due_date(paid_on: Column, part: Column) -> Column:
    """Thirty days after the previous part; a later part counts from its payment date. Null for numbers beyond all dates."""
    return F.date_add(paid_on, ((part - 1) * 30).try_cast("int"))


def provision_part(kind: Column, part: Column, provision: Column, parts: Column) -> Column:
    """Share of the provision: 30 % then 70 % over six parts, or even parts of a settlement."""
    first = V.COURT_PLAN_DOWN_PAYMENT
    later = (provision * (1 - first)) / V.COURT_PLAN_LATER_PARTS
    return (
        F.when((kind == "CONDENAÇÃO") & (part == 1), provision * first)
        .when((kind == "CONDENAÇÃO") & (part > 1), later)
        .when(kind == "ACORDO", F.try_divide(provision, parts))
    )


def conviction_part_value(part: Column, value: Column) -> Column:
    """The down payment itself, then a sixth of what it leaves open."""
    whole = value / V.COURT_PLAN_DOWN_PAYMENT
    return F.when(part == 1, value).otherwise((whole - value) / V.COURT_PLAN_LATER_PARTS)
