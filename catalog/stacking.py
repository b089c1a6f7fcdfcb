"""Unions of slices whose schemas differ."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from closeworks.operators import schema, unions
from closeworks.plans.entries import entries_base, entries_per_month
from closeworks.sources.snapshots import read_snapshots

_YEARS = list(range(1995, 2002))


def _slices(spark, folder):
    """One table per year of orders, as if each had been written by another version of a job.

    The first also holds all earlier orders and those without a date, the last all later ones.
    """
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate")
    for year in _YEARS:
        start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
        end = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
        within = day >= start if year == _YEARS[-1] else (day >= start) & (day < end)
        yield year, orders.filter(within if year > _YEARS[0] else day.isNull() | (day < end))


@query("""
SELECT o_orderkey::VARCHAR AS "ID_PROCESSO", o_custkey::VARCHAR AS "CODIGO", o_totalprice AS "VALOR_R$",
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS "PRIORIDADE",
       CASE WHEN year(o_orderdate) >= 2001 THEN o_orderdate::DATE END AS "DATA_DE_ENTRADA"
FROM orders""")
def union_harmonized(spark, folder):
    slices = []
    for year, rows in _slices(spark, folder):
        key, code, value = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
        columns = [
            key.cast("string").alias("id processo") if year % 2 else key.alias("ID_PROCESSO"),
            code.cast("string").alias("Código") if year == 1996 else code.alias("CODIGO"),
            value.alias("Valor R$"),
            F.lit("repetido").alias("valor_r$") if year == 1997 else F.lit(None).cast("double").alias("VALOR_R$"),
        ]
        if year >= 1998:
            columns.append(F.col("o_orderpriority").alias("prioridade"))
        if year == 2001:
            columns.append(F.to_date("o_orderdate").alias("Data de entrada"))
        slices.append(rows.select(*columns))
    return unions.union_harmonized(slices)


@query("""
SELECT o_orderkey, CASE WHEN coalesce(year(o_orderdate), 1995) < 1999 THEN o_custkey END AS customer,
       CASE WHEN year(o_orderdate) >= 1999 THEN o_orderstatus END AS status, least(greatest(coalesce(year(o_orderdate), 1995), 1995), 2001)::INTEGER AS year
FROM orders""")
def union_missing(spark, folder):
    slices = []
    for year, rows in _slices(spark, folder):
        extra = F.col("o_custkey").alias("customer") if year < 1999 else F.col("o_orderstatus").alias("status")
        slices.append(rows.select("o_orderkey", extra, F.lit(year).alias("year")))
    return unions.union_all(slices)


@query("""
SELECT DISTINCT o_custkey::VARCHAR AS o_custkey, o_orderstatus FROM orders""")
def union_distinct(spark, folder):
    orders = table(spark, folder, "orders")
    odd = F.col("o_orderkey") % 2 == 1
    left = orders.filter(odd).select("o_custkey", "o_orderstatus", "o_totalprice")
    # The key is text in one of the two, as after a change of the export.
    right = orders.filter(~odd).select("o_orderstatus", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderpriority")
    return unions.union_distinct(left, right)


@query("""
WITH sheets AS (SELECT least(greatest(coalesce(year(o_orderdate), 1995), 1995), 2001) AS sheet, * FROM orders)
SELECT o_orderkey AS "Id", CASE WHEN sheet % 2 = 0 THEN o_totalprice ELSE o_custkey::DOUBLE END AS "Valor",
  CASE WHEN sheet < 1998 THEN o_orderstatus END AS "situacao"
FROM sheets""")
def union_letter_case(spark, folder):
    """Sheets that spell a column Id, ID or id are one table; amounts are whole numbers in every other sheet."""
    sheets = []
    for year, rows in _slices(spark, folder):
        key = F.col("o_orderkey").alias(("Id", "ID", "id")[(year - 1995) % 3])
        value = F.col("o_custkey").cast("int").alias("Valor") if year % 2 else F.col("o_totalprice").alias("VALOR")
        status = [F.col("o_orderstatus").alias("situacao" if year < 1997 else "Situacao")]
        sheets.append(rows.select(key, value, *(status if year < 1998 else [])))
    return unions.union_all(sheets)


@query("""
WITH sheets AS (SELECT least(greatest(coalesce(year(o_orderdate), 1995), 1995), 2001) - 1995 AS "ENTRADA", * FROM orders
), places AS (SELECT unnest(range(7)) AS "ENTRADA")
SELECT p."ENTRADA"::INTEGER AS "ENTRADA", c."COLUNA", count(*) FILTER (
    s."ENTRADA" IS NOT NULL AND CASE c."COLUNA" WHEN 'CODIGO' THEN o_custkey % 5 = 0 AND p."ENTRADA" % 2 = 1 WHEN 'VALOR' THEN o_orderstatus = 'P' END) AS "PERDIDOS"
FROM places p CROSS JOIN (VALUES ('CODIGO'), ('VALOR')) c("COLUNA") LEFT JOIN sheets s ON s."ENTRADA" = p."ENTRADA" GROUP BY ALL""")
def lost_values(spark, folder):
    """Values that sheets lose when they are brought to one schema: codes with a letter in every other year, and amounts in words."""
    sheets = []
    for year, rows in _slices(spark, folder):
        code = F.col("o_custkey").cast("string")
        coded = F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit("A"), code)).otherwise(code) if year % 2 == 0 else F.col("o_custkey")
        value = F.when(F.col("o_orderstatus") == "P", "a combinar").otherwise(F.col("o_totalprice").cast("string"))
        sheets.append(rows.select(coded.alias("Codigo"), value.alias("valor"), "o_orderkey"))
    return schema.lost_values(sheets, "CODIGO bigint, VALOR double, OUTRO string")


@query("""
SELECT date_trunc('month', o_orderdate)::DATE AS "MES_FECH", count(*) AS "QTD" FROM orders
WHERE o_orderdate >= DATE '1998-01-01' GROUP BY 1""")
def entries_by_era(spark, folder):
    eras = []
    for year, rows in _slices(spark, folder):
        month = F.trunc(F.to_date("o_orderdate"), "MM").alias("MES_FECH")
        columns = [F.col("o_orderkey").alias("ID_PROCESSO"), month, F.lit(str(year)).alias("SOURCE")]
        eras.append(rows.select(*columns, *(["o_orderpriority"] if year > 1998 else [])))
    return entries_per_month(entries_base(*eras), "1998-01-01")


@query("""
SELECT date_trunc('year', o_orderdate)::DATE AS "MES_FECH", o_orderstatus, count(*) AS n FROM orders
WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate <= DATE '1999-12-31' GROUP BY ALL""")
def snapshots_by_period(spark, folder):
    recent = read_snapshots(spark, f"{folder}/orders.parquet", "o_orderdate", "1997-01-01", "1999-12-31")
    year = F.trunc(F.to_date("o_orderdate"), "year").alias("MES_FECH")
    return recent.groupBy(year, "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
