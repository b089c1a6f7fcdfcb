"""Sources that need no files of their own: headers of grids, periods in file names, and names that become paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, rounded, table
from closeworks.sources import contracts, merges, rollups, sheets, snapshots


@query("""
SELECT 'livro ' || o_custkey % 50 AS SOURCE_FILE, o_orderstatus AS SHEET, o_orderkey::VARCHAR AS CHAVE,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS PRIORIDADE FROM orders""")
def promoted_header(spark, folder):
    """Tabs with a title row, a header, and columns in another order or missing."""
    orders = table(spark, folder, "orders")
    key, priority, status = F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), F.col("o_orderstatus")
    file = F.concat(F.lit("livro "), (F.col("o_custkey") % 50).cast("string"))
    missing = F.lit(None).cast("string")

    def tab(first, second):
        """Cells in the layout of the tab: P has no priority, O has the columns the other way round."""
        return F.when(status == "P", F.array(first)).when(status == "O", F.array(second, missing, first)).otherwise(F.array(first, second))

    # Rows of a tab follow the key, so that the grid needs no numbering of its own.
    below = orders.select(file.alias("SOURCE_FILE"), status.alias("SHEET"), (F.col("o_orderkey") % 1_000_000 + 10).cast("int").alias("ROW_NO"), tab(key, priority).alias("CELLS"))
    tabs = orders.select(file.alias("SOURCE_FILE"), status.alias("SHEET"), "o_orderstatus").distinct()
    header = tabs.select("SOURCE_FILE", "SHEET", F.lit(4).alias("ROW_NO"), tab(F.lit("CHAVE"), F.lit("PRIORIDADE")).alias("CELLS"))
    title = tabs.select("SOURCE_FILE", "SHEET", F.lit(2).alias("ROW_NO"), F.array(F.lit("PLANILHA")).alias("CELLS"))
    return sheets.promote_header(below.union(header).union(title), ["CHAVE", "PRIORIDADE"], "CHAVE")


@query("""
SELECT o_orderkey, 'base ' || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderstatus = 'P' THEN '.csv' ELSE '.xlsx' END AS SOURCE,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS DATA_ARQUIVO,
  CASE WHEN o_orderstatus <> 'P' THEN date_trunc('month', o_orderdate)::DATE END AS MES_REF
FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 7 <> 3""")
def source_period(spark, folder):
    """Every order has a file; `named_like` rejects the .tmp ones."""
    orders = table(spark, folder, "orders")
    ending = F.when(F.col("o_orderstatus") == "P", ".csv").when(F.col("o_orderkey") % 7 != 3, ".xlsx").otherwise(".tmp")
    name = F.concat(F.lit("base "), F.date_format("o_orderdate", "yyyyMMdd"), ending)
    tagged = snapshots.tag_source_period(orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), name)
    return snapshots.named_like(tagged, "SOURCE", r"\.(csv|xlsx)$").drop("o_orderdate", "o_orderstatus")


@query("""
SELECT p_partkey, replace(replace(regexp_replace(trim(p_type || ' / ' || p_brand), '[\\\\*?:"<>|]', '', 'g'), ' ', '_'), '/', '-') AS ARQUIVO
FROM part""")
def file_safe_names(spark, folder):
    part = table(spark, folder, "part")
    name = F.concat("p_type", F.lit(" / "), "p_brand")
    return part.select("p_partkey", snapshots.file_safe(name).alias("ARQUIVO"))


@query("""
WITH book AS (SELECT o_orderkey AS "ID", o_totalprice AS "VALOR", o_orderstatus AS "FASE", date_trunc('month', o_orderdate)::DATE AS "MES_FECH"
  FROM orders WHERE o_orderdate IS NOT NULL
), corrected AS (SELECT * FROM book WHERE "MES_FECH" BETWEEN DATE '1997-03-01' AND DATE '1997-08-01' AND "ID" % 3 = 0)
SELECT "ID", CASE WHEN "ID" IN (SELECT "ID" FROM corrected) THEN "VALOR" * 2 ELSE "VALOR" END AS "VALOR", "FASE", "MES_FECH" FROM book
UNION ALL SELECT -"ID", "VALOR", 'N', "MES_FECH" FROM corrected""")
def merged_history(spark, folder):
    """A history by month, into which corrected and new rows of some months are merged."""
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("MES_FECH")
    orders = table(spark, folder, "orders").where("o_orderdate is not null")
    book = orders.select(F.col("o_orderkey").alias("ID"), F.col("o_totalprice").alias("VALOR"), F.col("o_orderstatus").alias("FASE"), month)
    path = merges.shared_folder(spark)
    snapshots.write_period(book, path)
    some = book.where("MES_FECH BETWEEN DATE'1997-03-01' AND DATE'1997-08-01' AND ID % 3 = 0")
    corrected = some.select("ID", (F.col("VALOR") * 2).alias("VALOR"), F.lit(None).cast("string").alias("FASE"), "MES_FECH")
    added = some.select((-F.col("ID")).alias("ID"), "VALOR", F.lit("N").alias("FASE"), "MES_FECH")
    merges.merge_periods(corrected.union(added), path, ["ID"])
    return snapshots.read_snapshots(spark, path)


_DRIFT_SQL = """
WITH rows_ AS (SELECT *, date_trunc('month', o_orderdate)::DATE AS "MES_FECH" FROM orders WHERE o_orderdate IS NOT NULL),
kind AS (SELECT *, CASE WHEN "MES_FECH" < DATE '1996-01-01' OR "MES_FECH" = DATE '1997-05-01' THEN 1 WHEN "MES_FECH" < DATE '1997-01-01' THEN 2 ELSE 3 END AS k
  FROM rows_)"""


def _drifting(spark, folder):
    """A history whose months came in three shapes, one of its months again in the first shape."""
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("MES_FECH")
    rows = table(spark, folder, "orders").where("o_orderdate is not null").select("*", month)
    again, second, third = "MES_FECH = DATE'1997-05-01'", "MES_FECH >= DATE'1996-01-01'", "MES_FECH >= DATE'1997-01-01'"
    key, note = F.col("o_orderkey"), F.col("o_orderpriority").alias("NOTA")
    path = merges.shared_folder(spark)
    first = [key.alias("ID"), F.col("o_custkey").cast("int").alias("CLIENTE"), "MES_FECH"]
    contracts.write_drifting(rows.where(f"NOT {second}").select(*first), path)
    contracts.write_drifting(rows.where(f"{second} AND NOT {third}").select("MES_FECH", note, F.col("o_custkey").cast("bigint").alias("Cliente"), key.alias("id")), path)
    named = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    contracts.write_drifting(rows.where(third).select(key.alias("ID"), named.alias("CLIENTE"), note, "MES_FECH"), path)
    contracts.write_drifting(rows.where(again).select(*first), path)
    return path


@query(_DRIFT_SQL + """
SELECT o_orderkey AS "ID", CASE WHEN k = 3 THEN 'C' ELSE '' END || o_custkey AS "CLIENTE", "MES_FECH", CASE WHEN k > 1 THEN o_orderpriority END AS "NOTA" FROM kind""")
def drifted_history(spark, folder):
    """Months with different columns and types, read in the widest without merging the schemas of files."""
    return contracts.read_drifting(spark, _drifting(spark, folder))


@query(_DRIFT_SQL + """
SELECT 'CLIENTE' AS "COLUNA", CASE k WHEN 1 THEN 'int' ELSE 'bigint' END AS "TIPO", 'string' AS "TIPO_LIDO", "MES_FECH"::VARCHAR AS "PERIODO"
FROM kind WHERE k < 3 GROUP BY k, "MES_FECH"
UNION ALL SELECT 'NOTA', NULL, 'string', "MES_FECH"::VARCHAR FROM kind WHERE k = 1 GROUP BY "MES_FECH" """)
def drift_report(spark, folder):
    """Which months have a column in another type than it is read in, or not at all."""
    return contracts.widened(spark, _drifting(spark, folder))


@query("""
WITH book AS (SELECT o_orderpriority AS "PRIORIDADE", o_orderstatus AS "FASE", date_trunc('month', o_orderdate)::DATE AS "MES_FECH",
  CASE WHEN date_trunc('month', o_orderdate)::DATE IN (DATE '1998-02-01', DATE '1998-07-01') THEN o_totalprice * 2 ELSE o_totalprice END AS "VALOR" FROM orders WHERE o_orderdate IS NOT NULL)
SELECT "PRIORIDADE", count(*) AS "QTD", round(sum("VALOR"), 2) AS "SOMA", round(avg("VALOR"), 2) AS "MEDIA", min("VALOR") AS "MENOR", max("VALOR") AS "MAIOR"
FROM book WHERE "MES_FECH" >= DATE '1996-01-01' GROUP BY 1""")
def stored_totals(spark, folder):
    """Totals from stored parts of months, two of which were corrected and read again."""
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("MES_FECH")
    orders = table(spark, folder, "orders").where("o_orderdate is not null")
    book = orders.select(F.col("o_orderkey").alias("ID"), F.col("o_orderpriority").alias("PRIORIDADE"), F.col("o_orderstatus").alias("FASE"), F.col("o_totalprice").alias("VALOR"), month)
    history, stored = merges.shared_folder(spark), merges.shared_folder(spark)
    measures = {
        "QTD": rollups.number_of_rows(),
        "SOMA": rollups.total("VALOR"),
        "MEDIA": rollups.average("VALOR"),
        "MENOR": rollups.smallest("VALOR"),
        "MAIOR": rollups.largest("VALOR"),
    }
    snapshots.write_period(book, history)
    rollups.refresh(snapshots.read_table(spark, history), stored, ["PRIORIDADE", "FASE"], measures)
    months = ["1998-02-01", "1998-07-01"]
    corrected = book.where(F.col("MES_FECH").isin(*[F.lit(m).cast("date") for m in months])).withColumn("VALOR", F.col("VALOR") * 2)
    merges.merge_periods(corrected, history, ["ID"])
    rollups.refresh(snapshots.read_table(spark, history), stored, ["PRIORIDADE", "FASE"], measures, months)
    return rounded(rollups.totals(spark, stored, ["PRIORIDADE"], measures, start="1996-01-01"), "SOMA", "MEDIA")
