"""Value and name cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, rounded, table
from closeworks.functions import dates, text
from closeworks.functions.fixed_values import NO_INFO
from closeworks.operators import cleaning, schema

# ---- text ---------------------------------------------------------------------


@query("SELECT c_custkey, regexp_replace(c_name, '[#0]+', '-', 'g') AS c_name FROM customer")
def char_replace(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return cleaning.replace_chars(customer, ["c_name"], "[#0]+", "-")


@query(r"""
SELECT doc_id, md5(regexp_replace(trim(text), '\s+', ' ', 'g')) AS digest,
       length(regexp_replace(trim(text), '\s+', ' ', 'g'))::INTEGER AS size
FROM documents""")
def compress_text(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    squeezed = cleaning.compress_values(documents, ["text"])
    return squeezed.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("size"))


@query("""
SELECT doc_id, md5(translate(text, 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäéèêëíìîïóòôõöúùûüçñ', 'AAAAAEEEEIIIIOOOOOUUUUCNaaaaaeeeeiiiiooooouuuucn')) AS digest
FROM documents""")
def plain_text(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", F.md5(text.strip_accents(F.col("text"))).alias("digest"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 3 <> 0 THEN o_orderstatus END AS status,
       CASE WHEN o_orderkey % 5 > 1 THEN o_orderpriority END AS priority
FROM orders""")
def null_tokens(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    raw = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "nan")
        .when(key % 3 == 0, "None")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
        F.when(key % 5 == 0, "").when(key % 5 == 1, "NaT").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return cleaning.null_text(raw)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey ELSE 0 END AS customer
FROM orders""")
def coerce_ids(spark, folder):
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, "sem id")
        .when(key % 7 == 1, F.concat(F.lit(" "), customer, F.lit("_x000D_")))
        .when(key % 7 == 2, F.concat(customer, F.lit(".0")))
        .otherwise(customer)
        .alias("customer"),
    )
    return cleaning.coerce_ids(raw, ["customer"], fill_zero=True)


@query("""
SELECT c_custkey, lpad(c_custkey::VARCHAR, 11, '0') AS tax_id,
       substr(lpad(c_custkey::VARCHAR, 11, '0'), 1, 3) || '.' || substr(lpad(c_custkey::VARCHAR, 11, '0'), 4, 3) || '.'
       || substr(lpad(c_custkey::VARCHAR, 11, '0'), 7, 3) || '-' || substr(lpad(c_custkey::VARCHAR, 11, '0'), 10, 2) AS masked,
       c_custkey AS as_number, lpad(c_custkey::VARCHAR, 8, '0') AS registration
FROM customer""")
def tax_id_mask(spark, folder):
    raw = F.col("c_custkey").cast("string")
    spaced = F.concat(F.lit(" "), F.substring(raw, 1, 2), F.lit(" "), F.substring(raw, 3, 20))
    customer = table(spark, folder, "customer").select(
        "c_custkey", text.normalize_tax_id(F.concat(F.lit("."), raw, F.lit("-"))).alias("tax_id"), spaced.alias("spaced")
    )
    masked = text.mask_tax_id(F.col("tax_id"))
    return customer.select(
        "c_custkey",
        "tax_id",
        masked.alias("masked"),
        text.tax_id_number(masked).alias("as_number"),
        text.normalize_registration(F.col("spaced")).alias("registration"),
    )


@query("""
SELECT p_partkey, CASE upper(p_type) WHEN 'PROMO' THEN 'PROMOÇÃO' WHEN 'SMALL' THEN 'PEQUENO' ELSE upper(p_type) END AS p_type
FROM part""")
def value_replace(spark, folder):
    part = table(spark, folder, "part")
    kind = text.replace_values(F.lower("p_type"), {"PROMO": "PROMOÇÃO", "SMALL": "PEQUENO"})
    return part.select("p_partkey", kind.alias("p_type"))


@query("""
SELECT p_partkey, CASE WHEN p_name LIKE '% bolt' THEN substr(p_name, 1, length(p_name) - 5) ELSE p_name END AS p_name
FROM part""")
def strip_suffix(spark, folder):
    part = table(spark, folder, "part")
    return part.select("p_partkey", text.strip_suffix(F.col("p_name"), " bolt").alias("p_name"))


@query("SELECT c_custkey, replace(c_name, 'Customer#', '') AS c_name FROM customer")
def strip_prefix(spark, folder):
    customer = table(spark, folder, "customer")
    return customer.select("c_custkey", text.strip_prefix(F.col("c_name"), "Customer#").alias("c_name"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 4 = 1 THEN substr(o_orderpriority, 3, 4)
       ELSE o_orderstatus END AS branch
FROM orders""")
def branch_code(spark, folder):
    key = F.col("o_orderkey") % 4
    branch = F.when(key == 0, "").when(key > 1, F.col("o_orderstatus"))
    return table(spark, folder, "orders").select(
        "o_orderkey", text.branch_code(branch, F.col("o_orderpriority")).alias("branch")
    )


@query("""
SELECT c_custkey, coalesce(o_orderpriority, c_mktsegment) AS either,
       coalesce(nullif(o_orderstatus, ''), 'nenhum') AS filled, coalesce(o_orderstatus, 'Sem info') AS labelled,
       CASE WHEN o_orderstatus IS NULL THEN 0 ELSE 1 END AS has_text
FROM customer LEFT JOIN orders ON c_custkey * 11 = o_orderkey""")
def first_non_null(spark, folder):
    customer = table(spark, folder, "customer").withColumn("order", F.col("c_custkey") * 11)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    joined = customer.join(orders, F.col("order") == F.col("o_orderkey"), "left")
    status = F.col("o_orderstatus")
    return joined.select(
        "c_custkey",
        F.coalesce("o_orderpriority", "c_mktsegment").alias("either"),
        text.first_filled(status, F.lit("nenhum")).alias("filled"),
        text.label_or(status, "Sem info").alias("labelled"),
        text.text_flag(status).alias("has_text"),
    )


@query("""
SELECT c_custkey, coalesce(n_name, 'Sem info') AS country FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2""")
def default_label(spark, folder):
    nation = table(spark, folder, "nation").filter("n_regionkey <> 2").select("n_nationkey", "n_name")
    joined = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", text.label_or(F.col("n_name"), NO_INFO).alias("country"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR text = '' OR text IS NULL THEN 0 ELSE 1 END AS has_text FROM documents""")
def text_flag(spark, folder):
    written = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    return table(spark, folder, "documents").select("doc_id", text.text_flag(written).alias("has_text"))


@query("""
SELECT lang, count(*) AS n, count(*) FILTER (text ILIKE '%LICENSE%') AS licensed
FROM documents GROUP BY 1""")
def text_contains(spark, folder):
    documents = table(spark, folder, "documents")
    hit = text.contains_word(F.col("text"), "license")
    return documents.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("licensed"))


# ---- numbers ------------------------------------------------------------------


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS price FROM part""")
def to_number(spark, folder):
    raw = F.when(F.col("p_size") % 5 == 0, "n/d").otherwise(F.col("p_retailprice").cast("string"))
    part = table(spark, folder, "part").select("p_partkey", raw.alias("price"))
    return cleaning.to_number(part, ["price"])


@query("""
SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_tax <> 0 THEN l_tax END) AS n_tax,
       round(sum(CASE WHEN l_tax <> 0 THEN l_tax END), 2) AS tax
FROM lineitem GROUP BY 1""")
def nan_to_null(spark, folder):
    tax = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    items = table(spark, folder, "lineitem").select("l_returnflag", tax.alias("l_tax"))
    sums = cleaning.nan_to_null(items).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("n_tax"), F.sum("l_tax").alias("tax")
    )
    return rounded(sums, "tax")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE 0 END AS value,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '-' END AS status
FROM orders""")
def fill_defaults(spark, folder):
    key = F.col("o_orderkey")
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(key % 2 == 0, F.col("o_totalprice")).alias("value"),
        F.when(key % 3 == 0, F.col("o_orderstatus")).alias("status"),
    )
    return cleaning.fill_defaults(raw, {"value": 0.0, "status": "-"})


@query("""
SELECT o_orderkey, translate(format('{:,.2f}', o_totalprice), ',.', '.,') AS written, o_totalprice AS value,
       -o_totalprice AS negative, o_totalprice AS plain, 0.0::DOUBLE AS dash
FROM orders""")
def brl_roundtrip(spark, folder):
    price = F.col("o_totalprice")
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        text.format_brl(price).alias("written"),
        F.concat(F.lit("R$ "), text.format_brl(price)).alias("value"),
        F.concat(F.lit("-"), text.format_brl(price)).alias("negative"),
        price.alias("plain"),
        F.lit("-").alias("dash"),
    )
    return cleaning.parse_money(raw, ["value", "negative", "plain", "dash"])


# ---- dates --------------------------------------------------------------------

_LAYOUTS = """
SELECT o_orderkey, CASE o_orderkey % 6
         WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%y')
         WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%y') WHEN 3 THEN strftime(o_orderdate, '%-d/%-m/%Y')
         WHEN 4 THEN strftime(o_orderdate, '%d/%m%Y') ELSE NULL END AS written
FROM orders"""


def _written_dates(spark, folder):
    key, day = F.col("o_orderkey") % 6, F.to_date("o_orderdate")
    written = (
        F.when(key == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(key == 1, F.date_format(day, "MM/dd/yy"))
        .when(key == 2, F.date_format(day, "M/d/yy"))
        .when(key == 3, F.date_format(day, "d/M/yyyy"))
        .when(key == 4, F.date_format(day, "dd/MMyyyy"))
    )
    return table(spark, folder, "orders").select("o_orderkey", written.alias("written"))


@query(f"""
WITH w AS ({_LAYOUTS})
SELECT o_orderkey,
  CASE WHEN length(written) = 10 THEN try_strptime(written, '%d/%m/%Y')
       WHEN length(written) BETWEEN 6 AND 8 THEN
         CASE WHEN regexp_matches(written, '^\\d+/\\d+/\\d\\d$') THEN try_strptime(written, '%m/%d/%y')
              WHEN regexp_matches(written, '^\\d+/\\d+/\\d\\d\\d\\d$') THEN try_strptime(written, '%m/%d/%Y') END
       WHEN regexp_matches(written, '^\\d+/\\d+/\\d\\d\\d\\d$') THEN try_strptime(written, '%d/%m/%Y') END::DATE AS day,
  CASE WHEN length(written) = 10 THEN try_strptime(written, '%d/%m/%Y')
       WHEN regexp_matches(written, '^\\d+/\\d+/\\d\\d$') THEN try_strptime(written, '%d/%m/%y')
       WHEN regexp_matches(written, '^\\d+/\\d+/\\d\\d\\d\\d$') THEN try_strptime(written, '%d/%m/%Y') END::DATE AS day_first
FROM w""")
def mixed_dates(spark, folder):
    written = _written_dates(spark, folder)
    column = F.col("written")
    return written.select(
        "o_orderkey",
        dates.parse_mixed_date(column).alias("day"),
        dates.parse_short_date(column, "dmy").alias("day_first"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate::DATE END AS day,
       CASE WHEN o_orderkey % 4 <> 3 THEN o_totalprice END AS value,
       CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey END AS customer, NULL::INTEGER AS extra
FROM orders""")
def coerce_dates(spark, folder):
    key, day = F.col("o_orderkey") % 4, F.to_date("o_orderdate")
    written = (
        F.when(key == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(key == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(key == 2, F.date_format(day, "dd.MM.yyyy"))
        .otherwise("31/02/1999")
    )
    unless_broken = lambda c: F.when(key == 3, "x").otherwise(F.col(c).cast("string"))
    raw = table(spark, folder, "orders").select(
        "o_orderkey", written.alias("day"), unless_broken("o_totalprice").alias("value"),
        unless_broken("o_custkey").alias("customer"), "o_orderstatus",
    )
    coerced = cleaning.coerce_dates(raw, ["day"])
    return schema.conform(coerced, "o_orderkey bigint, day date, value double, customer bigint, extra int")


@query("""
SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS INTEGER) AS level,
       try_cast(o_orderstatus AS DOUBLE) AS status, o_orderdate::DATE AS day
FROM orders""")
def explicit_casts(spark, folder):
    raw = table(spark, folder, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("day"),
    )
    return cleaning.cast_columns(raw, {"level": "int", "status": "double", "day": "date"})


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_trunc('month', l_shipdate)::DATE AS month,
  (l_shipdate::DATE - o_orderdate::DATE)::INTEGER AS days,
  CASE WHEN l_shipdate >= o_orderdate THEN
    (year(l_shipdate) * 12 + month(l_shipdate)) - (year(o_orderdate) * 12 + month(o_orderdate))
      - CASE WHEN day(l_shipdate) < day(o_orderdate) THEN 1 ELSE 0 END
  ELSE -((year(o_orderdate) * 12 + month(o_orderdate)) - (year(l_shipdate) * 12 + month(l_shipdate))
      - CASE WHEN day(o_orderdate) < day(l_shipdate) THEN 1 ELSE 0 END) END::BIGINT AS months
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_distances(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    items = table(spark, folder, "lineitem")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped, ordered = F.to_date("l_shipdate"), F.col("ordered")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.month_start(shipped).alias("month"),
        dates.days_between(ordered, shipped).alias("days"),
        dates.whole_months(ordered, shipped).alias("months"),
    )


@query("""
WITH c AS (
  SELECT c_custkey, min(o_orderdate)::DATE AS hired, CASE WHEN c_custkey % 3 <> 0 THEN max(o_orderdate)::DATE END AS left_on,
         max(o_orderdate)::DATE + 40 AS filed
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1),
p AS (
  SELECT *, CASE WHEN filed - 1800 >= hired THEN (filed - 1800)::DATE ELSE hired END AS claim_start,
         coalesce(left_on, filed)::DATE AS claim_end,
         (year(left_on) * 12 + month(left_on)) - (year(hired) * 12 + month(hired))
           - CASE WHEN day(left_on) < day(hired) THEN 1 ELSE 0 END AS months
  FROM c)
SELECT c_custkey, claim_start, claim_end,
       strftime(claim_start, '%m-%Y') || ' a ' || strftime(claim_end, '%m-%Y') AS label,
       CASE WHEN left_on IS NULL THEN 'Sem info' WHEN months <= 60 THEN year(left_on)::VARCHAR
            ELSE (year(left_on) - 5)::VARCHAR END AS vintage
FROM p""")
def claim_period(spark, folder):
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("hired"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    people = table(spark, folder, "customer").select("c_custkey").join(orders, "c_custkey")
    people = people.select(
        "c_custkey", "hired",
        F.when(F.col("c_custkey") % 3 != 0, F.col("last")).alias("left"),
        F.date_add("last", 40).alias("filed"),
    )
    people = people.withColumns(
        {
            "claim_start": dates.claim_start(F.col("filed"), F.col("hired")),
            "claim_end": dates.claim_end(F.col("filed"), F.col("left")),
        }
    )
    return people.select(
        "c_custkey", "claim_start", "claim_end",
        dates.claim_label(F.col("claim_start"), F.col("claim_end")).alias("label"),
        dates.claim_vintage(F.col("left"), dates.whole_months(F.col("hired"), F.col("left"))).alias("vintage"),
    )


@query("""
WITH c AS (SELECT c_custkey, o_orderdate::DATE AS hired, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderdate::DATE + (o_orderkey % 3000)::INTEGER)::DATE END AS left_on,
             o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey)
SELECT o_orderkey, CASE WHEN left_on IS NULL THEN 'Sem info'
    WHEN (year(left_on) * 12 + month(left_on)) - (year(hired) * 12 + month(hired)) - CASE WHEN day(left_on) < day(hired) THEN 1 ELSE 0 END <= 60
    THEN year(left_on)::VARCHAR ELSE (year(left_on) - 5)::VARCHAR END AS vintage
FROM c""")
def claim_vintage(spark, folder):
    key, hired = F.col("o_orderkey"), F.to_date("o_orderdate")
    dismissed = F.when(key % 4 != 0, F.date_add(hired, (key % 3000).cast("int")))
    vintage = dates.claim_vintage(dismissed, dates.whole_months(hired, dismissed))
    return table(spark, folder, "orders").select("o_orderkey", vintage.alias("vintage"))


# ---- names --------------------------------------------------------------------


@query("""
SELECT c_custkey AS "CODIGO_CLIENTE", c_name AS "NOME_RAZAO_SOCIAL", c_acctbal AS "SALDO_R$",
       c_mktsegment AS "SEGMENTO_AREA"
FROM customer""")
def clean_columns(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("  código - (cliente)"),
        F.col("c_name").alias("Nome/Razão  Social"),
        F.col("c_acctbal").alias("saldo; R$"),
        F.col("c_mktsegment").alias("Segmento|área?"),
    )
    compressed = schema.compress_column_names(customer)
    return schema.adjust_column_names(schema.strip_accents_columns(compressed))


@query("""
SELECT s_suppkey AS "ID", s_name AS "ID_1", s_nationkey AS "DATA_DE_BAIXA", s_acctbal AS "DATA_DE_BAIXA_1"
FROM supplier""")
def dedupe_columns(spark, folder):
    supplier = table(spark, folder, "supplier").toDF("Id.", "(Id)", "Data de baixa", "Data-de-baixa")
    return schema.dedupe_columns_suffix(schema.snake_columns(supplier, upper=True))


@query('SELECT s_suppkey AS "ID", s_nationkey AS "PAIS" FROM supplier')
def first_columns(spark, folder):
    supplier = table(spark, folder, "supplier").toDF("ID", "ID", "PAIS", "PAIS")
    return schema.dedupe_columns_first(supplier)
