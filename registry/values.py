"""Scalar expressions over whole columns: codes and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import query, table
from snapmart.functions import codes, dates
from snapmart.operators.aggregate import AGE_BANDS, banded

# ---- codes ---------------------------------------------------------------------


@query("code_normalise", """
SELECT c_custkey, regexp_replace(trim('  ' || CAST(c_custkey AS VARCHAR) || '.0 '), '\\.0$', '') AS code,
  regexp_replace(trim(CAST(c_acctbal AS VARCHAR)), '\\.0$', '') AS balance FROM customer""")
def code_normalise(spark, d):
    text = F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(".0 "))
    return table(spark, d, "customer").select(
        "c_custkey", codes.normalise_code(text).alias("code"), codes.normalise_code("c_acctbal").alias("balance")
    )


@query("code_pad", """
SELECT o_orderkey, CASE WHEN length(k) < 4 THEN lpad(k, 4, '0') ELSE k END AS padded, o_orderpriority AS other
FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS k FROM orders)""")
def code_pad(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", codes.pad_code("o_orderkey", 4).alias("padded"), codes.pad_code("o_orderpriority", 30).alias("other")
    )


@query("code_strip", """
SELECT c_custkey, coalesce(nullif(ltrim(replace(c_name, 'Customer#', ''), '0'), ''), '0') AS bare FROM customer""")
def code_strip(spark, d):
    digits = F.replace(F.col("c_name"), F.lit("Customer#"), F.lit(""))
    return table(spark, d, "customer").select("c_custkey", codes.strip_zeros(digits).alias("bare"))


@query("code_digits", """
SELECT s_suppkey, CASE WHEN length(g) < 12 THEN lpad(g, 12, '0') ELSE g END AS digits,
  CASE WHEN length(b) < 6 THEN lpad(b, 6, '0') ELSE b END AS balance
FROM (SELECT s_suppkey, nullif(regexp_replace(s_name, '[^0-9]+', '', 'g'), '') AS g,
  nullif(regexp_replace(regexp_replace(CAST(s_acctbal AS VARCHAR), '\\.0$', ''), '[^0-9]+', '', 'g'), '') AS b FROM supplier)""")
def code_digits(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey", codes.digits_code("s_name", 12).alias("digits"), codes.digits_code("s_acctbal", 6).alias("balance")
    )


@query("code_join", """
SELECT p_partkey, nullif(concat_ws('- ', c, t), '') AS joined
FROM (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_brand END AS c, CASE WHEN p_type <> 'PROMO' THEN p_type END AS t FROM part)""")
def code_join(spark, d):
    code = F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise(" NaN ")
    text = F.when(F.col("p_type") != "PROMO", F.col("p_type")).otherwise("")
    return table(spark, d, "part").select("p_partkey", codes.join_code_text(code, text, "- ").alias("joined"))


@query("catalog_code", """
SELECT doc_id, replace(upper(trim(source || '.' || lang)), '.', '') AS code FROM documents""")
def catalog_code(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", codes.catalog_code(F.concat_ws(".", "source", "lang")).alias("code")
    )


@query("header_slug", """
SELECT conv_id, turn, trim(regexp_replace(lower(regexp_replace(strip_accents(trim(text)), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM conversations""")
def header_slug(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", codes.slug("text").alias("slug"))


@query("yes_flag", """
SELECT l_linestatus, l_returnflag, count(*) AS n, sum(CASE WHEN f THEN 1 ELSE 0 END)::BIGINT AS yes
FROM (SELECT *, l_returnflag = 'R' AND l_linestatus = 'O' AS f FROM lineitem) GROUP BY ALL""")
def yes_flag(spark, d):
    flag = F.when(F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "O", " sim").otherwise("nao"))
    rows = table(spark, d, "lineitem").withColumn("flag", flag)
    return rows.groupBy("l_linestatus", "l_returnflag").agg(
        F.count("*").alias("n"), F.count_if(codes.is_yes("flag")).alias("yes")
    )


@query("prefix_exclude", """
SELECT p_brand, count(*) AS n FROM (SELECT CASE WHEN p_size > 5 THEN p_brand END AS p_brand FROM part)
WHERE p_brand IS NULL OR NOT regexp_matches(p_brand, '^(Brand#1|Brand#3)') GROUP BY 1""")
def prefix_exclude(spark, d):
    brand = F.when(F.col("p_size") > 5, F.col("p_brand")).alias("p_brand")
    rows = table(spark, d, "part").select(brand)
    kept = rows.where(~codes.starts_with_any("p_brand", ["Brand#1", "Brand#3"]))
    return kept.groupBy("p_brand").agg(F.count("*").alias("n"))


@query("placeholder_filter", """
SELECT doc_id, v FROM (SELECT doc_id, CASE WHEN lang = 'fr' THEN NULL WHEN lang = 'de' THEN '0'
  WHEN source = 'src1' THEN 'NaN' ELSE source END AS v FROM documents)
WHERE v IS NOT NULL AND v NOT IN ('','None','nan','NaN','0','00','NoneType','<NA>')""")
def placeholder_filter(spark, d):
    v = (
        F.when(F.col("lang") == "fr", F.lit(None))
        .when(F.col("lang") == "de", " 0.0 ")
        .when(F.col("source") == "src1", "NaN")
        .otherwise(F.col("source"))
    )
    rows = table(spark, d, "documents").select("doc_id", v.alias("v"))
    return rows.where(~codes.is_placeholder("v"))


@query("null_defaults", """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'Não Indígena' WHEN lang = 'es' THEN 'Não Declarada' ELSE lang END AS v FROM documents""")
def null_defaults(spark, d):
    v = F.when(F.col("lang") == "en", " 0000").when(F.col("lang") != "es", F.col("lang"))
    return table(spark, d, "documents").select(
        "doc_id", codes.replace_sentinel(v, "0000", "Não Indígena", "Não Declarada").alias("v")
    )


@query("number_coercion", """
SELECT l_returnflag, l_linestatus, count(v) AS valid, count(*) - count(v) AS invalid,
  CAST(sum(CAST(round_even(v / 8, 1) AS DECIMAL(28,1))) AS DOUBLE) AS eighths
FROM (SELECT *, CASE WHEN l_linenumber <= 3 THEN l_quantity END AS v FROM lineitem) GROUP BY ALL""")
def number_coercion(spark, d):
    text = F.when(F.col("l_linenumber") <= 3, F.col("l_quantity").cast("string")).otherwise("n/a")
    rows = table(spark, d, "lineitem").withColumn("v", codes.to_number(text))
    eighth = codes.to_amount(F.col("v") / 8).cast("decimal(28,1)")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("v").alias("valid"),
        (F.count("*") - F.count("v")).alias("invalid"),
        F.sum(eighth).cast("double").alias("eighths"),
    )


BANDS = "CASE WHEN v BETWEEN 0 AND 17 THEN '0-17' WHEN v BETWEEN 18 AND 29 THEN '18-29' WHEN v BETWEEN 30 AND 44 THEN '30-44' WHEN v BETWEEN 45 AND 59 THEN '45-59' WHEN v BETWEEN 60 AND 74 THEN '60-74' WHEN v >= 75 THEN '75+' END"


@query("age_bands", f"SELECT {BANDS} AS band, count(*) AS n FROM (SELECT c_acctbal / 100 AS v FROM customer) GROUP BY 1")
def age_bands(spark, d):
    band = banded(F.col("c_acctbal") / 100, AGE_BANDS).alias("band")
    return table(spark, d, "customer").groupBy(band).agg(F.count("*").alias("n"))


# ---- dates ---------------------------------------------------------------------


@query("period_parse", """
SELECT o_orderkey, CASE WHEN o_orderpriority < '4' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS parsed
FROM orders""")
def period_parse(spark, d):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") < "3", F.date_format(day, "yyyyMM"))
        .when(F.col("o_orderpriority") < "4", F.date_format(day, "MMyyyy"))
        .when(F.col("o_orderpriority") < "5", F.date_format(day, "yyyy'13'"))
        .otherwise("none")
    )
    return table(spark, d, "orders").select("o_orderkey", dates.parse_period(text).alias("parsed"))


@query("day_parse", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 4 THEN CAST(l_shipdate AS DATE) END AS day, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
FROM lineitem""")
def day_parse(spark, d):
    ymd = F.date_format("l_shipdate", "yyyyMMdd")
    text = F.when(F.col("l_linenumber") < 4, ymd).otherwise(F.concat(ymd, F.lit("9")))
    parts = dates.year_month_date(F.year("l_shipdate"), F.month("l_shipdate"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", dates.parse_ymd(text).alias("day"), parts.alias("month")
    )


@query("calendar_attrs", f"""
SELECT o_orderkey, strftime(d, '%m') AS month, strftime(d, '%Y') AS year,
  CAST(dayofyear(d) AS VARCHAR) AS day_of_year, CAST(day(d) AS VARCHAR) AS day_of_month,
  CAST((day(d) - 1) // 7 + 1 AS VARCHAR) AS week_of_month, CAST(weekofyear(d) AS VARCHAR) AS week_of_year,
  (['Segunda-feira', 'Terça-feira', 'Quarta-feira', 'Quinta-feira', 'Sexta-feira', 'Sábado', 'Domingo'])[isodow(d)] AS weekday_name, (['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro', 'Dezembro'])[month(d)] AS month_name,
  CAST((month(d) - 1) // 2 + 1 AS VARCHAR) AS two_month, CAST(quarter(d) AS VARCHAR) AS quarter,
  CAST((month(d) - 1) // 6 + 1 AS VARCHAR) AS half_year
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def calendar_attrs(spark, d):
    cols = dates.calendar_columns(F.col("o_orderdate").cast("date"))
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in cols.items()])


@query("period_window", """
WITH last AS (SELECT date_trunc('month', max(o_orderdate)) AS m FROM orders)
SELECT strftime(m - INTERVAL 1 MONTH * k, '%Y%m') AS period,
  (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m - INTERVAL 1 MONTH * k) AS n
FROM last, (SELECT unnest(range(1, 13)) AS k)""")
def period_window(spark, d):
    """Orders in each of the 12 whole months before the latest one."""
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    latest = orders.agg(F.max("day")).first()[0]
    periods = dates.last_complete_periods(latest, 12)
    first, last = dates.parse_month(f"{periods[0][:4]}-{periods[0][4:]}"), dates.shift_months(latest, -1)
    kept = orders.where(dates.month_range("day", first, last))
    return kept.groupBy(dates.period_key("day").alias("period")).agg(F.count("*").alias("n"))


@query("bounded_dates", """
SELECT year(o_orderdate) AS y, count(*) AS n, count(CASE WHEN o_orderdate BETWEEN '1997-01-01' AND '1999-12-31' THEN 1 END) AS kept,
  count(CASE WHEN NOT (o_orderdate BETWEEN '1997-01-01' AND '1999-12-31') THEN 1 END) AS outliers
FROM orders GROUP BY 1""")
def bounded_dates(spark, d):
    lo, hi = dates.parse_month("1997-01"), dates.parse_month("1999-12").replace(day=31)
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").groupBy(F.year(day).cast("bigint").alias("y")).agg(
        F.count("*").alias("n"),
        F.count(dates.bounded(day, lo, hi)).alias("kept"),
        F.count_if(dates.is_outlier(day, lo, hi)).alias("outliers"),
    )


@query("snapshot_key", """
SELECT strftime(CASE WHEN l_quantity > 1 THEN l_shipdate ELSE TIMESTAMP '1999-09-01' END, '%Y%m') || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS key,
  count(*) AS n FROM lineitem GROUP BY 1""")
def snapshot_key(spark, d):
    day = F.when(F.col("l_quantity") > 1, F.col("l_shipdate"))
    key = dates.snapshot_key(day, "l_suppkey", fallback=F.lit("199909"))
    rows = table(spark, d, "lineitem").select(key.alias("key"))
    # The key leads back to its period.
    return rows.where(dates.is_period(dates.key_period("key"))).groupBy("key").agg(F.count("*").alias("n"))


@query("year_to_date", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
WHERE o_orderdate >= date_trunc('year', (SELECT max(o_orderdate) FROM orders)) GROUP BY 1""")
def year_to_date(spark, d):
    orders = table(spark, d, "orders")
    latest = orders.agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]
    rows = orders.where(dates.day_range("o_orderdate", *dates.year_to_date(latest)))
    return rows.groupBy(dates.month_label("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
