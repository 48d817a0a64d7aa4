"""Queries for the scalar functions f01-f35."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions import metrics as M
from rankflow.functions import numbers as N
from rankflow.functions import text as X
from rankflow.plans import driver as D
from rankflow.plans.q_relational import sql_keyword_tokens, sql_round2
from rankflow.plans.registry import query


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.table(spark, sf, name)


# -- tokenizers (f01-f13) ----------------------------------------------------------

@query("f01_split_space", "SELECT p_partkey, string_split(concat(p_name, '  ', p_type), ' ') AS tokens FROM part")
def f01(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", X.split_space(F.concat("p_name", F.lit("  "), "p_type")).alias("tokens"))


_F02_NAME = "concat(p_name, ' ', p_brand, ' ', lower(p_type), ' X', CAST(p_size AS VARCHAR), ' ', CAST(p_size AS VARCHAR))"


def _f02_name() -> F.Column:
    return F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), F.lower("p_type"), F.lit(" X"),
                    F.col("p_size").cast("string"), F.lit(" "), F.col("p_size").cast("string"))


@query("f02_keyword_tokens", f"SELECT p_partkey, {sql_keyword_tokens(_F02_NAME)} AS keywords FROM part")
def f02(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", X.keyword_tokens(_f02_name()).alias("keywords"))


_F03_ARR = "string_split(concat(p_name, '| |', p_type, ' a[b|c]d'), ' ')"


@query("f03_strip_symbols", f"""
SELECT p_partkey, list_filter(list_transform({_F03_ARR}, lambda x: trim(regexp_replace(x, '[\\|]', '', 'g'))),
                              lambda x: trim(x) <> '') AS tokens FROM part""")
def f03(spark, sf):
    arr = F.split(F.concat("p_name", F.lit("| |"), "p_type", F.lit(" a[b|c]d")), " ")
    return _t(spark, sf, "part").select("p_partkey", X.strip_symbols(arr).alias("tokens"))


_F04_ARR = "string_split(concat('[', p_brand, '] ', p_name, '-x ', lower(p_type)), ' ')"


@query("f04_split_symbols", f"""
SELECT p_partkey, list_filter(list_transform(flatten(list_transform({_F04_ARR},
           lambda x: regexp_split_to_array(x, '[^가-힣a-zA-Z0-9]'))), lambda x: trim(x)),
       lambda x: trim(x) <> '') AS tokens FROM part""")
def f04(spark, sf):
    arr = F.split(F.concat(F.lit("["), "p_brand", F.lit("] "), "p_name", F.lit("-x "), F.lower("p_type")), " ")
    return _t(spark, sf, "part").select("p_partkey", X.split_symbols(arr).alias("tokens"))


_SQL_CLEAN = "regexp_replace(lower(text), '[^a-zA-Z가-힣0-9\\s]', '', 'g')"


@query("f05_clean_name", f"SELECT doc_id, {_SQL_CLEAN} AS cleaned FROM documents")
def f05(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.clean_name("text").alias("cleaned"))


_SQL_WS_TOKENS = f"regexp_split_to_array({_SQL_CLEAN}, '\\s+')"


@query("f06_whitespace_tokens", f"SELECT doc_id, {_SQL_WS_TOKENS} AS tokens FROM documents")
def f06(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.whitespace_tokens(X.clean_name("text")).alias("tokens"))


def sql_stop_words() -> str:
    return D.sql_list(X.english_stop_words())


def _f07_sql() -> str:
    return (f"SELECT doc_id, list_filter({_SQL_WS_TOKENS}, lambda x: NOT list_contains({sql_stop_words()}, lower(x))) "
            f"AS keywords FROM documents")


@query("f07_stop_words", _f07_sql())
def f07(spark, sf):
    tokens = X.whitespace_tokens(X.clean_name("text"))
    return _t(spark, sf, "documents").select("doc_id", X.remove_stop_words(tokens).alias("keywords"))


@query("f08_array_to_text", "SELECT p_partkey, array_to_string(string_split(p_name, ' '), ',') AS text FROM part")
def f08(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", X.array_to_text(F.split("p_name", " ")).alias("text"))


@query("f09_text_to_array", "SELECT p_partkey, string_split(concat_ws(', ', p_name, p_type, p_brand), ', ') AS arr FROM part")
def f09(spark, sf):
    txt = F.concat_ws(", ", "p_name", "p_type", "p_brand")
    return _t(spark, sf, "part").select("p_partkey", X.text_to_array(txt).alias("arr"))


@query("f10_explode", """
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, string_split(p_name, ' ')[i] AS token
FROM part, range(1, len(string_split(p_name, ' ')) + 1) r(i)""")
def f10(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "token"))


@query("f11_normalise_keyword", """
SELECT p_partkey, list_transform(string_split(concat(p_brand, ' ', p_name, ' T-2'), ' '),
                                 lambda x: regexp_replace(lower(x), '[^가-힣a-zA-Z]', '', 'g')) AS tokens FROM part""")
def f11(spark, sf):
    arr = F.split(F.concat("p_brand", F.lit(" "), "p_name", F.lit(" T-2")), " ")
    return _t(spark, sf, "part").select("p_partkey", F.transform(arr, X.normalise_keyword).alias("tokens"))


@query("f12_keep_vocabulary", """
WITH words AS (SELECT unnest(string_split(p_name, ' ')) AS w FROM part),
     top AS (SELECT w FROM words GROUP BY w ORDER BY count(*) DESC, w LIMIT 5)
SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: list_contains(v.vocab, x)) AS kept
FROM part, (SELECT list(w) AS vocab FROM top) v""")
def f12(spark, sf):
    from rankflow.plans.jobs import vocabulary

    p = _t(spark, sf, "part").withColumn("words", F.split("p_name", " "))
    vocab = vocabulary(p, "words", 5)
    return X.with_vocabulary(p, "words", vocab, "kept").select("p_partkey", "kept")


@query("f13_extract_colors", f"SELECT p_partkey, {D.sql_colors('p_name')} AS colors FROM part")
def f13(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", X.extract_colors("p_name").alias("colors"))


# -- unit numbers (f14-f18) -----------------------------------------------------------

_UNIT_TEXT_SQL = """CASE p_type
  WHEN 'ECONOMY' THEN CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) || '천'
  WHEN 'LARGE' THEN CAST(p_size AS VARCHAR) || '만 회 이상'
  WHEN 'MEDIUM' THEN CAST(p_size AS VARCHAR) || ',' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')
  WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) || '백'
  WHEN 'SMALL' THEN CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) || '천만'
  ELSE CASE WHEN p_size > 25 THEN 'none' END END"""


def _unit_text() -> F.Column:
    size, k = F.col("p_size").cast("string"), F.col("p_partkey")
    return (F.when(F.col("p_type") == "ECONOMY", F.concat(size, F.lit("."), (k % 10).cast("string"), F.lit("천")))
             .when(F.col("p_type") == "LARGE", F.concat(size, F.lit("만 회 이상")))
             .when(F.col("p_type") == "MEDIUM", F.concat(size, F.lit(","), F.lpad((k % 1000).cast("string"), 3, "0")))
             .when(F.col("p_type") == "PROMO", F.concat(size, F.lit("."), (k % 10).cast("string"), F.lit("백")))
             .when(F.col("p_type") == "SMALL", F.concat(size, F.lit("."), (k % 10).cast("string"), F.lit("천만")))
             .otherwise(F.when(F.col("p_size") > 25, F.lit("none"))))


def sql_unit_number(text: str, units, remove=(",", " "), null_as=None) -> str:
    s = text
    for ch in remove:
        s = f"replace({s}, '{ch}', '')"
    digits = f"regexp_extract({s}, '\\d+(\\.\\d+)?', 0)"
    value = f"CASE WHEN {digits} <> '' THEN CAST({digits} AS DECIMAL(38,6)) END"
    for u in units:
        value = f"({value} * CASE WHEN contains({s}, '{u}') THEN {N.UNIT_FACTORS[u]} ELSE 1 END)"
    out = f"CAST(trunc({value}) AS BIGINT)"
    if null_as is not None:
        out = f"CASE WHEN {text} IS NULL THEN {null_as} ELSE {out} END"
    return out


def _unit_query(name: str, units, remove, null_as=None):
    sql = (f"SELECT p_partkey, txt, {sql_unit_number('txt', units, remove, null_as)} AS number "
           f"FROM (SELECT p_partkey, {_UNIT_TEXT_SQL} AS txt FROM part)")

    @query(name, sql)
    def build(spark, sf):
        p = _t(spark, sf, "part").select("p_partkey", _unit_text().alias("txt"))
        return p.select("p_partkey", "txt", N.parse_unit_number("txt", units, remove, null_as).alias("number"))

    return build


_unit_query("f14_unit_number", N.DETAIL_UNITS, (",", " "))
_unit_query("f15_unit_number_ranking", N.RANKING_UNITS, (" ",))
_unit_query("f16_unit_number_thousands", N.NOTEBOOK_UNITS, (" ",))
_unit_query("f17_unit_number_no_comma", N.DETAIL_UNITS, (" ",))
_unit_query("f18_unit_number_zero_null", N.DETAIL_UNITS, (",", " "), 0)


# -- label parsers (f19-f24) ---------------------------------------------------------------

_EV = "WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)\n"


def _ev(spark, sf) -> DataFrame:
    return _t(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _infos() -> F.Column:
    k = F.col("k").cast("string")
    txt = lambda c: F.struct(c.alias("text"))
    view = F.when(F.col("event_type") == "view", F.concat(k, F.lit("명이 보는 중"))) \
            .otherwise(F.concat(F.lit("1."), k, F.lit("천명이 보는 중")))
    buy = F.when(F.col("event_type") == "click", F.concat(F.lit("2"), k, F.lit("명이 구매 중")))
    return F.array(txt(view), txt(F.coalesce(buy, F.lit("광고"))))


_SQL_VIEW_N = "CASE WHEN event_type = 'view' THEN CAST(k AS BIGINT) " \
              "ELSE CAST(trunc(CAST('1.' || CAST(k AS VARCHAR) AS DECIMAL(18,6)) * 1000) AS BIGINT) END"


@query("f19_viewing_purchasing", _EV + f"""
SELECT event_id, {_SQL_VIEW_N} AS viewing,
       CASE WHEN event_type = 'click' THEN CAST('2' || CAST(k AS VARCHAR) AS BIGINT) ELSE 0 END AS purchasing
FROM e""")
def f19(spark, sf):
    e = _ev(spark, sf).withColumn("infos", _infos())
    return e.select("event_id", N.viewing_count("infos").alias("viewing"), N.buying_count("infos").alias("purchasing"))


def _sales_text() -> F.Column:
    k = F.col("k").cast("string")
    return (F.when(F.col("event_type") == "view", F.concat(F.lit("판매 "), k, F.lit("천개")))
             .when(F.col("event_type") == "click", F.concat(F.lit("판매 "), k, F.lit(".5만개")))
             .when(F.col("event_type") == "purchase", F.concat(F.lit("판매 "), k, F.lit("개"))))


@query("f20_sales_count", _EV + """
SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(k AS BIGINT) * 1000
                      WHEN event_type = 'click' THEN CAST(k AS BIGINT) * 10000 + 5000 END AS sold_count
FROM e""")
def f20(spark, sf):
    return _ev(spark, sf).select("event_id", N.sales_count(_sales_text()).alias("sold_count"))


def _labels() -> F.Column:
    txt = lambda c: F.struct(c.alias("text"))
    k = F.col("k").cast("string")
    return (F.when(F.col("event_type") == "view", F.array(txt(F.lit("급상승")), txt(F.concat(F.lit("판매 "), k, F.lit("천개")))))
             .when(F.col("event_type") == "click", F.array(txt(F.concat(F.lit("판매 "), k, F.lit("천개"))), txt(F.lit("급상승"))))
             .when(F.col("event_type") == "purchase", F.array(txt(F.lit("신상")), txt(F.lit("세일"))))
             .otherwise(F.array().cast("array<struct<text:string>>")))


@query("f21_label_flags", _EV + """
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS trending,
       CASE WHEN event_type IN ('view', 'click') THEN '판매 ' || CAST(k AS VARCHAR) || '천개'
            WHEN event_type = 'purchase' THEN '세일' END AS sales_text
FROM e""")
def f21(spark, sf):
    e = _ev(spark, sf).withColumn("labels", _labels())
    return e.select("event_id", N.trending_from_labels("labels").alias("trending"),
                    N.sales_text_from_labels("labels").alias("sales_text"))


@query("f22_json_defaults", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(0 AS BIGINT) AS missing_count,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_score,
       CAST(NULL AS DOUBLE) AS missing_score
FROM events""")
def f22(spark, sf):
    e = _t(spark, sf, "events")
    return e.select("event_id", N.int_or(F.get_json_object("props", "$.k"), None).alias("k"),
                    N.int_or(F.get_json_object("props", "$.missing"), 0).alias("missing_count"),
                    N.float_or_null(F.get_json_object("props", "$.k")).alias("k_score"),
                    N.float_or_null(F.get_json_object("props", "$.missing")).alias("missing_score"))


@query("f23_trending_flag", """
SELECT event_id, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS trending FROM events""")
def f23(spark, sf):
    e = _t(spark, sf, "events")
    text = (F.when(F.col("event_type") == "view", F.concat(F.lit("급상승 "), "event_type"))
             .when(F.col("event_type") == "error", F.lit(None).cast("string"))
             .otherwise(F.col("event_type")))
    return e.select("event_id", X.trending_flag(text).alias("trending"))


@query("f24_strip_text", """
SELECT page_id, regexp_replace(chr(10) || '  ' || regexp_extract(html, '<title>([^<]*)</title>', 1) || chr(9) || ' ',
                               '^\\s+|\\s+$', '', 'g') AS title FROM pages""")
def f24(spark, sf):
    p = _t(spark, sf, "pages")
    raw = F.concat(F.lit("\n  "), F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("\t "))
    return p.select("page_id", X.strip_text(raw).alias("title"))


# -- metrics (f25-f35) -------------------------------------------------------------------------

_USER_COUNTS_SQL = """uc AS (
  SELECT user_id,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         NULLIF(count(*) FILTER (WHERE event_type = 'view'), 13) AS views,
         count(*) FILTER (WHERE event_type = 'click') AS clicks
  FROM events GROUP BY user_id)"""


def _user_counts(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events")
    return e.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.nullif(F.count_if(F.col("event_type") == "view"), F.lit(13)).alias("views"),
        F.count_if(F.col("event_type") == "click").alias("clicks"))


@query("f25_conversion_rate", D.with_ctes(_USER_COUNTS_SQL) + """
SELECT user_id, purchases, views,
       CASE WHEN views <> 0 THEN purchases / views ELSE 0.0 END AS rate FROM uc""")
def f25(spark, sf):
    u = _user_counts(spark, sf)
    return u.select("user_id", "purchases", "views", M.conversion_rate("purchases", "views").alias("rate"))


@query("f26_conversion_nullable", D.with_ctes(_USER_COUNTS_SQL) + """
SELECT user_id, CASE WHEN views IS NULL OR purchases IS NULL THEN NULL
                     WHEN views > 0 THEN purchases / views ELSE 0.0 END AS rate FROM uc""")
def f26(spark, sf):
    u = _user_counts(spark, sf)
    return u.select("user_id", M.conversion_rate_nullable("purchases", "views").alias("rate"))


@query("f27_cap_outliers", D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL) + """
, rated AS (SELECT r.productId, r.date, CASE WHEN d.views <> 0 THEN r.totalSales / d.views ELSE 0.0 END AS rate
            FROM ranking r JOIN detail d ON r.productId = d.productId AND r.date = d.date)
SELECT productId, date, CASE WHEN rate > 1 THEN (SELECT max(rate) FROM rated WHERE rate < 1) ELSE rate END
       AS conversionRate FROM rated""")
def f27(spark, sf):
    from rankflow.operators.relational import join_snapshots
    from rankflow.plans.jobs import cap_rate

    j = join_snapshots(*D.snapshots(spark, sf))
    rated = j.select("productId", "date", M.conversion_rate("totalSales", "views").alias("conversionRate"))
    return cap_rate(rated)


@query("f28_ratio", D.with_ctes(_USER_COUNTS_SQL) + """
SELECT user_id, purchases / NULLIF(clicks, 0) AS ratio FROM uc""")
def f28(spark, sf):
    return _user_counts(spark, sf).select("user_id", M.ratio("purchases", "clicks").alias("ratio"))


@query("f29_original_price", f"""
SELECT l_orderkey, l_linenumber,
       {D.sql_original_price('l_extendedprice', '(l_discount + 0.0)')} AS from_fraction,
       {D.sql_original_price('l_extendedprice', '(round(l_discount * 100) + 0.0)')} AS from_percent,
       {D.sql_original_price('l_extendedprice', 'CAST(1.0 AS DOUBLE)')} AS full_discount
FROM lineitem""")
def f29(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     M.original_price("l_extendedprice", F.col("l_discount") + F.lit(0.0)).alias("from_fraction"),
                     M.original_price("l_extendedprice", F.round(F.col("l_discount") * 100) + F.lit(0.0))
                     .alias("from_percent"),
                     M.original_price("l_extendedprice", F.lit(1.0)).alias("full_discount"))


_STAMP_SQL = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
                     WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0')
                     WHEN 'P' THEN strftime(o_orderdate, '%Y%m%d') || '2035' ELSE 'x' END"""


def _stamp_text() -> F.Column:
    d = F.date_format("o_orderdate", "yyyyMMdd")
    return (F.when(F.col("o_orderstatus") == "F", d)
             .when(F.col("o_orderstatus") == "O", F.concat(d, F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")))
             .when(F.col("o_orderstatus") == "P", F.concat(d, F.lit("2035")))
             .otherwise(F.lit("x")))


@query("f30_parse_stamp", f"""
SELECT o_orderkey, {_STAMP_SQL} AS stamp, {D.sql_parse_stamp(_STAMP_SQL)} AS ts FROM orders""")
def f30(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", _stamp_text().alias("stamp"))
    return o.select("o_orderkey", "stamp", M.parse_stamp("stamp").cast("timestamp_ntz").alias("ts"))


@query("f31_season", f"SELECT o_orderkey, {D.sql_season('o_orderdate')} AS season FROM orders")
def f31(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", M.season("o_orderdate").alias("season"))


@query("f32_stamp_prefix", D.with_ctes(D.RANKING_SQL) + """
SELECT productId, date, substr(CAST(date AS VARCHAR), 1, 6) AS month FROM ranking""")
def f32(spark, sf):
    return D.ranking(spark, sf).select("productId", "date", M.stamp_prefix("date", 6).alias("month"))


@query("f33_generic_stamp", f"""
SELECT l_orderkey, l_linenumber, {D.sql_parse_stamp("strftime(l_shipdate, '%Y%m%d')")} AS ts FROM lineitem""")
def f33(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     M.parse_stamp(F.date_format("l_shipdate", "yyyyMMdd")).cast("timestamp_ntz").alias("ts"))


@query("f34_format_2dp", """
SELECT l_orderkey, l_linenumber, printf('%.2f', l_discount * 100) AS pct, printf('%.2f', l_extendedprice / 7) AS seventh
FROM lineitem""")
def f34(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", M.format_2dp(F.col("l_discount") * 100).alias("pct"),
                     M.format_2dp(F.col("l_extendedprice") / 7).alias("seventh"))


@query("f35_round_half_even", D.with_ctes(_USER_COUNTS_SQL) + f"""
SELECT user_id, {sql_round2('purchases / NULLIF(purchases + clicks, 0)')} AS share FROM uc""")
def f35(spark, sf):
    u = _user_counts(spark, sf)
    share = F.try_divide(F.col("purchases").cast("double"), (F.col("purchases") + F.col("clicks")).cast("double"))
    return u.select("user_id", M.round_half_even(share, 2).alias("share"))



@query("f36_snapshot_stamp", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL (o_orderkey % 24) HOUR, '%Y%m%d%H') AS stamp FROM orders""")
def f36(spark, sf):
    o = _t(spark, sf, "orders")
    at = F.col("o_orderdate").cast("timestamp") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return o.select("o_orderkey", M.snapshot_stamp(at).alias("stamp"))
