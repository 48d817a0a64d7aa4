"""Queries for scans, sinks, JSON and HTML sources (s01-s18, c09, c10, t01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow import schemas
from rankflow.functions import metrics as M
from rankflow.plans import driver as D
from rankflow.plans import jobs as J
from rankflow.plans.registry import query
from rankflow.session import materialize, scratch_path
from rankflow.sources import files as IO
from rankflow.sources import html as H
from rankflow.sources import json_items as JS
from rankflow.sources import ledger as LG
from rankflow.sources import markup as MK
from rankflow.streaming.ingest import ingest_snapshots

RANKING_COLS = [f.name for f in schemas.RANKING.fields]
_R = D.with_ctes(D.RANKING_SQL)
_RANKING_ALL = _R + """SELECT productId, brandName, productName, price, discountRate,
       CAST(NULL AS BIGINT) AS currentlyViewing, CAST(NULL AS BIGINT) AS currentlyBuying,
       ranking, trending, totalSales, colors, date, category FROM ranking"""


@query("s01_csv_scan", _RANKING_ALL)
def s01(spark: SparkSession, sf: str) -> DataFrame:
    path = IO.write_csv(D.ranking(spark, sf), scratch_path(spark, "s01"))
    return IO.read_snapshot(spark, path, "ranking")


def _deliver_tree(spark: SparkSession, sf: str, name: str, r: DataFrame | None = None,
                  reorder: bool = False) -> str:
    """Two CSV deliveries in nested folders plus a non-CSV file the scan must skip;
    with ``reorder`` the second delivery has its columns in reverse order."""
    root = scratch_path(spark, name)
    r = r if r is not None else materialize(D.ranking(spark, sf), f"{name}-ranking")  # read twice below
    second = r.filter(F.col("date") >= 19980101)
    if reorder:
        second = second.select(*reversed(second.columns))
    IO.write_csv(r.filter(F.col("date") < 19980101), f"{root}/20241127")
    IO.write_csv(second, f"{root}/nested/20241128")
    r.limit(0).write.mode("overwrite").json(f"{root}/nested/ignored_json")
    return root


@query("s02_csv_tree", _RANKING_ALL)
def s02(spark: SparkSession, sf: str) -> DataFrame:
    return IO.read_tree(spark, _deliver_tree(spark, sf, "s02"), "ranking")


@query("s02_csv_tree_by_header", _RANKING_ALL)
def s02h(spark: SparkSession, sf: str) -> DataFrame:
    """s02 over deliveries whose column order differs: each file read through its own header."""
    return IO.read_tree(spark, _deliver_tree(spark, sf, "s02h", reorder=True), "ranking")


_S03_NAME = "concat('2024-ranking-', regexp_extract(url, '/(fr|en|de|es)/', 1), '-summary.csv')"


@query("s03_category_from_name", f"""
SELECT page_id,
       CASE WHEN regexp_extract({_S03_NAME}, 'ranking-(.*?)-summary\\.csv', 1) = '' THEN 'unknown'
            ELSE regexp_replace(lower(trim(regexp_extract({_S03_NAME}, 'ranking-(.*?)-summary\\.csv', 1))), '-', '_', 'g')
       END AS category,
       CASE WHEN regexp_extract(url, 'ranking-(.*?)-summary\\.csv', 1) = '' THEN 'unknown'
            ELSE regexp_extract(url, 'ranking-(.*?)-summary\\.csv', 1) END AS url_category
FROM pages""")
def s03(spark: SparkSession, sf: str) -> DataFrame:
    pages = D.table(spark, sf, "pages")
    name = F.concat(F.lit("2024-ranking-"), F.regexp_extract("url", "/(fr|en|de|es)/", 1), F.lit("-summary.csv"))
    return pages.select("page_id", IO.category_from_filename(name).alias("category"),
                        IO.category_from_filename("url").alias("url_category"))


@query("s04_category_filter", _R + """SELECT productId, date, category, totalSales FROM ranking
WHERE category IN ('economy', 'promo')""")
def s04(spark: SparkSession, sf: str) -> DataFrame:
    r = IO.filter_categories(D.ranking(spark, sf), ["economy", "promo"])
    return r.select("productId", "date", "category", "totalSales")


def _deliver_by_name(spark: SparkSession, sf: str) -> str:
    """A delivery of CSV files named by category, in folders by number; a note without a header lies among them."""
    r = D.ranking(spark, sf)
    r = materialize(r, "s04-ranking")
    root = scratch_path(spark, "s04-landing")
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for (category,) in r.select("category").distinct().collect():  # the driver tables have a few
        out = IO.write_csv(r.where(F.col("category") == category).drop("category"), f"{root}/raw-{category}")
        parts = [s.getPath() for s in fs.listStatus(path(out)) if s.getPath().getName().startswith("part-")]
        for k, part in enumerate(parts):
            fs.mkdirs(path(f"{root}/{k}"))
            fs.rename(part, path(f"{root}/{k}/20241127-ranking-{category.replace('_', '-')}-summary.csv"))
        fs.delete(path(out), True)
    note = fs.create(path(f"{root}/20241127-ranking-notes-summary.csv"), False)
    note.write(bytearray(b"no header here\n1\n"))
    note.close()
    return root


@query("s04_files_by_name", _R + """
SELECT productId, date, regexp_replace(category, '-', '_', 'g') AS category, totalSales FROM ranking WHERE category IN ('economy', 'promo')""")
def s04_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files outside the include list are left out by their names, before they are opened."""
    df = IO.read_tree(spark, _deliver_by_name(spark, sf), "ranking", ["economy", "promo"], by_name=True)
    return df.select("productId", "date", "category", "totalSales")


@query("s05_require_columns", "SELECT p_partkey, p_name, p_type FROM part")
def s05(spark: SparkSession, sf: str) -> DataFrame:
    part = schemas.require_columns(D.table(spark, sf, "part"), ["p_partkey", "P_NAME", "p_type"])
    return part.select("p_partkey", "p_name", "p_type")


@query("s06_normalise_columns", """
SELECT p_partkey AS productId, p_name AS productName, p_size AS ranking,
       regexp_replace(lower(trim(concat(p_type, '-', p_brand))), '-', '_', 'g') AS category
FROM part""")
def s06(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("ProductName"),
        F.col("p_size").alias("Ranking"), F.concat("p_type", F.lit("-"), "p_brand").alias("Category"))
    return schemas.normalise_columns(part)


@query("s07_table_sink", _RANKING_ALL)
def s07(spark: SparkSession, sf: str) -> DataFrame:
    path = IO.write_table(D.ranking(spark, sf), scratch_path(spark, "s07"), partition_by=["category"])
    return schemas.conform(spark.read.parquet(path), schemas.RANKING)


@query("s07_observed_sink", _R + """
SELECT count(*) AS "rows", count(*) - count(colors) AS null_colors, CAST(min(date) AS BIGINT) AS first_date, CAST(max(date) AS BIGINT) AS last_date FROM ranking""")
def s07_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Row count, nulls and range of a table, observed while it is written."""
    seen = IO.write_observed(D.ranking(spark, sf), scratch_path(spark, "s07-observed"), ranges=["date"], partition_by=["category"])
    return spark.createDataFrame([(seen["rows"], seen["nulls.colors"], seen["min.date"], seen["max.date"])], "rows long, null_colors long, first_date long, last_date long")


@query("s08_csv_sink", """
SELECT p_partkey AS productId, p_name AS productName,
       array_to_string(string_split(concat(p_name, ' ', lower(p_type)), ' '), ',') AS keywords
FROM part""")
def s08(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select(
        F.col("p_partkey").alias("productId"), F.col("p_name").alias("productName"),
        F.split(F.concat("p_name", F.lit(" "), F.lower("p_type")), " ").alias("keywords"))
    path = IO.write_csv(part, scratch_path(spark, "s08"))
    return spark.read.schema("productId bigint, productName string, keywords string").option("header", True).option("escape", '"').csv(path)


@query("s09_append_snapshot", _R + """
SELECT productId, date, category, totalSales FROM ranking WHERE date < 19980101
UNION ALL
SELECT productId, date, category, totalSales FROM ranking WHERE date >= 19970101""")
def s09(spark: SparkSession, sf: str) -> DataFrame:
    r = D.ranking(spark, sf).select("productId", "date", "category", "totalSales")
    path = scratch_path(spark, "s09")
    IO.append_snapshot(r.filter(F.col("date") < 19980101), path, ["category"])
    IO.append_snapshot(r.filter(F.col("date") >= 19970101), path, ["category"])
    return spark.read.parquet(path).select("productId", "date", "category", "totalSales")


@query("s10_append_distinct", _R + "SELECT productId, date, category, totalSales FROM ranking")
def s10(spark: SparkSession, sf: str) -> DataFrame:
    r = D.ranking(spark, sf).select("productId", "date", "category", "totalSales")
    path = scratch_path(spark, "s10")
    IO.append_distinct(spark, r.filter(F.col("date") < 19980101), path, ["productId", "date"], range_col="date")
    IO.append_distinct(spark, r.filter(F.col("date") >= 19970101), path, ["productId", "date"], range_col="date")
    return spark.read.parquet(path)


@query("s10_ledger", _R + """
SELECT CASE WHEN productId % 11 = 0 THEN NULL ELSE productId END AS productId, date, category, max(totalSales) AS totalSales
FROM ranking GROUP BY 1, 2, 3""")
def s10_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Three overlapping deliveries, some keys null, one of them repeated under its own id and one under
    another: each key once."""
    key = F.when(F.col("productId") % 11 != 0, F.col("productId")).alias("productId")
    r = D.ranking(spark, sf).select(key, "date", "category", (-F.col("totalSales")).alias("totalSales"))  # the least row is the largest sale
    r = materialize(r, "s10-ranking")
    ledger = LG.BatchLedger(spark, scratch_path(spark, "s10-ledger"), r.schema)
    early, late = r.filter("date IS NULL OR date < 19960101"), r.filter("date >= 19950101")
    for batch, rows in (("early", early), ("early", early), ("late", late), ("again", r)):
        ledger.deliver(batch, rows, ["productId", "date", "category"], range_col="date")
    return ledger.read().withColumn("totalSales", -F.col("totalSales"))


@query("s11_publish", _RANKING_ALL)
def s11(spark: SparkSession, sf: str) -> DataFrame:
    dst = IO.publish(spark, _deliver_tree(spark, sf, "s11"), scratch_path(spark, "s11-lake"))
    return schemas.conform(spark.read.parquet(dst), schemas.RANKING)


_TSV_COLS = ("productId", "date", "brandName", "productName", "colors", "ranking", "price", "discountRate",
             "totalSales", "category", "views", "conversionRate", "season")


def _tsv_sql_part(c: str) -> str:
    if c in ("discountRate", "conversionRate"):
        return f"COALESCE(printf('%.2f', CAST({c} AS DOUBLE)), 'None')"
    if c == "date":
        return "COALESCE(strftime(date, '%Y-%m-%d %H:%M:%S'), 'None')"
    return f"COALESCE(CAST({c} AS VARCHAR), 'None')"


_S12_SQL = D.with_ctes(D.RANKING_SQL, D.DETAIL_SQL, D.ENRICHED_SQL) + \
    "SELECT concat_ws(chr(9), " + ", ".join(_tsv_sql_part(c) for c in _TSV_COLS) + ") AS line FROM enriched"


@query("s12_tsv_lines", _S12_SQL)
def s12(spark: SparkSession, sf: str) -> DataFrame:
    e = J.enrich_with_price_and_season(*D.snapshots(spark, sf))
    return IO.to_tsv_lines(e, _TSV_COLS, two_dp=("discountRate", "conversionRate")).select(
        F.col("value").alias("line"))


# -- nested JSON (s14, c09) --------------------------------------------------

def _k(col: str = "props") -> F.Column:
    return F.get_json_object(col, "$.k").cast("int")


def ranking_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One ranking-API response document per event, built from the event's fields.

    Each document has a module with a ranked item and a banner item (no
    ``image``), and a module without items, so the flattening has to skip both.
    """
    ev = D.table(spark, sf, "events").withColumn("k", _k())
    k = F.col("k").cast("string")
    text = lambda c: F.struct(c.alias("text"))
    viewing = F.when(F.col("event_type") == "view", F.concat(k, F.lit("명이 보는 중"))) \
               .otherwise(F.concat(F.lit("1."), k, F.lit("천명이 보는 중")))
    infos = F.array(text(viewing), text(F.concat(k, F.lit("명이 구매 중"))))
    labels = F.when(F.col("event_type") == "view",
                    F.array(text(F.lit("급상승")), text(F.concat(F.lit("판매 "), k, F.lit("천개"))))) \
              .when(F.col("event_type") == "click", F.array(text(F.concat(F.lit("판매 "), k, F.lit("만개"))))) \
              .otherwise(F.array(text(F.concat(F.lit("판매 "), k, F.lit("개")))))
    image = F.struct(F.col("user_id").cast("int").alias("rank"), F.concat(F.lit("/img/"), k).alias("url"),
                     labels.alias("labels"))
    ranked = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.col("event_type").alias("brandName"),
                 F.concat(F.lit("item "), F.col("user_id").cast("string")).alias("productName"),
                 infos.alias("additionalInformation")).alias("info"),
        F.struct(F.concat(F.lit("/p/"), F.col("event_id").cast("string")).alias("url"),
                 F.struct(F.struct(F.struct((F.col("k") * 100).alias("price"),
                                            (F.col("k") * 120).alias("original_price"),
                                            F.when(F.col("event_type") != "error", F.col("k") % 50)
                                            .alias("discount_rate")).alias("payload")).alias("ga4"),
                          F.struct(F.struct(F.when(F.col("event_type") != "signup", k).alias("reviewCount"),
                                            M.format_2dp("value").alias("reviewScore"))
                                   .alias("payload")).alias("amplitude")).alias("eventLog")).alias("onClick"),
        image.alias("image"))
    banner = ranked.withField("id", F.concat(F.lit("b"), F.col("event_id").cast("string"))) \
                   .withField("image", F.when(F.lit(False), image))
    modules = F.array(F.struct(F.array(ranked, banner).alias("items")),
                      F.struct(F.when(F.lit(False), F.array(ranked)).alias("items")))
    doc = F.struct(F.struct(modules.alias("modules")).alias("data"))
    return ev.select("event_id", F.to_json(doc).alias("value"))


@query("s14_json_items", """
SELECT event_id, CAST(event_id AS VARCHAR) AS item_id, CAST(user_id AS INTEGER) AS rank FROM events""")
def s14(spark: SparkSession, sf: str) -> DataFrame:
    items = JS.read_ranking_json(ranking_documents(spark, sf), keep=("event_id",))
    return items.select("event_id", F.col("item.id").alias("item_id"), F.col("item.image.rank").alias("rank"))


_C09_SQL = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, '202411271530' AS date, CAST(event_id AS VARCHAR) AS product_id,
       'item ' || CAST(user_id AS VARCHAR) AS product_name, event_type AS brand_name,
       CAST(k * 120 AS BIGINT) AS original_price, CAST(k * 100 AS BIGINT) AS final_price,
       CAST(CASE WHEN event_type <> 'error' THEN k % 50 ELSE 0 END AS BIGINT) AS discount_rate,
       CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS trending,
       CASE WHEN event_type = 'view' THEN CAST(k AS BIGINT) * 1000
            WHEN event_type = 'click' THEN CAST(k AS BIGINT) * 10000 END AS sold_count,
       CASE WHEN event_type = 'view' THEN CAST(k AS BIGINT)
            ELSE CAST(trunc(CAST('1.' || CAST(k AS VARCHAR) AS DECIMAL(18,6)) * 1000) AS BIGINT) END AS viewing,
       CAST(k AS BIGINT) AS purchasing,
       CAST(CASE WHEN event_type <> 'signup' THEN k ELSE 0 END AS BIGINT) AS review_count,
       CAST(printf('%.2f', value) AS DOUBLE) AS review_score,
       '/p/' || CAST(event_id AS VARCHAR) AS product_url, '/img/' || CAST(k AS VARCHAR) AS image_url,
       CAST(user_id AS INTEGER) AS rank
FROM e"""


@query("c09_flatten_json", _C09_SQL)
def c09(spark: SparkSession, sf: str) -> DataFrame:
    return JS.flatten_ranking_json(ranking_documents(spark, sf), "202411271530", keep=("event_id",))


def drifted_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking documents, of each ten events one cut off, one without modules, one null, and one each
    with a rank as text, prices as text, one label in place of a list, and bare texts as information."""
    docs, k, value = ranking_documents(spark, sf), F.col("event_id") % 10, F.col("value")
    drifted = docs.withColumn("value", F.when(k == 1, F.substring(value, 1, 40)).when(k == 2, F.lit('{"data": {"modules": "none"}}')).when(k == 3, F.lit(None).cast("string"))
                           .when(k == 4, F.regexp_replace(value, '"rank":(\\d+)', '"rank":"$1"'))
                           .when(k == 5, F.regexp_replace(value, '"(price|original_price)":(\\d+)', '"$1":"$2"'))
                           .when(k == 6, F.regexp_replace(value, '"labels":\\[(\\{[^}]*\\})\\]', '"labels":$1'))
                           .when(k == 7, F.regexp_replace(value, '\\{"text":("[^"]*보는 중")\\}', "$1")).otherwise(value))
    return materialize(drifted, "drifted")  # as documents lie in storage


@query("c09_drifted_json", _C09_SQL + " WHERE event_id % 10 NOT IN (1, 2, 3)")
def c09_drifted(spark: SparkSession, sf: str) -> DataFrame:
    """c09 by variant paths over drifted documents: the readable ones give the same rows."""
    items, _ = JS.read_documents(drifted_documents(spark, sf), keep=("event_id",))
    return JS.flatten_documents(items, "202411271530", keep=("event_id",))


@query("s14_quarantine", """
SELECT CASE event_id % 10 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no modules' ELSE 'no document' END AS reason, count(*) AS documents, min(event_id) AS first_event
FROM events WHERE event_id % 10 IN (1, 2, 3) GROUP BY 1""")
def s14_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = JS.read_documents(drifted_documents(spark, sf), keep=("event_id",))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"), F.min("event_id").alias("first_event"))


# -- HTML pages (s15-s18) ------------------------------------------------------

_TILE = '<a\\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>'


@query("s15_html_tiles", f"""
SELECT page_id, CAST(i AS INTEGER) AS pos, hrefs[i] AS href,
       regexp_replace(texts[i], '^\\s+|\\s+$', '', 'g') AS text
FROM (SELECT page_id, regexp_extract_all(html, '{_TILE}', 1) AS hrefs,
             regexp_extract_all(html, '{_TILE}', 2) AS texts FROM pages) t,
     range(1, len(hrefs) + 1) r(i)""")
def s15(spark: SparkSession, sf: str) -> DataFrame:
    return H.extract_tiles(D.table(spark, sf, "pages"), "a", "href").withColumn("pos", F.col("pos").cast("int"))


@query("s16_html_labelled", """
SELECT page_id,
       NULLIF(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>\\s*[^<]*\\s*</h1>.*?<b[^>]*>([^<]*)<', 1),
                             '^\\s+|\\s+$', '', 'g'), '') AS after_title,
       NULLIF(regexp_replace(regexp_extract(html, '(?s)<a[^>]*>\\s*The\\s*</a>.*?<a[^>]*>([^<]*)<', 1),
                             '^\\s+|\\s+$', '', 'g'), '') AS after_the
FROM pages""")
def s16(spark: SparkSession, sf: str) -> DataFrame:
    pages = D.table(spark, sf, "pages")
    return pages.select("page_id",
                        H.extract_labelled("html", "[^<]*", "h1", "b", label_is_pattern=True).alias("after_title"),
                        H.extract_labelled("html", "The", "a").alias("after_the"))


@query("s17_first_numeric", """
SELECT page_id, CAST(replace(regexp_replace(
         list_filter(regexp_extract_all(url, '[^/?=&#.:]+'),
                     lambda x: regexp_matches(replace(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), ',', ''), '^[0-9]+$'))[1],
         '^\\s+|\\s+$', '', 'g'), ',', '') AS BIGINT) AS first_number
FROM pages""")
def s17(spark: SparkSession, sf: str) -> DataFrame:
    pages = D.table(spark, sf, "pages")
    tokens = F.regexp_extract_all("url", F.lit("[^/?=&#.:]+"), F.lit(0))
    return pages.select("page_id", H.first_numeric(tokens).alias("first_number"))


# Stored pages with nested and partly broken markup, rendered from the driver's rows.

def _escaped(c: str) -> F.Column:
    out = F.col(c)
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _text(c: F.Column | str) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ranking_pages(ranking: DataFrame, per_page: int = 40) -> DataFrame:
    """Ranking pages of at most ``per_page`` tiles.  Paragraphs are left open, a page ends within its
    last tile, and every seventh tile has no discount and every fifth no counters."""
    viewing, buying = F.col("totalSales") % 50, F.col("totalSales") % 7
    counters = F.when(F.col("productId") % 5 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<div class="pt-2.5 x"><div><span>'), _text(viewing), F.lit("명이 <br>보는 중</span>"),
        F.when(buying > 0, F.concat(F.lit("<span><b>"), _text(buying), F.lit("</b>명이 구매 중</span>"))).otherwise(""), F.lit("</div></div>")))
    tile = F.concat(
        F.lit('<div class="a gtm-view-item-list" data-item-id="'), _text("productId"), F.lit('" data-price="'), _text("price"), F.lit('"'),
        F.when(F.col("productId") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit(' data-discount-rate="'), _text("discountRate"), F.lit('"'))),
        F.lit('><div class="sc-1m4cyao-1 dYjLwF"><span><i></i><span>'), _text("ranking"), F.lit("</span></span>"),
        F.when(F.col("trending") == 1, F.lit("<div><span><span> 급상승 </span></span></div>")).otherwise("</em>"),
        F.lit('</div><a><p class="text-etc_11px_semibold">'), _escaped("brandName"), F.lit('<p class="x text-body_13px_reg"> '), _escaped("productName"), F.lit(" </a>"),
        counters, F.lit('<span class="font-pretendard text-etc_11px_reg sc-1m4cyao-7 eYXbyJ">판매 '), _text("totalSales"), F.lit(" 개</span>"))
    order = F.floor((F.col("ranking") - 1) / per_page).alias("page")
    tiles = F.transform(F.array_sort(F.collect_list(F.struct("ranking", "productId", tile.alias("tile")))), lambda t: t["tile"])
    return ranking.groupBy("category", "date", order).agg(tiles.alias("tiles")).select(
        "category", "date", F.concat(F.lit("<!DOCTYPE html><html><body><style>p{}</style><p>top<ul><li>1<li>2</ul><div>"),
                                     F.array_join("tiles", "</div>\n")).alias("html"))


@query("s15_tile_records", _R + """
SELECT productId, brandName, productName, price, CASE WHEN productId % 7 = 0 THEN 0.0 ELSE discountRate END AS discountRate,
       CASE WHEN productId % 5 = 0 THEN 0 ELSE totalSales % 50 END AS currentlyViewing,
       CASE WHEN productId % 5 = 0 THEN 0 ELSE totalSales % 7 END AS currentlyBuying,
       ranking, trending, totalSales, colors, date, category FROM ranking""")
def s15_records(spark: SparkSession, sf: str) -> DataFrame:
    return H.ranking_records(ranking_pages(D.ranking(spark, sf))).select(*RANKING_COLS)


_ITEM = '<li><a href="([^"]*)">([^<]*)</a></li>'


@query("s15_page_items", f"""
SELECT page_id, CAST(i AS INTEGER) AS pos, links[i] AS link,
       regexp_replace(replace(labels[i], '&amp;', '&'), '^\\s+|\\s+$', '', 'g') AS label
FROM (SELECT page_id, regexp_extract_all(html, '{_ITEM}', 1) AS links, regexp_extract_all(html, '{_ITEM}', 2) AS labels FROM pages) t,
     range(1, len(links) + 1) r(i)""")
def s15_items(spark: SparkSession, sf: str) -> DataFrame:
    """The entries of every page's menu."""
    link = (MK.Step("a", child=True),)
    return MK.extract_records(D.table(spark, sf, "pages"), MK.Step("li"), {"link": MK.Field(link, "href"), "label": MK.Field(link)})


def detail_pages(detail: DataFrame) -> DataFrame:
    """One detail page per row.  Pages lack what the row lacks; other spans and numbers stand around."""
    whole = lambda c: F.format_number(F.col(c), 0)
    like = '<span class="text-xs font-medium font-pretendard">'
    html = F.concat(
        F.lit("<html><body><header><span>1</span><img src=x><span>조회수 안내</span></header><p>"),
        F.when(F.col("views").isNotNull(), F.concat(F.lit("<dl><dt><span>조회수</span><dd><div><span> "), whole("views"), F.lit(" 회</span></div></dl>"))).otherwise(""),
        F.lit("<div><span>누적판매</span><i>9</i><span>"), whole("totalSales"), F.lit("개</span></div>"),
        F.lit(f'{like}77</span><button><b><div aria-label="좋아요 버튼"><svg></svg></div></b></button>{like}좋아요</span><div>{like}'), whole("likes"), F.lit("</span></div>"),
        F.when(F.col("rating").isNotNull(), F.concat(F.lit('<div><span class="text-black font-medium">'), _text("rating"),
                                                     F.lit("<!-- stars --></span><em><span>5</span></em><span>후기 "), whole("ratingCount"), F.lit("개</span></div>"))).otherwise("<span>8</span>"))
    return detail.select("productId", "date", html.alias("html"))


@query("s16_detail_records", D.with_ctes(D.DETAIL_SQL) + """
SELECT productId, date, views, likes, rating, CASE WHEN rating IS NOT NULL THEN ratingCount END AS ratingCount, totalSales FROM detail""")
def s16_records(spark: SparkSession, sf: str) -> DataFrame:
    return H.detail_records(detail_pages(D.dealt(D.detail(spark, sf), "productId", "date")))


def _plain(sql: str) -> str:
    return f"regexp_replace(replace({sql}, '&amp;', '&'), '^\\s+|\\s+$', '', 'g')"


_LI = "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)"


@query("s16_page_nodes", f"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, CAST(len({_LI}) AS INTEGER) AS n_items,
       {_plain(_LI + '[1]')} AS first_item, {_plain(_LI + '[2]')} AS next_item,
       {_plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS title,
       {_plain("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS ad
FROM pages""")
def s16_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Menu, title and advertisement of every page by conditions on node numbers."""
    n = F.col("nodes")
    menu = MK.bind(MK.first(MK.elements(n, "nav")), lambda nav: MK.elements(n, "li", where=MK.inside(nav)))
    item = MK.first(menu)
    onward = lambda of: MK.first(MK.elements(n, "li", where=MK.siblings_after(of)))
    text = lambda e: MK.bind(e, lambda one: MK.text_of(n, one))
    ad = MK.bind(MK.first(MK.elements(n, "nav")), lambda nav: MK.first(MK.elements(n, "div", ["ad"], where=MK.after(nav))))
    return MK.with_nodes(D.table(spark, sf, "pages")).select(
        "page_id", MK.first(MK.elements(n, "html"))["attrs"]["lang"].alias("lang"), F.size(menu).alias("n_items"),
        text(item).alias("first_item"), text(MK.bind(item, onward)).alias("next_item"),
        text(MK.first(MK.elements(n, "h1"))).alias("title"), text(ad).alias("ad"))


_S18_TEXT = """CASE event_type WHEN 'view' THEN printf('%.2f', value)
                WHEN 'click' THEN CAST(k AS VARCHAR) || '.' || CAST(k AS VARCHAR) || '.1'
                WHEN 'purchase' THEN '.' || CAST(k AS VARCHAR)
                WHEN 'signup' THEN CAST(k AS VARCHAR) || '.'
                ELSE event_type END"""


@query("s18_safe_rating", f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, {_S18_TEXT} AS rating_text,
       CASE WHEN regexp_matches(regexp_replace({_S18_TEXT}, '^\\s+|\\s+$', '', 'g'), '^([0-9]+\\.?[0-9]*|\\.[0-9]+)$')
            THEN TRY_CAST(regexp_replace({_S18_TEXT}, '^\\s+|\\s+$', '', 'g') AS DOUBLE) END AS rating
FROM e""")
def s18(spark: SparkSession, sf: str) -> DataFrame:
    ev = D.table(spark, sf, "events").withColumn("k", _k().cast("string"))
    t = (F.when(F.col("event_type") == "view", M.format_2dp("value"))
          .when(F.col("event_type") == "click", F.concat("k", F.lit("."), "k", F.lit(".1")))
          .when(F.col("event_type") == "purchase", F.concat(F.lit("."), "k"))
          .when(F.col("event_type") == "signup", F.concat("k", F.lit(".")))
          .otherwise(F.col("event_type")))
    return ev.select("event_id", t.alias("rating_text"), H.safe_rating(t).alias("rating"))


# -- ingest (c10, t01) ------------------------------------------------------------

@query("c10_ingest_batch", _R + """
SELECT productId, brandName, productName, price, discountRate,
       CAST(NULL AS BIGINT) AS currentlyViewing, CAST(NULL AS BIGINT) AS currentlyBuying,
       ranking, trending, totalSales, colors, date, category
FROM ranking WHERE substr(CAST(date AS VARCHAR), 1, 6) = '199803' AND date > 19980315""")
def c10(spark: SparkSession, sf: str) -> DataFrame:
    ranking = materialize(D.ranking(spark, sf), "c10-ranking")  # feeds both deliveries and `done`
    landing = _deliver_tree(spark, sf, "c10", ranking)
    done = ranking.filter(F.col("date") <= 19980315).select("productId", "date")
    return J.ingest_batch(spark, landing, done, "199803", width=6)


@query("t01_stream_ingest", "SELECT event_id, ts, user_id, event_type FROM events")
def t01(spark: SparkSession, sf: str) -> DataFrame:
    ev = D.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    src, sink, ckpt = (scratch_path(spark, f"t01-{n}") for n in ("landing", "sink", "checkpoint"))
    schema = ev.schema
    # Two deliveries overlapping by ten days, each landed before its own run.
    ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")).write.mode("append").parquet(src)
    ingest_snapshots(spark, src, sink, ckpt, schema, keys=("user_id", "ts"), fmt="parquet",
                     event_time="ts")
    ev.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).write.mode("append").parquet(src)
    ingest_snapshots(spark, src, sink, ckpt, schema, keys=("user_id", "ts"), fmt="parquet",
                     event_time="ts")
    return spark.read.parquet(sink)


@query("t01_stream_ledger", "SELECT event_id, ts, user_id, event_type FROM events")
def t01_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """t01 into a ledger; the second delivery is ingested twice, the second time by a stream that has
    lost its checkpoint."""
    ev = D.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    src, sink, ckpt, fresh = (scratch_path(spark, f"t01-ledger-{n}") for n in ("landing", "sink", "checkpoint", "checkpoint2"))
    for low, high, at, name in (("2000-01-01", "2024-01-20", ckpt, "stream"), ("2024-01-10", "2100-01-01", ckpt, "stream"), (None, None, fresh, "restarted")):
        if low:
            part = (F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz"))
            ev.filter(F.coalesce(part, F.lit(True))).write.mode("append").parquet(src)
        ingest_snapshots(spark, src, sink, at, ev.schema, keys=("event_id",), fmt="parquet", policy="ledger", event_time="ts", name=name)
    return LG.BatchLedger(spark, sink, ev.schema).read()


@query("s13_preview", _R + """SELECT productId, date, ranking, category FROM ranking
ORDER BY date DESC, ranking, productId LIMIT 20""")
def s13(spark: SparkSession, sf: str) -> DataFrame:
    """The bounded rows a preview shows (``IO.preview`` prints the same frame)."""
    from rankflow.operators import windows as W

    r = D.ranking(spark, sf).select("productId", "date", "ranking", "category")
    return W.top_k(r, [F.col("date").desc(), F.col("ranking"), F.col("productId")], 20)
