"""Nested ranking-API JSON as rows (s14, f19-f22, c09).

``from_json`` with a fixed schema, then ``explode`` of the module and item
arrays: parsing and flattening are Catalyst expressions, one pass, no Python.

Where documents drift or break, :func:`read_documents` reads them as VARIANT: a value is taken by
its path whatever type it has now, and documents that can't be read are kept with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow import schemas
from rankflow.functions import numbers as N

FLAT_COLUMNS = ("date", "product_id", "product_name", "brand_name", "original_price", "final_price",
                "discount_rate", "trending", "sold_count", "viewing", "purchasing", "review_count",
                "review_score", "product_url", "image_url", "rank")


def read_ranking_json(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """s14: response documents -> one row per ranked item (``item`` struct).

    Modules without items contribute nothing; items without ``image.rank`` are
    dropped (they are ads/banners, not ranked products).
    """
    doc = F.from_json(F.col(value), schemas.RANKING_RESPONSE)
    modules = df.select(*keep, F.explode(doc["data"]["modules"]).alias("_m"))
    items = modules.select(*keep, F.explode_outer("_m.items").alias("item"))
    return items.filter(F.col("item.image.rank").isNotNull())


def flatten_items(items: DataFrame, stamp: Column | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """c09: the 16-column flat ranking row from each item (f19-f22 applied)."""
    i = F.col("item")
    ga4 = i["onClick"]["eventLog"]["ga4"]["payload"]
    amp = i["onClick"]["eventLog"]["amplitude"]["payload"]
    infos = F.coalesce(i["info"]["additionalInformation"], F.array().cast("array<struct<text:string>>"))
    labels = F.coalesce(i["image"]["labels"], F.array().cast("array<struct<text:string>>"))
    st = F.lit(stamp) if isinstance(stamp, str) else stamp
    return items.select(
        *keep,
        st.alias("date"),
        i["id"].alias("product_id"),
        i["info"]["productName"].alias("product_name"),
        i["info"]["brandName"].alias("brand_name"),
        N.int_or(ga4["original_price"], None).alias("original_price"),
        N.int_or(ga4["price"], None).alias("final_price"),
        N.int_or(ga4["discount_rate"], 0).alias("discount_rate"),
        N.trending_from_labels(labels).alias("trending"),
        N.sales_count(N.sales_text_from_labels(labels)).alias("sold_count"),
        N.viewing_count(infos).alias("viewing"),
        N.buying_count(infos).alias("purchasing"),
        N.int_or(amp["reviewCount"], 0).alias("review_count"),
        N.float_or_null(amp["reviewScore"]).alias("review_score"),
        i["onClick"]["url"].alias("product_url"),
        i["image"]["url"].alias("image_url"),
        i["image"]["rank"].alias("rank"),
    )


def flatten_ranking_json(df: DataFrame, stamp: Column | str, value: str = "value",
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """c09 end to end: documents -> flat rows."""
    return flatten_items(read_ranking_json(df, value, keep), stamp, keep)


# -- documents that drift or break ----------------------------------------------

NO_DOCUMENT, NOT_JSON, NO_MODULES = "no document", "not JSON", "no modules"


def read_documents(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """s14 on VARIANT: (items, quarantine).

    ``items`` has the ``keep`` columns and one variant ``item`` per ranked item; as in
    :func:`read_ranking_json`, items without a rank are left out.  ``quarantine`` has the ``keep``
    columns, the document as it came and the ``reason``: every input row without a readable list of
    modules is there, so rows in = rows read + rows quarantined.
    """
    parsed = F.try_parse_json(F.col(value))
    modules = F.try_variant_get("_doc", "$.data.modules", "array<variant>")
    reason = F.when(F.col(value).isNull(), NO_DOCUMENT).when(F.col("_doc").isNull(), NOT_JSON).when(F.col("_modules").isNull(), NO_MODULES)
    read = df.select(*keep, F.col(value), parsed.alias("_doc")).withColumn("_modules", modules).withColumn("reason", reason)
    module = read.where("reason IS NULL").select(*keep, F.explode("_modules").alias("_m"))
    item = module.select(*keep, F.explode(_list(F.col("_m"), "$.items")).alias("item"))
    return item.where(_whole(F.col("item"), "$.image.rank").isNotNull()), read.where("reason IS NOT NULL").select(*keep, value, "reason")


def _text(v: Column, path: str) -> Column:
    """The scalar at a path as text, whatever its type; null for lists and objects."""
    return F.try_variant_get(v, path, "string")


def _whole(v: Column, path: str) -> Column:
    """The number at a path, also where it stands as text."""
    return N.int_or(_text(v, path), None)


def _list(v: Column, path: str) -> Column:
    """The list at a path; a single value there is a list of one, nothing an empty list."""
    one = F.try_variant_get(v, path, "variant")
    some = F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one)).otherwise(F.array().cast("array<variant>"))
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), some)


def _texts(v: Column, path: str) -> Column:
    """The list at a path as structs with ``text``: of objects their text, of scalars themselves."""
    return F.transform(_list(v, path), lambda e: F.struct(F.coalesce(_text(e, "$.text"), _text(e, "$")).alias("text")))


def flatten_documents(items: DataFrame, stamp: Column | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """c09 on the items of :func:`read_documents`: the same 16 columns by path, with their defaults."""
    i = F.col("item")
    ga4, amp = "$.onClick.eventLog.ga4.payload", "$.onClick.eventLog.amplitude.payload"
    labels, infos = _texts(i, "$.image.labels"), _texts(i, "$.info.additionalInformation")
    return items.select(
        *keep,
        (F.lit(stamp) if isinstance(stamp, str) else stamp).alias("date"),
        _text(i, "$.id").alias("product_id"),
        _text(i, "$.info.productName").alias("product_name"),
        _text(i, "$.info.brandName").alias("brand_name"),
        _whole(i, f"{ga4}.original_price").alias("original_price"),
        _whole(i, f"{ga4}.price").alias("final_price"),
        F.coalesce(_whole(i, f"{ga4}.discount_rate"), F.lit(0).cast("bigint")).alias("discount_rate"),
        N.trending_from_labels(labels).alias("trending"),
        N.sales_count(N.sales_text_from_labels(labels)).alias("sold_count"),
        N.viewing_count(infos).alias("viewing"),
        N.buying_count(infos).alias("purchasing"),
        F.coalesce(_whole(i, f"{amp}.reviewCount"), F.lit(0).cast("bigint")).alias("review_count"),
        N.float_or_null(_text(i, f"{amp}.reviewScore")).alias("review_score"),
        _text(i, "$.onClick.url").alias("product_url"),
        _text(i, "$.image.url").alias("image_url"),
        _whole(i, "$.image.rank").cast("int").alias("rank"),
    )
