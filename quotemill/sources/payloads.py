"""Flattening of raw provider payloads (JSON text, one response per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import product_url, strip

_STRINGS = "array<string>"


def _get(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def _present(value: Column) -> Column:
    """The field exists, be it a JSON null."""
    return value.isNotNull()


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Plain projections are merged, which would parse the payload again for every use; a
    one-row generator keeps them apart without a shuffle.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def with_content(raw: DataFrame) -> DataFrame:
    """Replace ``payload`` by ``_root``, the content object as a variant.

    ``results[0].content`` if that field exists (null counts as an empty object), else
    ``content``, else the payload itself.
    """
    keep = [c for c in raw.columns if c != "payload"]
    parsed = _once(raw, keep, _whole=F.try_parse_json("payload"))
    whole = F.col("_whole")
    fields = _once(
        parsed,
        [*keep, "_whole"],
        _first=F.variant_get(whole, "$.results[0].content", "variant"),
        _content=F.variant_get(whole, "$.content", "variant"),
    )
    first, content = F.col("_first"), F.col("_content")
    empty = F.parse_json(F.lit("{}"))
    root = (
        F.when(_present(first), F.when(F.is_variant_null(first), empty).otherwise(first))
        .when(_present(content), F.when(F.is_variant_null(content), empty).otherwise(content))
        .otherwise(whole)
    )
    return _once(fields, keep, _root=root)


def split_payloads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose payload is JSON, the others)."""
    parsed = F.try_parse_json("payload").isNotNull()
    return raw.where(parsed), raw.where(~parsed)


def payload_outcome(raw: DataFrame) -> DataFrame:
    """Number of readable and unreadable payloads."""
    parsed = F.try_parse_json("payload").isNotNull()
    return raw.agg(F.count_if(parsed).alias("ok"), F.count_if(~parsed).alias("failed"))


# Fields of a product's content; the variant ones tell a missing field from a JSON null.
_PRODUCT = (
    "struct<asin: string, title: string, brand: string, price: double, currency: string, "
    "stock: string, rating: double, url: string, images: variant, category: variant, "
    "categories: variant, category_path: array<string>, buybox: variant, product_overview: variant>"
)

# Fields of one search result.
_RESULTS = (
    "array<struct<asin: string, product_asin: string, title: string, brand: string, price: double, "
    "currency: string, rating: double, images: array<string>>>"
)


def _strings(field: Column) -> Column:
    """A list field; a missing one is the empty list, an explicit null stays null."""
    return F.when(_present(field), _get(field, "$", _STRINGS)).otherwise(F.array().cast(_STRINGS))


def _json_text(field: Column) -> Column:
    return F.when(_present(field), F.to_json(field)).otherwise("[]")


def flatten_product_payload(raw: DataFrame) -> DataFrame:
    """Product snapshot rows from (queried_asin, payload, amazon_domain, geo_location, scraped_at)."""
    keep = ["queried_asin", "amazon_domain", "geo_location", "scraped_at"]
    rows = _once(with_content(raw), keep, c=_get(F.col("_root"), "$", _PRODUCT))
    category = _strings(F.col("c.category"))
    path = F.filter("c.category_path", lambda c: c.isNotNull() & (c != ""))
    return rows.select(
        F.coalesce(F.nullif("c.asin", F.lit("")), "queried_asin").alias("asin"),
        *[f"c.{n}" for n in ("title", "brand", "price", "currency", "stock", "rating", "url")],
        _strings(F.col("c.images")).alias("images"),
        F.when(F.size(category) > 0, category)
        .otherwise(_strings(F.col("c.categories")))
        .alias("categories"),
        F.coalesce(F.transform(path, lambda c: strip(c)), F.array().cast(_STRINGS)).alias("category_path"),
        _json_text(F.col("c.buybox")).alias("buybox"),
        _json_text(F.col("c.product_overview")).alias("product_overview"),
        "amazon_domain",
        "geo_location",
        "scraped_at",
    )


def flatten_search_payload(raw: DataFrame) -> DataFrame:
    """Competitor snapshot rows from (parent_asin, payload, amazon_domain, fetched_at).

    Organic results come before paid ones; the first occurrence of a key wins. Both are
    settled inside the response's own array, so no shuffle is needed.
    """
    root = F.col("_root")
    none = F.array().cast(_RESULTS)
    results = F.concat(
        F.coalesce(_get(root, "$.results.organic", _RESULTS), none),
        F.coalesce(_get(root, "$.results.paid", _RESULTS), none),
    )
    products = F.coalesce(_get(root, "$.products", _RESULTS), none)
    has_results = _present(F.variant_get(root, "$.results", "variant"))

    def key(own: Column, other: Column) -> Column:
        return F.coalesce(F.nullif(own, F.lit("")), F.nullif(other, F.lit("")))

    def kept(_: Column, i: Column) -> Column:
        asin = F.get("_keys", i)
        other = ~asin.eqNullSafe(F.col("parent_asin"))
        return asin.isNotNull() & other & (F.array_position("_keys", asin) == i + 1)

    keep = ["parent_asin", "amazon_domain", "fetched_at"]
    listed = _once(with_content(raw), keep, _items=F.when(has_results, results).otherwise(products))
    keys = F.transform("_items", lambda item: key(item["asin"], item["product_asin"]))
    listed = _once(listed, [*keep, "_items"], _keys=keys)
    found = listed.select(*keep, F.inline(F.filter("_items", kept)))
    asin = key(F.col("asin"), F.col("product_asin"))
    return found.withColumn("asin", asin).select(
        "parent_asin",
        "asin",
        "title",
        "brand",
        "price",
        "currency",
        "rating",
        product_url(F.col("amazon_domain"), F.col("asin")).alias("url"),
        F.coalesce("images", F.array().cast(_STRINGS)).alias("images"),
        "amazon_domain",
        "fetched_at",
    )
