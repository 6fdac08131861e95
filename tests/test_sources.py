"""Snapshot, payload, manifest and CSV readers on small hand-written files."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from quotemill.schemas import PRICE_HISTORY, PRODUCT_SNAPSHOT
from quotemill.sinks.files import write_csv, write_snapshots
from quotemill.sources import payloads as L
from quotemill.sources import snapshots as S

DAY = "2024-03-01"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def product(asin, **fields):
    return {"asin": asin, "price": 10.0, "stock": "In Stock", "scraped_at": f"{DAY}T08:00:00Z", **fields}


@pytest.fixture()
def root(tmp_path):
    put(tmp_path / f"products/{DAY}/A.json", json.dumps(product("A", buybox=[{"p": 1}], images=["u"]), indent=1))
    put(tmp_path / f"products/{DAY}/B.json", json.dumps(product("B", price="n/a")))
    put(tmp_path / f"products/{DAY}/none.json", json.dumps(product(None)))
    put(tmp_path / f"products/{DAY}/broken.json", '{"asin": "C", ')
    rival = {"parent_asin": "A", "price": 9.0, "fetched_at": f"{DAY}T08:00:00Z"}
    put(
        tmp_path / f"competitors/{DAY}/A_competitors.json",
        json.dumps([{**rival, "asin": "X"}, {**rival, "asin": "Y"}, {**rival, "asin": None}]),
    )
    put(tmp_path / f"competitors/{DAY}/B_competitors.json", "[]")
    return str(tmp_path)


def test_products(spark, root):
    rows = {r.asin: r for r in S.read_products(spark, root, DAY).collect()}
    assert set(rows) == {"A", "B"}
    assert json.loads(rows["A"].buybox) == [{"p": 1}] and rows["A"].images == ["u"]
    assert rows["B"].price is None
    assert rows["A"].ingest_date == date(2024, 3, 1) and rows["A"]._ingested_at is not None


def test_snapshot_after_midnight_keeps_its_own_day(spark, tmp_path):
    put(tmp_path / f"products/{DAY}/A.json", json.dumps(product("A", scraped_at="2024-03-02T00:01:00Z")))
    assert S.read_products(spark, str(tmp_path), DAY).first().ingest_date == date(2024, 3, 2)


def test_competitors(spark, root):
    assert sorted(r.asin for r in S.read_competitors(spark, root, DAY).collect()) == ["X", "Y"]


def test_missing_day_is_empty(spark, root):
    rows = S.read_products(spark, root, "1999-01-01")
    assert rows.isEmpty() and "scraped_at" in rows.columns


def test_quarantine(spark, root):
    rows = S.read_json_folder(spark, f"{root}/products/{DAY}", PRODUCT_SNAPSHOT)
    good, bad = S.split_corrupt(rows)
    assert good.count() == 3
    assert [r[0].startswith('{"asin": "C"') for r in bad.collect()] == [True]


def test_manifest(spark, tmp_path):
    put(tmp_path / "keys.txt", "# tracked\nb000000001\n\n   \n  B000000002\t\n#B000000003\n #odd\n")
    keys = [r.asin for r in S.read_manifest(spark, str(tmp_path / "keys.txt")).collect()]
    assert sorted(keys) == ["#ODD", "B000000001", "B000000002"]


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("A", date(2024, 1, 2), 1.5, None)], "asin string, scrape_date date, price double, parent_asin string")
    write_csv(rows, str(tmp_path / "csv"))
    back = S.read_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert back.collect() == rows.collect()
    assert PRICE_HISTORY["scrape_date"].dataType == back.schema["scrape_date"].dataType


def test_snapshot_writer(spark, tmp_path):
    rows = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "asin string, price double")
    write_snapshots(rows, str(tmp_path), "products", DAY)
    read = S.read_products(spark, str(tmp_path), DAY, multi_line=False)
    assert sorted((r.asin, r.price) for r in read.collect()) == [("A", 1.0), ("B", 2.0)]
    path = write_snapshots(rows, str(tmp_path / "keyed"), "products", DAY, key="asin")
    assert (tmp_path / "keyed" / "products" / DAY / "_asin=A").exists()
    assert S.read_json_folder(spark, path, PRODUCT_SNAPSHOT, multi_line=False).count() == 2


def raw(spark, *payloads):
    rows = [("Q", p if isinstance(p, str) else json.dumps(p), "com", "10001") for p in payloads]
    frame = spark.createDataFrame(rows, "queried_asin string, payload string, amazon_domain string, geo_location string")
    return frame.withColumn("scraped_at", F.lit("2024-03-01 00:00:00").cast("timestamp"))


@pytest.mark.parametrize(
    "payload, asin, title",
    [
        ({"results": [{"content": {"asin": "A", "title": "t"}}]}, "A", "t"),
        ({"results": [{"content": None}], "content": {"title": "no"}}, "Q", None),
        ({"results": [], "content": {"asin": "A", "title": "c"}}, "A", "c"),
        ({"results": [{"x": 1}], "content": {"title": "c"}}, "Q", "c"),
        ({"results": {"a": 1}, "title": "own"}, "Q", "own"),
        ({"content": None}, "Q", None),
        ({"asin": "", "title": "bare"}, "Q", "bare"),
        ([1, 2], "Q", None),
    ],
)
def test_payload_root(spark, payload, asin, title):
    row = L.flatten_product_payload(raw(spark, payload)).first()
    assert (row.asin, row.title) == (asin, title)


def test_payload_lists(spark):
    row = L.flatten_product_payload(
        raw(spark, {"category": [], "categories": ["c"], "category_path": [" a ", "", None, " "], "buybox": [{"x": 1}], "price": "abc"})
    ).first()
    assert (row.images, row.categories, row.category_path) == ([], ["c"], ["a", ""])
    assert (row.buybox, row.product_overview, row.price) == ('[{"x":1}]', "[]", None)
    row = L.flatten_product_payload(raw(spark, {"category": ["n"], "categories": ["c"], "category_path": None})).first()
    assert (row.categories, row.category_path) == (["n"], [])


def test_unreadable_payloads(spark):
    frame = raw(spark, {"asin": "A"}, "{oops", '{"a": ')
    good, bad = L.split_payloads(frame)
    assert (good.count(), bad.count()) == (1, 2)
    assert tuple(L.payload_outcome(frame).first()) == (1, 2)


def search(spark, payload):
    frame = raw(spark, payload).select(
        F.lit("P").alias("parent_asin"), "payload", "amazon_domain", F.col("scraped_at").alias("fetched_at")
    )
    return [(r.asin, r.title, r.price) for r in L.flatten_search_payload(frame).collect()]


def test_search_results(spark):
    organic = [{"asin": "A", "title": "1", "price": 1.0}, {"product_asin": "B", "title": "2"}, {"title": "no key"}]
    paid = [{"asin": "A", "title": "again"}, {"asin": "P", "title": "self"}, {"asin": "", "product_asin": "C", "title": "3", "price": 3}]
    payload = {"results": [{"content": {"results": {"organic": organic, "paid": paid}}}]}
    assert search(spark, payload) == [("A", "1", 1.0), ("B", "2", None), ("C", "3", 3.0)]
    assert search(spark, {"content": {"products": organic}}) == [("A", "1", 1.0), ("B", "2", None)]
    # a present but unusable "results" hides "products"
    assert search(spark, {"content": {"results": None, "products": organic}}) == []
    assert search(spark, {"content": {"results": {"organic": None, "paid": None}}}) == []
