"""The daily run: snapshots → bronze → silver → gold, one write per table."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binning import as_day
from ..operators.gold import gold_from_silver, own_prices, price_tails
from ..operators.quality import quality_report
from ..operators.silver import clean_competitors, competitor_map, silver_price_history
from ..rules import RULES, PriceRules
from ..schemas import (
    BRONZE_COMPETITORS,
    BRONZE_PRODUCTS,
    GOLD_PRICE_FEATURES,
    OPS_LOAD_AUDIT,
    SILVER_COMPETITOR_MAP,
    SILVER_PRICE_HISTORY,
    SILVER_PRICE_TAILS,
)
from ..sinks.tables import (
    append_table,
    new_rows_only,
    read_table,
    replace_partition,
    upsert_table,
)
from ..sources.snapshots import read_competitors, read_products


@dataclass
class DayResult:
    """What one run wrote; a skipped stage has no entry."""

    day: date
    loads: dict[str, dict] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def load_bronze(
    spark: SparkSession,
    root: str,
    snapshots: str,
    day: str | date = "",
    multi_line: bool = True,
    once: bool = False,
) -> DayResult:
    """Append the day's snapshots. Tables without any new row are reported as skipped.

    Bronze is an audit trail, so a repeated run appends again and silver removes the
    copies; ``once`` leaves out rows that the partitions of the same days already hold.
    """
    result = DayResult(as_day(day))
    sources = (
        (BRONZE_PRODUCTS, read_products, ("asin", "scraped_at")),
        (BRONZE_COMPETITORS, read_competitors, ("parent_asin", "asin", "fetched_at")),
    )
    for table, reader, keys in sources:
        rows = reader(spark, snapshots, result.day, multi_line)
        if once:
            days = [r[0] for r in rows.select("ingest_date").distinct().collect()]
            known = read_table(spark, root, table).where(F.col("ingest_date").isin(days))
            rows = new_rows_only(rows, known, keys)
        audit = append_table(rows, table, root, result.day.isoformat())
        if audit["rows_in"]:
            result.loads[table.full_name] = audit
        else:
            result.skipped.append(table.full_name)
    return result


def _bronze(spark: SparkSession, root: str, table, day: date | None) -> DataFrame:
    rows = read_table(spark, root, table)
    return rows if day is None else rows.where(F.col("ingest_date") == F.lit(day))


def build_silver(spark: SparkSession, root: str, day: str | date | None) -> DayResult:
    """Upsert the day's cleaned prices and competitor map; None rebuilds every day.

    Bronze is partitioned by the snapshots' own date, so only that partition is read.
    """
    run_day = None if day is None else as_day(day)
    result = DayResult(run_day or as_day(""))
    batch = run_day.isoformat() if run_day else "backfill"
    products = _bronze(spark, root, BRONZE_PRODUCTS, run_day)
    competitors = _bronze(spark, root, BRONZE_COMPETITORS, run_day)
    staged = silver_price_history(products, competitors, run_day)
    result.loads[SILVER_PRICE_HISTORY.full_name] = upsert_table(
        staged, SILVER_PRICE_HISTORY, root, batch,
        ["price", "currency", "stock", "rating", "scraped_at"],
    )
    details = clean_competitors(competitors, run_day, carry=("title", "brand"))
    history = read_table(spark, root, SILVER_PRICE_HISTORY)
    result.loads[SILVER_COMPETITOR_MAP.full_name] = upsert_table(
        competitor_map(history, run_day, details), SILVER_COMPETITOR_MAP, root, batch
    )
    return result


def last_valid_tails(spark: SparkSession, root: str, day: date) -> date | None:
    """The newest day before ``day`` whose stored tails still match the price history.

    A load of that day or an earlier one, or a load that is not tied to a day, makes tails
    written before it stale.
    """
    audit = read_table(spark, root, OPS_LOAD_AUDIT)
    tails = audit.where(F.col("table_name") == SILVER_PRICE_TAILS.full_name).select(
        F.expr("try_cast(batch AS DATE)").alias("as_of"), F.col("loaded_at").alias("written_at")
    )
    tails = tails.groupBy("as_of").agg(F.max("written_at").alias("written_at"))
    loads = audit.where(F.col("table_name") == SILVER_PRICE_HISTORY.full_name).select(
        F.coalesce(F.expr("try_cast(batch AS DATE)"), F.lit(date(1970, 1, 1))).alias("load_day"),
        "loaded_at",
    )
    stale = (F.col("load_day") <= F.col("as_of")) & (F.col("loaded_at") >= F.col("written_at"))
    valid = tails.where(F.col("as_of") < F.lit(day)).join(loads, stale, "left_anti")
    return valid.agg(F.max("as_of")).first()[0]


def recent_history(spark: SparkSession, root: str, day: date) -> DataFrame:
    """Own prices that reach the day's frames: stored tails and the days after them.

    Without valid tails the whole history up to the day is read.
    """
    own = own_prices(read_table(spark, root, SILVER_PRICE_HISTORY))
    own = own.where(F.col("scrape_date") <= F.lit(day))
    start = last_valid_tails(spark, root, day)
    if start is None:
        return own
    tails = read_table(spark, root, SILVER_PRICE_TAILS).where(F.col("as_of") == F.lit(start))
    return tails.drop("as_of").unionByName(own.where(F.col("scrape_date") > F.lit(start)))


def build_gold(
    spark: SparkSession, root: str, day: str | date | None, rules: PriceRules = RULES
) -> DayResult:
    """Upsert the day's feature rows; None rebuilds every day in one pass.

    A daily run reads the tails of the last run and the new day, so its cost follows the
    number of products and not the length of the history.
    """
    run_day = None if day is None else as_day(day)
    result = DayResult(run_day or as_day(""))
    history = None
    if run_day is not None:
        history = recent_history(spark, root, run_day)
        tails = price_tails(history, run_day, rules).withColumn("as_of", F.lit(run_day))
        result.loads[SILVER_PRICE_TAILS.full_name] = replace_partition(
            tails, SILVER_PRICE_TAILS, root, run_day.isoformat()
        )
        today = read_table(spark, root, SILVER_PRICE_TAILS).where(F.col("as_of") == F.lit(run_day))
        history = today.drop("as_of")
    features = gold_from_silver(
        read_table(spark, root, SILVER_PRICE_HISTORY),
        read_table(spark, root, SILVER_COMPETITOR_MAP),
        as_of=run_day,
        rules=rules,
        history=history,
    )
    result.loads[GOLD_PRICE_FEATURES.full_name] = upsert_table(
        features, GOLD_PRICE_FEATURES, root, run_day.isoformat() if run_day else "backfill"
    )
    return result


def run_day(
    spark: SparkSession, root: str, snapshots: str, day: str | date = "", multi_line: bool = True
) -> DayResult:
    """All stages of one day in order."""
    result = load_bronze(spark, root, snapshots, day, multi_line)
    for stage in (build_silver, build_gold):
        result.loads.update(stage(spark, root, result.day).loads)
    return result


def check_layers(spark: SparkSession, root: str, only_failures: bool = False) -> DataFrame:
    """Quality report over the stored tables."""
    tables = (BRONZE_PRODUCTS, BRONZE_COMPETITORS, SILVER_PRICE_HISTORY, GOLD_PRICE_FEATURES)
    stored = {t.full_name: read_table(spark, root, t) for t in tables}
    return quality_report(stored, only_failures=only_failures)
