"""Aggregates kept from changes against the same aggregates computed anew."""

from __future__ import annotations

from datetime import datetime

from lakeops.plans import gold
from lakeops.plans.batch import run_batch
from lakeops.plans.gold_parts import GoldParts
from lakeops.plans.lake import Lake
from lakeops.streaming.micro_batch import medallion_handler
from tests.conftest import rows
from tests.test_files_and_tables import product, write_day
from tests.test_stream import decoded


def agree(spark, lake, daily=True):
    kept, state = GoldParts(spark, lake).tables(), lake.state(spark).read()
    anew = {
        "brand_performance": gold.brand_performance(state, unique_ids=True),
        "discount_analysis": gold.discount_analysis(state, unique_ids=True),
        "price_trend": gold.price_trend(lake.read_history(spark)),
    }
    if daily:
        anew["daily_summary"] = gold.daily_summary(lake.read_bronze(spark).drop("ingest"))
    for name, df in anew.items():
        assert rows(kept[name], *df.columns) == rows(df), name


def test_loads_repeats_and_late_days(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))

    def load(day, hour, *records):
        run_batch(spark, write_day(tmp_path, day, *records), lake, loaded_at=datetime(2024, 3, 1, hour), keep_gold=True)

    load("2024-01-02", 1, product(1, 50), product(2, 60, brand_name="C", rating_average=None), product(3, 70, 2, quantity_sold=0))
    load("2024-01-03", 2, product(1, 40, discount_rate=55), product(2, 60, 3), product(4, 1, original_price=None))
    agree(spark, lake)
    load("2024-01-03", 3, product(1, 41), product(4, 2))
    agree(spark, lake)
    load("2024-01-01", 4, product(1, 10), product(5, 5, discount_rate=30))
    agree(spark, lake)
    GoldParts(spark, lake).fold()
    load("2024-01-04", 5, product(5, 6, brand_name="No Brand"), product(1, 9, discount_rate=0))
    agree(spark, lake)


def test_epochs_of_a_stream(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    # sums are kept from the first epoch on; what was loaded before is added up then
    run_batch(spark, write_day(tmp_path, "2024-01-01", product(1, 50), product(2, 60)), lake, loaded_at=datetime(2024, 1, 1))
    handler = medallion_handler(lake, order=["event_id"], event_only=["event_id"], error="_error", keep_gold=True)
    events = [{**product(n % 3, 10 * n), "event_id": n, "crawl_date": "2024-01-02", "_event_type": "PING"} for n in range(6)]
    handler(decoded(spark, *events[:3]), 0)
    handler(decoded(spark, *events[3:]), 1)
    handler(decoded(spark, *events[3:]), 1)
    agree(spark, lake, daily=False)
