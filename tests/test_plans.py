"""Plans: what is shuffled, what is read."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeops.operators.changes import detect_changes
from lakeops.operators.history import change_log, replay_state
from lakeops.operators.merge import upsert
from lakeops.operators.paging import deep_page
from lakeops.plans.reports import footer_counts
from lakeops.sinks.tables import bucketed_table, drop_tables
from tests.conftest import plan_of, rows

PRODUCT = "id long, price long, original_price long, discount long, discount_rate int, category_id int, is_active boolean, crawl_date date"


def products(spark, n, day=1, step=1):
    data = [(k, k % 7, 9, 9 - k % 7, 5, k % 3, True, date(2024, 1, day)) for k in range(0, n, step)]
    return spark.createDataFrame(data, PRODUCT)


@pytest.fixture
def bucketed(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    frames = {"state": products(spark, 60), "batch": products(spark, 90, 2, 3)}
    frames["daily"] = frames["state"].unionByName(frames["batch"])
    for name, df in frames.items():
        bucketed_table(df, f"plans_{name}", str(tmp_path / name), "id", 4)
    yield frames, {name: spark.table(f"plans_{name}") for name in frames}
    drop_tables(spark, [f"plans_{name}" for name in frames], really=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_merges_and_changes_of_bucketed_tables_shuffle_nothing(bucketed):
    plain, stored = bucketed
    merged = upsert(stored["state"], stored["batch"], on_duplicate="unique")
    changed = detect_changes(stored["batch"], stored["state"])
    for found, expected in (
        (merged, upsert(plain["state"], plain["batch"], on_duplicate="unique")),
        (changed, detect_changes(plain["batch"], plain["state"])),
    ):
        assert "Exchange" not in plan_of(found) and "SortMergeJoin" in plan_of(found)
        assert rows(found) == rows(expected)


def test_replay_of_a_bucketed_table_shuffles_nothing_of_its_size(bucketed):
    plain, stored = bucketed
    log, state = change_log(stored["daily"]), replay_state(stored["daily"], full_snapshot=False)
    for found, expected in ((log, change_log(plain["daily"])), (state, replay_state(plain["daily"], full_snapshot=False))):
        assert "Exchange" not in plan_of(found)
        assert rows(found) == rows(expected)


def test_counts_and_extremes_come_from_footers(spark, tmp_path):
    products(spark, 50).repartition(3).write.parquet(str(tmp_path / "t"))
    option = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(option)
    counted = footer_counts(spark, {"t": str(tmp_path / "t")}, "id")
    assert rows(counted) == [("t", 50, 0, 49)] and spark.conf.get(option) == before
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in counted._jdf.queryExecution().toString()
    assert rows(footer_counts(spark, {"t": str(tmp_path / "t")})) == [("t", 50)]


def test_a_deep_page_sorts_its_ranges_only(spark):
    frame = spark.range(10_000).withColumn("v", F.xxhash64("id"))
    found = deep_page(frame, ["v"], 225, 40, ranges=20)
    assert [r.v for r in found.collect()] == [r.v for r in frame.orderBy("v").offset(224 * 40).limit(40).collect()]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    offset = int(re.search(r"Offset (\d+)", plan)[1])
    # the page begins inside one range of twenty
    assert "Filter" in plan and offset < 10_000 / 5
