"""Replay in one pass against a day-by-day loop, look-back in chunks, as-of reads."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.functions.dates import day
from lakeops.operators import history
from lakeops.operators.changes import detect_changes
from lakeops.operators.history import (
    as_of,
    change_log,
    replay_state,
    retain_last_n,
    version_log,
    with_previous,
)
from lakeops.operators.latest import first_by, latest_by
from lakeops.operators.merge import upsert
from lakeops.plans.recovery import daily_rows, plan_recovery, rebuild
from lakeops.plans.reports import daily_changes, price_moves
from tests.conftest import plan_of, rows

SCHEMA = (
    "id long, price long, original_price long, discount long, discount_rate int, "
    "category_id int, is_active boolean, crawl_date date"
)


def random_days(spark, seed: int, days: int = 6, ids: int = 25):
    chance = random.Random(seed)
    data = []
    for n in range(days):
        for key in range(ids):
            if chance.random() < 0.6:
                maybe = [None, 1, 2]
                data.append(
                    (key, chance.choice([1, 2]), chance.choice(maybe), chance.choice(maybe), chance.choice([1, 2]),
                     chance.choice([None, 1, 2, 3]), True, date(2024, 1, 1) + timedelta(n))
                )
    return spark.createDataFrame(data, SCHEMA).cache()


@pytest.mark.parametrize("seed, full_snapshot", [(1, True), (2, True), (3, False)])
def test_one_pass_replay_equals_the_daily_loop(spark, seed, full_snapshot):
    daily = random_days(spark, seed)
    scope = "category_id" if full_snapshot else None
    state, log = None, None
    for n in range(6):
        batch = daily.filter(F.col("crawl_date") == day(date(2024, 1, 1) + timedelta(n)))
        if state is None:
            state, log = batch, batch
        else:
            log = log.unionByName(detect_changes(batch, state))
            state = upsert(state, batch, snapshot_scope=scope)
        state, log = (spark.createDataFrame(df.collect(), SCHEMA) for df in (state, log))
    assert rows(change_log(daily)) == rows(log)
    assert rows(replay_state(daily, full_snapshot=full_snapshot)) == rows(state)


def test_as_of_the_last_day_is_the_active_state(spark):
    daily = random_days(spark, 4)
    now = as_of(daily, ["id"], ["crawl_date"], day("2024-12-31"), tie_break=[])
    assert rows(now) == rows(replay_state(daily, full_snapshot=False))


def hot_log(spark):
    """One key owns most rows; its chunks have gaps and a key may start late."""
    data = [(1, n * 3 % 7, date(2024, 1, 1) + timedelta(n * 2)) for n in range(150)]
    data += [(k, k + n, date(2024, 2, 1) + timedelta(n * 40)) for k in (2, 3) for n in range(4)]
    data += [(None, n, date(2024, 3, 1) + timedelta(n * 20)) for n in range(5)]
    return spark.createDataFrame(data, "id long, price long, crawl_date date")


@pytest.mark.parametrize("chunk", ["day", "month", "year"])
def test_look_back_in_chunks_equals_one_window(spark, chunk):
    log = hot_log(spark)
    whole = with_previous(log, ["id"], ["crawl_date"], ["price"])
    split = with_previous(log, ["id"], ["crawl_date"], ["price"], F.date_trunc(chunk, "crawl_date"))
    picked = ["id", "price", "crawl_date", "previous.price as p"]
    assert rows(split.selectExpr(*picked)) == rows(whole.selectExpr(*picked))


def test_chunked_moves_keep_rows_without_a_key(spark):
    moves = hot_log(spark).withColumn("name", F.lit("n"))
    assert rows(moves.filter("id is null")) != []
    assert rows(price_moves(moves, chunk=F.trunc("crawl_date", "month"))) == rows(price_moves(moves))


def test_split_look_back_shuffles_the_rows_once(spark):
    split = with_previous(hot_log(spark), ["id"], ["crawl_date"], ["price"], F.trunc("crawl_date", "month"))
    plan = plan_of(split.filter("price >= 0"))
    # the rows once, the tails by chunk, by key and back by chunk
    assert plan.count("Exchange hashpartitioning(id") <= 4


def test_latest_row_is_limited_before_the_shuffle(spark):
    plan = plan_of(latest_by(hot_log(spark).repartition(3), ["id"], ["crawl_date"]))
    partial, exchange = plan.rindex("Partial"), plan.index("Exchange hashpartitioning(id")
    assert "WindowGroupLimit" in plan and partial > exchange  # children print below their parents


def test_latest_and_first_keep_one_null_group(spark):
    log = hot_log(spark)
    assert rows(latest_by(log, ["id"], ["crawl_date"]), "id", "price") == [(None, 4), (1, 149 * 3 % 7), (2, 5), (3, 6)]
    assert rows(first_by(log, ["id"], ["crawl_date"]), "id", "price") == [(None, 0), (1, 0), (2, 2), (3, 3)]


def test_retention_keeps_whole_stamps(spark):
    daily = random_days(spark, 5)
    kept = retain_last_n(daily, "crawl_date", 2)
    assert {r[0] for r in rows(kept, "crawl_date")} == {date(2024, 1, 5), date(2024, 1, 6)}
    assert kept.count() == daily.filter("crawl_date >= '2024-01-05'").count()


def test_version_log_counts_rows(spark):
    data = [(1, date(2024, 1, 1), "a", datetime(2024, 1, 1, 1)), (2, date(2024, 1, 1), "a", datetime(2024, 1, 1, 2))]
    loaded = spark.createDataFrame(data, "id long, crawl_date date, source_file string, loaded_at timestamp")
    assert rows(version_log(loaded)) == [(date(2024, 1, 1), "a", datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2), 2)]


def raw_rows(spark):
    """Loads with a repeated day, padded names and a row without a key."""
    data = [
        (1, " a ", "b", 5, 1, 1, 7, date(2024, 1, 1), datetime(2024, 1, 1, 1)),
        (1, "a", "b", 6, 1, 1, 7, date(2024, 1, 1), datetime(2024, 1, 1, 9)),
        (1, "a", "b", 6, None, None, 7, date(2024, 1, 2), datetime(2024, 1, 2, 1)),
        (2, "c", "d", None, 1, 1, 7, date(2024, 1, 1), datetime(2024, 1, 1, 1)),
        (None, "x", "y", 1, 1, 1, 7, date(2024, 1, 2), datetime(2024, 1, 2, 1)),
    ]
    frame = spark.createDataFrame(
        data,
        "id long, name string, brand_name string, price long, discount_rate int, quantity_sold int, "
        "category_id int, crawl_date date, loaded_at timestamp",
    )
    return frame.withColumns(
        {"original_price": F.lit(9).cast("long"), "discount": F.lit(1).cast("long"), "is_active": F.lit(True)}
    )


def test_rebuild_cleans_and_deduplicates(spark):
    log, state = rebuild(raw_rows(spark))
    assert rows(log, "id", "name", "price", "crawl_date") == [
        (1, "a", 6, date(2024, 1, 1)),
        (1, "a", 6, date(2024, 1, 2)),  # the NULL discount rate became 0, a change
        (2, "c", 0, date(2024, 1, 1)),
    ]
    assert rows(state, "id", "is_active") == [(1, True), (2, False)]
    assert daily_rows(raw_rows(spark), to_date="2024-01-01").count() == 2


def test_recovery_plan_is_a_dry_run(spark):
    assert rows(plan_recovery(raw_rows(spark))) == [
        ("gold", date(2024, 1, 2), 3),
        ("replay", date(2024, 1, 1), 2),
        ("replay", date(2024, 1, 2), 1),
    ]
    assert plan_recovery(raw_rows(spark), from_date="2024-01-02", skip_gold=True).count() == 1


def test_daily_changes_counts_first_sightings(spark):
    raw = raw_rows(spark)
    log, _ = rebuild(raw)
    assert rows(daily_changes(log, raw)) == [(date(2024, 1, 1), 2, 2, 0, 0), (date(2024, 1, 2), 1, 0, 1, 0)]
