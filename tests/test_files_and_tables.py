"""Sources, sinks, the state table and the batch job on small files."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.history import change_log
from lakeops.plans import gold
from lakeops.plans.batch import run_all, run_batch, run_gold
from lakeops.plans.lake import Lake
from lakeops.plans.recovery import recover, recover_range
from lakeops.schema import product_schema
from lakeops.sinks import files, tables
from lakeops.sinks.state import StateTable
from lakeops.sources import catalog
from lakeops.sources import files as sources
from lakeops.sources.messages import decode, drain, file_messages, kafka_options
from querybook import io_queries
from tests.conftest import plan_of, rows


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id": 1, "price": 5}\n{"id": \n{"id": 2, "price": "x"}\n')
    read = sources.read_records(spark, str(tmp_path), corrupt="_bad")
    assert rows(read, "id", "price") == [(None, None), (1, 5), (2, None)]
    assert [r[2] for r in rows(read, "id", "price", "_bad")] == ['{"id": ', None, '{"id": 2, "price": "x"}']


def test_backfill_skips_other_roots_and_undated_files(spark, tmp_path):
    (tmp_path / "x_2024-01-01.json").write_text('\n [{"id": 1}, {"id": 2, "crawl_date": "2023-01-01"}]')
    (tmp_path / "x_2024-01-02.json").write_text('{"id": 3}')
    (tmp_path / "x.json").write_text('[{"id": 4}]')
    (tmp_path / "x_2024-01-03.json").write_text("[]")
    (tmp_path / "x_2024-01-04.json").write_text('[{"id": 7}, {"id": 8}, {"id"')
    broken = sources.broken_json_arrays(spark, str(tmp_path), product_schema())
    assert rows(broken.selectExpr("regexp_extract(file, '[^/]*$', 0) f", "text")) == [("x_2024-01-04.json", '[{"id": 7}, {"id": 8}, {"id"')]
    found = sources.read_backfill(spark, str(tmp_path))
    assert rows(found, "id", "crawl_date") == [(1, date(2024, 1, 1)), (2, date(2023, 1, 1))]


def test_shards_last_row_wins(spark, tmp_path):
    (tmp_path / "mock_1.json").write_text('[{"id": 1, "price": 1}, {"id": 1, "price": 2, "quantity_sold": {"value": 3}}]')
    (tmp_path / "mock_2.json").write_text('[{"id": 2, "price": 3, "quantity_sold": 4.0}, {"id": 3}]')
    loaded = sources.load_shards(spark, str(tmp_path))
    assert rows(loaded, "id", "price", "quantity_sold", "brand_name", "is_active") == [
        (1, 2, 3, "", True), (2, 3, 4, "", True), (3, 0, 0, "", True)
    ]


def test_csv_and_parquet_exports(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a, "b"', 1.5), (2, None, 2.5)], "id int, name string, rating double")
    files.write_csv(frame, str(tmp_path / "csv"), single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    assert rows(sources.read_csv(spark, str(tmp_path / "csv"))) == rows(frame)
    files.write_parquet(frame, str(tmp_path / "pq"), single_file=True)
    assert rows(sources.read_parquet(spark, str(tmp_path / "pq"))) == rows(frame)


def test_batch_overwrite_spares_other_days_and_stream_rows(spark, tmp_path):
    path = str(tmp_path / "bronze")

    def put(day, value, ingest="batch"):
        frame = spark.createDataFrame([(value, date.fromisoformat(day))], "v int, crawl_date date")
        files.write_bronze(frame, path, ingest)

    put("2024-01-01", 1)
    put("2024-01-02", 2)
    put("2024-01-02", 3, "stream-1")
    put("2024-01-02", 4)
    stored = spark.read.parquet(path)
    assert rows(stored, "v", "ingest") == [(1, "batch"), (3, "stream-1"), (4, "batch")]
    assert "PartitionFilters: [isnotnull(crawl_date" in plan_of(stored.filter("crawl_date = date'2024-01-02'"))


def test_kafka_options_carry_start_and_loss_tolerance():
    assert kafka_options("h:9092", "t", "earliest") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_messages_round_trip(spark):
    frame = spark.createDataFrame([(1, 5)], "id long, price long")
    messages = files.to_messages(frame, crawl_date="2024-01-01")
    assert rows(messages) == [("1", '{"id":1,"price":5,"crawl_date":"2024-01-01"}')]
    assert rows(decode(messages), "id", "price", "crawl_date") == [(1, 5, "2024-01-01")]


def test_drain_resumes_after_what_was_taken(spark, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def put(n):
        spark.createDataFrame([(str(n), json.dumps({"id": n}))], "key string, value string").write.mode("append").parquet(inbox)

    put(1)
    put(2)
    first = drain(file_messages(spark, inbox), str(tmp_path / "first"), checkpoint)
    put(3)
    second = drain(file_messages(spark, inbox), str(tmp_path / "second"), checkpoint)
    assert rows(sources.read_records(spark, first), "id") == [(1,), (2,)]
    assert rows(sources.read_records(spark, second), "id") == [(3,)]
    with pytest.raises(ValueError, match="no messages"):
        drain(file_messages(spark, inbox), str(tmp_path / "third"), checkpoint, must_have_rows=True)


class FakeFrame:
    def __init__(self):
        self.calls = []

    @property
    def write(self):
        return self

    def jdbc(self, **arguments):
        self.calls.append(arguments)


def test_jdbc_sink_passes_the_table_and_truncates():
    frame = FakeFrame()
    tables.jdbc_sink("jdbc:db", "t", {"user": "u"})(frame)
    tables.jdbc_sink("jdbc:db", "t", {"user": "u"}, mode="append")(frame)
    assert frame.calls == [
        {"url": "jdbc:db", "table": "t", "mode": "overwrite", "properties": {"user": "u", "truncate": "true"}},
        {"url": "jdbc:db", "table": "t", "mode": "append", "properties": {"user": "u"}},
    ]


def test_publish_feeds_every_sink_from_one_computation(spark, tmp_path):
    frame = spark.range(4).withColumn("n", F.rand())  # differs when computed twice
    tables.publish(frame, [tables.table_sink("dual", str(tmp_path / "a")), lambda df: df.write.parquet(str(tmp_path / "b"))])
    assert rows(spark.table("dual")) == rows(spark.read.parquet(str(tmp_path / "b")))
    tables.drop_tables(spark, ["dual"], really=True)


def test_create_replace_append_describe_drop(spark, tmp_path):
    tables.create_or_replace(spark.range(2), "replaced", str(tmp_path / "t"))
    tables.create_or_replace(spark.range(3).withColumn("x", F.lit("y")), "replaced", str(tmp_path / "t"))
    assert rows(spark.table("replaced")) == [(0, "y"), (1, "y"), (2, "y")]
    tables.append_table(spark.range(2), "appended", str(tmp_path / "appended"))
    tables.append_table(spark.range(2, 3), "appended")
    assert rows(spark.table("appended")) == [(0,), (1,), (2,)]
    assert rows(catalog.describe(spark, ["replaced"])) == [("replaced", "id", "bigint"), ("replaced", "x", "string")]
    names = ["replaced", "appended", "missing"]
    assert rows(tables.drop_tables(spark, names)) == [("appended", True), ("missing", False), ("replaced", True)]
    assert {"replaced", "appended"} <= set(catalog.list_tables(spark))
    tables.drop_tables(spark, names, really=True)
    assert rows(catalog.existing(spark, names), "present") == [(False,)] * 3
    tables.create_namespace(spark, "extra")
    assert "extra" in catalog.list_databases(spark)


STATE = "id long, price long, category_id int, is_active boolean"


def times(n):
    return [datetime(2024, 1, 1 + i) for i in range(n)]


def test_state_over_runs(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), StructType.fromDDL(STATE))
    assert state.is_empty() and state.read().count() == 0

    def batch(*data):
        return spark.createDataFrame(list(data), STATE)

    first, second, third, fourth, fifth = times(5)
    state.append(batch((1, 1, 1, True), (2, 2, 1, True), (3, 3, 2, True)), "a", first)
    state.append(batch((2, 99, 1, True), (5, 5, 1, True)), "b", second)
    state.append(batch((2, 20, 1, True), (4, 4, 1, True)), "b", second)  # the run is repeated
    assert rows(state.read(), "id", "price") == [(1, 1), (2, 20), (3, 3), (4, 4)]
    assert rows(state.read(first), "id", "price") == [(1, 1), (2, 2), (3, 3)]
    assert rows(state.read(without="b"), "id", "price") == [(1, 1), (2, 2), (3, 3)]
    assert rows(state.read(keys=batch((2, 0, 0, True), (9, 0, 0, True))), "id", "price") == [(2, 20)]

    state.append(batch((1, 1, 1, True)), "c", third, snapshot=True)
    assert rows(state.read(), "id", "is_active") == [(1, True), (2, False), (3, True), (4, False)]
    state.renew_base(third)
    assert rows(state.read(), "id", "is_active") == [(1, True), (2, False), (3, True), (4, False)]
    state.rollback(first, fourth)
    assert rows(state.read(), "id", "price") == [(1, 1), (2, 2), (3, 3)]
    assert rows(state.read(third), "id", "is_active") == [(1, True), (2, False), (3, True), (4, False)]
    assert rows(state.log(), "run", "row_count") == [("a", 3), ("b", 2), ("c", 1)]
    with pytest.raises(ValueError, match="no state"):
        state.rollback(datetime(2000, 1, 1))
    state.append(batch((9, 9, 9, True)), "d", fifth)
    assert rows(state.read(), "id") == [(1,), (2,), (3,), (9,)]


def test_two_loads_at_a_time_lose_nothing(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), StructType.fromDDL(STATE))
    at = datetime(2024, 1, 1)
    for key, run in ((1, "x"), (2, "y")):
        state.append(spark.createDataFrame([(key, key, 1, True), (7, key, 1, True)], STATE), run, at)
    assert rows(state.read(), "id", "price") == [(1, 1), (2, 2), (7, 2)]  # of equal times the later name


def product(key, price, category=1, **extra):
    record = {
        "id": key, "name": f" p{key} ", "brand_name": "B", "price": price, "original_price": 100, "discount": 100 - price,
        "discount_rate": 10, "rating_average": 4.0, "review_count": 20, "category_id": category,
        "category_name": f"c{category}", "quantity_sold": 5, "url_key": "u", "thumbnail_url": "t",
    }
    return {**record, **extra}


def write_day(folder, day, *records):
    path = folder / f"products_raw_{day}.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


def test_batch_job_end_to_end(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    paths = [
        write_day(tmp_path, "2024-01-01", product(1, 50), product(2, 60), product(3, 70, 2), product(1, 50)),
        write_day(tmp_path, "2024-01-02", product(1, 50), product(2, 55), product(None, 1)),
        write_day(tmp_path, "2024-01-03", product(1, 40), product(4, 10, 3)),
    ]
    made = run_all(spark, paths, lake)
    state = lake.state(spark).read()
    assert rows(state, "id", "price", "is_active", "name") == [
        (1, 40, True, "p1"), (2, 55, False, "p2"), (3, 70, True, "p3"), (4, 10, True, "p4")
    ]
    assert rows(lake.read_history(spark), "id", "price", "crawl_date") == [
        (1, 40, date(2024, 1, 3)), (1, 50, date(2024, 1, 1)), (2, 55, date(2024, 1, 2)),
        (2, 60, date(2024, 1, 1)), (3, 70, date(2024, 1, 1)), (4, 10, date(2024, 1, 3)),
    ]
    assert set(made) == {"brand_performance", "price_trend", "discount_analysis", "top_products", "daily_summary"}
    for name, df in made.items():
        assert rows(spark.table(f"gold_{name}")) == rows(df)

    target = Lake(str(tmp_path / "recovered"))
    plan = recover(spark, lake, target, dry_run=True)
    assert plan.count() == 4 and target.state(spark).is_empty()
    recover(spark, lake, target)
    assert rows(target.read_history(spark).drop("run")) == rows(lake.read_history(spark).drop("run"))
    assert rows(target.state(spark).read()) == rows(state)
    with pytest.raises(ValueError, match="no rows"):
        recover(spark, lake, target, from_date="2030-01-01")


def test_records_may_carry_their_own_date(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    path = str(tmp_path / "products_raw_2024-01-02.json")
    frame = spark.createDataFrame([(1, 5, "2024-01-01"), (1, 6, None), (2, 7, "soon")], "id long, price long, crawl_date string")
    files.write_ndjson(frame, path)
    run_batch(spark, path, lake, layer="bronze", own_dates=True)
    assert rows(lake.read_bronze(spark), "id", "price", "crawl_date") == [
        (1, 5, date(2024, 1, 1)), (1, 6, date(2024, 1, 2)), (2, 7, date(2024, 1, 2))
    ]


def test_batch_runs_can_be_repeated(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    first = write_day(tmp_path, "2024-01-01", product(1, 50))
    run_batch(spark, first, lake, run="one", loaded_at=datetime(2024, 1, 1))
    run_batch(spark, first, lake, run="one", loaded_at=datetime(2024, 1, 1))
    assert rows(lake.state(spark).log(), "run") == [("one",)]
    write_day(tmp_path, "2024-01-01", product(1, 45))
    run_batch(spark, first, lake, run="two", loaded_at=datetime(2024, 1, 1, 4))
    assert rows(lake.read_history(spark), "price", "run") == [(45, "two"), (50, "one")]
    assert rows(lake.read_bronze(spark), "price") == [(45,)]
    with pytest.raises(ValueError, match="unknown layer"):
        run_batch(spark, first, lake, layer="tin")
    with pytest.raises(ValueError, match="no rows"):
        run_batch(spark, write_day(tmp_path, "2024-01-09"), lake)
    with pytest.raises(ValueError, match="load a batch first"):
        run_gold(spark, Lake(str(tmp_path / "nothing")))


def lakes_agree(spark, lake, folder):
    """State and log of a lake and of its full recovery."""
    target = Lake(str(folder))
    recover(spark, lake, target, skip_gold=True)
    for read in (lambda x: x.state(spark).read(), lambda x: x.read_history(spark)):
        columns = ["id", "price", "is_active", "crawl_date"]
        assert rows(read(lake), *columns) == rows(read(target), *columns)


def three_days(folder):
    return [
        write_day(folder, "2024-01-01", product(1, 50), product(2, 60), product(3, 70, 2)),
        write_day(folder, "2024-01-02", product(1, 55), product(2, 60), product(4, 10)),
        write_day(folder, "2024-01-03", product(1, 55), product(3, 71, 2), product(5, 1)),
    ]


def test_a_repeated_day_forgets_what_no_longer_holds(spark, tmp_path):
    lake, paths = Lake(str(tmp_path / "lake")), three_days(tmp_path)
    for path in paths[:2]:
        run_batch(spark, path, lake)
    write_day(tmp_path, "2024-01-02", product(1, 50), product(2, 60))
    run_batch(spark, paths[1], lake)
    assert rows(lake.read_history(spark), "id", "crawl_date") == [(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (3, date(2024, 1, 1))]
    lakes_agree(spark, lake, tmp_path / "recovered")


@pytest.mark.parametrize("renewed", [False, True])
def test_days_loaded_again_and_out_of_order(spark, tmp_path, renewed):
    lake, paths = Lake(str(tmp_path / "lake")), three_days(tmp_path)
    for hour, n in enumerate((0, 2, 1), 1):
        run_batch(spark, paths[n], lake, loaded_at=datetime(2024, 2, 1, hour))
        if renewed:
            lake.state(spark).renew_base(datetime(2024, 2, 1, hour, 30))
    lakes_agree(spark, lake, tmp_path / "recovered")
    # the first day again: a price that the second day then no longer changes, a product gone, one more
    write_day(tmp_path, "2024-01-01", product(1, 55), product(3, 70, 2), product(6, 6))
    run_batch(spark, paths[0], lake, loaded_at=datetime(2024, 2, 2))
    lakes_agree(spark, lake, tmp_path / "again")
    assert rows(lake.state(spark).read(), "id", "is_active") == [(1, True), (2, False), (3, True), (4, False), (5, True), (6, False)]


@pytest.mark.parametrize(("low", "high"), [(1, 1), (2, 2), (1, 2), (3, 3), (2, 3), (1, 3)])
def test_a_range_is_put_back_among_the_other_days(spark, tmp_path, low, high):
    lake, paths = Lake(str(tmp_path / "lake")), three_days(tmp_path)
    for n, path in enumerate(paths):
        run_batch(spark, path, lake, loaded_at=datetime(2024, 2, 1, n + 1))
    for day in range(low, high + 1):
        changed = write_day(tmp_path, f"2024-01-{day:02d}", product(1, 55), product(2, 60 + day), product(7, day, 2))
        run_batch(spark, changed, lake, layer="bronze", loaded_at=datetime(2024, 2, 2, day))
    whole, part = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "part"))
    recover(spark, lake, whole, skip_gold=True)
    plan = recover_range(spark, lake, part, f"2024-01-{low:02d}", f"2024-01-{high:02d}", skip_gold=True)
    assert plan.count() == high - low + 1
    for read in (lambda x: x.state(spark).read(), lambda x: x.read_history(spark).drop("run")):
        assert rows(read(part), "id", "price", "is_active", "crawl_date") == rows(read(whole), "id", "price", "is_active", "crawl_date")


def test_older_copies_of_a_replaced_table_go(spark, tmp_path):
    for n in range(4):
        tables.create_or_replace(spark.range(n), "often_replaced", str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("copy-*"))) == 2 and spark.table("often_replaced").count() == 3
    with pytest.raises(ValueError, match="has to stay"):
        tables.create_or_replace(spark.range(1), "often_replaced", str(tmp_path / "t"), keep=0)
    tables.drop_tables(spark, ["often_replaced"], really=True)


def test_bases_expire_and_later_states_stay(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), StructType.fromDDL(STATE), buckets=4)
    moments = times(6)
    for n, at in enumerate(moments):
        state.append(spark.createDataFrame([(n, n, 1, True), (99, n, 1, True)], STATE), f"r{n}", at)
        if n % 2:
            state.renew_base(at)
    before = [rows(state.read(at)) for at in moments[3:]]
    assert len(state.bases()) == 3
    gone = state.expire(2)
    assert len(state.bases()) == 2 and any("hour=" in f for f in gone) and state.expire(2) == []
    assert [rows(state.read(at)) for at in moments[3:]] == before
    with pytest.raises(ValueError, match="has to stay"):
        state.expire(0)


def test_reads_by_keys_open_their_buckets_and_the_hours_since_the_base(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"), StructType.fromDDL(STATE), buckets=8)
    keys = spark.createDataFrame([(5,)], "id long")

    def files_of_an_epoch():
        return len(state.read(keys=keys).inputFiles()), plan_of(state.read(keys=keys))

    opened = []
    for n, at in enumerate(times(8)):
        state.append(spark.createDataFrame([(k, n, 1, True) for k in range(40)], STATE).coalesce(1), f"r{n}", at)
        if n % 2:
            state.renew_base(at)
            opened.append(files_of_an_epoch())
    assert len({count for count, _ in opened}) == 1
    assert "PartitionFilters: [isnotnull(bucket" in opened[-1][1] or "PartitionFilters: [bucket" in opened[-1][1]
    assert rows(state.read(keys=keys), "id", "price") == [(5, 7)]


def test_loads_that_were_rolled_back_stay_out_of_what_follows(spark, tmp_path):
    lake, paths = Lake(str(tmp_path / "lake")), three_days(tmp_path)
    for n, path in enumerate(paths):
        run_batch(spark, path, lake, loaded_at=datetime(2024, 2, 1, n + 1))
    state = lake.state(spark)
    state.rollback(datetime(2024, 2, 1, 2, 30), datetime(2024, 2, 1, 5))
    assert {r[0] for r in rows(state.read(), "id")} == {1, 2, 3, 4}
    write_day(tmp_path, "2024-01-01", product(1, 1))
    run_batch(spark, paths[0], lake, loaded_at=datetime(2024, 2, 1, 6))
    assert rows(state.read(), "id", "price") == [(1, 55), (2, 60), (3, 70), (4, 10)]
    logged = rows(lake.read_history(spark).filter("run <> 'batch-2024-01-03'"), "id", "price", "run")
    assert logged == [(1, 1, "batch-2024-01-01"), (1, 55, "batch-2024-01-02"), (2, 60, "batch-2024-01-02"), (4, 10, "batch-2024-01-02")]


def test_counting_ids_equals_distinct_ids_on_a_state(spark):
    state = spark.createDataFrame([product(n, n + 1, n % 3, is_active=n % 2 == 0, crawl_date=date(2024, 1, 1)) for n in range(30)])
    for table in (gold.brand_performance, gold.discount_analysis):
        assert rows(table(state, unique_ids=True)) == rows(table(state, unique_ids=False))
    assert gold.brand_performance(state, active_only=True).agg(F.sum("total_products")).first()[0] == 15
    assert gold.top_products(state, n=5).count() == 5


def test_change_log_can_see_nulls(spark):
    data = [(1, None, date(2024, 1, 1)), (1, 5, date(2024, 1, 2)), (1, 5, date(2024, 1, 3))]
    daily = spark.createDataFrame(data, "id long, price long, crawl_date date")
    assert change_log(daily, tracked=["price"]).count() == 1
    assert change_log(daily, tracked=["price"], null_safe=True).count() == 2


def test_records_of_a_job_are_packed(spark, tmp_path):
    frame = spark.range(3000).select("id", F.concat(F.lit("a name "), "id").alias("name"), (F.col("id") * 7).alias("price"))
    files.write_ndjson(frame, f"{tmp_path}/products_raw_2024-01-01.json", compression="lz4")
    names = [p.name for p in (tmp_path / "products_raw_2024-01-01.json").glob("part-*")]
    assert names and all(n.endswith(".lz4") for n in names)
    back = sources.read_records(spark, f"{tmp_path}/products_raw_2024-01-01.json").select("id", "name", "price")
    assert rows(back) == rows(frame)


def test_dated_files_are_packed(spark, tmp_path):
    for name, columns in (("lineitem", LINE), ("part", PART)):
        spark.range(1, 50).selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    _, paths = io_queries.dated_files(spark, str(tmp_path), "packed")
    read = [sources.read_records(spark, path) for path in paths]
    assert sum(r.count() for r in read) == 49
    assert all(f.endswith(".lz4") for r in read for f in r.inputFiles())


LINE = [
    "id l_partkey", "id l_orderkey", "cast(1 as int) l_linenumber", "id l_suppkey", "cast(id as double) l_extendedprice",
    "0.05D l_tax", "0.1D l_discount", "2D l_quantity", "timestamp_ntz'1995-01-02' + make_interval(cast(id % 6 as int)) l_shipdate",
]
PART = ["id p_partkey", "concat('n ', id) p_name", "'Brand#1' p_brand", "cast(id % 9 as int) p_size", "'PROMO' p_type"]
