"""The stream job: batch equivalence, quarantine, restart, repeated epochs."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest

from lakeops.plans.lake import Lake
from lakeops.schema import event_schema
from lakeops.sources.messages import decode, file_messages
from lakeops.streaming.micro_batch import medallion_handler
from lakeops.streaming.run import start
from querybook import stream_queries
from tests.conftest import rows

ORDER = {"order": ["event_id"], "event_only": ["event_id"], "error": "_error"}


def make_events(count: int = 120):
    chance = random.Random(7)
    made = []
    for n in range(count):
        event = {
            "event_id": n, "id": chance.randrange(12), "name": " n ", "price": chance.choice([1, 2, 3]),
            "discount_rate": chance.choice([1, 2]), "quantity_sold": n, "crawl_date": "2024-01-01",
            "_event_type": chance.choice(["PING", "PURCHASE"]),
        }
        if n % 10 == 0:
            event["is_active"] = False
        made.append(event)
    return made


def send(spark, inbox, events, extra=()):
    messages = [(str(e["id"]), json.dumps(e)) for e in events] + [("x", text) for text in extra]
    spark.createDataFrame(messages, "key string, value string").write.mode("append").parquet(inbox)


def run(spark, root, lake, **options):
    parsed = decode(file_messages(spark, f"{root}/in"), event_schema({"event_id": "long"}), error="_error")
    start(parsed, medallion_handler(lake, **{**ORDER, **options}), f"{root}/checkpoint", every=None).awaitTermination()


def expected(events, splits):
    """State and log by a plain loop over the batches."""
    state, log = {}, []
    size = len(events) // splits
    for n in range(splits):
        latest = {e["id"]: e for e in events[n * size : (n + 1) * size]}
        for key, event in latest.items():
            old = state.get(key)
            if old is None or (old["price"], old["discount_rate"]) != (event["price"], event["discount_rate"]):
                log.append((key, event["price"], n))
            state[key] = event
    return sorted((k, e["price"], e.get("is_active", True)) for k, e in state.items()), sorted(log)


@pytest.mark.parametrize("splits", [1, 3])
def test_stream_equals_batch_by_batch_loop(spark, tmp_path, splits):
    events, lake = make_events(), Lake(str(tmp_path / "lake"))
    size = len(events) // splits
    for n in range(splits):
        send(spark, f"{tmp_path}/in", events[n * size : (n + 1) * size], extra=["{broken"] if n == 0 else [])
        run(spark, tmp_path, lake)
    state, log = expected(events, splits)
    assert rows(lake.state(spark).read(), "id", "price", "is_active") == sorted(state, key=lambda r: str(r[0]))
    history = lake.read_history(spark).selectExpr("id", "price", "cast(substring_index(run, '-', -1) as int) n")
    assert sorted(map(tuple, history.collect())) == log
    assert spark.read.parquet(lake.speed).count() == len(events)
    assert rows(spark.read.parquet(lake.quarantine), "_error") == [("{broken",)]
    assert lake.read_bronze(spark).select("id", "ingest").distinct().count() == lake.read_bronze(spark).count()


def test_failed_epoch_is_repeated_without_duplicates(spark, tmp_path):
    events = make_events()
    lakes = {}
    for label, failing in (("plain", False), ("failing", True)):
        root = tmp_path / label
        lakes[label] = lake = Lake(str(root / "lake"))
        for n in range(2):
            send(spark, f"{root}/in", events[n * 60 : n * 60 + 60])
            if failing and n == 1:

                def fail(epoch):
                    raise RuntimeError("lost after the writes")

                with pytest.raises(Exception, match="lost after the writes"):
                    run(spark, root, lake, before_last=fail)
                assert lake.state(spark).log().count() == 1
            run(spark, root, lake)
    plain, failing = lakes["plain"], lakes["failing"]
    columns = ["id", "price", "discount_rate", "is_active"]
    assert rows(plain.state(spark).read(), *columns) == rows(failing.state(spark).read(), *columns)
    assert rows(plain.read_history(spark), "id", "price", "run") == rows(failing.read_history(spark), "id", "price", "run")
    assert rows(plain.read_bronze(spark), "id", "price", "ingest") == rows(failing.read_bronze(spark), "id", "price", "ingest")
    assert spark.read.parquet(failing.speed).count() == len(events)


def test_repeated_epoch_changes_nothing(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    handler = medallion_handler(lake, **ORDER)
    message = spark.createDataFrame([("1", json.dumps(make_events(1)[0]))], "key string, value string")
    full = decode(message, event_schema({"event_id": "long"}), error="_error")
    handler(full, 0)
    handler(full, 0)
    handler(full.limit(0), 1)
    assert lake.state(spark).log().count() == 1
    assert lake.state(spark).read().count() == lake.read_history(spark).count() == 1


def test_an_order_is_asked_for(tmp_path):
    with pytest.raises(ValueError, match="order"):
        medallion_handler(Lake(str(tmp_path)), order=[])


def test_falling_prices_by_message_time(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    sent = [(n, {"id": 1, "price": price, "quantity_sold": {"value": n}}) for n, price in enumerate([100, 70, 50])]
    messages = spark.createDataFrame(
        [("1", json.dumps(e), 0, n, datetime(2024, 1, 1, 0, 0, n // 2)) for n, e in sent],
        "key string, value string, partition int, offset long, timestamp timestamp",
    )
    medallion_handler(lake, ["_timestamp", "_offset"])(decode(messages), 0)
    assert rows(lake.state(spark).read(), "price", "quantity_sold") == [(50, 2)]
    assert "_offset" not in lake.state(spark).read().columns


def decoded(spark, *events):
    messages = spark.createDataFrame([("1", json.dumps(e)) for e in events], "key string, value string")
    return decode(messages, event_schema({"event_id": "long"}), error="_error")


def test_a_renewed_base_changes_nothing(spark, tmp_path):
    plain, renewed = Lake(str(tmp_path / "plain")), Lake(str(tmp_path / "renewed"))
    events = make_events(10)
    for lake in (plain, renewed):
        handler = medallion_handler(lake, **ORDER)
        for epoch in range(5):
            handler(decoded(spark, *events[2 * epoch : 2 * epoch + 2]), epoch)
            if lake is renewed and epoch % 2:
                lake.state(spark).renew_base(datetime.now())
    assert rows(renewed.state(spark).read(), "id", "price") == rows(plain.state(spark).read(), "id", "price")
    assert rows(renewed.read_history(spark), "id", "price", "run") == rows(plain.read_history(spark), "id", "price", "run")


def test_an_epoch_of_broken_messages_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    handler = medallion_handler(lake, **ORDER)
    broken = decode(spark.createDataFrame([("x", "{oops")], "key string, value string"), event_schema({"event_id": "long"}), error="_error")
    handler(broken, 0)
    handler(decoded(spark, make_events(1)[0]), 1)
    handler(broken, 2)
    assert rows(lake.state(spark).read(), "id") == [(make_events(1)[0]["id"],)]
    assert lake.read_history(spark).count() == 1
    assert spark.read.parquet(lake.quarantine).count() == 2


def test_older_events_do_not_overwrite_newer_state(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), extra=(("event_id", "long"),))
    seen = []
    handler = medallion_handler(lake, order=["event_id"], newer_by="event_id", error="_error", speed_sinks=[lambda df: seen.append(df.count())])
    events = [{**e, "id": 1, "price": 100 + e["event_id"]} for e in make_events(6)]

    def batch(*picked):
        messages = spark.createDataFrame([("1", json.dumps(events[n])) for n in picked], "key string, value string")
        return decode(messages, event_schema({"event_id": "long"}), error="_error")

    handler(batch(3, 2), 0)
    handler(batch(0, 1), 1)
    assert rows(lake.state(spark).read(), "price") == [(103,)]
    assert rows(lake.read_history(spark), "price") == [(103,)]
    handler(batch(5), 2)
    assert rows(lake.state(spark).read(), "price") == [(105,)]
    assert seen == [2, 2, 1]


def test_an_epoch_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "MESSAGES", 10)
    fields = ["id event_id", "id % 5 user_id", "'click' event_type", "cast(id as double) value", "'{\"k\": 3}' props"]
    events = spark.range(100).selectExpr(*fields, "timestamp_ntz'2024-01-02' ts").coalesce(1)
    events.write.parquet(f"{tmp_path}/events.parquet")
    stream_queries.send(spark, str(tmp_path), f"{tmp_path}/in", 0)
    sent = spark.read.parquet(f"{tmp_path}/in")
    assert sent.count() == 100 and len(sent.inputFiles()) == 10


def test_counters_of_all_shapes(spark):
    texts = ['4', '"5"', '{"value":6}', '" {\\"value\\": 7}"', '{"other":8}', '"nine"', 'null']
    messages = spark.createDataFrame([(f'{{"id":{n},"quantity_sold":{t}}}',) for n, t in enumerate(texts)], "value string")
    found = dict(decode(messages).select("id", "quantity_sold").collect())
    assert found == {0: 4, 1: 5, 2: 6, 3: 7, 4: None, 5: None, 6: None}
    plan = decode(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan or "contains(" in plan.lower()  # a plain number is not parsed a second time
