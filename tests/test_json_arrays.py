"""Arrays cut at any byte against a reader of whole files."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql.types import ArrayType, StructType

from lakeops.sources import files as sources
from lakeops.sources.json_arrays import Cutter, array_elements, deeper, outside_strings, pieces
from tests.conftest import rows

MORE = StructType().add("a", "long").add("b", "string")
RECORD = StructType().add("id", "long").add("name", "string").add("tags", ArrayType(MORE["b"].dataType)).add("more", MORE)


def made(n, seed=3):
    chance = random.Random(seed)
    odd = ['a "quoted" one', "back\\slash", "}{][,", '\\"}', "é€😀", "", "x,y", "\n\t", "}" * 5, '"', "\\", "\\\\}"]
    out = []
    for i in range(n):
        record = {"id": i, "name": "".join(chance.choice(odd) for _ in range(chance.randrange(4)))}
        if i % 3 == 0:
            record["tags"] = [chance.choice(odd) for _ in range(chance.randrange(3))]
        if i % 4 == 0:
            record["more"] = {"a": i, "b": chance.choice(odd)}
        out.append(record)
    return out


def as_tuple(r):
    more = r.get("more")
    return r["id"], r["name"], r.get("tags"), more and (more["a"], more["b"])


@pytest.mark.parametrize("size", [7, 16, 61, 200, 100_000])
def test_blocks_of_any_size_give_the_same_records(spark, tmp_path, size):
    whole = {"a.json": made(40), "b.json": made(3, 4), "c.json": [], "d.json": [{}], "e.json": made(25, 5)}
    for name, records in whole.items():
        text = json.dumps(records, indent=1 if name == "e.json" else None, ensure_ascii=name == "a.json")
        (tmp_path / name).write_text("\n " + text + "\n")
    (tmp_path / "object.json").write_text('{"id": 1, "name": "[1]"}')
    (tmp_path / "cut.json").write_text('[{"id": 7}, {"id": 8}, {"id"')
    (tmp_path / "string.json").write_text('[{"id": 7, "name": "not ended}]')
    (tmp_path / "blank.json").write_text(" \n")
    options = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        found = sources.read_json_arrays(spark, str(tmp_path), RECORD).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    by_file = {}
    for r in found:
        by_file.setdefault(r.file.rsplit("/", 1)[1], []).append((r.position, r.record))
    expected = {name: [as_tuple(r) if r else (None,) * 4 for r in records] for name, records in whole.items() if records}
    got = {name: [tuple(x if not hasattr(x, "asDict") else tuple(x) for x in r) for _, r in sorted(found, key=lambda p: p[0])] for name, found in by_file.items()}
    assert got == expected


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(made(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        elements = array_elements(spark, str(tmp_path))
        assert pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 3
        assert elements.count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_element_that_is_no_json_leaves_the_others(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id" 2}, 5, [6], {"id": "x", "name": "n"}, {"id": 3}]')
    found = sources.read_json_arrays(spark, str(tmp_path), RECORD).selectExpr("record.id", "record.name")
    assert rows(found) == [(None, "n"), (1, None), (3, None)]


def test_strings_are_blanked():
    assert outside_strings('a"b}\\"c"d', False) == ('a"_____"d', False)
    assert outside_strings("x", True) == ("_", True)
    assert deeper("[{]") == 1


def test_a_cutter_that_begins_inside_a_string():
    cutter = Cutter("f", 10, True, 2)
    got = [*cutter.cut('still a string", "b": 1'), *cutter.cut(', {"id": 2'), *cutter.cut("]"), *cutter.rest()]
    assert [(kind, text) for _, _, _, kind, text in got] == [(1, 'still a string", "b": 1}'), (0, ' {"id": 2}')]
