"""Cube decoding: list and object forms, sparse and dense, one chunk and many."""

import itertools
import json

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from landing_files import category, document

from pyspark.sql import functions as F

from tierwell.sources import cube

EXAMPLE = {
    "id": ["Region", "Drivmedel", "Tid"], "size": [2, 2, 1],
    "dimension": {
        "Region": {"category": {"index": {"0114": 1, "00": 0}, "label": {"00": "R", "0114": "M"}}},
        "Drivmedel": {"category": {"index": ["100", "120"], "label": {"100": "a", "120": "b"}}},
        "Tid": {"category": {"index": {"2024M01": 0}, "label": {"2024M01": "2024M01"}}},
    },
    "value": {"0": 1, "3": 4},
}
NAMES = ["Region", "Drivmedel", "Tid"]


def documents(spark, *payloads):
    return spark.createDataFrame([(f"f{i}.json", json.dumps(p)) for i, p in enumerate(payloads)],
                                 "_source_file string, value string")


def by_hand(payload, labelled):
    axes = []
    for name in payload["id"]:
        index = payload["dimension"][name]["category"]["index"]
        axes.append(sorted(index, key=index.get) if isinstance(index, dict) else index)
    for position, codes in enumerate(itertools.product(*axes)):
        value = payload["value"]
        cell = value.get(str(position)) if isinstance(value, dict) else value[position]
        row = {"value": None if cell is None else str(cell)}
        for name, code in zip(payload["id"], codes):
            row[name] = code
            if name in labelled:
                row[f"{name}_label"] = payload["dimension"][name]["category"]["label"][code]
        yield row


def test_sparse_document_with_unordered_index(spark):
    flat = cube.flatten(documents(spark, EXAMPLE), NAMES, ["Region"])
    assert flat.columns == ["_source_file", "Region", "Region_label", "Drivmedel", "Tid", "value"]
    assert rows(flat, "Region", "Region_label", "Drivmedel", "value") == sorted(
        [("00", "R", "100", "1"), ("00", "R", "120", None), ("0114", "M", "100", None), ("0114", "M", "120", "4")], key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_any_document_matches_the_product_of_its_members(spark, data):
    sizes = [data.draw(st.integers(1, 4)) for _ in NAMES]
    order = data.draw(st.permutations(NAMES))
    axes = [(name, category([f"{name[0]}{i:02d}" for i in range(size)], as_object=data.draw(st.booleans())))
            for name, size in zip(order, sizes)]
    cells = sizes[0] * sizes[1] * sizes[2]
    value = data.draw(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=cells, max_size=cells))
    if data.draw(st.booleans()):
        value = {str(i): v for i, v in reversed(list(enumerate(value))) if v is not None}
    payload = document(axes, value)
    flat = cube.flatten(documents(spark, payload), NAMES, ["Tid"], chunk_cells=data.draw(st.integers(1, 9)))
    wanted = [tuple(row[c] for c in flat.columns[1:]) for row in by_hand(payload, ["Tid"])]
    assert rows(flat, *flat.columns[1:]) == sorted(wanted, key=repr)


def test_large_document_is_cut_into_chunks(spark):
    size = 300
    payload = document([("Region", category([f"{i:04d}" for i in range(size)])),
                        ("Drivmedel", category([f"{i:03d}" for i in range(size)]))], list(range(size * size)))
    flat = cube.flatten(documents(spark, payload), ["Region", "Drivmedel"], chunk_cells=10_000)
    assert flat.count() == size * size
    wrong = flat.where("cast(value as int) <> cast(Region as int) * 300 + cast(Drivmedel as int)")
    assert wrong.isEmpty()


def test_empty_and_all_null_vectors(spark):
    empty = document([("Region", category(["a", "b"])), ("Drivmedel", category([])), ("Tid", category(["t"]))], [])
    nothing = document([("Region", category(["a", "b"])), ("Drivmedel", category(["x"])), ("Tid", category(["t"]))], {})
    flat = cube.flatten(documents(spark, empty, nothing), NAMES)
    assert rows(flat, "_source_file", "Region", "value") == [("f1.json", "a", None), ("f1.json", "b", None)]


def test_size_report_is_per_file(spark):
    short, long = json.loads(json.dumps(EXAMPLE)), json.loads(json.dumps(EXAMPLE))
    short["value"], long["value"] = [1, 2, 3], [1, 2, 3, 4, 5]
    docs = documents(spark, EXAMPLE, short, long)
    report = cube.size_report(cube.outline(docs), cube.flatten(docs, NAMES))
    assert rows(report) == [("f0.json", 4, 4), ("f1.json", 4, 3), ("f2.json", 4, 5)]


def test_unexpected_dimensions_and_members(spark):
    docs = documents(spark, EXAMPLE)
    assert cube.unexpected_dimensions(cube.outline(docs), ["Tid", "Region", "Drivmedel"]).isEmpty()
    assert rows(cube.unexpected_dimensions(cube.outline(docs), ["Tid", "Region"]), "_source_file") == [("f0.json",)]
    assert rows(cube.members(docs, "Region")) == [("00",), ("0114",)]


def test_malformed_json_fails(spark):
    broken = spark.createDataFrame([("f.json", '{"id": ["Region"')], "_source_file string, value string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        cube.flatten(broken, NAMES).collect()


def test_one_huge_document_is_parsed_once_and_expanded_by_several_tasks(spark, tmp_path):
    width = 10_000
    payload = dict(EXAMPLE, size=[2, 2, width], value=list(range(4 * width)), dimension=dict(
        EXAMPLE["dimension"], Tid={"category": {"index": [f"t{i}" for i in range(width)], "label": {}}}))
    text = documents(spark, payload, EXAMPLE)
    cube.parse(text).write.parquet(f"{tmp_path}/parsed")
    parsed = spark.read.parquet(f"{tmp_path}/parsed")
    cube.chunks(parsed, None, 2_500).write.parquet(f"{tmp_path}/chunks")
    pieces = spark.read.parquet(f"{tmp_path}/chunks")
    cells = cube.expand(cube.spread(pieces, 4), NAMES)
    assert pieces.count() == 17 and cells.where("_source_file = 'f0.json'").select(F.spark_partition_id()).distinct().count() > 1
    found = cells.where("_source_file = 'f0.json'").agg(F.count("*"), F.countDistinct("Region", "Drivmedel", "Tid"), F.sum(F.col("value").cast("long")))
    assert found.first()[:] == (4 * width, 4 * width, sum(range(4 * width)))
    corner = cells.where("Region = '0114' AND Drivmedel = '100' AND Tid = 't7'").first()
    assert corner.value == str(2 * width + 7)
    plan = cube.outline(parsed, None)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "value" not in plan.partition("ReadSchema")[2]
    assert rows(cube.outline(parsed, None), "declared_cells") == [(4,), (4 * width,)]
