"""Plans, logs, streams and words."""

import datetime

import pytest

from terrazzo.operators import words
from terrazzo.plans import documents
from terrazzo.streaming import logs


def pixels(spark):
    rows = [(0, 0, 220, 30, 30), (0, 1, 30, 50, 220), (0, 2, 120, 120, 120), (0, 3, 171, 171, 171)]
    return spark.createDataFrame(rows, "y int, x int, r int, g int, b int")


def test_plan_compiles_layers(spark):
    plan = {
        "layers": [
            {"id": "zones", "kind": "categorical", "legend": [{"rgb": [220, 30, 30]}, {"rgb": [[30, 50, 220], [20, 40, 200]]}], "max_distance": 5, "min_margin": 1},
            {"id": "greys", "kind": "grayscale_categorical", "legend": [{"gray": 171}, {"gray": 120}], "exclude_layers": ["zones"]},
            {"id": "ink", "kind": "feature_ink", "low": [85, 60, 55], "high": [125, 255, 255]},
            {"id": "heat", "kind": "continuous", "stops": [{"value": 0, "rgb": [0, 0, 0]}, {"value": 100, "rgb": [255, 255, 255]}], "max_residual": 3},
        ]
    }
    out = documents.compile_plan(plan, pixels(spark))
    at = lambda name, c="class_id": {r["x"]: r[c] for r in out[name].collect()}
    assert at("zones") == {0: 1, 1: 2, 2: 0, 3: 0}
    assert at("greys") == {2: 2, 3: 1}
    assert at("ink") == {1: 1}
    heat = at("heat", "value")
    assert heat[0] is None and heat[2] == pytest.approx(100 * 120 / 255)
    with pytest.raises(ValueError):
        documents.compile_plan({"layers": [{"id": "a", "kind": "none"}]}, pixels(spark))


def event(m, n, phase, ok, decision):
    return (m, n, phase, {"g": ok}, decision, datetime.datetime(2024, 1, 1, 0, n))


EVENTS = [event("a", 1, "alignment", True, "accept"), event("a", 2, "extraction", False, "accept"), event("a", 3, "extraction", True, "accept"), event("b", 1, "alignment", True, "accept"), event("b", 2, "extraction", False, "block")]


def test_log_state(spark):
    events = spark.createDataFrame(EVENTS + EVENTS[:1], logs.SCHEMA)
    got = {r["map"]: (r["attempts"], r["phases"], r["status"]) for r in logs.state(events).collect()}
    assert got == {"a": (3, ["alignment", "extraction"], "complete"), "b": (2, ["alignment"], "blocked")}
    manifest = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "seq int, map string")
    assert [r["map"] for r in logs.resumable(manifest, events).collect()] == ["c"]


def test_stream_appends_each_event_once(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for k, part in enumerate((EVENTS[:3], EVENTS[2:], EVENTS)):
        spark.createDataFrame(part, logs.SCHEMA).coalesce(1).write.mode("append").parquet(source)
        q = logs.follow(spark.readStream.schema(logs.SCHEMA).parquet(source), sink, str(tmp_path / "checkpoint"))
        q.awaitTermination()
        assert spark.read.parquet(sink).count() == (3, 5, 5)[k]
    assert logs.state(spark.read.parquet(sink)).filter("status = 'complete'").count() == 1


def test_greedy_words(spark):
    df = spark.createDataFrame([("p", "River", 10, 10, 20, 8, 90.0), ("p", "river", 12, 11, 20, 8, 80.0), ("p", "River", 60, 10, 20, 8, 70.0), ("q", "x", 0, 0, 1, 1, 5.0)], "page string, text string, left int, top int, width int, height int, conf double")
    kept = words.greedy(df, "page", ["-conf", "top", "left"], words.same_word(5))
    assert sorted((r["page"], r["left"]) for r in kept.collect()) == [("p", 10), ("p", 60), ("q", 0)]


def test_label_lines_and_points(spark):
    df = spark.createDataFrame([("p", 1, "Very", 0, 0, 9, 5), ("p", 1, "High,", 10, 0, 9, 5), ("p", 1, "Zone", 20, 0, 9, 5)], "page string, line int, text string, left int, top int, width int, height int")
    got = words.label_lines(df, "page", "line", "high zone").collect()
    assert [(r["left"], r["right"]) for r in got] == [(10, 29)]
    legend = spark.createDataFrame([("l", i, t) for i, t in enumerate(["1.5", "2.0", "25", "3.5", "40"])], "legend string, i int, text string")
    assert [r["text"] for r in words.restore_points(legend, "legend", "i", "text").orderBy("i").collect()] == ["1.5", "2.0", "2.5", "3.5", "4.0"]
    mixed = spark.createDataFrame([("l", i, t) for i, t in enumerate(["1.5", "2.0", "15", "3.5"])], "legend string, i int, text string")
    assert [r["text"] for r in words.restore_points(mixed, "legend", "i", "text").orderBy("i").collect()] == ["1.5", "2.0", "15", "3.5"]


def test_falling_column(spark):
    df = spark.createDataFrame([("p", str(v), 10, 10 * k, 8, 5) for k, v in enumerate([50, 40, 30, 35, 20])] + [("p", "x", 10, 90, 8, 5)], "page string, text string, left int, top int, width int, height int")
    got = words.falling_column(df, "page").first()
    assert (got["n"], got["first"], got["last"]) == (3, 50.0, 30.0)
