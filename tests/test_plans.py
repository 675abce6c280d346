from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quire.functions import html as ht
from quire.functions import hooks
from quire.plans import catalogue, runner
from quire.sources import io
from quire.streaming import events as ev


def double(inputs, params):
    (df,) = inputs.values()
    return df.withColumn("n", F.col("n") * params["by"])


REGISTRY = {
    "load": runner.Module(lambda i, p: i["numbers"], produces=("n",)),
    "double": runner.Module(double, {"by": {"type": "integer", "default": 2, "minimum": 1}}, requires=("n",), produces=("n",)),
}


def test_run_and_resume(spark, tmp_path):
    stages = [{"id": "b", "module": "double", "needs": ["a"], "params": {"by": 3}}, {"id": "a", "module": "load"}]
    src = {"numbers": spark.range(3).select(F.col("id").alias("n"))}
    reg = {**REGISTRY, "double": runner.Module(lambda i, p: double({"a": i["a"]}, p), REGISTRY["double"].params, ("n",), ("n",))}
    out = runner.run(spark, stages, reg, src, str(tmp_path))
    assert sorted(r.n for r in out["b"].collect()) == [0, 3, 6]
    assert json.loads((tmp_path / "state.json").read_text()) == {"a": "done", "b": "done"}
    again = runner.run(spark, stages, reg, {"numbers": src["numbers"].limit(0)}, str(tmp_path))
    assert again["b"].count() == 3
    assert runner.downstream(stages, "a") == ["a", "b"]


def test_bad_recipes():
    with pytest.raises(runner.PlanError, match="cycle"):
        runner.order_stages([{"id": "a", "module": "load", "needs": ["b"]}, {"id": "b", "module": "load", "needs": ["a"]}])
    with pytest.raises(runner.PlanError, match="unknown parameters"):
        runner.merge_params({}, {"x": 1})
    with pytest.raises(runner.PlanError, match="bounds"):
        runner.merge_params(REGISTRY["double"].params, {"by": 0})
    with pytest.raises(runner.PlanError, match="does not produce"):
        bad = {**REGISTRY, "load": runner.Module(lambda i, p: i["numbers"], produces=("m",))}
        runner.validate([{"id": "a", "module": "load"}, {"id": "b", "module": "double", "needs": ["a"]}], bad)


def test_jsonl_round_trip_and_envelope(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.createDataFrame([(1, "a", None), (2, "b", "boom")], "n int, s string, error string")
    io.write_jsonl(df, path)
    io.write_jsonl(df, path, append=True)
    back = io.stamp(io.read_jsonl(spark, path, "n int, s string, error string"), "rows_v1", run_id="r")
    assert back.count() == 2 and {r.schema_version for r in back.collect()} == {"rows_v1"}
    (tmp_path / "index.json").write_text(json.dumps({"001": "a.html", "002": "b.html"}))
    assert {(r.page, r.path) for r in io.read_index(spark, str(tmp_path / "index.json")).collect()} == {("001", "a.html"), ("002", "b.html")}


def test_event_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [("2024-01-01T00:00:00Z", "r", "ocr", "running", 1), ("2024-01-01T00:01:00Z", "r", "ocr", "done", 9), ("2024-01-01T00:02:00Z", "r", "ocr", "warning", 9), ("2024-01-01T00:00:00Z", "r", "cut", "warning", 0), ("2024-01-01T00:00:00Z", "r", "cut", "nonsense", 0)]
    (src / "a.json").write_text("\n".join(json.dumps(dict(zip(("timestamp", "run_id", "stage", "status", "current"), x))) for x in rows))
    state = str(tmp_path / "state")
    q = ev.write_state(ev.fold(ev.read_events(spark, str(src))), state, str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.stage, r.status, r.events) for r in spark.read.parquet(state).collect()}
    batch = {(r.stage, r.status, r.events) for r in ev.fold(spark.read.schema(ev.EVENT).json(str(src))).collect()}
    assert got == batch == {("ocr", "done", 3), ("cut", "running", 1)}


def test_html_and_hook(spark):
    assert ht.text_of("<p>a<br>b</p><table><tr><td>x</td><td>y</td></tr></table><img alt='map'>") == "ab\nx y\n[image: map]"
    assert [b["block_type"] for b in ht.blocks_of("<h1>T</h1><p>one<p>two</p><img>")] == ["h1", "/h1", "p", "p", "/p", "img"]
    assert ht.blocks_of(None) == [] and ht.text_of(None) is None
    df = hooks.call_model(spark.range(4), lambda f: f.assign(y=f["id"] * 10), "id long, y long")
    assert sorted(r.y for r in df.collect()) == [0, 10, 20, 30]


def test_catalogue_names_match():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert catalogue.FLAGSHIP in catalogue.queries()
