"""Runs that fail, are stopped, go on and tell their state."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators.progress import run_status, step_status
from sluice.plans import runlog
from sluice.plans.runlog import run_log, run_states
from sluice.plans.runner import Run, run_inputs, run_manifest, run_steps, start_steps

SCHEMA = "id bigint, text string"
FAIL = {"name": "require", "params": {"condition": "id <> 3"}}
PASS = {"name": "require", "params": {"condition": "id >= 0"}}


def config(root, out, engines, second, **step):
    return {
        "dataset": {"input_path": root, "schema": SCHEMA, "output_path": out},
        "steps": [{"engine_type": engines[0], "operators": [{"name": "op1"}], "engine_config": step},
                  {"engine_type": engines[1], "operators": [second, {"name": "op2"}]}],
    }


@pytest.fixture
def lines(write_lines):
    for i in range(4):
        write_lines(f"in/{i}.jsonl", [json.dumps({"id": 10 * i + j, "text": f"t{j}"}) for j in range(5)])
    write_lines("in/empty.jsonl", [])
    return write_lines.root + "/in"


def states(spark, out):
    return {r["step_id"][-1]: (r["state"], r["attempt"], r["input_rows"], r["output_rows"]) for r in run_states(spark, out).collect()}


def status(spark, out):
    manifest, inputs = run_manifest(spark, out), run_inputs(spark, out)
    return run_status(manifest, inputs).first()["state"], {r["step_id"][-1]: r["state"] for r in step_status(manifest, inputs).collect()}


@pytest.mark.parametrize("engines", [("spark-cpu-stream", "spark-cpu-stream"), ("spark-cpu-batch", "spark-cpu-batch"), ("spark-cpu-batch", "spark-cpu-stream")])
def test_a_failed_run_tells_so_and_can_be_run_again(spark, lines, tmp_path, engines):
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="does not meet"):
        run_steps(spark, config(lines, out, engines, FAIL, materialize=True))
    assert status(spark, out) == ("failed", {"1": "success", "2": "failed"})
    assert [s[0] for s in states(spark, out).values()] == ["success", "failed"]
    assert "id <> 3" in run_states(spark, out).filter("state = 'failed'").first()["message"]
    manifest = run_manifest(spark, out)
    assert manifest.filter("step_id = 'run_step_2' and state = 'failed'").select("input_file").distinct().count() == 5
    assert run_steps(spark, config(lines, out, engines, PASS, materialize=True)).count() == 20
    assert status(spark, out) == ("success", {"1": "success", "2": "success"})
    again = states(spark, out)["2"]
    assert again == (("success", 1, 20, 20) if engines[1] == "spark-cpu-stream" else ("success", 1, None, None))
    assert {r["attempt"] for r in run_manifest(spark, out).filter("step_id = 'run_step_2'").collect()} == {1}


def test_steps_that_share_a_plan_fail_together(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="does not meet"):
        run_steps(spark, config(lines, out, ("batch", "batch"), FAIL))
    assert [s[0] for s in states(spark, out).values()] == ["failed", "failed"]
    assert status(spark, out)[0] == "failed"


def test_micro_batches_are_logged_with_their_rows(spark, lines, tmp_path, monkeypatch):
    monkeypatch.setattr(runlog, "PER_FILE", 2)  # files are put together and removed
    out = str(tmp_path / "out")
    run_steps(spark, config(lines, out, ("stream", "stream"), {"name": "length_filter", "params": {"min_length": 3}}, maxFilesPerTrigger=1))
    batches = run_log(spark, out).filter("event = 'batch'").groupBy("step_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("input_rows").alias("read"), F.sum("output_rows").alias("made"), F.countDistinct("batch_id").alias("ids"))
    found = {r["step_id"][-1]: tuple(r[1:]) for r in batches.collect()}
    assert found["1"] == (4, 20, 20, 4) and found["2"][1:3] == (20, 0) and found["2"][0] == found["2"][3]
    assert states(spark, out) == {"1": ("success", 0, 20, 20), "2": ("success", 0, 20, 0)}


def test_a_run_can_be_stopped_and_goes_on(spark, lines, tmp_path):
    out = str(tmp_path / "out")
    conf = config(lines, out, ("stream", "stream"), PASS, maxFilesPerTrigger=1)
    run = Run(spark, conf)
    run.stop()  # before it has begun
    assert run.start().wait(60) is None and {s[0] for s in states(spark, out).values()} == {"pending"}
    run = start_steps(spark, conf)
    while not run.states().filter("batches > 0").count():
        assert run._thread.is_alive()
    run.stop()
    assert run.wait(60) is None and states(spark, out)["1"][0] == "stopped"
    assert status(spark, out)[0] == "running"
    rows = start_steps(spark, conf).wait(120)
    assert sorted(r["id"] for r in rows.collect()) == [10 * i + j for i in range(4) for j in range(5)]
    assert status(spark, out) == ("success", {"1": "success", "2": "success"})
    with pytest.raises(Exception, match="does not meet"):
        start_steps(spark, config(lines, out, ("batch", "batch"), FAIL), "other").wait(60)


def test_a_file_that_comes_later_counts_by_its_rows(spark, lines, tmp_path, write_lines):
    out = str(tmp_path / "out")
    conf = config(lines, out, ("stream", "stream"), PASS)
    run_steps(spark, conf)
    write_lines("in/late.jsonl", ['{"id": 99}'])
    run_steps(spark, conf)
    assert run_inputs(spark, out).filter("input_file like '%late.jsonl'").count() == 2
    assert status(spark, out)[0] == "success"


def test_require_needs_every_record(spark):
    from sluice.operators.filters import require

    rows = spark.createDataFrame([(1,), (None,)], "id bigint")
    assert require(rows, "id is null or id = 1").count() == 2
    with pytest.raises(Exception, match="odd ids"):
        require(rows, "id = 1", "odd ids").collect()
