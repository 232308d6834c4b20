"""Fields that a schema does not name, from the file through streams and runs into the file again."""

import json

import pytest

from sluice.plans.runner import check_config, run_steps
from sluice.sinks.files import write_jsonl
from sluice.sources.files import read_jsonl
from sluice.streaming.steps import finish, stream_jsonl, write_stream

LINES = ['{"id": 1, "b": {"x": [1, 2.50, null], "y": "\\u00e9\\n"}, "c": null, "d d": "q\\"x"}', '{"id": 2}', '{"id": 3, "b": 1, "b": {}}', "{}", "bad", '{"id": "no", "z": 1}',
         '{"id": 5, "text": "t", "_rest": {"k": 1}, "_corrupt_record": "r"}']
RECORDS = [{"id": 1, "text": None, "b": {"x": [1, 2.5, None], "y": "é\n"}, "c": None, "d d": 'q"x'}, {"id": 2, "text": None}, {"id": 3, "text": None, "b": {}},
           {"id": None, "text": None}, {"id": 5, "text": "t", "_rest": {"k": 1}, "_corrupt_record": "r"}]
SCHEMA = "id bigint, text string"


def records(spark, path):
    found = [json.loads(r.value) for r in spark.read.text(path).collect()]
    return sorted(({k: v for k, v in r.items() if k != "input_file"} for r in found), key=str)


def test_unnamed_fields_go_round(spark, write_lines):
    write_lines("in/a.jsonl", LINES)
    root = write_lines.root
    rows = read_jsonl(spark, root + "/in", SCHEMA, open_records=True)
    assert dict(rows.dtypes)["_rest"] == "variant"
    write_jsonl(rows, root + "/out")
    assert records(spark, root + "/out") == sorted(RECORDS, key=str)
    again = read_jsonl(spark, root + "/out", "`d d` string", open_records=True, glob="*.txt", on_error="fail")
    write_jsonl(again.select("_rest"), root + "/twice")
    assert [r for r in records(spark, root + "/twice") if r.get("id") == 1] == [{k: v for k, v in RECORDS[0].items() if k != "d d"}]
    bad = read_jsonl(spark, root + "/in", SCHEMA, open_records=True, on_error="quarantine").filter("_corrupt_record is not null")
    assert sorted(r._corrupt_record for r in bad.collect()) == ["bad", '{"id": "no", "z": 1}'] and bad.filter("_rest is not null").count() == 0


def test_unnamed_fields_in_partitions_and_streams(spark, write_lines):
    write_lines("in/a.jsonl", LINES)
    root = write_lines.root
    write_jsonl(read_jsonl(spark, root + "/in", SCHEMA, open_records=True), root + "/parts", partition_by=["id"], compression="gzip")
    assert records(spark, root + "/parts/id=1") == [{k: v for k, v in RECORDS[0].items() if k != "id"}]
    finish(write_stream(stream_jsonl(spark, root + "/in", SCHEMA, open_records=True), root + "/o", root + "/c"))
    assert records(spark, root + "/o") == sorted(RECORDS, key=str)


@pytest.mark.parametrize("engines", [("stream", "batch"), ("batch", "batch"), ("stream", "stream")])
def test_unnamed_fields_in_a_run(spark, write_lines, tmp_path, engines):
    write_lines("in/a.jsonl", LINES)
    config = {"dataset": {"input_path": write_lines.root + "/in", "schema": SCHEMA, "output_path": str(tmp_path / "out"), "open_records": True, "on_error": "quarantine"},
              "steps": [{"engine_type": e, "operators": [{"name": n}]} for e, n in zip(engines, ("op1", "op2"))]}
    rows = run_steps(spark, config)
    assert rows.columns == ["id", "text", "_corrupt_record", "_rest", "input_file", "op1", "op2"] and rows.count() == 7
    found = {r["id"]: r for r in records(spark, str(tmp_path / "out" / "run" / "final_output"))}
    assert found[1]["b"] == RECORDS[0]["b"] and found[1]["op1"] == "processed" and found[5]["_corrupt_record"] is None and "c" in found[1]
    with pytest.raises(ValueError, match="open_records"):
        check_config({**config, "dataset": {**config["dataset"], "input_format": "csv"}})
