"""Files opened by the tasks that hold their references."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.sources import by_reference
from sluice.sources.by_reference import lines_of, with_existence
from sluice.sources.files import list_folders, read_by_index
from sluice.streaming import steps
from sluice.streaming.steps import finish, run_refs_step, stream_refs

SCHEMA = "id bigint, text string"


def refs(spark, paths):
    return spark.createDataFrame([(p, f"t{i}") for i, p in enumerate(paths)], "input_file string, track_id string")


def test_ten_thousand_references(spark, tmp_path):
    """More references than files, none of them listed or collected."""
    for i in range(200):
        (tmp_path / f"{i}.jsonl").write_text(json.dumps({"id": i}) + "\n")
    base = f"file:{tmp_path}/"
    named = spark.range(10_000).select(F.concat(F.lit(base), (F.col("id") % 400).cast("string"), F.lit(".jsonl")).alias("input_file"),
                                       F.concat(F.lit("t"), F.col("id") % 25).alias("track_id"))
    got = read_by_index(spark, named, SCHEMA, by_name=True)
    assert "InMemoryFileIndex" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == named.distinct().filter(F.regexp_extract("input_file", r"(\d+)\.jsonl", 1).cast("int") < 200).count()
    assert with_existence(named).filter("exists").count() == 5_000
    lost = lines_of(named.distinct(), "input_file", "track_id", "report").filter("value is null")
    assert lost.select("input_file").distinct().count() == 200
    with pytest.raises(Exception, match="FileNotFound|No such file|does not exist"):
        read_by_index(spark, named, SCHEMA, by_name=True, tested=True).collect()


def test_lines_end_as_in_the_text_reader(spark, tmp_path, monkeypatch):
    texts = [b"", b"\n", b"a\r\nb\rc\nd", b"\xc3\xa9\r\n\r\n x\x0by\x85z \xe2\x80\xa8 end\r", b"long " * 400 + b"\n" + b"q" * 900, b"\xff bad\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt").write_bytes(text)
    named = refs(spark, [f"file://{tmp_path}/{i}.txt" for i in range(len(texts))])
    expected = sorted(r.value for r in spark.read.text(str(tmp_path)).collect())
    for block in (7, 1 << 20):
        monkeypatch.setattr(by_reference, "BLOCK", block)
        found = [line.decode("utf-8", "replace") for i in range(len(texts)) for part in by_reference._lines(f"{tmp_path}/{i}.txt") for line in part]
        assert sorted(found) == expected
    assert sorted(r.value for r in lines_of(named, "input_file", "track_id").collect()) == expected


def test_unknown_options_and_no_references(spark):
    with pytest.raises(ValueError, match="on_missing"):
        lines_of(refs(spark, ["/x"]), "input_file", "track_id", "ignore")
    assert with_existence(refs(spark, [])).count() == 0
    assert with_existence(spark.createDataFrame([(None, "a")], "input_file string, track_id string")).first().exists is False


@pytest.mark.parametrize("root", [False, True])
def test_the_log_of_references_stays_short(spark, tmp_path, write_lines, monkeypatch, root):
    """Many micro-batches name the same files again; the log is put together and nothing is read twice."""
    monkeypatch.setattr(steps, "LOG_EVERY", 3)
    for i in range(8):
        write_lines(f"in/{i}.jsonl", [json.dumps({"id": i})])
        named = [json.dumps({"id": str(k), "input_file": f"file:{write_lines.root}/in/{k}.jsonl"}) for k in range(i + 1)]
        write_lines(f"refs/{i}.json", named)
        stream = stream_refs(spark, "text", path=write_lines.root + "/refs", maxFilesPerTrigger="1")
        finish(run_refs_step(stream, SCHEMA, [], str(tmp_path / "o"), str(tmp_path / "c"), root=write_lines.root + "/in" if root else None))
    assert sorted(r.id for r in spark.read.schema(SCHEMA).json(str(tmp_path / "o")).collect()) == list(range(8))
    assert list_folders(spark, str(tmp_path / "o/_refs"), "") == ["batch=000000006", "batch=000000007", "upto=000000006"]
