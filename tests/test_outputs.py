"""Objects per input, side outputs, bounded state, tree models and fan-out."""

import gzip
import json
import os
from types import SimpleNamespace

import pyarrow.fs as fs
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sluice.operators.filters import md5_dedup_within
from sluice.operators.rows import fan_out
from sluice.operators.tree_models import load_model, logistic_spec, model_features, model_score, save_model, stored_model, train_tree_model, tree_score, tree_spec
from sluice.operators.models import score_clean_model, train_clean_model
from sluice.plans.runner import check_config, run_bad_rows, run_steps
from sluice.sinks import per_input
from sluice.sinks.per_input import stream_per_input, write_per_input
from sluice.sources.files import read_jsonl
from sluice.streaming.steps import finish, side_path, stream_jsonl, write_stream, write_stream_split

ROWS = "id bigint, text string, input_file string, track_id string"


# one object per input


def objects(path):
    found = {}
    for name in sorted(os.listdir(path)):
        opener = gzip.open if name.endswith(".gz") else open
        with opener(f"{path}/{name}", "rt") as handle:
            found[name] = sorted((json.loads(line) for line in handle), key=lambda r: r["id"])
    return found


def test_objects_are_named_by_track_or_input(spark, tmp_path):
    data = [(1, "é\n", "s3a://b/x/a.jsonl.gz", None), (2, None, "s3a://b/x/a.jsonl.gz", None), (3, "t", "/y/b c.json", ""), (4, "u", "/z/other", "t/1"),
            (5, "v", "plain", None)]
    write_per_input(spark.createDataFrame(data, ROWS).repartition(4), str(tmp_path / "o"))
    got = objects(tmp_path / "o")
    assert list(got) == ["a.jsonl", "b c.jsonl", "plain.jsonl", "t_1.jsonl"]
    assert [r["id"] for r in got["a.jsonl"]] == [1, 2] and got["a.jsonl"][0] == {"id": 1, "text": "é\n", "track_id": None}
    write_per_input(spark.createDataFrame([(9, "new", "/q/a.jsonl", None)], ROWS), str(tmp_path / "o"))  # its own object is replaced
    got = objects(tmp_path / "o")
    assert [r["id"] for r in got["a.jsonl"]] == [9] and len(got) == 4
    write_per_input(spark.createDataFrame([], ROWS), str(tmp_path / "none"))
    assert not os.path.exists(tmp_path / "none") or os.listdir(tmp_path / "none") == []
    with pytest.raises(ValueError, match="input_file"):
        write_per_input(spark.range(3), str(tmp_path / "o"))


def test_a_failed_write_leaves_no_object(spark, tmp_path):
    rows = spark.range(0, 2000, 1, 4).select("id", F.concat(F.lit("f"), F.col("id") % 50).alias("input_file"))
    broken = rows.withColumn("x", F.when(F.col("id") == 1999, F.raise_error(F.lit("boom"))).otherwise(F.col("id").cast("string")))
    with pytest.raises(Exception, match="boom"):
        write_per_input(broken, str(tmp_path / "o"))
    assert not os.path.exists(tmp_path / "o") or os.listdir(tmp_path / "o") == []
    clash = spark.createDataFrame([(1, "a", "/x/a.jsonl", None), (2, "b", "/y/a.jsonl", None)], ROWS)
    with pytest.raises(Exception, match="two inputs"):
        write_per_input(clash, str(tmp_path / "o"))
    assert os.listdir(tmp_path / "o") == []


def test_a_stream_that_is_killed_writes_whole_objects_only(spark, tmp_path, write_lines):
    for i in range(4):
        write_lines(f"in/{i}.jsonl", [json.dumps({"id": 10 * i + j}) for j in range(3)])
    source = lambda: stream_jsonl(spark, write_lines.root + "/in", "id bigint", max_files_per_trigger=2)
    last = F.when(F.col("input_file").endswith("3.jsonl"), F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id")
    out, state = str(tmp_path / "o"), str(tmp_path / "c")
    with pytest.raises(Exception, match="boom"):
        finish(stream_per_input(source().select(last, "input_file"), out, state, "gzip"))
    before = objects(out)
    assert "3.jsonl.gz" not in before and all(len(v) == 3 for v in before.values()) and len(before) == 2
    finish(stream_per_input(source(), out, state, "gzip"))
    assert {k: [r["id"] for r in v] for k, v in objects(out).items()} == {f"{i}.jsonl.gz": [10 * i, 10 * i + 1, 10 * i + 2] for i in range(4)}


@pytest.mark.parametrize("inside", [True, False])  # False: a store whose files are written from front to back
def test_a_large_object_is_written_by_several_tasks(spark, tmp_path, write_lines, monkeypatch, inside):
    made, put = [], per_input._put_together
    monkeypatch.setattr(per_input, "_put_together", lambda spark, path, wholes: (made.append(wholes), put(spark, path, wholes)))
    if not inside:
        monkeypatch.setattr(per_input, "fs", SimpleNamespace(LocalFileSystem=type(None), FileSelector=fs.FileSelector))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    text = F.concat(*[F.md5(F.concat("id", F.lit(f"-{i}"))) for i in range(4)]).alias("text")
    rows = spark.range(0, 4000, 1, 8).select("id", text, F.when(F.col("id") % 100 < 98, "/x/large.jsonl").otherwise("/x/small.jsonl").alias("input_file"))
    want = {(r.id, r.text) for r in rows.collect()}
    try:
        for compression, end in ((None, ""), ("gzip", ".gz")):
            out = tmp_path / f"o{end}"
            write_per_input(rows, str(out), compression)
            got = objects(out)
            assert {k: len(v) for k, v in got.items()} == {f"large.jsonl{end}": 3920, f"small.jsonl{end}": 80}
            assert {(r["id"], r["text"]) for v in got.values() for r in v} == want
            sizes = [size for pieces in made.pop().values() for _, size in pieces]
            assert len(sizes) > 4 and max(sizes) < sum(sizes) / 4  # before, one task wrote all of it
            assert sorted(os.listdir(out)) == list(got)
            assert spark.read.schema("id bigint").json(str(out)).distinct().count() == 4000  # every gzip member is read
        write_lines("in/one.jsonl", [json.dumps({"id": r.id, "text": r.text}) for r in rows.collect()])
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        stream = stream_jsonl(spark, write_lines.root + "/in", "id bigint, text string")
        finish(stream_per_input(stream, str(tmp_path / "s"), str(tmp_path / "c"), "gzip"))
        got = objects(tmp_path / "s")
        assert list(got) == ["one.jsonl.gz"] and {(r["id"], r["text"]) for r in got["one.jsonl.gz"]} == want and len(got["one.jsonl.gz"]) == 4000
        assert len(next(iter(made.pop().values()))) > 4
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_pieces_that_are_cut_short_leave_no_object(spark, tmp_path, monkeypatch):
    """A store that lost the end of a piece fails the write; nothing gets a name."""
    def short(spark, path, wholes):
        put(spark, path, {whole: [(piece, size + 1) for piece, size in pieces] for whole, pieces in wholes.items()})

    put = per_input._put_together
    monkeypatch.setattr(per_input, "_put_together", short)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        with pytest.raises(OSError, match="bytes of"):
            write_per_input(spark.range(0, 20000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("t"), F.lit("f").alias("input_file")), str(tmp_path / "o"))
    finally:
        spark.conf.set(key, before)
    assert os.listdir(tmp_path / "o") == []


# side outputs


def test_a_batch_that_is_run_again_doubles_nothing(spark, tmp_path, write_lines):
    for i in range(3):
        write_lines(f"in/{i}.jsonl", [json.dumps({"id": i}), "broken"])
    path, state = str(tmp_path / "o"), str(tmp_path / "c")

    def run():
        rows = stream_jsonl(spark, write_lines.root + "/in", "id bigint", max_files_per_trigger=1, on_error="quarantine")
        finish(write_stream_split(rows, path, state))
        good = spark.read.schema("id bigint").json(side_path(path, "good")).collect()
        bad = spark.read.schema("`_corrupt_record` string, input_file string").option("columnNameOfCorruptRecord", "x").json(side_path(path, "bad")).collect()
        return sorted(r.id for r in good), sorted(r._corrupt_record for r in bad)

    assert run() == ([0, 1, 2], ["broken"] * 3)
    os.remove(f"{state}/commits/2")  # as if the driver had died before the commit
    if os.path.exists(f"{state}/commits/.2.crc"):
        os.remove(f"{state}/commits/.2.crc")
    assert run() == ([0, 1, 2], ["broken"] * 3)
    with pytest.raises(ValueError, match="bad side"):
        write_stream_split(stream_jsonl(spark, write_lines.root + "/in", "id bigint"), path, state)


def test_side_output_of_a_run(spark, tmp_path, write_lines):
    write_lines("in/a.jsonl", ["broken", "also broken"])
    conf = {"dataset": {"input_path": write_lines.root + "/in", "schema": "id bigint", "on_error": "quarantine", "output_path": str(tmp_path / "out")},
            "steps": [{"engine_type": "stream", "operators": [{"name": "op1"}], "engine_config": {"side_output": True}},
                      {"engine_type": "stream", "operators": [{"name": "op2"}], "engine_config": {}}]}
    rows = run_steps(spark, conf)
    assert rows.columns == ["id", "input_file", "op1", "op2"] and rows.count() == 0
    bad = run_bad_rows(spark, str(tmp_path / "out"))
    assert sorted(r._corrupt_record for r in bad.collect()) == ["also broken", "broken"] and bad.first().step_id == "run_step_1"
    with pytest.raises(ValueError, match="side_output"):
        check_config({**conf, "steps": [{**conf["steps"][0], "engine_type": "batch"}]})


# bounded state


def test_state_forgets_what_is_old(spark, tmp_path):
    def arrive(hour, texts):
        rows = spark.createDataFrame([(t, hour) for t in texts], "text string, h int")
        rows.select("text", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp")).alias("at")).coalesce(1).write.parquet(f"{tmp_path}/in/{hour:03d}")
        stream = spark.readStream.schema("text string, at timestamp").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        query = write_stream(md5_dedup_within(stream, "3 hours", "text", "at"), f"{tmp_path}/o", f"{tmp_path}/c", "parquet")
        finish(query)
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    held = [arrive(0, ["a", "a", "b", None, None]), arrive(1, ["a", "c"]), arrive(2, ["b", None])]
    assert held == [3, 4, 4]
    for tick in (20, 21, 22):
        last = arrive(tick, [f"tick {tick}"])
    assert last <= 3
    arrive(24, ["a", "d"])
    out = spark.read.parquet(f"{tmp_path}/o").groupBy("text").count().collect()
    assert {r["text"]: r["count"] for r in out if not (r["text"] or "").startswith("tick")} == {"a": 2, "b": 1, None: 1, "c": 1, "d": 1}
    with pytest.raises(ValueError, match="streams"):
        md5_dedup_within(spark.range(1).select(F.lit("x").alias("text")), "1 hour")


# models


def test_compiled_trees_score_like_the_fitted_model(spark, tmp_path):
    rows = spark.range(400).select(
        (F.rand(1) * 10).alias("words_num"), F.rand(2).alias("punc_frac"), F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).otherwise(F.rand(3)).alias("entropy"))
    rows = rows.withColumn(
        "quality", ((F.col("words_num") > 4).cast("int") + (F.col("punc_frac") > 0.6).cast("int")) % 2)
    cols = ("words_num", "punc_frac", "entropy")
    assembler, model = train_tree_model(rows, cols=cols, trees=6, depth=3)
    spec = tree_spec(assembler, model)
    save_model(spark, spec, str(tmp_path / "m"))
    loaded = load_model(spark.newSession(), str(tmp_path / "m"))
    assert loaded == spec and set(model_features(spec)) <= set(cols)
    both = model.transform(assembler.transform(rows)).select(vector_to_array("__probability")[1].alias("a"), tree_score(spec).alias("b"), model_score(loaded).alias("c"), "quality")
    found = both.collect()
    assert max(abs(r.a - r.b) for r in found) < 1e-9 and all(r.b == r.c for r in found)
    assert sum((r.b >= 0.5) == bool(r.quality) for r in found) > 360


def test_stored_logistic_model_and_its_operator(spark, tmp_path):
    rows = spark.createDataFrame([(i, "good words here and there " * (i % 7 + 1) if i % 2 else "$$$ 111 !!", i % 2) for i in range(40)] + [(99, None, None), (98, "", None)],
                                 "id int, text string, quality int")
    from sluice.functions.features import quality_features

    names = ("words_num", "punc_frac", "entropy")
    features = quality_features(rows, "text", features=list(names))
    model = train_clean_model(features, cols=names)
    save_model(spark, logistic_spec(model), str(tmp_path / "m"))
    scored = {r.id: r.p for r in stored_model(rows, str(tmp_path / "m"), text_col="text", out="p").collect()}
    fitted = {r.id: r.clean_prob for r in score_clean_model(model, features.filter("text <> ''")).select("id", "clean_prob").collect()}
    assert scored[99] is None and scored[98] == 0.0 and all(abs(scored[i] - p) < 1e-9 for i, p in fitted.items())
    with pytest.raises(ValueError, match="unknown kind"):
        save_model(spark, {"kind": "forest"}, str(tmp_path / "x"))
    spark.createDataFrame([("{}",), ("{}",)], "value string").write.text(str(tmp_path / "two"))
    with pytest.raises(ValueError, match="one model"):
        load_model(spark, str(tmp_path / "two"))


# fan-out


def test_fan_out_of_every_size(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, ""), (3, None), (4, "x " * 5000)], "id int, text string").repartition(3)

    def words(seen, text):
        for n, word in enumerate((text or "").split()):
            yield n + seen, word

    got = fan_out(rows, words, ["text"], "n bigint, word string", init=lambda: 10)
    assert got.columns == ["id", "text", "n", "word"] and got.count() == 5003
    assert sorted(tuple(r) for r in got.filter("id = 1").select("n", "word").collect()) == [(10, "a"), (11, "b"), (12, "c")]
    kept = fan_out(rows, words, ["text"], "n bigint, word string", keep_empty=True, init=lambda: 0)
    assert sorted((r.id, r.n) for r in kept.filter("n is null").collect()) == [(2, None), (3, None)] and kept.count() == 5005
    assert fan_out(rows.limit(0), words, ["text"], "n bigint, word string", init=lambda: 0).count() == 0
    with pytest.raises(ValueError, match="already"):
        fan_out(rows, words, ["text"], "id bigint")
