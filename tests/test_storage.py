"""Sources, sinks, streams and multi-step runs in a fresh folder."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators.filters import md5_dedup
from sluice.operators.labels import combine_label
from sluice.functions.scalar import normalize_path
from sluice.operators.progress import run_status
from sluice.operators.refs import REF_SCHEMA, skip_done, valid_refs
from sluice.plans.runner import check_config, output_paths, run_manifest, run_steps
from sluice.session import materialize, recorded_scratch, remove_scratch, scratch_path, shared_root, spread
from sluice.sinks.files import write_any, write_jsonl
from sluice.sources.files import (
    file_positions, format_of, infer_schema, list_files, path_exists, read_any, read_binary, read_by_index, read_jsonl,
    read_objects,
)
from sluice.streaming.steps import (
    drain_chain, finish, run_refs_step, run_stream_step, stream_jsonl, stream_refs, stream_sink_files, write_stream,
)

SCHEMA = "id bigint, text string"


def line(i, text="x"):
    return json.dumps({"id": i, "text": text})


@pytest.fixture
def folder(write_lines):
    write_lines("in/x/a.jsonl", [line(i) for i in range(3)])
    write_lines("in/y/a.jsonl", [line(10 + i) for i in range(4)])
    write_lines("in/x/b.jsonl.gz", [line(20 + i) for i in range(2)])
    write_lines("in/x/c.txt", [line(99)])
    write_lines("in/x/bad.jsonl", [line(30), "", '{"id": 31, "te', line(32), "   ", "[1, 2]"])
    return write_lines.root + "/in"


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


# sources


def test_read_jsonl(spark, folder):
    got = read_jsonl(spark, folder + "/x", SCHEMA)
    assert got.columns == ["id", "text"]
    assert ids(got) == [0, 1, 2, 20, 21, 30, 32]
    assert got.count() == 7
    assert ids(read_jsonl(spark, folder, SCHEMA, recursive=True)) == [0, 1, 2, 10, 11, 12, 13, 20, 21, 30, 32]


def test_read_jsonl_error_modes(spark, folder):
    kept = read_jsonl(spark, folder + "/x", SCHEMA, on_error="quarantine")
    assert sorted(r._corrupt_record for r in kept.filter("_corrupt_record is not null").collect()) == ["[1, 2]", '{"id": 31, "te']
    with pytest.raises(Exception, match="MALFORMED"):
        read_jsonl(spark, folder + "/x", SCHEMA, on_error="fail").collect()
    with pytest.raises(ValueError):
        read_jsonl(spark, folder + "/x", SCHEMA, on_error="ignore")
    with pytest.raises(ValueError):
        read_jsonl(spark, folder + "/x", "input_file string", keep_file=True)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_jsonl(spark, folder + "/none", SCHEMA).count()


def test_read_jsonl_infers_the_schema(spark, folder):
    assert infer_schema(spark, folder + "/x").simpleString() == "struct<id:bigint,text:string>"
    assert ids(read_jsonl(spark, folder + "/y")) == [10, 11, 12, 13]


def test_file_names_keep_directories_apart(spark, folder):
    got = read_jsonl(spark, folder, SCHEMA, recursive=True, keep_file=True).filter("input_file like '%a.jsonl'")
    assert {r.input_file[-9:]: r["count"] for r in got.groupBy("input_file").count().collect()} == {"x/a.jsonl": 3, "y/a.jsonl": 4}


def test_positions_follow_the_lines(spark, folder):
    got = read_jsonl(spark, folder, SCHEMA, recursive=True, positions=True).orderBy("input_file", "row_pos").collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.input_file[-11:], []).append((r.row_pos, r.id))
    assert by_file["n/x/a.jsonl"] == [(0, 0), (1, 1), (2, 2)]
    assert by_file["x/bad.jsonl"] == [(0, 30), (1, 32)]
    assert by_file["/b.jsonl.gz"] == [(0, 20), (1, 21)]


def test_positions_of_a_file_with_many_splits(spark, write_lines):
    path = write_lines("big/one.jsonl", [line(i, "y" * (i % 90)) for i in range(5000)])
    write_lines("big/two.jsonl", [line(i) for i in range(7)])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        got = read_jsonl(spark, path.rsplit("/", 1)[0], SCHEMA, positions=True)
        assert got.filter("id != row_pos").count() == 0 and got.count() == 5007
        assert got.filter("input_file like '%one.jsonl'").agg(F.countDistinct("row_pos")).first()[0] == 5000
        assert spark.read.text(path).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set(key, before)


def test_positions_of_parquet(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "p"))
    got = file_positions(spark.read.parquet(str(tmp_path / "p")))
    assert got.filter("id != row_pos").count() == 0 and "input_file" in got.columns


def test_positional_merge_of_files(spark, folder):
    base = read_jsonl(spark, folder, SCHEMA, recursive=True, positions=True)
    labelled = base.filter("row_pos < 2").select("input_file", "row_pos", (F.col("id") * 10).alias("label"))
    got = combine_label(base, labelled, ["label"])
    assert got.filter("label != id * 10").count() == 0
    assert ids(got) == [0, 1, 10, 11, 20, 21, 30, 32]


def test_formats(spark, tmp_path):
    assert [format_of(p) for p in ("a.parquet", "b/c.jsonl.gz", "d.txt", "e.csv/")] == ["parquet", "json", "text", "csv"]
    with pytest.raises(ValueError):
        format_of("a/b")
    df = spark.createDataFrame([(1, 'a "q"\nline, two'), (2, None)], SCHEMA)
    for name in ("t.parquet", "t.orc", "t.csv", "t.json"):
        write_any(df, str(tmp_path / name))
        options = {"multiLine": "true"} if name.endswith("csv") else {}
        assert sorted(map(tuple, read_any(spark, str(tmp_path / name), schema=SCHEMA, **options).collect())) == [(1, 'a "q"\nline, two'), (2, None)]


def test_listing_and_binary(spark, folder):
    assert list_files(spark, folder, "*.jsonl", recursive=True).count() == 3
    row = read_binary(spark, folder + "/x", "c.txt").first()
    assert bytes(row.content).decode().strip() == line(99) and row.length == len(row.content)


@pytest.mark.parametrize("by_name", [True, False])
def test_read_by_index(spark, folder, by_name):
    """By name and by scanning the folder above: same rows."""
    index = spark.createDataFrame(
        [("1", f"file://{folder}/x/a.jsonl", "t1"), ("1", f"file://{folder}/x/a.jsonl", "t1"),
         ("2", f"file:{folder}/y/a.jsonl", None), ("3", f"file:{folder}/x/gone.jsonl", "t3"), ("4", None, "t4")],
        "id string, input_file string, track_id string")
    got = read_by_index(spark, index, SCHEMA, folder, by_name=by_name)
    assert {(r.id, r.track_id) for r in got.collect()} == {(0, "t1"), (1, "t1"), (2, "t1")} | {(i, None) for i in range(10, 14)}
    assert got.count() == 7


def test_read_by_index_without_files(spark, folder):
    index = spark.createDataFrame([("1", f"file:{folder}/gone.jsonl", "t")], "id string, input_file string, track_id string")
    assert read_by_index(spark, index, SCHEMA, folder).count() == 0
    nowhere = index.withColumn("input_file", F.lit("file:/no/such/folder/a.jsonl"))
    assert read_by_index(spark, nowhere, SCHEMA, by_name=True).count() == 0
    got = read_by_index(spark, index.limit(0), "track_id string", folder)
    assert got.columns == ["track_id", "input_file", "ref_track_id"]


ODD_NAMES = ["a b.jsonl", "c[1].jsonl", "p%20q.jsonl", "{x,y}.jsonl", "h#1.jsonl", "größe+.jsonl", "q?.jsonl"]


def test_odd_file_names(spark, write_lines):
    """Blanks, percent signs, brackets, braces and other letters: one spelling everywhere, no file lost."""
    root = write_lines.root + "/odd"
    for i, name in enumerate(ODD_NAMES):
        write_lines(f"odd/{name}", [line(i)])
    index = spark.createDataFrame([(str(i), f"file:{root}/{n}", n) for i, n in enumerate(ODD_NAMES)], REF_SCHEMA)
    for by_name in (True, False):
        got = read_by_index(spark, index, SCHEMA, root, by_name=by_name).collect()
        assert sorted((r.id, r.track_id) for r in got) == sorted((i, n) for i, n in enumerate(ODD_NAMES))
    assert valid_refs(index, list_files(spark, root)).count() == len(ODD_NAMES)
    done = read_jsonl(spark, root, SCHEMA, keep_file=True).select("input_file", F.lit("success").alias("state"))
    assert skip_done(index, done).count() == 0
    assert read_jsonl(spark, root, SCHEMA, positions=True).select("input_file").distinct().count() == len(ODD_NAMES)


def test_references_that_would_be_lost_raise(spark, folder, write_lines):
    outside = write_lines("other/z.jsonl", [line(5)])
    hidden = write_lines("in/x/_h.jsonl", [line(6)])
    for path in (outside, hidden):
        index = spark.createDataFrame([("1", f"file:{path}", "t")], REF_SCHEMA)
        with pytest.raises(ValueError, match="outside"):
            read_by_index(spark, index, SCHEMA, folder)
    assert ids(read_by_index(spark, index, SCHEMA, by_name=True)) == [6]  # tasks open what is named
    with pytest.raises(ValueError, match="root"):
        read_by_index(spark, index, SCHEMA)


def test_lines_that_are_not_one_record(spark, write_lines):
    """Trailing text and a second value make a line undecodable; what JSON allows inside a record does not."""
    bad = ['{"id": 1} trailing', '{"id": 2}{"id": 3}', '{"id": 4},{"id": 5}', '{"id": 6}] x', '{"id": 7}} x', '{"id": 8},"r":9']
    good = ['{"id": 10, "text": "a}]{[,"}', ' {"id": 11} ', '{"id": 12, "x": {"y": [1, {"z": "]"}]}}']
    write_lines("one/a.jsonl", bad + good)
    root = write_lines.root + "/one"
    assert ids(read_jsonl(spark, root, SCHEMA)) == [10, 11, 12]
    kept = read_jsonl(spark, root, SCHEMA, on_error="quarantine")
    assert sorted(r[0] for r in kept.filter("_corrupt_record is not null").select("_corrupt_record").collect()) == sorted(bad)
    with pytest.raises(Exception, match="MALFORMED"):
        read_jsonl(spark, root, SCHEMA, on_error="fail").collect()


def test_lines_with_numbers_that_are_not_finite(spark, write_lines):
    """Their words inside texts change nothing; as values they belong to a record."""
    bad = ['{"id": 2, "text": "Infinity pool"}{"id": 3}', '{"id": 1, "text": "NaN is a word"} trailing', '{"id": 4, "x": NaN}{"id": 5}', '{"id": 6, "x": -INF}}',
           r'{"id": 7, "text": "a \\" NaN"}', r'{"id": 8, "x": NaN}\\', '{"id": 9, "text": "NaN', r'{"id": 9, "text": "\\\\" , "x": NaN} "b"']
    good = ['{"id": 10, "x": NaN}', '{"id": 11, "x": -Infinity, "text": "{NaN}}"}', r'{"id": 12, "text": "a \" NaN \\", "x": +Infinity}', '{"id": 13, "x": +INF, "text": "NaN"}',
            '{"id": 14, "text": "' + "Infinity and \\n \\\" " * 20_000 + '"}']
    write_lines("finite/a.jsonl", bad + good)
    root = write_lines.root + "/finite"
    schema = "id bigint, x double, text string"
    assert ids(read_jsonl(spark, root, schema)) == [10, 11, 12, 13, 14]
    kept = read_jsonl(spark, root, schema, on_error="quarantine").filter("_corrupt_record is not null")
    assert sorted(r[0] for r in kept.select("_corrupt_record").collect()) == sorted(bad)


def test_csv_is_split(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    spark.range(200_000).select("id", F.lit("some text").alias("t")).coalesce(1).write.csv(path)
    size = list_files(spark, path).agg(F.sum("length")).first()[0]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 8))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        rows = read_any(spark, path, schema="id bigint, t string")
        assert rows.rdd.getNumPartitions() >= 4 and rows.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_objects_keeps_missing_ones(spark, folder):
    refs = spark.createDataFrame([("1", f"file:{folder}/x/c.txt", "t"), ("2", f"file:{folder}/x/gone.txt", "t")], REF_SCHEMA)
    rows = {r.id: r for r in read_objects(spark, refs, folder).collect()}
    assert bytes(rows["1"].content).decode().strip() == line(99) and rows["1"]["_error"] is None
    assert rows["2"].content is None and rows["2"]["_error"] == "read_error" and "gone.txt" in rows["2"]["_error_msg"]


# sinks and session


def test_jsonl_sink_keeps_nulls_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "o")
    for n in (5, 2):
        write_jsonl(spark.range(n).select("id", F.lit(None).cast("string").alias("text")), path, compression="gzip")
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(path).collect()) == [0, 1]
    assert all(json.loads(r.value)["text"] is None for r in spark.read.text(path).collect())
    assert list_files(spark, path, "*.json.gz").count() > 0 and list_files(spark, path, "*.json").count() == 0


def test_partitioned_sink(spark, tmp_path):
    path = str(tmp_path / "o")
    write_jsonl(spark.range(10).withColumn("track_id", F.col("id") % 2), path, partition_by=["track_id"])
    assert spark.read.schema("id bigint").json(path + "/track_id=1").count() == 5


def test_shared_folder(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_root(spark))
    df = materialize(spark.range(5), "m")
    assert df.count() == 5 and len(df.inputFiles()) > 0


def test_scratch_is_removed_on_request(spark):
    kept = materialize(spark.range(3), "kept")
    with recorded_scratch() as paths:
        materialize(spark.range(5), "gone")
    assert len(paths) == 1 and path_exists(spark, paths[0])
    remove_scratch(spark, paths)
    assert not path_exists(spark, paths[0]) and kept.count() == 3


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def __init__(self, value=None):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Context:
        master, applicationId = "yarn", "app"

        def __init__(self, value=None):
            self.value = value

        def getConf(self):
            return Conf(self.value)

    class Session:
        def __init__(self, value=None):
            self.sparkContext, self.conf = Context(value), Conf()

    assert shared_root(Session("hdfs:///ckpt/")) == "hdfs:///ckpt"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_root(Session())


def test_spread_is_a_choice_of_the_session(spark):
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 32
    chosen = spark.conf.get("sluice.spread.partitions")
    spark.conf.unset("sluice.spread.partitions")
    df = spark.range(0, 10, 1, 1)
    assert spread(df) is df
    spark.conf.set("sluice.spread.partitions", chosen)


# streams


def test_stream_resumes_and_reads_new_files_only(spark, write_lines):
    root = write_lines.root
    write_lines("s/1.jsonl", [line(1), "broken", line(2)])

    def run():
        query = run_stream_step(stream_jsonl(spark, root + "/s", SCHEMA), [{"name": "op_stream_1"}], root + "/out", root + "/ck")
        finish(query)
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert run() == 3 and run() == 0
    write_lines("s/2.jsonl.gz", [line(3)])
    write_lines("s/skip.txt", [line(9)])
    assert run() == 1
    out = spark.read.json(root + "/out")
    assert ids(out) == [1, 2, 3] and out.filter("op_stream_1 = 100 and input_file is not null").count() == 3


def test_one_file_per_micro_batch(spark, write_lines):
    for i in range(3):
        write_lines(f"s/{i}.jsonl", [line(i)])
    root = write_lines.root
    query = write_stream(stream_jsonl(spark, root + "/s", SCHEMA, max_files_per_trigger=1), root + "/o", root + "/c")
    finish(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]


def test_interval_trigger_runs_until_stopped(spark, write_lines):
    write_lines("s/1.jsonl", [line(1)])
    root = write_lines.root
    query = run_stream_step(stream_jsonl(spark, root + "/s", SCHEMA), [{"name": "op1"}], root + "/o", root + "/c",
                            trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        write_lines("s/2.jsonl", [line(2)])
        query.processAllAvailable()
        assert query.isActive and ids(spark.read.json(root + "/o")) == [1, 2]
    finally:
        query.stop()
    assert not query.isActive


def test_stream_dedup_across_batches(spark, write_lines):
    for i in range(4):
        write_lines(f"s/{i}.jsonl", [line(10 * i + j, f"t{j % 3}") for j in range(9)] + [line(1000 + i, f"own{i}")])
    root = write_lines.root
    rows = md5_dedup(stream_jsonl(spark, root + "/s", SCHEMA, max_files_per_trigger=1), "text")
    finish(write_stream(rows, root + "/o", root + "/c"))
    texts = [r.text for r in spark.read.schema(SCHEMA).json(root + "/o").collect()]
    assert sorted(texts) == ["own0", "own1", "own2", "own3", "t0", "t1", "t2"]


def test_stream_equals_batch(spark, write_lines):
    from sluice.functions.features import FEATURES, quality_features

    write_lines("s/1.jsonl", [line(i, f"Some text, number {i}.\nAnd more & more; {i % 3} {i % 3}") for i in range(20)])
    root = write_lines.root
    batch = quality_features(read_jsonl(spark, root + "/s", SCHEMA))
    finish(write_stream(quality_features(stream_jsonl(spark, root + "/s", SCHEMA)), root + "/o", root + "/c", "parquet"))
    stream = spark.read.parquet(root + "/o").select(batch.columns)
    assert stream.exceptAll(batch).count() == 0 and stream.count() == 20 and set(FEATURES) <= set(batch.columns)


def test_chained_steps_run_side_by_side(spark, write_lines):
    for i in range(6):
        write_lines(f"s/{i}.jsonl", [line(10 * i + j) for j in range(3)])
    root = write_lines.root
    first = lambda: run_stream_step(stream_jsonl(spark, root + "/s", SCHEMA, max_files_per_trigger=1), [{"name": "op1"}], root + "/1", root + "/c1")
    schema = spark.createDataFrame([], SCHEMA + ", input_file string, op1 string").schema
    second = lambda: run_stream_step(stream_sink_files(spark, root + "/1", schema), [{"name": "op2"}], root + "/2", root + "/c2")
    drain_chain([first, second])
    out = spark.read.json(root + "/2")
    assert out.count() == 18 and out.select("id").distinct().count() == 18 and {"op1", "op2"} <= set(out.columns)


def test_failing_step_is_raised(spark, write_lines):
    write_lines("s/1.jsonl", [line(1)])
    root = write_lines.root
    broken = lambda: write_stream(stream_jsonl(spark, root + "/s", SCHEMA).select(F.raise_error(F.lit("boom")).cast("string").alias("x")), root + "/o", root + "/c")
    with pytest.raises(Exception, match="boom"):
        drain_chain([broken])


def test_stream_of_references(spark, folder, write_lines):
    write_lines("refs/1.json", [json.dumps({"id": "1", "input_file": f"file://{folder}/x/a.jsonl", "track_id": "t1"}), "{broken"])
    root = write_lines.root

    def run():
        refs = stream_refs(spark, "text", path=root + "/refs")
        finish(run_refs_step(refs, SCHEMA, [{"name": "op1"}], root + "/o", root + "/c"))

    run()
    write_lines("refs/2.json", [json.dumps({"id": "2", "input_file": f"file:{folder}/y/a.jsonl"}),
                                json.dumps({"id": "3", "input_file": f"file:{folder}/gone.jsonl"})])
    run()
    # The same file again in a later micro-batch is not processed again.
    write_lines("refs/3.json", [json.dumps({"id": "4", "input_file": f"file://{folder}/y/a.jsonl"})])
    run()
    out = spark.read.schema(SCHEMA + ", track_id string, op1 string").json(root + "/o")
    assert ids(out) == [0, 1, 2, 10, 11, 12, 13]
    assert out.filter("track_id = 't1'").count() == 3


def test_a_reference_before_its_file_counts_when_sent_again(spark, folder, write_lines):
    root = write_lines.root
    message = lambda i, name, track=None: json.dumps({"id": i, "input_file": f"file:{folder}/x/{name}", "track_id": track})

    def run():
        finish(run_refs_step(stream_refs(spark, "text", path=root + "/refs"), SCHEMA, [], root + "/o", root + "/c"))
        return ids(spark.read.schema(SCHEMA).json(root + "/o"))

    write_lines("refs/1.json", [message("1", "late.jsonl")])
    assert run() == []
    write_lines("in/x/late.jsonl", [line(50), line(51)])
    write_lines("refs/2.json", [message("2", "late.jsonl")])
    assert run() == [50, 51]
    write_lines("refs/3.json", [message("3", "late.jsonl"), message("4", "a.jsonl")])
    assert run() == [0, 1, 2, 50, 51]


@pytest.mark.parametrize("apart", [False, True])
def test_a_file_with_two_track_ids_does_not_depend_on_the_trigger(spark, folder, write_lines, apart):
    root = write_lines.root
    messages = [json.dumps({"id": "1", "input_file": f"file:{folder}/y/a.jsonl", "track_id": t}) for t in ("t1", "t2", "t1")]
    for i, message in enumerate(messages):
        write_lines(f"refs/{i}.json", [message])
    refs = stream_refs(spark, "text", path=root + "/refs", **({"maxFilesPerTrigger": "1"} if apart else {}))
    finish(run_refs_step(refs, SCHEMA, [], root + "/o", root + "/c"))
    out = spark.read.schema(SCHEMA + ", track_id string").json(root + "/o")
    assert {(r.track_id, r["count"]) for r in out.groupBy("track_id").count().collect()} == {("t1", 4), ("t2", 4)}


# multi-step runs


def config(folder, base, engines=("spark-cpu-batch", "spark-cpu-batch"), triggers=("job_finished", "job_finished"), **dataset):
    return {
        "pipeline_meta": {"pipeline_name": "test"},
        "dataset": {"input_path": folder + "/x", "input_type": "data", "schema": SCHEMA, "output_path": base + "/out", "on_error": "drop", **dataset},
        "steps": [
            {"engine_type": engines[0], "trigger_event": triggers[0], "operators": [{"name": "op1", "params": {}}, {"name": "op2"}],
             "engine_config": {"maxOffsetsPerTrigger": "1"}},
            {"engine_type": engines[1], "trigger_event": triggers[1], "operators": [{"name": "op3"}, {"name": "op4"}]},
        ],
    }


@pytest.mark.parametrize("engines", [
    ("spark-cpu-batch", "local-cpu-batch"), ("spark-cpu-stream", "spark-cpu-stream"), ("spark-cpu-batch", "ray-gpu-stream"),
    ("spark-cpu-stream", "spark-cpu-batch")])
@pytest.mark.parametrize("trigger", ["job_finished", "file_success"])
def test_runs_in_every_engine_mix(spark, folder, tmp_path, engines, trigger):
    got = run_steps(spark, config(folder, str(tmp_path), engines, ("job_finished", trigger)))
    assert ids(got) == [0, 1, 2, 20, 21, 30, 32]
    assert got.filter("op1 = 'processed' and op2 = 100 and op3 = 'processed' and op4 = 100").count() == 7


def test_batch_steps_are_fused_unless_materialized(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path))
    run_steps(spark, conf)
    assert (tmp_path / "out" / "run" / "final_output").exists() and not (tmp_path / "out" / "run" / "step_1").exists()
    conf["steps"][0]["engine_config"]["materialize"] = True
    conf["steps"][0]["engine_config"]["output_compression"] = "gzip"
    assert run_steps(spark, conf, "again").count() == 7
    assert list((tmp_path / "out" / "again" / "step_1").glob("*.json.gz"))


def test_rerun_of_a_stream_resumes(spark, folder, tmp_path, write_lines):
    conf = config(folder, str(tmp_path), ("spark-cpu-stream", "spark-cpu-stream"))
    assert run_steps(spark, conf).count() == 7
    write_lines("in/x/new.jsonl", [line(77)])
    assert ids(run_steps(spark, conf)) == [0, 1, 2, 20, 21, 30, 32, 77]


@pytest.mark.parametrize("engines", [("spark-cpu-batch", "spark-cpu-stream"), ("spark-cpu-stream", "spark-cpu-batch"),
                                     ("spark-cpu-batch", "spark-cpu-batch"), ("spark-cpu-stream", "spark-cpu-stream")])
def test_runs_can_be_repeated(spark, folder, tmp_path, engines):
    """The same run twice changes nothing; another run on the same output path has its own rows."""
    conf = config(folder, str(tmp_path), engines)
    for _ in range(2):
        assert ids(run_steps(spark, conf)) == [0, 1, 2, 20, 21, 30, 32]
    conf["dataset"]["input_path"] = folder + "/y"
    assert ids(run_steps(spark, conf, "second")) == [10, 11, 12, 13]
    conf["dataset"]["input_path"] = folder + "/x"
    assert ids(run_steps(spark, conf)) == [0, 1, 2, 20, 21, 30, 32]


def test_stream_input_takes_the_dataset_settings(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path), ("spark-cpu-stream", "spark-cpu-stream"), recursive=True)
    conf["dataset"]["input_path"] = folder
    assert run_steps(spark, conf).count() == 11
    rows = spark.range(5).select("id", F.lit("t").alias("text"))
    write_any(rows, str(tmp_path / "p/nested"), "parquet")
    conf = config(folder, str(tmp_path), ("spark-cpu-stream", "spark-cpu-stream"), recursive=True, input_format="parquet")
    conf["dataset"]["input_path"] = str(tmp_path / "p")
    assert ids(run_steps(spark, conf, "parquet")) == [0, 1, 2, 3, 4]


def test_trigger_interval_paces_a_run(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path), ("spark-cpu-stream", "spark-cpu-stream"), ("job_finished", "file_success"))
    for step in conf["steps"]:
        step["engine_config"] = {"trigger_interval": "1 second", "spark_conf_name": "x", "input_as_stream": True, "spark.any": "1"}
    assert ids(run_steps(spark, conf)) == [0, 1, 2, 20, 21, 30, 32]


def test_on_error_of_a_run(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path), on_error="fail")
    with pytest.raises(Exception, match="MALFORMED"):
        run_steps(spark, conf)
    for engine in ("spark-cpu-batch", "spark-cpu-stream"):
        conf = config(folder, str(tmp_path), (engine, engine), on_error="quarantine")
        assert sorted(r._corrupt_record for r in run_steps(spark, conf, engine).collect() if r.id is None) == ["[1, 2]", '{"id": 31, "te']


def test_run_partitions_its_output(spark, folder, tmp_path):
    for engine in ("spark-cpu-batch", "spark-cpu-stream"):
        conf = config(folder, str(tmp_path), (engine, engine))
        conf["steps"][1]["engine_config"] = {"partition_by": ["op3"]}
        assert run_steps(spark, conf, engine).count() == 7
        assert (tmp_path / "out" / engine / "final_output" / "op3=processed").exists()


def test_a_run_leaves_a_manifest(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path), ("spark-cpu-stream", "spark-cpu-stream"))
    run_steps(spark, conf)
    manifest = run_manifest(spark, str(tmp_path / "out"))
    assert manifest.select("step_id", "input_file").distinct().count() == 6
    listing = list_files(spark, folder + "/x", "*.jsonl*").select(normalize_path(F.col("path")).alias("input_file"))
    steps = spark.createDataFrame([("run", "run_step_1"), ("run", "run_step_2")], "run_id string, step_id string")
    assert run_status(manifest, steps.crossJoin(listing)).first().state == "success"
    more = listing.union(spark.createDataFrame([("file:/x",)], "f string"))
    assert run_status(manifest, steps.crossJoin(more)).first().state == "running"


@pytest.mark.parametrize("engines", [("spark-cpu-batch", "spark-cpu-batch"), ("spark-cpu-batch", "spark-cpu-stream"),
                                     ("spark-cpu-stream", "spark-cpu-stream"), ("spark-cpu-stream", "spark-cpu-batch")])
def test_files_without_surviving_rows_are_finished(spark, folder, tmp_path, write_lines, engines):
    """An empty file, files whose records are all dropped and steps merged into one plan; a file that came later is not claimed."""
    write_lines("in/x/empty.jsonl", [])
    write_lines("in/x/a b+c.jsonl", ['{"id": 1, "te'])
    conf = config(folder, str(tmp_path), engines)
    conf["steps"][0]["operators"] = [{"name": "length_filter", "params": {"min_length": 5}}, {"name": "op1"}]
    write_lines("in/x/long.jsonl", [line(7, "long enough")])
    names = ("a.jsonl", "b.jsonl.gz", "bad.jsonl", "empty.jsonl", "a b+c.jsonl", "long.jsonl")
    listing = spark.createDataFrame([(f"file:{folder}/x/{name}",) for name in names], "input_file string")
    steps = spark.createDataFrame([("run", "run_step_1"), ("run", "run_step_2")], "run_id string, step_id string")
    for _ in range(2):
        assert ids(run_steps(spark, conf)) == [7]
        manifest = run_manifest(spark, str(tmp_path / "out"))
        status = run_status(manifest, steps.crossJoin(listing)).first()
        assert (status.state, status.input_count, status.finished) == ("success", 12, 12)
        assert manifest.filter("output_file is not null").select("input_file").distinct().count() == 1
        assert manifest.filter("state <> 'success' or attempt <> 0").count() == 0
    more = listing.union(spark.createDataFrame([("file:/x",)], "f string"))
    assert run_status(manifest, steps.crossJoin(more)).first().state == "running"
    if engines == ("spark-cpu-batch", "spark-cpu-stream"):
        write_lines("in/x/new.jsonl", [line(8, "long enough")])
        assert ids(run_steps(spark, conf)) == [7]  # such a step needs a new run id
        assert not run_manifest(spark, str(tmp_path / "out")).filter("input_file like '%new.jsonl'").count()


def test_manifest_of_a_run_from_an_index(spark, folder, tmp_path, write_lines):
    index = [(f"file:{folder}/x/{name}", "t") for name in ("a.jsonl", "b.jsonl.gz", "empty.jsonl", "gone.jsonl")]
    spark.createDataFrame(index, "input_file string, track_id string").write.parquet(str(tmp_path / "index"))
    write_lines("in/x/empty.jsonl", [])
    for run_id, root in (("named", None), ("rooted", folder)):
        conf = config(folder, str(tmp_path), input_type="index", input_format="parquet", **({"root": root} if root else {}))
        conf["dataset"]["input_path"] = str(tmp_path / "index")
        conf["steps"][1]["operators"] = [{"name": "length_filter", "params": {"min_length": 5}}]
        assert run_steps(spark, conf, run_id).count() == 0
        found = {(r.step_id[-1], r.input_file.rsplit("/", 1)[-1], r.output_file) for r in
                 run_manifest(spark, str(tmp_path / "out"), run_id).collect()}
        assert found == {(step, name, None) for step in "12" for name in ("a.jsonl", "b.jsonl.gz", "empty.jsonl")}


@pytest.mark.parametrize("engines", [("spark-cpu-batch", "spark-cpu-batch"), ("spark-cpu-stream", "spark-cpu-stream"),
                                     ("spark-cpu-batch", "spark-cpu-stream"), ("spark-cpu-stream", "spark-cpu-batch")])
def test_csv_runs_keep_every_text(spark, folder, tmp_path, engines):
    """A header, quotes, line breaks and white space of the input, and all of them again in the files of the run."""
    texts = ['a "q"\nline, two', 'x\r\ny', "cr\rcr", " both ", '\\"', "\\", None, '"', "#no comment", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    write_any(df, str(tmp_path / "in.csv"), header="true")
    conf = config(folder, str(tmp_path), engines, input_format="csv", output_format="csv", options={"header": "true", "multiLine": "true", "lineSep": "\n"})
    conf["dataset"]["input_path"] = str(tmp_path / "in.csv")
    conf["steps"][0]["engine_config"]["materialize"] = True
    got = run_steps(spark, conf)
    assert sorted((r.id, r.text) for r in got.collect()) == list(enumerate(texts))


def test_reader_options_need_a_format_that_has_them(folder):
    with pytest.raises(ValueError, match="options"):
        check_config(config(folder, "out", options={"header": "true"}))


def test_three_concurrent_stream_steps(spark, folder, tmp_path):
    conf = config(folder, str(tmp_path), ("spark-cpu-stream",) * 2, ("job_finished", "file_success"))
    conf["steps"].append({"engine_type": "spark-cpu-stream", "trigger_event": "file_success", "operators": [{"name": "length_filter", "params": {"min_length": 1}}]})
    assert run_steps(spark, conf).count() == 7


@pytest.mark.parametrize("engine", ["spark-cpu-batch", "spark-cpu-stream"])
def test_run_from_an_index(spark, folder, tmp_path, engine):
    index = spark.createDataFrame([("1", f"file:{folder}/x/a.jsonl", "t1"), ("2", f"file:{folder}/x/gone.jsonl", "t2")],
                                  "id string, input_file string, track_id string")
    write_any(index, str(tmp_path / "index.parquet"))
    conf = config(folder, str(tmp_path), (engine, engine), input_type="index", root=folder)
    conf["dataset"]["input_path"] = str(tmp_path / "index.parquet")
    got = run_steps(spark, conf)
    assert ids(got) == [0, 1, 2] and {r.track_id for r in got.collect()} == {"t1"}


def test_lazy_run_without_output(spark, folder):
    conf = config(folder, "")
    conf["dataset"]["output_path"] = None
    assert ids(run_steps(spark, conf)) == [0, 1, 2, 20, 21, 30, 32]
    conf["steps"][0]["engine_type"] = "spark-cpu-stream"
    with pytest.raises(ValueError):
        run_steps(spark, conf)


def test_unknown_settings_are_errors(folder):
    for where in ("dataset", "engine_config"):
        conf = config(folder, "out")
        (conf["dataset"] if where == "dataset" else conf["steps"][0]["engine_config"])["maxFilesPerTriger"] = 1
        with pytest.raises(ValueError, match="maxFilesPerTriger"):
            check_config(conf)
    conf = config(folder, "out")
    conf["steps"][0]["engine_config"]["trigger_interval"] = "5 seconds"
    with pytest.raises(ValueError, match="trigger_interval"):
        check_config(conf)


def test_config_errors(folder):
    for change, error in [({"engine_type": "local-gpu-batch"}, ValueError), ({"trigger_event": "later"}, ValueError),
                          ({"operators": [{"name": "nope"}]}, KeyError)]:
        conf = config(folder, "out")
        conf["steps"][1].update(change)
        with pytest.raises(error):
            check_config(conf)
    with pytest.raises(ValueError):
        check_config({"dataset": {}, "steps": []})
    with pytest.raises(ValueError):
        check_config({"dataset": {"input_type": "table"}, "steps": [{}]})
    assert output_paths("o/", "r", 3) == ["o/r/step_1", "o/r/step_2", "o/r/final_output"]
