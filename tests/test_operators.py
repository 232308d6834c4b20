"""Registry, filters, deduplication, labels, references, progress, user functions and models."""

import random
import sys

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sluice
from sluice.operators.documents import extract_documents
from sluice.operators.filters import length_filter, md5_dedup, space_ratio
from sluice.operators.labels import combine_label, rank_positions
from sluice.operators.literals import add_literal
from sluice.operators.models import (
    DEFAULT_WEIGHTS, batch_predict, clean_model, logistic, score_clean_model, train_clean_model,
)
from sluice.operators.progress import (
    manifest_from_output, merge_manifest, run_status, step_complete, step_progress, step_status,
)
from sluice.operators.refs import count_inputs, file_refs, parse_file_refs, skip_done, valid_refs
from sluice.operators.rows import run_partitions, run_rows
from sluice.plans import registry
from sluice.plans.registry import apply_operators

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# registry


def test_registry_knows_the_named_operators():
    known = sluice.list_operators()
    for name in ("op1", "op2", "op3", "op4", "op_stream_1", "combine_label", "clean_model_demo", "model_operator",
                 "length_filter", "space_ratio", "md5_dedup", "extract_documents"):
        assert known[name].name == name and callable(known[name].fn)
    assert known["model_operator"].kind == "gpu_model" and known["op1"].kind == "default"


def test_registry_errors():
    with pytest.raises(KeyError, match="already registered"):
        sluice.operator("op1")(lambda df: df)
    with pytest.raises(TypeError):
        sluice.operator("")
    with pytest.raises(TypeError):
        sluice.operator("named", kind="")
    with pytest.raises(KeyError, match="md5_dedup"):
        sluice.get_operator("no_such_operator")


def test_custom_operator_in_a_chain(spark):
    @sluice.operator("test_double")
    def double(df, col):
        return df.withColumn(col, F.col(col) * 2)

    try:
        df = sluice.apply_operators(spark.range(3), [{"name": "test_double", "params": {"col": "id"}}, {"name": "op2"}])
        assert rows(df) == [(0, 100), (2, 100), (4, 100)]
    finally:
        del registry._OPERATORS["test_double"]


def test_chain_resolves_names_before_running(spark):
    with pytest.raises(KeyError):
        sluice.apply_operators(spark.range(1), [{"name": "op1"}, {"name": "missing"}])


def test_chain_becomes_one_projection(spark):
    df = sluice.apply_operators(spark.range(1), [{"name": f"op{i}"} for i in (1, 2, 3, 4)])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Project") == 1
    assert dict(df.dtypes) == {"id": "bigint", "op1": "string", "op2": "bigint", "op3": "string", "op4": "bigint"}


def test_literal_overwrites_and_types(spark):
    df = spark.createDataFrame([("old",)], "op1 string").transform(sluice.get_operator("op1"))
    assert df.first().op1 == "processed"
    types = {v: dict(add_literal(spark.range(1), "x", v).dtypes)["x"] for v in ("a", 7, 0.5, True)}
    assert types == {"a": "string", 7: "bigint", 0.5: "double", True: "boolean"}


# filters and deduplication


def test_filters_edges(spark):
    df = spark.createDataFrame([("",), ("abc",), ("a b c",), ("é" * 5,), (None,)], "text string")
    assert rows(length_filter(df, min_length=5)) == [("a b c",), ("é" * 5,)]
    assert rows(space_ratio(df, max_ratio=0.4)) == [("a b c",), ("abc",), ("é" * 5,)]
    assert rows(space_ratio(df, max_ratio=0.39)) == [("abc",), ("é" * 5,)]


def test_dedup_keeps_the_first_by_order(spark):
    data = [(3, "a", None), (1, "a", "x"), (2, "b", None), (5, None, "n"), (4, None, "m")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, extra string")
    got = md5_dedup(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 4]
    assert md5_dedup(df, order_by=["extra", "doc_id"]).filter("text = 'a'").first().doc_id == 3


def test_dedup_with_one_hot_text(spark):
    hot = spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = md5_dedup(hot)
    assert got.count() == 20_001 and got.filter("text = 'hot'").collect() == [(0, "hot")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    # Narrow rows are aggregated by hash on the map side; no text is sorted before it is shuffled, nor kept in a buffer.
    assert "partial_min(__key0" in plan and "SortAggregate" not in plan and "min_by" not in plan


def test_dedup_keeps_one_of_rows_that_are_equal_in_text_and_key(spark):
    data = [(None, "a", 1), (2, "a", 2), (None, "a", 3), (7, "b", 4), (7, "b", 4), (None, None, 5), (None, None, 5), (1, "", 6)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, n int").repartition(5)
    got = [tuple(r) for r in md5_dedup(df).collect()]
    assert len(got) == 4 and sorted(str(r[:2]) for r in got) == sorted(str(x) for x in [(None, "a"), (7, "b"), (None, None), (1, "")])
    plain = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3), ("y", 3)], "text string, n int")
    assert rows(md5_dedup(plain)) == [("x", 1), ("y", 3)]
    assert rows(md5_dedup(plain.select(F.col("text").alias("body"), "n"), "body", order_by=["n"])) == [("x", 1), ("y", 3)]


# labels


def test_positional_merge_stops_at_the_shorter_side(spark):
    base = spark.createDataFrame([("f", i, f"b{i}", None) for i in range(5)], "input_file string, row_pos int, x string, y string")
    lab = spark.createDataFrame([("f", i, f"l{i}") for i in range(3)], "input_file string, row_pos int, y string")
    got = combine_label(base, lab, ["y"])
    assert got.columns == base.columns
    assert rows(got) == [("f", i, f"b{i}", f"l{i}") for i in range(3)]
    with pytest.raises(KeyError, match="absent"):
        combine_label(base, lab, ["absent"])


def test_merge_by_key_in_a_chain(spark):
    base = spark.createDataFrame([("t1", 1), ("t2", 2)], "track_id string, a int")
    lab = spark.createDataFrame([("t2", 9, 0.5)], "track_id string, a int, score double")
    step = {"name": "combine_label", "params": {"base": base, "combing_cols": ["a", "score"], "on": "track_id"}}
    assert rows(sluice.apply_operators(lab, [step])) == [("t2", 9, 0.5)]


def test_merge_with_a_hot_key(spark):
    """A third of all rows under one key: each keeps its label, and the join is left to AQE's skew handling."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    base = spark.range(0, 30_000, 1, 8).select(key.alias("track_id"), F.col("id").alias("a"))
    labels = base.select("track_id").distinct().withColumn("label", F.length("track_id"))
    got = combine_label(base, labels, ["label"], on="track_id")
    assert got.count() == 30_000 and got.filter("track_id = 'hot' and label = 3").count() == 10_000
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-1000, 1000)), min_size=1, max_size=80, unique=True),
       st.sampled_from([2, 7, 32]))
def test_rank_positions_property(spark, pairs, ranges):
    """However a group is cut, the positions are the same."""
    df = spark.createDataFrame([(None if g == "a" else g, v) for g, v in pairs], "g string, v int")
    want = {}
    for g in ("a", "b"):
        for i, v in enumerate(sorted(v for h, v in pairs if h == g)):
            want[(None if g == "a" else g, v)] = i
    assert {(r.g, r.v): r.row_pos for r in rank_positions(df, "g", "v", ranges=ranges).collect()} == want


def test_rank_positions_cuts_a_hot_group(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), (F.col("id") * 7).alias("v")
    )
    got = rank_positions(df, "g", "v")
    assert got.filter("g = 'hot'").agg(F.count("*"), F.min("row_pos"), F.max("row_pos"), F.countDistinct("row_pos")) \
        .first() == (13333, 0, 13332, 13333)
    assert got.filter("g != 'hot'").agg(F.max("row_pos")).first()[0] == 0


# references


def test_valid_refs(spark):
    refs = spark.createDataFrame(
        [("1", "file:///a.jsonl", "t"), ("2", "file:/gone.jsonl", "t"), ("3", "ftp://a.jsonl", None),
         ("4", "s3://b/c.jsonl", None), ("4", "s3://b/c.jsonl", None), ("5", None, None)], "id string, input_file string, track_id string")
    listing = spark.createDataFrame([("file:/a.jsonl",), ("s3a://b/c.jsonl",), ("s3a://b/c.jsonl",)], "path string")
    assert [r[0] for r in rows(valid_refs(refs, listing).select("id"))] == ["1", "4", "4"]


def test_refs_messages(spark):
    manifest = spark.createDataFrame([("1", "in/a", "t1", "out/a")], "id string, input_file string, track_id string, output_file string")
    kept = file_refs(manifest).first().value
    assert kept == '{"id":"1","track_id":"t1","input_file":"out/a"}'
    assert file_refs(manifest, keep_fields=False).first().value == '{"id":"out/a","input_file":"out/a"}'
    raw = spark.createDataFrame([(bytearray(kept.encode()),), (bytearray(b"{broken"),), (bytearray(b'{"id":"2"}'),)], "value binary")
    assert rows(parse_file_refs(raw)) == [("1", "out/a", "t1")]


def test_count_and_skip(spark):
    listing = spark.createDataFrame([("x/a.jsonl",), ("x/a.jsonl",), ("x/b.jsonl.gz",), ("x/c.txt",), ("x/jsonl",)], "path string")
    assert count_inputs(listing).first().input_count == 2
    refs = spark.createDataFrame([("file:///a",), ("b",), ("b",)], "input_file string")
    done = spark.createDataFrame([("file:/a",), ("file:/a",)], "input_file string")
    assert rows(skip_done(refs, done)) == [("b",), ("b",)]


# progress


@pytest.fixture
def runs(spark):
    inputs = [("r", "full", f"f{i}") for i in range(2)] + [("r", "part", f"f{i}") for i in range(3)]
    inputs += [("bad", "s1", "f0"), ("idle", "s1i", "f0"), ("good", "g1", "f0")]
    manifest = [("r", "full", "f0", "o0", "success"), ("r", "full", "f1", "o1", "success"), ("r", "full", "f1", "o1", "success"),
                ("r", "part", "f0", "o0", "success"), ("bad", "s1", "f0", "o0", "failed"), ("good", "g1", "f0", "o0", "success"),
                ("good", "g0", None, None, "success")]
    return (spark.createDataFrame(manifest, "run_id string, step_id string, input_file string, output_file string, state string"),
            spark.createDataFrame(inputs, "run_id string, step_id string, input_file string"))


def test_step_and_run_status(runs):
    manifest, inputs = runs
    assert dict((r.step_id, r.progress) for r in step_progress(manifest).collect()) == {
        "full": 2, "part": 1, "s1": 1, "g1": 1, "g0": 0}
    states = {r.step_id: r.state for r in step_status(manifest, inputs).collect()}
    assert states == {"full": "success", "part": "running", "s1": "failed", "s1i": "pending", "g1": "success", "g0": "success"}
    assert {r.step_id: r.complete for r in step_complete(manifest, inputs).collect()}["part"] is False
    assert {r.run_id: r.state for r in run_status(manifest, inputs).collect()} == {
        "r": "running", "bad": "failed", "idle": "running", "good": "success"}


MANIFEST_ROWS = "run_id string, step_id string, input_file string, output_file string, state string, attempt int"


def test_inputs_are_counted_not_output_files(spark):
    """Several parts of an input, inputs packed into one part, skipped inputs and retries."""
    rows = [("r", "packed", f"f{i}", f"part{i % 2}", "success", 0) for i in range(10)]
    rows += [("r", "split", "f0", f"part{i}", "success", 0) for i in range(2)]
    rows += [("r", "skips", "f0", None, "skipped", 0), ("r", "skips", "f1", "part0", "success", 0)]
    rows += [("r", "retry", "f0", "part0", "failed", 0), ("r", "retry", "f0", "part1", "success", 1)]
    rows += [("r", "worse", "f0", "part0", "success", 0), ("r", "worse", "f0", "part1", "failed", 1)]
    inputs = [("r", "packed", f"f{i}") for i in range(10)] + [("r", "split", f"f{i}") for i in range(2)]
    inputs += [("r", "skips", "f0"), ("r", "skips", "f1"), ("r", "retry", "f0"), ("r", "worse", "f0")]
    manifest = spark.createDataFrame(rows, MANIFEST_ROWS)
    wanted = spark.createDataFrame(inputs, "run_id string, step_id string, input_file string")
    states = {r.step_id: (r.state, r.finished, r.progress) for r in step_status(manifest, wanted).collect()}
    assert states == {"packed": ("success", 10, 2), "split": ("running", 1, 2), "skips": ("success", 2, 1),
                      "retry": ("success", 1, 2), "worse": ("failed", 1, 2)}


def test_a_retry_replaces_the_failure(spark):
    one = spark.createDataFrame([("r", "s", "f", "o", "failed", 0), ("r", "s", "g", None, "skipped", 0)], MANIFEST_ROWS)
    two = spark.createDataFrame([("r", "s", "f", "o", "success", 1)], MANIFEST_ROWS)
    for a, b in ((one, two), (two, one)):
        assert {(r.input_file, r.state) for r in merge_manifest(a, b).collect()} == {("f", "success"), ("g", "skipped")}
    same = two.withColumn("attempt", F.lit(0))
    assert merge_manifest(one, same).filter("input_file = 'f'").first().state == "success"


def test_flatten_refuses_equal_names(spark):
    from sluice.functions.scalar import flatten_struct

    df = spark.sql("SELECT 1 AS a, named_struct('a', 2) AS s")
    with pytest.raises(ValueError, match="several columns"):
        flatten_struct(df, "s")


def test_filters_find_the_text_of_records(spark):
    """Without a text column the joined content counts, and copies are ordered by the id there is."""
    block = "array<struct<type:string,md:string,text:string>>"
    rows = spark.createDataFrame([("b", [("text", "", "x" * 60), ("image", "y", "z")]), ("a", [("text", "x" * 60, "")]),
                                  ("c", [("text", "", "short")]), ("d", None)], f"track_id string, content_list {block}")
    chain = [{"name": "length_filter", "params": {"min_length": 50}}, {"name": "space_ratio"}, {"name": "md5_dedup", "params": {}}]
    assert [r.track_id for r in apply_operators(rows, chain).collect()] == ["a"]


def test_merge_manifest(runs):
    manifest, _ = runs
    merged = merge_manifest(manifest, manifest)
    assert merged.columns == manifest.columns and merged.count() == manifest.distinct().count()


def test_manifest_from_output(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "input_file string, x int").coalesce(1).write.json(path)
    got = manifest_from_output(spark.read.schema("input_file string, x int").json(path), "r", "s")
    assert got.columns == ["run_id", "step_id", "input_file", "output_file", "state", "attempt"]
    assert step_progress(got).first().progress == 1 and got.count() == 2


# user functions


def _inverse(record, resource=1):
    if record["x"] == 7:
        return {"x": "not a number"}
    return {"x": record["x"], "inv": resource / record["x"], "nested": [{"k": None}]}


INVERSE = "x bigint, inv double, nested array<struct<k:string>>"


def test_run_rows_error_modes(spark):
    df = spark.createDataFrame([(2,), (0,), (7,), (None,)], "x bigint")
    assert [(r.x, r.inv) for r in run_rows(df, _inverse, INVERSE).collect()] == [(2, 0.5)]
    kept = run_rows(df, _inverse, INVERSE, on_error="quarantine").collect()
    assert [(r.x, r.inv, r._error is None) for r in kept] == [(2, 0.5, True), (0, None, False), (7, None, False), (None, None, False)]
    assert kept[1]._error == "ZeroDivisionError" and "division" in kept[1]._error_msg
    with pytest.raises(Exception, match="ZeroDivisionError"):
        run_rows(df.filter("x = 0"), _inverse, INVERSE, on_error="fail").collect()
    with pytest.raises(ValueError):
        run_rows(df, _inverse, INVERSE, on_error="ignore")


def test_run_rows_loads_the_resource_once_per_task(spark):
    def init():
        return {"loads": random.random()}

    def tag(record, resource):
        return {"id": record["id"], "load": resource["loads"]}

    got = run_rows(spark.range(0, 10_000, 1, 2), tag, "id bigint, load double", init=init)
    assert got.select("load").distinct().count() == 2


def test_run_partitions_changes_cardinality(spark):
    def repeat(records):
        for r in records:
            yield from ({"id": r["id"], "copy": i} for i in range(r["id"] % 3))

    got = run_partitions(spark.range(0, 3000, 1, 3), repeat, T.StructType.fromDDL("id bigint, copy int"))
    assert got.count() == 3000 and got.filter("id % 3 = 0").count() == 0


def test_extract_documents_errors(spark):
    def extractor(raw):
        if raw == b"bad":
            raise ValueError("no document")
        return [{"type": "text", "text": raw.decode(), "page": 1}]

    df = spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"bad")), (3, None)], "id int, content binary")
    got = extract_documents(df, extractor, partitions=2)
    assert got.columns == ["id", "content_list", "_error", "_error_msg"]
    by_id = {r.id: r for r in got.collect()}
    assert by_id[1].content_list[0].asDict() == {"type": "text", "md": None, "text": "ok"} and by_id[1]._error is None
    assert (by_id[2]._error, by_id[2]._error_msg) == ("extract_error", "no document")
    assert by_id[3]._error == "read_error"


def test_extract_documents_by_path(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"body")
    paths = [(f"file:{tmp_path}/a.pdf",), (f"file://{tmp_path}/a.pdf",), (f"{tmp_path}/gone.pdf",)]
    df = spark.createDataFrame(paths, "path string")
    got = extract_documents(df, lambda raw: [{"type": "text", "md": raw.decode()}], path_col="path").collect()
    assert [r.content_list and r.content_list[0].md for r in got] == ["body", "body", None]
    assert got[2]._error == "read_error" and "gone.pdf" in got[2]._error_msg and got[2].path.endswith("gone.pdf")


# models


def test_clean_model_gate_and_missing_content(spark):
    blocks = "id int, content_list array<struct<type:string,md:string,text:string>>"
    text = "The quick brown fox jumps over the lazy dog and runs to the river."
    df = spark.createDataFrame([(1, [("text", "", text)]), (2, [("text", "", "abab")]), (3, None), (4, [])], blocks)
    got = {r.id: r.clean_prob for r in clean_model(df).collect()}
    assert 0 < got[1] < 1 and got[2] == 0.0 and got[3] is None and got[4] == 0.0
    assert clean_model(df, on_error="drop").count() == 3
    only = clean_model(df.withColumn("t", F.lit(text)), {"intercept": 0.0, "words_num": 0.1}, text_col="t").first().clean_prob
    assert abs(only - 1 / (1 + np.exp(-1.4))) < 1e-12
    with pytest.raises(KeyError):
        logistic({"no_such_feature": 1.0})


def test_clean_model_computes_only_weighted_features(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    plan = clean_model(df, {"words_num": 1.0}, text_col="text")._jdf.queryExecution().optimizedPlan().toString()
    assert "sentences" not in plan and plan.count("ArrowEvalPython") == 1
    assert set(DEFAULT_WEIGHTS) - {"intercept"}


def _newton(x, y, reg, steps=50):
    """Brute-force ridge logistic regression on standardised features, as the trained model is defined."""
    scale = x.std(axis=0, ddof=1)
    z = np.hstack([np.ones((len(x), 1)), x / scale])
    w = np.zeros(z.shape[1])
    penalty = np.eye(z.shape[1]) * reg
    penalty[0, 0] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ w))
        grad = z.T @ (p - y) / len(y) + penalty @ w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty
        w -= np.linalg.solve(hess, grad)
    return 1 / (1 + np.exp(-z @ w))


def test_training_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2)) * [1.0, 5.0]
    y = (x @ [1.5, -0.3] + rng.normal(size=300) > 0).astype(float)
    data = [(int(i), float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "i int, f1 double, f2 double, quality double")
    unlabelled = spark.createDataFrame([(999, 0.0, 0.0, None)], df.schema)
    model = train_clean_model(df.unionByName(unlabelled), cols=("f1", "f2"), max_iter=200)
    got = {r.i: r.clean_prob for r in score_clean_model(model, df).collect()}
    want = _newton(x, y, 0.01)
    assert max(abs(got[i] - want[i]) for i in range(300)) < 1e-3


def _two_class():
    return lambda x: (x * 2).astype("float32")


def _labels():
    return lambda x, y: np.stack([x, y, x + y], axis=1).astype("float32")


def _texts():
    return lambda x: np.array([f"<{v}>" for v in x], dtype=object)


def test_batch_predict_outputs(spark):
    df = spark.range(1, 4).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    assert [r.prediction for r in batch_predict(df, ["x"], _two_class).collect()] == [2.0, 4.0, 6.0]
    multi = batch_predict(df, ["x", "y"], _labels, T.ArrayType(T.FloatType()), out="p").first().p
    assert multi == [1.0, 1.0, 2.0]
    assert batch_predict(df, ["x"], _texts, T.StringType(), out="t").first().t == "<1.0>"


def _batch_size():
    return lambda x: np.full(len(x), len(x), dtype="float32")


def test_batch_size_is_bounded(spark):
    sizes = batch_predict(spark.range(0, 1000, 1, 1), ["id"], _batch_size, batch_size=64)
    assert sizes.agg(F.max("prediction")).first()[0] == 64


def test_model_factory_by_name(spark):
    step = {"name": "model_operator", "params": {
        "cols": ["embedding"], "make_predict_fn": "sluice.queries.features:make_linear_model", "out": "s",
        "return_type": T.DoubleType(), "input_tensor_shapes": [[64]]}}
    df = spark.createDataFrame([([1.0] + [0.0] * 63,)], "embedding array<float>")
    assert abs(sluice.apply_operators(df, [step]).first().s - (-0.9)) < 1e-9
