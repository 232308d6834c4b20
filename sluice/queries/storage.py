"""Sources, sinks, streams and multi-step runs: each writes tables to the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.scalar import normalize_path
from sluice.operators.filters import md5_dedup, md5_dedup_within
from sluice.operators.labels import combine_label
from sluice.operators.progress import run_status, step_status
from sluice.operators.refs import valid_refs
from sluice.plans.registry import apply_operators, operator
from sluice.plans.runner import run_bad_rows, run_inputs, run_manifest, run_steps, start_steps
from sluice.queries.common import CONTENT_SQL, as_blocks, r6, table
from sluice.queries.features import clean_prob_sql
from sluice.session import scratch_path, spread
from sluice.sinks.files import READ_BACK, write_any, write_jsonl
from sluice.sinks.per_input import stream_per_input, write_per_input
from sluice.sources.files import list_files, path_exists, read_any, read_by_index, read_jsonl, read_objects
from sluice.streaming.steps import finish, run_refs_step, run_stream_step, stream_jsonl, stream_refs, write_stream

QUERIES, SQL = {}, {}

# Spark names its JSON output *.json, so files written here are read with this pattern.
WRITTEN = "*.{json,json.gz}"
DOC = "doc_id bigint, text string, lang string"
DOC_COLS = ["doc_id", "text", "lang"]
OPS = [{"name": "op1"}, {"name": "op2"}]
MORE_OPS = [{"name": "op3"}, {"name": "op4"}]


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*DOC_COLS)


def written_docs(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_path(spark, label)
    write_jsonl(spread(docs(spark, sf_dir)), path)
    return path


def scan_jsonl(spark, sf_dir):
    """Plain and gzip files side by side."""
    path = scratch_path(spark, "scan-jsonl")
    odd = F.col("doc_id") % 2 == 1
    write_jsonl(docs(spark, sf_dir).filter(odd), path)
    write_jsonl(docs(spark, sf_dir).filter(~odd), path, compression="gzip", mode="append")
    return read_jsonl(spark, path, DOC, glob=WRITTEN)


QUERIES["scan_jsonl"] = scan_jsonl
SQL["scan_jsonl"] = "SELECT doc_id, text, lang FROM documents"


def scan_bad_rows(spark, sf_dir):
    """Of ten lines one is cut off, one has text behind the record and one a second record; a blank line follows each line.

    Half of the texts hold the words for numbers that are not finite, and every record has such a number.
    """
    path = scratch_path(spark, "scan-bad-rows")
    words = F.when(F.floor(F.col("doc_id") / 10) % 2 == 0, F.concat(F.lit('NaN "Infinity" -INF \\'), "text")).otherwise(F.col("text")).alias("text")
    number = F.when(F.col("doc_id") % 3 == 0, '"x":NaN').when(F.col("doc_id") % 3 == 1, '"x":-Infinity').otherwise('"x":1.5')
    whole = F.concat(F.regexp_replace(F.to_json(F.struct("doc_id", words, "lang")), r"\}$", ","), number, F.lit("}"))
    kind = F.col("doc_id") % 10
    line = (F.when(kind == 0, F.expr("substring(l, 1, length(l) - 5)")).when(kind == 1, F.concat("l", F.lit(" trailing")))
            .when(kind == 2, F.concat("l", "l")).otherwise(F.col("l")))
    lines = docs(spark, sf_dir).select("doc_id", whole.alias("l")).select(F.concat(line, F.lit("\n")).alias("value"))
    write_any(lines, path, "text")
    parsed = read_jsonl(spark, path, f"{DOC}, x double", on_error="quarantine", glob="*.txt")
    bad = F.col("_corrupt_record").isNotNull()
    number = F.regexp_extract("_corrupt_record", r'"doc_id":(\d+)', 1)
    quarantined = parsed.filter(bad).select(number.cast("bigint").alias("doc_id"), F.lit(True).alias("is_bad"))
    good = read_jsonl(spark, path, f"{DOC}, x double", on_error="drop", glob="*.txt").select("doc_id", F.lit(False).alias("is_bad"))
    return good.unionByName(quarantined)


QUERIES["scan_bad_rows"] = scan_bad_rows
SQL["scan_bad_rows"] = "SELECT doc_id, doc_id % 10 < 3 AS is_bad FROM documents"


def scan_open_records(spark, sf_dir):
    """Fields that only some records have, through a batch and a stream step that do not know them, and back into the records."""
    path = scratch_path(spark, "scan-open")
    number = F.col("doc_id")
    extra = F.when(number % 10 == 0, F.struct(F.col("source").alias("s"), F.array(number, F.lit(None)).alias("a")))
    note = F.when(number % 7 == 0, F.concat(F.lit('"q" \\ '), "source"))
    lines = table(spark, sf_dir, "documents").select(F.to_json(F.struct(*DOC_COLS, extra.alias("extra"), note.alias("a note"))).alias("value"))
    write_any(lines, f"{path}/in", "text")
    config = {
        "dataset": {"input_path": f"{path}/in", "schema": "doc_id bigint, lang string", "glob": "*.txt", "output_path": f"{path}/out", "open_records": True},
        "steps": [{"engine_type": "spark-cpu-batch", "operators": OPS}, {"engine_type": "spark-cpu-stream", "operators": MORE_OPS}],
    }
    run_steps(spark, config)
    schema = f"{DOC}, extra struct<s: string, a: array<bigint>>, `a note` string, op1 string, op4 bigint"
    back = read_jsonl(spark, f"{path}/out/run/final_output", schema, glob="*.txt", open_records=True)
    return back.select(*DOC_COLS, F.col("extra.s").alias("s"), F.get("extra.a", 0).alias("a"), F.col("a note").alias("note"), "op1", "op4",
                       F.to_json("_rest").contains('"op2":100').alias("rest"))


QUERIES["scan_open_records"] = scan_open_records
SQL["scan_open_records"] = """SELECT doc_id, text, lang, CASE WHEN doc_id % 10 = 0 THEN source END AS s, CASE WHEN doc_id % 10 = 0 THEN doc_id END AS a,
  CASE WHEN doc_id % 7 = 0 THEN '"q" \\ ' || source END AS note, 'processed' AS op1, 100::BIGINT AS op4, true AS rest FROM documents"""


def scan_any(spark, sf_dir):
    """The same rows through four formats, with quotes, line breaks and white space around the name, cut off only if they are whole."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    before, after = ' "a", \\"b\n', '\r\n\n"c" '
    odd = customers.withColumn("c_name", F.concat(F.lit(before), "c_name", F.lit(after)))
    whole = F.col("c_name").startswith(before) & F.col("c_name").endswith(after)
    name = F.when(whole, F.expr(f"substring(c_name, {len(before) + 1}, length(c_name) - {len(before) + len(after)})"))
    read = []
    for fmt in ("parquet", "orc", "csv", "json"):
        path = f"{scratch_path(spark, 'scan-any')}.{fmt}"
        write_any(odd, path)
        rows = read_any(spark, path, schema=customers.schema, **READ_BACK.get(fmt, {}))
        read.append(rows.withColumn("c_name", F.coalesce(name, "c_name")).withColumn("fmt", F.lit(fmt)))
    return read[0].unionByName(read[1]).unionByName(read[2]).unionByName(read[3])


QUERIES["scan_any"] = scan_any
SQL["scan_any"] = """SELECT c_custkey, c_name, c_acctbal, fmt
FROM customer, (VALUES ('parquet'), ('orc'), ('csv'), ('json')) v(fmt)"""


def shard_index(spark, sf_dir, label):
    """Documents in four shards of files, and an index of the files of three plus refs that lead nowhere."""
    path = scratch_path(spark, label)
    sharded = docs(spark, sf_dir).withColumn("shard", F.concat(F.lit("t"), F.col("doc_id") % 4))
    write_jsonl(sharded, path, partition_by=["shard"])
    listing = list_files(spark, path, WRITTEN, recursive=True)
    shard = F.regexp_extract("path", "shard=(t[0-9]+)/", 1)
    known = listing.select(F.col("path").alias("id"), F.col("path").alias("input_file"), shard.alias("track_id"))
    known = known.filter(F.col("track_id") != "t3")
    missing = known.withColumn("input_file", F.concat("input_file", F.lit(".gone")))
    other = known.withColumn("input_file", F.regexp_replace("input_file", "^[a-z0-9]+:", "ftp:"))
    return path, listing, known.unionByName(missing).unionByName(other)


def scan_by_index(spark, sf_dir):
    path, listing, index = shard_index(spark, sf_dir, "scan-by-index")
    refs = valid_refs(index, listing, ("file", "hdfs", "s3", "s3a", "abfss", "gs"))
    return read_by_index(spark, refs, DOC, path).select("doc_id", "lang", "track_id")


QUERIES["scan_by_index"] = scan_by_index
SQL["scan_by_index"] = "SELECT doc_id, lang, 't' || (doc_id % 4) AS track_id FROM documents WHERE doc_id % 4 <> 3"


def scan_binary_docs(spark, sf_dir):
    """Pages in buckets of text files, read as whole objects by reference; one object per bucket does not exist."""
    path = scratch_path(spark, "scan-binary")
    pages = table(spark, sf_dir, "pages").select("html", (F.col("page_id") % 16).alias("bucket"))
    write_any(pages, path, "text", partition_by=["bucket"], maxRecordsPerFile="50")
    listing = list_files(spark, path, "*.txt", recursive=True)
    bucket = F.regexp_extract("input_file", "bucket=([0-9]+)/", 1).cast("bigint").alias("bucket")
    known = listing.select(F.col("path").alias("input_file"), "length")
    gone = known.select(bucket, F.regexp_replace("input_file", "[^/]*$", "gone.txt").alias("input_file")).distinct()
    refs = known.unionByName(gone.select("input_file", F.lit(None).cast("bigint").alias("length")))
    objects = read_objects(spark, refs, path)
    return objects.groupBy(bucket).agg(
        F.sum(F.octet_length("content")).cast("bigint").alias("n_bytes"), F.sum("length").alias("listed_bytes"),
        F.count_if(F.col("_error") == "read_error").alias("read_errors"), F.count("_error_msg").alias("messages"),
    )


QUERIES["scan_binary_docs"] = scan_binary_docs
SQL["scan_binary_docs"] = """SELECT page_id % 16 AS bucket, sum(strlen(html) + 1)::BIGINT AS n_bytes,
  sum(strlen(html) + 1)::BIGINT AS listed_bytes, 1::BIGINT AS read_errors, 1::BIGINT AS messages FROM pages GROUP BY 1"""


def combine_label_files(spark, sf_dir):
    """Positional merge of JSONL files with the in-flight rows of the same files."""
    path = written_docs(spark, sf_dir, "combine-label")
    base = read_jsonl(spark, path, DOC, positions=True, glob=WRITTEN)
    labelled = base.select("input_file", "row_pos", F.length("text").cast("bigint").alias("size"),
                           F.upper("lang").alias("lang"))
    return combine_label(base, labelled, ["lang", "size"]).select("doc_id", "text", "lang", "size")


QUERIES["combine_label_files"] = combine_label_files
SQL["combine_label_files"] = "SELECT doc_id, text, upper(lang) AS lang, length(text)::BIGINT AS size FROM documents"

ORDER_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "clerk"]
ORDER = "o_orderkey bigint, o_orderstatus string, o_totalprice double, clerk string"
ORDERS_SQL = """SELECT o_orderkey, o_orderstatus, o_totalprice,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS clerk FROM orders"""


def orders(spark, sf_dir):
    """Orders with a column that is often NULL."""
    clerk = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").withColumn("clerk", clerk).select(*ORDER_COLS)


def sink_jsonl(spark, sf_dir):
    """Read back as text as well: NULL fields must be written out."""
    path = scratch_path(spark, "sink-jsonl")
    write_jsonl(orders(spark, sf_dir), path)
    explicit = F.col("value").contains('"clerk":null')
    lines = spark.read.text(path).select(F.from_json("value", ORDER).alias("r"), explicit.alias("explicit_null"))
    return lines.select("r.*", "explicit_null")


QUERIES["sink_jsonl"] = sink_jsonl
SQL["sink_jsonl"] = f"SELECT *, clerk IS NULL AS explicit_null FROM ({ORDERS_SQL})"


def sink_any(spark, sf_dir):
    path = f"{scratch_path(spark, 'sink-any')}.orc"
    write_any(orders(spark, sf_dir), path)
    return read_any(spark, path)


QUERIES["sink_any"] = sink_any
SQL["sink_any"] = ORDERS_SQL


def sink_compressed(spark, sf_dir):
    path = scratch_path(spark, "sink-compressed")
    write_jsonl(orders(spark, sf_dir), path, compression="gzip")
    rows = read_any(spark, path, "json", ORDER)
    return rows.select("*", F.col("_metadata.file_name").endswith(".json.gz").alias("is_gzip"))


QUERIES["sink_compressed"] = sink_compressed
SQL["sink_compressed"] = f"SELECT *, true AS is_gzip FROM ({ORDERS_SQL})"


def table_stream(spark, sf_dir, name):
    """A table as a file stream; the pattern lets a table be one file as well as a directory."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def quarter_of_files(spark, path, glob=WRITTEN):
    """Files per micro-batch that make about four micro-batches."""
    return max(1, list_files(spark, path, glob).count() // 4)


def sink_stream(spark, sf_dir):
    """Stream of a table into a file sink that keeps the source file of each row."""
    path = scratch_path(spark, "sink-stream")
    rows = table_stream(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("_metadata.file_path").alias("input_file")
    )
    finish(write_stream(rows, f"{path}/out", f"{path}/checkpoint", "parquet"))
    back = spark.read.parquet(f"{path}/out")
    return back.select("c_custkey", "c_name", F.col("input_file").contains("customer.parquet").alias("has_source"))


QUERIES["sink_stream"] = sink_stream
SQL["sink_stream"] = "SELECT c_custkey, c_name, true AS has_source FROM customer"


def stream_scan_files(spark, sf_dir):
    path = written_docs(spark, sf_dir, "stream-scan")
    rows = stream_jsonl(spark, path, DOC, glob=WRITTEN)
    finish(write_stream(rows, f"{path}-out", f"{path}-checkpoint"))
    return spark.read.schema(DOC).json(f"{path}-out")


QUERIES["stream_scan_files"] = stream_scan_files
SQL["stream_scan_files"] = "SELECT doc_id, text, lang FROM documents"


def _refs_messages(spark, sf_dir, label):
    """A folder of messages that name files: all of them, then in a later file the same again, and one that does not parse."""
    path, listing, index = shard_index(spark, sf_dir, label)
    messages = valid_refs(index, listing, ("file", "hdfs", "s3", "s3a", "abfss", "gs")).select(F.to_json(F.struct("*")).alias("value"))
    broken = spark.range(1).select(F.lit("{not json").alias("value"))
    for part in (messages.union(broken), messages):
        write_any(part.coalesce(1), f"{path}-messages", "text", mode="append")
    return path, stream_refs(spark, "text", path=f"{path}-messages", maxFilesPerTrigger="1")


def stream_scan_refs(spark, sf_dir):
    """Messages that name files, each file named in two micro-batches; a message that does not parse is skipped."""
    path, refs = _refs_messages(spark, sf_dir, "stream-refs")
    finish(run_refs_step(refs, DOC, OPS, f"{path}-out", f"{path}-checkpoint"))
    out = spark.read.schema(f"{DOC}, track_id string, op1 string, op2 bigint").json(f"{path}-out")
    return out.select("doc_id", "lang", "track_id", "op1", "op2")


QUERIES["stream_scan_refs"] = stream_scan_refs
SQL["stream_scan_refs"] = """SELECT doc_id, lang, 't' || (doc_id % 4) AS track_id, 'processed' AS op1, 100::BIGINT AS op2
FROM documents WHERE doc_id % 4 <> 3"""


def stream_refs_chain(spark, sf_dir):
    """Two steps: the files that the first one produces are the references of the second."""
    path, refs = _refs_messages(spark, sf_dir, "refs-chain")
    finish(run_refs_step(refs, DOC, OPS, f"{path}-one", f"{path}-checkpoint-1", refs_out=f"{path}-made"))
    made = stream_refs(spark, "text", path=f"{path}-made", recursiveFileLookup="true")
    middle = f"{DOC}, op1 string, op2 bigint"
    finish(run_refs_step(made, middle, MORE_OPS, f"{path}-two", f"{path}-checkpoint-2"))
    out = spark.read.schema(f"{middle}, op3 string, op4 bigint").json(f"{path}-two")
    return out.select("doc_id", "lang", "op1", "op2", "op3", "op4")


QUERIES["stream_refs_chain"] = stream_refs_chain
SQL["stream_refs_chain"] = """SELECT doc_id, lang, 'processed' AS op1, 100::BIGINT AS op2, 'processed' AS op3, 100::BIGINT AS op4
FROM documents WHERE doc_id % 4 <> 3"""


def set_op_stream_1(spark, sf_dir):
    path = scratch_path(spark, "set-op-stream-1")
    rows = table_stream(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    finish(run_stream_step(rows, [{"name": "op_stream_1"}], f"{path}/out", f"{path}/checkpoint", "parquet"))
    return spark.read.parquet(f"{path}/out")


QUERIES["set_op_stream_1"] = set_op_stream_1
SQL["set_op_stream_1"] = "SELECT c_custkey, c_name, c_mktsegment, 100::BIGINT AS op_stream_1 FROM customer"


def stream_step(spark, sf_dir):
    """A chain with a filter and the scoring model, with its entropy gate, on a stream, in several micro-batches."""
    path = written_docs(spark, sf_dir, "stream-step")
    chain = [{"name": "length_filter", "params": {"min_length": 500}}, {"name": "clean_model_demo", "params": {"text_col": "text"}}, *OPS]
    rows = stream_jsonl(spark, path, DOC, max_files_per_trigger=quarter_of_files(spark, path), glob=WRITTEN)
    finish(run_stream_step(rows, chain, f"{path}-out", f"{path}-checkpoint"))
    back = spark.read.schema(f"{DOC}, clean_prob double, op1 string, op2 bigint").json(f"{path}-out")
    return back.select(*DOC_COLS, r6(F.col("clean_prob")).alias("clean_prob"), "op1", "op2")


QUERIES["stream_step"] = stream_step
SQL["stream_step"] = f"""SELECT doc_id, text, lang, clean_prob, 'processed' AS op1, 100::BIGINT AS op2
FROM documents JOIN ({clean_prob_sql("documents", "text", "")}) USING (doc_id) WHERE length(text) >= 500"""


def sink_per_input(spark, sf_dir):
    """One object per input: by track_id from a table, then by base name from a stream over these objects."""
    path, listing, index = shard_index(spark, sf_dir, "sink-per-input")
    refs = valid_refs(index, listing, ("file", "hdfs", "s3", "s3a", "abfss", "gs"))
    rows = read_by_index(spark, refs, DOC, path)
    write_per_input(rows.withColumn("input_file", F.concat("track_id", F.lit(".jsonl"))), f"{path}-one")
    named = stream_jsonl(spark, f"{path}-one", f"{DOC}, track_id string", max_files_per_trigger=2)
    finish(stream_per_input(apply_operators(named.drop("track_id"), OPS), f"{path}-two", f"{path}-checkpoint", "gzip"))
    back = spark.read.schema(f"{DOC}, op1 string, op2 bigint").json(f"{path}-two")
    return back.select("*", F.col("_metadata.file_name").alias("object"))


QUERIES["sink_per_input"] = sink_per_input
SQL["sink_per_input"] = """SELECT doc_id, text, lang, 'processed' AS op1, 100::BIGINT AS op2, 't' || (doc_id % 4) || '.jsonl.gz' AS object
FROM documents WHERE doc_id % 4 <> 3"""


def run_side_output(spark, sf_dir):
    """Bad lines of a run in a place of their own, good ones through two steps; a run again doubles nothing."""
    path = scratch_path(spark, "run-side")
    whole = F.to_json(F.struct(*DOC_COLS))
    line = F.when(F.col("doc_id") % 6 == 0, F.expr("substring(l, 1, length(l) - 3)")).otherwise(F.col("l"))
    write_any(spread(docs(spark, sf_dir).select("doc_id", whole.alias("l"))).select(line.alias("value")), f"{path}/in", "text")
    config = {
        "dataset": {"input_path": f"{path}/in", "schema": DOC, "glob": "*.txt", "on_error": "quarantine", "output_path": f"{path}/out"},
        "steps": [{"engine_type": "spark-cpu-stream", "operators": OPS,
                   "engine_config": {"side_output": True, "maxFilesPerTrigger": quarter_of_files(spark, f"{path}/in", "*.txt")}},
                  {"engine_type": "spark-cpu-stream", "operators": MORE_OPS}],
    }
    run_steps(spark, config)
    rows = run_steps(spark, config)
    number = F.regexp_extract("_corrupt_record", r'"doc_id":(\d+)', 1).cast("bigint")
    bad = run_bad_rows(spark, f"{path}/out").select(number.alias("doc_id"), F.lit(None).cast("bigint").alias("op4"), "step_id")
    return rows.select("doc_id", "op4", F.lit(None).cast("string").alias("step_id")).unionByName(bad)


QUERIES["run_side_output"] = run_side_output
SQL["run_side_output"] = """SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN 100::BIGINT END AS op4, CASE WHEN doc_id % 6 = 0 THEN 'run_step_1' END AS step_id
FROM documents"""


def stream_dedup_within(spark, sf_dir):
    """All texts, again an hour later, and again after a day, when the state has let them go; the stream is stopped and goes on between.

    Returns the copies that are left of each text, and the digests in the state before the last arrival, which is what time has left.
    """
    path = scratch_path(spark, "stream-within")
    schema = "text string, at timestamp"
    hours = F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp"))
    texts = docs(spark, sf_dir).select("text")
    held = None
    for hour in (0, 1, 10, 11, 12, 24):
        arrived = texts if hour in (0, 1, 24) else spark.range(1).select(F.lit(f"tick {hour}").alias("text"))
        write_any(arrived.withColumn("h", F.lit(hour)).select("text", hours.alias("at")), f"{path}/in/{hour:02d}", "parquet")
        rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}/in")
        query = write_stream(md5_dedup_within(rows, "2 hours", "text", "at"), f"{path}/out", f"{path}/checkpoint", "parquet")
        finish(query)
        if hour == 12:
            held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    back = spark.read.schema(schema).parquet(f"{path}/out").filter("text not like 'tick %'")
    return back.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.hour("at")).cast("bigint").alias("first_hour")).withColumn("few_held", F.lit(held <= 3))


QUERIES["stream_dedup_within"] = stream_dedup_within
SQL["stream_dedup_within"] = "SELECT DISTINCT md5(text) AS digest, 2::BIGINT AS copies, 0::BIGINT AS first_hour, true AS few_held FROM documents"


def _two_steps(spark, sf_dir, engine, trigger, label):
    path = scratch_path(spark, label)
    source = f"{path}/in"
    lines = spread(docs(spark, sf_dir)).select(F.to_json(F.struct(*DOC_COLS)).alias("value"))
    write_any(lines, source, "text")
    config = {
        "dataset": {"input_path": source, "input_type": "data", "schema": DOC, "output_path": f"{path}/out",
                    "glob": "*.txt"},
        "steps": [
            {"engine_type": engine, "operators": OPS, "trigger_event": "job_finished",
             "engine_config": {"maxFilesPerTrigger": quarter_of_files(spark, source, "*.txt")}},
            {"engine_type": engine, "operators": MORE_OPS, "trigger_event": trigger},
        ],
    }
    return run_steps(spark, config).select(*DOC_COLS, "op1", "op2", "op3", "op4")


TWO_STEPS_SQL = """SELECT doc_id, text, lang, 'processed' AS op1, 100::BIGINT AS op2, 'processed' AS op3,
  100::BIGINT AS op4 FROM documents"""

QUERIES["trigger_job_finished"] = lambda s, d: _two_steps(s, d, "spark-cpu-stream", "job_finished", "trigger-job")
SQL["trigger_job_finished"] = TWO_STEPS_SQL
QUERIES["trigger_file_success"] = lambda s, d: _two_steps(s, d, "spark-cpu-stream", "file_success", "trigger-file")
SQL["trigger_file_success"] = TWO_STEPS_SQL


def stream_drain(spark, sf_dir):
    """A second run without new files handles no rows."""
    path = scratch_path(spark, "stream-drain")

    def run():
        rows = table_stream(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
        query = write_stream(rows, f"{path}/out", f"{path}/checkpoint", "parquet")
        finish(query)
        return sum(p["numInputRows"] for p in query.recentProgress)

    run()
    again = run()
    return spark.read.parquet(f"{path}/out").withColumn("rerun_rows", F.lit(again).cast("bigint"))


QUERIES["stream_drain"] = stream_drain
SQL["stream_drain"] = "SELECT o_orderkey, o_orderstatus, 0::BIGINT AS rerun_rows FROM orders"


def stream_resume(spark, sf_dir):
    """Half of the files, then the other half: the second run reads only the new ones."""
    path = scratch_path(spark, "stream-resume")
    for part in (0, 1):
        write_jsonl(docs(spark, sf_dir).filter(F.col("doc_id") % 2 == part), f"{path}/in", mode="append")
        rows = stream_jsonl(spark, f"{path}/in", DOC, glob=WRITTEN).withColumn("pass", F.lit(part).cast("bigint"))
        finish(write_stream(rows, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(f"{DOC}, pass bigint").json(f"{path}/out")


QUERIES["stream_resume"] = stream_resume
SQL["stream_resume"] = "SELECT doc_id, text, lang, doc_id % 2 AS pass FROM documents"


def stream_dedup(spark, sf_dir):
    """Which copy survives depends on arrival, so texts and their number are compared."""
    path = written_docs(spark, sf_dir, "stream-dedup")
    files = 2 * quarter_of_files(spark, path)
    rows = md5_dedup(stream_jsonl(spark, path, DOC, max_files_per_trigger=files, glob=WRITTEN), "text")
    finish(write_stream(rows, f"{path}-out", f"{path}-checkpoint"))
    back = spark.read.schema(DOC).json(f"{path}-out")
    return back.groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count(F.lit(1)).alias("copies"))


QUERIES["stream_dedup"] = stream_dedup
SQL["stream_dedup"] = "SELECT DISTINCT md5(text) AS digest, 1::BIGINT AS copies FROM documents"


def multi_step_batch(spark, sf_dir):
    """Two batch steps from a config: cleaning filters and deduplication, then enrichment."""
    path = scratch_path(spark, "multi-step")
    write_any(docs(spark, sf_dir), f"{path}/in", "parquet")
    config = {
        "pipeline_meta": {"pipeline_name": "cleaning"},
        "dataset": {"input_path": f"{path}/in", "input_format": "parquet", "output_path": f"{path}/out",
                    "output_format": "parquet"},
        "steps": [
            {"engine_type": "spark-cpu-batch", "operators": [
                {"name": "length_filter", "params": {"min_length": 100}},
                {"name": "space_ratio", "params": {"max_ratio": 0.16}},
                {"name": "md5_dedup", "params": {"order_by": "doc_id"}}]},
            {"engine_type": "spark-cpu-batch", "trigger_event": "job_finished", "operators": [*OPS, *MORE_OPS]},
        ],
    }
    return run_steps(spark, config).drop("input_file")


QUERIES["multi_step_batch"] = multi_step_batch
SQL["multi_step_batch"] = """SELECT doc_id, text, lang, 'processed' AS op1, 100::BIGINT AS op2, 'processed' AS op3,
  100::BIGINT AS op4 FROM documents
WHERE length(text) >= 100 AND (length(text) - length(replace(text, ' ', '')))::DOUBLE / length(text) <= 0.16::DOUBLE
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"""


def run_rerun(spark, sf_dir):
    """A batch step before a stream step, run twice, then another run on another input with the same output path."""
    path = scratch_path(spark, "run-rerun")
    for part in (0, 1):
        write_any(docs(spark, sf_dir).filter(F.col("doc_id") % 2 == part), f"{path}/in-{part}", "parquet")
    found = []
    for run_id, part in (("first", 0), ("first", 0), ("second", 1)):
        config = {
            "dataset": {"input_path": f"{path}/in-{part}", "input_format": "parquet", "output_path": f"{path}/out"},
            "steps": [{"engine_type": "spark-cpu-batch", "operators": OPS}, {"engine_type": "spark-cpu-stream", "operators": MORE_OPS}],
        }
        found.append(run_steps(spark, config, run_id).select("doc_id", "op1", "op4", F.lit(run_id).alias("run_id")))
    return found[1].unionByName(found[2])


QUERIES["run_rerun"] = run_rerun
SQL["run_rerun"] = """SELECT doc_id, 'processed' AS op1, 100::BIGINT AS op4, CASE doc_id % 2 WHEN 0 THEN 'first' ELSE 'second' END AS run_id
FROM documents"""


def run_stream_formats(spark, sf_dir):
    """Parquet files in nested folders through stream steps."""
    path = scratch_path(spark, "run-stream-formats")
    write_any(docs(spark, sf_dir).withColumn("part", F.col("doc_id") % 3), f"{path}/in", "parquet", partition_by=["part"])
    config = {
        "dataset": {"input_path": f"{path}/in", "input_format": "parquet", "schema": DOC, "recursive": True, "output_path": f"{path}/out",
                    "output_format": "parquet"},
        "steps": [{"engine_type": "spark-cpu-stream", "operators": OPS},
                  {"engine_type": "spark-cpu-stream", "trigger_event": "file_success", "operators": MORE_OPS}],
    }
    return run_steps(spark, config).select(*DOC_COLS, "op1", "op2", "op3", "op4")


QUERIES["run_stream_formats"] = run_stream_formats
SQL["run_stream_formats"] = TWO_STEPS_SQL


def run_manifest_status(spark, sf_dir):
    """The status table of a finished run, from the manifest that the run has written. A filter leaves no record of some files."""
    path = scratch_path(spark, "run-manifest")
    parts = docs(spark, sf_dir).withColumn("part", F.col("doc_id") % 4)
    parts = parts.withColumn("text", F.when(F.col("part") == 3, "short").otherwise(F.col("text")))
    write_jsonl(parts, f"{path}/in", partition_by=["part"])
    config = {
        "dataset": {"input_path": f"{path}/in", "schema": DOC, "glob": WRITTEN, "recursive": True, "output_path": f"{path}/out"},
        "steps": [{"engine_type": "spark-cpu-stream", "operators": [{"name": "length_filter", "params": {"min_length": 10}}, *OPS]},
                  {"engine_type": "spark-cpu-stream", "operators": MORE_OPS}],
    }
    run_steps(spark, config)
    inputs = list_files(spark, f"{path}/in", WRITTEN, recursive=True).select(normalize_path(F.col("path")).alias("input_file"))
    both = spark.range(1, 3).select(F.lit("run").alias("run_id"), F.concat(F.lit("run_step_"), "id").alias("step_id"))
    status = run_status(run_manifest(spark, f"{path}/out"), inputs.join(F.broadcast(both)))
    return status.select("run_id", "steps", (F.col("finished") == F.col("input_count")).alias("all_finished"), "state")


QUERIES["run_manifest_status"] = run_manifest_status
SQL["run_manifest_status"] = "SELECT 'run' AS run_id, 2::BIGINT AS steps, true AS all_finished, 'success' AS state FROM documents LIMIT 1"


def _status_rows(spark, output_path):
    """State of the run and of each of its steps, from manifest and inputs."""
    manifest, inputs = run_manifest(spark, output_path), run_inputs(spark, output_path)
    return run_status(manifest, inputs).select(F.col("run_id").alias("of"), "state").unionByName(
        step_status(manifest, inputs).select(F.col("step_id").alias("of"), "state"))


@operator("status_probe")
def status_probe(df, output_path, to):
    """Keeps the status of the run at the moment at which the step is planned."""
    if not path_exists(df.sparkSession, to):
        write_any(_status_rows(df.sparkSession, output_path), to, "parquet")
    return df


def run_failed_status(spark, sf_dir):
    """The status of a run between its two steps, after the second one has failed, and after it was run again and succeeded."""
    path = scratch_path(spark, "run-failed")
    write_jsonl(spread(docs(spark, sf_dir)), f"{path}/in")

    def config(condition):
        probe = {"name": "status_probe", "params": {"output_path": f"{path}/out", "to": f"{path}/between"}}
        return {
            "dataset": {"input_path": f"{path}/in", "schema": DOC, "glob": WRITTEN, "output_path": f"{path}/out"},
            "steps": [{"engine_type": "spark-cpu-stream", "operators": OPS},
                      {"engine_type": "spark-cpu-stream", "operators": [probe, {"name": "require", "params": {"condition": condition}}, *MORE_OPS]}],
        }

    try:
        run_steps(spark, config("doc_id < 0"))
    except Exception as error:
        if "doc_id < 0" not in str(error):
            raise
    write_any(_status_rows(spark, f"{path}/out"), f"{path}/failed", "parquet")
    rows = run_steps(spark, config("doc_id >= 0"))
    write_any(_status_rows(spark, f"{path}/out"), f"{path}/again", "parquet")
    found = spark.read.schema("of string, state string").parquet(f"{path}/between", f"{path}/failed", f"{path}/again")
    phase = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    counted = rows.agg(F.count(F.lit(1)).alias("rows"))
    return found.select(phase.alias("phase"), "of", "state").join(F.broadcast(counted))


QUERIES["run_failed_status"] = run_failed_status
SQL["run_failed_status"] = """SELECT phase, "of", state, (SELECT count(*) FROM documents)::BIGINT AS rows FROM (VALUES
  ('between', 'run', 'running'), ('between', 'run_step_1', 'success'), ('between', 'run_step_2', 'pending'),
  ('failed', 'run', 'failed'), ('failed', 'run_step_1', 'success'), ('failed', 'run_step_2', 'failed'),
  ('again', 'run', 'success'), ('again', 'run_step_1', 'success'), ('again', 'run_step_2', 'success')) v(phase, "of", state)"""


def run_stop_resume(spark, sf_dir):
    """A run that is stopped after some of its files and started again: every record once, and the states of its step."""
    path = scratch_path(spark, "run-stop")
    write_jsonl(docs(spark, sf_dir).repartition(10), f"{path}/in")
    config = {
        "dataset": {"input_path": f"{path}/in", "schema": DOC, "glob": WRITTEN, "output_path": f"{path}/out"},
        "steps": [{"engine_type": "spark-cpu-stream", "operators": [*OPS, *MORE_OPS], "engine_config": {"maxFilesPerTrigger": 1}}],
    }
    run = start_steps(spark, config)
    while not run.states().filter("batches > 0").count():
        pass
    run.stop()
    stopped = run.wait() is None
    first = run.states().first()
    before = spark.read.schema(DOC).json(f"{path}/out/run/final_output").count()
    rows = run_steps(spark, config)
    last = run.states().first()
    return rows.select(
        "doc_id", "op1", "op4", F.lit(first.state).alias("state_before"), F.lit(last.state).alias("state_after"),
        F.lit(stopped and first.output_rows == before > 0).alias("counted"), F.lit(last.output_rows + before).cast("bigint").alias("rows"))


QUERIES["run_stop_resume"] = run_stop_resume
SQL["run_stop_resume"] = """SELECT doc_id, 'processed' AS op1, 100::BIGINT AS op4, 'stopped' AS state_before, 'success' AS state_after, true AS counted,
  (SELECT count(*) FROM documents)::BIGINT AS rows FROM documents"""


def config_chain(spark, sf_dir):
    """The configured filter chain on records: (track_id, content_list), no column named in the parameters."""
    records = as_blocks(table(spark, sf_dir, "documents")).select(F.concat(F.lit("t"), "doc_id").alias("track_id"), "content_list")
    chain = [{"name": "length_filter", "params": {"min_length": 100}}, {"name": "space_ratio", "params": {"max_ratio": 0.16}},
             {"name": "md5_dedup", "params": {}}]
    return apply_operators(records, chain).select("track_id", F.size("content_list").cast("bigint").alias("blocks"))


QUERIES["config_chain"] = config_chain
SQL["config_chain"] = f"""WITH {CONTENT_SQL}, kept AS (
  SELECT 't' || doc_id AS track_id, content, len(content_list)::BIGINT AS blocks FROM contents JOIN records USING (doc_id)
  WHERE length(content) >= 100
    AND (length(content) - length(replace(content, ' ', '')))::DOUBLE / length(content) <= 0.16::DOUBLE)
SELECT track_id, blocks FROM kept QUALIFY row_number() OVER (PARTITION BY md5(content) ORDER BY track_id) = 1"""
