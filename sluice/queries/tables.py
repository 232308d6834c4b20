"""Joins, references, progress and status tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.labels import combine_label, rank_positions
from sluice.operators.progress import merge_manifest, run_status, step_complete, step_progress
from sluice.operators.refs import count_inputs, file_refs, skip_done, valid_refs
from sluice.queries.common import table

QUERIES, SQL = {}, {}


def combine_label_query(spark, sf_dir):
    """Zip documents and labels by position inside each of four files."""
    file = F.concat(F.lit("part-"), F.col("doc_id") % 4)
    docs = table(spark, sf_dir, "documents").select(file.alias("input_file"), "doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select(
        file.alias("input_file"), F.col("doc_id").alias("label_id"), "quality", F.lit(None).cast("bigint").alias("n_chars")
    )
    base = rank_positions(docs, "input_file", "doc_id")
    labelled = rank_positions(labels, "input_file", "label_id")
    return combine_label(base, labelled, ["label_id", "quality", "n_chars"]).drop("n_chars")


QUERIES["combine_label"] = combine_label_query
SQL["combine_label"] = """WITH d AS (
  SELECT 'part-' || (doc_id % 4) AS input_file, doc_id, lang,
    row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS row_pos FROM documents),
l AS (
  SELECT 'part-' || (doc_id % 4) AS input_file, doc_id AS label_id, quality,
    row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS row_pos FROM labels)
SELECT input_file, doc_id, lang, row_pos::BIGINT AS row_pos, label_id, quality
FROM d JOIN l USING (input_file, row_pos)"""


def combine_label_by_key_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return combine_label(docs, table(spark, sf_dir, "labels"), ["quality", "toxic"], on="doc_id")


QUERIES["combine_label_by_key"] = combine_label_by_key_query
SQL["combine_label_by_key"] = """SELECT doc_id, text, lang, source, n_chars, quality, toxic
FROM documents JOIN labels USING (doc_id)"""


def page_refs(spark, sf_dir):
    """References to all pages, plus an unsupported scheme for every seventh."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    refs = pages.select(F.col("page_id").cast("string").alias("id"), F.col("url").alias("input_file"),
                        F.concat(F.lit("t"), "page_id").alias("track_id"))
    bad = pages.filter(F.col("page_id") % 7 == 0).select(
        F.col("page_id").cast("string").alias("id"), F.regexp_replace("url", "^https?://", "ftp://").alias("input_file"),
        F.concat(F.lit("t"), "page_id").alias("track_id"))
    return refs.unionByName(bad)


def page_listing(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(F.col("page_id") % 3 != 0).select(F.col("url").alias("path"))


PAGE_REFS_SQL = """refs AS (
  SELECT page_id::VARCHAR AS id, url AS input_file, 't' || page_id AS track_id FROM pages
  UNION ALL SELECT page_id::VARCHAR, regexp_replace(url, '^https?://', 'ftp://'), 't' || page_id FROM pages
  WHERE page_id % 7 = 0)"""


def valid_refs_query(spark, sf_dir):
    return valid_refs(page_refs(spark, sf_dir), page_listing(spark, sf_dir), ("http", "https"))


QUERIES["valid_refs"] = valid_refs_query
SQL["valid_refs"] = f"""WITH {PAGE_REFS_SQL} SELECT * FROM refs WHERE regexp_matches(input_file, '^https?:')
  AND input_file IN (SELECT url FROM pages WHERE page_id % 3 <> 0)"""


def input_count_query(spark, sf_dir):
    """Documents stand for files: most are JSONL, some gzip, some neither, and names repeat."""
    suffix = F.when(F.col("doc_id") % 5 == 0, ".txt").when(F.col("doc_id") % 5 == 1, ".jsonl.gz").otherwise(".jsonl")
    path = F.concat(F.lit("s3a://in/"), "source", F.lit("/"), F.floor(F.col("doc_id") / 2), suffix)
    return count_inputs(table(spark, sf_dir, "documents").select(path.alias("path")))


QUERIES["input_count"] = input_count_query
SQL["input_count"] = """SELECT count(DISTINCT source || '/' || (doc_id // 2) || CASE doc_id % 5 WHEN 1 THEN '.jsonl.gz'
  ELSE '.jsonl' END)::BIGINT AS input_count FROM documents WHERE doc_id % 5 <> 0"""


def run_inputs(spark, sf_dir):
    """Inputs of four runs with four steps each, and the order they came from."""
    run = F.concat(F.lit("r"), (F.floor(F.col("o_orderkey") / 4) % 4).cast("string"))
    return table(spark, sf_dir, "orders").select(
        run.alias("run_id"),
        F.concat(run, F.lit("_step_"), (F.col("o_orderkey") % 4 + 1).cast("string")).alias("step_id"),
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("input_file"),
        "o_orderkey", "o_orderstatus",
    )


def run_manifest(spark, sf_dir):
    """Inputs with one file, with two, packed into a common file, skipped, failed, and tried again."""
    rows = run_inputs(spark, sf_dir).filter((F.col("o_orderstatus") != "P") | (F.col("run_id") == "r1"))
    number = F.substring("input_file", 2, 20).cast("bigint")
    kind, own = number % 10, F.concat(F.lit("out/"), "input_file")
    packed = F.concat(F.lit("out/pack"), F.floor(number / 10).cast("string"))
    failed = (F.col("run_id") == "r0") & (F.col("o_orderkey") % 97 == 0)
    keys = ["run_id", "step_id", "input_file"]
    tried = rows.select(
        *keys, F.when(kind == 4, F.lit(None)).when(kind.isin(2, 3), packed).otherwise(own).alias("output_file"),
        F.when(kind == 4, "skipped").when(failed, "failed").otherwise("success").alias("state"), F.lit(0).alias("attempt"))
    second = rows.filter(kind == 1).select(*keys, F.concat(own, F.lit("-b")).alias("output_file"), F.lit("success").alias("state"),
                                           F.lit(0).alias("attempt"))
    again = rows.filter(failed & (F.col("o_orderkey") % 194 == 0) & (kind != 4)).select(
        *keys, F.concat(own, F.lit("-again")).alias("output_file"), F.lit("success").alias("state"), F.lit(1).alias("attempt"))
    return tried.unionByName(second).unionByName(again)


RUNS_SQL = """inputs AS (
  SELECT 'r' || ((o_orderkey // 4) % 4) AS run_id,
    'r' || ((o_orderkey // 4) % 4) || '_step_' || (o_orderkey % 4 + 1) AS step_id,
    'f' || o_custkey AS input_file, o_custkey, o_orderkey, o_orderstatus FROM orders),
tried AS (SELECT *, o_custkey % 10 AS kind, run_id = 'r0' AND o_orderkey % 97 = 0 AS failed FROM inputs
  WHERE o_orderstatus <> 'P' OR run_id = 'r1'),
manifest AS (
  SELECT run_id, step_id, input_file, CASE WHEN kind = 4 THEN NULL WHEN kind IN (2, 3) THEN 'out/pack' || (o_custkey // 10)
      ELSE 'out/' || input_file END AS output_file,
    CASE WHEN kind = 4 THEN 'skipped' WHEN failed THEN 'failed' ELSE 'success' END AS state, 0 AS attempt FROM tried
  UNION ALL SELECT run_id, step_id, input_file, 'out/' || input_file || '-b', 'success', 0 FROM tried WHERE kind = 1
  UNION ALL SELECT run_id, step_id, input_file, 'out/' || input_file || '-again', 'success', 1 FROM tried
  WHERE failed AND o_orderkey % 194 = 0 AND kind <> 4),
ended AS (
  SELECT run_id, step_id, input_file, bool_or(state = 'failed') AS failed FROM manifest m
  WHERE attempt = (SELECT max(attempt) FROM manifest x WHERE x.run_id = m.run_id AND x.step_id = m.step_id AND x.input_file = m.input_file)
  GROUP BY ALL),
steps AS (
  SELECT run_id, step_id, input_count, finished, coalesce(progress, 0) AS progress, CASE WHEN any_failed THEN 'failed'
    WHEN finished >= input_count THEN 'success' WHEN finished > 0 THEN 'running' ELSE 'pending' END AS state
  FROM (SELECT run_id, step_id, count(*) AS input_count, count(failed) AS finished, coalesce(bool_or(failed), false) AS any_failed
    FROM (SELECT DISTINCT run_id, step_id, input_file FROM inputs) LEFT JOIN ended USING (run_id, step_id, input_file) GROUP BY ALL)
  LEFT JOIN (SELECT run_id, step_id, count(DISTINCT output_file) AS progress FROM manifest GROUP BY ALL) USING (run_id, step_id))"""


def step_progress_query(spark, sf_dir):
    return step_progress(run_manifest(spark, sf_dir))


QUERIES["step_progress"] = step_progress_query
SQL["step_progress"] = f"""WITH {RUNS_SQL}
SELECT step_id, count(DISTINCT output_file)::BIGINT AS progress FROM manifest GROUP BY step_id"""


def step_complete_query(spark, sf_dir):
    return step_complete(run_manifest(spark, sf_dir), run_inputs(spark, sf_dir))


QUERIES["step_complete"] = step_complete_query
SQL["step_complete"] = f"""WITH {RUNS_SQL}
SELECT step_id, input_count::BIGINT AS input_count, finished::BIGINT AS finished, progress::BIGINT AS progress,
  finished >= input_count AS complete FROM steps"""


def run_status_query(spark, sf_dir):
    return run_status(run_manifest(spark, sf_dir), run_inputs(spark, sf_dir))


QUERIES["run_status"] = run_status_query
SQL["run_status"] = f"""WITH {RUNS_SQL}
SELECT run_id, count(*)::BIGINT AS steps, sum(progress)::BIGINT AS progress, sum(input_count)::BIGINT AS input_count,
  sum(finished)::BIGINT AS finished, CASE WHEN bool_or(state = 'failed') THEN 'failed' WHEN bool_and(state = 'success') THEN 'success' ELSE 'running' END
  AS state FROM steps GROUP BY run_id"""


def progress_union_query(spark, sf_dir):
    """First attempts, and a newer manifest that holds the retries and repeats a third of the first attempts as successes."""
    manifest = run_manifest(spark, sf_dir)
    first = manifest.filter("attempt = 0")
    third = F.length("input_file") % 3 == 0
    newer = manifest.filter("attempt = 1").unionByName(
        first.filter(third & (F.col("state") == "failed")).withColumn("state", F.lit("success")))
    return merge_manifest(first, newer)


QUERIES["progress_union"] = progress_union_query
SQL["progress_union"] = f"""WITH {RUNS_SQL}, aged AS (
  SELECT *, 1 AS age FROM manifest WHERE attempt = 0
  UNION ALL SELECT *, 0 FROM manifest WHERE attempt = 1
  UNION ALL SELECT run_id, step_id, input_file, output_file, 'success', 0, 0 FROM manifest
  WHERE attempt = 0 AND state = 'failed' AND length(input_file) % 3 = 0)
SELECT run_id, step_id, input_file, output_file, state, attempt FROM aged
QUALIFY row_number() OVER (PARTITION BY run_id, step_id, input_file, output_file ORDER BY attempt DESC, age, state) = 1"""


def skip_done_query(spark, sf_dir):
    """Inputs of the first run that no step of it has produced yet, one row per order."""
    inputs = run_inputs(spark, sf_dir)
    done = run_manifest(spark, sf_dir).filter(F.col("run_id") == "r2")
    return skip_done(inputs.select("step_id", "input_file", "o_orderkey"), done)


QUERIES["skip_done"] = skip_done_query
SQL["skip_done"] = f"""WITH {RUNS_SQL} SELECT step_id, input_file, o_orderkey FROM inputs
WHERE input_file NOT IN (SELECT input_file FROM manifest WHERE run_id = 'r2')"""


def sink_refs_query(spark, sf_dir):
    manifest = run_manifest(spark, sf_dir).select(F.col("input_file").alias("id"), "input_file", "step_id", "output_file")
    return file_refs(manifest).unionByName(file_refs(manifest, keep_fields=False))


QUERIES["sink_refs"] = sink_refs_query
SQL["sink_refs"] = f"""WITH {RUNS_SQL}
SELECT '{{"id":"' || input_file || '","step_id":"' || step_id || '","input_file":"' || output_file || '"}}' AS value
FROM manifest WHERE output_file IS NOT NULL
UNION ALL SELECT '{{"id":"' || output_file || '","input_file":"' || output_file || '"}}' FROM manifest WHERE output_file IS NOT NULL"""
