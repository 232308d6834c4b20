"""From raw documents to packed training sequences: five stages, each a Spark job over what the one before it kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.mixing import mixed_documents
from sluice.llm.near_duplicates import keep_one_per_group
from sluice.llm.packing import pack_documents
from sluice.llm.pii import redact
from sluice.llm.quality_rules import keep_good
from sluice.llm.queries import vocabulary_path
from sluice.queries.common import table
from sluice.session import arrow_batches, materialize, recorded_scratch, remove_scratch, scratch_path

_BATCH = 500  # texts that cross to Python together
_scratch: dict[tuple[str, str], list[str]] = {}  # by table folder and stage: scratch of results that the next stage has not begun on


def _stage(fn):
    """A stage that first removes the scratch folders of the stage before it, made for the same tables.

    By then the rows of that stage have been written and read again, so nothing needs its scratch; otherwise each stage would
    leave a copy of the corpus until the end. Stages that are called by themselves, or for other tables, keep theirs.
    """
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        order = [stage.__name__ for _, stage in STAGES]
        place = order.index(fn.__name__)
        if place:
            remove_scratch(spark, _scratch.pop((sf_dir, order[place - 1]), []))
        with recorded_scratch() as made:
            out = fn(spark, docs, sf_dir)
        _scratch.setdefault((sf_dir, fn.__name__), []).extend(made)
        return out

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted quality rules reject go."""
    return keep_good(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id."""
    return keep_one_per_group(docs)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return redact(docs)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document taken twice is two rows."""
    return mixed_documents(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids: one row per piece, with its ids.

    Written here, while few texts cross to Python together: the session's 10,000 would lie in the JVM and in Python several times.
    """
    with arrow_batches(spark, _BATCH):
        return materialize(pack_documents(docs, vocabulary_path(), with_ids=True), "packed")


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", personal_data), ("source mix", mix),
          ("packing", pack)]

#: Expectation-maximisation, the span classifier and the tokenizer have no counterpart in SQL; the tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
