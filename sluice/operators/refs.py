"""File references: ``id, input_file, track_id`` rows that name files to process."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.scalar import normalize_path

REF_SCHEMA = "id string, input_file string, track_id string"
JSONL_NAME = r"\.jsonl(\.gz)?$"


def parse_file_refs(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode JSON messages (text or Kafka bytes) into references; messages without a file are dropped."""
    ref = F.from_json(F.col(value_col).cast("string"), REF_SCHEMA)
    return raw.select(ref.alias("__ref")).select("__ref.*").filter(F.col("input_file").isNotNull())


def file_refs(manifest: DataFrame, keep_fields: bool = True) -> DataFrame:
    """One JSON message per produced file, for the next step to consume; inputs without an output have none.

    With ``keep_fields`` a message keeps the other fields of its row and its ``input_file`` becomes the output
    file; without, it holds only ``id`` and ``input_file``, both the output file.
    """
    manifest, produced = manifest.filter(F.col("output_file").isNotNull()), F.col("output_file")
    if keep_fields:
        others = [F.col(f"`{c}`") for c in manifest.columns if c not in ("input_file", "output_file")]
        message = F.struct(*others, produced.alias("input_file"))
    else:
        message = F.struct(produced.alias("id"), produced.alias("input_file"))
    return manifest.select(F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def valid_refs(
    index: DataFrame,
    existing: DataFrame,
    schemes: tuple[str, ...] = ("s3", "s3a", "file"),
    path_col: str = "path",
) -> DataFrame:
    """References with a supported scheme whose file is in the listing ``existing``."""
    listed = existing.select(normalize_path(F.col(path_col)).alias("__path")).distinct()
    supported = index.filter(F.col("input_file").rlike(f"^({'|'.join(schemes)}):"))
    return supported.join(listed, normalize_path(F.col("input_file")) == F.col("__path"), "left_semi")


def count_inputs(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """Number of distinct JSONL files in a listing."""
    return listing.filter(F.col(path_col).rlike(JSONL_NAME)).agg(F.countDistinct(path_col).alias("input_count"))


def skip_done(refs: DataFrame, manifest: DataFrame) -> DataFrame:
    """References whose file has no row in the manifest yet; one that only failed is not done."""
    done = manifest.filter(F.col("state") != "failed") if "state" in manifest.columns else manifest
    done = done.select(normalize_path(F.col("input_file")).alias("__done")).distinct()
    return refs.join(done, normalize_path(F.col("input_file")) == F.col("__done"), "left_anti")
