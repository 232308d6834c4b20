"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.files import REST, format_of, has_rest


# Settings by format: files are written so that every text keeps its white space, quotes and line breaks, and are read back with
# the second ones. A text with line breaks spans lines, so such a CSV file is one split; an empty text in CSV comes back as null.
WRITE_OPTIONS = {
    "json": {"ignoreNullFields": "false"},
    "csv": {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
}
READ_BACK = {"csv": {"escape": '"', "multiLine": "true", "lineSep": "\n"}}


def as_lines(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Records as JSON lines (``value``) with the fields of ``_rest`` put back; a named column wins over a field of its name."""
    named = [c for c in df.columns if c != REST and c not in (partition_by or [])]
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in named]), {"ignoreNullFields": "false"})
    fields = F.map_filter(F.col(REST).cast("map<string, variant>"), lambda k, v: ~k.isin([*named, *(partition_by or [])]))
    rest = F.when(F.size(fields) > 0, F.to_json(fields))
    inner = F.expr(f"substring({REST}_json, 2, length({REST}_json) - 2)")
    with_rest = df.withColumn(f"{REST}_json", rest).withColumn("__record", record)
    line = F.when(F.col(f"{REST}_json").isNull(), F.col("__record")).otherwise(
        F.concat(F.expr("substring(__record, 1, length(__record) - 1)"), F.lit("," if named else ""), inner, F.lit("}")))
    return with_rest.select(*[F.col(f"`{c}`") for c in partition_by or []], line.alias("value"))


def json_as_text(df: DataFrame, fmt: str, partition_by: list[str] | None) -> tuple[DataFrame, str]:
    """What is written in place of JSON rows that carry fields without a column."""
    return (as_lines(df, partition_by), "text") if fmt == "json" and has_rest(df.schema) else (df, fmt)


def _writer(df: DataFrame, fmt: str, mode: str, compression: str | None, partition_by: list[str] | None, options: dict):
    df, fmt = json_as_text(df, fmt, partition_by)
    writer = df.write.format(fmt).mode(mode).options(**WRITE_OPTIONS.get(fmt, {}))
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.options(**options)


def write_jsonl(
    df: DataFrame,
    path: str,
    compression: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """One JSON object per line with explicit nulls; ``compression="gzip"`` gives gzip files.

    Records read with ``open_records`` get their other fields back; Spark names such files ``*.txt``.
    """
    _writer(df, "json", mode, compression, partition_by, options).save(path)


def write_any(
    df: DataFrame,
    path: str,
    fmt: str | None = None,
    mode: str = "overwrite",
    compression: str | None = None,
    partition_by: list[str] | None = None,
    **options: str,
) -> None:
    """Write in any Spark format; the format follows from the suffix unless given."""
    _writer(df, fmt or format_of(path), mode, compression, partition_by, options).save(path)
