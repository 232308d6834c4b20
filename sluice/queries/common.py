"""Helpers shared by the registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_CYCLE = ("text", "image", "code", "hr", "mystery")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(col: Column) -> Column:
    """Six digits, by the same arithmetic as :func:`r6_sql`."""
    return F.floor(col * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def r6_sql(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5::DOUBLE) / 1e6"


def as_blocks(df: DataFrame, text_col: str = "text", out: str = "content_list") -> DataFrame:
    """One content block per line: the type cycles, every second block has markdown."""
    kinds = F.array(*[F.lit(t) for t in BLOCK_CYCLE])

    def block(line: Column, pos: Column) -> Column:
        marked = F.concat(F.lit("**"), line, F.lit("**"))
        return F.struct(
            F.element_at(kinds, pos % len(BLOCK_CYCLE) + 1).alias("type"),
            F.when(pos % 2 == 0, F.lit("")).otherwise(marked).alias("md"),
            line.alias("text"),
        )

    return df.withColumn(out, F.transform(F.split(F.col(text_col), "\n"), block))


RECORDS_SQL = """records AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda line, i: struct_pack(
    "type" := (['text', 'image', 'code', 'hr', 'mystery'])[((i - 1) % 5) + 1],
    md := CASE WHEN (i - 1) % 2 = 0 THEN '' ELSE '**' || line || '**' END,
    "text" := line)) AS content_list
  FROM documents)"""

BODY_SQL = "coalesce(nullif(b.md, ''), nullif(b.text, ''), '')"

CONTENT_SQL = f"""{RECORDS_SQL}, contents AS (
  SELECT doc_id, array_to_string(list_transform(
    list_filter(content_list, lambda b: b.type NOT IN ('image', 'audio', 'video', 'hr')),
    lambda b: {BODY_SQL}), chr(10) || chr(10)) AS content
  FROM records)"""
