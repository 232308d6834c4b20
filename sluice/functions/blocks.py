"""Content blocks: ``array<struct<type, md, text>>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The block vocabulary and the two sets of kept types.
BLOCK_TYPES = ("text", "quote", "list", "code", "table", "image", "audio", "video", "hr", "equation")
KEPT_TYPES = {
    "nlp": ("text", "quote", "list", "table"),
    "text": ("text", "quote", "list", "table", "code", "equation"),
}

CONTENT_LIST_SCHEMA = "array<struct<type:string,md:string,text:string>>"


def dropped_types(kind: str) -> list[str]:
    """Known types that a kind leaves out. Types outside the vocabulary are never dropped."""
    if kind not in KEPT_TYPES:
        raise ValueError(f"unknown block kind {kind!r}; known: {sorted(KEPT_TYPES)}")
    return [t for t in BLOCK_TYPES if t not in KEPT_TYPES[kind]]


def _fields(df: DataFrame, col: str) -> list[str]:
    dtype = df.schema[col].dataType
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, T.StructType):
        raise TypeError(f"{col} is not an array of blocks")
    return dtype.elementType.fieldNames()


def block_body(block: Column, fields: list[str] | tuple[str, ...] = ("md", "text")) -> Column:
    """Markdown when non-empty, else text when non-empty, else the empty string."""
    present = [F.nullif(block.getField(f), F.lit("")) for f in ("md", "text") if f in fields]
    return F.coalesce(*present, F.lit(""))


def kept_blocks(blocks: Column, kind: str = "text") -> Column:
    """Blocks whose type is not excluded; a NULL type counts as unknown and stays."""
    excluded = dropped_types(kind)
    return F.filter(blocks, lambda b: ~F.coalesce(b.getField("type"), F.lit("")).isin(excluded))


def filter_blocks(df: DataFrame, col: str = "content_list", kind: str = "text", out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, kept_blocks(F.col(col), kind))


def block_markdown(df: DataFrame, col: str = "content_list", out: str = "bodies") -> DataFrame:
    fields = _fields(df, col)
    return df.withColumn(out, F.transform(F.col(col), lambda b: block_body(b, fields)))


def content_of(df: DataFrame, src: str = "content_list", kind: str = "text") -> Column:
    """Bodies of the kept blocks, joined by a blank line; an empty body keeps its separator."""
    fields = _fields(df, src)
    return F.array_join(F.transform(kept_blocks(F.col(src), kind), lambda b: block_body(b, fields)), "\n\n")


def concat_content(df: DataFrame, src: str = "content_list", out: str = "content", kind: str = "text") -> DataFrame:
    """Add the joined content of a block column."""
    return df.withColumn(out, content_of(df, src, kind))
