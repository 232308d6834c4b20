"""Scalar expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_div(a: Column, b: Column) -> Column:
    """a / b with 0/0 = NaN and x/0 = +inf for either sign of x; NULL in, NULL out."""
    num, den = a.cast("double"), b.cast("double")
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when((den == 0) & (num == 0), F.lit(float("nan")))
        .when(den == 0, F.lit(float("inf")))
        .otherwise(num / den)
    )


def basename(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def normalize_path(path: Column) -> Column:
    """One spelling per file: ``file:///x`` and ``file:/x`` agree, and so do s3, s3n and s3a."""
    slashes = F.regexp_replace(path, r"^file:/+", "file:/")
    return F.regexp_replace(slashes, r"^s3n?://", "s3a://")


def metadata_path(path: Column) -> Column:
    """A path from ``_metadata``, which is percent-encoded there and nowhere else, in the spelling of listings and references."""
    return normalize_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def flatten_struct(df: DataFrame, col: str, sep: str = ".") -> DataFrame:
    """Replace struct column ``col`` by one column per leaf, named by its path below ``col``.

    Two columns of one name are an error.
    """

    def leaves(dtype: T.StructType, ref: Column, name: tuple[str, ...]):
        for field in dtype.fields:
            child, path = ref.getField(field.name), (*name, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, child, path)
            else:
                yield child.alias(sep.join(path))

    dtype = df.schema[col].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{col} is not a struct column")
    kept = [F.col(f"`{c}`") for c in df.columns if c != col]
    flat = df.select(*kept, *leaves(dtype, F.col(f"`{col}`"), ()))
    twice = sorted({c for c in flat.columns if flat.columns.count(c) > 1})
    if twice:
        raise ValueError(f"flattening {col} gives several columns named {twice}; pass another separator or rename first")
    return flat


def from_json_col(df: DataFrame, col: str, schema: str | T.StructType, out: str | None = None) -> DataFrame:
    """Decode JSON text into a struct; undecodable text becomes NULL fields."""
    return df.withColumn(out or col, F.from_json(F.col(col), schema))


def to_json_col(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """Encode columns as one JSON object per row, with explicit nulls kept."""
    return df.withColumn(out, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
