"""User functions over record dictionaries, run in Arrow batches.

Native expressions are the first choice; these jobs are for logic that only exists as Python code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ERROR_FIELDS = [T.StructField("_error", T.StringType()), T.StructField("_error_msg", T.StringType())]
ROWS_PER_BATCH = 1000


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _keep_convertible(records: list[dict], failed: Callable, arrow: pa.Schema) -> list[dict]:
    """Results of a batch that fit the schema, tested one by one after the whole batch was refused."""
    kept = []
    for source, result in records:
        try:
            pa.RecordBatch.from_pylist([result], schema=arrow)
        except (pa.ArrowException, TypeError, ValueError) as error:
            result = failed(source, error)
        if result is not None:
            kept.append(result)
    return kept


def run_rows(
    df: DataFrame,
    fn: Callable[..., dict],
    schema: str | T.StructType,
    init: Callable[[], Any] | None = None,
    on_error: str = "drop",
    profile: Any = None,
) -> DataFrame:
    """Apply ``fn(record) -> record`` to every row.

    ``init`` runs once per task; its result is passed as ``fn(record, resource)``. A record whose function
    raises, or whose result does not fit ``schema``, is dropped (``drop``), kept with ``_error`` and
    ``_error_msg`` next to those of its fields that are in the schema (``quarantine``), or fails the job
    (``fail``). ``profile`` is a ResourceProfile for stage-level scheduling, for instance on GPU nodes.
    """
    if on_error not in ("drop", "quarantine", "fail"):
        raise ValueError(f"on_error is drop, quarantine or fail, not {on_error!r}")
    out = as_struct(schema)
    if on_error == "quarantine":
        out = T.StructType(out.fields + ERROR_FIELDS)
    arrow, names = to_arrow_schema(out), out.fieldNames()

    def failed(source: dict, error: Exception) -> dict | None:
        if on_error == "fail":
            raise error
        if on_error == "drop":
            return None
        kept = {k: v for k, v in source.items() if k in names}
        return {**kept, "_error": type(error).__name__, "_error_msg": str(error)}

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (init(),) if init else ()
        for batch in batches:
            done = []
            for source in batch.to_pylist():
                try:
                    result = fn(dict(source), *extra)
                except Exception as error:  # user code may raise anything
                    result = failed(source, error)
                if result is not None:
                    done.append((source, result))
            try:
                yield pa.RecordBatch.from_pylist([r for _, r in done], schema=arrow)
            except (pa.ArrowException, TypeError, ValueError):
                yield pa.RecordBatch.from_pylist(_keep_convertible(done, failed, arrow), schema=arrow)

    return df.mapInArrow(process, out, profile=profile)


def run_partitions(
    df: DataFrame,
    fn: Callable[..., Iterable[dict]],
    schema: str | T.StructType,
    init: Callable[[], Any] | None = None,
    profile: Any = None,
) -> DataFrame:
    """Apply ``fn(iterator of records) -> iterator of records`` to every partition.

    The function may drop, change or add records. Both sides are streamed, a partition is never held whole.
    """
    out = as_struct(schema)
    arrow = to_arrow_schema(out)

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = (init(),) if init else ()
        records = (record for batch in batches for record in batch.to_pylist())
        results = iter(fn(records, *extra))
        while chunk := list(islice(results, ROWS_PER_BATCH)):
            yield pa.RecordBatch.from_pylist(chunk, schema=arrow)

    return df.mapInArrow(process, out, profile=profile)


def fan_out(
    df: DataFrame, fn: Callable[..., Iterable[tuple]], args: list[str], schema: str | T.StructType, keep_empty: bool = False,
    init: Callable[[], Any] | None = None,
) -> DataFrame:
    """Each row with what ``fn(*args of the row)`` yields, as new columns: none, one or many rows for one.

    A lateral join with a table function that runs in Arrow batches: only ``args`` cross to Python, the other columns stay in the JVM and are
    not shuffled. ``init`` runs once per task; its result is passed as first argument. With ``keep_empty`` a row for which nothing is
    yielded is kept with nulls. New columns must not have names of old ones.
    """
    out = as_struct(schema)
    clash = set(out.fieldNames()) & set(df.columns)
    if clash:
        raise ValueError(f"columns that are there already: {sorted(clash)}")

    class Each:
        def __init__(self) -> None:
            self._extra = (init(),) if init else ()

        def eval(self, *values: Any) -> Iterator[tuple]:
            none = True
            for row in fn(*self._extra, *values):
                none = False
                yield row
            if none and keep_empty:  # an inner join with a row of nulls is a generator; an outer lateral join is not
                yield nothing

    nothing = (None,) * len(out.fields)
    table = F.udtf(Each, returnType=out, useArrow=True)
    return df.lateralJoin(table(*[F.col(f"`{a}`").outer() for a in args]))
