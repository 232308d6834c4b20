"""Operators that set a field to a constant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.plans.registry import operator


def add_literal(df: DataFrame, name: str, value: str | int | float | bool) -> DataFrame:
    """Set ``name`` to a constant, replacing an existing column. Integers are 64 bit, as in JSON."""
    literal = F.lit(value)
    if isinstance(value, int) and not isinstance(value, bool):
        literal = literal.cast("bigint")
    return df.withColumn(name, literal)


# The demo operators and the constant each one sets.
LITERAL_OPERATORS = {
    "op1": "processed",
    "op2": 100,
    "op3": "processed",
    "op4": 100,
    "op_stream_1": 100,
}

for _name, _value in LITERAL_OPERATORS.items():
    operator(_name)(lambda df, name=_name, value=_value: add_literal(df, name, value))
