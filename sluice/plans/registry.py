"""Named operators: a name, a kind and a function ``f(df, **params) -> df``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame

Transform = Callable[..., DataFrame]


@dataclass(frozen=True)
class Operator:
    name: str
    kind: str
    fn: Transform


_OPERATORS: dict[str, Operator] = {}


def operator(name: str, kind: str = "default") -> Callable[[Transform], Transform]:
    """Register a DataFrame transform under a unique name."""
    if not name or not kind:
        raise TypeError("an operator needs a name and a kind")

    def register(fn: Transform) -> Transform:
        if name in _OPERATORS:
            raise KeyError(f"operator {name!r} is already registered as {_OPERATORS[name].fn.__name__}")
        _OPERATORS[name] = Operator(name, kind, fn)
        return fn

    return register


def get_operator(name: str, params: dict[str, Any] | None = None) -> Callable[[DataFrame], DataFrame]:
    """The named operator with its parameters bound."""
    if name not in _OPERATORS:
        raise KeyError(f"unknown operator {name!r}; known operators: {sorted(_OPERATORS)}")
    fn, bound = _OPERATORS[name].fn, dict(params or {})
    return lambda df: fn(df, **bound)


def list_operators() -> dict[str, Operator]:
    return dict(_OPERATORS)


def apply_operators(df: DataFrame, operators: Iterable[dict[str, Any]]) -> DataFrame:
    """Apply ``[{"name", "params"}, ...]`` from left to right.

    Names are resolved before the first operator runs, so a typo fails early.
    """
    steps = [get_operator(op["name"], op.get("params")) for op in operators]
    return reduce(lambda acc, step: acc.transform(step), steps, df)
