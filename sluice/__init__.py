"""Cleaning and scoring of text corpora on Spark."""

import sys

from pyspark import cloudpickle

from sluice import operators  # noqa: F401  (registers the named operators)
from sluice.plans.registry import apply_operators, get_operator, list_operators, operator
from sluice.plans.runner import run_steps
from sluice.sinks.files import write_any, write_jsonl
from sluice.sources.files import list_files, read_any, read_binary, read_by_index, read_jsonl

__all__ = [
    "apply_operators", "get_operator", "list_operators", "operator", "run_steps", "write_any", "write_jsonl",
    "list_files", "read_any", "read_binary", "read_by_index", "read_jsonl",
]

# Functions of this package travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
