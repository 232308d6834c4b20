"""Importing this package registers every named operator."""

from sluice.operators import blocks, documents, filters, labels, literals, models, tree_models  # noqa: F401
