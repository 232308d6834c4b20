"""Registered form of the content-block transforms."""

from sluice.functions.blocks import concat_content, filter_blocks
from sluice.plans.registry import operator

operator("concat_content")(concat_content)
operator("filter_blocks")(filter_blocks)
