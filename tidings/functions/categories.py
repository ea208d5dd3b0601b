"""Vendor category -> canonical category."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import CATEGORY_MAPS, NO_CATEGORY


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def category_map(category: Column, aggregator: Column) -> Column:
    """Canonical category for the row's aggregator; unmapped or null -> 'n/a'."""
    expr = None
    for agg, mapping in CATEGORY_MAPS.items():
        val = (F.try_element_at(_literal_map(mapping), category) if mapping
               else F.lit(None).cast("string"))
        expr = F.when(aggregator == agg, val) if expr is None else expr.when(aggregator == agg, val)
    return F.coalesce(expr, F.lit(NO_CATEGORY))


def category_multi(categories: Column, aggregator: Column) -> Column:
    """Map every element of an array of categories and join them with ','."""
    return F.array_join(F.transform(categories, lambda c: category_map(c, aggregator)), ",")
