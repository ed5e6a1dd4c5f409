"""Value bands for the issue histograms."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges in days of the open-interval bands.
INTERVAL_EDGES = (1, 7, 30, 90, 180, 365, 730, 1095, 1460)

# Upper edges of the comment-count and issue-number bands; the
# band of 0 holds exactly 0, the others everything up to their edge.
LEVEL_EDGES = (0, 10, 100, 1000, 10000, 100000, 1000000)

OTHERS = "others"


def first_match(cases: Iterable[tuple[Column, str]], otherwise: str = OTHERS) -> Column:
    """Label of the first true condition; NULL conditions fall through."""
    chain = reduce(lambda acc, case: acc.when(case[0], F.lit(case[1])), cases, F)
    return chain.otherwise(F.lit(otherwise))


def interval_names() -> list[str]:
    return [f"I{edge}" for edge in INTERVAL_EDGES] + [OTHERS]


def level_names(prefix: str) -> list[str]:
    return [f"{prefix}{edge}" for edge in LEVEL_EDGES] + [OTHERS]


def interval_label(days: Column) -> Column:
    return first_match((days <= edge, f"I{edge}") for edge in INTERVAL_EDGES)


def level_label(value: Column, prefix: str) -> Column:
    return first_match(
        (value == edge if edge == 0 else value <= edge, f"{prefix}{edge}") for edge in LEVEL_EDGES
    )
