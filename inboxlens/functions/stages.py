"""Funnel stage rank and event-type predicates as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_LABELS, EventLabels


def stage_rank(labels: EventLabels = DEFAULT_LABELS, col: str = "type_event") -> Column:
    """1 for SENT ... 5 for FORWARDED; null for types outside the funnel."""
    expr = None
    for rank, (_, stage_labels) in enumerate(labels.stages(), start=1):
        cond = F.col(col).isin(*stage_labels)
        expr = F.when(cond, F.lit(rank)) if expr is None else expr.when(cond, F.lit(rank))
    return expr


def count_if(cond: Column) -> Column:
    """Number of rows meeting ``cond`` as a long (0 when none)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")
