"""Size bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, limits: Sequence[float]) -> Column:
    """0 above the first limit, 1 above the second, ...; ``len(limits)`` at or below the last one."""
    result = F.when(value.isNull(), F.lit(None).cast("int"))
    for number, limit in enumerate(limits):
        result = result.when(value > limit, number)
    return result.otherwise(len(limits))


def pick(number: Column, values: Sequence) -> Column:
    """The entry of ``values`` at a band number."""
    return F.element_at(F.array(*map(F.lit, values)), number + 1)
