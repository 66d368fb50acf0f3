"""A value that an expression refers to several times, in the plan once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(use: Callable[[Column], Column], **values: Column) -> Column:
    """use(v) with v.name for each value: nested rules otherwise multiply in the plan with every reference."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), use), F.lit(0))
