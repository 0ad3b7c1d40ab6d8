"""Row validation as data (FL15-FL18): rule list -> violations column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def violations(rules: list[tuple[str, Column]]) -> Column:
    """``array`` of rule codes whose condition is TRUE (null conditions pass)."""
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(code)) for code, cond in rules]))
