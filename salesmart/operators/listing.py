"""List filters and paging (FL10-FL14, SO1-SO3).

A filter spec is a plain dict; each entry becomes a native predicate that
Catalyst pushes to the scan (``PushedFilters``).  Paging is a sort on an
allowed column with the key as tie-break (D13), then offset/limit - the
limit is the feature here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class PageSpec:
    """FL14: page >= 1, 1 <= limit <= 100 (default 20), sort asc/desc."""
    page: int = 1
    limit: int = 20
    sort_by: str | None = None
    sort_order: str = "asc"

    def __post_init__(self):
        if self.page < 1:
            raise ValueError("page must be >= 1")
        if not 1 <= self.limit <= 100:
            raise ValueError("limit must be between 1 and 100")
        if self.sort_order not in ("asc", "desc"):
            raise ValueError("sort_order must be asc or desc")


def _pred(col: str, op: str, value, case_insensitive: bool = False) -> Column:
    c = F.col(col)
    if op == "eq":
        return (F.lower(c) == F.lower(F.lit(value))) if case_insensitive and isinstance(value, str) else c == value
    if op == "contains":
        return F.lower(c).contains(str(value).lower()) if case_insensitive else c.contains(str(value))
    if op == "gte":
        return c >= value
    if op == "lte":
        return c <= value
    if op == "gt":
        return c > value
    if op == "lt":
        return c < value
    if op == "between":
        lo, hi = value
        return c.between(lo, hi)
    raise ValueError(f"unknown operator {op}")


def apply_filter_spec(df: DataFrame, spec: dict, case_insensitive: bool = False) -> DataFrame:
    """FL10-FL13: ``{"Canal": ("eq", "WEB"), "Total": ("gte", 0), ...}``.

    A bound of 0 is honoured (D16); numeric bounds compare numerically."""
    for col, (op, value) in spec.items():
        if value is None:
            continue
        df = df.where(_pred(col, op, value, case_insensitive))
    return df


def page(df: DataFrame, key: str, spec: PageSpec, allowed: tuple[str, ...]) -> DataFrame:
    """SO1/SO2: sort by an allowed column (else the key), key as tie-break."""
    col = spec.sort_by if spec.sort_by in allowed else key
    o = F.col(col).desc() if spec.sort_order == "desc" else F.col(col).asc()
    k = F.col(key).desc() if spec.sort_order == "desc" else F.col(key).asc()
    ordered = df.orderBy(o, k) if col != key else df.orderBy(o)
    return ordered.offset((spec.page - 1) * spec.limit).limit(spec.limit)


def page_after(df: DataFrame, key: str, spec: PageSpec, allowed: tuple[str, ...], last: tuple | None) -> DataFrame:
    """SO1/SO2 for deep pages: the rows that follow ``last`` = (sort value, key) of the page before.

    The border is a filter that reaches the scan, so every page costs a top-k of
    ``limit`` rows however far down it is; ``spec.page`` does not enter.  Null
    sort values come first ascending and last descending, as in ``page``."""
    col = spec.sort_by if spec.sort_by in allowed else key
    down = spec.sort_order == "desc"
    if last is not None:
        v, k = last
        c = F.col(col)
        past_key = F.col(key) < F.lit(k) if down else F.col(key) > F.lit(k)
        if col == key:
            df = df.where(past_key)
        elif v is None:
            df = df.where(c.isNull() & past_key if down else c.isNotNull() | past_key)
        elif down:
            df = df.where((c < F.lit(v)) | ((c == F.lit(v)) & past_key) | c.isNull())
        else:
            df = df.where((c > F.lit(v)) | ((c == F.lit(v)) & past_key))
    o = [F.col(x).desc() if down else F.col(x).asc() for x in ([col, key] if col != key else [col])]
    return df.orderBy(*o).limit(spec.limit)


def page_count(df: DataFrame, limit: int) -> DataFrame:
    """SO1: total rows and pages (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("total")).withColumn("paginas", F.ceil(F.col("total") / F.lit(limit)))
