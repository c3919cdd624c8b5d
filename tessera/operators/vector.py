"""Exact nearest neighbours."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument


def distance(column: Column | str, key: list[float], kind: str = "l2") -> Column:
    """Squared L2, cosine or negative dot-product distance of an array column to a vector, in doubles."""
    c = F.col(column) if isinstance(column, str) else column
    q = F.array(*[F.lit(float(x)) for x in key])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    up = F.transform(c, lambda x: x.cast("double"))
    kind = kind.lower()
    if kind in ("l2", "euclidean"):
        return total(F.zip_with(up, q, lambda a, b: (a - b) * (a - b)))
    dot = total(F.zip_with(up, q, lambda a, b: a * b))
    if kind == "dot":
        return 1 - dot
    if kind == "cosine":
        size = F.sqrt(total(F.transform(up, lambda x: x * x))) * F.lit(sum(float(x) ** 2 for x in key) ** 0.5)
        return 1 - F.try_divide(dot, size)
    raise InvalidArgument(f"unknown distance {kind}")


def nearest(df: DataFrame, request: str | dict, tie: str | None = None) -> DataFrame:
    """The ``k`` rows nearest to ``key``, with ``_distance``: over the whole table, kept by each task on the way.

    ``request``: JSON or a dict of column, key, k (10), distanceType (l2). Index hints (minimumNprobes, maximumNprobes,
    ef, refineFactor, useIndex) are accepted: the search is exact. Null vectors and vectors of another length are left
    out; equal distances are ordered by ``tie``, or by the first column.
    """
    r = json.loads(request) if isinstance(request, str) else dict(request)
    column, key, k = r.get("column"), r.get("key"), int(r.get("k", 10))
    if column not in df.columns or not key:
        raise InvalidArgument("nearest needs a column of the table and a key")
    if k <= 0:
        raise InvalidArgument("k must be positive")
    d = distance(column, key, r.get("distanceType") or "l2")
    rows = df.where(F.size(F.col(column)) == len(key)).withColumn("_distance", d)
    return rows.orderBy("_distance", tie or df.columns[0]).limit(k)
