"""Joins by row address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fragment_of


def fragment_join(left: DataFrame, right: DataFrame, left_key: str = "_rowaddr", right_key: str = "_rowaddr", how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Joins on addresses with both sides dealt by fragment, so that rows of a fragment meet in one task.

    The fragment is part of the join's keys: Spark then needs no further exchange, and a fragment's rows, which are
    neighbours in their file, stay together. Sides that are already dealt so are not dealt again.
    """
    l, r = left.withColumn("__lf", fragment_of(left_key)), right.withColumn("__rf", fragment_of(right_key))
    l = l.withColumnRenamed(left_key, "__lk") if left_key in right.columns else l.withColumn("__lk", F.col(left_key))
    lk, rk = F.col("__lk"), F.col(right_key)
    same = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    out = l.repartition("__lf").join(r.repartition("__rf"), same(F.col("__lf"), F.col("__rf")) & same(lk, rk), how)
    if left_key in right.columns and how not in ("left_semi", "left_anti"):
        key = F.coalesce(lk, rk).alias(left_key)
        return out.select(key, *[c for c in left.columns if c != left_key], *[c for c in right.columns if c != right_key])
    if how in ("left_semi", "left_anti"):
        return out.withColumnRenamed("__lk", left_key).select(*left.columns) if left_key in right.columns else out.select(*left.columns)
    return out.drop("__lf", "__rf", "__lk")
