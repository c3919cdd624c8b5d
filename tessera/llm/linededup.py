"""Line deduplication by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut


@dataclass(frozen=True)
class LineParams:
    """A line goes from a host's pages if at least ``min_pages`` of them hold it and they are more than ``max_ratio`` of
    the host's pages. A host has at most (mean distinct lines a page) / max_ratio such lines, however large it is."""

    max_ratio: float = 0.1
    min_pages: int = 5
    salts: int = 32


#: Lines to drop, over all hosts, that are broadcast once counted; beyond it the join is dealt by host and salt.
BROADCAST_LINES = 200_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits of a line without the blanks around it; null for a blank line, which is never dropped."""
    x = F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(x != "", F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))


def boilerplate(docs: DataFrame, host: str = "source", params: LineParams = LineParams()) -> DataFrame:
    """``host, key, pages, ratio`` of the lines to drop."""
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col("text").cast("string").alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _key))).alias("key")).where("key is not null")
    counts = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= params.min_pages)
    return counts.join(totals, "host").withColumn("ratio", F.col("pages") / F.col("total")).where(F.col("ratio") > params.max_ratio).select("host", "key", "pages", "ratio")


def drop_boilerplate(docs: DataFrame, host: str = "source", params: LineParams = LineParams()) -> DataFrame:
    """``docs`` with lines over the boilerplate ratio of their host taken out of ``text``, and ``n_lines``, ``n_dropped``.

    Pages of a null host form one host, together with the empty one. Null text stays null with 0 lines; an empty text is
    one blank line. A line repeated within a page counts once for the ratio and is dropped each time. Repeated rows are
    pages of their own. Columns other than text pass through, but for those named as the two new ones, which they replace.
    """
    docs = docs.drop("n_lines", "n_dropped", "__host", "__drop", "__kept", "__salt")
    # a few lines a host, see LineParams
    found = cut(boilerplate(docs, host, params).groupBy("host").agg(F.collect_set("key").alias("__drop")).withColumnRenamed("host", "__host"))
    lines = found.select(F.sum(F.size("__drop")).alias("n"), F.count(F.lit(1)).alias("hosts")).first()
    keyed = docs.withColumn("__host", F.coalesce(F.col(host).cast("string"), F.lit("")))
    if (lines["n"] or 0) <= BROADCAST_LINES:
        joined = keyed.join(F.broadcast(found), "__host", "left")
    else:  # a host may have a third of the pages: deal its pages to several tasks
        salt = F.pmod(F.xxhash64("text"), F.lit(params.salts)).cast("int")
        joined = keyed.withColumn("__salt", F.coalesce(salt, F.lit(0))).join(found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1)))), ["__host", "__salt"], "left").drop("__salt")
    lines = _lines(F.col("text").cast("string"))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), _key(x)), F.lit(False)))
    joined = joined.withColumn("__kept", F.when(F.col("__drop").isNull(), lines).otherwise(kept)).withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"))
    joined = joined.withColumn("n_dropped", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("__kept")).cast("long"))
    text = F.when(F.col("n_dropped") > 0, F.array_join("__kept", "\n")).otherwise(F.col("text").cast("string"))
    return joined.withColumn("text", text).select(*docs.columns, "n_lines", "n_dropped")
