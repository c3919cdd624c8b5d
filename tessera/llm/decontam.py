"""Benchmark decontamination in DataFrame functions only: a broadcast hash set of test n-grams, scanned and verified."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, cut, sized, weigh


@dataclass(frozen=True)
class DecontamParams:
    """Windows of ``width`` consecutive words; an item of fewer words is one window. The benchmark's windows are broadcast
    in blocks of ``block_bytes``, one as a rule, and the corpus is scanned once a block."""

    width: int = 10
    block_bytes: int = 32 << 20


_LOWER_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased words of digits, letters a-z and characters beyond ASCII; empty for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), _LOWER_GAP, -1), ""), F.array().cast("array<string>"))


def _marks(w: Column, width: int) -> Column:
    """By start: a hash of four words of the window. It is cheap to scan with and misses no window."""
    starts = F.sequence(F.lit(0), F.size(w) - width)
    mark = lambda i: F.xxhash64(F.lit(width), *[F.get(w, i + F.lit(j)) for j in _sampled(width)])
    return F.when(F.size(w) >= width, F.transform(starts, mark)).otherwise(F.array())


def _sampled(width: int) -> list[int]:
    """Places of the words of a window that its mark is made of."""
    return [0, (width - 1) // 3, 2 * (width - 1) // 3, width - 1]


def benchmark_windows(benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """``item_id, width, mark, window`` of every window of ``benchmark(item_id, text)``; ids as text."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("w")).where("size(w) > 0 and item_id is not null")
    items = items.withColumn("width", F.least(F.size("w"), F.lit(params.width)))
    starts = items.select("item_id", "width", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("width"))).alias("i"))
    mark = F.lit(None).cast("long")
    for n in range(1, params.width + 1):
        mark = F.when(F.col("width") == n, F.xxhash64(F.lit(n), *[F.get("w", F.col("i") + j) for j in _sampled(n)])).otherwise(mark)
    window = F.array_join(F.slice(F.col("w"), F.col("i") + 1, F.col("width")), " ")
    return starts.select("item_id", "width", mark.alias("mark"), window.alias("window")).distinct()


def _text_key(text: Column) -> Column:
    """128 bits of a text: hits depend on nothing else, so copies are looked into once."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def find_hits(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """Per distinct contaminated text: ``key, n_hit, n_items, items_sha256, spans``; spans are ``start, width`` in words.

    The marks of a text meet the broadcast set of marks as they are made, and where one is found the window itself is
    compared; no more than the windows found leave the scan.
    """
    spark = docs.sparkSession
    with Scratch(spark, "decontam") as scratch:
        known = scratch.save(benchmark_windows(benchmark, params), "windows")
        widths = [r["width"] for r in known.select("width").distinct().collect()]  # at most params.width values
        texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null").withColumn("key", _text_key(F.col("text"))).withColumn("w", words(F.col("text")))
        # marks are a column before they are exploded: explosion, join and comparison then run as one compiled loop, in
        # which no row with its words is written out; and "outer" has no filter made of them, for which they would be
        # worked out word by word
        if len(widths) == 1:
            rows = texts.withColumn("x", _marks(F.col("w"), widths[0])).select("key", "w", F.lit(widths[0]).alias("width"), F.posexplode_outer("x").alias("start", "mark"))
        else:
            entry = lambda n: lambda m, i: F.struct(F.lit(n).alias("width"), i.alias("start"), m.alias("mark"))
            every = [F.transform(_marks(F.col("w"), n), entry(n)) for n in widths]
            marks = F.concat(*every) if every else F.array().cast("array<struct<width:int,start:int,mark:bigint>>")
            rows = texts.withColumn("x", marks).select("key", "w", F.explode_outer("x").alias("e")).select("key", "w", "e.*")
        blocks = max(1, -(-weigh(known) // params.block_bytes))
        hits = None
        for b in range(blocks):
            mine = known.where(F.pmod(F.col("mark"), F.lit(blocks)) == b) if blocks > 1 else known
            mine = mine.select(F.col("width").alias("k_width"), F.col("mark").alias("k_mark"), "window", "item_id")
            # not a key of the join, which would be worked out for every window, but a comparison where marks met
            text = F.array_join(F.slice(F.col("w"), F.col("start") + 1, F.col("width")), " ")
            same = (text >= F.col("window")) & (text <= F.col("window"))
            found = rows.join(F.broadcast(mine), (F.col("width") == F.col("k_width")) & (F.col("mark") == F.col("k_mark")) & same).select("key", "start", "width", "item_id")
            hits = found if hits is None else hits.union(found)
        # a text has at most one entry a word and width, whatever the number of its copies
        per = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "width"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda a, s: F.struct(F.greatest(a["end"], s["start"] + s["width"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["start"] + s["width"] - F.greatest(a["end"], s["start"]))).alias("n"))
        return cut(per.select("key", F.aggregate("spans", zero, step, lambda a: a["n"]).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs(doc_id, text, ...)``.

    Null and empty texts have no words and no hits; items with null id, null text or no words are ignored. Repeated rows
    are answered each, whatever their doc_id. With an empty benchmark nothing is contaminated; the digest of no items is
    that of the empty string. Texts are read whole, however long. Windows that several items share are found for each of
    them. Other columns, whatever their names, are not read.
    """
    hits = find_hits(docs, benchmark, params).drop("spans")
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP, -1), "")).cast("long").alias("n_words"), _text_key(text).alias("key"))
    # both sides are slim, and contaminated texts grow with the corpus: no broadcast
    return rows.join(hits, "key", "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark window occurs; all columns pass through, but for one named ``__key``.

    Rows of null or empty text stay. Up to 16 MB of contaminated texts' keys are broadcast; beyond that texts are dealt.
    """
    docs = docs.drop("__key")
    hits = find_hits(docs, benchmark, params).select(F.col("key").alias("__key"))
    return docs.withColumn("__key", _text_key(F.col("text").cast("string"))).join(sized(hits), "__key", "left_anti").drop("__key")


def remove_spans(docs: DataFrame, benchmark: DataFrame, params: DecontamParams = DecontamParams()) -> DataFrame:
    """``docs`` with the words of benchmark windows taken out; a text that changes becomes its words with single blanks.

    Null, empty and clean texts stay as they are. Columns pass through, but for those named ``__key`` and ``__spans``.
    """
    docs = docs.drop("__key", "__spans")
    hits = find_hits(docs, benchmark, params).select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    keyed = docs.withColumn("__key", _text_key(F.col("text").cast("string"))).join(sized(hits), "__key", "left")
    w = words(F.col("text").cast("string"))
    left = F.filter(w, lambda _, i: ~F.exists("__spans", lambda s: (s["start"] <= i) & (i < s["start"] + s["width"])))
    return keyed.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(left, " "))).select(*docs.columns)
