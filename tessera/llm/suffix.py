"""Removal of byte strings that occur twice: suffix-array deduplication over a partitioned corpus.

Equal strings of ``least`` bytes have the same minimiser, the smallest hash among their ``anchor``-byte substrings. Runs
of windows with one minimiser at one place form segments, so equal windows always lie in different segments of one group
(a minimiser's segments). A group with one segment repeats nothing; one whose segments are all equal repeats everything; in the
others, the distinct segments go through a suffix array of their own (``bwt.py``), which finds the equal windows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bwt import END, repeated_starts
from .common import Scratch, as_bytes, cut, mix, sized

_STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class SuffixParams:
    """``chunk_bytes`` of distinct segments share a suffix array. A group beyond ``group_bytes`` is not gathered in a
    task: its windows are counted by 128-bit hashes instead, spread over all tasks."""

    least: int = 200
    anchor: int = 64
    chunk_bytes: int = 1 << 20
    group_bytes: int = 8 << 20


class _Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, as far as they were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n += n // 2
            for name, step in (("up", _STEP), ("down", pow(_STEP, -1, 2**64))):
                x = np.full(n, step, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x))
        return self.up, self.down


def minimiser_runs(text: bytes, params: SuffixParams, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimisers and ``start, end`` bytes of the segments of a text of ``least`` bytes or more."""
    k, w = params.anchor, params.least - params.anchor + 1
    up, down = powers.grow(len(text) + 1)
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    x += np.uint64(1)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=total[1:])
    h = mix((total[k:] - total[:-k]) * down[: len(x) - k + 1])
    n = len(h)
    grid = np.full(-(-n // w) * w, 2**64 - 1, np.uint64)
    grid[:n] = h
    grid = grid.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    # a window's minimiser is the leftmost of its value: another segment begins where that leaves the window
    new = (low[1:] != low[:-1]) | (h[: len(low) - 1] == low[:-1])
    start = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(new) + 1])
    end = np.append(start[1:], len(low)) + params.least - 1
    return low[start], start, end


def text_keys(text: Column) -> list[Column]:
    """128 bits of a text, which stand for it: copies have equal coverage."""
    return [F.xxhash64(text).alias("ka"), F.xxhash64(F.lit(1), text).alias("kb")]


_SEGMENT = "ka long, kb long, id long, h long, ch long, start int, len int, times int"


def _distinct(h: np.ndarray, ch: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """``h, ch, start, len, times`` of a text's distinct segments, and of the runs of bytes that repeated ones cover
    (times 0)."""
    order = np.lexsort((start, ch, h))
    x, y = h[order], ch[order]
    lead = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    times = np.diff(np.append(lead, len(order)))
    first = order[lead]
    again = np.sort(order[np.repeat(times > 1, times)])
    runs = np.array(merge_spans(list(zip(start[again].tolist(), end[again].tolist(), strict=True))), np.int64).reshape(-1, 2)
    none = np.zeros(len(runs), np.uint64)
    return np.append(h[first], none), np.append(ch[first], none), np.append(start[first], runs[:, 0]), np.append(end[first] - start[first], runs[:, 1] - runs[:, 0]), np.append(times, np.zeros(len(runs), np.int64))


def segments(texts: DataFrame, params: SuffixParams) -> DataFrame:
    """``ka, kb, id, h, ch, start, len, times`` of each distinct segment of each of ``texts(ka, kb, id, text)``.

    ch is the hash of a segment's bytes; it occurs ``times`` in its text. A periodic text would have a segment for each
    period, so those that a text repeats itself are covered here: rows without h are covered bytes.
    """

    def run(batches):
        import pyarrow as pa
        import xxhash

        powers = _Powers()
        with np.errstate(over="ignore"):
            for batch in batches:
                parts, owner = [], []
                size = 0

                def flush():
                    h, ch, s, n, times = (np.concatenate([p[j] for p in parts]) for j in range(5))
                    take = pa.array(np.repeat([i for i, _ in owner], [m for _, m in owner]))
                    return pa.RecordBatch.from_arrays([*(batch.column(j).take(take) for j in range(3)), pa.array(h.view(np.int64), mask=times == 0), pa.array(ch.view(np.int64)), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(times.astype(np.int32))], ["ka", "kb", "id", "h", "ch", "start", "len", "times"])

                for i, text in enumerate(as_bytes(batch.column(3))):
                    if len(text) < params.least:
                        continue
                    h, a, b = minimiser_runs(text, params, powers)
                    view = memoryview(text)
                    ch = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
                    part = _distinct(h, ch, a, b)
                    parts.append(part)
                    owner.append((i, len(part[0])))
                    size += len(part[0])
                    if size > 50_000:
                        yield flush()
                        parts, owner, size = [], [], 0
                if parts:
                    yield flush()

    return texts.select("ka", "kb", "id", "text").mapInArrow(run, _SEGMENT)


def _slices(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """``wanted(ka, kb, h, ch, m, start, len)`` with the segments' ``bytes``, out of one of the texts of each key."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows, take, held = [], [], 0
            for i, (text, places) in enumerate(zip(as_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True)):
                for p in places:
                    rows.append((p["h"], p["ch"], p["m"], p["start"], text[p["start"] : p["start"] + p["len"]]))
                    take.append(i)
            if rows:
                cols = list(zip(*rows, strict=True))
                at = pa.array(take, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True))], ["ka", "kb", "h", "ch", "m", "start", "bytes"])

    # a text has few segments more than (its bytes / 50), so the list is bounded by the text
    per = wanted.groupBy("ka", "kb", "id").agg(F.collect_list(F.struct("h", "ch", "m", "start", "len")).alias("places"))
    return texts.join(per, ["ka", "kb", "id"]).select("ka", "kb", "text", "places").mapInArrow(run, "ka long, kb long, h long, ch long, m long, start int, bytes binary")


def _runs(starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes covered by windows at ascending ``starts``, as begins and ends of maximal runs."""
    gap = np.flatnonzero(np.diff(starts) > least)
    return starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + least


def _chunked(pieces: DataFrame, params: SuffixParams) -> DataFrame:
    """``ka, kb, s, e``: covered bytes of the segments that occur once, found by suffix arrays over whole groups."""
    least = params.least

    def solve(rows):
        found = []
        marked = [r[5] + b"\xff" for r in rows]
        x = np.frombuffer(b"".join(marked), np.uint8)
        hit = repeated_starts(x, least)
        at = 0
        for (ka, kb, _, m, start, data), piece in zip(rows, marked, strict=True):
            if m == 1:
                begins = np.flatnonzero(hit[at : at + len(data)])
                if len(begins):
                    s, e = _runs(begins, least)
                    found += [(ka, kb, start + int(i), start + int(j)) for i, j in zip(s, e, strict=True)]
            at += len(piece)
        return found

    def run(batches):
        import pyarrow as pa

        assert END == 0xFF
        group, rows, size, seen, now = [], [], 0, set(), None

        def out(found):
            cols = list(zip(*found, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["ka", "kb", "s", "e"])

        for batch in batches:
            for ka, kb, h, ch, m, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != now:
                    rows += group
                    group, seen, now = [], set(), h
                    if size >= params.chunk_bytes:
                        yield out(solve(rows))
                        rows, size = [], 0
                if ch not in seen:  # repeated rows of a document bring a segment twice
                    seen.add(ch)
                    group.append((ka, kb, ch, m, start, data))
                    size += len(data)
        rows += group
        if rows:
            yield out(solve(rows))

    return pieces.select("ka", "kb", "h", "ch", "m", "start", "bytes").repartition("h").sortWithinPartitions("h").mapInArrow(run, "ka long, kb long, s int, e int")


def _counted(pieces: DataFrame, params: SuffixParams) -> DataFrame:
    """The same as ``_chunked`` for groups too large for a task: equal windows meet by hash, combined on the map side, and
    those found become runs before a text's are gathered."""
    least = params.least

    def windows(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for ka, kb, h, m, start, data in zip(*(batch.column(j).to_pylist() for j in (0, 1, 2, 4, 5, 6)), strict=True):
                n = len(data) - least + 1
                d = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[i : i + least]) for i in range(n)]), np.int64).reshape(-1, 2)
                full = lambda v, n=n: pa.array(np.full(n, v, np.int64))
                yield pa.RecordBatch.from_arrays([full(ka), full(kb), full(m), pa.array(np.arange(start, start + n, dtype=np.int32)), pa.array(d[:, 0]), pa.array(d[:, 1])], ["ka", "kb", "m", "s", "wa", "wb"])

    w = pieces.select("ka", "kb", "h", "ch", "m", "start", "bytes").mapInArrow(windows, "ka long, kb long, m long, s int, wa long, wb long")
    twice = w.groupBy("wa", "wb").agg(F.sum("m").alias("n")).where("n > 1").select("wa", "wb")
    hits = w.where("m = 1").join(twice, ["wa", "wb"], "left_semi")
    near = hits.groupBy("ka", "kb", F.shiftright("s", 12).alias("b")).agg(F.collect_set("s").alias("starts"))  # 4096 at most

    def runs(batches):
        import pyarrow as pa

        for batch in batches:
            found = [_runs(np.sort(np.array(x.as_py(), np.int32)), least) for x in batch.column(2)]
            take = pa.array(np.repeat(np.arange(len(found)), [len(s) for s, _ in found]))
            s, e = (np.concatenate([x[j] for x in found]) if found else np.zeros(0, np.int32) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["ka", "kb", "s", "e"])

    return near.select("ka", "kb", "starts").mapInArrow(runs, "ka long, kb long, s int, e int")


def coverage(texts: DataFrame, scratch: Scratch, params: SuffixParams) -> DataFrame:
    """``ka, kb, spans``: the covered bytes ``s, e`` of each text that has any, in order; spans may touch and overlap."""
    # copies of a text repeat all of it; one of them stands for the others from here on
    copies = cut(texts.groupBy("ka", "kb").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("bytes")).where("n > 1").drop("n"))
    texts = texts.join(sized(copies.select("ka", "kb", "first")), ["ka", "kb"], "left").where("first is null or id = first").drop("first")
    whole = copies.select("ka", "kb", F.lit(0).alias("s"), F.col("bytes").alias("e"))
    segs = scratch.save(segments(texts, params), "segments")
    own = scratch.save(segs.where("h is null").select("ka", "kb", F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e")), "own")
    segs = segs.where("h is not null")
    stats = segs.groupBy("h").agg(F.sum("times").alias("n"), F.min("ch").alias("c0"), F.max("ch").alias("c1")).where("n > 1").select("h", (F.col("c0") != F.col("c1")).alias("mixed"))
    shared = scratch.save(segs.join(stats.hint("shuffle_hash"), "h"), "shared")
    scratch.drop("segments")
    alike = shared.where("not mixed").select("ka", "kb", F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e"))
    mixed = shared.where("mixed")
    contents = mixed.groupBy("h", "ch").agg(F.sum("times").alias("m"), F.min(F.struct("ka", "kb", "id", "start", "len")).alias("at"))
    contents = scratch.save(contents.select("h", "ch", "m", "at.*"), "contents")
    twice = mixed.join(contents.where("m > 1").select("h", "ch"), ["h", "ch"], "left_semi").select("ka", "kb", F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e"))
    groups = scratch.save(contents.groupBy("h").agg(F.min("m").alias("least"), F.sum("len").alias("bytes")).where("least = 1").select("h", "bytes"), "groups")
    pieces = scratch.save(_slices(contents.join(groups.select("h"), "h", "left_semi"), texts), "pieces")
    large = cut(groups.where(F.col("bytes") > params.group_bytes).select("h"))
    found = [whole, own, alike, twice]
    if large.isEmpty():
        found.append(_chunked(pieces, params))
    else:
        found.append(_chunked(pieces.join(sized(large), "h", "left_anti"), params))
        found.append(_counted(pieces.join(sized(large), "h", "left_semi"), params))
    every = found[0]
    for x in found[1:]:
        every = every.union(x)
    # distinct spans of a text: fewer than its bytes, however many copies it has
    cover = scratch.save(every.groupBy("ka", "kb").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans")), "cover")
    for name in ("own", "shared", "contents", "groups", "pieces"):
        scratch.drop(name)
    return cover


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of ascending spans."""
    out: list[list[int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def cut_out(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for s, e in runs:
        kept.append(text[at:s])
        at = e
    return b"".join([*kept, text[at:]])


def _apply(docs: DataFrame, params: SuffixParams, answer, columns: dict[str, str]) -> DataFrame:
    """``doc_id`` and ``answer(text, runs)``, the ``columns`` by name and Arrow type, per row of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *text_keys(text))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pairs = zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True)
            rows = [answer(data, merge_spans([(x["s"], x["e"]) for x in spans or ()])) for data, spans in pairs]
            cols = list(zip(*rows, strict=True)) or [()] * len(columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, columns.values(), strict=True))], ["doc_id", *columns])

    schema = ", ".join(["doc_id long", *(f"{c} {'long' if t == 'int64' else t}" for c, t in columns.items())])
    with Scratch(docs.sparkSession, "suffix") as scratch:
        texts = keyed.where(F.octet_length("text") >= params.least).select("ka", "kb", F.coalesce("doc_id", F.lit(-1)).alias("id"), "text")
        cover = coverage(texts, scratch, params)
        return cut(keyed.join(cover, ["ka", "kb"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema))


def removals(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs(doc_id, text, ...)``.

    Null text counts as empty, and texts under ``least`` bytes lose nothing. Every row counts as a place of its own, so
    a repeated row loses all of its text if that has ``least`` bytes. Matches stay within a row's text. Texts are read
    whole, however long; there is nothing to tie. Other columns, whatever their names, are not read. An empty table
    gives no rows.
    """
    answer = lambda text, runs: (len(text), sum(e - s for s, e in runs), len(runs), hashlib.sha256(cut_out(text, runs)).hexdigest())
    return _apply(docs, params, answer, {"n_bytes": "int64", "n_removed": "int64", "n_spans": "int64", "kept_sha256": "string"})


def remove_repeats(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """``doc_id, text`` without the repeated strings; a character cut in two at a run's edge becomes U+FFFD."""
    return _apply(docs, params, lambda text, runs: (cut_out(text, runs).decode("utf-8", "replace"),), {"text": "string"})
