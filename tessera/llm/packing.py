"""Best-fit packing: repeat counts of length patterns fitted by non-negative least squares, the residual by best fit."""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut, sized


@dataclass(frozen=True)
class PackParams:
    """``width`` tokens a sequence. The plan is made from the histogram of piece lengths: ``width`` numbers, whatever the
    size of the corpus. ``most_patterns`` bounds the enumerated patterns of three."""

    tokenizer: str | None = None
    end_id: int = 2
    width: int = 1024
    most_patterns: int = 60_000
    steps: int = 400


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters are their own
    byte, the other bytes follow in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


#: The pre-tokeniser of byte-level BPE, a fixed value of the format.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, as ``tokenizers`` gives them for a vocabulary file.

    A byte-level vocabulary whose ids follow the order of its merges is also run by ``tiktoken``, which gives the same
    ids five times as fast. That is done for texts of characters below U+0500, on whose classes all versions of Unicode
    agree, that spell no special token; the first ``proof`` texts go through both, and a difference raises.
    """

    def __init__(self, path: str, proof: int = 8):
        import json
        import re

        from tokenizers import Tokenizer

        self.tokenizer, self.proof = Tokenizer.from_file(path), proof
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.slow = re.compile("|".join(["[^\x00-\u04ff]", *special]))
        with open(path, encoding="utf-8") as f:
            self.fast = self._ranked(json.load(f))

    @staticmethod
    def _ranked(spec: dict):
        import tiktoken

        model, pre, chars = spec["model"], spec.get("pre_tokenizer") or {}, _byte_of_char()
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("end_of_word_suffix")
        if not plain:
            return None
        vocab = model["vocab"]
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(vocab.get(m) != 256 + k for k, m in enumerate(merges)) or any(vocab.get(c, 256) > 255 for c in chars):
            return None
        ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
        return tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def exact(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.fast is None or self.slow.search(text):
            return self.exact(text)
        ids = array("I", self.fast.encode_ordinary(text)).tobytes()
        if self.proof:
            self.proof -= 1
            if ids != self.exact(text):
                raise ValueError("tiktoken and tokenizers differ on this vocabulary")
        return ids


def pieces_of(ids: bytes, width: int) -> list[tuple[int, int, int]]:
    """``start, length, crc32`` of the pieces of an id sequence; only the first may be shorter than ``width``."""
    n = len(ids) // 4
    first = n % width or width
    cuts = [0, *range(first, n + 1, width)] if n > width else [0, n]
    return [(a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:], strict=False)]


def tokenizer_path(params: PackParams) -> str:
    if params.tokenizer:
        return params.tokenizer
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_pieces(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and the piece's place among the same length in its task (``part, nth``)."""
    path, width, end = tokenizer_path(params), params.width, np.array([params.end_id], "<u4").tobytes()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode, seen, part = Encoder(path), np.zeros(width + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows, take = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for k, (start, length, crc) in enumerate(pieces_of((encode(text) if text else b"") + end, width)):
                    rows.append((k, start, length, crc, seen[length]))
                    take.append(i)
                    seen[length] += 1
            cols = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take, pa.int32())), pa.array(cols[:, 0].astype(np.int32)), *(pa.array(cols[:, j]) for j in (1, 2, 3)), pa.array(np.full(len(rows), part, np.int32)), pa.array(cols[:, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def enumerate_patterns(hist: np.ndarray, most: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill a sequence exactly and occur in ``hist``: pairs first, then triples."""
    width = len(hist) - 1
    have = np.flatnonzero(hist[:width])
    pairs = [(width - x, x, 0) for x in have if 2 * x <= width and hist[width - x]]
    i, j = np.triu_indices(len(have))
    a, b = have[i], have[j]
    c = width - a - b
    ok = (c >= b) & (c < width)
    ok[ok] = hist[c[ok]] > 0
    triples = np.stack([c[ok], b[ok], a[ok]], 1)
    if len(triples) > most:  # the best supplied ones, whole
        supply = hist[triples].min(1)
        triples = triples[np.argsort(-supply, kind="stable")[:most]]
    return np.concatenate([np.array(pairs, np.int64).reshape(-1, 3), triples])


def fit_repeats(patterns: np.ndarray, hist: np.ndarray, steps: int) -> np.ndarray:
    """Non-negative least squares of pattern counts against the histogram, by accelerated projected gradients."""
    width = len(hist) - 1
    want = hist.astype(float)
    want[[0, width]] = 0
    flat, n = patterns.ravel(), patterns.shape[1]

    def forward(x):
        y = np.bincount(flat, np.repeat(x, n), width + 1)
        y[0] = 0
        return y

    def backward(r):
        return r[patterns].sum(1)

    v = np.ones(len(patterns))
    for _ in range(12):  # the largest eigenvalue
        v = backward(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = z = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, z - backward(np.where(np.arange(width + 1) == 0, 0, forward(z) - want)) / norm)
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, x, t = new + (t - 1) / t1 * (new - x), new, t1
    return x


def plan(hist: np.ndarray, params: PackParams = PackParams()) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, repeats)`` that use up the histogram of piece lengths (index: length)."""
    width, left, out = params.width, hist.astype(np.int64).copy(), []

    def use(lengths: tuple[int, ...], repeats: int) -> None:
        out.append((lengths, int(repeats)))
        for x in lengths:
            left[x] -= repeats

    if left[width]:
        use((width,), left[width])
    patterns = enumerate_patterns(left, params.most_patterns)
    if len(patterns):
        x = fit_repeats(patterns, left, params.steps)
        rounded = np.floor(x + 1e-6).astype(np.int64)
        for k in np.argsort(-x, kind="stable"):
            if not rounded[k]:
                continue
            lengths = tuple(int(v) for v in patterns[k] if v)
            repeats = min(int(rounded[k]), *(int(left[v]) // lengths.count(v) for v in lengths))
            if repeats > 0:
                use(lengths, repeats)
    while True:  # best fit for what is left, a class at a time
        some = np.flatnonzero(left)
        if not len(some):
            return out
        lengths, room, free = [int(some[-1])], width - int(some[-1]), left.copy()
        free[lengths[0]] -= 1
        while room:
            fits = np.flatnonzero(free[: room + 1])
            if not len(fits):
                break
            pick = int(fits[-1])
            if pick != room:  # two that fill the room exactly beat the longest that fits
                rest = room - fits
                both = fits[(rest >= fits) & (free[rest] > (rest == fits))]
                if len(both):
                    pick = room - int(both[-1])
            lengths.append(pick)
            free[pick] -= 1
            room -= pick
        use(tuple(lengths), min(int(left[v]) // lengths.count(v) for v in lengths))


def slots(patterns: list[tuple[tuple[int, ...], int]], width: int) -> dict[int, np.ndarray]:
    """By length: rows ``first rank, sequence of it, offset``; ranks count up within the length."""
    taken, base = np.zeros(width + 1, np.int64), 0
    out: dict[int, list] = {}
    for lengths, repeats in patterns:
        offset = 0
        for x in lengths:
            out.setdefault(x, []).append((taken[x], base, offset))
            taken[x] += repeats
            offset += x
        base += repeats
    return {x: np.array(v, np.int64) for x, v in out.items()}


def pack(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of ``docs(doc_id, text, ...)``.

    Every document ends in ``end_id``, so null and empty texts are one piece of one token. Repeated rows are packed each.
    An empty table gives an empty result. Pieces of equal length are interchangeable: a piece's rank within its length is
    its place in its task plus the counts of the tasks before, and the plan turns (length, rank) into a place.
    """
    with Scratch(docs.sparkSession, "packing") as scratch:
        pieces = scratch.save(cut_pieces(docs, params), "pieces")
        counts = scratch.save(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "counts")
        hist = np.zeros(params.width + 1, np.int64)
        for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``width`` rows
            hist[r["length"]] = r["n"]
        table = docs.sparkSession.sparkContext.broadcast(slots(plan(hist, params), params.width))
        from pyspark.sql import Window

        before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        offsets = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
        ranked = pieces.join(sized(offsets), ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))

        def place(batches):
            import pyarrow as pa

            for batch in batches:
                length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
                sequence, offset = np.empty_like(rank), np.empty_like(rank)
                for x in np.unique(length):
                    rows, at = table.value[int(x)], np.flatnonzero(length == x)
                    k = np.searchsorted(rows[:, 0], rank[at], "right") - 1
                    sequence[at], offset[at] = rows[k, 1] + rank[at] - rows[k, 0], rows[k, 2]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

        return cut(ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
