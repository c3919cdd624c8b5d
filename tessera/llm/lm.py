"""Language-model scoring: a bigram model in Elias-Fano tries, one for each shard of contexts, built where it is queried.

P(w | c) = (n(c, w) + m(c) * P(w)) / (n(c) + m(c)), with P(w) = (n(w) + 1) / (N + V + 1) and m(c) = kappa * n(c) ** beta,
which stands for the number of distinct successors. The context of a text's first word is the end of a text.

The corpus is cut once into chunks of packed tokens. Words are counted by ranges of their hashes and each chunk gets the
counts of its own words back. Then each chunk deals its distinct bigrams to shards by context, with the documents they
occur in; a shard adds up the counts, writes its trie, maps it, looks the chunks' bigrams up in it and returns sums by
document. The trie's first level has every word of the shard with its probability and its back-off weight, the second the
bigrams of training; a bigram that is not there is the weight of its context times the probability of its word. A context
with more tokens than a shard's share is dealt on by successor, which the formula allows. No task holds more than a shard
or a chunk, and no model is broadcast or collected: it grows with the corpus, spread over tasks.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHasher, as_bytes, ascii_words, crc_mod, cut, mix
from .eliasfano import NgramTrie


@dataclass(frozen=True)
class LmParams:
    folds: int = 7
    held_fold: int = 2
    kappa: float = 3.0
    beta: float = 0.85
    chunk_tokens: int = 1 << 19
    shard_words: int = 1 << 19  #: entries of chunk vocabularies a task counts
    shard_tokens: int = 1 << 21  #: tokens a shard of bigrams stands for


#: No word has a blank.
_END = b"the end"
#: An id is a range of hashes and a place in it; the two fill this many bits at most, beside a context's place in its shard.
_RANK_BITS, _WORD_BITS = 24, 42


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed string, byte planes apart, so that unused high bytes cost nothing."""
    import zstandard

    head = np.array([len(arrays)], np.int64).tobytes()
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += a.dtype.str.ljust(8).encode() + np.array([len(a)], np.int64).tobytes()
        body.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 + 16 * count, []
    for k in range(count):
        kind = np.dtype(raw[8 + 16 * k : 16 + 16 * k].decode().strip())
        n = int(np.frombuffer(raw, np.int64, 1, 16 + 16 * k)[0])
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def _deltas(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _stretches(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of equal values of a non-empty array."""
    begin = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    return begin, np.append(begin[1:], len(a))


def chunks(docs: DataFrame, params: LmParams) -> DataFrame:
    """``kind, chunk, n, payload``: of each chunk the vocabulary with its training counts (kind 0, n words), and the
    documents (kind 1, n tokens)."""
    fold = crc_mod(F.col("doc_id"), params.folds)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(fold == params.held_fold, F.lit(False)).alias("held"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        hasher, part, seq = WordHasher(), TaskContext.get().partitionId(), 0
        ids, held, sizes, held_hashes, total = [], [], [], [], 0

        def close():
            hashes = np.concatenate(held_hashes)
            vocabulary, tokens = np.unique(hashes, return_inverse=True)
            known = np.array([i is not None for i in ids])
            learnt = known & ~np.array(held)
            counts = np.bincount(tokens[np.repeat(learnt, sizes)], minlength=len(vocabulary))
            kind = np.uint16 if len(vocabulary) <= 1 << 16 else np.uint32
            body = pack(np.array([i or 0 for i in ids], np.int64), known, np.array(held), np.array(sizes, np.uint32), tokens.astype(kind))
            words = pack(_deltas(vocabulary), counts.astype(np.uint32))
            cols = [pa.array([0, 1], pa.int32()), pa.array([(part << 32) | seq] * 2, pa.int64()), pa.array([len(vocabulary), len(tokens)], pa.int64()), pa.array([words, body], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["kind", "chunk", "n", "payload"])

        for batch in batches:
            for doc_id, text, out in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                h = hasher.hashes([*ascii_words(text or b""), _END])
                ids.append(doc_id), held.append(out), sizes.append(len(h)), held_hashes.append(h)
                total += len(h)
                if total >= params.chunk_tokens:
                    yield close()
                    ids, held, sizes, held_hashes, total, seq = [], [], [], [], 0, seq + 1
        if ids:
            yield close()

    return rows.mapInArrow(run, "kind int, chunk long, n long, payload binary")


def _grouped(batches, key: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of Arrow batches that are sorted by column ``key``, a group at a time."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[key] != now and rows:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


def count_words(table: DataFrame, parts: int) -> DataFrame:
    """``chunk, part, payload, n, v``: ids and training counts of the words of each chunk in each range of hashes.

    The row of chunk -1 has the range's tokens and distinct words in training. Ids ascend with the hashes.
    """

    def split(batches):
        import pyarrow as pa

        for batch in batches:
            for chunk, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                deltas, counts = unpack(words)
                hashes = np.cumsum(deltas, dtype=np.uint64)
                # equal ranges of the upper half of the hash; only those the chunk has words in are looked at
                part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                at, end = _stretches(part)
                payload = [pack(_deltas(hashes[a:b]), counts[a:b]) for a, b in zip(at, end, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(part[at].astype(np.int32)), pa.array(np.full(len(at), chunk, np.int64)), pa.array(payload, pa.binary())], ["part", "chunk", "payload"])

    def add(batches):
        import pyarrow as pa

        for part, rows in _grouped(batches, 0):
            pairs = [unpack(r[2]) for r in rows]
            hashes = [np.cumsum(d, dtype=np.uint64) for d, _ in pairs]
            words, place = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(place, np.concatenate([c for _, c in pairs]).astype(float)).astype(np.uint64)
            ids = (np.uint64(part) << np.uint64(_RANK_BITS)) + np.arange(len(words), dtype=np.uint64)
            out, at = [], 0
            for r, h in zip(rows, hashes, strict=True):
                mine = place[at : at + len(h)]
                at += len(h)
                out.append((r[1], part, pack(_deltas(ids[mine]), total[mine]), 0, 0))
            out.append((-1, part, None, int(total.sum()), int((total > 0).sum())))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()), strict=True)], ["chunk", "part", "payload", "n", "v"])

    dealt = table.where("kind = 0").select("chunk", "payload").mapInArrow(split, "part int, chunk long, payload binary")
    return dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, "chunk long, part int, payload binary, n long, v long")


def mass(n: np.ndarray, params: LmParams) -> np.ndarray:
    """The weight m(c) of the unigram distribution after a context seen ``n`` times; 1 for one never seen."""
    return np.where(n > 0, params.kappa * np.maximum(n, 1).astype(float) ** params.beta, 1.0)


def _deal(words: list[tuple[int, bytes]], body: bytes, total: int, distinct: int, shards: int, params: LmParams) -> tuple[bytes, list[tuple[int, bytes]]]:
    """A chunk's documents with what it can score itself, and its bigrams of known words by shard."""
    doc_ids, known, held, sizes, tokens = unpack(body)
    parts = [unpack(p) for _, p in sorted(words)]
    ids = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in parts])
    counts = np.concatenate([c for _, c in parts]).astype(np.int64)
    sizes, tokens = sizes.astype(np.int64), tokens.astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[starts] = tokens[-1]  # every document ends in the end
    unigram = (counts + 1) / (total + distinct + 1)
    log_uni = np.log10(unigram)[tokens]
    base = np.add.reduceat(log_uni, starts)
    n_known = np.add.reduceat((counts[tokens] > 0).astype(np.int64), starts)
    sent = (counts[tokens] > 0) & (counts[context] > 0)
    n = counts[context]
    m = mass(n, params)
    alone = np.add.reduceat(np.where(sent, 0.0, log_uni + np.log10(m / (n + m))), starts)
    head = pack(doc_ids, known, held, sizes, n_known, base, alone)

    wb, db = np.uint64(max(1, int(len(ids) - 1).bit_length())), np.uint64(max(1, int(len(sizes) - 1).bit_length()))
    if int(wb) * 2 + int(db) > 64:
        raise ValueError("a chunk this large cannot be packed; lower chunk_tokens")
    key = (context[sent].astype(np.uint64) << (wb + db)) | (tokens[sent].astype(np.uint64) << db) | doc[sent].astype(np.uint64)
    key.sort()
    if not len(key):
        return head, []
    new = np.r_[True, key[1:] != key[:-1]]
    at = np.flatnonzero(new)
    pairs, times = key[at], np.diff(np.r_[at, len(key)])
    pair_doc = (pairs & ((np.uint64(1) << db) - np.uint64(1))).astype(np.int64)
    both = pairs >> db
    entry = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    first, second = (both[entry] >> wb).astype(np.int64), (both[entry] & ((np.uint64(1) << wb) - np.uint64(1))).astype(np.int64)
    learnt = known & ~held
    seen = np.add.reduceat(times * learnt[pair_doc], entry)
    widths = np.diff(np.r_[entry, len(pairs)])
    # a context of more tokens than a shard stands for is dealt on by its successors
    ways = (counts[first] // params.shard_tokens + 1).astype(np.uint64)
    shard = (mix(ids[first] * np.uint64(0x9E3779B97F4A7C15) + ids[second] % ways) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    out = []
    for a, b in zip(*_stretches(shard[order]), strict=True):
        e = order[a:b]
        s = shard[e[0]]
        c, w = first[e], second[e]
        lead = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        size = widths[e]
        stop = np.cumsum(size)
        take = np.arange(stop[-1]) + np.repeat(entry[e] - (stop - size), size)
        kind = np.uint16 if len(sizes) <= 1 << 16 else np.uint32
        out.append((int(s), pack(_deltas(ids[c[lead]]), np.diff(np.r_[lead, len(e)]).astype(np.uint32), counts[c[lead]], ids[w], counts[w], seen[e].astype(np.uint32), size.astype(np.uint32), pair_doc[take].astype(kind), times[take].astype(np.uint32))))
    return head, out


def build_shard(parts: Iterator[tuple[np.ndarray, ...]], size: int, params: LmParams) -> NgramTrie:
    """The trie of a shard from ``first, second, seen, n1, n2`` arrays, n1 and n2 being the counts of the two words in
    training; rows are added up. ``size``: the denominator of word probabilities."""
    held, vocabulary = [], []
    for first, second, seen, n1, n2 in parts:
        words, at = np.unique(np.concatenate([first, second]), return_index=True)
        vocabulary.append((words, np.concatenate([n1, n2])[at]))
        some = seen > 0
        held.append((first[some], second[some], seen[some], n1[some], n2[some]))
    first, second, seen, n1, n2 = (np.concatenate(x) for x in zip(*held, strict=True))
    words, counts = (np.concatenate(x) for x in zip(*vocabulary, strict=True))
    words, at = np.unique(words, return_index=True)
    counts = counts[at].astype(float)
    del held, vocabulary, at
    place = np.searchsorted(words, first)
    key = (place.astype(np.uint64) << np.uint64(_WORD_BITS)) | second
    del first, place
    order = np.argsort(key)
    key = key[order]
    lead = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    both = np.add.reduceat(seen[order].astype(np.int64), lead) if len(lead) else np.zeros(0, np.int64)
    some = order[lead]
    m = mass(n1[some], params)
    logp = np.log10((both + m * (n2[some] + 1) / size) / (n1[some] + m))
    pairs = np.stack([words[(key[lead] >> np.uint64(_WORD_BITS)).astype(np.int64)], second[some]], 1)
    del key, order, some
    m = mass(counts, params)
    return NgramTrie.build([words[:, None], pairs], [np.log10((counts + 1) / size), logp], [np.log10(m / (counts + m))])


def _shard(rows: list[bytes], total: int, distinct: int, params: LmParams) -> Iterator[bytes]:
    """For each chunk's bigrams of this shard: documents and the sums of their log10 probabilities."""

    def entries(row):
        lead, size, n1, second, n2, seen, width, docs, times = unpack(row)
        return np.repeat(np.cumsum(lead, dtype=np.uint64), size), second, seen, np.repeat(n1, size), n2, width, docs, times

    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "trie")
        build_shard((entries(r)[:5] for r in rows), total + distinct + 1, params).save(path)
        trie = NgramTrie.load(path)
        for row in rows:  # unpacked again rather than held: a shard is one chunk large at a time
            first, second, _, _, _, width, docs, times = entries(row)
            at = trie.find(np.stack([first, second], 1))
            logp = trie.logp(1, np.maximum(at, 0)) if trie.words[1].n else np.zeros(len(at))
            new = np.flatnonzero(at < 0)
            logp[new] = trie.back(0, trie.find(first[new, None])) + trie.logp(0, trie.find(second[new, None]))
            sums = np.bincount(docs, np.repeat(logp, width) * times)
            some = np.flatnonzero(np.bincount(docs))
            yield pack(some.astype(np.uint32), sums[some])
        del trie


def score(docs: DataFrame, params: LmParams = LmParams()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text, ...)``.

    Null text counts as empty: one token, the end. A null doc_id is neither held out nor learnt from. Repeated rows are
    learnt and scored each. Without a training row every word is unknown and every probability is that of the unknown
    word, 1. An empty table gives no rows. Texts are read whole, however long. Other columns, whatever their names, are
    not read. There is nothing to tie.
    """
    with Scratch(docs.sparkSession, "lm") as scratch:
        table = scratch.save(chunks(docs, params), "chunks", by="kind")
        size = {r["kind"]: r["n"] for r in table.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
        parts = max(8, -(-size.get(0, 0) // params.shard_words))
        shards = max(8, -(-size.get(1, 0) // params.shard_tokens))
        counts = scratch.save(count_words(table, parts), "counts")
        bodies = table.where("kind = 1").select("chunk", F.col("payload").alias("body"))
        scratch.drop("chunks/kind=0")
        found = counts.where("chunk < 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
        total, distinct = found["n"] or 0, found["v"] or 0

        def deal(batches):
            import pyarrow as pa

            for batch in batches:
                for chunk, body, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    head, sent = _deal([(w["part"], w["payload"]) for w in words], body, total, distinct, shards, params)
                    rows = [(-1 - chunk % shards, chunk, head), *((s, chunk, p) for s, p in sent)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["shard", "chunk", "payload"])

        def answer(batches):
            import pyarrow as pa

            for shard, rows in _grouped(batches, 0):
                payloads = [r[2] for r in rows]
                if shard >= 0:
                    payloads = list(_shard(payloads, total, distinct, params))
                yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.int64()), pa.array([shard < 0] * len(rows)), pa.array(payloads, pa.binary())], ["chunk", "head", "payload"])

        def close(batches):
            import pyarrow as pa

            for _, rows in _grouped(batches, 0):
                doc_ids, known, held, sizes, n_known, base, sums = next(unpack(r[2]) for r in rows if r[1])
                sums = sums.copy()
                for r in rows:
                    if not r[1]:
                        at, more = unpack(r[2])
                        sums[at] += more
                cols = [pa.array(doc_ids, mask=~known), pa.array(held & known), pa.array(sizes), pa.array(n_known), pa.array(np.full(len(sizes), total)), pa.array(base), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        # a chunk's words lie in as many ranges as it has words at most
        words = counts.where("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("part", "payload")).alias("words"))
        dealt = bodies.join(words, "chunk").select("chunk", "body", "words").mapInArrow(deal, "shard long, chunk long, payload binary")
        answered = dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(answer, "chunk long, head boolean, payload binary")
        final = answered.repartition(max(8, shards // 4), "chunk").sortWithinPartitions("chunk").mapInArrow(close, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        return cut(final)
