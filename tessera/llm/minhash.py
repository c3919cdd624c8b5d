"""Near-duplicate detection: banded MinHash, sequential Bayesian pruning of candidates, exact verification.

Documents that share a band are candidates. Within a bucket, batches of signatures are compared and pairs go as soon as
the posterior probability that they reach the threshold is under ``miss``; what stays links documents to clusters. Every
plausible pair lies within one cluster, so the full sets of a cluster's documents meet once, whatever number of bands
they share; the pairs that no batch prunes are verified there, and only links that join two parts of a component leave a
task. Neither step writes out the pairs of a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHasher, as_bytes, ascii_words, cut, mix, shingle_set, sized
from .components import connected_components


@dataclass(frozen=True)
class MinHashParams:
    """``bands`` x ``rows`` hashes: a pair at the threshold shares no band with probability (1 - t**rows) ** bands,
    3e-6 at the defaults. ``batch`` hashes are compared at a time; after each batch a pair goes if the posterior
    probability that it reaches the threshold is under ``miss``. What is left is verified on full sets. A larger bucket or
    cluster is dealt to tasks in pairs of blocks."""

    shingle: int = 2
    percent: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-6
    block: int = 4096  #: documents of a bucket that are compared in one task
    sets_block: int = 1024  #: documents of a cluster whose sets are
    sets_shingles: int = 1 << 20  #: shingles of those documents, 8 MB as hashes; a larger document is a block of its own
    seed: int = 20240229


@cache
def _coefficients(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, (k, 1), np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, (k, 1), np.uint64)


def signature(shingles: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` 32-bit minima of a non-empty set of 64-bit shingle hashes, in blocks that stay in the CPU's cache."""
    a, b = _coefficients(k, seed)
    low = np.full(k, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 512):
        x = a * shingles[None, i : i + 512]
        x += b
        np.minimum(low, x.min(1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


@cache
def least_matches(params: MinHashParams) -> list[int]:
    """For n = batch, 2 * batch, ...: the fewest agreements among n hashes that keep a pair.

    One byte of each hash is compared, so unequal hashes agree with probability 1/256 and a pair of similarity t agrees
    with p = t + (1 - t) / 256. Under a uniform prior the posterior of "at least p" given m of n is P(Bin(n+1, p) <= m).
    """
    t = params.percent / 100
    p = t + (1 - t) / 256
    out = []
    for n in range(params.batch, params.bands * params.rows + 1, params.batch):
        tail, m = 0.0, -1
        while tail < params.miss:
            m += 1
            tail += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(p) + (n + 1 - m) * math.log1p(-p))
        out.append(m)
    return out


def plausible(x: np.ndarray, y: np.ndarray, params: MinHashParams) -> np.ndarray:
    """Indexes of the row pairs of ``x`` and ``y`` that no batch prunes."""
    live, seen = np.arange(len(x)), np.zeros(len(x), np.int64)
    for i, least in enumerate(least_matches(params)):
        s = slice(i * params.batch, (i + 1) * params.batch)
        seen = seen + (x[live, s] == y[live, s]).sum(1)
        ok = seen >= least
        live, seen = live[ok], seen[ok]
        if not len(live):
            break
    return live


def features(docs: DataFrame, params: MinHashParams) -> DataFrame:
    """Per row: set size, 128-bit fingerprint of the set, one byte of each minimum, band keys."""
    k, rows, seed, width = params.bands * params.rows, params.rows, params.seed, params.shingle

    def run(batches):
        import pyarrow as pa
        import xxhash

        hasher = WordHasher()
        with np.errstate(over="ignore"):
            salt = mix(np.arange(1, params.bands + 1, dtype=np.uint64))
            for batch in batches:
                sizes, hi, lo, sigs, keys = [], [], [], [], []
                for text in as_bytes(batch.column(1)):
                    s = shingle_set(hasher.hashes(ascii_words(text or b"")), width)
                    sizes.append(len(s))
                    if not len(s):
                        hi.append(0), lo.append(0), sigs.append(None), keys.append(None)
                        continue
                    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    hi.append(d[0]), lo.append(d[1])
                    sig = signature(s, k, seed)
                    sigs.append((sig & np.uint32(255)).astype(np.uint8).tobytes())
                    acc = salt.copy()
                    for j in range(rows):
                        acc ^= sig[j::rows]
                        acc = mix(acc)
                    keys.append(acc.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64())), batch.column(2)],
                    ["doc_id", "n_shingles", "hi", "lo", "sig", "bands", "text_key"],
                )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("text_key")).mapInArrow(run, "doc_id long, n_shingles long, hi long, lo long, sig binary, bands array<long>, text_key long")


def spanning_links(n: int, scan) -> list[tuple[int, int]]:
    """A spanning forest of a graph of ``n`` nodes; ``scan(i, others)`` says which of ``others`` node i is linked with.

    Nodes of the largest part found so far are not scanned: two parts that are linked have a node outside it.
    """
    part = np.arange(n)
    size = np.ones(n, np.int64)
    fresh = np.ones(n, bool)
    links = []
    i = 0
    while True:
        fresh[i] = False
        others = np.flatnonzero(part != part[i])
        if len(others):
            for j in others[scan(i, others)]:
                p, q = part[i], part[j]
                if p != q:
                    links.append((i, int(j)))
                    part[part == q] = p
                    size[p] += size[q]
        left = np.flatnonzero(fresh & (part != part[int(np.argmax(size[part]))]))
        if not len(left):
            return links
        i = int(left[0])


def set_scanner(sets: list[np.ndarray], percent: int, few: int = 32):
    """A ``scan`` by exact similarity of sorted sets: one by one, or for more than ``few`` over an inverted index of all."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    index: list[tuple] = []

    def shared(i: int, j: int) -> int:
        a, b = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return int((b[at] == a).sum())

    def build():
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, item = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(item, kind="stable")
        return item, owner[order], np.searchsorted(item[order], np.arange(item.max() + 2)), np.cumsum(sizes) - sizes

    def scan(i, others):
        if len(others) <= few:
            both = np.fromiter((shared(i, j) for j in others), np.int64, len(others))
        else:
            if not index:
                index.append(build())
            item, holders, first, starts = index[0]
            mine = item[starts[i] : starts[i] + sizes[i]]
            a, b = first[mine], first[mine + 1]
            ends = np.cumsum(b - a)
            place = np.arange(ends[-1]) + np.repeat(a - (ends - (b - a)), b - a)
            both = np.bincount(holders[place], minlength=len(sets))[others]
        return 100 * both >= percent * (sizes[i] + sizes[others] - both)

    return scan


def _dealt(groups: DataFrame) -> DataFrame:
    """``groups(key, id, blocks, ...)`` with ``lo, hi``: every two members of a group meet in some (key, lo, hi)."""
    blocks = F.col("blocks")
    side = F.pmod(F.xxhash64("id"), blocks.cast("long")).cast("int")
    peer = F.explode(F.sequence(F.lit(0), blocks - 1))
    return groups.withColumn("side", side).withColumn("peer", peer).withColumn("lo", F.least("side", "peer")).withColumn("hi", F.greatest("side", "peer")).drop("side", "peer", "blocks")


def _units(batches, payload: int):
    """Ids and payloads of the rows ``key, lo, hi, id, payload`` of each unit, sorted by unit."""
    now, ids, held = None, [], []
    for batch in batches:
        for *unit, i, x in zip(*(c.to_pylist() for c in batch.columns[:4]), as_bytes(batch.column(payload)), strict=True):
            if unit != now and ids:
                yield ids, held
                ids, held = [], []
            now = unit
            ids.append(i)
            held.append(x)
    if ids:
        yield ids, held


def _linked(units: DataFrame, payload: str, scanner_of, rows: int = 10_000) -> DataFrame:
    """Links ``a, b`` of a spanning forest of each unit of ``units(key, lo, hi, id, payload)``."""

    def run(batches):
        import pyarrow as pa

        scanner = scanner_of()
        found: list[tuple[int, int]] = []
        with np.errstate(over="ignore"):
            for ids, held in _units(batches, 4):
                if len(ids) > 1:
                    found += [(ids[i], ids[j]) for i, j in spanning_links(len(ids), scanner(held))]
                if len(found) >= rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    spread = units.select("key", "lo", "hi", "id", payload).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")
    return spread.mapInArrow(run, "a long, b long")


def plausible_links(sigs: DataFrame, params: MinHashParams) -> DataFrame:
    """Links between documents that share a band and that no batch of hashes prunes."""

    def scanner(held):
        sig = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1)

        def scan(i, others):
            out = np.zeros(len(others), bool)
            out[plausible(np.broadcast_to(sig[i], (len(others), sig.shape[1])), sig[others], params)] = True
            return out

        return scan

    rows = sigs.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / params.block).cast("int").alias("blocks"))
    units = _dealt(rows.join(shared, "key"))
    return _linked(units.join(sigs.select(F.col("doc_id").alias("id"), "sig"), "id"), "sig", lambda: scanner).distinct()


def exact_links(docs: DataFrame, sigs: DataFrame, clusters: DataFrame, params: MinHashParams) -> DataFrame:
    """Links between documents of a cluster that no batch of hashes prunes and whose full sets reach the threshold."""
    width, percent, k = params.shingle, params.percent, params.bands * params.rows

    def scanner_of():
        hasher = WordHasher()

        def scanner(texts):
            sets = [shingle_set(hasher.hashes(ascii_words(t)), width) for t in texts]
            exact = set_scanner(sets, percent)
            if len(sets) == 2:  # what links two documents to a cluster is their own pair
                return exact
            sig = np.stack([(signature(s, k, params.seed) & np.uint32(255)).astype(np.uint8) for s in sets])

            def scan(i, others):
                out = np.zeros(len(others), bool)
                live = plausible(np.broadcast_to(sig[i], (len(others), k)), sig[others], params)
                if len(live):
                    out[live] = exact(i, others[live])
                return out

            return scan

        return scanner

    members = clusters.join(sigs.select(F.col("doc_id").alias("id"), "n_shingles", "text_key"), "id").withColumnRenamed("component", "key")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / params.sets_block), F.ceil(F.sum("n_shingles") / params.sets_shingles))
    sizes = members.groupBy("key").agg(blocks.cast("int").alias("blocks"))
    units = _dealt(members.join(sizes, "key").select("key", "id", "text_key", "blocks"))
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key")).where("text is not null")
    return _linked(texts.join(sized(units), ["id", "text_key"]), "text", scanner_of).distinct()


def near_duplicates(docs: DataFrame, params: MinHashParams = MinHashParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    Documents with equal sets are one node of the graph; a set's least doc_id stands for it.

    Null or empty text, or text without words: size 0, linked with nothing. A null doc_id: component_id null, kept.
    Repeated rows of one doc_id count as one document and are all returned; if their texts differ, the document's links
    are those of the row of the smallest set, by size and then fingerprint, and of rows with equal sets. Of a group the
    least doc_id is kept, so there are no ties. Texts are read whole, however long. Other columns, whatever their names,
    are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with Scratch(spark, "minhash") as scratch:
        feats = scratch.save(features(docs, params), "features")
        real = feats.where("n_shingles > 0 and doc_id is not null")
        reps = real.groupBy("n_shingles", "hi", "lo").agg(F.min("doc_id").alias("rep"))
        nodes = scratch.save(feats.select("doc_id", "n_shingles", "hi", "lo").join(reps, ["n_shingles", "hi", "lo"], "left").select("doc_id", "n_shingles", "rep"), "nodes")
        firsts = nodes.where("doc_id = rep").select("doc_id").distinct()
        least = F.min(F.struct("n_shingles", "hi", "lo", "text_key", "sig", "bands")).alias("x")
        sigs = scratch.save(real.join(firsts, "doc_id", "left_semi").groupBy("doc_id").agg(least).select("doc_id", "x.n_shingles", "x.text_key", "x.sig", "x.bands"), "signatures")
        scratch.drop("features")
        clusters = connected_components(scratch.save(plausible_links(sigs, params), "plausible"))
        comps = connected_components(scratch.save(exact_links(docs, sigs, clusters, params), "links"))
        out = nodes.join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
        return cut(out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
