import random

import numpy as np
from helpers import make

from tessera.llm.components import connected_components
from tessera.llm.minhash import MinHashParams, least_matches, near_duplicates, set_scanner, spanning_links


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def five_words(text):
    """What stages of the pipeline take; ``shingles`` is op1's."""
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, of=None):
    """Component of each id by all pairs of the sets that ``of`` (``shingles``) makes of texts."""
    sets = {i: (of or shingles)(t) for i, t, *_ in rows if i is not None}
    part = {i: i for i in sets}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((find(a), find(b)))
                part[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None}


def test_messy(spark, messy, docs):
    out = near_duplicates(docs)
    assert out.count() == len(messy)
    assert got(out) == brute(messy)
    assert {(r.component_id, r.kept) for r in out.where("doc_id is null").collect()} == {(None, True)}


def test_chain_of_edits_and_blocks(spark):
    """A long chain, in which only neighbours are alike, stays one component however it is dealt to blocks."""
    rng = random.Random(1)
    w = [f"a{i}" for i in range(60)]
    rows = []
    for i in range(120):
        rows.append((i * 3 % 361, " ".join(w), "en", "s"))
        w[rng.randrange(60)] = f"n{i}"
    df = make(spark, rows).repartition(5)
    for params in (MinHashParams(), MinHashParams(block=16, sets_block=8, sets_shingles=300)):
        assert got(near_duplicates(df, params)) == brute(rows)


def test_empty(nothing):
    out = near_duplicates(nothing)
    assert out.count() == 0 and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_threshold_is_met_exactly(spark):
    """Ten shared of twelve, and eight shared of ten: 100 * 8 = 80 * 10 is a link; 7 of 9 is none."""
    rows = [(1, "a b c d e f g h i x", "en", ""), (2, "a b c d e f g h i y", "en", ""), (3, "p q r s t u v w x1", "en", ""), (4, "p q r s t u v w y1", "en", "")]
    assert got(near_duplicates(make(spark, rows))) == brute(rows)


def test_pruning_table():
    p = MinHashParams()
    least = least_matches(p)
    rng = np.random.default_rng(0)
    same = rng.random((20_000, p.bands * p.rows)) < 0.8
    for n, m in zip(range(p.batch, 161, p.batch), least, strict=True):
        assert (same[:, :n].sum(1) < m).mean() < 1e-3
    assert least == sorted(least)


def test_spanning_links_against_all_pairs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 14))
        sets = [np.unique(rng.integers(0, 8, rng.integers(1, 8))).astype(np.uint64) for _ in range(n)]
        scan = set_scanner(sets, 60, int(rng.choice([0, 3, 32])))
        links = spanning_links(n, scan)
        part = list(range(n))

        def merge(pairs, part=part):
            part[:] = range(len(part))
            for a, b in pairs:
                p, q = part[a], part[b]
                part[:] = [p if x == q else x for x in part]
            return [part.index(x) for x in part]

        alike = [(a, b) for a in range(n) for b in range(n) if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b]))]
        assert merge(links) == merge(alike)
        assert len(links) < n and set(links) <= {*alike, *[(b, a) for a, b in alike]}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(100)] + [(5, 5), (None, 3), (7, None)]
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    part = {}
    for a, b in pairs:
        if a is None or b is None or a == b:
            continue
        p, q = part.setdefault(a, a), part.setdefault(b, b)
        part = {x: min(p, q) if y in (p, q) else y for x, y in part.items()}
    assert found == part


def test_texts_of_one_id(spark):
    """Rows of one doc_id are one document, linked by its smaller set and with rows of equal sets, however rows are dealt."""
    a, b = "one two three four five six seven", "other words that are more than those of the first text by far"
    rows = [(1, a, "en", ""), (2, a, "en", ""), (2, b, "en", ""), (3, b, "en", "")]
    found = [sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(make(spark, rows).repartition(n)).collect()) for n in (1, 4)]
    assert found[0] == found[1] and {i: c for i, _, c in found[0] if i != 2} == {1: 1, 3: 1}
