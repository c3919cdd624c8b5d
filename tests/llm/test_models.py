"""Language identification and language-model scoring."""

import collections
import math
import random
import tempfile
import zlib

import numpy as np
from helpers import make
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.llm.eliasfano import EliasFano, NgramTrie
from tessera.llm.langid import LangParams, identify, predict, train
from tessera.llm.lm import LmParams, build_shard, pack, score, unpack


def crc(i):
    return zlib.crc32(str(i).encode())


# --- language identification


def spoken(n, seed=1):
    rng = random.Random(seed)
    sounds = {"en": ["the", "ing", "and", "tion", "er"], "fr": ["le", "eau", "ré", "que", "oi"], "de": ["der", "sch", "ung", "ü", "ein"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(sounds))
        rows.append((i, " ".join("".join(rng.choices(sounds[lang], k=2)) for _ in range(rng.randrange(2, 40))), lang, "s"))
    return rows


def naive_bayes(rows, p=LangParams()):
    """``doc_id: (held_out, lang_pred, score, excess)`` one n-gram at a time; for tables that ``per_lang`` does not thin."""

    def grams(text):
        cp = [ord(c) if c.isalpha() else 32 for c in f" {text.lower()}{' ' * (max(p.orders) - 1)}"]
        for i in range(len(cp) - max(p.orders) + 1):
            for order in p.orders:
                h = order
                for j in range(order):
                    h = (h * 0x01000193 & 0xFFFFFFFF ^ cp[i + j]) * 0x9E3779B1 & 0xFFFFFFFF
                    h ^= h >> 15
                yield h >> (32 - p.bits)

    counts = {}
    for i, text, lang, *_ in rows:
        if crc(i) % 5 and text is not None and lang is not None:
            counts.setdefault(lang, collections.Counter()).update(grams(text) if text else ())
    slots = (1 << p.bits) + 1
    sums = {k: c.total() + p.alpha * slots for k, c in counts.items()}
    own = {}
    for k, c in counts.items():
        p_k = [(n + p.alpha) / sums[k] for n in c.values()] + [p.alpha / sums[k]] * (slots - len(c))
        own[k] = sum(x * math.log(x) for x in p_k)
    out = {}
    for i, text, *_ in rows:
        found = ("und", 0.0, 0.0)
        if any(c.isalpha() for c in (text or "").lower()):
            seen = collections.Counter(grams(text))
            total = {k: sum(n * math.log((counts[k][g] + p.alpha) / sums[k]) for g, n in seen.items()) for k in sorted(counts)}
            best = max(total, key=total.get)
            post = 1 / sum(math.exp(max(x - total[best], -700)) for x in total.values())
            found = (best, post, (seen.total() * own[best] - total[best]) / (seen.total() + p.prior_grams))
        out[i] = (crc(i) % 5 == 0, *found)
    return out


def same_languages(got, want):
    assert {i: x[:2] for i, x in got.items()} == {i: x[:2] for i, x in want.items()}
    assert all(abs(x[k] - want[i][k]) < 1e-3 for i, x in got.items() for k in range(2, len(x)))


def test_scores_are_those_of_naive_bayes(spark):
    rows = [*spoken(150), (1000, "the der eau", None, "s"), (1001, "t", None, "s"), (1002, "12 34", "en", "s"), (1003, "", "de", "s"), (1004, None, "de", "s")]
    same_languages({r.doc_id: (r.held_out, r.lang_pred, r.score) for r in identify(make(spark, rows)).collect()}, naive_bayes(rows))


def test_excess_is_that_of_naive_bayes(spark):
    rows = [*spoken(150), (1000, "кот спит на столе " * 9, None, "s"), (1001, "t", None, "s"), (1002, "12 34", "en", "s"), (1003, "", "de", "s"), (1004, None, "de", "s")]
    docs, want = make(spark, rows), naive_bayes(rows)
    model = train(docs.where(crc_mod(F.col("doc_id"), 5) != 0))
    got = {r.doc_id: (want[r.doc_id][0], r.lang_pred, r.score, r.excess) for r in predict(docs, model, "doc_id").collect()}
    same_languages(got, want)
    assert got[1000][3] > 2 + max(got[i][3] for i in range(150)) and got[1004][3] == 0


def test_held_out_accuracy(spark):
    rows = spoken(300)
    out = {r.doc_id: r for r in identify(make(spark, rows)).collect()}
    truth = {i: lang for i, _, lang, _ in rows}
    held = [r for r in out.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if crc(i) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_label_is_no_input_and_sample_is_bounded(spark):
    rows = spoken(200)
    held = [r for r in rows if crc(r[0]) % 5 == 0]
    lied = [(i, t, "de" if crc(i) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(make(spark, rows)).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in identify(make(spark, lied)).collect()}
    assert held and a == b
    few = identify(make(spark, rows), LangParams(per_lang=20))
    assert few.count() == len(rows)


def test_langid_messy(messy, docs):
    out = identify(docs).collect()
    assert len(out) == len(messy)
    by = {r.doc_id: r for r in out}
    for i in (0, 1, 2, 96):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[10].lang_pred == "en" and by[95].lang_pred in ("en", "de", "fr")
    assert all(r.held_out is False for r in out if r.doc_id is None)


def test_langid_nothing(spark, nothing):
    assert identify(nothing).count() == 0
    none = make(spark, [(1, "some text", None, "s")])
    assert [tuple(r) for r in identify(none).collect()] == [(1, crc(1) % 5 == 0, "und", 0.0)]


def test_long_text_is_read_whole(spark):
    """The language changes after a megabyte: the larger part decides."""
    rows = spoken(300)
    en = " ".join(t for _, t, lang, _ in rows if lang == "en")
    de = " ".join(t for _, t, lang, _ in rows if lang == "de")
    long = (en * (1_000_000 // len(en) + 1))[:400_000] + (de * (1_000_000 // len(de) + 1))[:900_000]
    out = {r.doc_id: r for r in identify(make(spark, [*rows, (10_000, long, None, "s")])).collect()}
    assert out[10_000].lang_pred == "de"


# --- language model


def reference(rows, p):
    uni, bi, texts = collections.Counter(), collections.Counter(), []
    for i, t, *_ in rows:
        w = [*(t or "").encode().lower().split(), b" end"]
        texts.append((i, w))
        if i is not None and crc(i) % 7 != 2:
            uni.update(w)
            bi.update(zip([b" end", *w], w, strict=False))
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, w in texts:
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        total = 0.0
        for c, x in zip([b" end", *w], w, strict=False):
            m = p.kappa * uni[c] ** p.beta if uni[c] else 1
            total += math.log10((bi[c, x] + m * (uni[x] + 1) / (n + v + 1)) / (uni[c] + m))
        out.append((i, i is not None and crc(i) % 7 == 2, len(w), sum(uni[x] > 0 for x in w), n, base, total))
    return out


def near(a, b):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert [x[:5] for x in a] == [x[:5] for x in b]
    for x, y in zip(a, b, strict=True):
        assert abs(x[5] - y[5]) < 1e-6 * max(1, abs(y[5]))
        assert abs(x[6] - y[6]) < 2e-4 * y[2]  # the quantised step


def test_scores(messy, docs):
    for params in (LmParams(), LmParams(chunk_tokens=500, shard_words=300, shard_tokens=700)):
        near([tuple(r) for r in score(docs, params).collect()], reference(messy, params))


def test_scores_of_nothing(spark, nothing):
    assert score(nothing).count() == 0
    held = next(i for i in range(100) if crc(i) % 7 == 2)
    rows = [(held, "only held out", "en", "s"), (None, "no id", "en", "s")]
    near([tuple(r) for r in score(make(spark, rows)).collect()], reference(rows, LmParams()))


def test_held_out_text_of_the_corpus_gains(spark):
    rng = random.Random(2)
    lines = [" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(20)]
    rows = [(i, "\n".join(rng.sample(lines, 4)), "en", "s") for i in range(300)]
    held = [r for r in score(make(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_pack():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.uint32), np.array([True, False]), np.array([1.5, -2.0])]
    for a, b in zip(arrays, unpack(pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and (a == b).all()


def test_elias_fano():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, top = rng.integers(0, 200), int(rng.choice([1, 2, 10, 300, 10**6, 2**50]))
        v = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        e = EliasFano.build(v)
        if n:
            assert (e.get(np.arange(n)) == v).all()
        q, a = rng.integers(0, top + 5, 80).astype(np.uint64), rng.integers(0, n + 1, 80)
        b = np.maximum(a, rng.integers(0, n + 1, 80))
        want = [next((i for i in range(x, y) if v[i] >= z), y) for z, x, y in zip(q, a, b, strict=True)]
        assert e.successor(q, a, b).tolist() == want


def test_trie_of_three_levels():
    rng = np.random.default_rng(1)
    for top in (3, 10, 1000):
        g3 = np.unique(rng.integers(0, top, (90, 3)), axis=0)
        g2 = np.unique(np.concatenate([g3[:, :2], rng.integers(0, top, (20, 2))]), axis=0)
        g1 = np.unique(np.concatenate([g2[:, :1], rng.integers(0, top, (5, 1))]), axis=0)
        logp = [-rng.random(len(g)) * 5 for g in (g1, g2, g3)]
        back = [-rng.random(len(g)) * 3 for g in (g1, g2)]
        with tempfile.NamedTemporaryFile() as f:
            NgramTrie.build([g1, g2, g3], logp, back).save(f.name)
            trie = NgramTrie.load(f.name)
            for k, x in enumerate(back):
                assert np.abs(trie.back(k, np.arange(len(x))) - x).max() <= 0.5 / trie.BACK_STEP + 1e-12
            for k, g in enumerate((g1, g2, g3)):
                assert (trie.find(g) == np.arange(len(g))).all()
                assert np.abs(trie.logp(k, np.arange(len(g))) - logp[k]).max() <= 0.5 / trie.STEP + 1e-12
                q, at = rng.integers(0, top, (200, k + 1)), {tuple(r): i for i, r in enumerate(g.tolist())}
                assert trie.find(q).tolist() == [at.get(tuple(r), -1) for r in q.tolist()]


def test_shard_answers_from_its_trie():
    """Every bigram of a shard, seen or not, is scored by the trie alone: its levels have all that the formula needs."""
    rng = np.random.default_rng(4)
    p, size = LmParams(), 1000.0
    counts = rng.integers(1, 50, 40)
    first, second = rng.integers(0, 40, 300).astype(np.uint64), rng.integers(0, 40, 300).astype(np.uint64)
    pairs = np.unique(np.stack([first, second], 1), axis=0)
    first, second = pairs[:, 0], pairs[:, 1]
    seen = rng.integers(0, 3, len(pairs)).astype(np.uint32)
    trie = build_shard(iter([(first, second, seen, counts[first.astype(int)], counts[second.astype(int)])]), size, p)
    at = trie.find(pairs)
    assert ((at >= 0) == (seen > 0)).all()
    for i, (a, b) in enumerate(pairs.astype(int).tolist()):
        n, m = counts[a], p.kappa * counts[a] ** p.beta
        want = math.log10((seen[i] + m * (counts[b] + 1) / size) / (n + m))
        one = lambda x: trie.find(np.array([[x]], np.uint64))
        got = trie.logp(1, at[i : i + 1]) if at[i] >= 0 else trie.back(0, one(a)) + trie.logp(0, one(b))
        assert abs(got[0] - want) < 2e-4
