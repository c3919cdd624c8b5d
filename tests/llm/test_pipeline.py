"""The pipeline's stages and the registered queries that SQL cannot express, against brute force on the smallest tables."""

import hashlib
import os

import corpus_pipeline
import numpy as np
import pytest
from test_bytes import brute as covered_bytes
from test_bytes import check_packing
from test_minhash import brute as components
from test_minhash import five_words, got
from test_models import naive_bayes, near, reference, same_languages

from tessera.llm import packing, queries
from tessera.llm.lm import LmParams

DATA = os.environ.get("TESSERA_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontaminate", "pack"]
    bench = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(10, len(w))]) for _, w in bench if w for i in range(len(w) - min(10, len(w)) + 1)}
    sizes = {len(w) for w in windows}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select(*columns).collect()]
        stage(spark, docs, DATA).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        after = [tuple(r) for r in docs.collect()]
        if name != "pack":
            assert docs.columns == columns
        if name == "language_id":
            found = naive_bayes(before)
            assert sorted(after) == sorted(r for r in before if found[r[0]][1] != "und" and found[r[0]][2] >= 0.5 and found[r[0]][3] <= 3)
        elif name == "line_dedup":
            pages, total = {}, {}
            for _, text, _, host, _ in before:
                total[host] = total.get(host, 0) + 1
                for k in {x.strip(" \t\n\x0b\x0c\r") for x in (text or "").split("\n")} - {""}:
                    pages[host, k] = pages.get((host, k), 0) + 1
            want = []
            for i, text, lang, host, n in before:
                lines = text.split("\n")
                left = [x for x in lines if not ((k := (host, x.strip(" \t\n\x0b\x0c\r")))[1] and pages[k] >= 5 and pages[k] / total[host] > 0.1)]
                new = "\n".join(left)
                want.append((i, new, lang, host, len(new) if len(left) < len(lines) else n))
            assert sorted(after) == sorted(want)
        elif name == "near_dedup":
            found = components(before, five_words)
            assert sorted(after) == sorted(r for r in before if found[r[0]][2])
        elif name == "decontaminate":

            def dirty(text):
                w = words(text)
                return any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

            assert sorted(after) == sorted(r for r in before if not dirty(r[1]))
        else:
            n, total = check_packing(before, docs.collect(), packing.PackParams())
            assert n <= 1.05 * -(-total // 1024) + 1


def test_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_op1(spark, rows):
    assert got(queries.op1_minhash_near_dedup(spark, DATA)) == components(rows)


def test_op2(spark, rows):
    near([tuple(r) for r in queries.op2_lm_scoring(spark, DATA).collect()], reference(rows, LmParams()))


def test_op8(spark, rows):
    n, total = check_packing(rows, queries.op8_best_fit_packing(spark, DATA).collect(), packing.PackParams())
    assert n <= 1.05 * -(-total // 1024) + 1


def test_op9(spark, rows):
    out = {r.doc_id: r for r in queries.op9_language_id(spark, DATA).collect()}
    assert out.keys() == {i for i, *_ in rows}
    held = [(out[i].lang_pred, lang) for i, _, lang, _ in rows if out[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    same_languages({i: (r.held_out, r.lang_pred, r.score) for i, r in out.items()}, naive_bayes(rows))


def test_op10(spark, rows):
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op10_suffix_array_dedup(spark, DATA).collect()}
    texts = [(t or "").encode() for _, t, *_ in rows]
    want = {}
    for (i, *_), b, c in zip(rows, texts, covered_bytes(texts, 200), strict=True):
        c = np.asarray(c, bool)
        spans = int((np.diff(c.astype(int), prepend=0) == 1).sum())
        want[i] = (len(b), int(c.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~c].tobytes()).hexdigest())
    assert out == want


def test_every_operator_is_registered():
    assert [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in queries.QUERIES) != 1] == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_messy_rows(spark, docs, nothing, name, stage):
    out = stage(spark, docs, DATA)
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in out.collect()} <= ids
    if name != "pack":
        assert out.columns == corpus_pipeline.COLUMNS
    if name == "near_dedup":
        kept = [r.doc_id for r in out.collect() if r.doc_id is not None]
        assert len(kept) == len(set(kept)) and {0, 1, 2, 3} <= set(kept) and 4 not in kept
    if name == "line_dedup":
        assert out.count() == docs.count()
    assert stage(spark, nothing, DATA).count() == 0
