"""Archives, packing and suffix-array dedup."""

import hashlib
import random
import struct
import zlib

import duckdb
import numpy as np
import pytest
import zstandard
from helpers import make

from tessera.llm import packing, suffix, warc
from tessera.llm.bwt import repeated_starts
from tessera.llm.sql import SQL

# --- WARC


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    body = ["<p>" + " ".join(f"word{rng.randrange(50)}" for _ in range(300)) + "</p>" for _ in range(5)]
    rows = [(i, f"http://h{i % 3}.org/{i}", rng.choice(body)) for i in range(40)]
    rows += [(100, None, None), (101, "http://x/\r\nWARC-Type: request", ""), (102, "http://é/", "short"), (103, "http://a/", "short"), (104, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (105, "u", "ü" * 600), (106, "u", "x" * 3_000_000)]
    rows += [rows[0], rows[0], (107, "u", "y" * 999), (108, "u", "y" * 999), (109, "u", "z" * 1000), (110, "u", "z" * 1000)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, first int").repartition(3)


def test_round_trip(pages):
    out = warc.round_trip(pages)
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    cols = sorted(out.columns)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, out.select(*cols).collect())) == sorted(map(key, con.sql(SQL["op7_warc"]).select(*cols).fetchall()))


def test_payloads_and_urls(spark, pages, tmp_path):
    uri = f"file://{tmp_path}/archives"
    assert warc.write_archives(pages, uri, warc.WarcParams(archive_bytes=2000, dict_samples=4)) == pages.count()
    back = {r.page_id: r for r in warc.read_archives(spark, uri).collect()}
    html = {r.page_id: (r.html or "") for r in pages.collect()}
    for i, r in back.items():
        if r.record_type == "response":
            assert bytes(r.payload).decode() == html[i]
        else:
            assert r.payload is None and html[r.refers_to] == html[i]
    assert back[101].url == "http://x/ WARC-Type: request" and back[100].url is None
    assert len(list((tmp_path / "archives").glob("*.warc.zst"))) > 3


def test_no_pages(spark, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(records, dictionary=b"", level=3):
    import io

    out = io.BytesIO()
    w = warc.ArchiveWriter(out, dictionary, level)
    for r in records:
        w.write(r)
    return out.getvalue()


def test_reader_validates():
    ok = warc.encode_record(1, "http://a/", b"payload", None, False, "2024-01-01T00:00:00Z")
    good = archive([ok, ok])
    assert [r.payload for r in warc.read_archive(good)] == [b"payload"] * 2
    assert struct.unpack_from("<I", good)[0] == warc.DICT_MAGIC
    for bad in (ok.replace(b"Content-Length: ", b"Content-Length: 1", 1), ok[:-4], ok.replace(b"WARC/1.1", b"HTTP/1.1"), ok.replace(b"WARC-Date", b"X-Date"), ok.replace(b"payload", b"pAyload"), ok.replace(b"\r\nContent-Type: app", b"\r\nno colon here\r\nContent-Type: app")):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(archive([bad])))
    for data in (good[:-3], good[:20], good + b"junk", good[:6]):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(data))
    flipped = bytearray(good)
    flipped[-12] ^= 0xFF
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(bytes(flipped)))


def test_foreign_archives():
    """A raw dictionary, a skippable frame between records, no dictionary at all."""
    ok = warc.encode_record(1, "http://a/", b"payload " * 50, None, False, "2024-01-01T00:00:00Z")
    d = (ok * 3)[:2000]
    frame = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)).compress(ok)
    data = struct.pack("<II", warc.DICT_MAGIC, len(d)) + d + frame + struct.pack("<II", 0x184D2A55, 3) + b"abc" + frame
    assert len(list(warc.read_archive(data))) == 2
    assert len(list(warc.read_archive(zstandard.ZstdCompressor().compress(ok)))) == 1


# --- packing


def check_packing(rows, out, params):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path(params))
    want = []
    for i, t, *_ in rows:
        ids = [*(tok.encode(t, add_special_tokens=False).ids if t else []), 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in out)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), sum(r.length for r in out)


def test_pack(messy, docs, nothing):
    n, total = check_packing(messy, packing.pack(docs).collect(), packing.PackParams())
    assert n <= 1.1 * -(-total // 1024)
    assert packing.pack(nothing).count() == 0


def test_encoder():
    e = packing.Encoder(packing.tokenizer_path(packing.PackParams()), proof=0)
    assert e.fast is not None
    rng = random.Random(0)
    parts = [" ", "\n", "a", "B", "1", ".", "'s", "\t", "é", "  ", "<|endoftext|>", "漢", " ", "don't", "12a", "ж"]
    for _ in range(3000):
        s = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert e(s) == e.exact(s)


def test_plan():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 3000):
        hist = np.bincount(np.minimum(1024, 1 + rng.geometric(0.004, n)), minlength=1025)
        made = packing.plan(hist)
        used = np.zeros(1025, np.int64)
        for lengths, repeats in made:
            assert sum(lengths) <= 1024 and repeats > 0
            for x in lengths:
                used[x] += repeats
        assert (used == hist).all()
        total = int((hist * np.arange(1025)).sum())
        assert sum(r for _, r in made) <= 1.02 * -(-total // 1024) + 2


# --- suffix-array dedup


def brute(texts, least):
    places = {}
    for i, b in enumerate(texts):
        for p in range(len(b) - least + 1):
            places.setdefault(b[p : p + least], []).append((i, p))
    covered = [np.zeros(len(b), bool) for b in texts]
    for v in places.values():
        if len(v) > 1:
            for i, p in v:
                covered[i][p : p + least] = True
    return covered


def check(spark, rows, params):
    texts = [(t or "").encode() for _, t, *_ in rows]
    want = []
    for (i, *_), b, c in zip(rows, texts, brute(texts, params.least), strict=True):
        left = np.frombuffer(b, np.uint8)[~c].tobytes()
        runs = int((c[1:] & ~c[:-1]).sum() + c[0]) if len(c) else 0
        want.append((i, len(b), int(c.sum()), runs, hashlib.sha256(left).hexdigest()))
    out = suffix.removals(make(spark, rows).repartition(4), params).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out)


def test_removals(spark, messy, nothing):
    rows = [r if r[0] != 10 else (10, r[1][:20_000], *r[2:]) for r in messy]
    for params in (suffix.SuffixParams(), suffix.SuffixParams(group_bytes=300), suffix.SuffixParams(least=20, anchor=7, chunk_bytes=500)):
        check(spark, rows, params)
    assert suffix.removals(nothing).count() == 0


def test_periodic_and_shared_passages(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = [(1, "a" * 1000, "en", "s"), (2, "ab" * 300, "en", "s"), (3, "x" * 199, "en", "s"), (4, "x" * 199, "en", "s"), (5, "y" * 200, "en", "s")]
    rows += [(10 + i, "".join(rng.choice("xyz") for _ in range(rng.randrange(300))) + passage[rng.randrange(80) :] + "é" * i, "en", "s") for i in range(30)]
    rows.append((90, passage + passage, "en", "s"))
    check(spark, rows, suffix.SuffixParams())
    check(spark, rows, suffix.SuffixParams(group_bytes=500))


def test_remaining_text(spark):
    same = "the same passage " * 20
    out = {r.doc_id: r.text for r in suffix.remove_repeats(make(spark, [(1, "one " + same, "en", "s"), (2, "two " + same, "en", "s"), (3, None, "en", "s")])).collect()}
    assert out[1].startswith("on") and out[2].startswith("tw") and len(out[1]) < 30 and out[3] == ""


def test_interval_expansion():
    rng = random.Random(5)
    for _ in range(600):
        base = [bytes(rng.choice(b"abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))) for _ in range(3)]
        texts = [b"".join(rng.choice(base) for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(1, 6))]
        x = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
        least = rng.choice([1, 2, 3, 5, 9, 17, 33])
        seen = {}
        for i in range(len(x) - least + 1):
            w = x[i : i + least].tobytes()
            if b"\xff" not in w:
                seen.setdefault(w, []).append(i)
        want = np.zeros(len(x), bool)
        for v in seen.values():
            if len(v) > 1:
                want[v] = True
        assert (repeated_starts(x, least) == want).all()
