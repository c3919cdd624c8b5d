"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, crc_mod


@dataclass(frozen=True)
class LangParams:
    """``per_lang`` bounds the expected number of training documents of each language: a language with more is thinned
    by a hash of doc_id. The model is a matrix of 2 ** ``bits`` + 1 rows and one column a language, at most ``max_langs``.
    ``max_excess`` is for callers that reject: nats an n-gram by which a text may be less likely than its language is, where
    ``prior_grams`` more n-grams count as usual ones: a name or a code in a text of a few words tells little."""

    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 17
    per_lang: int = 1500
    max_langs: int = 200
    alpha: float = 0.1
    min_score: float = 0.5
    max_excess: float = 3.0
    prior_grams: int = 60
    block_chars: int = 1 << 18


@dataclass(frozen=True)
class LangModel:
    langs: list[str]
    logp: np.ndarray  #: (2 ** bits + 1, languages) float32; the last row is zero, for windows that leave a text
    usual: np.ndarray  #: (languages,) mean log probability of an n-gram under the language's own distribution
    params: LangParams


@cache
def _letters() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_rows(texts: list[str], params: LangParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed rows of the texts' n-grams (orders x characters), where each text begins, and its number of letters.

    Texts are lower-cased, runs of other characters count as spaces, and each text stands between spaces.
    """
    pad = max(params.orders)
    lowered = [f" {t.lower()}{' ' * pad}" for t in texts]
    starts = np.cumsum([0, *map(len, lowered)])
    cp = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    cp = np.where(letter, cp, np.uint32(32))
    usable = np.ones(len(cp), bool)
    for j in range(1, pad + 1):
        usable[starts[1:] - j] = False
    out = np.empty((len(params.orders), len(cp)), np.int32)
    for r, order in enumerate(params.orders):
        h = np.full(len(cp), order, np.uint32)
        for j in range(order):
            h *= np.uint32(0x01000193)
            h[: len(cp) - j] ^= cp[j:]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        # three spaces in a row tell nothing
        out[r] = np.where(usable, h >> np.uint32(32 - params.bits), np.uint32(1 << params.bits))
    return out, starts, np.add.reduceat(letter, starts[:-1], dtype=np.int64)


def score_texts(texts: list[str | None], model: LangModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Predicted language, posterior probability and excess of each text; ``und``, 0 and 0 for null and for texts without letters.

    The posterior nears 1 with a text's length whatever its language. The excess does not grow with it: it is the mean
    log probability of the language's n-grams minus that of the text's, about 0 for a text of the language and several
    nats for one of a language that was never seen. Very short texts are drawn to 0 by ``prior_grams``. A model that has
    seen little expects less of a text.
    """
    given = [i for i, t in enumerate(texts) if t]
    langs, scores, excess = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    if not model.langs:
        return langs, scores, excess
    for part in blocks(given, lambda i: len(texts[i]), model.params.block_chars):
        rows, starts, letters = ngram_rows([texts[i] for i in part], model.params)
        total, grams = np.zeros((len(part), len(model.langs))), np.zeros(len(part))
        for row in rows:
            total += np.add.reduceat(model.logp[row], starts[:-1], axis=0, dtype=np.float64)
            grams += np.add.reduceat(row != 1 << model.params.bits, starts[:-1], dtype=np.int64)
        best = total.argmax(1)
        post = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        for k, i in enumerate(part):
            if letters[k]:
                langs[i], scores[i] = model.langs[best[k]], post[k]
                excess[i] = (grams[k] * model.usual[best[k]] - total[k, best[k]]) / (grams[k] + model.params.prior_grams)
    return langs, scores, excess


def train(docs: DataFrame, params: LangParams = LangParams()) -> LangModel:
    """Learns from the rows of ``docs(doc_id, text, lang)`` with text and lang.

    Tasks count n-grams of their rows and send, for each language, its non-zero counts; Spark adds them up, so the
    driver gets languages x 2 ** bits numbers at most, whatever the size of the table. No row: a model that knows no
    language and answers ``und``.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(params.max_langs + 1).collect()}
    if len(sizes) > params.max_langs:
        raise ValueError(f"more than {params.max_langs} languages")
    langs = sorted(sizes)
    if not langs:
        return LangModel([], np.zeros(((1 << params.bits) + 1, 0), np.float32), np.zeros(0), params)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, params.per_lang / sizes[k])))])
    sample = docs.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def run(batches):
        import pyarrow as pa

        held = np.zeros((len(langs), (1 << params.bits) + 1), np.int64)
        at = {k: i for i, k in enumerate(langs)}
        for batch in batches:
            pairs = [(t, at[k]) for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t]
            for part in blocks(pairs, lambda x: len(x[0]), params.block_chars):
                rows, starts, _ = ngram_rows([t for t, _ in part], params)
                which = np.repeat([k for _, k in part], np.diff(starts))
                for row in rows:
                    held += np.bincount(which * held.shape[1] + row, minlength=held.size).reshape(held.shape)
        held[:, -1] = 0
        i, j = np.nonzero(held)
        for s in range(0, len(i), 50_000):
            t = slice(s, s + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(i[t], pa.int32()), pa.array(j[t], pa.int32()), pa.array(held[i[t], j[t]], pa.int64())], ["i", "j", "n"])

    counts = np.zeros(((1 << params.bits) + 1, len(langs)))
    totals = sample.select("text", "lang").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    table = totals.toArrow()
    counts[table["j"].to_numpy(), table["i"].to_numpy()] = table["n"].to_numpy()
    logp = np.log((counts + params.alpha) / (counts.sum(0) + params.alpha * len(counts)))
    usual = (np.exp(logp) * logp).sum(0)
    logp[-1] = 0
    return LangModel(langs, logp.astype(np.float32), usual, params)


def predict(docs: DataFrame, model: LangModel, *carry: str | Column) -> DataFrame:
    """``carry`` columns, ``lang_pred``, ``score`` and ``excess`` for every row of ``docs``; only ``text`` is looked at.

    The matrix is broadcast: 2 ** bits rows of 4 bytes a language, 2 MB for four languages at the default.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "__text") + ", lang_pred string, score double, excess double"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs, scores, excess = score_texts(batch.column(batch.num_columns - 1).to_pylist(), held.value)
            answers = [pa.array(langs, pa.string()), pa.array(scores), pa.array(excess)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *answers], [*batch.schema.names[:-1], "lang_pred", "score", "excess"])

    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame, params: LangParams = LangParams(), folds: int = 5) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang, ...)``.

    Learns from rows whose crc32(doc_id) is not 0 modulo ``folds``; a null doc_id is neither held out nor learnt from.
    Null, empty and letterless texts are ``und`` with score 0; long ones are read whole, in one piece. Ties go to the first language in order. Repeated rows
    are answered each. Other columns are not looked at, whatever their names. With no row to learn from every answer is ``und``.
    """
    fold = crc_mod(F.col("doc_id"), folds)
    model = train(docs.where(fold != 0), params)
    return predict(docs, model, "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out")).drop("excess")
