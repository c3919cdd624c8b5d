"""A corpus pipeline of five stages: language ID, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, linededup, minhash, packing
from tessera.llm.common import Scratch, crc_mod, cut, sized

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = minhash.MinHashParams(shingle=5)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, texts whose best language has under half of the posterior, and texts in none of the
    languages: those over ``max_excess`` nats an n-gram less likely than their best language's own n-grams (see ``LangParams``).

    Null and empty texts go; rows are judged one by one, repeated ones too. Ties go to the first language. Where there is
    nothing to learn from, all rows go. Here and in the next stages texts are read whole, other columns than those of
    documents are dropped, and an empty table stays empty.
    """
    params = langid.LangParams()
    model = langid.train(docs.where(crc_mod(F.col("doc_id"), 5) != 0), params)
    known = (F.col("lang_pred") != "und") & (F.col("score") >= params.min_score) & (F.col("excess") <= params.max_excess)
    return langid.predict(docs, model, *COLUMNS).where(known).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes site boilerplate out of the texts; every document stays, with ``n_chars`` of what is left."""
    out = linededup.drop_boilerplate(docs)
    changed = F.col("n_dropped") > 0
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id; one row of those of one id and text.

    Near-duplicates share 80 % of their runs of five words; the two words of op1 are looser.
    """
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if not again.isEmpty():
        return _near_dedup_repeated(docs, cut(again))
    found = minhash.near_duplicates(docs, NEAR)
    # ids that go: as a rule far fewer than stay
    gone = cut(found.where("not kept").select("doc_id").distinct())
    return docs.join(sized(gone), "doc_id", "left_anti").select(*COLUMNS)


def _near_dedup_repeated(docs: DataFrame, again: DataFrame) -> DataFrame:
    """For ids that are not unique, those in ``again``: each text of an id is a document of its own, under a hash as key.

    Of rows of one id and text the first by the other columns stays; of a group's documents the first by id, then key.
    """
    again = sized(again)
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    texts = docs.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("x")).select("doc_id", "text", "x.*")
    texts = texts.select(F.xxhash64("doc_id", "text").alias("key"), *COLUMNS)
    keyed = docs.join(again, "doc_id", "left_anti").select(F.col("doc_id").cast("long").alias("key"), *COLUMNS).union(texts)
    found = minhash.near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"), NEAR).where("doc_id is not null").select(F.col("doc_id").alias("key"), "component_id")
    found = found.join(texts.select("key", F.col("doc_id").cast("long").alias("id")), "key", "left")
    firsts = found.groupBy("component_id").agg(F.min(F.struct(F.coalesce("id", "key").alias("id"), "key"))["key"].alias("first"))
    gone = cut(found.join(firsts, "component_id").where("key <> first").select("key"))
    return keyed.join(sized(gone), "key", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any benchmark window go. Null and empty texts stay, and an empty benchmark takes nothing."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document; null and empty texts are one token, and rows of one id are packed each."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]

#: A trained classifier and a tokenizer are no SQL: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark, "pipeline") as scratch:
        for k, (name, stage) in enumerate(STAGES):
            docs = scratch.save(stage(spark, docs, sf_dir), name)
            if k:
                scratch.drop(STAGES[k - 1][0])
        return cut(docs)
