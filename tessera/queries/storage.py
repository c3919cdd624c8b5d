"""Queries over tables of the engine: each builds its table in a fresh scratch folder and reads it back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import fragment_of, fragment_or_rand
from ..operators import backfill, dml, indexes, maintenance
from ..operators.joins import fragment_join
from ..operators.vector import nearest
from ..plans.sql import Engine
from ..sources.catalog import Catalog
from ..sources.scratch import scratch_path
from ..sources.table import Table, write
from ..streaming import cdf
from . import Tables, query


def _copy(t: Tables, df: DataFrame, fragments: int | None = None, key: str | None = None, properties: dict | None = None) -> Table:
    """A table with the rows of ``df``; ``fragments`` and ``key`` deal them, else they stay as they were read."""
    if fragments:
        df = df.repartitionByRange(fragments, key) if key else df.repartition(fragments)
    return write(df, scratch_path(t.spark, "table"), properties=properties)


@query("SELECT * FROM orders")
def table_scan(t):
    return _copy(t, t.orders).df()


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def table_scan_pruned(t):
    """Columns and the condition reach the Parquet scan: a table without changes reads as one."""
    return _copy(t, t.orders).df(where="o_totalprice > 250000 AND o_orderstatus = 'F'", columns=["o_orderkey", "o_totalprice"])


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS addresses, 4::BIGINT AS fragments, 1::BIGINT AS created FROM orders")
def meta_columns(t):
    rows = _copy(t, t.orders, 4, "o_orderkey").df(metadata=True)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("_rowaddr").alias("addresses"), F.count_distinct("_fragid").alias("fragments"), F.max(F.col("_row_created_at_version") - 1).alias("created"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0")
def count_metadata(t):
    table = _copy(t, t.orders, 4)
    dml.delete(table, "o_orderkey % 5 = 0")
    return table.count_df()


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey < 1000 AND o_totalprice > 10000")
def count_filtered(t):
    return _copy(t, t.orders, 4).df(where="o_orderkey < 1000 AND o_totalprice > 10000").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT min(o_orderkey) AS o_orderkey, 1::BIGINT AS n_files FROM orders")
def rowaddr_prune(t):
    """The first row of the first of eight fragments: the condition names its address, so one file is read."""
    table = _copy(t, t.orders, 8, "o_orderkey")
    first = table.df(metadata=True).orderBy("o_orderkey").select("_rowaddr").first()[0]
    rows = table.df(metadata=True, where=f"_rowaddr = {first} AND o_orderkey IS NOT NULL")
    return rows.select("o_orderkey", F.lit(len(rows.inputFiles())).cast("bigint").alias("n_files"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 0")
def time_travel_version(t):
    table = _copy(t, t.nation.where("n_regionkey = 0"))
    table.append(t.nation.where("n_regionkey > 0"))
    return table.df(version=2).select("n_nationkey", "n_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <= 1")
def time_travel_timestamp(t):
    table = _copy(t, t.nation.where("n_regionkey = 0"))
    then = table.append(t.nation.where("n_regionkey = 1")).time_us
    table.append(t.nation.where("n_regionkey > 1"))
    return table.df(timestamp=then).select("n_nationkey", "n_name")


@query("SELECT * FROM nation UNION ALL SELECT n_nationkey + 100, upper(n_name), n_regionkey FROM nation")
def insert_append(t):
    table = _copy(t, t.nation)
    table.append(t.nation.select((F.col("n_nationkey") + 100).alias("n_nationkey"), F.upper("n_name").alias("n_name"), "n_regionkey"))
    return table.df()


@query("SELECT * FROM nation WHERE n_regionkey = 2")
def insert_overwrite(t):
    table = _copy(t, t.nation)
    table.overwrite(t.nation.where("n_regionkey = 2"))
    return table.df()


@query("SELECT r_regionkey AS k, r_name FROM region")
def ctas_replace(t):
    """CREATE TABLE AS, then CREATE OR REPLACE with another schema."""
    engine = Engine(t.spark, Catalog(t.spark, scratch_path(t.spark, "catalog")))
    t.nation.createOrReplaceTempView("nation_source")
    t.region.createOrReplaceTempView("region_source")
    engine.sql("CREATE TABLE places AS SELECT * FROM nation_source")
    engine.sql("CREATE OR REPLACE TABLE places AS SELECT r_regionkey AS k, r_name FROM region_source")
    return engine.sql("SELECT k, r_name FROM places")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 50000)")
def dml_delete(t):
    table = _copy(t, t.orders, 4)
    dml.delete(table, "o_orderstatus = 'F' AND o_totalprice > 50000")
    return table.df().select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def dml_update(t):
    table = _copy(t, t.orders, 4)
    dml.update(table, {"o_totalprice": "o_totalprice * 2", "o_orderstatus": "'X'"}, "o_orderstatus = 'O'")
    return table.df().select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 1 ELSE c_nationkey END::INT AS first FROM customer")
def dml_update_nested(t):
    """A field of a struct, and an array by a lambda."""
    made = t.customer.select("c_custkey", F.struct("c_name", F.col("c_mktsegment").alias("seg")).alias("info"), F.array("c_nationkey", F.lit(1)).alias("ns"))
    table = _copy(t, made)
    dml.update(table, {"info.seg": "concat(upper(info.seg), '!')", "ns": "transform(ns, x -> x + 1)"}, "c_custkey % 3 = 0")
    return table.df().select("c_custkey", "info.seg", F.col("ns")[0].alias("first"))


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 10 <> 0
 UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal FROM customer WHERE c_custkey % 7 = 0""")
def dml_merge(t):
    """Deletes, updates and inserts in one commit, through SQL."""
    engine = Engine(t.spark)
    table = _copy(t, t.customer.select("c_custkey", "c_name", "c_acctbal"), 4)
    even = t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.where("c_custkey % 7 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", "c_acctbal")
    even.unionAll(new).createOrReplaceTempView("customer_changes")
    engine.sql(f"""MERGE INTO `{table.root}` AS t USING customer_changes AS s ON t.c_custkey = s.c_custkey
        WHEN MATCHED AND t.c_custkey % 10 = 0 THEN DELETE
        WHEN MATCHED THEN UPDATE SET c_acctbal = t.c_acctbal + 100
        WHEN NOT MATCHED THEN INSERT *""")
    return table.df()


@query("SELECT p_partkey, p_name, p_retailprice * 1.1 AS gross FROM part")
def backfill_add(t):
    table = _copy(t, t.part.select("p_partkey", "p_name", "p_retailprice"), 4)
    rows = table.df(metadata=True)
    backfill.add_columns(table, ["gross"], rows.select("_rowaddr", "_fragid", (F.col("p_retailprice") * 1.1).alias("gross")))
    return table.df().select("p_partkey", "p_name", "gross")


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size * 2 END AS twice FROM part")
def backfill_add_partial(t):
    table = _copy(t, t.part.select("p_partkey", "p_size"), 4)
    rows = table.df(metadata=True).where("p_size > 25")
    backfill.add_columns(table, ["twice"], rows.select("_rowaddr", "_fragid", (F.col("p_size") * 2).alias("twice")))
    return table.df().select("p_partkey", "twice")


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size > 40 THEN 'large' ELSE p_brand END AS p_brand FROM part")
def backfill_update(t):
    """Matched rows may become null; the others keep their values; addresses stay."""
    table = _copy(t, t.part.select("p_partkey", "p_brand", "p_size"), 4)
    rows = table.df(metadata=True).where("p_size < 10 OR p_size > 40")
    backfill.update_columns(table, ["p_brand"], rows.select("_rowaddr", "_fragid", F.when(F.col("p_size") > 40, "large").alias("p_brand")))
    return table.df().select("p_partkey", "p_brand")


@query("SELECT * FROM (VALUES (10::BIGINT, 2::BIGINT, 10::BIGINT, 2::BIGINT)) v(fragments_removed, fragments_added, files_removed, files_added)")
def optimize_stats(t):
    """Ten fragments of one row, five to a fragment."""
    table = _copy(t, t.nation.where("n_nationkey < 10"), 10, "n_nationkey")
    return maintenance.optimize(table, {"target_rows_per_fragment": 5})


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 4 <> 1")
def optimize_rows(t):
    """Rows after deletions and compaction, through SQL."""
    table = _copy(t, t.nation, 5)
    engine = Engine(t.spark)
    engine.sql(f"DELETE FROM `{table.root}` WHERE n_nationkey % 4 = 1")
    engine.sql(f"OPTIMIZE `{table.root}` WITH (target_rows_per_fragment = 100, materialize_deletions = true)")
    return engine.sql(f"SELECT n_nationkey, n_name FROM `{table.root}`")


@query("SELECT true AS freed, 3::BIGINT AS old_versions, (SELECT count(*) FROM nation) AS n")
def vacuum_stats(t):
    table = _copy(t, t.nation.where("n_regionkey < 4"))
    table.append(t.nation.where("n_regionkey = 4"))
    table.overwrite(t.nation)
    out = maintenance.vacuum(table, {"before_version": 1000000})
    return out.select((F.col("bytes_removed") > 0).alias("freed"), "old_versions", F.lit(table.df().count()).alias("n"))


@query("""SELECT * FROM (VALUES ('by_key', 'o_orderkey', 'btree', 4::BIGINT, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0), 1::BIGINT, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 1)))
 v(name, field, index_type, num_indexed_fragments, num_indexed_rows, num_unindexed_fragments, num_unindexed_rows)""")
def show_indexes(t):
    table = _copy(t, t.orders.where("o_orderkey % 2 = 0"), 4)
    engine = Engine(t.spark)
    engine.sql(f"ALTER TABLE `{table.root}` CREATE INDEX by_key USING btree (o_orderkey) WITH (zone_size = 500)")
    table.append(t.orders.where("o_orderkey % 2 = 1").coalesce(1))
    return engine.sql(f"SHOW INDEXES FROM `{table.root}`").withColumn("field", F.col("fields")[0]).drop("fields")


@query("SELECT 4::BIGINT AS fragments_indexed, 'words' AS index_name")
def create_index(t):
    table = _copy(t, t.documents.select("doc_id", "text"), 4)
    return indexes.create_index(table, "words", "fts", ["text"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 500 AND 700")
def index_btree_lookup(t):
    table = _copy(t, t.orders, 8, "o_orderkey")
    indexes.create_index(table, "by_key", "btree", ["o_orderkey"], {"zone_size": 256})
    return indexes.lookup(table, "o_orderkey", 500, 700).select("o_orderkey", "o_custkey")


@query(r"""SELECT doc_id FROM (SELECT doc_id, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS w FROM documents) WHERE list_contains(w, 'license') AND list_contains(w, 'the')""")
def fts_search(t):
    table = _copy(t, t.documents.select("doc_id", "text"), 4)
    indexes.create_index(table, "words", "fts", ["text"])
    return indexes.search(table, "text", "The License").select("doc_id")


_KEY = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"


def _key(t) -> list[float]:
    return t.embeddings.where("vec_id = 0").select("embedding").first()[0]


@query(f"SELECT vec_id, round(list_sum(list_transform(list_zip(embedding, {_KEY}), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), 6) AS distance FROM embeddings ORDER BY list_sum(list_transform(list_zip(embedding, {_KEY}), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), vec_id LIMIT 10")
def knn_l2(t):
    table = _copy(t, t.embeddings.select("vec_id", "embedding"), 3, properties={"embedding.arrow.fixed-size-list.size": "64"})
    request = json.dumps({"column": "embedding", "key": _key(t), "k": 10, "distanceType": "l2"})
    return table.df(options={"nearest": request}).select("vec_id", F.round("_distance", 6).alias("distance"))


@query(f"SELECT vec_id, round(1 - list_cosine_similarity(embedding::DOUBLE[], {_KEY}::DOUBLE[]), 6) AS distance FROM embeddings ORDER BY 1 - list_cosine_similarity(embedding::DOUBLE[], {_KEY}::DOUBLE[]), vec_id LIMIT 10")
def knn_cosine(t):
    return nearest(t.embeddings, {"column": "embedding", "key": _key(t), "k": 10, "distanceType": "cosine"}, "vec_id").select("vec_id", F.round("_distance", 6).alias("distance"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'updated' ELSE 'inserted' END AS kind FROM orders WHERE (o_orderkey % 2 = 0 AND o_orderkey % 3 = 0) OR (o_orderkey % 2 = 1 AND o_orderkey % 3 <> 0)")
def cdf_incremental(t):
    """What changed after the second version: rows updated, and rows inserted then."""
    table = _copy(t, t.orders.where("o_orderkey % 2 = 0"))
    dml.update(table, {"o_totalprice": "0"}, "o_orderkey % 3 = 0")
    table.append(t.orders.where("o_orderkey % 2 = 1 AND o_orderkey % 3 <> 0"))
    new = F.when(F.col("_row_created_at_version") > 2, "inserted").otherwise("updated")
    return cdf.changes_since(table, 2).select("o_orderkey", new.alias("kind"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 11 = 0")
def cdf_deleted(t):
    table = _copy(t, t.orders, 2, properties={"enable_stable_row_ids": "true"})
    before = table.manifest().version
    dml.update(table, {"o_totalprice": "1"}, "o_orderkey % 5 = 0")
    dml.delete(table, "o_orderkey % 11 = 0")
    gone = cdf.deleted_between(table, before, table.manifest().version)
    return table.df(version=before, metadata=True).join(gone, "_rowid", "left_semi").select("o_orderkey")


@query("SELECT o_orderkey, o_totalprice * 2 AS twice FROM orders WHERE o_orderstatus = 'P'")
def fragment_aware_join(t):
    rows = _copy(t, t.orders, 4).df(metadata=True)
    left, right = rows.select("_rowaddr", "o_orderkey"), rows.where("o_orderstatus = 'P'").select("_rowaddr", (F.col("o_totalprice") * 2).alias("twice"))
    return fragment_join(left, right).select("o_orderkey", "twice")


@query("SELECT doc_id, octet_length(encode(text))::BIGINT AS size, 0::INT AS read FROM documents")
def blob_sizes(t):
    """A blob reads as empty bytes with its size beside it."""
    docs = t.documents.select("doc_id", F.encode("text", "utf-8").alias("data"))
    rows = _copy(t, docs, properties={"data.tessera.encoding": "blob"}).df(metadata=True)
    return rows.select("doc_id", F.col("data__blob_size").alias("size"), F.octet_length("data").alias("read"))


@query("SELECT 3::BIGINT AS known, true AS whole, (SELECT count(*) FROM nation) AS n")
def fn_fragment_or_rand(t):
    """Known fragments stay, nulls get some number."""
    rows = _copy(t, t.nation, 3).df(metadata=True).select("_fragid").unionAll(t.spark.range(5).select(F.lit(None).cast("int")))
    made = rows.select("_fragid", fragment_or_rand("_fragid").alias("f"))
    return made.agg(F.count_distinct("_fragid").alias("known"), F.every(F.col("f").isNotNull() & (F.col("_fragid").isNull() | (F.col("_fragid") == F.col("f")))).alias("whole"), F.count("_fragid").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 12")
def table_topn(t):
    return _copy(t, t.orders, 4).df(where="o_totalprice > 100000").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(12).select("o_orderkey", "o_totalprice")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 3")
def sql_statements(t):
    """A life of a table in SQL: namespace, create, insert, delete, columns from a view, time travel."""
    engine = Engine(t.spark, Catalog(t.spark, scratch_path(t.spark, "catalog")))
    t.nation.createOrReplaceTempView("nation_source")
    engine.sql("CREATE NAMESPACE geo")
    engine.sql("CREATE TABLE geo.nation (n_nationkey INT NOT NULL, n_name STRING)")
    engine.sql("INSERT INTO geo.nation SELECT n_nationkey, n_name FROM nation_source")
    engine.sql("DELETE FROM geo.nation WHERE n_nationkey < 3")
    engine.sql("UPDATE geo.nation SET n_name = upper(n_name) WHERE n_nationkey = 5")
    engine.sql("UPDATE geo.nation SET n_name = 'none' WHERE n_nationkey = 6")
    return engine.sql("SELECT n_nationkey, n_name FROM geo.nation VERSION AS OF 3")


@query("SELECT 4::BIGINT AS fragments, count(*) AS n FROM orders")
def write_clustered(t):
    """Changes are dealt by fragment and in order of address before they are written."""
    rows = _copy(t, t.orders, 4, "o_orderkey").df(metadata=True)
    out = dml.clustered(rows.select("_rowaddr", "_fragid"))
    return out.agg(F.count_distinct(fragment_of("_rowaddr")).alias("fragments"), F.count("*").alias("n"))
