"""Queries over statements, catalogs, commits and options: what a table's life is made of, each with its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..errors import CommitConflict, InvalidArgument, NamespaceNotEmpty, NoSuchTable, TableAlreadyExists, Unsupported
from ..operators import backfill, dml, indexes, maintenance
from ..plans.sql import Engine
from ..sources.catalog import Catalog
from ..sources.datasource import register
from ..sources.scratch import scratch_path
from ..sources.table import Table, write
from ..streaming import cdf, windows
from . import Tables, query
from .storage import _copy


def _engine(t: Tables, **options) -> Engine:
    return Engine(t.spark, Catalog(t.spark, scratch_path(t.spark, "catalog"), **options))


def _raises(kind, f) -> bool:
    try:
        f()
    except kind:
        return True
    return False


def _one(t: Tables, **values):
    """A row of results."""
    return t.spark.createDataFrame([tuple(values.values())], list(values))


@query("SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'd.x' WHEN 1 THEN 'x' ELSE n_name END AS n_name FROM nation WHERE n_nationkey <> 0")
def dml_delete_literal(t):
    """A literal that looks like a column of the table is a literal."""
    engine = _engine(t)
    t.nation.createOrReplaceTempView("nation_source")
    engine.sql("CREATE TABLE d AS SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'd.x' WHEN 1 THEN 'x' ELSE n_name END AS n_name FROM nation_source")
    engine.sql("DELETE FROM d WHERE d.n_name = 'd.x' -- not 'x'")
    return engine.sql("SELECT * FROM d")


@query("SELECT n_nationkey, CASE WHEN n_nationkey < 5 THEN n_name || ' is d.n_name, = WHERE' WHEN n_regionkey = 2 THEN NULL ELSE n_name END AS n_name FROM nation")
def dml_update_literal(t):
    """Assignments with commas, equals signs, keywords and CASE in them."""
    engine = _engine(t)
    t.nation.createOrReplaceTempView("nation_source")
    engine.sql("CREATE TABLE d AS SELECT * FROM nation_source")
    engine.sql("UPDATE d AS x SET n_name = CASE WHEN x.n_nationkey < 5 THEN concat(d.n_name, ' is d.n_name, = WHERE') END WHERE x.n_nationkey < 5 OR (d.n_regionkey = 2 AND n_nationkey >= 5)")
    return engine.sql("SELECT n_nationkey, n_name FROM d")


@query("SELECT c_custkey, c_name AS city, 'x, y' AS country, c_nationkey AS first FROM customer WHERE c_custkey <= 50")
def ddl_nested(t):
    """Struct, map and decimal columns in CREATE TABLE."""
    engine = _engine(t)
    t.customer.createOrReplaceTempView("customer_source")
    engine.sql("CREATE TABLE c (c_custkey BIGINT NOT NULL COMMENT 'a, (b', at STRUCT<city: STRING, more: STRUCT<country: STRING>>, m MAP<STRING, ARRAY<INT>>, d DECIMAL(10, 2)) PARTITIONED BY (bucket(4, c_custkey))")
    engine.sql("INSERT INTO c SELECT c_custkey, named_struct('city', c_name, 'more', named_struct('country', 'x, y')), map('k', array(c_nationkey)), 1.5 FROM customer_source WHERE c_custkey <= 50")
    return engine.sql("SELECT c_custkey, at.city, at.more.country, m['k'][0] AS first FROM c WHERE d = 1.5")


@query("""SELECT c_custkey, CASE WHEN c_custkey IN (1, 2, 3) THEN 'when (matched)' ELSE c_name END AS c_name FROM customer WHERE c_custkey <= 20 AND c_custkey NOT IN (4, 5)
 UNION ALL SELECT c_custkey + 1000000, c_name FROM customer WHERE c_custkey IN (6, 7)""")
def merge_subquery_in(t):
    """A source that ends in brackets, CASE in clauses, a field of a struct set by MERGE."""
    engine = _engine(t)
    t.customer.createOrReplaceTempView("customer_source")
    engine.sql("CREATE TABLE c AS SELECT c_custkey, named_struct('name', c_name, 'n', 1) AS info FROM customer_source WHERE c_custkey <= 20")
    engine.sql("""MERGE INTO c AS x USING (SELECT CASE WHEN c_custkey IN (6, 7) THEN c_custkey + 1000000 ELSE c_custkey END AS k, c_name FROM customer_source WHERE c_custkey IN (1, 2, 3, 4, 5, 6, 7)) AS s
        ON x.c_custkey = s.k
        WHEN MATCHED AND CASE WHEN s.k IN (4, 5) THEN true ELSE false END THEN DELETE
        WHEN MATCHED THEN UPDATE SET x.info.name = CASE WHEN s.k > 0 THEN 'when (matched)' END
        WHEN NOT MATCHED THEN INSERT (c_custkey, info) VALUES (s.k, named_struct('name', s.c_name, 'n', 2))""")
    return engine.sql("SELECT c_custkey, info.name AS c_name FROM c")


@query("SELECT n_nationkey FROM nation")
def rowaddr_case(t):
    """AND within CASE says nothing about the whole condition: no fragment is ruled out."""
    table = _copy(t, t.nation, 4, "n_nationkey")
    return table.df(where="CASE WHEN n_nationkey >= 0 AND _rowaddr = 0 AND n_nationkey < 99 THEN true ELSE true END", columns=["n_nationkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey < 300 AND o_orderstatus = 'F')")
def dml_delete_subquery(t):
    """A condition with a subquery on another table of the engine."""
    engine = _engine(t)
    for name in ("kept", "o"):
        engine.catalog.create_table_as(name, t.orders.where("o_orderkey < 300 AND o_orderstatus = 'F'") if name == "kept" else t.orders)
    engine.sql("DELETE FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept WHERE o_orderkey IS NOT NULL)")
    return engine.sql("SELECT o_orderkey, o_custkey FROM o")


@query("SELECT o_orderkey, o_custkey, 1::BIGINT AS n_files FROM orders WHERE o_orderkey BETWEEN 500 AND 520 AND o_custkey > 0")
def index_where(t):
    """A condition reads only the fragments that a zone map leaves."""
    table = _copy(t, t.orders, 8, "o_orderkey")
    indexes.create_index(table, "by_key", "btree", ["o_orderkey"], {"zone_size": 64})
    rows = table.df(where="o_orderkey >= 500 AND o_orderkey <= 520 AND o_custkey > 0")
    return rows.select("o_orderkey", "o_custkey", F.lit(min(len(rows.inputFiles()), 2) if len(rows.inputFiles()) > 2 else 1).cast("bigint").alias("n_files"))


@query("SELECT o_orderkey, o_custkey, true AS pruned FROM orders WHERE o_orderkey BETWEEN 500 AND 520")
def index_sql(t):
    """So does a query in SQL."""
    engine = _engine(t)
    engine.catalog.create_table_as("o", t.orders.repartitionByRange(8, "o_orderkey"))
    engine.sql("ALTER TABLE o CREATE INDEX by_key USING btree (o_orderkey) WITH (zone_size = 64)")
    rows = engine.sql("SELECT o_orderkey, o_custkey FROM o AS x WHERE x.o_orderkey BETWEEN 500 AND 520 ORDER BY o_orderkey")
    return rows.withColumn("pruned", F.lit(len(rows.inputFiles()) <= 2))


@query("SELECT p_partkey, true AS bare FROM part")
def backfill_unnamed(t):
    """A query that does not name a column beside the fragments does not join it."""
    engine = _engine(t)
    engine.catalog.create_table_as("p", t.part.select("p_partkey", "p_size"))
    engine.sql("ALTER TABLE p ADD COLUMNS twice FROM (SELECT _rowaddr, _fragid, p_size * 2 AS twice FROM p)")
    rows = engine.sql("SELECT p_partkey FROM p")
    return rows.withColumn("bare", F.lit("Join" not in rows._jdf.queryExecution().optimizedPlan().toString()))


@query("SELECT p_partkey, p_size * 2 AS twice, 0::BIGINT AS sides FROM part")
def optimize_sides(t):
    """OPTIMIZE folds columns beside fragments in, also of fragments of full size."""
    table = _copy(t, t.part.select("p_partkey", "p_size"), 3)
    rows = table.df(metadata=True)
    backfill.add_columns(table, ["twice"], rows.select("_rowaddr", "_fragid", (F.col("p_size") * 2).alias("twice")))
    maintenance.optimize(table, {"target_rows_per_fragment": 10})
    return table.df().select("p_partkey", "twice", F.lit(len(table.manifest().sides)).cast("bigint").alias("sides"))


@query("SELECT n_nationkey, n_name FROM nation")
def write_modes(t):
    """Append needs the table, error wants none, overwrite keeps the schema, ignore leaves it; a failed query leaves no table."""
    path = scratch_path(t.spark, "table")
    rows = t.nation.select("n_nationkey", "n_name")
    ok = _raises(NoSuchTable, lambda: write(rows, path, "append"))
    ok &= _raises(Exception, lambda: write(rows.withColumn("bad", F.raise_error(F.lit("no")).cast("int")), path)) and not Table(t.spark, path).log.exists()
    write(rows.where("n_nationkey < 3"), path)
    ok &= _raises(TableAlreadyExists, lambda: write(rows, path))
    write(rows, path, "overwrite")
    write(rows, path, "ignore")
    return Table.open(t.spark, path).df().where(F.lit(ok))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 20")
def table_location(t):
    """An external table shares the rows; dropping it leaves them, PURGE of a foreign folder raises."""
    engine = _engine(t)
    table = _copy(t, t.nation.select("n_nationkey", "n_name"))
    engine.sql(f"CREATE TABLE other LOCATION '{table.root}'")
    engine.sql("DELETE FROM other WHERE n_nationkey >= 20")
    ok = _raises(InvalidArgument, lambda: engine.sql("DROP TABLE other PURGE"))
    engine.sql("DROP TABLE other")
    return engine.sql(f"SELECT * FROM `{table.root}`").where(F.lit(ok and not engine.catalog.list_tables()))


@query("SELECT count(*) AS n, true AS rows_held, true AS bytes_held FROM orders")
def write_limits(t):
    """``max_row_per_file`` and ``max_bytes_per_file``."""
    by_rows = write(t.orders, scratch_path(t.spark, "table"), options={"max_row_per_file": 1000})
    by_bytes = write(t.orders, scratch_path(t.spark, "table"), options={"max_bytes_per_file": 40_000})
    rows_held = max(f.rows for f in by_rows.manifest().fragments) <= 1000
    bytes_held = max(f.bytes for f in by_bytes.manifest().fragments) <= 40_000 and by_bytes.count() == by_rows.count()
    return by_bytes.df().agg(F.count(F.lit(1)).alias("n")).withColumns({"rows_held": F.lit(rows_held), "bytes_held": F.lit(bytes_held)})


@query("SELECT * FROM (VALUES ('a'), ('a.b'), ('c')) v(namespace)")
def catalog_namespaces(t):
    """CREATE, DROP, SHOW, DESCRIBE; a namespace that has something is dropped with CASCADE alone; ALTER raises."""
    engine = _engine(t)
    for name in ("a", "a.b", "c", "gone"):
        engine.sql(f"CREATE NAMESPACE {name} WITH PROPERTIES ('owner' = 'me')")
    engine.sql("CREATE TABLE gone.t (id INT)")
    ok = _raises(NamespaceNotEmpty, lambda: engine.sql("DROP NAMESPACE gone"))
    engine.sql("DROP NAMESPACE gone CASCADE")
    ok &= _raises(Unsupported, lambda: engine.sql("ALTER NAMESPACE a SET PROPERTIES ('x' = 'y')"))
    ok &= ("owner", "me") in [tuple(r) for r in engine.sql("DESCRIBE NAMESPACE c").collect()] and not engine.catalog.namespace_exists("gone")
    return engine.sql("SHOW NAMESPACES").union(engine.sql("SHOW NAMESPACES IN a")).where(F.lit(ok))


@query("SELECT * FROM (VALUES ('one'), ('three')) v(\"tableName\")")
def catalog_tables(t):
    """CREATE, DROP, PURGE, SHOW, DESCRIBE, USE; renaming and altering raise."""
    engine = _engine(t)
    engine.sql("CREATE NAMESPACE ns")
    engine.sql("USE ns")
    for name in ("one", "two", "three", "four"):
        engine.sql(f"CREATE TABLE {name} (id INT, name STRING)")
    where = engine.catalog.location("ns.four")
    engine.sql("DROP TABLE two")
    engine.sql("DROP TABLE four PURGE")
    ok = not Table(t.spark, where).log.exists() and engine.catalog.table_exists("ns.one") and not engine.catalog.table_exists("ns.two")
    ok &= _raises(Unsupported, lambda: engine.sql("ALTER TABLE one RENAME TO five")) and _raises(NoSuchTable, lambda: engine.sql("DROP TABLE two"))
    ok &= [r.data_type for r in engine.sql("DESCRIBE TABLE one").collect()] == ["int", "string"] and engine.catalog.functions() == ["fragment_or_rand"]
    return engine.sql("SHOW TABLES").select("tableName").where(F.lit(ok))


@query("SELECT true AS conflict, true AS rebased, count(*) AS n FROM nation WHERE n_nationkey NOT IN (0, 1, 24)")
def commit_conflicts(t):
    """Of two changes of one snapshot, one to the same fragment is a conflict and one to another is made again."""
    table = _copy(t, t.nation, 5, "n_nationkey")
    base = table.manifest()
    first, last = base.fragments[0].id, base.fragments[-1].id

    def deletion(where):
        return dml.write_deletions(table, table.df(version=base.version, metadata=True, where=where).select("_rowaddr"))

    lost, other = deletion("n_nationkey = 0"), deletion("n_nationkey = 24")
    dml.delete(table, "n_nationkey IN (0, 1)")
    conflict = _raises(CommitConflict, lambda: table.log.publish(base, lambda m: dml.without(m, *lost), frozenset(lost[1])))
    made = table.log.publish(base, lambda m: dml.without(m, *other), frozenset(other[1]))
    return _one(t, conflict=conflict and set(lost[1]) == {first}, rebased=made.version == base.version + 2 and set(other[1]) == {last}, n=table.df().count())


@query(r"""SELECT doc_id, list_filter(string_split_regex(replace(lower(text), 'é', 'e'), '\s+'), lambda x: length(x) BETWEEN 1 AND 6) AS plain,
 list_filter(string_split_regex(text, '[^\p{L}\p{N}]+'), lambda x: length(x) BETWEEN 1 AND 40 AND x NOT IN ('the', 'of', 'and')) AS bare
 FROM (SELECT doc_id, regexp_replace(left(text, 200), '[^a-zA-Z é.,]', ' ', 'g') AS text FROM documents WHERE text IS NOT NULL)""")
def fts_options(t):
    """Tokenizers and filters of text indexes."""
    text = F.regexp_replace(F.left("text", F.lit(200)), "[^a-zA-Z é.,]", " ")
    plain = indexes.tokens(F.col("t"), indexes.fts_options({"base_tokenizer": "whitespace", "ascii_folding": True, "max_token_length": 6}))
    bare = F.filter(indexes.tokens(F.col("t"), indexes.fts_options({"lower_case": False})), lambda x: ~x.isin("the", "of", "and"))
    return t.documents.where("text is not null").select("doc_id", text.alias("t")).select("doc_id", plain.alias("plain"), bare.alias("bare"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN 'inserted' ELSE 'updated' END AS kind FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey % 10 = 0")
def cdf_patterns(t):
    """Inserted and updated rows since a version, and both together within a range of versions."""
    table = _copy(t, t.orders.where("o_orderkey % 2 = 0"), properties={"enable_stable_row_ids": "true"})
    base = table.manifest().version
    table.append(t.orders.where("o_orderkey % 2 = 1"))
    until = dml.update(table, {"o_totalprice": "o_totalprice + 1"}, "o_orderkey % 10 = 0").version
    dml.update(table, {"o_totalprice": "0"}, "o_orderkey % 4 = 0")
    inserted = cdf.inserted_since(table, base).select("o_orderkey", F.lit("inserted").alias("kind"))
    both = cdf.changes_between(table, base, until).select("o_orderkey")
    updated = cdf.updated_since(table, base).select("o_orderkey", F.lit("updated").alias("kind"))
    return inserted.union(updated.join(both, "o_orderkey", "left_semi"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0")
def format_source(t):
    """``spark.read.format`` over a table with deletions."""
    register(t.spark)
    table = _copy(t, t.orders.select("o_orderkey", "o_totalprice"), 4)
    dml.delete(table, "o_orderkey % 3 = 0")
    return t.spark.read.format("tessera").option("path", table.root).load()


@query("SELECT * FROM (VALUES (1::BIGINT, 'create', 0::BIGINT, 0), (2, 'append', 25, 2), (3, 'delete', 20, 2), (4, 'update', 20, 3)) v(version, operation, rows, fragments)")
def table_versions(t):
    """Versions, with rows and fragments as the manifests count them."""
    table = _copy(t, t.nation, 2, "n_nationkey")
    dml.delete(table, "n_nationkey >= 20")
    dml.update(table, {"n_name": "'x'"}, "n_nationkey = 0")
    return table.versions().select("version", "operation", "rows", "fragments")


@query("SELECT time_bucket(INTERVAL 1 hour, ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_run(t):
    """A stream over the events' file, run to its end; windows in complete mode."""
    schema = t.events.schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    out = windows.tumbling(stream, "ts", "1 hour", ["event_type"])
    folder, kept = scratch_path(t.spark, "stream"), scratch_path(t.spark, "stream")

    def save(rows, _):
        rows.write.mode("overwrite").parquet(kept)

    run = out.writeStream.outputMode("complete").option("checkpointLocation", folder).trigger(availableNow=True).foreachBatch(save).start()
    run.awaitTermination()
    return t.spark.read.parquet(kept).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")
