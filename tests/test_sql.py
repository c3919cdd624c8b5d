from decimal import Decimal

import pytest

from tessera.errors import InvalidArgument, NamespaceAlreadyExists, NamespaceNotEmpty, NoSuchNamespace, NoSuchTable, ParseError, TableAlreadyExists, Unsupported
from tessera.plans.sql import Engine
from tessera.sources.catalog import Catalog


@pytest.fixture
def engine(spark, tmp_path):
    return Engine(spark, Catalog(spark, f"file://{tmp_path}/catalog", name="cat"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_namespaces(engine):
    engine.sql("CREATE NAMESPACE a WITH PROPERTIES ('owner' = 'me')")
    engine.sql("CREATE NAMESPACE a.b")
    with pytest.raises(NamespaceAlreadyExists):
        engine.sql("CREATE NAMESPACE a")
    engine.sql("CREATE NAMESPACE IF NOT EXISTS a")
    assert rows(engine.sql("SHOW NAMESPACES")) == [("a",)] and rows(engine.sql("SHOW NAMESPACES IN a")) == [("a.b",)]
    assert rows(engine.sql("SHOW NAMESPACES LIKE 'z*'")) == []
    assert ("owner", "me") in rows(engine.sql("DESCRIBE NAMESPACE a"))
    with pytest.raises(NamespaceNotEmpty):
        engine.sql("DROP NAMESPACE a")
    engine.sql("DROP NAMESPACE a CASCADE")
    with pytest.raises(NoSuchNamespace):
        engine.sql("DROP NAMESPACE a")
    with pytest.raises(NoSuchNamespace):
        engine.sql("CREATE TABLE gone.t (id INT)")
    engine.sql("DROP NAMESPACE IF EXISTS a")
    with pytest.raises(Unsupported):
        engine.sql("ALTER NAMESPACE a SET PROPERTIES ('x' = 'y')")


def test_single_level(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/one", single_level=True)
    assert c.list_namespaces() == ["default"] and c.namespace_exists("default")
    c.create_table("t", "id int")
    assert c.table_exists("default.t") and c.list_tables("default") == ["t"]


def test_tables(engine, spark, tmp_path):
    engine.sql("CREATE TABLE t (id INT NOT NULL, name STRING, v ARRAY<FLOAT>) USING tessera PARTITIONED BY (id) TBLPROPERTIES ('v.arrow.fixed-size-list.size' = '2')")
    with pytest.raises(TableAlreadyExists):
        engine.sql("CREATE TABLE t (id INT)")
    engine.sql("CREATE TABLE IF NOT EXISTS t (id INT)")
    engine.sql("INSERT INTO t (id, name) VALUES (1, 'a, b'), (2, 'it''s')")
    assert rows(engine.sql("SELECT id, name FROM t")) == [(1, "a, b"), (2, "it's")]
    assert rows(engine.sql("SELECT id FROM cat.t WHERE t.name LIKE 'a%'")) == [(1,)]
    assert ("id", "int", None) in [tuple(r) for r in engine.sql("DESCRIBE TABLE t").collect()]
    assert engine.sql("DESCRIBE EXTENDED t").count() > engine.sql("DESCRIBE t").count()
    assert [r.tableName for r in engine.sql("SHOW TABLES").collect()] == ["t"]
    where = engine.catalog.location("t")
    engine.sql("DROP TABLE t")
    with pytest.raises(NoSuchTable):
        engine.sql("DROP TABLE t")
    engine.sql("DROP TABLE IF EXISTS t")
    assert rows(engine.sql(f"SELECT count(*) FROM `{where}`")) == [(2,)]
    engine.sql(f"CREATE TABLE other LOCATION '{where}'")
    engine.sql(f"CREATE TABLE third (ignored INT) LOCATION '{where}'")
    engine.sql("DROP TABLE third")
    assert rows(engine.sql("SELECT id FROM other")) == [(1,), (2,)]
    with pytest.raises(NoSuchTable):
        engine.sql(f"CREATE TABLE fourth LOCATION 'file://{tmp_path}/nothing'")
    engine.sql("DROP TABLE other PURGE")
    with pytest.raises(NoSuchTable):
        engine.sql(f"DROP TABLE `{where}`")
    with pytest.raises(Unsupported):
        engine.catalog.rename_table("a", "b")


def test_ctas_and_replace(engine):
    engine.sql("CREATE TABLE t AS SELECT 1 AS id, 'x' AS name")
    engine.sql("CREATE OR REPLACE TABLE t AS SELECT 2.5D AS v")
    assert rows(engine.sql("SELECT * FROM t")) == [(2.5,)]
    engine.sql("REPLACE TABLE t (k INT)")
    assert engine.sql("SELECT * FROM t").columns == ["k"] and rows(engine.sql("SELECT COUNT(*) FROM t")) == [(0,)]
    with pytest.raises(NoSuchTable):
        engine.sql("REPLACE TABLE missing AS SELECT 1 AS x")
    engine.sql("INSERT OVERWRITE t SELECT 7")
    assert rows(engine.sql("SELECT k FROM t")) == [(7,)]


def test_row_level(engine, spark):
    engine.sql("CREATE TABLE t AS SELECT * FROM VALUES (1, 'a', 10), (2, 'b', 20), (3, 'c', 30) AS v(id, name, value)")
    engine.sql("UPDATE t AS x SET value = x.value + 1, name = concat(x.name, ', =') WHERE x.id = 2 OR t.id = 3")
    assert rows(engine.sql("SELECT * FROM t")) == [(1, "a", 10), (2, "b, =", 21), (3, "c, =", 31)]
    engine.sql("DELETE FROM t WHERE id IN (1, 3)")
    assert rows(engine.sql("SELECT id FROM t")) == [(2,)]
    engine.sql("MERGE INTO t USING (SELECT 2 AS id, 'z' AS name, 5 AS value UNION ALL SELECT 8, 'n', 1) AS s ON t.id = s.id WHEN MATCHED THEN UPDATE SET name = s.name WHEN NOT MATCHED AND s.value > 0 THEN INSERT (id, name) VALUES (s.id, upper(s.name))")
    assert rows(engine.sql("SELECT id, name FROM t")) == [(2, "z"), (8, "N")]
    engine.sql("MERGE INTO t USING (SELECT 8 AS id) s ON t.id = s.id WHEN MATCHED THEN DELETE")
    assert rows(engine.sql("SELECT id FROM t")) == [(2,)]
    assert rows(engine.sql("SELECT id FROM t VERSION AS OF 2")) == [(1,), (2,), (3,)]
    us = engine.catalog.table("t").manifest(2).time_us
    assert engine.sql(f"SELECT id FROM t TIMESTAMP AS OF {us} AS old JOIN t USING (id)").count() == 1
    engine.sql("DELETE FROM t")
    assert rows(engine.sql("SELECT count(*) FROM t")) == [(0,)]


def test_columns_indexes_maintenance(engine, spark):
    engine.sql("CREATE TABLE t AS SELECT id, concat('w', id) AS text FROM range(10)")
    engine.sql("SELECT _rowaddr, _fragid, id * 2 AS twice FROM t WHERE id < 5").createOrReplaceTempView("extra")
    engine.sql("ALTER TABLE t ADD COLUMNS twice FROM extra")
    assert rows(engine.sql("SELECT sum(twice) FROM t")) == [(20,)]
    engine.sql("ALTER TABLE t UPDATE COLUMNS twice FROM (SELECT _rowaddr, _fragid, cast(null as bigint) AS twice FROM t WHERE id = 4)")
    assert rows(engine.sql("SELECT count(twice) FROM t")) == [(4,)]
    assert engine.sql("ALTER TABLE t CREATE INDEX words USING fts (text) WITH (lower_case = true)").first().index_name == "words"
    assert engine.sql("SHOW INDEX IN t").count() == 1
    engine.sql("INSERT INTO t VALUES (99, 'late', 0)")
    assert engine.sql("OPTIMIZE t WITH (target_rows_per_fragment = 1000)").first().fragments_added == 1
    assert engine.sql("VACUUM t WITH (before_version = 1000000, delete_unverified = true)").first().bytes_removed > 0
    assert rows(engine.sql("SELECT count(*) FROM t WHERE id >= 0")) == [(11,)]


@pytest.mark.parametrize("text", ["OPTIMIZE", "OPTIMIZE t #", "VACUUM t WITH", "ALTER TABLE t CREATE INDEX i USING btree", "MERGE INTO t USING s WHEN MATCHED THEN DELETE", ""])
def test_bad_statements_raise(engine, text):
    engine.sql("CREATE TABLE IF NOT EXISTS t AS SELECT 1 AS id")
    with pytest.raises((ParseError, InvalidArgument)):
        engine.sql(text)


def test_use_and_joins(engine, spark):
    engine.sql("CREATE NAMESPACE ns")
    engine.sql("CREATE TABLE ns.a AS SELECT id, id % 3 AS k FROM range(9)")
    engine.sql("USE ns")
    engine.sql("CREATE TABLE b AS SELECT id AS k, concat('n', id) AS name FROM range(3)")
    assert rows(engine.sql("SELECT b.name, count(*) FROM a JOIN b ON a.k = b.k GROUP BY b.name")) == [("n0", 3), ("n1", 3), ("n2", 3)]
    assert rows(engine.sql("WITH c AS (SELECT * FROM a WHERE id > 5) SELECT count(*) FROM c")) == [(3,)]
    assert rows(engine.sql("SELECT 'FROM a' AS s FROM b WHERE k = 0")) == [("FROM a",)]


def test_connect_and_parent(spark, tmp_path):
    import tessera

    root = f"file://{tmp_path}/c"
    engine = tessera.connect(spark, root, parent="x/y", parent_delimiter="/", defaults={"enable_stable_row_ids": "true"})
    engine.sql("CREATE TABLE t AS SELECT 1 AS id")
    table = engine.catalog.table("t")
    assert "/c/x/y/" in table.root and table.manifest().stable_row_ids
    assert rows(engine.sql("SELECT id FROM t FOR VERSION AS OF 2")) == [(1,)]
    tessera.write(spark.range(3), f"{root}/p", max_row_per_file=1)
    assert tessera.read(spark, f"{root}/p", where="id > 0").count() == 2
    bare = tessera.connect(spark)
    assert rows(bare.sql(f"SELECT count(*) FROM `{root}/p` AS q WHERE q.id < 2")) == [(2,)]


def test_text_that_looks_like_sql(engine):
    engine.sql("CREATE TABLE d AS SELECT * FROM VALUES (1, 't.x'), (2, 'x'), (3, 'd.x'), (4, 'it''s') AS v(id, name) /* FROM nowhere; */")
    engine.sql("DELETE FROM d WHERE name = 'd.x'")
    assert rows(engine.sql("SELECT name FROM d")) == [("it's",), ("t.x",), ("x",)]
    engine.sql(r"UPDATE d SET name = 'a\', d.name = WHERE' WHERE d.id = 2")
    assert rows(engine.sql("SELECT name FROM d WHERE id = 2")) == [("a', d.name = WHERE",)]
    engine.sql("MERGE INTO d USING (SELECT 4 AS id, 'WHEN MATCHED THEN DELETE' AS name WHERE 4 IN (1, 4)) AS s ON d.id = s.id AND s.name <> 'ON (' WHEN MATCHED THEN UPDATE SET name = s.name")
    assert rows(engine.sql("SELECT name FROM d WHERE id = 4")) == [("WHEN MATCHED THEN DELETE",)]


def test_nested_columns(engine):
    engine.sql("CREATE TABLE n (id INT, at STRUCT<city: STRING, country: STRING>, m MAP<STRING, INT>, p DECIMAL(10, 2))")
    engine.sql("INSERT INTO n VALUES (1, named_struct('city', 'a', 'country', 'b'), map('k', 1), 2.5)")
    engine.sql("UPDATE n AS x SET x.at.city = concat(x.at.city, n.at.country) WHERE x.id = 1")
    assert rows(engine.sql("SELECT at.city, m['k'], p FROM n")) == [("ab", 1, Decimal("2.50"))]
    with pytest.raises(ParseError):
        engine.sql("CREATE TABLE bad (id INT, STRUCT<a>)")


@pytest.mark.parametrize("text, joined", [("SELECT id FROM t", False), ("SELECT count(*) FROM t WHERE id > 1", False), ("SELECT * FROM t", True), ("SELECT id FROM t WHERE twice > 1", True), ("SELECT id FROM t ORDER BY `twice`", True)])
def test_columns_beside_fragments_are_joined_if_named(engine, text, joined):
    engine.sql("CREATE TABLE t AS SELECT id FROM range(10)")
    engine.sql("ALTER TABLE t ADD COLUMNS twice FROM (SELECT _rowaddr, _fragid, id * 2 AS twice FROM t)")
    plan = engine.sql(text)._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join" in plan) == joined
    assert engine.sql(text).count() >= 0
