import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.errors import CommitConflict, InvalidArgument, NoSuchTable, NoSuchVersion, TableAlreadyExists, Unsupported
from tessera.functions.kinds import apply_properties
from tessera.operators import backfill, dml, indexes, maintenance
from tessera.operators.joins import fragment_join
from tessera.operators.vector import nearest
from tessera.plans.prune import fragments_of
from tessera.sources.table import HIDDEN, Table, write
from tessera.streaming import cdf


def four_longs(spark, path):
    """Two fragments of two rows."""
    rows = spark.createDataFrame([(0, 0, 0, 0), (1, 2, 3, -1)], "x long, y long, b long, c long").coalesce(1)
    table = Table.create(spark, path, rows.schema)
    table.append(rows)
    table.append(spark.createDataFrame([(2, 4, 6, -2), (3, 6, 9, -3)], rows.schema).coalesce(1))
    return table


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_addresses_and_hidden_columns(spark, path):
    table = four_longs(spark, path)
    assert table.df().columns == ["x", "y", "b", "c"]
    rows = table.df(metadata=True).orderBy("x").collect()
    assert [r._rowaddr for r in rows] == [0, 1, 1 << 32, (1 << 32) + 1]
    assert [r._rowid for r in rows] == [r._rowaddr for r in rows]
    assert [r._fragid for r in rows] == [0, 0, 1, 1]
    assert [r._row_created_at_version for r in rows] == [2, 2, 3, 3]


def test_bare_scan_has_no_join(spark, path):
    plan = four_longs(spark, path).df(where="x > 1", columns=["x"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PushedFilters: [IsNotNull(x), GreaterThan(x,1)]" in plan and "ReadSchema: struct<x:bigint>" in plan


def test_count_subtracts_deletions(spark, path):
    table = four_longs(spark, path)
    dml.delete(table, "x = 1")
    assert table.count() == 3 == table.df().count()
    assert table.statistics()["fragments"] == 2


def test_write_modes(spark, path):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(NoSuchTable):
        write(df, path, "append")
    write(df, path)
    with pytest.raises(TableAlreadyExists):
        write(df, path)
    write(df, path, "append")
    assert write(df, path, "overwrite").count() == 1
    other = spark.createDataFrame([(1.5,)], "v double")
    assert write(other, path, "create_or_replace").df().columns == ["v"]
    assert write(df, path, "ignore").df().columns == ["v"]
    assert Table.open(spark, path).df(version=2).columns == ["id", "name"]
    with pytest.raises(InvalidArgument):
        Table.open(spark, path).append(df)
    with pytest.raises(InvalidArgument):
        write(df, path, "append", options={"batch_size": 0})


def test_empty_tasks_and_row_bound(spark, path):
    df = spark.createDataFrame([(1,), (2,)], "id int").repartition(4)
    assert len(write(df, path).manifest().fragments) <= 2
    many = spark.range(10).selectExpr("cast(id as int) id").coalesce(1)
    assert len(write(many, path, "overwrite", options={"max_row_per_file": 3}).manifest().fragments) == 4


def test_not_null_and_vector_length(spark, path):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.ArrayType(T.FloatType()))])
    table = Table.create(spark, path, schema, {"v.arrow.fixed-size-list.size": "2"})
    table.append(spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<float>"))
    with pytest.raises(Exception, match="must have 2 elements"):
        table.append(spark.createDataFrame([(3, [1.0])], "id int, v array<float>"))
    with pytest.raises(Exception, match="must not be null"):
        table.append(spark.createDataFrame([(None, [1.0, 2.0])], "id int, v array<float>"))
    assert table.count() == 2


@pytest.mark.parametrize("column, key", [("s", "s.arrow.fixed-size-list.size"), ("s", "s.tessera.encoding"), ("v", "v.arrow.large_var_char")])
def test_kind_errors(column, key):
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("v", T.ArrayType(T.StringType()))])
    with pytest.raises(InvalidArgument):
        apply_properties(schema, {key: {"s.tessera.encoding": "blob", "v.arrow.large_var_char": "true"}.get(key, "4")})
    with pytest.raises(InvalidArgument):
        apply_properties(schema, {"v.arrow.fixed-size-list.size": "4"})


def test_types_round_trip(spark, path):
    df = spark.sql("""SELECT 1Y b, 2S s, 3 i, 4L l, 1.5F f, 2.5D d, 1.25BD dec, 'x' str, X'01' bin, true t, DATE '1960-01-01' day, TIMESTAMP '2020-01-01 00:00:00' ts,
        TIMESTAMP_NTZ '2020-01-01 00:00:00' ntz, INTERVAL '1' DAY dt, INTERVAL '2' MONTH ym, array(1, null) a, named_struct('p', named_struct('q', 1)) st, map('k', 1) m, cast(null as struct<z:int>) n""")
    text = lambda x: x.withColumn("ym", F.col("ym").cast("string"))  # noqa: E731  Python has no such value
    assert values(text(write(df, path).df())) == values(text(df))
    assert dict(Table.open(spark, path).df().dtypes) == dict(df.dtypes)


def test_time_travel(spark, path):
    table = four_longs(spark, path)
    assert table.df(version=1).count() == 0 and table.df(version=2).count() == 2
    then = table.manifest(2).time_us
    assert table.df(timestamp=then).count() == 2
    with pytest.raises(NoSuchVersion):
        table.df(version=99)
    with pytest.raises(NoSuchVersion):
        table.df(timestamp=0)
    assert table.versions().count() == 3


def test_delete_removes_empty_fragments(spark, path):
    table = four_longs(spark, path)
    dml.delete(table, "x < 2")
    assert [f.id for f in table.manifest().fragments] == [1]
    before = table.manifest().version
    dml.delete(table, "x = 77")
    assert table.manifest().version == before
    dml.delete(table)
    assert table.count() == 0 == table.df().count()
    assert values(table.df(version=3)) == values(table.df(version=3))


def test_delete_null_condition_keeps_rows(spark, path):
    table = write(spark.createDataFrame([(1, None), (2, 5)], "id int, v int"), path)
    dml.delete(table, "v > 1")
    assert values(table.df()) == [(1, None)]


def test_update_keeps_creation_and_row_id(spark, path):
    rows = spark.range(6).selectExpr("cast(id as int) id", "'n' name", "1 value").coalesce(1)
    table = write(rows, path, properties={"enable_stable_row_ids": "true"})
    before = {r.id: r._rowid for r in table.df(metadata=True).collect()}
    dml.update(table, {"value": "value + id"}, "id >= 4")
    after = {r.id: r for r in table.df(metadata=True).collect()}
    assert {i: r._rowid for i, r in after.items()} == before
    assert after[5].value == 6 and after[5]._row_created_at_version == 2 and after[5]._row_last_updated_at_version == 3
    assert after[0]._row_last_updated_at_version == 2
    assert values(cdf.changes_since(table, 2).select("id")) == [(4,), (5,)]
    assert cdf.inserted_since(table, 2).count() == 0 and cdf.updated_since(table, 2).count() == 2


def test_merge(spark, path):
    table = write(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string"), path)
    source = spark.createDataFrame([(1, "x"), (2, "y"), (9, "z"), (None, "w")], "id int, name string")
    dml.merge(table, source, "t.id = s.id", [dml.When(True, "delete", None, "t.name = 'a'"), dml.When(True, "update", {"name": "concat(t.name, s.name)"}), dml.When(False, "insert")])
    assert values(table.df()) == [(2, "by"), (3, None), (9, "z"), (None, "w")]
    assert table.manifest().version == 3
    twice = spark.createDataFrame([(2, "p"), (2, "q")], "id int, name string")
    with pytest.raises(InvalidArgument):
        dml.merge(table, twice, "t.id = s.id", [dml.When(True, "update", {"name": "s.name"})])


def test_conflicts(spark, path):
    table = four_longs(spark, path)
    base = table.manifest()
    path_of, counts = dml.write_deletions(table, table.df(metadata=True, where="x = 0").select("_rowaddr"))
    dml.delete(table, "x = 1")
    with pytest.raises(CommitConflict):
        table.log.publish(base, lambda m: dml.without(m, path_of, counts), frozenset(counts))
    table.log.publish(base, lambda m: m, frozenset({1}))  # another fragment: made again on the newer version
    with pytest.raises(CommitConflict):
        table.log.publish(base, lambda m: m, rebase=False)


def test_backfill(spark, path):
    table = four_longs(spark, path)
    rows = table.df(metadata=True)
    addresses = values(rows.select("x", "_rowaddr"))
    with pytest.raises(InvalidArgument):
        backfill.add_columns(table, ["y"], rows)
    with pytest.raises(InvalidArgument):
        backfill.add_columns(table, ["z"], spark.range(1))
    assert backfill.add_columns(table, ["z"], rows.where("false").withColumn("z", F.lit(1))).version == 3
    backfill.add_columns(table, ["z"], rows.where("x > 1").select("_rowaddr", "_fragid", (F.col("x") * 10).alias("z"), F.lit(1).alias("unused")))
    assert values(table.df().select("x", "z")) == [(0, None), (1, None), (2, 20), (3, 30)]
    backfill.update_columns(table, ["z"], table.df(metadata=True).where("x >= 2").select("_rowaddr", "_fragid", F.when(F.col("x") == 2, 7).alias("z")))
    assert values(table.df().select("x", "z")) == [(0, None), (1, None), (2, 7), (3, None)]
    with pytest.raises(InvalidArgument):
        backfill.update_columns(table, ["none"], rows)
    assert values(table.df(metadata=True).select("x", "_rowaddr")) == addresses
    table.append(spark.createDataFrame([(9, 1)], "x long, z long"))
    dml.update(table, {"z": "z + 1"}, "x = 9 OR x = 2")
    maintenance.optimize(table)
    assert values(table.df().select("x", "z")) == [(0, None), (1, None), (2, 8), (3, None), (9, 2)]
    assert not table.manifest().sides


@pytest.mark.parametrize("target, expected", [(None, (10, 1, 10, 1)), (5, (10, 2, 10, 2)), (1, (0, 0, 0, 0))])
def test_optimize(spark, path, target, expected):
    table = write(spark.range(10).repartitionByRange(10, "id"), path, options={"max_row_per_file": 1})
    assert len(table.manifest().fragments) == 10
    options = {} if target is None else {"target_rows_per_fragment": target}
    assert tuple(maintenance.optimize(table, options).first()) == expected
    assert values(table.df()) == [(i,) for i in range(10)]
    with pytest.raises(InvalidArgument):
        maintenance.optimize(table, {"speed": 1})


def test_optimize_keeps_versions_and_materialises(spark, path):
    table = write(spark.range(100).repartition(2), path)
    dml.delete(table, "id < 20")
    before = values(table.df(metadata=True).select("id", "_row_created_at_version", "_row_last_updated_at_version"))
    maintenance.optimize(table, {"materialize_deletions": True})
    m = table.manifest()
    assert m.row_count == 80 == sum(f.rows for f in m.fragments) and not m.deletions
    assert values(table.df(metadata=True).select("id", "_row_created_at_version", "_row_last_updated_at_version")) == before
    empty = Table.create(spark, f"{path}-empty", "id long")
    assert tuple(maintenance.optimize(empty).first()) == (0, 0, 0, 0)


def test_vacuum(spark, path):
    table = four_longs(spark, path)
    dml.delete(table, "x = 0")
    now = values(table.df())
    out = maintenance.vacuum(table, {"before_version": 1_000_000}).first()
    assert out.bytes_removed > 0 and out.old_versions == 3
    assert values(table.df()) == now and table.log.versions() == [4]
    with pytest.raises(NoSuchVersion):
        table.df(version=2)
    again = maintenance.vacuum(table, {"before_version": 1_000_000}).first()
    assert again.old_versions == 0 and values(table.df()) == now


def test_indexes(spark, path):
    table = write(spark.range(1000).selectExpr("id", "concat('word', id % 7, ' The end') t").repartitionByRange(4, "id"), path)
    assert tuple(indexes.create_index(table, "k", "btree", ["id"], {"zone_size": 50}).first()) == (4, "k")
    found = indexes.lookup(table, "id", 10, 12)
    assert values(found.select("id")) == [(10,), (11,), (12,)] and len(found.inputFiles()) == 1
    table.append(spark.createDataFrame([(11, "late word1")], "id long, t string"))
    assert indexes.lookup(table, "id", 11, 11).count() == 2
    indexes.create_index(table, "t", "fts", ["t"], {"remove_stop_words": True, "with_position": True})
    table.append(spark.createDataFrame([(5000, "WORD3 at last")], "id long, t string"))
    assert indexes.search(table, "t", "word3").count() == len([i for i in range(1000) if i % 7 == 3]) + 1
    assert indexes.search(table, "t", "word3 last", every=True).count() == 1
    with pytest.raises(Unsupported):
        indexes.create_index(table, "z", "ivf", ["id"])
    with pytest.raises(Unsupported):
        indexes.create_index(table, "z", "fts", ["t"], {"stem": True})
    shown = {r.name: r for r in indexes.show_indexes(table).collect()}
    assert shown["k"].num_unindexed_fragments == 2 and shown["t"].num_unindexed_rows == 1
    indexes.create_index(table, "k", "btree", ["id"])
    assert {r.name: r for r in indexes.show_indexes(table).collect()}["k"].num_unindexed_fragments == 0
    indexes.drop_index(table, "k")
    assert indexes.show_indexes(table).count() == 1
    empty = Table.create(spark, f"{path}-empty", "id long")
    assert indexes.create_index(empty, "k", "btree", ["id"]).first().fragments_indexed == 0


def test_blobs(spark, path):
    data = spark.createDataFrame([(1, bytearray(b"x" * 1000)), (2, None), (3, bytearray(b""))], "id int, data binary")
    table = write(data, path, properties={"data.tessera.encoding": "blob"})
    rows = {r.id: r for r in table.df(metadata=True).collect()}
    assert bytes(rows[1].data) == b"" and rows[1].data__blob_size == 1000 and rows[2].data is None and rows[2].data__blob_size is None
    dml.update(table, {"id": "id + 10"}, "id = 1")
    assert {r.data__blob_size for r in table.df(metadata=True).where("id = 11").collect()} == {1000}
    assert bytes(table.blobs("data").where("data is not null and length(data) > 0").first().data) == b"x" * 1000


def test_nearest(spark, path):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(20)] + [(99, None), (98, [1.0])], "id int, v array<float>")
    request = {"column": "v", "key": [4.2, 0.0], "k": 3, "minimumNprobes": 2, "useIndex": True}
    assert [r.id for r in nearest(df, request).collect()] == [4, 5, 3]
    assert [r.id for r in write(df, path).df(options={"nearest": json.dumps(request)}).collect()] == [4, 5, 3]
    with pytest.raises(InvalidArgument):
        nearest(df, {"column": "none", "key": [1.0]})


@pytest.mark.parametrize(
    "text, expected",
    [
        ("_rowaddr = 4294967296", {1}),
        ("4294967297 = _rowaddr", {1}),
        ("_rowaddr <=> 0", {0}),
        ("_rowaddr IN (0, 8589934592)", {0, 2}),
        ("_rowaddr = 0 AND x > 3", {0}),
        ("_rowaddr = 0 AND _rowaddr = 4294967296", set()),
        ("_rowaddr = 0 OR _rowaddr = 4294967296", {0, 1}),
        ("_rowaddr = 0 OR x = 1", None),
        ("NOT _rowaddr = 0", None),
        ("_rowaddr > 5", None),
        ("_rowaddr BETWEEN 0 AND 5", None),
        ("(_rowaddr = 0 OR _rowaddr IN (1)) AND (x = 1 OR y = 2)", {0}),
        ("x = 'a AND _rowaddr = 0'", None),
        ("t._rowaddr = 0", {0}),
        ("_rowaddr = 0 + 1", None),
        ("x BETWEEN 1 AND 2 AND _rowaddr = 0", {0}),
        ("(x + 1) * 2 = 4 AND _rowaddr = 0", {0}),
        ("_rowaddr NOT IN (0)", None),
        ("CASE WHEN x >= 0 AND _rowaddr = 0 AND x < 99 THEN true ELSE true END", None),
        (r"x = 'a\' AND _rowaddr = 0 AND y = \'b'", None),
        ('_rowaddr = 0 AND x = "a"', None),
        ("_rowaddr = 0 AND exists(a, v -> v = 1)", None),
    ],
)
def test_row_address_analysis(text, expected):
    assert fragments_of(text) == expected


def test_pruned_scan(spark, path):
    table = four_longs(spark, path)
    found = table.df(metadata=True, where="_rowaddr = 4294967296")
    assert [r.x for r in found.collect()] == [2] and len(found.inputFiles()) == 1
    assert table.df(metadata=True, where="_rowaddr = 0 AND _rowaddr = 4294967296").count() == 0
    assert set(HIDDEN) <= set(table.df(metadata=True, where="_rowaddr = 0 AND _rowaddr = 4294967296").columns)


def test_zone_maps_prune_conditions(spark, path):
    """Only comparisons that hold for every row of the answer rule fragments out, and only as the index still knows them."""
    table = write(spark.range(100).selectExpr("id", "cast(id as string) s", "named_struct('id', id + 1000) meta").repartitionByRange(5, "id"), path)
    indexes.create_index(table, "k", "btree", ["id", "s"], {"zone_size": 8})
    files = lambda where: len(table.df(where=where).inputFiles())
    for where, most in (("id = 7", 1), ("id BETWEEN 3 AND 9 AND s <> 'x'", 1), ("70 < id", 3), ("id = 7 OR id = 90", 5), ("meta.id = 1007", 5), ("s = 7", 5), ("s = '7'", 5), ("NOT id = 7", 5), ("id >= 20 AND id < 10", 0)):
        rows = table.df(where=where)
        assert values(rows.select("id")) == values(table.df().where(where).select("id")), where
        assert (files(where) if most else rows.count()) <= most, where
    backfill.update_columns(table, ["id"], table.df(metadata=True).where("id = 99").select("_rowaddr", "_fragid", F.lit(7).cast("long").alias("id")))
    assert table.df(where="id = 7").count() == 2


def test_deletions_of_other_fragments_are_not_broadcast(spark, path):
    table = write(spark.range(1000).repartitionByRange(4, "id"), path)
    dml.delete(table, "id % 2 = 0")
    last = table.manifest().fragments[-1].id
    rows = table.df(fragments=[last])
    assert "isnotnull(_rowaddr" in rows._jdf.queryExecution().optimizedPlan().toString().lower() and f"= {last})" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == 125


def test_failed_statements_leave_nothing(spark, path):
    bad = spark.range(5).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        write(bad, path)
    assert not Table(spark, path).log.exists()
    table = write(spark.range(5), f"{path}-2")
    dml.merge(table, spark.range(3, 8), "t.id = s.id", [dml.When(True, "delete"), dml.When(False, "insert")])
    with pytest.raises(InvalidArgument):
        dml.merge(table, spark.createDataFrame([(5,), (5,)], "id long"), "t.id = s.id", [dml.When(True, "delete")])
    assert values(table.df()) == [(0,), (1,), (2,), (5,), (6,), (7,)]
    left = [n for n, _, folder, _ in table.files.list(f"{table.root}/_staging") for x, *_ in table.files.list(f"{table.root}/_staging/{n}") if folder and not x.endswith(".crc") and x != "_SUCCESS"]
    assert not left


def test_fragment_join(spark, path):
    rows = four_longs(spark, path).df(metadata=True)
    for how, n in (("inner", 2), ("left_outer", 4), ("left_semi", 2), ("left_anti", 2)):
        assert fragment_join(rows.select("_rowaddr", "x"), rows.where("x > 1").select("_rowaddr", "y"), how=how).count() == n
