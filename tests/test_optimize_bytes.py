from tessera.operators import maintenance
from tessera.sources.table import write


def test_optimize_keeps_to_max_bytes_per_file(spark, path):
    table = write(spark.range(8000).repartitionByRange(8, "id"), path)
    before = table.manifest().fragments
    limit = 2 * max(f.bytes + 24 * f.rows for f in before)
    assert len(before) == 8
    assert tuple(maintenance.optimize(table, {"max_bytes_per_file": str(limit)}).first()) == (8, 4, 8, 4)
    after = table.manifest().fragments
    assert len(after) == 4 and max(f.bytes for f in after) <= limit
    assert sorted(r.id for r in table.df().collect()) == list(range(8000))


def test_optimize_joins_nothing_under_a_fragment(spark, path):
    table = write(spark.range(80).repartitionByRange(4, "id"), path)
    assert tuple(maintenance.optimize(table, {"max_bytes_per_file": 1}).first()) == (0, 0, 0, 0)
    assert tuple(maintenance.optimize(table).first()) == (4, 1, 4, 1)
