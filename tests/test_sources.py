from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tessera.errors import NoSuchVersion
from tessera.operators import dml
from tessera.sources.datasource import register
from tessera.sources.files import Files
from tessera.sources.manifest import Log
from tessera.sources.table import Table, write
from tessera.streaming import windows


def test_format_facade(spark, path):
    register(spark)
    table = write(spark.range(50).select("id", F.concat(F.lit("n"), "id").alias("name")).repartition(3), path)
    dml.delete(table, "id % 7 = 0")
    dml.delete(table, "id = 1")
    mine = spark.read.format("tessera").option("path", path).load()
    assert mine.columns == ["id", "name"]
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, table.df().collect()))
    assert spark.read.format("tessera").option("path", path).option("version", 2).load().count() == 50


def test_exclusive_creation(spark, tmp_path):
    files, root = Files(spark), f"file://{tmp_path}"
    assert files.create(f"{root}/a.json", "1") and not files.create(f"{root}/a.json", "2")
    assert files.read(f"{root}/a.json") == "1"
    assert files.create(f"{root}/a.json", "3", replace=True) and files.read(f"{root}/a.json") == "3"
    assert [n for n, *_ in files.list(root) if not n.endswith(".crc")] == ["a.json"]
    assert files.list(f"{root}/none") == []
    with pytest.raises(NoSuchVersion):
        Log(files, root).load(3)


def test_concurrent_committers(spark, path):
    """Eight writers append at once: every commit is kept, each as a version of its own."""
    table = write(spark.range(1), path)
    base = table.manifest().version
    staged = [table.stage(spark.range(10 * k, 10 * k + 10).coalesce(1), table.schema) for k in range(1, 9)]
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda x: Table(spark, table.root).add(x), staged))
    assert sorted(m.version for m in made) == list(range(base + 1, base + 9))
    assert sorted(r.id for r in table.df().collect()) == [0, *range(10, 90)]
    assert len({f.id for f in table.manifest().fragments}) == len(table.manifest().fragments)


def test_claim_after_the_winner_is_done(spark, tmp_path, monkeypatch):
    """A writer that saw no file, and claims it only after another wrote it, does not replace it."""
    files, path = Files(spark), f"file://{tmp_path}/a.json"
    plain, looks = Files._fs, []

    class Blind:  # sees nothing at the first two looks, those before the claim
        def __init__(self, fs):
            self.fs = fs

        def exists(self, target):
            looks.append(target.getName())
            return self.fs.exists(target) and looks.count("a.json") > 2

        def __getattr__(self, name):
            return getattr(self.fs, name)

    assert files.create(path, "winner")
    monkeypatch.setattr(Files, "_fs", lambda self, p: Blind(plain(self, p)))
    assert not files.create(path, "loser") and looks.count("a.json") >= 3
    monkeypatch.undo()
    assert files.read(path) == "winner"


def test_late_events_are_dropped(spark, tmp_path):
    """A late row is judged by the watermark that the batch before it left: it does not count."""
    folder = f"file://{tmp_path}/events"
    schema = "ts timestamp, user long"
    files = ([("2024-01-01 00:01:00", 1), ("2024-01-01 00:02:00", 1)], [("2024-01-01 03:00:00", 1)], [("2024-01-01 03:01:00", 1)], [("2024-01-01 00:03:00", 1), ("2024-01-01 06:00:00", 1)])
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "ts string, user long").select(F.col("ts").cast("timestamp"), "user").coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)
    out = windows.tumbling(stream, "ts", "1 hour", ["user"], late="10 minutes")
    q = out.writeStream.format("memory").queryName("late").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    found = {str(r.start): r.n for r in spark.table("late").collect()}
    assert found["2024-01-01 00:00:00"] == 2 and found["2024-01-01 03:00:00"] == 2 and "2024-01-01 06:00:00" not in found
