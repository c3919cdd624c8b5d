"""``spark.read.format("tessera")``: a facade over a table's path for code that wants a format name.

Rows come through Python in Arrow batches, a partition for each fragment; ``Table.df`` reads the same rows in Spark's own
Parquet reader and is what the engine itself uses. Tables with columns beside their fragments need that, or OPTIMIZE.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def _open(uri: str):
    from pyarrow import fs

    uri = re.sub(r"^s3[an]:", "s3:", uri)  # Hadoop's names of the same store
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def _manifest(path: str, version: str | None, time_us: str | None) -> dict:
    from pyarrow import fs

    files, root = _open(path)
    listed = files.get_file_info(fs.FileSelector(f"{root}/_versions", allow_not_found=True))
    names = sorted(f.base_name for f in listed if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    if not names:
        raise ValueError(f"no table at {path}")

    def load(name: str) -> dict:
        with files.open_input_stream(f"{root}/_versions/{name}") as f:
            return json.loads(f.read())

    if version is not None:
        wanted = f"{int(version):012d}.json"
        if wanted not in names:
            raise ValueError(f"{path} has no version {version}")
        return load(wanted)
    if time_us is not None:
        for name in reversed(names):
            m = load(name)
            if m["time_us"] <= int(time_us):
                return m
        raise ValueError(f"{path} has no version as old as {time_us} us")
    return load(names[-1])


class FragmentPartition(InputPartition):
    def __init__(self, path: str, deletions: list[str], fragment: int):
        super().__init__((path, tuple(deletions), fragment))


class TableReader(DataSourceReader):
    def __init__(self, root: str, manifest: dict, schema: StructType):
        self.root, self.manifest, self.names = root, manifest, schema.names
        if manifest["sides"]:
            raise ValueError("columns stand beside the fragments: read with Table.df, or OPTIMIZE the table")

    def partitions(self):
        m = self.manifest
        return [FragmentPartition(f["path"], [p for p, ids in m["deletions"] if f["id"] in ids] if f["deleted"] else [], f["id"]) for f in m["fragments"]]

    def read(self, partition):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        import pyarrow.parquet as pq

        path, deletions, fragment = partition.value
        files, root = _open(self.root)
        gone = [ds.dataset(f"{root}/{d}", filesystem=files, format="parquet").to_table(filter=(pc.field("_rowaddr") >= fragment << 32) & (pc.field("_rowaddr") < (fragment + 1) << 32))["_rowaddr"].to_numpy() for d in deletions]
        dead = np.unique(np.concatenate(gone)) & 0xFFFFFFFF if gone else np.zeros(0, np.int64)
        at = 0
        for batch in pq.ParquetFile(f"{root}/{path}", filesystem=files).iter_batches(8192, columns=self.names):
            n = batch.num_rows
            keep = np.ones(n, bool)
            keep[dead[(dead >= at) & (dead < at + n)] - at] = False
            at += n
            yield batch.select(self.names).filter(pa.array(keep))


class TesseraSource(DataSource):
    """Options: ``path``, and ``version`` or ``timestamp_us``."""

    @classmethod
    def name(cls) -> str:
        return "tessera"

    def _loaded(self) -> dict:
        return _manifest(self.options["path"], self.options.get("version"), self.options.get("timestamp_us"))

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self._loaded()["schema"]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(self.options["path"], self._loaded(), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TesseraSource)
