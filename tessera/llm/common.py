"""Helpers that the training-data operators share: scratch tables, size-checked broadcasts, word hashing.

Spark code here keeps to three rules. Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` and nowhere else. A side is broadcast only after its bytes were added up. Python workers keep
bounded state only, and reach no path that Spark itself does not hand them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a side that may be broadcast once they were added up; as a hash relation it takes about twice as many.
BROADCAST_BYTES = 16 << 20

M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xC2B2AE3D27D4EB4F)
M3 = np.uint64(0x165667B19E3779F9)
_33 = np.uint64(33)


def scratch_base(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset, a session of one machine gets a folder of its
    temp folder (tests) and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or f"file://{tempfile.gettempdir()}/tessera-scratch").rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a slim result: its lineage ends at files in the shared folder, which Spark's cleaner removes."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(scratch_base(df.sparkSession))
    return df.checkpoint()


#: Rows that Python workers get at a time; whole texts are long.
BATCH_ROWS = 2000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """Intermediate Parquet tables under the shared folder, deleted as soon as nothing reads them any more.

    As a context it also has Arrow batches made of fewer rows, which bounds the memory of Python workers.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Writes ``df`` and reads it back; ``by``: a column whose values get folders of their own, ``name/by=value``."""
        path = f"{self.root}/{name}"
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        self.rows = self.spark.conf.get(_BATCH_KEY)
        self.spark.conf.set(_BATCH_KEY, str(min(BATCH_ROWS, int(self.rows)) if int(self.rows) > 0 else BATCH_ROWS))
        return self

    def __exit__(self, *_) -> None:
        self.spark.conf.set(_BATCH_KEY, self.rows)
        self.drop()


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, T.ArrayType):
        each = _bytes(F.lit(None).cast(kind.elementType), kind.elementType)
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType)):
            return F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + _bytes(x, kind.elementType).cast("int")), F.lit(0)) + 16
        return F.greatest(F.size(value), F.lit(0)) * each + 16
    return F.lit(8)


def weigh(df: DataFrame) -> int:
    """About the bytes of all rows of ``df``: one pass over it."""
    each = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.sum(each.cast("long"))).first()[0] or 0


def sized(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its rows have at most ``limit`` bytes, else as it is, for a shuffled join."""
    return F.broadcast(df) if weigh(df) <= (BROADCAST_BYTES if limit is None else limit) else df


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key's text, modulo ``n``; null where the key is null."""
    return F.crc32(key.cast("string").cast("binary")) % n


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; overwrites and returns its argument."""
    x ^= x >> _33
    x *= M2
    x ^= x >> _33
    x *= M3
    x ^= x >> _33
    return x


class WordHasher(dict):
    """64-bit hashes of byte strings, remembered for at most ``limit`` of them."""

    def __init__(self, limit: int = 250_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z lower-cased."""
    return text.lower().split()


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``k`` words; of the whole sequence where it is shorter; empty for none."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc *= M1
        acc ^= hashes[j : n - k + 1 + j]
        acc = mix(acc)
    return np.unique(acc)


def as_bytes(column) -> list:
    """An Arrow string column as a list of bytes or None."""
    import pyarrow as pa

    return column.cast(pa.large_binary()).to_pylist()


def blocks(items: Iterable, weight, limit: int) -> Iterable[list]:
    """Runs of consecutive items of at most ``limit`` total weight, or of one heavier item."""
    held, total = [], 0
    for x in items:
        w = weight(x)
        if held and total + w > limit:
            yield held
            held, total = [], 0
        held.append(x)
        total += w
    if held:
        yield held


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once a row, however often and in whatever lambda the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
