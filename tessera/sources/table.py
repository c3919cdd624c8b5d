"""Tables: directories of Parquet fragments under versioned manifests, read and written as DataFrames."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, NoSuchTable, TableAlreadyExists
from ..functions.kinds import apply_properties, blob_columns, check_storable, vector_size
from ..functions.scalar import address, fragment_of
from .files import Files
from .manifest import Fragment, Log, Manifest

#: Columns every table has beside its own; they are not part of ``SELECT *``.
HIDDEN = ("_rowid", "_rowaddr", "_row_last_updated_at_version", "_row_created_at_version", "_fragid")
#: What moved rows carry in their files.
CARRIED = {"__rowid": "bigint", "__created": "bigint", "__updated": "bigint"}
#: Deleted addresses are broadcast up to this many, as the manifest counts them.
BROADCAST_DELETES = 1_000_000
#: Columns beside fragments are broadcast if their files have at most so many bytes; larger ones are joined by a shuffle.
BROADCAST_SIDE = 4 << 20


def nullable(schema: T.StructType) -> T.StructType:
    """A table made from rows takes nulls in every column and in all that is nested, whatever its first rows were."""

    def wide(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, wide(f.dataType), True, f.metadata) for f in t.fields])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(wide(t.elementType), True)
        if isinstance(t, T.MapType):
            return T.MapType(wide(t.keyType), wide(t.valueType), True)
        return t

    return wide(schema)


def named(df: DataFrame, alias: str | list[str] | None) -> DataFrame:
    """``df`` under an alias. Further names are structs of its columns, so that Spark resolves those too; a column of the
    same name goes before them."""
    names = [alias] if isinstance(alias, str) else list(alias or ())
    columns = df.columns
    for n in names[1:]:
        if n.lower() not in map(str.lower, columns):
            df = df.withColumn(n, F.struct(*[F.col(f"`{c}`") for c in columns]))
    return df.alias(names[0]) if names else df


class Table:
    """A table at a path. Methods that write return the new version's manifest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.files = spark, Files(spark)
        self.root = self.files.qualified(path)
        self.log = Log(self.files, self.root)

    # --- lifecycle

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Table:
        table = cls(spark, path)
        if not table.log.exists():
            raise NoSuchTable(path)
        return table

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType | str, properties: dict[str, str] | None = None, replace_existing: bool = False) -> Table:
        """An empty table; version 1, or the next one if it replaces another."""
        table = cls(spark, path)
        properties = {k: str(v) for k, v in (properties or {}).items()}
        schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        schema = apply_properties(schema, properties)
        check_storable(schema)
        made = Manifest(0, 0, json.dumps(schema.jsonValue()), properties)
        if table.log.exists():
            if not replace_existing:
                raise TableAlreadyExists(path)
            old = table.log.latest()
            table.log.publish(old, lambda m: replace(made, next_fragment=m.next_fragment, next_row_id=m.next_row_id, operation="replace"), rebase=False)
        else:
            table.log.publish(None, lambda _: made)
        return table

    def manifest(self, version: int | None = None, timestamp: int | str | None = None) -> Manifest:
        if version is not None and timestamp is not None:
            raise InvalidArgument("a version or a timestamp, not both")
        if version is not None:
            return self.log.load(int(version))
        if timestamp is not None:
            return self.log.at_time(self._micros(timestamp))
        return self.log.latest()

    def _micros(self, timestamp: int | str) -> int:
        if isinstance(timestamp, int):
            return timestamp
        found = self.spark.range(1).select(F.unix_micros(F.lit(timestamp).cast("timestamp"))).first()[0]
        return found

    @property
    def schema(self) -> T.StructType:
        return self.manifest().struct

    def versions(self) -> DataFrame:
        """``version, timestamp, operation, rows, fragments`` of every version kept."""
        rows = [(m.version, m.time_us, m.operation, m.row_count, len(m.fragments)) for m in map(self.log.load, self.log.versions())]
        made = self.spark.createDataFrame(rows, "version bigint, us bigint, operation string, rows bigint, fragments int")
        return made.select("version", F.timestamp_micros("us").alias("timestamp"), "operation", "rows", "fragments")

    # --- reading

    def df(self, version: int | None = None, timestamp: int | str | None = None, metadata: bool = False, where: Column | str | None = None, columns: Iterable[str] | None = None, fragments: Iterable[int] | None = None, options: dict | None = None, alias: str | list[str] | None = None, without: Iterable[str] = ()) -> DataFrame:
        """A snapshot. ``metadata`` adds the hidden columns; ``fragments`` keeps only those; options may name a version
        or ``nearest`` (JSON), others are accepted and have no meaning here.

        A condition in SQL is looked through for addresses and for ranges of columns that have a zone map: fragments that
        it rules out are not read. ``alias``: the name, or names, by which it speaks of the table. ``without``: columns that nobody
        asks for; what stands beside the fragments for them alone is not read.
        """
        options = {k.lower(): v for k, v in (options or {}).items()}
        m = self.manifest(options.get("version", version), timestamp)
        wanted = None if fragments is None else set(fragments)
        if wanted is None and isinstance(where, str):
            from ..operators.indexes import zoned
            from ..plans.prune import fragments_of

            wanted = fragments_of(where)
            zones = zoned(self, m, where)
            wanted = zones if wanted is None else wanted if zones is None else wanted & zones
        without = set(without)
        if without and columns is None:
            kept = [c for c in m.struct.names if c not in without]
            out = self._snapshot(m, metadata, wanted, kept).drop(*without)
            return out if where is None else out.where(where)
        out = self._snapshot(m, metadata or isinstance(where, str) and any(h in where for h in HIDDEN), wanted, None if where is not None else columns)
        if where is not None:
            out = named(out, alias).where(where)
        if "nearest" in options:
            from ..operators.vector import nearest

            out = nearest(out, options["nearest"])
        if columns is not None:
            return out.select(*columns)
        extra = [x for b in blob_columns(m.struct) for x in (f"{b}__blob_pos", f"{b}__blob_size")] if metadata else []
        hidden = HIDDEN if metadata else ()
        return out.select(*m.struct.names, *extra, *hidden, *[c for c in out.columns if c == "_distance"])

    def _snapshot(self, m: Manifest, metadata: bool, wanted: set[int] | None, columns: Iterable[str] | None = None) -> DataFrame:
        """All columns of a version. Without deletions, side files and hidden columns this is a bare Parquet scan."""
        schema = m.struct
        files = [f for f in m.fragments if wanted is None or f.id in wanted]
        needed = set(columns) if columns is not None else None
        sides = [s for s in m.sides if (needed is None or needed & set(s.columns)) and {f.id for f in files} & set(s.fragments)]
        gone = [f for f in files if f.deleted]
        addressed = metadata or bool(sides) or bool(gone)
        blobs = blob_columns(schema)
        stored = T.StructType([f for f in schema.fields])
        if not files:
            out = self.spark.createDataFrame([], stored)
            for name in blobs:
                out = out.withColumns({f"{name}__blob_pos": F.lit(None).cast("bigint"), f"{name}__blob_size": F.lit(None).cast("bigint")})
            if metadata:
                kinds = {"_fragid": "int"}
                out = out.withColumns({h: F.lit(None).cast(kinds.get(h, "bigint")) for h in HIDDEN})
            return out
        if not addressed:
            return self._blobs(self._scan(m, files, stored), blobs)

        whole = [f for f in files if not f.deleted]
        parts = []
        if whole:
            parts.append(self._addressed(self._scan(m, whole, stored, True)))
        if gone:
            parts.append(self._undeleted(m, self._addressed(self._scan(m, gone, stored, True)), gone))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        for s in sides:
            out = self._beside(out, s, schema)
        out = self._blobs(out, blobs)
        missing = [c for c in schema.names if c not in out.columns]
        for c in missing:
            out = out.withColumn(c, F.lit(None).cast(schema[c].dataType))
        order = [*schema.names, *[x for b in blobs for x in (f"{b}__blob_pos", f"{b}__blob_size")]]
        return out.select(*order, *(HIDDEN if metadata else ()))

    def _scan(self, m: Manifest, files: list[Fragment], schema: T.StructType, hidden: bool = False) -> DataFrame:
        if hidden:
            schema = T.StructType([*schema.fields, *(T.StructField(n, T.LongType()) for n in CARRIED)])
        rows = self.spark.read.schema(nullable(schema)).parquet(*[f"{self.root}/{f.path}" for f in files])
        if hidden:
            rows = rows.withColumns({"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})
        return rows

    @staticmethod
    def _addressed(rows: DataFrame) -> DataFrame:
        """Hidden columns, from the file's name and the place in it; moved rows keep what they carry."""
        name = F.split("__file", "_", 4)
        rows = rows.withColumn("_fragid", name[0].cast("int"))
        version, first = name[1].cast("bigint"), name[2].cast("bigint")
        addr = address(F.col("_fragid"), F.col("__row"))
        rowid = F.coalesce(F.col("__rowid"), F.when(first >= 0, first + F.col("__row")), addr)
        created, updated = F.coalesce(F.col("__created"), version), F.coalesce(F.col("__updated"), version)
        return rows.withColumns({"_rowaddr": addr, "_rowid": rowid, "_row_created_at_version": created, "_row_last_updated_at_version": updated}).drop("__file", "__row", *CARRIED)

    def _undeleted(self, m: Manifest, rows: DataFrame, gone: list[Fragment]) -> DataFrame:
        ids = {f.id for f in gone}
        folders = [(p, set(touched)) for p, touched in m.deletions if ids & set(touched)]
        dead = self.spark.read.schema("_rowaddr bigint").parquet(*[f"{self.root}/{p}" for p, _ in folders])
        if any(touched - ids for _, touched in folders):  # so that the manifest's counts hold for what is broadcast
            dead = dead.where(fragment_of("_rowaddr").isin(sorted(ids)))
        if sum(f.deleted for f in gone) <= BROADCAST_DELETES:
            dead = F.broadcast(dead)
        return rows.join(dead, "_rowaddr", "left_anti")

    def _beside(self, rows: DataFrame, side, schema: T.StructType) -> DataFrame:
        """Columns of a side file over those the rows have; a row it lacks keeps its own value, or null."""
        kinds = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in side.columns)
        new = self.spark.read.schema(f"_rowaddr bigint, {kinds}").parquet(f"{self.root}/{side.path}")
        if 0 <= side.bytes <= BROADCAST_SIDE:
            new = F.broadcast(new)
        new = new.select("_rowaddr", F.lit(True).alias("__has"), *[F.col(c).alias(f"__new_{c}") for c in side.columns])
        out = rows.join(new, "_rowaddr", "left")
        for c in side.columns:
            old = F.col(c) if c in rows.columns else F.lit(None).cast(schema[c].dataType)
            out = out.withColumn(c, F.when(F.col("__has"), F.col(f"__new_{c}")).otherwise(old))
        return out.drop("__has", *[f"__new_{c}" for c in side.columns])

    @staticmethod
    def _blobs(rows: DataFrame, blobs: list[str]) -> DataFrame:
        """Blob columns read as empty bytes, with their place and size beside them."""
        for b in blobs:
            size = F.octet_length(F.col(b)).cast("bigint")
            rows = rows.withColumns({f"{b}__blob_size": size, f"{b}__blob_pos": F.when(F.col(b).isNotNull(), F.lit(0).cast("bigint"))})
            rows = rows.withColumn(b, F.when(F.col(b).isNotNull(), F.lit(b"")))
        return rows

    def blobs(self, column: str, version: int | None = None) -> DataFrame:
        """``_rowaddr`` and the bytes of a blob column."""
        m = self.manifest(version)
        if column not in blob_columns(m.struct):
            raise InvalidArgument(f"{column} is no blob column")
        rows = self._addressed(self._scan(m, list(m.fragments), T.StructType([m.struct[column]]), True))
        gone = [f for f in m.fragments if f.deleted]
        return (self._undeleted(m, rows, gone) if gone else rows).select("_rowaddr", column)

    def count(self, version: int | None = None) -> int:
        """Rows of a version, from its manifest: no file is opened."""
        return self.manifest(version).row_count

    def count_df(self, version: int | None = None) -> DataFrame:
        return self.spark.createDataFrame([(self.count(version),)], "n bigint")

    def statistics(self, version: int | None = None) -> dict[str, int]:
        m = self.manifest(version)
        return {"rows": m.row_count, "bytes": m.byte_count, "fragments": len(m.fragments)}

    # --- writing

    def _aligned(self, df: DataFrame, schema: T.StructType, by: str | None = None) -> DataFrame:
        """``df`` by name in the table's order and types, missing columns null; vectors of a wrong length raise."""
        extra = [c for c in df.columns if c not in schema.names and c not in CARRIED and c != by]
        if extra:
            raise InvalidArgument(f"columns that the table lacks: {', '.join(extra)}")
        out = []
        for f in schema.fields:
            c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
            if (n := vector_size(f)) is not None:
                bad = c.isNotNull() & (F.size(c) != n)
                c = F.when(bad, F.raise_error(F.lit(f"vector {f.name} must have {n} elements")).cast(f.dataType)).otherwise(c)
            if not f.nullable:
                c = F.when(c.isNull(), F.raise_error(F.lit(f"column {f.name} must not be null")).cast(f.dataType)).otherwise(c)
            out.append(c.alias(f.name, metadata=f.metadata))
        return df.select(*out, *[c for c in CARRIED if c in df.columns], *([by] if by else []))

    def stage(self, df: DataFrame, schema: T.StructType, max_rows: int | None = None, by: str | None = None, max_bytes: int | None = None) -> list[tuple[str, int, int]]:
        """Writes ``df`` to a staging folder; ``path, rows, bytes`` of the files that have rows.

        ``by``: a column of ``df`` beside the table's; each of its values gets files of its own. Files of more than
        ``max_bytes`` are written again in fewer rows, down to files of one row.
        """
        return self._within(self._stage(self._aligned(df, schema, by), max_rows, by), max_bytes)

    def _within(self, staged: list[tuple[str, int, int]], max_bytes: int | None) -> list[tuple[str, int, int]]:
        large = [x for x in staged if max_bytes and x[2] > max_bytes and x[1] > 1]
        if not large:
            return staged
        most = max(1, min(int(0.8 * rows * max_bytes / size) for _, rows, size in large))
        again = self.spark.read.parquet(*[f"{self.root}/{path}" for path, *_ in large])
        out = self._stage(again, min(most, max(rows for _, rows, _ in large) - 1))
        for path, *_ in large:
            self.files.delete(f"{self.root}/{path}")
        return [x for x in staged if x not in large] + self._within(out, max_bytes)

    def _stage(self, rows: DataFrame, max_rows: int | None, by: str | None = None) -> list[tuple[str, int, int]]:
        folder = f"_staging/{uuid.uuid4().hex}"
        writer = rows.write
        if max_rows:
            writer = writer.option("maxRecordsPerFile", int(max_rows))
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{folder}")
        found = []
        for name, size, is_folder, _ in self.files.list(f"{self.root}/{folder}"):
            inside = [(f"{name}/{n}", s) for n, s, *_ in self.files.list(f"{self.root}/{folder}/{name}")] if is_folder else [(name, size)]
            found += [x for x in inside if x[0].endswith(".parquet")]
        if not found:
            return []
        # a row for each file; footers alone are read
        last = 2 if by else 1
        name = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -last, last), "/")
        counted = {r[0]: r[1] for r in self.spark.read.parquet(f"{self.root}/{folder}").groupBy(name).agg(F.count(F.lit(1))).collect()}
        return [(f"{folder}/{n}", counted[n], size) for n, size in found if counted.get(n)]

    def adopt(self, m: Manifest, staged: list[tuple[str, int, int]], moved: bool = False) -> tuple[list[Fragment], Manifest]:
        """Moves staged files to their places as fragments of the version after ``m``."""
        out, number, row_id = [], m.next_fragment, m.next_row_id
        self.files.mkdirs(f"{self.root}/data")
        for path, rows, size in staged:
            first = row_id if m.stable_row_ids and not moved else -1
            name = f"data/{number}_{m.version + 1}_{first}_{uuid.uuid4().hex}.parquet"
            if self.files.exists(f"{self.root}/{path}"):
                self.files.rename(f"{self.root}/{path}", f"{self.root}/{name}")
            out.append(Fragment(number, name, rows, size, 0, moved))
            number += 1
            if first >= 0:
                row_id += rows
        return out, replace(m, next_fragment=number, next_row_id=row_id)

    def _append(self, df: DataFrame, overwrite: bool, schema: T.StructType | None, properties: dict | None, max_rows: int | None, operation: str, max_bytes: int | None = None) -> Manifest:
        base = self.log.latest()
        return self._publish(base, self.stage(df, schema or base.struct, max_rows, max_bytes=max_bytes), overwrite, schema, properties, operation)

    def add(self, staged: list[tuple[str, int, int]]) -> Manifest:
        """Appends files that ``stage`` wrote."""
        return self._publish(self.log.latest(), staged, False, None, None, "append")

    def _publish(self, base: Manifest, staged: list[tuple[str, int, int]], overwrite: bool, schema: T.StructType | None, properties: dict | None, operation: str) -> Manifest:
        placed: dict[str, str] = {}

        def change(m: Manifest) -> Manifest:
            now = [(placed.get(p, p), r, b) for p, r, b in staged]
            made, m = self.adopt(m, now)
            placed.update({s[0]: f.path for s, f in zip(staged, made, strict=True)})
            if overwrite:
                m = replace(m, fragments=(), deletions=(), sides=(), indexes=())
            if schema is not None:
                m = replace(m, schema=json.dumps(schema.jsonValue()), properties=properties or {})
            return replace(m, fragments=(*m.fragments, *made), operation=operation)

        return self.log.publish(base, change, rebase=not overwrite)

    def append(self, df: DataFrame, max_rows_per_file: int | None = None, max_bytes_per_file: int | None = None) -> Manifest:
        return self._append(df, False, None, None, max_rows_per_file, "append", max_bytes_per_file)

    def overwrite(self, df: DataFrame, max_rows_per_file: int | None = None, max_bytes_per_file: int | None = None) -> Manifest:
        """Replaces all rows; the schema stays."""
        return self._append(df, True, None, None, max_rows_per_file, "overwrite", max_bytes_per_file)

    def replace_with(self, df: DataFrame, properties: dict[str, str] | None = None) -> Manifest:
        """Replaces rows and schema in one commit."""
        properties = {k: str(v) for k, v in (properties or {}).items()}
        schema = apply_properties(nullable(df.schema), properties)
        check_storable(schema)
        return self._append(df, True, schema, properties, None, "replace")


def write(df: DataFrame, path: str, mode: str = "error", properties: dict[str, str] | None = None, options: dict | None = None) -> Table:
    """Writes ``df`` to the table at ``path``. Modes: error, append, overwrite, ignore, create_or_replace.

    Options: ``max_row_per_file`` bounds the rows of a fragment and ``max_bytes_per_file`` its bytes, as far as more than
    one row is in it; names of buffers and formats are accepted, unused.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    if int(options.get("batch_size", 8192)) <= 0:
        raise InvalidArgument("batch_size must be positive")
    most = options.get("max_row_per_file")
    size = int(options["max_bytes_per_file"]) if options.get("max_bytes_per_file") else None
    table = Table(df.sparkSession, path)
    there = table.log.exists()
    if mode == "append":
        if not there:
            raise NoSuchTable(path)
        table.append(df, most, size)
    elif there and mode == "error":
        raise TableAlreadyExists(path)
    elif there and mode == "overwrite":
        table.overwrite(df, most, size)
    elif there and mode == "create_or_replace":
        table.replace_with(df, properties)
    elif not (there and mode == "ignore"):
        schema = apply_properties(nullable(df.schema), {k: str(v) for k, v in (properties or {}).items()})
        check_storable(schema)
        try:  # the rows are written before the table is there: a query that fails leaves none behind
            staged = table.stage(df, schema, most, max_bytes=size)
        except Exception:
            if not table.log.exists():
                table.files.delete(f"{table.root}/_staging")
            raise
        table = Table.create(df.sparkSession, path, nullable(df.schema), properties)
        table.add(staged)
    return table
