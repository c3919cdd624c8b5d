"""Columns added or updated beside the fragments, by row address: no fragment is rewritten."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions.kinds import check_storable
from ..functions.scalar import fragment_of
from ..sources.manifest import Manifest, SideFile
from ..sources.table import Table


def _write(table: Table, source: DataFrame, columns: list[str]) -> SideFile | None:
    """A side file of the source's addresses and columns, a fragment's rows together and in order."""
    if not {"_rowaddr", "_fragid"} <= set(source.columns):
        raise InvalidArgument("the source needs the columns _rowaddr and _fragid")
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise InvalidArgument(f"the source lacks {', '.join(missing)}")
    path = f"columns/{uuid.uuid4().hex}"
    rows = source.select("_rowaddr", "_fragid", *columns).where("_rowaddr is not null").dropDuplicates(["_rowaddr"])
    rows.repartition("_fragid").sortWithinPartitions("_rowaddr").drop("_fragid").write.parquet(f"{table.root}/{path}")
    found = table.spark.read.schema("_rowaddr bigint").parquet(f"{table.root}/{path}")
    touched = [r[0] for r in found.select(fragment_of("_rowaddr")).distinct().collect()]  # fragments, not rows
    if not touched:
        table.files.delete(f"{table.root}/{path}")
        return None
    size = sum(n for name, n, *_ in table.files.list(f"{table.root}/{path}") if name.endswith(".parquet"))
    return SideFile(path, tuple(columns), tuple(sorted(touched)), size)


def add_columns(table: Table, columns: list[str], source: DataFrame) -> Manifest:
    """Adds ``columns`` of ``source(_rowaddr, _fragid, ...)``; rows that it lacks get null. No source row: no change."""
    base = table.manifest()
    taken = [c for c in columns if c in base.struct.names]
    if taken:
        raise InvalidArgument(f"columns that exist already: {', '.join(taken)}")
    side = _write(table, source, columns)
    if side is None:
        return base
    schema = T.StructType([*base.struct.fields, *[T.StructField(c, source.schema[c].dataType, True, source.schema[c].metadata) for c in columns]])
    check_storable(schema)
    return table.log.publish(base, lambda m: replace(m, schema=json.dumps(schema.jsonValue()), sides=(*m.sides, side), operation="add_columns"), frozenset(side.fragments))


def update_columns(table: Table, columns: list[str], source: DataFrame) -> Manifest:
    """Sets ``columns`` of the rows that ``source`` has, to null too; addresses stay."""
    base = table.manifest()
    missing = [c for c in columns if c not in base.struct.names]
    if missing:
        raise InvalidArgument(f"no columns {', '.join(missing)}")
    side = _write(table, source, columns)
    if side is None:
        return base

    def change(m: Manifest) -> Manifest:  # an index of these columns knows the touched fragments no more
        indexes = tuple(replace(i, fragments=tuple(f for f in i.fragments if f not in side.fragments)) if set(i.columns) & set(columns) else i for i in m.indexes)
        return replace(m, sides=(*m.sides, side), indexes=indexes, operation="update_columns")

    return table.log.publish(base, change, frozenset(side.fragments))
