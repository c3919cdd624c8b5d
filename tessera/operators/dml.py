"""DELETE, UPDATE and MERGE: deleted addresses beside the fragments, and new fragments for changed rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..functions.kinds import blob_columns
from ..functions.scalar import fragment_of, fragment_or_rand
from ..sources.manifest import Manifest
from ..sources.table import HIDDEN, Table, named


def _as_column(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def _rows(table: Table, m: Manifest, where: Column | str | None = None, fragments: set[int] | None = None, alias: str | list[str] | None = None) -> DataFrame:
    """Rows with hidden columns and the bytes of blobs; a SQL condition on addresses prunes fragments."""
    out = table.df(version=m.version, metadata=True, where=where, fragments=fragments, alias=alias)
    for b in blob_columns(m.struct):
        out = out.drop(b, f"{b}__blob_pos", f"{b}__blob_size").join(table.blobs(b, m.version), "_rowaddr", "left")
    return out.select(*m.struct.names, *HIDDEN)


def write_deletions(table: Table, addresses: DataFrame) -> tuple[str, dict[int, int]]:
    """Writes distinct ``_rowaddr`` of a delete, a fragment's together and in order; the folder and counts by fragment."""
    path = f"deletions/{uuid.uuid4().hex}"
    frag = fragment_of("_rowaddr")
    addresses.select("_rowaddr").withColumn("__f", frag).repartition("__f").sortWithinPartitions("_rowaddr").select("_rowaddr").write.parquet(f"{table.root}/{path}")
    found = table.spark.read.schema("_rowaddr bigint").parquet(f"{table.root}/{path}")
    # a row for each touched fragment
    return path, {r["f"]: r["n"] for r in found.groupBy(frag.alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()}


def without(m: Manifest, path: str, counts: dict[int, int]) -> Manifest:
    """``m`` with the deletions of a folder; fragments with no row left are gone."""
    fragments = [replace(f, deleted=f.deleted + counts.get(f.id, 0)) for f in m.fragments]
    live = tuple(f for f in fragments if f.deleted < f.rows)
    ids = {f.id for f in live}
    deletions = [*m.deletions, (path, tuple(sorted(counts)))] if counts else m.deletions
    return replace(m, fragments=live, deletions=tuple((p, t) for p, t in deletions if ids & set(t)))


def delete(table: Table, where: Column | str | None = None, alias: str | list[str] | None = None) -> Manifest:
    """Deletes the rows for which ``where`` is true; all without it. Nothing to delete is no commit. ``alias``: the name by
    which the condition speaks of the table."""
    base = table.manifest()
    if where is None:
        return table.log.publish(base, lambda m: replace(m, fragments=(), deletions=(), sides=(), operation="delete"), frozenset(f.id for f in base.fragments))
    path, counts = write_deletions(table, table.df(version=base.version, metadata=True, where=where, alias=alias).select("_rowaddr"))
    if not counts:
        table.files.delete(f"{table.root}/{path}")
        return base
    return table.log.publish(base, lambda m: replace(without(m, path, counts), operation="delete"), frozenset(counts))


def _carried(df: DataFrame) -> DataFrame:
    """Changed rows keep their row id and the version they were created at."""
    return df.withColumns({"__rowid": F.col("_rowid"), "__created": F.col("_row_created_at_version")})


def _commit(table: Table, base: Manifest, gone: DataFrame, changed: DataFrame | None, inserted: DataFrame | None, operation: str) -> Manifest:
    """One version with the deletions, the changed rows (which keep what they carry) and the inserted ones.

    Fragments that another commit changed meanwhile are a conflict; see ``Log.publish``.
    """
    schema = base.struct
    moved = [] if changed is None else table.stage(changed.select(*schema.names, "__rowid", "__created"), schema)
    new = [] if inserted is None else table.stage(inserted.select(*schema.names), schema)
    path, counts = write_deletions(table, gone)
    if not (moved or new or counts):
        table.files.delete(f"{table.root}/{path}")
        return base
    placed: dict[str, str] = {}

    def change(m: Manifest) -> Manifest:
        m = without(m, path, counts)
        for files, is_moved in ((moved, True), (new, False)):
            made, m = table.adopt(m, [(placed.get(p, p), r, b) for p, r, b in files], is_moved)
            placed.update({s[0]: f.path for s, f in zip(files, made, strict=True)})
            m = replace(m, fragments=(*m.fragments, *made))
        return replace(m, operation=operation)

    return table.log.publish(base, change, frozenset(counts))


def _assign(schema, df: DataFrame, values: dict[str, Column | str]) -> DataFrame:
    """``df`` with columns set; ``a.b`` sets a field of a struct."""
    whole: dict[str, Column] = {}
    for name, value in values.items():
        top, _, rest = name.partition(".")
        if top not in schema.names:
            raise InvalidArgument(f"no column {name}")
        value = _as_column(value)
        whole[top] = whole.get(top, F.col(top)).withField(rest, value) if rest else value.cast(schema[top].dataType)
    return df.withColumns(whole)


def update(table: Table, values: dict[str, Column | str], where: Column | str | None = None, alias: str | list[str] | None = None) -> Manifest:
    """Sets columns of the rows for which ``where`` is true. Values see the old row. The rows get new addresses."""
    base = table.manifest()
    matched = _rows(table, base, where, alias=alias)
    old = _carried(matched)
    changed = _assign(base.struct, named(old, alias), values)
    return _commit(table, base, matched.select("_rowaddr"), changed, None, "update")


@dataclass(frozen=True)
class When:
    """A clause of a merge: ``matched`` or not, an extra condition, and what to do: delete, or columns to set (all: of
    the source, by name)."""

    matched: bool
    action: str  # delete, update, insert
    values: dict[str, str] | None = None
    condition: str | None = None


def merge(table: Table, source: DataFrame, on: str, clauses: list[When], target: str = "t", alias: str = "s") -> Manifest:
    """MERGE INTO: for each pair the first clause whose condition is true applies; all in one commit.

    Keys that are null match nothing. A target row that two source rows would change raises. The source is written out
    once, so that it need not be deterministic, and what is written on the way is deleted, also where it raises.
    """
    base = table.manifest()
    staging = f"{table.root}/_staging/{uuid.uuid4().hex}"
    try:
        return _merge(table, base, source, on, clauses, target, alias, staging)
    finally:
        table.files.delete(staging)


def _merge(table: Table, base: Manifest, source: DataFrame, on: str, clauses: list[When], target: str, alias: str, staging: str) -> Manifest:
    schema, spark = base.struct, table.spark

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{staging}/{name}")
        return spark.read.schema(df.schema).parquet(f"{staging}/{name}")

    s = kept(source.select(F.struct(*source.columns).alias(alias), F.monotonically_increasing_id().alias("__sid")), "source")
    rows = _rows(table, base)
    t = rows.select(F.struct(*rows.columns).alias(target))
    matched_clauses = [(i, c) for i, c in enumerate(clauses) if c.matched]
    insert_clauses = [(i, c) for i, c in enumerate(clauses) if not c.matched]

    def chosen(which) -> Column:
        out = F.lit(None).cast("int")
        for i, c in reversed(which):
            ok = F.expr(c.condition) if c.condition else F.lit(True)
            out = F.when(F.coalesce(ok, F.lit(False)), F.lit(i)).otherwise(out)
        return out

    # the target is joined once: pairs are written out, and source rows of no pair are those to insert
    pairs = t.join(s, F.expr(on), "inner").withColumn("__c", chosen(matched_clauses))
    if not insert_clauses:
        pairs = pairs.where("__c is not null")
    elif not matched_clauses:
        pairs = pairs.select("__sid", "__c")
    pairs = kept(pairs, "pairs")
    inserted = changed = None
    if insert_clauses:
        alone = s.join(pairs.select("__sid").distinct(), "__sid", "left_anti").withColumn("__c", chosen(insert_clauses)).where("__c is not null")
        for i, c in insert_clauses:
            values = c.values or {n: f"{alias}.`{n}`" for n in source.columns if n in schema.names}
            part = alone.where(F.col("__c") == i).select(*[(F.expr(values[n]) if n in values else F.lit(None)).cast(schema[n].dataType).alias(n) for n in schema.names])
            inserted = part if inserted is None else inserted.unionByName(part)
    if not matched_clauses:
        gone = rows.where("false").select("_rowaddr")
    else:
        hit = pairs.where("__c is not null")
        twice = hit.groupBy(F.col(f"{target}._rowaddr").alias("a")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if not twice.isEmpty():
            raise InvalidArgument("a target row matches more than one source row")
        gone = hit.select(F.col(f"{target}._rowaddr").alias("_rowaddr"))
        for i, c in matched_clauses:
            if c.action == "delete":
                continue
            values = c.values or {n: f"{alias}.`{n}`" for n in source.columns if n in schema.names}
            cols = {n: F.col(f"{target}.`{n}`") for n in schema.names}
            for name, value in values.items():
                top, _, rest = name.partition(".")
                if top not in cols:
                    raise InvalidArgument(f"no column {name}")
                cols[top] = cols[top].withField(rest, F.expr(value)) if rest else F.expr(value).cast(schema[top].dataType)
            part = hit.where(F.col("__c") == i).select(*[x.alias(n) for n, x in cols.items()], F.col(f"{target}._rowid").alias("__rowid"), F.col(f"{target}._row_created_at_version").alias("__created"))
            changed = part if changed is None else changed.unionByName(part)
    return _commit(table, base, gone, changed, inserted, "merge")


def clustered(changes: DataFrame) -> DataFrame:
    """The distribution of a write of changes: a fragment's rows in one task in address order, new rows anywhere."""
    return changes.repartition(fragment_or_rand("_fragid")).sortWithinPartitions(F.col("_rowaddr").asc_nulls_first())
