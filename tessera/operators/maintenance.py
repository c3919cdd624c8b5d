"""Compaction and removal of old versions."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..sources.manifest import Fragment, Manifest
from ..sources.table import CARRIED, Table
from .dml import _rows

OPTIMIZE_OPTIONS = ("target_rows_per_fragment", "max_rows_per_group", "max_bytes_per_file", "materialize_deletions", "materialize_deletions_threshold", "num_threads", "batch_size", "defer_index_remap")
VACUUM_OPTIONS = ("before_version", "before_timestamp_millis", "delete_unverified", "error_if_tagged_old_versions")


def plan_bins(m: Manifest, target: int, materialize: bool, threshold: float, max_bytes: float = float("inf")) -> list[list[Fragment]]:
    """Runs of neighbouring fragments to be written as one: small ones up to ``target`` rows, and any with enough deletions
    or with columns beside it.

    Fragments are joined up to ``max_bytes``, by the bytes of their files and 24 a row for the hidden columns that moved
    rows carry. One fragment is never split, and columns beside it are not counted.
    """
    beside = {i for s in m.sides for i in s.fragments}
    bins: list[list[Fragment]] = []
    run: list[Fragment] = []
    rows = size = 0

    def close() -> None:
        if len(run) > 1 or run and (run[0].id in beside or materialize and run[0].deleted and run[0].deleted >= threshold * run[0].rows):
            bins.append(list(run))

    for f in m.fragments:
        live = f.rows - f.deleted
        candidate = live < target or f.id in beside or materialize and f.deleted and f.deleted >= threshold * f.rows
        held = f.bytes + (0 if f.moved else 24 * live)
        if not candidate or run and (rows + live > target or size + held > max_bytes):
            close()
            run, rows, size = [], 0, 0
        if candidate:
            run.append(f)
            rows += live
            size += held
    close()
    return bins


def optimize(table: Table, options: dict | None = None) -> DataFrame:
    """Compacts; ``fragments_removed, fragments_added, files_removed, files_added``. Nothing to do: zeros and no commit.

    All bins are written in one job: rows are clustered by bin and kept in address order, so a bin makes one fragment.
    Row ids and versions of the rows stay; indexes lose the fragments that went.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    unknown = [k for k in options if k not in OPTIMIZE_OPTIONS]
    if unknown:
        raise InvalidArgument(f"unknown options: {', '.join(unknown)}")
    target = int(options.get("target_rows_per_fragment", 1_048_576))
    materialize = str(options.get("materialize_deletions", "true")).lower() == "true"
    base = table.manifest()
    bins = plan_bins(base, target, materialize, float(options.get("materialize_deletions_threshold", 0.1)), float(options.get("max_bytes_per_file", "inf")))
    result = (0, 0, 0, 0)
    if bins:
        taken = {f.id for b in bins for f in b}
        pairs = table.spark.createDataFrame([(f.id, k) for k, b in enumerate(bins) for f in b], "_fragid int, __bin int")
        rows = _rows(table, base, None, taken).join(F.broadcast(pairs), "_fragid")  # fragments, as the manifest lists them
        rows = rows.withColumns({"__rowid": F.col("_rowid"), "__created": F.col("_row_created_at_version"), "__updated": F.col("_row_last_updated_at_version")})
        ordered = rows.repartition("__bin").sortWithinPartitions("__bin", "_rowaddr")
        staged = table.stage(ordered.select(*base.struct.names, *CARRIED, "__bin"), base.struct, by="__bin")
        placed: dict[str, str] = {}

        def change(m: Manifest) -> Manifest:
            made, m = table.adopt(m, [(placed.get(p, p), r, b) for p, r, b in staged], True)
            placed.update({s[0]: f.path for s, f in zip(staged, made, strict=True)})
            left = tuple(f for f in m.fragments if f.id not in taken)
            ids = {f.id for f in left}
            sides = tuple(replace(s, fragments=tuple(i for i in s.fragments if i in ids)) for s in m.sides)
            indexes = tuple(replace(i, fragments=tuple(x for x in i.fragments if x in ids)) for i in m.indexes)
            deletions = tuple((p, t) for p, t in m.deletions if ids & set(t))
            return replace(m, fragments=(*left, *made), sides=tuple(s for s in sides if s.fragments), indexes=indexes, deletions=deletions, operation="optimize")

        table.log.publish(base, change, frozenset(taken))
        result = (len(taken), len(staged), len(taken), len(staged))
    return table.spark.createDataFrame([result], "fragments_removed bigint, fragments_added bigint, files_removed bigint, files_added bigint")


def vacuum(table: Table, options: dict | None = None) -> DataFrame:
    """Removes versions before a version or a time, and the files that no version left needs: ``bytes_removed, old_versions``.

    The current version stays. Files that no version ever named may belong to a commit under way; they go only with
    ``delete_unverified`` or once they are a week old.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    unknown = [k for k in options if k not in VACUUM_OPTIONS]
    if unknown:
        raise InvalidArgument(f"unknown options: {', '.join(unknown)}")
    log, files, root = table.log, table.files, table.root
    found = [log.load(v) for v in log.versions()]
    latest = max(found, key=lambda m: m.version)
    by_version, by_time = options.get("before_version"), options.get("before_timestamp_millis")
    if by_version is None and by_time is None:
        by_time = (time.time() - 14 * 86400) * 1000
    old = [m for m in found if m.version != latest.version and (by_version is not None and m.version < int(by_version) or by_time is not None and m.time_us < float(by_time) * 1000)]
    kept = [m for m in found if m not in old]

    def used(ms: list[Manifest]) -> set[str]:
        return {x for m in ms for x in (*[f.path for f in m.fragments], *[p for p, _ in m.deletions], *[s.path for s in m.sides], *[i.path for i in m.indexes])}

    needed, named = used(kept), used(found)
    removed = 0
    young = (time.time() - 7 * 86400) * 1000
    unverified = str(options.get("delete_unverified", "false")).lower() == "true"
    for folder in ("data", "deletions", "columns", "indexes", "_staging"):
        for name, size, is_folder, modified in files.list(f"{root}/{folder}"):
            path = f"{folder}/{name}"
            if path in needed or path not in named and not unverified and modified > young:
                continue
            removed += sum(x[1] for x in files.list(f"{root}/{path}")) if is_folder else size
            files.delete(f"{root}/{path}")
    for m in old:
        path = f"{log.folder}/{m.version:012d}.json"
        removed += next((s for n, s, *_ in files.list(log.folder) if path.endswith(n)), 0)
        files.delete(path)
    return table.spark.createDataFrame([(removed, len(old))], "bytes_removed bigint, old_versions bigint")
