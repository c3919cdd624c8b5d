"""Change data: which rows were created or updated after a version, from the hidden version columns.

Rows keep the version that created them through updates and compaction. (The engine this one stands in for works the
versions of a touched fragment out anew and forgets when its rows were created; an incremental pull gives the same rows.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.table import Table

CREATED, UPDATED = "_row_created_at_version", "_row_last_updated_at_version"


def changes_since(table: Table, version: int) -> DataFrame:
    """Rows created or updated after ``version``, with the hidden columns."""
    return table.df(metadata=True).where((F.col(CREATED) > version) | (F.col(UPDATED) > version))


def changes_between(table: Table, after: int, until: int) -> DataFrame:
    """Rows as of ``until`` that were created or updated in ``after`` < version <= ``until``."""
    return table.df(version=until, metadata=True).where(F.col(UPDATED) > after)


def inserted_since(table: Table, version: int) -> DataFrame:
    return table.df(metadata=True).where(F.col(CREATED) > version)


def updated_since(table: Table, version: int) -> DataFrame:
    """Rows that were there at ``version`` and changed since."""
    return table.df(metadata=True).where((F.col(CREATED) <= version) & (F.col(UPDATED) > version))


def deleted_between(table: Table, after: int, until: int) -> DataFrame:
    """Row ids at version ``after`` that are gone at ``until``; an update keeps its row's id."""
    before = table.df(version=after, metadata=True).select("_rowid")
    return before.join(table.df(version=until, metadata=True).select("_rowid"), "_rowid", "left_anti")
