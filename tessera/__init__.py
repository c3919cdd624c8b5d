"""Tessera: a versioned, fragment-based table engine and query library on plain PySpark."""

from __future__ import annotations


def connect(spark, root: str | None = None, **catalog):
    """A SQL engine over a catalog at ``root``; without one, over tables named by their paths."""
    from .plans.sql import Engine
    from .sources.catalog import Catalog

    return Engine(spark, Catalog(spark, root, **catalog))


def read(spark, path: str, **options):
    """A table as a DataFrame. Options: version, timestamp, metadata, where, columns, and ``options`` such as nearest."""
    from .sources.table import Table

    return Table.open(spark, path).df(**options)


def write(df, path: str, mode: str = "error", properties: dict | None = None, **options):
    """Writes a DataFrame to the table at ``path``; modes as in ``tessera.sources.table.write``."""
    from .sources.table import write as put

    return put(df, path, mode, properties, options)
