"""Scalar functions of the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fragment_or_rand(fragment: Column | str) -> Column:
    """The fragment id, or a random int where it is null: keeps a fragment's rows together and spreads new ones."""
    c = F.col(fragment) if isinstance(fragment, str) else fragment
    return F.coalesce(c, (F.rand() * (2**31 - 1)).cast("int"))


def address(fragment: Column, row: Column) -> Column:
    return F.shiftleft(fragment.cast("bigint"), 32).bitwiseOR(row)


def fragment_of(addr: Column | str) -> Column:
    return F.shiftright(F.col(addr) if isinstance(addr, str) else addr, 32).cast("int")


def row_of(addr: Column | str) -> Column:
    return (F.col(addr) if isinstance(addr, str) else addr).bitwiseAND(0xFFFFFFFF)
