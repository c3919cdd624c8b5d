"""A catalog: nested namespaces as folders, tables as folders or pointers to other folders."""

from __future__ import annotations

import json
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession

from ..errors import InvalidArgument, NamespaceAlreadyExists, NamespaceNotEmpty, NoSuchNamespace, NoSuchTable, TableAlreadyExists, Unsupported
from .files import Files
from .table import Table

_PATH_STARTS = ("/", "file:", "hdfs:", "s3:", "s3a:", "gs:", "az:", "abfss:", "viewfs:")


def is_path(name: str) -> bool:
    return name.startswith(_PATH_STARTS)


class Catalog:
    """``root/<namespace>/.../<name>.table.json`` points at a table; ``_namespace.json`` makes a folder a namespace.

    ``single_level``: names have one namespace, ``default``, which is always there. ``parent``: a namespace, its parts
    parted by ``parent_delimiter``, that all names are taken to be in. ``defaults``: properties of new tables, such as
    ``enable_stable_row_ids``, which a table's own override. Without ``root`` only paths work.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, name: str = "tessera", single_level: bool = False, defaults: dict[str, str] | None = None, parent: str | None = None, parent_delimiter: str = "."):
        self.spark, self.name, self.single_level, self.defaults = spark, name, single_level, defaults or {}
        self.files = Files(spark)
        self.root = "/".join([self.files.qualified(root), *(parent.split(parent_delimiter) if parent else [])]) if root else None
        if self.root:
            self.files.mkdirs(self.root)

    # --- names

    def split(self, identifier: str | tuple[str, ...]) -> tuple[str, ...]:
        """The parts of a dotted name; parts in backquotes keep their dots. The catalog's own name in front is dropped."""
        if isinstance(identifier, tuple):
            parts = identifier
        else:
            parts, at = [], 0
            while at < len(identifier):
                if identifier[at] == "`":
                    end = identifier.index("`", at + 1)
                    parts.append(identifier[at + 1 : end])
                    at = end + 2
                else:
                    end = identifier.find(".", at)
                    end = len(identifier) if end < 0 else end
                    parts.append(identifier[at:end])
                    at = end + 1
            parts = tuple(parts)
        if len(parts) > 1 and parts[0] == self.name:
            parts = parts[1:]
        if self.single_level and len(parts) > 1 and parts[0] == "default":
            parts = parts[1:]
        if not parts or any(not p for p in parts):
            raise InvalidArgument(f"bad name {identifier}")
        if not is_path(parts[-1]) and any("/" in p or p in (".", "..") for p in parts):
            raise InvalidArgument(f"bad name {identifier}")
        return parts

    def _folder(self, namespace: tuple[str, ...]) -> str:
        if self.root is None:
            raise Unsupported("this catalog has no root: use paths")
        return "/".join([self.root, *namespace])

    def _pointer(self, parts: tuple[str, ...]) -> str:
        return f"{self._folder(parts[:-1])}/{parts[-1]}.table.json"

    def _own(self, path: str) -> bool:
        return self.root is not None and path.startswith(f"{self.root}/") and ".." not in path

    # --- namespaces

    def namespace_exists(self, namespace: str | tuple[str, ...]) -> bool:
        parts = self.split(namespace) if namespace else ()
        return not parts or self.single_level and parts == ("default",) or self.files.exists(f"{self._folder(parts)}/_namespace.json")

    def create_namespace(self, namespace: str, if_not_exists: bool = False, properties: dict[str, str] | None = None) -> None:
        parts = self.split(namespace)
        if self.namespace_exists(parts):
            if if_not_exists:
                return
            raise NamespaceAlreadyExists(namespace)
        if len(parts) > 1 and not self.namespace_exists(parts[:-1]):
            raise NoSuchNamespace(".".join(parts[:-1]))
        self.files.mkdirs(self._folder(parts))
        if not self.files.create(f"{self._folder(parts)}/_namespace.json", json.dumps(properties or {})):
            raise NamespaceAlreadyExists(namespace)

    def drop_namespace(self, namespace: str, cascade: bool = False, if_exists: bool = False) -> None:
        parts = self.split(namespace)
        if not self.namespace_exists(parts):
            if if_exists:
                return
            raise NoSuchNamespace(namespace)
        folder = self._folder(parts)
        if not cascade and any(n.endswith(".table.json") or d and self.files.exists(f"{folder}/{n}/_namespace.json") for n, _, d, _ in self.files.list(folder)):
            raise NamespaceNotEmpty(namespace)
        if not self._own(folder):
            raise InvalidArgument(f"{folder} is outside of the catalog")
        self.files.delete(folder)

    def describe_namespace(self, namespace: str) -> dict[str, str]:
        parts = self.split(namespace)
        if not self.namespace_exists(parts):
            raise NoSuchNamespace(namespace)
        path = f"{self._folder(parts)}/_namespace.json"
        return json.loads(self.files.read(path)) if self.files.exists(path) else {}

    def alter_namespace(self, *_) -> None:
        raise Unsupported("namespaces cannot be altered")

    def list_namespaces(self, parent: str | None = None, like: str | None = None) -> list[str]:
        parts = self.split(parent) if parent else ()
        if parts and not self.namespace_exists(parts):
            raise NoSuchNamespace(parent)
        found = [n for n, _, folder, _ in self.files.list(self._folder(parts)) if folder and self.files.exists(f"{self._folder(parts)}/{n}/_namespace.json")]
        if self.single_level and not parts:
            found.append("default")
        return sorted(".".join((*parts, n)) for n in found if like is None or fnmatchcase(n, like.replace("%", "*")))

    # --- tables

    def table_exists(self, identifier: str | tuple[str, ...]) -> bool:
        parts = self.split(identifier)
        return Table(self.spark, parts[-1]).log.exists() if is_path(parts[-1]) else self.files.exists(self._pointer(parts))

    def location(self, identifier: str | tuple[str, ...]) -> str:
        parts = self.split(identifier)
        if is_path(parts[-1]):
            return parts[-1]
        if not self.files.exists(self._pointer(parts)):
            raise NoSuchTable(".".join(parts))
        return json.loads(self.files.read(self._pointer(parts)))["location"]

    def table(self, identifier: str | tuple[str, ...]) -> Table:
        return Table.open(self.spark, self.location(identifier))

    def _register(self, parts: tuple[str, ...], location: str) -> None:
        if len(parts) > 1 and not self.namespace_exists(parts[:-1]):
            raise NoSuchNamespace(".".join(parts[:-1]))
        if not self.files.create(self._pointer(parts), json.dumps({"location": location})):
            raise TableAlreadyExists(".".join(parts))

    def _default_location(self, parts: tuple[str, ...]) -> str:
        """A free folder beside the pointer: data of a dropped table of the name may still lie in the plain one."""
        base, n = f"{self._folder(parts[:-1])}/{parts[-1]}.data", 0
        while self.files.exists(base if not n else f"{base}.{n}"):
            n += 1
        return base if not n else f"{base}.{n}"

    def create_table(self, identifier: str, schema, properties: dict[str, str] | None = None, location: str | None = None, if_not_exists: bool = False, replace: bool = False) -> Table:
        """A managed table; with ``location`` an external one, which must be there: its own schema holds."""
        parts = self.split(identifier)
        if self.table_exists(parts):
            if if_not_exists:
                return self.table(parts)
            if not replace:
                raise TableAlreadyExists(identifier)
            return Table.create(self.spark, self.location(parts), schema, {**self.defaults, **(properties or {})}, True)
        if location is not None:
            table = Table.open(self.spark, location)
            self._register(parts, table.root)
            return table
        if is_path(parts[-1]):
            return Table.create(self.spark, parts[-1], schema, {**self.defaults, **(properties or {})})
        if len(parts) > 1 and not self.namespace_exists(parts[:-1]):
            raise NoSuchNamespace(".".join(parts[:-1]))
        where = self._default_location(parts)
        table = Table.create(self.spark, where, schema, {**self.defaults, **(properties or {})})
        self._register(parts, where)
        return table

    def create_table_as(self, identifier: str, df: DataFrame, properties: dict[str, str] | None = None, replace: bool = False, or_create: bool = True) -> Table:
        """CTAS, and with ``replace`` RTAS: readers see the old table or all of the new one."""
        parts = self.split(identifier)
        if self.table_exists(parts):
            if not replace:
                raise TableAlreadyExists(identifier)
            table = self.table(parts)
            table.replace_with(df, {**self.defaults, **(properties or {})})
            return table
        if replace and not or_create:
            raise NoSuchTable(identifier)
        from .table import write

        where = parts[-1] if is_path(parts[-1]) else self._default_location(parts)
        table = write(df, where, "error", {**self.defaults, **(properties or {})})
        if not is_path(parts[-1]):
            self._register(parts, where)
        return table

    def drop_table(self, identifier: str, purge: bool = False, if_exists: bool = False) -> bool:
        """Forgets a table and keeps its data; a table of a path, and any with ``purge``, loses the data too."""
        parts = self.split(identifier)
        if not self.table_exists(parts):
            if if_exists:
                return False
            raise NoSuchTable(identifier)
        where = self.location(parts)
        if is_path(parts[-1]):
            if not Table(self.spark, where).log.exists():
                raise NoSuchTable(identifier)
            self.files.delete(where)
            return True
        if purge and not self._own(where):
            raise InvalidArgument(f"{where} is outside of the catalog")
        self.files.delete(self._pointer(parts))
        if purge:
            self.files.delete(where)
        return True

    def rename_table(self, *_) -> None:
        raise Unsupported("tables cannot be renamed")

    def alter_table(self, *_) -> None:
        raise Unsupported("only ADD COLUMNS FROM, UPDATE COLUMNS FROM and indexes alter a table")

    def list_tables(self, namespace: str | None = None) -> list[str]:
        parts = self.split(namespace) if namespace else ()
        if parts and not self.namespace_exists(parts):
            raise NoSuchNamespace(namespace)
        if self.single_level and parts == ("default",):
            parts = ()
        return [n.removesuffix(".table.json") for n, *_ in self.files.list(self._folder(parts)) if n.endswith(".table.json") and not n.startswith(".")]

    def functions(self) -> list[str]:
        return ["fragment_or_rand"]

    def function(self, name: str):
        from ..functions.scalar import fragment_or_rand

        if name not in self.functions():
            raise InvalidArgument(f"no function {name}")
        return fragment_or_rand
