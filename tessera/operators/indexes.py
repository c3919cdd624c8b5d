"""Indexes: zone maps (btree) and inverted lists (fts), as Parquet folders that cover a set of fragments."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument, Unsupported
from ..functions.scalar import fragment_of, row_of
from ..sources.manifest import Index
from ..sources.table import Table

METHODS = ("btree", "fts")
FTS_DEFAULTS = {"base_tokenizer": "simple", "language": "English", "max_token_length": 40, "lower_case": True, "stem": False, "remove_stop_words": False, "ascii_folding": False, "with_position": False, "min_ngram": 3, "max_ngram": 3}
#: The commonest function words of English.
STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
#: Latin letters with marks and the plain letters they fold to.
_MARKED, _PLAIN = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇ", "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYNC"


def fts_options(options: dict | None) -> dict:
    out = dict(FTS_DEFAULTS)
    for k, v in (options or {}).items():
        k = k.lower()
        if k not in FTS_DEFAULTS:
            raise InvalidArgument(f"unknown option {k}")
        kind = type(FTS_DEFAULTS[k])
        out[k] = str(v).lower() == "true" if kind is bool else kind(v)
    if out["base_tokenizer"] not in ("simple", "whitespace", "ngram"):
        raise InvalidArgument(f"unknown tokenizer {out['base_tokenizer']}")
    if out["stem"]:
        raise Unsupported("stemming: Spark has no stemmer")
    return out


def tokens(text: Column, options: dict) -> Column:
    """The tokens of a text as an array, in order; null text has none."""
    c = F.coalesce(text.cast("string"), F.lit(""))
    if options["lower_case"]:
        c = F.lower(c)
    if options["ascii_folding"]:
        c = F.translate(c, _MARKED, _PLAIN)
    if options["base_tokenizer"] == "ngram":
        grams = [F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i, n=n: F.substr(c, i, F.lit(n))) for n in range(options["min_ngram"], options["max_ngram"] + 1)]
        made = [F.when(F.length(c) >= n, g).otherwise(F.array().cast("array<string>")) for n, g in zip(range(options["min_ngram"], options["max_ngram"] + 1), grams, strict=True)]
        found = made[0] if len(made) == 1 else F.concat(*made)
    else:
        found = F.split(c, r"\s+" if options["base_tokenizer"] == "whitespace" else r"[^\p{L}\p{N}]+")
    found = F.filter(found, lambda x: (F.length(x) > 0) & (F.length(x) <= options["max_token_length"]))
    if options["remove_stop_words"]:
        found = F.filter(found, lambda x: ~x.isin(*STOP_WORDS))
    return found


def create_index(table: Table, name: str, method: str, columns: list[str], options: dict | None = None) -> DataFrame:
    """Builds an index over all present fragments, and replaces one of the name: ``fragments_indexed, index_name``.

    btree: per zone of ``zone_size`` rows the least and greatest value and the nulls of the column, one grouped pass.
    fts: ``token, _rowaddr, n, places``, in ranges of token and address, so that a search reads few files' row groups.
    """
    method = method.lower()
    if method not in METHODS:
        raise Unsupported(f"index method {method}")
    m = table.manifest()
    for c in columns:
        if c not in m.struct.names:
            raise InvalidArgument(f"no column {c}")
    if not columns or method == "fts" and len(columns) != 1:
        raise InvalidArgument("an index needs a column; a text index exactly one")
    out = "fragments_indexed bigint, index_name string"
    if not m.fragments:
        return table.spark.createDataFrame([(0, name)], out)
    path = f"indexes/{uuid.uuid4().hex}"
    rows = table.df(version=m.version, metadata=True)
    if method == "btree":
        options = {"zone_size": int((options or {}).get("zone_size", 8192))}
        if options["zone_size"] <= 0:
            raise InvalidArgument("zone_size must be positive")
        zone = F.floor(row_of("_rowaddr") / options["zone_size"]).cast("bigint")
        stats = [x for c in columns for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))]
        rows.groupBy(F.col("_fragid").alias("fragment"), zone.alias("zone")).agg(*stats, F.count(F.lit(1)).alias("rows")).write.parquet(f"{table.root}/{path}")
    else:
        options = fts_options(options)
        text = m.struct[columns[0]]
        if not isinstance(text.dataType, T.StringType):
            raise InvalidArgument(f"{columns[0]} is no text")
        listed = rows.select("_rowaddr", F.posexplode(tokens(F.col(columns[0]), options)).alias("place", "token"))
        lists = listed.groupBy("token", "_rowaddr").agg(F.count(F.lit(1)).alias("n"), *([F.sort_array(F.collect_list("place")).alias("places")] if options["with_position"] else []))
        # by token and address: the rows of a common word are split over tasks
        lists.repartitionByRange("token", "_rowaddr").sortWithinPartitions("token", "_rowaddr").write.parquet(f"{table.root}/{path}")
    made = Index(name, method, tuple(columns), options, path, tuple(f.id for f in m.fragments))
    table.log.publish(m, lambda x: replace(x, indexes=(*[i for i in x.indexes if i.name != name], made), operation="create_index"))
    return table.spark.createDataFrame([(len(made.fragments), name)], out)


def drop_index(table: Table, name: str) -> None:
    m = table.manifest()
    if all(i.name != name for i in m.indexes):
        raise InvalidArgument(f"no index {name}")
    table.log.publish(m, lambda x: replace(x, indexes=tuple(i for i in x.indexes if i.name != name), operation="drop_index"))


def show_indexes(table: Table) -> DataFrame:
    """``name, fields, index_type, num_indexed_fragments, num_indexed_rows, num_unindexed_fragments, num_unindexed_rows``."""
    m = table.manifest()
    rows = []
    for i in m.indexes:
        covered = set(i.fragments)
        inside = [f for f in m.fragments if f.id in covered]
        outside = [f for f in m.fragments if f.id not in covered]
        live = lambda fs: sum(f.rows - f.deleted for f in fs)
        rows.append((i.name, list(i.columns), i.method, len(inside), live(inside), len(outside), live(outside)))
    return table.spark.createDataFrame(rows, "name string, fields array<string>, index_type string, num_indexed_fragments bigint, num_indexed_rows bigint, num_unindexed_fragments bigint, num_unindexed_rows bigint")


def _index(table: Table, m, column: str, method: str) -> Index | None:
    return next((i for i in m.indexes if i.method == method and column in i.columns), None)


def zoned(table: Table, m, where: str) -> set[int] | None:
    """Fragments that can have rows for which a SQL condition holds, by the zone maps of its columns; None: any."""
    from ..plans.prune import bounds_of

    mapped = {c.lower(): (i, c) for i in m.indexes if i.method == "btree" for c in i.columns}
    if not any(c in where.lower() for c in mapped):
        return None
    own = {n.lower() for n in m.struct.names}
    kept = None
    for name, wanted in bounds_of(table.spark, where).items():
        if name[-1] not in mapped or len(name) > 2 or len(name) == 2 and name[0] in own:  # a field of a struct
            continue
        index, column = mapped[name[-1]]
        if isinstance(m.struct[column].dataType, T.StringType):  # other literals compare in another order
            wanted = [x for x in wanted if x[1].startswith("'")]
        zones = table.spark.read.parquet(f"{table.root}/{index.path}")
        for op, literal in wanted:
            if op in ("=", "<", "<="):
                zones = zones.where(F.expr(f"`min_{column}` {'<=' if op == '=' else op} {literal}"))
            if op in ("=", ">", ">="):
                zones = zones.where(F.expr(f"`max_{column}` {'>=' if op == '=' else op} {literal}"))
        found = {r[0] for r in zones.select("fragment").distinct().collect()}  # fragments, not rows
        covered = set(index.fragments)
        ids = {f.id for f in m.fragments if f.id in found or f.id not in covered}
        kept = ids if kept is None else kept & ids
    return kept


def lookup(table: Table, column: str, low=None, high=None, metadata: bool = False) -> DataFrame:
    """Rows with ``low <= column <= high`` (a bound that is None is open).

    A zone map keeps only fragments that have a zone meeting the range; fragments it does not cover are read too. Within
    a fragment, Parquet's own statistics serve. Without an index every fragment is read.
    """
    m = table.manifest()
    index = _index(table, m, column, "btree")
    kept = None
    if index:
        zones = table.spark.read.parquet(f"{table.root}/{index.path}")
        if low is not None:
            zones = zones.where(F.col(f"max_{column}") >= F.lit(low))
        if high is not None:
            zones = zones.where(F.col(f"min_{column}") <= F.lit(high))
        found = {r[0] for r in zones.select("fragment").distinct().collect()}  # fragments, not rows
        kept = [f.id for f in m.fragments if f.id in found or f.id not in set(index.fragments)]
    rows = table.df(version=m.version, metadata=metadata, fragments=kept)
    if low is not None:
        rows = rows.where(F.col(column) >= F.lit(low))
    if high is not None:
        rows = rows.where(F.col(column) <= F.lit(high))
    return rows


def search(table: Table, column: str, words: str, every: bool = True) -> DataFrame:
    """Rows whose text has every (or any) token of ``words``, with ``_rowaddr`` and ``_matches``, the tokens' occurrences.

    Uses the text index where it covers a fragment and scans the others with the same tokens. Needs an index.
    """
    m = table.manifest()
    index = _index(table, m, column, "fts")
    if index is None:
        raise InvalidArgument(f"no text index on {column}")
    options = fts_options(index.options)
    wanted = table.spark.range(1).select(F.array_distinct(tokens(F.lit(words), options))).first()[0]
    if not wanted:
        raise InvalidArgument("nothing to search for")
    lists = table.spark.read.parquet(f"{table.root}/{index.path}").where(F.col("token").isin(wanted)).select("_rowaddr", "token", "n")
    bare = [f.id for f in m.fragments if f.id not in set(index.fragments)]
    if bare:
        rest = table.df(version=m.version, metadata=True, fragments=bare)
        found = rest.select("_rowaddr", F.explode(tokens(F.col(column), options)).alias("token")).where(F.col("token").isin(wanted))
        lists = lists.unionByName(found.groupBy("_rowaddr", "token").agg(F.count(F.lit(1)).alias("n")))
    hits = lists.groupBy("_rowaddr").agg(F.count(F.lit(1)).alias("__k"), F.sum("n").alias("_matches")).where(F.col("__k") >= (len(wanted) if every else 1)).drop("__k")
    touched = [r[0] for r in hits.select(fragment_of("_rowaddr")).distinct().collect()]  # fragments, not rows
    rows = table.df(version=m.version, metadata=True, fragments=touched)
    return rows.join(hits, "_rowaddr").select(*m.struct.names, "_rowaddr", "_matches")
