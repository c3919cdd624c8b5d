"""Small tables for the tests of training-data operators."""

CLASHING = {"key": "k", "w": 1, "n": 2, "component": 3, "rep": 4, "host": "h", "stratum": "s", "spans": "x", "n_lines": 5, "depth": 6, "shard": "y", "h": 7, "id": 8, "n_words": 9, "score": 0.5, "rank": 1, "part": 2, "chunk": 3, "mark": 4, "quality": 0}


def make(spark, rows, extra=True):
    """``documents`` of ``(doc_id, text, lang, source)``, with columns of names that operators use inside."""
    cols = CLASHING if extra else {}
    kinds = {str: "string", int: "long", float: "double"}
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} {kinds[type(v)]}" for c, v in cols.items())
    return spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None, *cols.values()) for i, t, lang, s in rows], schema)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]
