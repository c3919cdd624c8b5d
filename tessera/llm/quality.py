"""Quality rules whose cutoffs are chosen under a guarantee on false rejections, in DataFrame functions only.

Each rule rejects documents of a value above a cutoff. Cutoffs stand on a grid that is fixed in advance, so every
labelled document serves as holdout. A cutoff is certified in a stratum if the exact binomial test refutes "it rejects
more than ``alpha`` of the good documents": P(Bin(n, alpha) <= k) <= level, for k rejections among n good ones. The grid
is gone through from the laxest cutoff down to the first that fails, which costs no correction; the level is ``delta``
divided by the number of (stratum, rule) pairs, a Bonferroni correction. The last cutoff passed is used; a stratum in
which none passes has no such rule. So with probability 1 - delta no rule rejects over ``alpha`` of the good documents
of any stratum. At the defaults and twenty pairs a stratum needs 197 good documents for its first cutoff.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut, let, sized


@dataclass(frozen=True)
class QualityParams:
    alpha: float = 0.03
    delta: float = 0.05
    #: per thousand of the rule's denominator
    grid: tuple[int, ...] = (5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000, 1500, 2000, 3000)


#: Rule: its value in thousandths, a whole number, of the metrics below.
RULES = {
    "symbols": "1000 * n_symbols div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "long_words": "100 * word_chars div greatest(n_words, 1)",
    "short_words": "1000 * n_words div greatest(word_chars, 1)",
}


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more. Windows are compared by 64-bit hashes of one text."""
    at = lambda i, j: F.get(w, i + F.lit(j))
    marks = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, lambda e, k: F.coalesce((F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]), F.get(s, k - 1)["h"] == e["h"], F.get(s, k + 1)["h"] == e["h"])), lambda e: e["i"])))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + F.least(F.lit(3), p + 3 - a["end"])).alias("n"))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), F.aggregate(places, zero, step, lambda a: a["n"])).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(w) >= 4, let(marks, covered)).otherwise(F.lit(0).cast("long"))


def metrics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``doc_id, stratum`` and the numbers the rules are made of, for every row of ``docs``; null text counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    both = let(w, lambda x: F.struct(F.size(x).cast("long").alias("n_words"), _repeat_words(x).alias("n_repeat_words")))
    counted = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        both.alias("x"),
        counted.alias("y"),
    ).select("doc_id", "stratum", "word_chars", "n_symbols", "x.*", "y.*")
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series at n + 9; absolute error under 1e-12."""
    n = n.cast("double")
    x = n + 9
    series = (x - 0.5) * F.log(x) - x + F.lit(0.9189385332046727) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    for j in range(1, 9):
        series = series - F.log(n + j)
    return series


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact in doubles where it matters: 1 from the mean on. Terms are added downwards from k."""
    k, n = k.cast("long"), n.cast("long")
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    terms = F.least(k, F.ceil(F.sqrt(n * F.lit(p)) * 20) + 100)
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    step = lambda a, i: F.struct((a["t"] * (k - i) / (n - k + i + 1) * F.lit((1 - p) / p)).alias("t"), (a["s"] + a["t"]).alias("s"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), terms), zero, step, lambda a: a["s"])
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(F.exp(top) * total)


def thresholds(measured: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``stratum, rule, cutoff, n_good, n_rejected, p_value`` of the certified rules.

    A holdout is a document, not a row: rows of one doc_id count once a stratum, by the largest value of each rule.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = measured.where("not base_failed").join(good, "doc_id").groupBy("stratum", "doc_id").agg(*[F.max(F.expr(v)).alias(r) for r, v in RULES.items()])
    values = held.select("stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("v")) for r in RULES])).alias("x")).select("stratum", "x.*")
    # of each value only its place on the grid matters: the number of cutoffs it exceeds
    cuts = F.array(*[F.lit(c) for c in params.grid])
    over = values.groupBy("stratum", "rule", F.size(F.filter(cuts, lambda c: F.col("v") > c)).alias("over")).agg(F.count(F.lit(1)).alias("m"))
    per = over.groupBy("stratum", "rule").agg(F.collect_list(F.struct("over", "m")).alias("bars"), F.sum("m").alias("n"))  # len(grid) + 1 bars at most
    tests = per.select("stratum", "rule", "n", F.posexplode(cuts).alias("pos", "cutoff"), "bars").withColumn("k", F.aggregate("bars", F.lit(0).cast("long"), lambda a, b: a + F.when(b["over"] > F.col("pos"), b["m"]).otherwise(0)))
    tests = tests.select("stratum", "rule", "cutoff", "n", "k", binomial_tail(F.col("k"), F.col("n"), params.alpha).alias("p_value"))
    families = max(1, per.count())
    level = params.delta / families
    seen = tests.groupBy("stratum", "rule").agg(F.max(F.when(F.col("p_value") > level, F.col("cutoff"))).alias("failed"))
    passed = tests.join(seen, ["stratum", "rule"]).where(F.col("failed").isNull() | (F.col("cutoff") > F.col("failed")))
    return passed.groupBy("stratum", "rule").agg(F.min_by(F.struct("cutoff", F.col("n").alias("n_good"), F.col("k").alias("n_rejected"), "p_value"), "cutoff").alias("x")).select("stratum", "rule", "x.*")


def judge(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), stratum: str = "lang") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` for every row of ``docs``.

    Null text counts as empty, so it has no words and fails the base. Null strata are one stratum, together with the
    empty one. Labels of null doc_id or quality are ignored and repeated ones count once; a document that is labelled
    both ways counts as good. Without labels no rule is certified and the base alone decides. Repeated rows are answered
    each, and are one holdout. A value equal to a cutoff stays. Texts are read whole, however long; other columns,
    whatever their names, are not read. An empty table gives no rows.
    """
    with Scratch(docs.sparkSession, "quality") as scratch:
        measured = scratch.save(metrics(docs, stratum), "metrics")
        found = cut(thresholds(measured, labels, params).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))
        rows = measured.join(sized(found), "stratum", "left")
        fails = F.lit(False)
        for rule, value in RULES.items():
            fails = fails | F.coalesce(F.expr(value) > F.col("cutoffs")[rule], F.lit(False))
        kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~fails)
        return cut(rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept")))
