"""Projection, join, aggregation, window, sort, set and scalar-function queries in DataFrame operations.

Sums of doubles are rounded, since their order differs between engines, and every limit has a total order.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import query

_money = lambda c: F.round(F.sum(c), 2)
_day = lambda s: F.lit(s).cast("timestamp_ntz")


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
 round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_quantity), 4) AS avg_qty, count(*) AS count_order
 FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(t):
    rows = t.lineitem.where(F.col("l_shipdate") <= _day("1998-09-02"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        _money("l_quantity").alias("sum_qty"),
        _money("l_extendedprice").alias("sum_base_price"),
        _money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
        F.count("*").alias("count_order"),
    )


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def scan_project(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))


@query("SELECT count(*) AS n FROM (SELECT 1 FROM lineitem)")
def scan_zero_columns(t):
    return t.lineitem.select().agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45 AND l_discount <= 0.03 AND l_linenumber <> 2 AND l_tax >= 0.02")
def filter_compare(t):
    return t.lineitem.where("l_quantity > 45 AND l_discount <= 0.03 AND l_linenumber <> 2 AND l_tax >= 0.02").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F')")
def filter_in(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_orderstatus").isin("F")).select("o_orderkey")


@query("SELECT o_orderkey, c_custkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000 WHERE c_custkey IS NULL OR c_name IS NOT NULL")
def filter_null(t):
    rich = t.customer.where("c_acctbal > 5000")
    joined = t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.where(F.col("c_custkey").isNull() | F.col("c_name").isNotNull()).select("o_orderkey", "c_custkey")


@query("SELECT p_partkey FROM part WHERE (p_size BETWEEN 5 AND 15 OR p_retailprice > 1500) AND NOT (p_brand = 'Brand#11')")
def filter_bool(t):
    return t.part.where((F.col("p_size").between(5, 15) | (F.col("p_retailprice") > 1500)) & ~(F.col("p_brand") == "Brand#11")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_type LIKE 'S%' OR p_name LIKE '%a' OR p_brand LIKE '%2%'")
def filter_like(t):
    return t.part.where(F.col("p_type").like("S%") | F.col("p_name").like("%a") | F.col("p_brand").like("%2%")).select("p_partkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IS NOT DISTINCT FROM 'O'")
def filter_null_safe(t):
    return t.orders.where(F.col("o_orderstatus").eqNullSafe("O")).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-06-30'")
def filter_dates(t):
    return t.orders.where(F.col("o_orderdate").between(_day("1995-01-01"), _day("1996-06-30"))).select("o_orderkey")


@query("SELECT count(*) AS n FROM orders WHERE o_totalprice > 1000")
def filter_nondeterministic(t):
    """A predicate that no source can take stays in Spark; here it lets every row pass."""
    return t.orders.where((F.rand(42) < 1.0) & (F.col("o_totalprice") > 1000)).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def drop_columns(t):
    return t.customer.drop("c_acctbal", "c_name")


@query("""WITH r AS (SELECT l_orderkey AS k, sum(l_quantity) AS q FROM lineitem GROUP BY l_orderkey)
 SELECT a.k, round(a.q, 2) AS q FROM r a JOIN (SELECT avg(q) AS m FROM r) b ON a.q > 2 * b.m""")
def cte_reused(t):
    r = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("q"))
    return r.join(F.broadcast(r.agg(F.avg("q").alias("m"))), F.col("q") > 2 * F.col("m")).select("k", F.round("q", 2).alias("q"))


@query("""SELECT n_name, s FROM (SELECT n_name, sum(c_acctbal) AS s0, round(sum(c_acctbal), 2) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) WHERE s0 > 0""")
def derived_table(t):
    inner = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.sum("c_acctbal").alias("s0"), _money("c_acctbal").alias("s"))
    return inner.where("s0 > 0").select("n_name", "s")


# --- joins -------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 200000")
def join_inner(t):
    big = t.orders.where("o_totalprice > 200000")
    return big.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("SELECT r_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def join_broadcast(t):
    """Nation and region have 25 and 5 rows at any scale."""
    places = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def join_left(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_outer").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("""SELECT coalesce(a.k, b.k) AS k, a.n AS n_cust, b.n AS n_supp FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) a
 FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.k = b.k""")
def join_full(t):
    a = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_cust"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_supp"))
    return a.join(b, "k", "full_outer")


@query("SELECT n_name, s_suppkey FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > 8000")
def join_right(t):
    return t.supplier.where("s_acctbal > 8000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right_outer").select("n_name", "s_suppkey")


@query("""SELECT a.n AS n_low, b.n AS n_high FROM (SELECT count(*) AS n FROM lineitem WHERE l_quantity < 10) a CROSS JOIN (SELECT count(*) AS n FROM lineitem WHERE l_quantity >= 40) b""")
def join_cross_scalars(t):
    """One row on each side; one pass over the table gives both."""
    return t.lineitem.agg(F.count_if(F.col("l_quantity") < 10).alias("n_low"), F.count_if(F.col("l_quantity") >= 40).alias("n_high"))


@query("SELECT o_orderkey, l_linenumber FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate > o_orderdate AND l_extendedprice * 3 > o_totalprice")
def join_theta(t):
    on = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate")) & (F.col("l_extendedprice") * 3 > F.col("o_totalprice"))
    return t.orders.join(t.lineitem, on).select("o_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)")
def join_semi(t):
    return t.orders.join(t.lineitem.where("l_quantity > 49"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def join_in_subquery(t):
    return t.sql("SELECT c_custkey FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_totalprice > 300000)", "customer", "orders")


@query("SELECT a.l_orderkey, a.l_linenumber FROM lineitem a WHERE EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_suppkey <> a.l_suppkey AND b.l_quantity > 48)")
def join_semi_noneq(t):
    a, b = t.lineitem.alias("a"), t.lineitem.where("l_quantity > 48").alias("b")
    on = (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_suppkey") != F.col("b.l_suppkey"))
    return a.join(b, on, "left_semi").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


_EXISTENCE = """SELECT c_custkey FROM {customer} c WHERE c_acctbal > 9500
 OR EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000)
 OR c_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = 1)"""


@query(_EXISTENCE.replace("{", "").replace("}", ""))
def join_existence_or(t):
    return t.sql(_EXISTENCE, "customer", "orders", "nation")


@query("""WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT m, n, rank() OVER (ORDER BY m) AS k FROM m)
 SELECT a.k::BIGINT AS k, a.n, b.n AS previous, c.n AS next FROM r a JOIN r b ON b.k = a.k - 1 JOIN r c ON c.k = a.k + 1""")
def join_self_rank(t):
    months = t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.count("*").alias("n"))  # months, not orders, are ranked
    r = months.select("n", F.rank().over(Window.orderBy("m")).cast("bigint").alias("k"))
    before, after = r.select((F.col("k") + 1).alias("k"), F.col("n").alias("previous")), r.select((F.col("k") - 1).alias("k"), F.col("n").alias("next"))
    return r.join(before, "k").join(after, "k").select("k", "n", "previous", "next")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem a WHERE l_quantity > 1.9 * (SELECT avg(l_quantity) FROM lineitem b WHERE b.l_partkey = a.l_partkey)""")
def subquery_scalar_correlated(t):
    means = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("m"))
    return t.lineitem.join(means, "l_partkey").where(F.col("l_quantity") > 1.9 * F.col("m")).select("l_orderkey", "l_linenumber")


_UNCORRELATED = "SELECT o_custkey, count(*) AS n FROM {orders} WHERE o_totalprice > (SELECT avg(o_totalprice) FROM {orders}) GROUP BY o_custkey HAVING count(*) > (SELECT min(n) + 4 FROM (SELECT count(*) AS n FROM {orders} GROUP BY o_custkey) x)"


@query(_UNCORRELATED.replace("{", "").replace("}", ""))
def subquery_scalar_uncorrelated(t):
    return t.sql(_UNCORRELATED, "orders")


_CASE = "SELECT CASE WHEN (SELECT count(*) FROM {lineitem} WHERE l_quantity > 25) > 1000 THEN (SELECT round(avg(l_discount), 6) FROM {lineitem}) ELSE (SELECT round(avg(l_tax), 6) FROM {lineitem}) END AS bucket"


@query(_CASE.replace("{", "").replace("}", ""))
def subquery_in_case(t):
    return t.sql(_CASE, "lineitem")


# --- aggregation -------------------------------------------------------------------------------------------------


@query("SELECT count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, round(sum(l_tax), 2) AS tax, round(avg(l_discount), 6) AS discount, min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem")
def agg_global(t):
    return t.lineitem.agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), _money("l_tax").alias("tax"), F.round(F.avg("l_discount"), 6).alias("discount"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"))


@query("SELECT year(l_shipdate)::INT AS y, l_returnflag, count(*) AS n, count(l_tax) AS n_tax, min(l_shipdate) AS first FROM lineitem GROUP BY 1, 2")
def agg_group(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("y"), "l_returnflag").agg(F.count("*").alias("n"), F.count("l_tax").alias("n_tax"), F.min("l_shipdate").alias("first"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) BETWEEN 500 AND 620")
def agg_having(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).where("n BETWEEN 500 AND 620")


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag")
def agg_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def select_distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("SELECT l_linestatus, round(stddev_samp(l_quantity), 6) AS deviation, round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS variation FROM lineitem GROUP BY l_linestatus")
def agg_stddev(t):
    d = F.stddev_samp("l_quantity")
    return t.lineitem.groupBy("l_linestatus").agg(F.round(d, 6).alias("deviation"), F.round(d / F.avg("l_quantity"), 6).alias("variation"))


@query("""SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 2) AS returned, round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS accepted,
 round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS ratio FROM lineitem GROUP BY l_suppkey""")
def agg_conditional(t):
    part = lambda flag: F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))
    returned = F.sum(part("R").otherwise(0))
    return t.lineitem.groupBy("l_suppkey").agg(F.round(returned, 2).alias("returned"), _money(part("A")).alias("accepted"), F.round(returned / F.sum("l_quantity"), 6).alias("ratio"))


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority")
def agg_pivot(t):
    wide = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    return wide.select("o_orderpriority", *[F.col(c).alias(c.lower()) for c in "FOP"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag)::BIGINT AS g1, grouping(l_linestatus)::BIGINT AS g2 FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def agg_cube(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping("l_returnflag").cast("bigint").alias("g1"), F.grouping("l_linestatus").cast("bigint").alias("g2"))


_SETS = "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"


@query(_SETS.replace("{", "").replace("}", ""))
def agg_grouping_sets(t):
    return t.sql(_SETS, "orders")


@query("""SELECT coalesce(r_name, 'all') AS r, coalesce(n_name, 'all') AS n, (grouping(r_name) + grouping(n_name))::BIGINT AS level, round(sum(c_acctbal), 2) AS total
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def agg_grouping_level(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).rollup("r_name", "n_name")
    out = rows.agg((F.grouping("r_name") + F.grouping("n_name")).cast("bigint").alias("level"), _money("c_acctbal").alias("total"))
    return out.select(F.coalesce("r_name", F.lit("all")).alias("r"), F.coalesce("n_name", F.lit("all")).alias("n"), "level", "total")


# --- windows -----------------------------------------------------------------------------------------------------


@query("SELECT * FROM (SELECT c_custkey, c_nationkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)::BIGINT AS rk FROM customer) WHERE rk <= 3")
def win_rank(t):
    """Spark keeps three rows a group on the map side already (WindowGroupLimit)."""
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))
    return t.customer.select("c_custkey", "c_nationkey", F.rank().over(w).cast("bigint").alias("rk")).where("rk <= 3")


@query("""SELECT l_returnflag, l_linenumber, round(s, 2) AS s, round(s * 100 / sum(s) OVER (PARTITION BY l_returnflag), 4) AS share FROM (SELECT l_returnflag, l_linenumber, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1, 2)""")
def win_ratio(t):
    s = t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(F.sum("l_extendedprice").alias("s"))
    return s.select("l_returnflag", "l_linenumber", F.round("s", 2).alias("s"), F.round(F.col("s") * 100 / F.sum("s").over(Window.partitionBy("l_returnflag")), 4).alias("share"))


@query("""SELECT y, l_returnflag, round(s, 2) AS s, round(avg(s) OVER (PARTITION BY l_returnflag), 2) AS mean FROM (SELECT year(l_shipdate)::INT AS y, l_returnflag, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2)""")
def win_avg(t):
    s = t.lineitem.groupBy(F.year("l_shipdate").alias("y"), "l_returnflag").agg(F.sum("l_quantity").alias("s"))
    return s.select("y", "l_returnflag", F.round("s", 2).alias("s"), F.round(F.avg("s").over(Window.partitionBy("l_returnflag")), 2).alias("mean"))


@query("""SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER w, 2) AS running, round(max(o_totalprice) OVER w, 2) AS most FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""")
def win_running(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return t.orders.select("o_custkey", "o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("running"), F.round(F.max("o_totalprice").over(w), 2).alias("most"))


@query("""SELECT l_returnflag, l_linestatus, n, level, rank() OVER (PARTITION BY level, CASE WHEN level = 0 THEN l_returnflag END ORDER BY n DESC)::BIGINT AS rk FROM (
 SELECT l_returnflag, l_linestatus, count(*) AS n, (grouping(l_returnflag) + grouping(l_linestatus))::BIGINT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus))""")
def win_grouping(t):
    g = t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), (F.grouping("l_returnflag") + F.grouping("l_linestatus")).cast("bigint").alias("level"))
    w = Window.partitionBy("level", F.when(F.col("level") == 0, F.col("l_returnflag"))).orderBy(F.desc("n"))
    return g.withColumn("rk", F.rank().over(w).cast("bigint"))


@query("""SELECT o_orderkey, row_number() OVER w AS rn, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority)::BIGINT AS dr, ntile(3) OVER w AS nt FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def win_rownum(t):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    dense = F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderpriority"))
    return t.orders.select("o_orderkey", F.row_number().over(w).cast("bigint").alias("rn"), dense.cast("bigint").alias("dr"), F.ntile(3).over(w).cast("bigint").alias("nt"))


@query("""SELECT event_id, user_id, lag(event_id) OVER w AS previous, lead(event_id) OVER w AS next, first_value(event_id) OVER w AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", "user_id", F.lag("event_id").over(w).alias("previous"), F.lead("event_id").over(w).alias("next"), F.first("event_id").over(w).alias("first"))


@query("""SELECT p_partkey, round(avg(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING), 4) AS near FROM part""")
def win_range(t):
    w = Window.partitionBy("p_brand").orderBy("p_size").rangeBetween(-2, 2)
    return t.part.select("p_partkey", F.round(F.avg("p_retailprice").over(w), 4).alias("near"))


# --- sort, limit, sets -------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 ORDER BY o_orderkey NULLS FIRST, c_custkey DESC LIMIT 30")
def order_nulls(t):
    joined = t.customer.join(t.orders.where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.orderBy(F.col("o_orderkey").asc_nulls_first(), F.desc("c_custkey")).limit(30).select("c_custkey", "o_orderkey")


@query("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 25")
def limit_offset(t):
    return t.customer.orderBy("c_custkey").offset(25).limit(10).select("c_custkey")


@query("SELECT p_partkey, p_size FROM part ORDER BY CASE WHEN p_size > 40 THEN 0 ELSE 1 END, p_size % 7 DESC, p_partkey LIMIT 15")
def order_expression(t):
    return t.part.orderBy(F.when(F.col("p_size") > 40, 0).otherwise(1), F.desc(F.col("p_size") % 7), "p_partkey").limit(15).select("p_partkey", "p_size")


@query("SELECT 'c' AS kind, c_nationkey AS k FROM customer UNION ALL SELECT 's', s_nationkey FROM supplier")
def union_all(t):
    return t.customer.select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("k")).unionAll(t.supplier.select(F.lit("s"), "s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def intersect(t):
    return t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(t.supplier.where("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 6000 EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900")
def except_distinct(t):
    keys = t.nation.select(F.col("n_nationkey").alias("k"))
    return keys.subtract(t.supplier.where("s_acctbal > 6000").select("s_nationkey")).subtract(t.customer.where("c_acctbal > 9900").select("c_nationkey"))


# --- scalar functions --------------------------------------------------------------------------------------------


@query("SELECT p_partkey, substr(p_name, 2, 4) AS part_of, concat(p_brand, '-', p_type) AS label, upper(p_name) AS up, lower(p_brand) AS low, p_brand || '/' || p_size AS slash FROM part")
def fn_string(t):
    c = F.col
    return t.part.select("p_partkey", F.substring("p_name", 2, 4).alias("part_of"), F.concat("p_brand", F.lit("-"), "p_type").alias("label"), F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.concat(c("p_brand"), F.lit("/"), c("p_size").cast("string")).alias("slash"))


@query("SELECT c_custkey, round(c_acctbal, 1) AS r, abs(c_acctbal) AS a, c_custkey % 7 AS m, c_acctbal * 2 / nullif(c_nationkey, 0) AS q FROM customer")
def fn_math(t):
    return t.customer.select("c_custkey", F.round("c_acctbal", 1).alias("r"), F.abs("c_acctbal").alias("a"), (F.col("c_custkey") % 7).alias("m"), F.try_divide(F.col("c_acctbal") * 2, F.col("c_nationkey")).alias("q"))


@query("""SELECT o_orderkey, (o_orderdate::DATE + 30)::DATE AS due, (o_orderdate::DATE - 5)::DATE AS before, year(o_orderdate)::INT AS y, o_orderdate::DATE AS d FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'""")
def fn_date(t):
    d = F.to_date("o_orderdate")
    rows = t.orders.where(F.col("o_orderdate").between(_day("1995-01-01"), _day("1995-03-31 23:59:59.999999")))  # on the column itself, so that it reaches the scan
    return rows.select("o_orderkey", F.date_add(d, 30).alias("due"), F.date_add(d, -5).alias("before"), F.year("o_orderdate").alias("y"), d.alias("d"))


@query("SELECT coalesce(c_name, 'none') AS name, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'much' END AS class, n_name IS NULL AS missing FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey > 1")
def fn_conditional(t):
    rows = t.customer.join(F.broadcast(t.nation.where("n_regionkey > 1")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    group = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "some").otherwise("much")
    return rows.select(F.coalesce("c_name", F.lit("none")).alias("name"), group.alias("class"), F.col("n_name").isNull().alias("missing"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(15, 2)) AS VARCHAR) AS price, CAST(l_quantity AS INT) AS q FROM lineitem")
def fn_cast_decimal(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(15,2)").cast("string").alias("price"), F.col("l_quantity").cast("int").alias("q"))


@query("SELECT vec_id, len(embedding)::INT AS n, round(list_max(embedding)::DOUBLE, 6) AS most, round(list_max(list_transform(embedding, lambda x: x * 2))::DOUBLE, 6) AS doubled, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings")
def fn_array(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.size(e).alias("n"), F.round(F.array_max(e).cast("double"), 6).alias("most"), F.round(F.array_max(F.transform(e, lambda x: x * 2)).cast("double"), 6).alias("doubled"), F.round(e[0].cast("double"), 6).alias("first"))


@query("SELECT s.b.name AS name, s.k AS k FROM (SELECT {'k': c_custkey, 'b': {'name': c_name, 'seg': c_mktsegment}} AS s FROM customer)")
def fn_struct(t):
    s = F.struct(F.col("c_custkey").alias("k"), F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")).alias("b")).alias("s")
    return t.customer.select(s).select("s.b.name", "s.k")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT (l_orderkey >> 3) AS hi, (l_orderkey & 7) AS lo, count(*) AS n FROM lineitem GROUP BY 1, 2")
def fn_bits(t):
    return t.lineitem.groupBy(F.shiftright("l_orderkey", 3).alias("hi"), F.col("l_orderkey").bitwiseAND(7).alias("lo")).agg(F.count("*").alias("n"))


@query("SELECT k, map_extract(m, 'a')[1] AS a, cardinality(m)::INT AS n FROM (SELECT c_custkey AS k, MAP {'a': c_nationkey, 'b': 2} AS m FROM customer)")
def fn_map(t):
    m = F.create_map(F.lit("a"), F.col("c_nationkey"), F.lit("b"), F.lit(2))
    return t.customer.select(F.col("c_custkey").alias("k"), m.alias("m")).select("k", F.col("m")["a"].alias("a"), F.size("m").alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT b) <= 4 AS few FROM (SELECT c_custkey, c_custkey % 4 AS b FROM customer)")
def fn_hash(t):
    """Spark's hash() spreads keys; its values are its own, so only what must hold is returned."""
    h = F.pmod(F.hash("c_custkey"), F.lit(4))
    return t.customer.select(h.alias("b")).agg(F.count("*").alias("n"), (F.count_distinct("b") <= 4).alias("few"))
