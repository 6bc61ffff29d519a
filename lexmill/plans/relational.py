"""The generic relational layer over the order tables: joins of every kind, grouping sets, set operations, range joins, top-k."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.plans.catalog import query
from lexmill.scale import table


@query("""
    SELECT n_name, extract(year FROM o_orderdate) AS year, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
""")
def revenue_by_nation(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    # lines are added up per order before the wider joins
    per_order = li.groupBy("l_orderkey").agg(F.sum("r").alias("r"), F.count("*").alias("n"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("long").alias("year"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "year").agg(F.round(F.sum("r"), 2).alias("revenue"), F.sum("n").alias("lines"))


@query("""
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS price, round(avg(l_discount), 6) AS discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
""")
def pricing_summary(spark, d):
    return table(spark, d, "lineitem").filter("l_shipdate <= TIMESTAMP '1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"), F.round(F.sum("l_extendedprice"), 2).alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, grouping(o_orderpriority) AS g, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_orders(spark, d):
    return table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.grouping("o_orderpriority").cast("long").alias("g"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus, o_orderpriority) AS g, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def cube_orders(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))


@query("""
    SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS pending FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def semi_anti_customers(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey").join(o.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    p = o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("p", F.lit(True))
    return c.join(p, "c_custkey", "left").select("c_custkey", F.coalesce("p", F.lit(False)).alias("pending"))


@query("""
    WITH a AS (SELECT l_partkey AS k, sum(l_quantity) AS sold FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1), b AS (SELECT p_partkey AS k, p_retailprice AS price FROM part WHERE p_size <= 25)
    SELECT coalesce(a.k, b.k) AS partkey, sold, price FROM a FULL OUTER JOIN b ON a.k = b.k
""")
def full_outer_parts(spark, d):
    a = table(spark, d, "lineitem").filter("l_shipdate >= TIMESTAMP '1998-01-01'").groupBy(F.col("l_partkey").alias("partkey")).agg(F.sum("l_quantity").alias("sold"))
    b = table(spark, d, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("partkey"), F.col("p_retailprice").alias("price"))
    return a.join(b, "partkey", "full_outer")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("""
    SELECT 'both' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customers only', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'any', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
""")
def union_intersect_except(spark, d):
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    n = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return n(c.intersect(s), "both").union(n(c.subtract(s), "customers only")).union(n(c.union(s).distinct(), "any"))


@query("""
    SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) <= 300
""")
def range_band_join(spark, d):
    """A band join: the band is cut into buckets of its width, so only rows of equal or next bucket meet."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.floor(F.col("s_acctbal") / 300).alias("cell"))
    b = s.select(F.col("s_suppkey").alias("b"), "s_nationkey", F.col("s_acctbal").alias("bal"), F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    return s.withColumnRenamed("s_suppkey", "a").join(b, ["s_nationkey", "cell"]).filter((F.col("a") < F.col("b")) & (F.abs(F.col("s_acctbal") - F.col("bal")) <= 300)).select("a", "b")


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER w AS k, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running,
      round(o_totalprice - lag(o_totalprice) OVER w, 2) AS step, ntile(4) OVER w AS quarter FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
    SELECT * FROM r
""")
def windows_over_orders(spark, d):
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.row_number().over(w).alias("k"), F.round(F.sum("o_totalprice").over(w.rowsBetween(W.unboundedPreceding, 0)), 2).alias("running"), F.round(F.col("o_totalprice") - F.lag("o_totalprice").over(w), 2).alias("step"), F.ntile(4).over(w).alias("quarter")
    )


@query("""
    SELECT c_mktsegment, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS o, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS f, round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END), 2) AS p
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def pivot_status(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    p = o.groupBy("c_mktsegment").pivot("o_orderstatus", ["O", "F", "P"]).agg(F.sum("o_totalprice"))
    return p.fillna(0).select("c_mktsegment", *[F.round(x, 2).alias(x.lower()) for x in "OFP"])
