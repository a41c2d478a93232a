"""Registry of named queries and their DuckDB oracle SQL.

Every query reads the source tables through ``Tables`` (or data Spark
derives from them) and returns a lazy DataFrame; ``ORACLE`` holds the
equivalent SQL over the same tables. Money sums are exact decimals cast to
DOUBLE on both sides; calendar parts are INTEGER on both sides.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.fixtures import with_line_dates
from ..sources.tables import Tables
from . import marts, star, tpch

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# SQL fragments
def M(c: str) -> str:  # exact money
    return f"CAST({c} AS DECIMAL(18,4))"


def R(c: str) -> str:  # exact rate
    return f"CAST({c} AS DECIMAL(10,4))"


def NET(p: str, d: str) -> str:
    return f"{M(p)} * (1 - {R(d)})"


def I(e: str) -> str:  # integer calendar part
    return f"CAST({e} AS INTEGER)"


# ------------------------------------------------------------ benchmark queries
register("q1_projection_limit", """
    SELECT l_orderkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
    ORDER BY l_orderkey, l_shipdate LIMIT 1000""")(
    lambda t: tpch.q1_projection_limit(t, ordered=True))
register("q2_filter", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'""")(tpch.q2_filter)
register("q3_count_by_customer", """
    SELECT o_custkey, COUNT(*) AS order_count FROM orders GROUP BY o_custkey""")(
    tpch.q3_count_by_customer)
register("q4_count_sort", """
    SELECT o_orderpriority, COUNT(*) AS cnt FROM orders
    GROUP BY o_orderpriority ORDER BY cnt DESC, o_orderpriority""")(tpch.q4_count_sort)
register("q5_join_sum", f"""
    SELECT c_nationkey, CAST(SUM({M('l_extendedprice')}) AS DOUBLE) AS total_revenue
    FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
    JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    GROUP BY c_nationkey""")(tpch.q5_join_sum)
register("top_customers_by_spend", f"""
    SELECT c.c_name, CAST(SUM({M('l.l_extendedprice')}) AS DOUBLE) AS total_spent
    FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
    JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    GROUP BY c.c_name ORDER BY total_spent DESC, c.c_name LIMIT 10""")(
    tpch.top_customers_by_spend)

# ------------------------------------------------------------ star schema
_NULLS = "CAST(NULL AS VARCHAR)"

register("dim_customer", f"""
    SELECT c_custkey AS custkey, c_name AS name, {_NULLS} AS address, {_NULLS} AS phone,
           c_acctbal AS acctbal, c_mktsegment AS mktsegment,
           CAST(c_nationkey AS BIGINT) AS nationkey FROM customer""")(
    lambda t: star.dim_customer(t.customer))
register("dim_customer_b", f"""
    SELECT c_custkey AS customer_key, c_name AS customer_name, {_NULLS} AS address,
           {_NULLS} AS phone, c_acctbal AS acctbal, c_mktsegment AS mktsegment,
           CAST(c_nationkey AS BIGINT) AS nation_key FROM customer""")(
    lambda t: star.dim_customer(t.customer, "shipdate"))
register("dim_supplier", f"""
    SELECT s_suppkey AS suppkey, s_name AS name, {_NULLS} AS address, {_NULLS} AS phone,
           s_acctbal AS acctbal, CAST(s_nationkey AS BIGINT) AS nationkey FROM supplier""")(
    lambda t: star.dim_supplier(t.supplier))
register("dim_supplier_b", f"""
    SELECT s_suppkey AS supplier_key, s_name AS supplier_name, {_NULLS} AS address,
           {_NULLS} AS phone, s_acctbal AS acctbal,
           CAST(s_nationkey AS BIGINT) AS nation_key FROM supplier""")(
    lambda t: star.dim_supplier(t.supplier, "shipdate"))
register("dim_part", f"""
    SELECT p_partkey AS partkey, p_name AS name, {_NULLS} AS mfgr, p_brand AS brand,
           p_type AS type, p_size AS size, {_NULLS} AS container,
           p_retailprice AS retailprice FROM part""")(lambda t: star.dim_part(t.part))
register("dim_part_b", f"""
    SELECT p_partkey AS part_key, p_name AS part_name, {_NULLS} AS mfgr, p_brand AS brand,
           p_type AS type, p_size AS size, {_NULLS} AS container,
           p_retailprice AS retail_price FROM part""")(
    lambda t: star.dim_part(t.part, "shipdate"))
register("dim_order", """
    SELECT o_orderkey AS orderkey, o_orderstatus AS orderstatus, o_totalprice AS totalprice,
           CAST(o_orderdate AS DATE) AS orderdate, o_orderpriority AS priority,
           o_custkey AS custkey FROM orders""")(lambda t: star.dim_order(t.orders))
register("dim_order_b", """
    SELECT o_orderkey AS order_key, o_orderstatus AS order_status, o_totalprice AS total_price,
           CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS order_priority,
           o_custkey AS customer_key FROM orders""")(
    lambda t: star.dim_order(t.orders, "shipdate"))
register("dim_geography", """
    SELECT CAST(r_regionkey AS BIGINT) AS regionkey, r_name AS regionname,
           CAST(n_nationkey AS BIGINT) AS nationkey, n_name AS nationname
    FROM nation JOIN region ON n_regionkey = r_regionkey""")(
    lambda t: star.dim_geography(t.nation, t.region))
register("dim_geography_left", """
    SELECT CAST(n_regionkey AS BIGINT) AS region_key, CAST(n_nationkey AS BIGINT) AS nation_key,
           n_name AS nation_name, r_name AS region_name
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")(
    lambda t: star.dim_geography(t.nation, t.region, "shipdate"))
register("dim_time", f"""
    SELECT d AS datekey, {I('year(d)')} AS year, {I('quarter(d)')} AS quarter,
           {I('month(d)')} AS month, {I('day(d)')} AS day
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
          WHERE o_orderdate IS NOT NULL)""")(lambda t: star.dim_time(t.orders))
register("dim_time_b", f"""
    SELECT d AS date, {I('year(d)')} AS year, {I('month(d)')} AS month, {I('day(d)')} AS day,
           CAST(quarter(d) AS VARCHAR) AS quarter, {I('weekofyear(d)')} AS week
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
          WHERE o_orderdate IS NOT NULL)""")(lambda t: star.dim_time(t.orders, "shipdate"))

_FACT_A = f"""
    SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
           o_custkey AS custkey, l_extendedprice AS extendedprice, l_discount AS discount,
           l_tax AS tax, l_quantity AS quantity, CAST(o_orderdate AS DATE) AS orderdate,
           {I('year(o_orderdate)')} AS year, {I('month(o_orderdate)')} AS month,
           {I('day(o_orderdate)')} AS day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
register("fact_sales", _FACT_A)(lambda t: star.fact_sales(t.lineitem, t.orders))


def _fact_b_sql(derived_dates: bool) -> str:
    if derived_dates:
        commit = "CAST(l_shipdate AS DATE) + CAST((l_orderkey % 61) - 30 AS INTEGER)"
        receipt = "CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER)"
    else:
        commit = receipt = "CAST(NULL AS DATE)"
    return f"""
    SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supplier_key,
           o_custkey AS customer_key, l_extendedprice AS extended_price,
           l_discount AS discount, l_tax AS tax, l_quantity AS quantity,
           CAST(l_shipdate AS DATE) AS ship_date, {commit} AS commit_date,
           {receipt} AS receipt_date,
           {I('year(l_shipdate)')} AS order_year, {I('month(l_shipdate)')} AS order_month,
           {I('day(l_shipdate)')} AS order_day
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""


register("fact_sales_shipdate", _fact_b_sql(False))(
    lambda t: star.fact_sales(t.lineitem, t.orders, "shipdate"))

# ------------------------------------------------------------ marts


def _fact_b(t: Tables):
    return star.fact_sales(t.lineitem, t.orders, "shipdate")


def _fact_a(t: Tables):
    return star.fact_sales(t.lineitem, t.orders)


register("sales_by_customer", f"""
    SELECT c_custkey AS custkey, c_name AS name,
           CAST(SUM({NET('l_extendedprice', 'l_discount')}) AS DOUBLE) AS total_revenue,
           COUNT(DISTINCT l_orderkey) AS total_orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name""")(
    lambda t: marts.sales_by_customer(_fact_a(t), star.dim_customer(t.customer)))
register("sales_by_region", f"""
    SELECT r_name AS regionname,
           CAST(SUM({NET('l_extendedprice', 'l_discount')}) AS DOUBLE) AS total_revenue,
           COUNT(DISTINCT l_orderkey) AS total_orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name""")(
    lambda t: marts.region_sales(t.lineitem, t.orders, star.dim_customer(t.customer),
                                 star.dim_geography(t.nation, t.region)))
register("sales_summary", f"""
    SELECT {I('year(o_orderdate)')} AS year, {I('month(o_orderdate)')} AS month,
           CAST(SUM({M('l_extendedprice')}) AS DOUBLE) AS total_revenue,
           CAST(SUM({R('l_discount')}) AS DOUBLE) / COUNT(l_discount) AS avg_discount,
           CAST(SUM({R('l_tax')}) AS DOUBLE) / COUNT(l_tax) AS avg_tax,
           CAST(SUM({M('l_quantity')}) AS DOUBLE) AS total_quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY 1, 2""")(lambda t: marts.sales_summary(_fact_a(t)))
register("revenue_by_customer", f"""
    SELECT o_custkey AS customer_key,
           CAST(SUM({NET('l_extendedprice', 'l_discount')}) AS DOUBLE) AS total_revenue,
           CAST(SUM({M('l_quantity')}) AS DOUBLE) AS total_units
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    GROUP BY o_custkey""")(lambda t: marts.revenue_by_customer(_fact_b(t)))
register("supplier_performance", f"""
    SELECT l_suppkey AS supplier_key,
           CAST(SUM({NET('l_extendedprice', 'l_discount')}) AS DOUBLE) AS total_revenue,
           CAST(SUM({M('l_quantity')}) AS DOUBLE) AS total_units,
           COUNT(*) AS transactions
    FROM lineitem GROUP BY l_suppkey""")(lambda t: marts.supplier_performance(star.line_fact(t.lineitem)))
register("inventory_summary", f"""
    SELECT l_partkey AS part_key,
           CAST(SUM({M('l_quantity')}) AS DOUBLE) AS units_ordered,
           CAST(SUM({NET('l_extendedprice', 'l_discount')}) AS DOUBLE) AS revenue
    FROM lineitem GROUP BY l_partkey""")(lambda t: marts.inventory_summary(star.line_fact(t.lineitem)))
register("order_fulfillment", f"""
    SELECT supplier_key, AVG(date_diff('day', commit_date, ship_date)) AS avg_ship_delay,
           AVG(date_diff('day', ship_date, receipt_date)) AS avg_fulfillment_days,
           COUNT(*) AS orders
    FROM ({_fact_b_sql(True)}) GROUP BY supplier_key""")(
    lambda t: marts.order_fulfillment(star.line_fact(with_line_dates(t.lineitem))))

# ------------------------------------------------------------ upsert / refresh
from pyspark.sql import functions as _F  # noqa: E402

from ..operators.upsert import merge_frames  # noqa: E402
from .refresh import FACT_KEYS  # noqa: E402

_FACT_COLS = ("orderkey, partkey, suppkey, custkey, extendedprice, discount, tax, quantity, "
              "orderdate, year, month, day")


def _fact_upsert(t: Tables) -> DataFrame:
    """base = fact rows ordered before 2000; delta = rows ordered from
    1999-06-01 with extendedprice + 1; upsert delta into base on the
    five-column MERGE key."""
    f = star.fact_sales(t.lineitem, t.orders)
    base = f.where(_F.col("orderdate") < _F.lit("2000-01-01").cast("date"))
    delta = (f.where(_F.col("orderdate") >= _F.lit("1999-06-01").cast("date"))
             .withColumn("extendedprice", _F.col("extendedprice") + 1))
    return merge_frames(base, delta, FACT_KEYS)


register("fact_upsert", f"""
    WITH f AS ({_FACT_A}),
    base AS (SELECT * FROM f WHERE orderdate < DATE '2000-01-01'),
    delta AS (SELECT orderkey, partkey, suppkey, custkey, extendedprice + 1 AS extendedprice,
                     discount, tax, quantity, orderdate, year, month, day
              FROM f WHERE orderdate >= DATE '1999-06-01')
    SELECT {_FACT_COLS} FROM delta
    UNION ALL
    SELECT {_FACT_COLS} FROM base b WHERE NOT EXISTS (
        SELECT 1 FROM delta d WHERE d.orderkey = b.orderkey AND d.partkey = b.partkey
          AND d.suppkey = b.suppkey AND d.custkey = b.custkey AND d.orderdate = b.orderdate)""")(
    _fact_upsert)

# ------------------------------------------------------------ ingestion
from ..sources import rawzone  # noqa: E402
from ..sources.jdbc import ExtractSpec, window_filter  # noqa: E402
from . import ingest  # noqa: E402

_ORDER_OUT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


def _raw_dedup(t: Tables) -> DataFrame:
    """Two overlapping date-window extracts of orders landed in two ingest
    hours; the RAW read sees both copies of the overlap, and
    ``latest_ingest`` keeps one row per order (the later hour's)."""
    def extract(lo, hi, y, m, d, h):
        spec = ExtractSpec("orders", window_col="o_orderdate", window=(lo, hi))
        df = window_filter(t.orders, spec)
        return df.select(*[(_F.to_date(c) if c == "o_orderdate" else _F.col(c)).alias(c)
                           for c in _ORDER_OUT]).withColumns(
            {"year": _F.lit(y), "month": _F.lit(m), "day": _F.lit(d), "hour": _F.lit(h)})
    both = (extract("1900-01-01", "1998-01-01", "2024", "01", "01", "10")
            .unionByName(extract("1997-01-01", "2100-01-01", "2024", "01", "02", "10")))
    return rawzone.latest_ingest(both, ["o_orderkey"]).select(*_ORDER_OUT)


register("raw_dedup", """
    SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM (
        SELECT * FROM orders WHERE o_orderdate >= DATE '1900-01-01' AND o_orderdate < DATE '1998-01-01'
        UNION ALL
        SELECT * FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '2100-01-01')
    """)(_raw_dedup)

_YEARS = [f"{y}-01-01" for y in range(1995, 2003)]
register("incremental_window", """
    SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS window_lo,
           CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR AS DATE) AS window_hi,
           COUNT(*) AS rows, MAX(o_orderkey) AS watermark
    FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '2002-01-01'
    GROUP BY 1, 2""")(
    lambda t: ingest.window_batches(t.orders, "o_orderdate", _YEARS, "o_orderkey"))

# ------------------------------------------------------------ sentiment sandbox
from ..functions import sentiment as S  # noqa: E402
from . import classifier  # noqa: E402
from . import sentiment as sent  # noqa: E402


def _sql_flags(words, col="lower(text)"):
    return " + ".join(f"CAST(contains({col}, '{w}') AS INTEGER)" for w in words)


def _sql_score(pos, neg, text="text"):
    return (f"(CASE WHEN {text} IS NULL OR {text} = '' THEN 0 ELSE "
            f"({_sql_flags(pos, f'lower({text})')}) - ({_sql_flags(neg, f'lower({text})')}) END)")


_SA = _sql_score(S.LEXICON_A_POSITIVE, S.LEXICON_A_NEGATIVE)
_SB = _sql_score(S.LEXICON_B_POSITIVE, S.LEXICON_B_NEGATIVE)


def _label(score, cap=False):
    p, n, u = ("Positive", "Negative", "Neutral") if cap else ("positive", "negative", "neutral")
    return f"CASE WHEN {score} > 0 THEN '{p}' WHEN {score} < 0 THEN '{n}' ELSE '{u}' END"


register("sentiment_lexicon_a", f"""
    SELECT doc_id, {_label(_SA)} AS predicted_label, CAST({_SA} AS DOUBLE) AS score
    FROM documents""")(
    lambda t: S.with_lexicon(t.documents.select("doc_id", "text"), "text", "a")
    .select("doc_id", "predicted_label", "score"))
register("sentiment_lexicon_b", f"""
    SELECT doc_id, CAST({_SB} AS FLOAT) AS sentiment_score, {_label(_SB, True)} AS sentiment
    FROM documents""")(
    lambda t: S.with_lexicon(t.documents.select("doc_id", "text"), "text", "b",
                             score_col="sentiment_score", label_col="sentiment")
    .select("doc_id", "sentiment_score", "sentiment"))
register("sentiment_conversations", f"""
    SELECT conv_id, turn, {_label(_SA)} AS predicted_label, CAST({_SA} AS DOUBLE) AS score
    FROM conversations""")(
    lambda t: S.with_lexicon(t.conversations.select("conv_id", "turn", "text"), "text", "a")
    .select("conv_id", "turn", "predicted_label", "score"))
register("weak_label", f"""
    SELECT doc_id, CAST(({_sql_flags(S.WEAK_POSITIVE)}) > 0 AS INTEGER) AS weak_label
    FROM documents""")(
    lambda t: t.documents.select("doc_id", S.weak_label("text").alias("weak_label")))


def _sentiment_enriched(t: Tables) -> DataFrame:
    """Documents as customer comments: custkey = doc_id % (customer count)."""
    n = t.customer.count()
    comments = t.documents.select((_F.col("doc_id") % n).cast("int").alias("custkey"),
                                  _F.col("text").alias("comment"))
    return sent.enrich(comments, star.dim_customer(t.customer))


register("sentiment_enriched", f"""
    SELECT CAST(d.custkey AS VARCHAR) AS custkey, c.c_name AS customer_name,
           CAST(c.c_nationkey AS BIGINT) AS nationkey, d.text AS comment,
           {_label(_SA)} AS predicted_label, CAST({_SA} AS DOUBLE) AS score
    FROM (SELECT CAST(doc_id % (SELECT COUNT(*) FROM customer) AS INTEGER) AS custkey, text
          FROM documents) d
    LEFT JOIN customer c ON CAST(d.custkey AS BIGINT) = c.c_custkey""")(_sentiment_enriched)


def _sentiment_product(t: Tables) -> DataFrame:
    """Conversation turns as product comments: customer id = conv_id,
    product id = turn (string ids, as in the CSV files)."""
    c = t.conversations.select(
        _F.concat_ws("-", _F.col("conv_id").cast("string"), _F.col("turn").cast("string"))
        .alias("comment_id"),
        _F.col("conv_id").cast("string").alias("customer_id"),
        _F.col("turn").cast("string").alias("product_id"),
        _F.col("text").alias("comment_text"))
    return sent.enrich_products(c, star.dim_customer(t.customer, "shipdate"),
                                star.dim_part(t.part, "shipdate"))


register("sentiment_product", f"""
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id,
           CAST(conv_id AS VARCHAR) AS customer_id, CAST(turn AS VARCHAR) AS product_id,
           text AS comment_text, CAST({_SB} AS FLOAT) AS sentiment_score,
           {_label(_SB, True)} AS sentiment, c.c_name AS customer_name, p.p_name AS part_name
    FROM conversations LEFT JOIN customer c ON conv_id = c.c_custkey
    LEFT JOIN part p ON turn = p.p_partkey""")(_sentiment_product)


# The fitted probability has no SQL form. What it must come to has: on the rows
# that it learned from, the model tells those that the weak rule marks.
register("text_classifier", f"""
    SELECT doc_id, weak_label, CASE weak_label WHEN 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
           TRUE AS probable FROM ({ORACLE["weak_label"]})""")(
    lambda t: classifier.classify(t.documents, "doc_id", "text").select(
        "doc_id", "weak_label", "sentiment",
        ((_F.col("p_positive") >= 0) & (_F.col("p_positive") <= 1)
         & ((_F.col("p_positive") > 0.5) == (_F.col("sentiment") == "Positive"))).alias("probable")))

# ------------------------------------------------------------ versions, checks, masking, ...
from ..operators import checks, masking, retention, versions  # noqa: E402
from ..schemas import union_evolving  # noqa: E402


def _versioned_orders(t: Tables) -> DataFrame:
    """Three batches: all orders; orders from 2000 with totalprice + 1;
    orders from 2001 with status 'C' and totalprice + 2."""
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    b1 = versions.stamp(o, 1)
    b2 = versions.stamp(o.where(_F.col("o_orderdate") >= _F.lit("2000-01-01").cast("date"))
                        .withColumn("o_totalprice", _F.col("o_totalprice") + 1), 2)
    b3 = versions.stamp(o.where(_F.col("o_orderdate") >= _F.lit("2001-01-01").cast("date"))
                        .withColumns({"o_orderstatus": _F.lit("C"),
                                      "o_totalprice": _F.col("o_totalprice") + 2}), 3)
    return b1.unionByName(b2).unionByName(b3).drop("o_orderdate")


_VERSIONED_SQL = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(1 AS BIGINT) AS batch_id FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1, CAST(2 AS BIGINT) FROM orders
      WHERE o_orderdate >= DATE '2000-01-01'
    UNION ALL SELECT o_orderkey, 'C', o_totalprice + 2, CAST(3 AS BIGINT) FROM orders
      WHERE o_orderdate >= DATE '2001-01-01'"""

register("as_of_orders", f"""
    SELECT o_orderkey, o_orderstatus, o_totalprice, batch_id FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY batch_id DESC) AS rn
      FROM ({_VERSIONED_SQL}) WHERE batch_id <= 2) WHERE rn = 1""")(
    lambda t: versions.as_of(_versioned_orders(t), ["o_orderkey"], 2))
register("orders_history_expired", f"""
    WITH v AS ({_VERSIONED_SQL}),
    snap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
             ORDER BY batch_id DESC) AS rn FROM v WHERE batch_id <= 2) WHERE rn = 1)
    SELECT batch_id, COUNT(*) AS rows FROM (
      SELECT batch_id FROM snap UNION ALL SELECT batch_id FROM v WHERE batch_id > 2)
    GROUP BY batch_id""")(
    lambda t: versions.history(versions.expire(_versioned_orders(t), ["o_orderkey"], 2)))


def _fk_checks(t: Tables) -> DataFrame:
    orders, lines = t.orders, t.lineitem
    return (checks.Suite()
            .foreign_key(orders, "o_custkey", t.customer, "c_custkey")
            .foreign_key(lines, "l_orderkey", orders, "o_orderkey")
            .foreign_key(lines, "l_partkey", t.part, "p_partkey")
            .foreign_key(lines, "l_suppkey", t.supplier, "s_suppkey")
            .unique(orders, ["o_orderkey"])
            .unique(lines, ["l_orderkey", "l_linenumber"])
            .not_null(orders, "o_orderdate")
            .in_range(lines, "l_discount", 0.0, 0.1)).run()


register("fk_checks", """
    SELECT 'fk:o_custkey' AS "check", COUNT(*) AS violations FROM orders
      WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
    UNION ALL SELECT 'fk:l_orderkey', COUNT(*) FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
    UNION ALL SELECT 'fk:l_partkey', COUNT(*) FROM lineitem
      WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
    UNION ALL SELECT 'fk:l_suppkey', COUNT(*) FROM lineitem
      WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)
    UNION ALL SELECT 'unique:o_orderkey', COUNT(*) FROM (
      SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1)
    UNION ALL SELECT 'unique:l_orderkey,l_linenumber', COUNT(*) FROM (
      SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'not_null:o_orderdate', COUNT(*) FROM orders WHERE o_orderdate IS NULL
    UNION ALL SELECT 'range:l_discount', COUNT(*) FROM lineitem
      WHERE l_discount < 0.0 OR l_discount > 0.1""")(_fk_checks)



def _orphan_checks(t: Tables) -> DataFrame:
    """Lines whose order, part or supplier is missing (every 50th order, every
    third part; all suppliers are there), and values outside the accepted."""
    lines = t.lineitem
    return (checks.Suite()
            .foreign_key(lines, "l_orderkey", t.orders.where(_F.col("o_orderkey") % 50 != 0), "o_orderkey")
            .foreign_key(lines, "l_partkey", t.part.where(_F.col("p_partkey") % 3 != 0), "p_partkey")
            .foreign_key(lines, "l_suppkey", t.supplier, "s_suppkey")
            .accepted(t.orders, "o_orderstatus", ["F", "O"])
            .in_range(lines, "l_quantity", 10, 40)).run()


register("orphan_checks", """
    SELECT 'fk:l_orderkey' AS "check", COUNT(*) AS violations FROM lineitem
      WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0)
    UNION ALL SELECT 'fk:l_partkey', COUNT(*) FROM lineitem
      WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)
    UNION ALL SELECT 'fk:l_suppkey', COUNT(*) FROM lineitem
      WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
    UNION ALL SELECT 'accepted:o_orderstatus', COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT 'range:l_quantity', COUNT(*) FROM lineitem WHERE l_quantity < 10 OR l_quantity > 40""")(
    _orphan_checks)

from ..operators import profiles  # noqa: E402


def _profile_merged(t: Tables) -> DataFrame:
    """Profiles of the orders of each year, merged without reading the orders
    again: the exact part, and whether each estimate is within its error of
    the whole table's figure."""
    orders = t.orders.select(*_PROFILE_COLS, "o_totalprice", _F.year("o_orderdate").alias("year"))
    stored = _stored(t, "profiles")
    cols = [*_PROFILE_COLS, "o_totalprice"]
    profiles.partial(orders, cols, ["year"]).write.partitionBy("year").parquet(stored)
    whole = profiles.merged(t.spark.read.parquet(stored))
    table = profiles.summary(whole, quantiles=[0.5])
    true = checks.profile(orders, cols).select("column", _F.col("distinct").alias("_distinct"))
    # the estimated median's rank, and the count of the most frequent status
    half = table.where(_F.col("column") == "o_totalprice").select(_F.col("quantiles")[0].alias("m"))
    below = (orders.join(half).agg(_F.avg((_F.col("o_totalprice") <= _F.col("m")).cast("double")).alias("r"))
             .select((_F.abs(_F.col("r") - 0.5) <= 0.03).alias("median_fits")))
    status = orders.groupBy("o_orderstatus").count().agg(_F.max("count").alias("_most"))
    top = _F.when(_F.col("column") == "o_orderstatus", _F.get("top", _F.lit(0))["count"] == _F.col("_most")).otherwise(True)
    return (table.join(true, "column").join(below).join(status).select(
        "column", "rows", "nulls", _F.when(_F.col("column") != "o_totalprice", _F.col("min")).alias("min"),
        _F.when(_F.col("column") != "o_totalprice", _F.col("max")).alias("max"),
        (_F.abs(_F.col("distinct") - _F.col("_distinct")) <= 0.06 * _F.col("_distinct")).alias("distinct_fits"),
        "median_fits", top.alias("top_fits")))


_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
register("profile_orders", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
               COUNT(DISTINCT {c}) AS "distinct", CAST(MIN({c}) AS VARCHAR) AS min,
               CAST(MAX({c}) AS VARCHAR) AS max FROM orders""" for c in _PROFILE_COLS))(
    lambda t: checks.profile(t.orders, _PROFILE_COLS))

register("profile_merged", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
               {f'CAST(MIN({c}) AS VARCHAR)' if c != 'o_totalprice' else 'CAST(NULL AS VARCHAR)'} AS min,
               {f'CAST(MAX({c}) AS VARCHAR)' if c != 'o_totalprice' else 'CAST(NULL AS VARCHAR)'} AS max,
               TRUE AS distinct_fits, TRUE AS median_fits, TRUE AS top_fits FROM orders"""
    for c in [*_PROFILE_COLS, "o_totalprice"]))(_profile_merged)

register("masked_customers", """
    SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
           CASE WHEN c_mktsegment IS NULL THEN NULL ELSE '*****' END AS c_mktsegment
    FROM customer""")(
    lambda t: masking.mask(t.customer, {"c_name": "sha2", "c_acctbal": "null",
                                        "c_mktsegment": "redact"}))
register("retention_tiers", """
    SELECT CASE WHEN o_orderdate IS NULL THEN 'undated'
                WHEN o_orderdate < DATE '1999-01-01' THEN 'archive' ELSE 'hot' END AS tier,
           COUNT(*) AS rows FROM orders GROUP BY 1""")(
    lambda t: retention.tier_counts(t.orders, "o_orderdate", "1999-01-01"))


def _schema_evolution(t: Tables) -> DataFrame:
    """Orders written in two schema versions: v1 (before 1998) with an INT
    key and no priority column; v2 with BIGINT key and o_orderpriority."""
    o = t.orders
    cut = _F.lit("1998-01-01").cast("date")
    v1 = o.where(_F.col("o_orderdate") < cut).select(
        _F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_custkey", "o_totalprice")
    v2 = o.where(_F.col("o_orderdate") >= cut).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return union_evolving(v1, v2)


register("schema_evolution_union", """
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority
      FROM orders WHERE o_orderdate < DATE '1998-01-01'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority
      FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")(_schema_evolution)

# ------------------------------------------------------------ streaming
import uuid as _uuid  # noqa: E402

from ..session import checkpoint_dir as _ckdir  # noqa: E402
from ..streaming import incremental as _inc  # noqa: E402


def _stream_incremental_orders(t: Tables) -> DataFrame:
    """Orders land as eight parquet files; a file-source stream (two files per
    micro-batch) upserts each batch into a dim_order table keyed on orderkey
    and partitioned by a bucket of the key, which no row ever leaves. The
    result must equal the batch-built dim_order."""
    spark = t.spark
    root = f"{_ckdir(spark).rstrip('/')}/strata-stream-{_uuid.uuid4().hex}"
    landing, target = f"{root}/landing", f"{root}/dim_order"
    t.orders.repartition(8, "o_orderkey").write.parquet(landing)
    stream = _inc.file_stream(spark, landing, t.orders.schema, glob="*.parquet",
                              max_files_per_trigger=2)

    def to_dim(batch: DataFrame) -> DataFrame:
        d = star.dim_order(batch)
        return d.withColumn("bucket", _F.pmod("orderkey", _F.lit(8)))

    _inc.run_incremental(spark, stream, target, ["orderkey"], job=f"stream-{root[-8:]}",
                         order_by=["orderdate"], partition_cols=("bucket",), keys_fix_partition=True, transform=to_dim,
                         checkpoint=f"{root}/_checkpoint", ledger_path=f"{root}/_ledger")
    return spark.read.parquet(target).select("orderkey", "orderstatus", "totalprice",
                                             "orderdate", "priority", "custkey")


register("stream_incremental_orders", ORACLE["dim_order"])(_stream_incremental_orders)



def _stream_late_orders(t: Tables) -> DataFrame:
    """Versions of orders land newest first: version 3 of every seventh order,
    then version 2 of every third, then version 1 of all, two files a batch. A
    row that comes in a later batch than a newer one of its order loses; status
    and year (the partition) tell versions apart."""
    spark = t.spark
    root = f"{_ckdir(spark).rstrip('/')}/strata-late-{_uuid.uuid4().hex}"
    landing, target = f"{root}/landing", f"{root}/dim_order"
    for version, every in ((3, 7), (2, 3), (1, 1)):
        (t.orders.where(_F.col("o_orderkey") % every == 0).withColumn("version", _F.lit(version))
         .repartition(3, "o_orderkey").write.mode("append").parquet(landing))
    schema = spark.read.parquet(landing).schema
    stream = _inc.file_stream(spark, landing, schema, glob="*.parquet", max_files_per_trigger=2)

    def to_dim(batch: DataFrame) -> DataFrame:
        named = batch.withColumn("o_orderstatus", _F.concat(_F.lit("v"), _F.col("version").cast("string")))
        d = star.dim_order(named).withColumn("version", _F.substring("orderstatus", 2, 9).cast("int"))
        return d.withColumn("year", _F.year("orderdate") + _F.col("version"))

    _inc.run_incremental(spark, stream, target, ["orderkey"], job=f"late-{root[-8:]}", order_by=["totalprice"],
                         partition_cols=("year",), newer_by="version", transform=to_dim,
                         checkpoint=f"{root}/_checkpoint", ledger_path=f"{root}/_ledger")
    return spark.read.parquet(target).select("orderkey", "orderstatus", "totalprice", "orderdate", "priority",
                                             "custkey", "version")


register("stream_late_orders", f"""
    SELECT * REPLACE ('v' || CAST(version AS VARCHAR) AS orderstatus) FROM (
        SELECT *, CAST(CASE WHEN orderkey % 7 = 0 THEN 3 WHEN orderkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS version
        FROM ({ORACLE["dim_order"]}))""")(_stream_late_orders)

# ------------------------------------------------------------ mart queries
register("sales_by_region_sorted", f"""
    SELECT regionname, total_revenue, total_orders FROM ({ORACLE["sales_by_region"]})
    ORDER BY total_revenue DESC, regionname, total_orders""")(
    lambda t: marts.sorted_desc(QUERIES["sales_by_region"](t), "total_revenue"))

# ------------------------------------------------------------ grain, refresh staging, RAW round trips
import datetime as _dt  # noqa: E402

from . import refresh as _refresh  # noqa: E402

register("fact_sales_line_safe", _FACT_A.replace(
    "l_quantity AS quantity,", "l_quantity AS quantity, l_linenumber AS linenumber,"))(
    lambda t: star.fact_sales(t.lineitem, t.orders, line_safe=True))

register("refresh_staging", f"""
    SELECT DISTINCT * FROM ({_FACT_A.replace("JOIN orders", "JOIN (SELECT DISTINCT * FROM orders) orders")})""")(
    lambda t: _refresh.staging_fact(t.lineitem, t.orders, "reference"))


def _dim_order_upsert(t: Tables) -> DataFrame:
    """dim_order MERGE on orderkey: base = orders before 2000; delta = orders
    from 1999-06-01 with status 'U' (the overlap is updated)."""
    d = star.dim_order(t.orders)
    cut = _F.lit("2000-01-01").cast("date")
    base = d.where(_F.col("orderdate") < cut)
    delta = (d.where(_F.col("orderdate") >= _F.lit("1999-06-01").cast("date"))
             .withColumn("orderstatus", _F.lit("U")))
    return merge_frames(base, delta, ["orderkey"])


register("dim_order_upsert", f"""
    WITH d AS ({ORACLE["dim_order"]}),
    base AS (SELECT * FROM d WHERE orderdate < DATE '2000-01-01'),
    delta AS (SELECT orderkey, 'U' AS orderstatus, totalprice, orderdate, priority, custkey
              FROM d WHERE orderdate >= DATE '1999-06-01')
    SELECT * FROM delta
    UNION ALL SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM delta x WHERE x.orderkey = b.orderkey)""")(
    _dim_order_upsert)


class _RawZone:
    """The source tables landed as RAW text (one ingest hour) under the
    cluster's checkpoint folder, read back with the RAW contracts."""

    def __init__(self, t: Tables, names):
        root = f"{_ckdir(t.spark).rstrip('/')}/strata-raw-{_uuid.uuid4().hex}"
        for n in names:
            rawzone.land(getattr(t, n), root, n, _dt.datetime(2024, 1, 1, 0))
        self._t, self._root = t, root

    def __getattr__(self, n):
        if n.startswith("_"):
            raise AttributeError(n)
        return rawzone.read_raw(self._t.spark, self._root, n)


register("dim_order_via_raw", ORACLE["dim_order"])(
    lambda t: star.dim_order(_RawZone(t, ["orders"]).orders))


def _region_via_raw(t: Tables) -> DataFrame:
    raw = _RawZone(t, ["lineitem", "orders", "customer", "nation", "region"])
    return marts.sales_by_region(star.fact_sales(raw.lineitem, raw.orders),
                                 star.dim_customer(raw.customer),
                                 star.dim_geography(raw.nation, raw.region))


register("sales_by_region_via_raw", ORACLE["sales_by_region"])(_region_via_raw)


def _fact_via_raw_twice(t: Tables) -> DataFrame:
    """Lineitem landed whole, then the even orders again an hour later: prices
    one up, without the first lines of every fourth order. The fact is built
    from the latest copies."""
    raw = _RawZone(t, ["orders", "lineitem"])
    even = t.lineitem.where((_F.col("l_orderkey") % 2 == 0)
                            & ((_F.col("l_orderkey") % 4 != 0) | (_F.col("l_linenumber") != 1)))
    rawzone.land(even.withColumn("l_extendedprice", _F.col("l_extendedprice") + 1), raw._root, "lineitem",
                 _dt.datetime(2024, 1, 1, 1))
    latest = rawzone.RawTables(t.spark, raw._root)
    return star.fact_sales(latest.lineitem, latest.orders)


register("fact_via_raw_twice", f"""
    WITH again AS (SELECT * REPLACE (l_extendedprice + 1 AS l_extendedprice) FROM lineitem
                   WHERE l_orderkey % 2 = 0 AND (l_orderkey % 4 <> 0 OR l_linenumber <> 1)),
    latest AS (SELECT * FROM again UNION ALL
               SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM again))
    {_FACT_A.replace("FROM lineitem JOIN orders", "FROM latest JOIN orders")}""")(_fact_via_raw_twice)


# ------------------------------------------------------------ stored tables
from ..operators.upsert import upsert_table as _upsert_table  # noqa: E402
from ..sinks.writer import write_table as _write_table  # noqa: E402


def _stored(t: Tables, name: str) -> str:
    return f"{_ckdir(t.spark).rstrip('/')}/strata-{name}-{_uuid.uuid4().hex}"


def _upsert_stored_orders(t: Tables) -> DataFrame:
    """dim_order on disk, partitioned by year, a seventh of the orders without
    a date; the delta gives every third order status 'U' and dates those of
    them that had none (they move out of the NULL partition)."""
    d = star.dim_order(t.orders)
    dated = lambda df: df.withColumn("year", _F.year("orderdate"))
    base = d.withColumn("orderdate", _F.when(_F.col("orderkey") % 7 != 0, _F.col("orderdate")))
    delta = d.where(_F.col("orderkey") % 3 == 0).withColumn("orderstatus", _F.lit("U"))
    path = _stored(t, "upsert")
    _write_table(dated(base), path, partition_cols=["year"])
    stored = _upsert_table(dated(delta), path, ["orderkey"], partition_cols=["year"], keys_fix_partition=False)
    return stored.drop("year")


register("upsert_stored_orders", f"""
    SELECT orderkey, CASE WHEN orderkey % 3 = 0 THEN 'U' ELSE orderstatus END AS orderstatus, totalprice,
           CASE WHEN orderkey % 7 <> 0 OR orderkey % 3 = 0 THEN orderdate END AS orderdate, priority, custkey
    FROM ({ORACLE["dim_order"]})""")(_upsert_stored_orders)


from . import archive as _archive  # noqa: E402
from . import reconcile as _reconcile  # noqa: E402


def _damaged_landing(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders, and what a RAW landing of them with planted faults reads: every
    101st order is lost, every 103rd twice there, every 107th has another price."""
    k = _F.col("o_orderkey")
    rows = t.orders.where(k % 101 != 0).withColumn(
        "o_totalprice", _F.when((k % 107 == 0) & (k % 103 != 0), _F.col("o_totalprice") + 1).otherwise(_F.col("o_totalprice")))
    root = _stored(t, "landing")
    rawzone.land(rows.unionByName(rows.where(k % 103 == 0)), root, "orders", _dt.datetime(2024, 1, 1, 0))
    return t.orders, rawzone.read_raw(t.spark, root, "orders")


def _reconciled(t: Tables) -> _reconcile.Reconciliation:
    source, landed = _damaged_landing(t)
    return _reconcile.landing(source, landed, "orders", _F.substring("o_orderdate", 1, 7), "o_orderkey")


register("reconcile_differences", """
    SELECT CAST(o_orderkey AS VARCHAR) AS key,
           CASE WHEN o_orderkey % 101 = 0 THEN 'lost' WHEN o_orderkey % 103 = 0 THEN 'doubled' ELSE 'changed' END AS kind,
           CAST(1 AS BIGINT) AS source_rows,
           CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 WHEN o_orderkey % 103 = 0 THEN 2 ELSE 1 END AS BIGINT) AS landed_rows
    FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0 OR o_orderkey % 107 = 0""")(
    lambda t: _reconciled(t).differences())
register("reconcile_windows", """
    SELECT strftime(o_orderdate, '%Y-%m') AS "window", COUNT(*) AS source_rows,
           CAST(SUM(CASE WHEN o_orderkey % 101 = 0 THEN 0 WHEN o_orderkey % 103 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS landed_rows,
           bool_and(o_orderkey % 101 <> 0 AND o_orderkey % 103 <> 0 AND o_orderkey % 107 <> 0) AS same
    FROM orders GROUP BY 1""")(lambda t: _reconciled(t).windows())


def _archived_orders(t: Tables) -> DataFrame:
    """dim_order partitioned by month in many small files; the months before
    1999 go to the archive, packed. Both tiers together are the table."""
    hot, cold, parts = _stored(t, "hot"), _stored(t, "archive"), ["year", "month"]
    d = star.dim_order(t.orders)
    d.withColumns({"year": _F.year("orderdate"), "month": _F.month("orderdate")}).repartition(4).write.partitionBy(*parts).parquet(hot)
    _archive.archive(t.spark, hot, cold, parts, _F.col("year").cast("int") < 1999)
    rows = _archive.tiers(t.spark, hot, cold, parts)
    return rows.select(*d.columns, "tier")


register("archived_orders", f"""
    SELECT *, CASE WHEN orderdate < DATE '1999-01-01' THEN 'archive' ELSE 'hot' END AS tier
    FROM ({ORACLE["dim_order"]})""")(_archived_orders)


def _marts_maintained(t: Tables) -> DataFrame:
    """The star of the orders before 2000 with its marts' state, then a refresh
    with the orders from June 1999 on, prices one up: the marts that followed
    the refresh by its changes, one row per group."""
    from . import jobs, maintain

    class Source:
        def __init__(self, **changed):
            self._changed = changed

        def __getattr__(self, name):
            return self._changed[name] if name in self._changed else getattr(t, name)

    warehouse, day = _stored(t, "maintained"), _F.col("o_orderdate").cast("date")
    jobs.init_datawarehouse(t.spark, Source(orders=t.orders.where(day < _F.lit("2000-01-01").cast("date"))), warehouse)
    jobs.init_maintained_marts(t.spark, warehouse)
    later = t.orders.where(day >= _F.lit("1999-06-01").cast("date"))
    dearer = t.lineitem.withColumn("l_extendedprice", _F.col("l_extendedprice") + 1)
    jobs.refresh_datawarehouse(t.spark, Source(orders=later, lineitem=dearer), warehouse, on_duplicate="ignore",
                               maintain_marts=True)
    kept = maintain.view(t.spark, warehouse)
    rows = [kept["sales_by_customer"].select(_F.lit("customer").alias("mart"), _F.col("custkey").cast("string").alias("grp"),
                                             "total_revenue", "total_orders"),
            kept["sales_by_region"].select(_F.lit("region"), "regionname", "total_revenue", "total_orders"),
            kept["sales_summary"].select(_F.lit("month"), (_F.col("year") * 100 + _F.col("month")).cast("string"),
                                         "total_revenue", _F.col("total_quantity").cast("long"))]
    return rows[0].union(rows[1]).union(rows[2])


register("marts_maintained", f"""
    WITH f AS ({_FACT_A}),
    delta AS (SELECT DISTINCT orderkey, partkey, suppkey, custkey, extendedprice + 1 AS extendedprice, discount, tax,
                     quantity, orderdate, year, month, day
              FROM f WHERE orderdate >= DATE '1999-06-01'),
    fact AS (SELECT * FROM delta UNION ALL
             SELECT * FROM f b WHERE orderdate < DATE '2000-01-01' AND NOT EXISTS (
                 SELECT 1 FROM delta d WHERE d.orderkey = b.orderkey AND d.partkey = b.partkey
                   AND d.suppkey = b.suppkey AND d.custkey = b.custkey AND d.orderdate = b.orderdate))
    SELECT 'customer' AS mart, CAST(custkey AS VARCHAR) AS grp,
           CAST(SUM({NET('extendedprice', 'discount')}) AS DOUBLE) AS total_revenue,
           COUNT(DISTINCT orderkey) AS total_orders
    FROM fact JOIN customer ON custkey = c_custkey GROUP BY custkey
    UNION ALL
    SELECT 'region', r_name, CAST(SUM({NET('extendedprice', 'discount')}) AS DOUBLE), COUNT(DISTINCT orderkey)
    FROM fact JOIN customer ON custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
    UNION ALL
    SELECT 'month', CAST(year * 100 + month AS VARCHAR), CAST(SUM({M('extendedprice')}) AS DOUBLE),
           CAST(SUM({M('quantity')}) AS BIGINT) FROM fact GROUP BY year, month""")(_marts_maintained)


def _raw_text_roundtrip(t: Tables) -> DataFrame:
    """Whole document texts (commas, newlines) landed as RAW text and read back."""
    root = _stored(t, "raw-text")
    rawzone.land(t.documents.select(_F.col("doc_id").alias("custkey"), _F.col("text").alias("comment")),
                 root, "customer_comments", _dt.datetime(2024, 1, 1, 0))
    return rawzone.read_raw(t.spark, root, "customer_comments").select("custkey", "comment")


register("raw_text_roundtrip", "SELECT doc_id AS custkey, text AS comment FROM documents")(_raw_text_roundtrip)


def _fact_partitioned(t: Tables) -> DataFrame:
    path = _stored(t, "fact")
    f = star.fact_sales(t.lineitem, t.orders)
    _write_table(f, path, partition_cols=["year", "month"])
    return t.spark.read.schema(f.schema).parquet(path).select(f.columns)


register("fact_partitioned_readback", _FACT_A)(_fact_partitioned)


def _rollback_orders(t: Tables) -> DataFrame:
    path = _stored(t, "versions")
    v = _versioned_orders(t)
    for batch in (1, 2, 3):
        versions.append_version(v.where(_F.col("batch_id") == batch).drop("batch_id"), path, batch)
    versions.rollback_stored(t.spark, path, 2)
    return versions.read_as_of(t.spark, path, ["o_orderkey"])


register("rollback_orders", ORACLE["as_of_orders"])(_rollback_orders)


def _csv_comments(t: Tables) -> DataFrame:
    """Conversation turns as comment files with a header line and quotes."""
    path = _stored(t, "csv")
    (t.conversations.select(
        _F.concat_ws("-", "conv_id", "turn").alias("comment_id"), _F.col("conv_id").cast("string").alias("customer_id"),
        _F.col("turn").cast("string").alias("product_id"), _F.col("text").alias("comment_text"),
        _F.lit("2024-01-01").alias("comment_date"))
     .write.option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path))
    return rawzone.read_csv_with_header(t.spark, path, rawzone.raw_schema("social_comments", False), multi_line=True)


register("csv_header_comments", """
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id,
           CAST(conv_id AS VARCHAR) AS customer_id, CAST(turn AS VARCHAR) AS product_id,
           text AS comment_text, '2024-01-01' AS comment_date FROM conversations""")(_csv_comments)

register("masked_role_view", """
    SELECT o_orderkey, repeat('*', greatest(length(o_orderpriority) - 4, 0)) || right(o_orderpriority, 4) AS o_orderpriority,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS o_orderdate
    FROM orders WHERE o_orderstatus = 'O'""")(
    lambda t: masking.role_view(t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus"),
                                ["o_orderkey", "o_orderpriority", "o_orderdate"], _F.col("o_orderstatus") == "O",
                                {"o_orderpriority": "last4", "o_orderdate": "year"}))


def _dates_without_format(t: Tables) -> DataFrame:
    """Order dates as strings the format-less parse must read: unpadded, with
    a time, or of no date at all."""
    from ..functions.dates import as_date
    d, k = _F.col("o_orderdate"), _F.col("o_orderkey") % 4
    plain = _F.concat_ws("-", _F.year(d), _F.month(d), _F.dayofmonth(d))
    text = (_F.when(k == 0, plain).when(k == 1, _F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(k == 2, _F.date_format(d, "yyyy-MM-dd")).otherwise(_F.lit("no date")))
    df = t.orders.select("o_orderkey", text.alias("d"))
    return df.select("o_orderkey", as_date(df, "d", None).alias("parsed"))


register("dates_without_format", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders""")(
    _dates_without_format)
