"""Query registration and shared SQL text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.session import stored
from propensity.sources import frames

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL twin when there is one."""
    def add(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is already registered")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6, exact: Sequence[str] = (), **special: int) -> DataFrame:
    """Round every double column, so that summation order does not show.

    ``exact`` columns do not depend on it (ratios of whole numbers, sums of 1/1024) and stay
    as they are: engines round a tie in the last digit differently.
    """
    # Adding zero turns a rounded -0.0 into 0.0.
    return df.select(*[
        (F.round(c, special.get(c, digits)) + F.lit(0.0)).alias(c) if kind in ("double", "float") and c not in exact else F.col(c)
        for c, kind in df.dtypes])


def flat(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the orders frame, stored: for operators that read their input more than once."""
    return stored(frames.orders_frame(spark, folder, columns), "flat")


# One row per order, as SQL.
P = """
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split,
         o.o_totalprice AS amount, c.c_acctbal AS balance, c.c_nationkey AS nation,
         coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_supp, 0) AS n_supp, coalesce(l.qty, 0) AS qty,
         o.o_orderpriority AS priority, c.c_mktsegment AS segment, r.r_name AS region,
         CASE WHEN c.c_acctbal >= 5000 THEN 'Yes' ELSE 'No' END AS rich,
         CASE WHEN o.o_orderpriority < '3' THEN 'High'
              WHEN o.o_orderpriority < '5' THEN 'Medium' ELSE 'Low' END AS urgency,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS target,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
         CAST((o.o_orderkey * 7919 + CASE WHEN o.o_orderstatus = 'F' THEN 211 ELSE 0 END) % 1000 AS DOUBLE)
           / CAST(1000 AS DOUBLE) AS score_a,
         CAST((o.o_orderkey * 7877 + CASE WHEN o.o_orderstatus = 'F' THEN 97 ELSE 0 END) % 500 AS DOUBLE)
           / CAST(500 AS DOUBLE) AS score_b,
         CAST((o.o_orderkey * 7919 + CASE WHEN o.o_orderstatus = 'F' THEN 211 ELSE 0 END) % 1024 AS DOUBLE)
           / CAST(1024 AS DOUBLE) AS score_d
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_supp,
                    CAST(sum(l_quantity) AS BIGINT) AS qty
             FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

E = """
  SELECT event_id AS id, event_type, user_id, value,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y
  FROM events
"""

L = """
  SELECT labels.doc_id AS id, quality, toxic, lang, source, n_chars
  FROM labels JOIN documents ON labels.doc_id = documents.doc_id
"""


def with_p(body: str) -> str:
    return f"WITH p AS ({P}) {body}"


def edges_sql(src: str, col: str, q: int) -> str:
    """Sorted distinct quantile edges of a column, as a list."""
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont(CAST({col} AS DOUBLE), [{probs}]))) FROM {src})"


def bin_sql(edges: str, col: str) -> str:
    """Right-closed bin number of a column among listed edges."""
    return f"CAST(greatest(len(list_filter({edges}, lambda e: e < {col})) - 1, 0) AS INTEGER)"


def auc_sql(src: str, by: Sequence[str] = ()) -> str:
    """Rank-sum AUC of (y, s) per group: n, positives, auc."""
    keys = "".join(f"{b}, " for b in by)
    tied = ", ".join([*by, "s"])
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""
    pairs = "(CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)))"
    return f"""
      SELECT {keys}count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
             CASE WHEN sum(y) > 0 AND sum(y) < count(*)
                  THEN (sum(CASE WHEN y = 1 THEN rk ELSE 0 END)
                        - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) / {pairs} END AS auc
      FROM (SELECT {keys}y, rank() OVER ({part}ORDER BY s)
                   + CAST(count(*) OVER (PARTITION BY {tied}) - 1 AS DOUBLE) / 2 AS rk
            FROM {src}) ranked
      {group}"""


def ap_sql(src: str) -> str:
    """Step-wise average precision of (y, s)."""
    return f"""
      SELECT sum(CAST(pos AS DOUBLE) * cp / cn) / sum(pos) AS average_precision
      FROM (SELECT pos, sum(pos) OVER (ORDER BY s DESC) AS cp, sum(n) OVER (ORDER BY s DESC) AS cn
            FROM (SELECT s, sum(y) AS pos, count(*) AS n FROM {src} GROUP BY s) g) c"""
