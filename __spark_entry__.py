"""Registered queries and the SQL that checks them.

``queries()[name](spark, folder)`` runs one operator over whole tables of the
folder; ``oracle_sql()[name]`` computes the same table in plain SQL. Sums and
interpolated values are rounded on both sides, as their last digits depend on the
order of addition.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from importlib import import_module
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package lies next to this file, wherever that is loaded from.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyframe import (  # noqa: E402
    box_summary,
    category_counts,
    correlation_matrix,
    durable,
    histogram_feed,
    period_series,
    read_table,
    region_value_feed,
)
from tallyframe.operators.boxes import QUARTILES, RANK_ERROR  # noqa: E402
from tallyframe.plans import FOLDER_SETTING  # noqa: E402

SMOKE_FOLDER = "/root/testdata/sf0.001"

TEXT_LENGTH = "length(text)"

Query = Callable[[SparkSession, str], DataFrame]


def _name_folder(spark: SparkSession) -> None:
    """Intermediate tables go to the warehouse if no checkpoint folder is set.

    A warehouse in a folder of one machine is taken only where driver and executors are
    one process; on a cluster the tables would be missed by later reads, so the settings
    have to name a folder there.
    """
    if spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None):
        return
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    one_process = re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", ""))
    if one_process or not re.match("file:|/", warehouse):
        spark.conf.set(FOLDER_SETTING, f"{warehouse}/work")


def _with_folder(query: Query) -> Query:
    def named(spark: SparkSession, folder: str) -> DataFrame:
        _name_folder(spark)
        return query(spark, folder)

    return named


def entry(spark: SparkSession) -> DataFrame:
    """Supplier count and account balance per nation."""
    return queries()["region_value_feed"](spark, SMOKE_FOLDER)


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in columns})


def _measured(
    spark: SparkSession, folder: str, table: str, measure: str, *others: str
) -> DataFrame:
    """A table with its ``measure``; one made of whole texts is computed only once.

    The operators read their input several times, which is cheap for a column of
    numbers and is not for texts.
    """
    frame = read_table(spark, folder, table).select(
        F.expr(measure).alias("measure"), *(F.expr(other).alias("by") for other in others)
    )
    return durable(frame) if measure == TEXT_LENGTH else frame


# --- values per region -------------------------------------------------------


def _region(
    fact: str, dim: str, fact_key: str, dim_key: str, dim_name: str, measure: str
) -> tuple[Query, str]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        feed = region_value_feed(
            read_table(spark, folder, fact),
            read_table(spark, folder, dim),
            F.expr(fact_key),
            dim_key,
            dim_name,
            F.expr(measure),
        )
        return _rounded(feed, 4, "value")

    sql = f"""
        SELECT {dim_name} AS name, count({fact_key}) AS n, round(sum({measure}), 4) AS value
        FROM {dim} LEFT JOIN {fact} ON {fact_key} = {dim_key}
        GROUP BY {dim_key}, {dim_name}
    """
    return query, sql


# --- counts per category -----------------------------------------------------


def _categories(table: str, column: str, k: int | None = None) -> tuple[Query, str]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return category_counts(read_table(spark, folder, table), F.expr(column), k)

    sql = f"""
        SELECT CAST({column} AS VARCHAR) AS category, count(*) AS n,
               count(*) / (SELECT count(*) FROM {table}) AS share
        FROM {table}
        GROUP BY {column}
        ORDER BY n DESC, category ASC NULLS LAST
        {'' if k is None else f'LIMIT {k}'}
    """
    return query, sql


# --- series per period -------------------------------------------------------


def _periods(
    table: str,
    ts: str,
    period: str,
    measure: str,
    instant: str | None = None,
    zone: str | None = None,
) -> tuple[Query, str]:
    """``instant`` is the time in Spark if it is not the same as in SQL."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = read_table(spark, folder, table)
        series = period_series(rows, F.expr(instant or ts), period, measure, zone)
        return _rounded(series, 2, "value")

    step = {"quarter": "3 months"}.get(period, f"1 {period}")
    sql = f"""
        WITH per AS (
            SELECT CAST(date_trunc('{period}', {ts}) AS DATE) AS period,
                   count(*) AS n, sum({measure}) AS value
            FROM {table} WHERE {ts} IS NOT NULL GROUP BY 1
        ), calendar AS (
            SELECT CAST(unnest(generate_series(
                       (SELECT CAST(min(period) AS TIMESTAMP) FROM per),
                       (SELECT CAST(max(period) AS TIMESTAMP) FROM per),
                       INTERVAL '{step}')) AS DATE) AS period
        )
        SELECT period, coalesce(n, 0) AS n, round(value, 2) AS value
        FROM calendar LEFT JOIN per USING (period)
    """
    return query, sql


# --- histograms --------------------------------------------------------------


def _histogram(table: str, column: str, bins: int) -> tuple[Query, str]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        feed = histogram_feed(_measured(spark, folder, table, column), "measure", bins)
        return _rounded(feed, 6, "lo", "hi")

    sql = f"""
        WITH val AS (
            SELECT CAST({column} AS DOUBLE) AS x FROM {table}
            WHERE {column} IS NOT NULL AND isfinite(CAST({column} AS DOUBLE))
        ), ext AS (
            SELECT min(x) AS lo, max(x) AS hi FROM val
        ), hit AS (
            SELECT least(CAST(floor(coalesce((x - lo) / nullif(hi - lo, 0), 0) * {bins}) AS BIGINT)
                         + 1, {bins}) AS bin, count(*) AS n
            FROM val, ext GROUP BY 1
        )
        SELECT CAST(b AS BIGINT) AS bin,
               round(lo + (hi - lo) * (b - 1) / {bins}, 6) AS lo,
               round(lo + (hi - lo) * b / {bins}, 6) AS hi,
               coalesce(n, 0) AS n
        FROM range(1, {bins + 1}) AS r(b) CROSS JOIN ext LEFT JOIN hit ON hit.bin = r.b
    """
    return query, sql


# --- box plots ---------------------------------------------------------------


def _boxes(table: str, column: str, by: str) -> tuple[Query, str]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        summary = box_summary(_measured(spark, folder, table, column, by), "measure", "by")
        return _rounded(
            summary, 6, "min", "whisker_lo", "q1", "median", "q3", "whisker_hi", "max"
        )

    sql = f"""
        WITH val AS (
            SELECT {by} AS "by", CAST({column} AS DOUBLE) AS x FROM {table}
            WHERE {column} IS NOT NULL AND isfinite(CAST({column} AS DOUBLE))
        ), box AS (
            SELECT "by", count(*) AS n, min(x) AS lo, max(x) AS hi,
                   quantile_cont(x, 0.25) AS q1,
                   quantile_cont(x, 0.5) AS median,
                   quantile_cont(x, 0.75) AS q3
            FROM val GROUP BY "by"
        ), fence AS (
            SELECT *, q1 - 1.5 * (q3 - q1) AS from_x, q3 + 1.5 * (q3 - q1) AS to_x FROM box
        )
        SELECT f."by", any_value(f.n) AS n, round(any_value(f.lo), 6) AS min,
               round(min(x) FILTER (WHERE x BETWEEN from_x AND to_x), 6) AS whisker_lo,
               round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
               round(any_value(q3), 6) AS q3,
               round(max(x) FILTER (WHERE x BETWEEN from_x AND to_x), 6) AS whisker_hi,
               round(any_value(f.hi), 6) AS max,
               count(*) FILTER (WHERE x < from_x OR x > to_x) AS outliers
        FROM val JOIN fence f ON val."by" IS NOT DISTINCT FROM f."by"
        GROUP BY f."by"
    """
    return query, sql


def _approximate_boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the rank of each approximate quartile is as close as promised."""
    rows = read_table(spark, folder, "lineitem").selectExpr("l_returnflag AS by", "l_extendedprice AS x")
    boxes = box_summary(rows, "x", "by", approx=True).select("by", "min", "max", *QUARTILES)
    close = [
        F.expr(
            f"count_if(x < {name}) / count(*) <= {place} + {RANK_ERROR}"
            f" AND count_if(x <= {name}) / count(*) >= {place} - {RANK_ERROR}"
        ).alias(f"{name}_close")
        for name, place in QUARTILES.items()
    ]
    ends = [F.round(F.any_value(name), 6).alias(name) for name in ("min", "max")]
    return rows.join(boxes, "by").groupBy("by").agg(F.count("*").alias("n"), *ends, *close)


APPROXIMATE_BOXES_SQL = """
    SELECT l_returnflag AS "by", count(*) AS n, round(min(l_extendedprice), 6) AS min,
           round(max(l_extendedprice), 6) AS max,
           true AS q1_close, true AS median_close, true AS q3_close
    FROM lineitem GROUP BY 1
"""


# --- correlations ------------------------------------------------------------


def _correlations(table: str, columns: list[str] | dict[str, str]) -> tuple[Query, str]:
    """Of columns, or of expressions by name."""
    named = columns if isinstance(columns, dict) else {name: name for name in columns}

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = read_table(spark, folder, table).selectExpr(*(f"{e} AS {n}" for n, e in named.items()))
        return _rounded(correlation_matrix(rows, list(named)), 6, "r")

    names = list(named)
    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    sql = " UNION ALL ".join(
        f"""
        SELECT '{x}' AS x, '{y}' AS y,
               round(CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN corr(a, b) END, 6) AS r,
               count(*) AS n
        FROM (SELECT CAST({named[x]} AS DOUBLE) AS a, CAST({named[y]} AS DOUBLE) AS b FROM {table})
        WHERE isfinite(a) AND isfinite(b)
        """
        for x, y in pairs
    )
    return query, sql


WIDE = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "l_discount",
    "tax": "l_tax",
    "line": "l_linenumber",
    "revenue": "l_extendedprice * (1 - l_discount)",
    "charge": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
    "unit": "l_extendedprice / l_quantity",
    "part": "l_partkey % 100",
}


def _registry() -> dict[str, tuple[Query, str | None]]:
    return {
        "region_value_feed": _region(
            "supplier", "nation", "s_nationkey", "n_nationkey", "n_name", "s_acctbal"
        ),
        "region_value_feed_customers": _region(
            "customer", "nation", "c_nationkey", "n_nationkey", "n_name", "c_acctbal"
        ),
        "region_value_feed_supplier_revenue": _region(
            "lineitem",
            "supplier",
            "l_suppkey",
            "s_suppkey",
            "s_name",
            "l_extendedprice * (1 - l_discount)",
        ),
        "region_value_feed_customer_orders": _region(
            "orders", "customer", "o_custkey", "c_custkey", "c_name", "o_totalprice"
        ),
        "category_counts": _categories("part", "p_brand"),
        "category_counts_top_types": _categories("part", "p_type", 5),
        "category_counts_top_parts": _categories("lineitem", "l_partkey", 20),
        "category_counts_top_users": _categories("events", "user_id", 10),
        "category_counts_languages": _categories("documents", "lang"),
        "category_counts_sources": _categories("documents", "source"),
        "category_counts_roles": _categories("conversations", "role"),
        "period_series": _periods("orders", "o_orderdate", "month", "o_totalprice"),
        "period_series_daily": _periods("orders", "o_orderdate", "day", "o_totalprice"),
        "period_series_weekly": _periods("events", "ts", "week", "value"),
        "period_series_quarterly": _periods(
            "lineitem", "l_shipdate", "quarter", "l_extendedprice"
        ),
        "period_series_yearly": _periods("lineitem", "l_shipdate", "year", "l_quantity"),
        "histogram_feed": _histogram("lineitem", "l_discount", 10),
        "histogram_feed_prices": _histogram("lineitem", "l_extendedprice", 50),
        "histogram_feed_order_totals": _histogram("orders", "o_totalprice", 100),
        "histogram_feed_text_lengths": _histogram("documents", TEXT_LENGTH, 20),
        "box_summary": _boxes("lineitem", "l_extendedprice", "l_returnflag"),
        "box_summary_events": _boxes("events", "value", "event_type"),
        "box_summary_order_priority": _boxes("orders", "o_totalprice", "o_orderpriority"),
        "box_summary_suppliers": _boxes("lineitem", "l_quantity", "l_suppkey"),
        "box_summary_text_lengths": _boxes("documents", TEXT_LENGTH, "source"),
        "box_summary_approx": (_approximate_boxes, APPROXIMATE_BOXES_SQL),
        "correlation_matrix": _correlations(
            "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ),
        "correlation_matrix_parts": _correlations("part", ["p_size", "p_retailprice"]),
        "correlation_matrix_wide": _correlations("lineitem", WIDE),
        # The same with missing, unknown and non-finite values.
        "region_value_feed_missing": _region(
            "lineitem",
            "supplier",
            "CASE WHEN l_linenumber = 2 THEN l_suppkey + 1000000 ELSE l_suppkey END",
            "s_suppkey",
            "s_name",
            "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END",
        ),
        "category_counts_missing": _categories(
            "part", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END"
        ),
        "period_series_gaps": _periods(
            "orders",
            "CASE WHEN month(o_orderdate) % 3 = 0 THEN NULL ELSE o_orderdate END",
            "month",
            "o_totalprice",
        ),
        "period_series_zone": _periods(
            "events",
            "ts + INTERVAL 9 HOUR",
            "day",
            "value",
            instant="CAST(concat(CAST(ts AS STRING), ' UTC') AS TIMESTAMP)",
            zone="Asia/Tokyo",
        ),
        "histogram_feed_missing": _histogram(
            "lineitem", "CASE WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END", 7
        ),
        "histogram_feed_constant": _histogram("lineitem", "l_linenumber * 0 + 1.5", 4),
        "box_summary_missing": _boxes(
            "lineitem",
            "CASE WHEN l_linenumber = 2 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END",
            "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END",
        ),
        "correlation_matrix_missing": _correlations(
            "lineitem",
            {
                "price": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice END",
                "quantity": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END",
                "tax": "CASE WHEN l_linenumber = 4 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END",
            },
        ),
    }


def _text_registry() -> dict[str, tuple[Query, str | None]]:
    """The queries on texts and vectors, where their subpackage can be imported."""
    registry = {}
    for module in ("tallyframe.llm.queries", "corpus_pipeline"):
        try:
            found = import_module(module)
        except ImportError:  # the subpackage, or a library that it needs, is not there
            break
        registry |= found.registry()
    return registry


def _everything() -> dict[str, tuple[Query, str | None]]:
    return _registry() | _text_registry()


def queries() -> dict[str, Query]:
    """Every operator over the tables, under the name of the operator."""
    return {name: _with_folder(query) for name, (query, _) in _everything().items()}


def oracle_sql() -> dict[str, str]:
    """The same tables in SQL, for all queries that SQL can express."""
    return {name: sql for name, (_, sql) in _everything().items() if sql is not None}
