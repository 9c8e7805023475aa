
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart.plans import reports  # noqa: E402

# The training-data operators may be absent; an import that fails inside them is an error.
try:
    import tidemart.llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name != "tidemart.llm":
        raise
    llm = None
else:
    from tidemart.llm import queries as llm  # noqa: E402
try:
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("tidemart.llm"):
        raise
    corpus_pipeline = None

_QUERIES = (
    reports.daily_revenue_by_category,
    reports.daily_revenue_by_category_large_catalog,
    reports.daily_revenue,
    reports.top_products_daily,
    reports.best_sellers_daily,
    reports.hourly_event_counts,
    reports.event_type_summary,
    reports.federated_top_products,
    reports.partition_scan,
    reports.ingest_enrich,
    reports.ingest_enrich_large_catalog,
    reports.raw_ingest,
    reports.ingest_stream,
    reports.raw_ingest_stream,
    reports.compacted_events,
    reports.dq_report,
    reports.dq_report_from_states,
    reports.dq_metrics_append,
    reports.quality_gate,
    reports.product_summary,
    reports.customer_tiers,
    reports.insert_if_absent,
    reports.serial_keys,
    reports.partition_overwrite,
    reports.counter_rate,
    reports.counter_rate_by_topic,
    reports.lag_by_topic,
    reports.latest_value,
    reports.latest_value_stream,
    reports.lag_by_topic_stream,
    reports.events_per_minute,
    reports.events_per_minute_stream,
    reports.source_ready,
    reports.source_ready_since_mark,
    reports.late_days_rebuilt,
    reports.marts_from_measures,
    reports.daily_marts,
    reports.daily_run,
)

# Common table expressions: the given tables in the shapes of the event model.
_FACTS = """facts AS (
    SELECT user_id, event_type, json_extract_string(props, '$.k') AS product, value AS amount,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, date_trunc('second', ts) AS event_time,
           strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr
    FROM events
)"""
_CATALOG = """catalog AS (
    SELECT p_partkey AS product_id,
           CASE WHEN p_size > 45 THEN 'retired-' || CAST(p_partkey AS VARCHAR)
                ELSE CAST(p_partkey AS VARCHAR) END AS name,
           p_type AS category, CAST(p_retailprice AS DECIMAL(10, 2)) AS base_price,
           (p_size - 5) * 10 AS stock
    FROM part
)"""
_SUM = "CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE)"
_AVG = """CAST((2 * sum(CAST(round(amount * 100) AS BIGINT)) + count(amount))
         // (2 * count(amount)) AS DOUBLE) / 100"""

_REVENUE = f"""
WITH {_FACTS}, {_CATALOG}
SELECT dt, coalesce(category, 'unknown') AS category, event_type,
       count(*) AS event_count, {_SUM} AS total_revenue, {_AVG} AS avg_order
FROM facts LEFT JOIN catalog ON product = name
GROUP BY ALL"""

_TOP_PRODUCTS = f"""
SELECT dt, product, coalesce(category, 'unknown') AS category,
       count(*) AS orders, {_SUM} AS revenue
FROM facts LEFT JOIN catalog ON product = name
WHERE event_type = 'purchase'
GROUP BY ALL"""

_ENRICHED = f"""
WITH {_FACTS}, {_CATALOG}
SELECT user_id, event_type, product, coalesce(category, 'unknown') AS category,
       amount, ts, event_time, dt, hr
FROM facts LEFT JOIN catalog ON product = name"""

_RAW = """
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS event,
       CASE WHEN event_type <> 'purchase' THEN round(value) END AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts
FROM events
UNION ALL
SELECT NULL, NULL, NULL, NULL FROM documents"""

_LAGS = """
WITH newest AS (
    SELECT o_orderpriority AS topic, o_totalprice AS value FROM orders
    WHERE o_orderstatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
)
SELECT topic, count(*) AS series,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS lag
FROM newest GROUP BY ALL"""
_LATEST = """
WITH newest AS (
    SELECT event_type, ts, value FROM events WHERE value <> 0
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
)
SELECT event_type, ts, value,
       CASE WHEN value >= 500 THEN 'red' WHEN value >= 100 THEN 'yellow' ELSE 'green' END AS band,
       value / 1073741824 AS gib
FROM newest"""

_CHECKED = """counts AS (
    SELECT count(*) AS total,
           1.0 - count(*) FILTER (user_id IS NULL) / greatest(count(*), 1)::DOUBLE AS users,
           1.0 - count(*) FILTER (event_type IS NULL) / greatest(count(*), 1)::DOUBLE AS types,
           count(*) FILTER (event_type = 'purchase') AS purchases,
           1.0 - count(*) FILTER (event_type = 'purchase' AND value <= 0)
               / greatest(count(*) FILTER (event_type = 'purchase'), 1)::DOUBLE AS amounts,
           1.0 - count(*) FILTER (event_type NOT IN ('signup', 'purchase', 'view', 'click'))
               / greatest(count(*), 1)::DOUBLE AS valid
    FROM present
),
checks AS (
    SELECT 'row_count >= 1' AS check_name, total >= 1 AS passed,
           total::DOUBLE AS value, 1.0::DOUBLE AS threshold FROM counts
    UNION ALL SELECT 'user_id completeness >= 0.99', users >= 0.99, round(users, 4), 0.99 FROM counts
    UNION ALL SELECT 'event_type completeness >= 0.99', types >= 0.99, round(types, 4), 0.99 FROM counts
    UNION ALL SELECT 'purchase amount > 0', amounts >= 1, round(amounts, 4), 1.0 FROM counts
        WHERE purchases > 0
    UNION ALL SELECT 'event_type in valid set', valid >= 0.99, round(valid, 4), 0.99 FROM counts
)"""
_RATIOS = f"present AS (SELECT * FROM events), {_CHECKED}"
_STATUS = "CASE WHEN passed THEN 'SUCCESS' ELSE 'FAILURE' END AS status"


def _tier(key: str) -> str:
    return f"CASE WHEN {key} % 10 = 0 THEN 'gold' WHEN {key} % 5 = 0 THEN 'silver' ELSE 'bronze' END"


def _country(key: str) -> str:
    return f"(['US', 'UK', 'IN', 'DE', 'AU'])[1 + {key} % 5]"


def _increases(width: int, step: int) -> str:
    """Samples paired with the one before inside each window, one value per topic and instant."""
    back = ", ".join(str(i * step) for i in range(-(-width // step)))
    return f"""samples AS (
    SELECT event_type AS topic, ts, CAST(max(event_id % 1000) AS DOUBLE) AS value
    FROM events GROUP BY ALL
),
placed AS (
    SELECT topic, ts, value,
           CAST(floor(epoch(ts) / {step}) AS BIGINT) * {step} - unnest([{back}]) AS start
    FROM samples
),
paired AS (
    SELECT topic, start, value, lag(value) OVER (PARTITION BY topic, start ORDER BY ts) AS prev
    FROM placed WHERE epoch(ts) < start + {width}
),
increases AS (
    SELECT topic, make_timestamp(start * 1000000) AS window_start, count(*) AS samples,
           sum(CASE WHEN prev IS NULL THEN 0 WHEN value >= prev THEN value - prev ELSE value END)
               AS increase
    FROM paired GROUP BY ALL HAVING count(*) >= 2
)"""


def entry(spark: SparkSession) -> DataFrame:
    return reports.daily_revenue_by_category(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if llm is not None:
        found |= llm.queries()
        if corpus_pipeline is not None:
            found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _library_sql()
    if llm is not None:
        found |= llm.oracle_sql()
        if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _library_sql() -> dict[str, str]:
    return {
        "daily_revenue_by_category": _REVENUE,
        "daily_revenue_by_category_large_catalog": _REVENUE,
        "daily_revenue": f"""
            SELECT dt, category, event_type, event_count, total_revenue FROM ({_REVENUE})""",
        "top_products_daily": f"""
            WITH {_FACTS}, {_CATALOG}, sold AS ({_TOP_PRODUCTS})
            SELECT *, row_number() OVER (
                       PARTITION BY dt ORDER BY revenue DESC NULLS LAST, product NULLS FIRST, category) AS rank
            FROM sold""",
        "best_sellers_daily": f"""
            WITH {_FACTS}, {_CATALOG}, sold AS ({_TOP_PRODUCTS})
            SELECT *, CAST(row_number() OVER (
                       PARTITION BY dt ORDER BY revenue DESC, product, category) AS INTEGER) AS rank
            FROM sold QUALIFY rank <= 3""",
        "hourly_event_counts": f"""
            WITH {_FACTS}
            SELECT dt, hr, event_type, count(*) AS event_count FROM facts GROUP BY ALL""",
        "event_type_summary": f"""
            WITH {_FACTS}
            SELECT event_type, count(*) AS cnt, {_SUM} AS revenue FROM facts GROUP BY ALL""",
        "federated_top_products": f"""
            WITH {_FACTS}, {_CATALOG}
            SELECT product, category, count(*) AS orders, {_SUM} AS revenue
            FROM facts JOIN catalog ON product = name
            WHERE event_type = 'purchase'
            GROUP BY ALL ORDER BY revenue DESC, product, category LIMIT 5""",
        "partition_scan": f"""
            WITH {_FACTS}
            SELECT user_id, event_type, product, amount, ts, dt, hr FROM facts
            WHERE dt = '2024-01-15'""",
        "ingest_enrich": _ENRICHED,
        "ingest_enrich_large_catalog": _ENRICHED,
        "raw_ingest": _RAW,
        "ingest_stream": _ENRICHED,
        "raw_ingest_stream": _RAW,
        "compacted_events": _ENRICHED,
        "dq_report": f"""
            WITH {_RATIOS} SELECT check_name, {_STATUS}, value, threshold FROM checks""",
        "dq_report_from_states": f"""
            WITH present AS (
                SELECT * FROM events WHERE event_type <> 'error' OR strftime(ts, '%Y-%m-%d') <> '2024-01-15'
            ), {_CHECKED}
            SELECT check_name, {_STATUS}, value, threshold FROM checks""",
        "dq_metrics_append": f"""
            WITH {_RATIOS}
            SELECT unnest(['2024-01-30', '2024-01-31']) AS run_date, check_name, {_STATUS},
                   CASE WHEN check_name = 'row_count >= 1' THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                        ELSE CAST(value AS VARCHAR) END AS value,
                   CASE WHEN check_name = 'row_count >= 1' THEN '1'
                        ELSE CAST(threshold AS VARCHAR) END AS threshold
            FROM checks""",
        "quality_gate": f"""
            WITH {_RATIOS}
            SELECT bool_and(passed) AS passed,
                   coalesce(string_agg(check_name, ', ' ORDER BY check_name)
                            FILTER (NOT passed), '') AS failed_checks
            FROM checks""",
        "product_summary": f"""
            WITH {_CATALOG}
            SELECT name, category, CAST(base_price AS DOUBLE) AS base_price, stock,
                   CASE WHEN stock > 100 THEN 'in_stock' WHEN stock > 0 THEN 'low_stock'
                        ELSE 'out_of_stock' END AS availability
            FROM catalog""",
        "customer_tiers": f"""
            SELECT c_custkey AS user_id, 'user' || c_custkey || '@example.com' AS email,
                   {_tier("c_custkey")} AS tier, {_country("c_custkey")} AS country
            FROM customer""",
        "insert_if_absent": f"""
            WITH known AS (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id FROM events)
            SELECT user_id, 'user' || user_id || '@example.com' AS email,
                   {_tier("user_id")} AS tier, {_country("user_id")} AS country
            FROM known
            UNION ALL
            SELECT DISTINCT CAST(o_custkey AS INTEGER), 'user' || o_custkey || '@example.com',
                   'bronze', 'US'
            FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM known)""",
        "serial_keys": """
            WITH names AS (SELECT p_name AS name FROM part UNION SELECT s_name FROM supplier),
            used AS (SELECT max(p_partkey) AS last FROM part)
            SELECT last + row_number() OVER (ORDER BY name) AS product_id, name,
                   CAST(NULL AS VARCHAR) AS category, CAST(0 AS BIGINT) AS stock
            FROM names, used""",
        "partition_overwrite": f"""
            WITH {_FACTS}
            SELECT dt, hr, event_type, count(*) AS event_count FROM facts
            WHERE dt < '2024-01-16' OR event_type <> 'error'
            GROUP BY ALL""",
        "counter_rate": f"""
            WITH {_increases(3600, 1800)}
            SELECT window_start, sum(increase) / 3600 AS rate FROM increases GROUP BY ALL""",
        "counter_rate_by_topic": f"""
            WITH {_increases(3600, 3600)}
            SELECT topic, window_start, samples, increase / 3600 AS rate FROM increases""",
        "lag_by_topic": _LAGS,
        "lag_by_topic_stream": _LAGS,
        "latest_value": _LATEST,
        "latest_value_stream": _LATEST,
        "events_per_minute": """
            SELECT date_trunc('minute', ts) AS window_start, count(*) AS events,
                   count(*) / 60.0::DOUBLE AS per_second
            FROM events GROUP BY ALL""",
        "events_per_minute_stream": """
            SELECT date_trunc('minute', ts) AS window_start, count(*) AS events,
                   count(*) / 60.0::DOUBLE AS per_second
            FROM events
            WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE
                  <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
            GROUP BY ALL""",
        "source_ready": """
            SELECT count(*) > 0 AS any_record,
                   count(*) FILTER (ts > TIMESTAMP '2024-01-15') > 0 AS after_mid_month,
                   count(*) FILTER (ts > TIMESTAMP '2024-02-01') > 0 AS after_month
            FROM events""",
        "source_ready_since_mark": """
            SELECT probe, probe < 3 AS ready,
                   CASE WHEN probe = 1 THEN (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')
                        ELSE (SELECT max(ts) FROM events) END AS mark
            FROM (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS probe)""",
        "late_days_rebuilt": _REVENUE,
        "marts_from_measures": _REVENUE,
        "daily_marts": _REVENUE,
        # A bad purchase stops the run before the marts; all event types count as valid here.
        "daily_run": f"""
            SELECT * FROM ({_REVENUE})
            WHERE NOT EXISTS (SELECT * FROM events WHERE event_type = 'purchase' AND value <= 0)
              AND (SELECT count(user_id) >= 0.99 * count(*) AND count(event_type) >= 0.99 * count(*)
                   FROM events)""",
    }
