"""Registration of queries with their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Views that the SQL of several queries shares; DuckDB runs only those used.
SHARED_SQL = """
WITH parts AS (
    SELECT p_partkey AS item, p_name, p_brand, p_type, p_size, p_retailprice FROM part
), ch AS (
    SELECT 'name' AS channel, item, unnest(string_split(p_name, ' ')) AS tag, 0.8::DOUBLE AS w FROM parts
    UNION ALL SELECT 'brand', item, p_brand, 2.0 FROM parts
    UNION ALL SELECT 'type', item, p_type, 1.0 FROM parts
), dict AS (
    SELECT tag, min(tag_id)::BIGINT AS tag_id FROM (
        SELECT DISTINCT p_brand AS tag, regexp_extract(p_brand, '\\d+')::BIGINT AS tag_id FROM parts
        UNION SELECT DISTINCT p_type, p_size FROM parts
    ) GROUP BY tag HAVING count(*) = 1
), tf AS (
    SELECT channel, item, tag, count(*) AS tf, max(w) AS w FROM ch GROUP BY channel, item, tag
), idf AS (
    SELECT channel, tag, ln((any_value(n) + 1) / (count(*) + 1)) AS idf
    FROM tf JOIN (SELECT channel, count(DISTINCT item)::DOUBLE AS n FROM tf GROUP BY channel) USING (channel) GROUP BY channel, tag
), weighted AS (
    SELECT channel, item, tag, round(tf * idf * w, 9) AS weight FROM tf JOIN idf USING (channel, tag)
), summed AS (
    SELECT item, tag, round(sum(weight), 9) AS weight FROM weighted GROUP BY item, tag
), merged AS (
    SELECT item, tag, round(coalesce(weight / nullif(max(weight) OVER (PARTITION BY item), 0), 0), 9) AS weight
    FROM (SELECT * FROM summed QUALIFY row_number() OVER (PARTITION BY item ORDER BY weight DESC, tag) <= 30)
), plays AS (
    SELECT o_custkey AS "user", l_partkey AS item, l_shipdate AS ts, l_shipdate::DATE AS day, l_quantity AS play,
           50.0::DOUBLE AS duration, l_quantity / 50 AS percent, l_orderkey, l_linenumber
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
), today AS (
    SELECT max(day) AS as_of FROM plays
), month AS (
    SELECT plays.*, date_diff('day', day, as_of) AS age FROM plays, today WHERE date_diff('day', day, as_of) BETWEEN 0 AND 30
), pool AS (
    SELECT item FROM parts WHERE p_size BETWEEN 1 AND 25
), ctr AS (
    SELECT user_id AS item, strftime(ts, '%w') AS zone, (event_type = 'click')::INT AS click, (event_type = 'view')::INT AS exposure FROM events
), searches AS (
    SELECT "user", item AS id, p_name AS query FROM plays JOIN parts USING (item)
), posted AS (
    SELECT tag, item, weight FROM merged WHERE item IN (SELECT item FROM pool)
), counts AS (
    SELECT item, unnest(list_distinct(list_concat(string_split(lower(query), ' '), [lower(query)]))) AS tag, n FROM (
        SELECT id AS item, query, count(*) AS n FROM searches GROUP BY id, query HAVING count(*) > 5
    )
), qcounts AS (
    SELECT item, tag, sum(n)::BIGINT AS n FROM counts WHERE length(tag) >= 2 GROUP BY item, tag
), qtags AS (
    SELECT item, tag, weight FROM (
        SELECT item, tag, round(n / max(n::DOUBLE) OVER (PARTITION BY item), 9) AS weight FROM qcounts
    ) WHERE weight > 0.01 QUALIFY row_number() OVER (PARTITION BY item ORDER BY weight DESC, tag) <= 30
), userday AS (
    SELECT day, "user", tag, weight FROM (
        SELECT day, "user", tag, round(sum(percent * weight), 9) AS weight FROM month JOIN merged USING (item) GROUP BY day, "user", tag
    ) WHERE weight > 0.01
), usermonth AS (
    SELECT "user", tag, weight FROM (
        SELECT "user", tag, round(sum(weight * CASE WHEN age <= 0 THEN 1.0 ELSE least(1.0, pow(age, -0.35)) END), 9) AS weight
        FROM (SELECT userday.*, date_diff('day', day, as_of) AS age FROM userday, today) GROUP BY "user", tag
    ) QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY weight DESC, tag) <= 100
), members AS (
    SELECT DISTINCT l_suppkey AS collection, l_partkey AS item FROM lineitem
), eps AS (
    SELECT l_orderkey AS collection, l_partkey AS item, max(l_linenumber) AS number FROM lineitem GROUP BY 1, 2
), latest AS (
    SELECT *, max(number) OVER (PARTITION BY collection) AS latest FROM eps
), epw AS (
    SELECT collection, item, number, latest, CASE WHEN number = 0 OR latest = 0 OR number > latest THEN 0.2 ELSE number::DOUBLE / latest END AS weight FROM latest
), titles AS (
    SELECT item, p_name AS title FROM parts
)
"""


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name; ``sql`` may use SHARED_SQL's views."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE_SQL[key] = SHARED_SQL + sql
        return function

    return register
