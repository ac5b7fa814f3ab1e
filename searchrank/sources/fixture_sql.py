"""The search log of ``fixture.search_log`` written as plain SQL.

Used by the oracle queries (DuckDB over the same parquet tables); kept
independent of the DataFrame version so that each checks the other.
"""

from __future__ import annotations

_COMP = ",\n".join(
    f"  CASE WHEN h < {5 * k} THEN CAST(l_partkey % 3 - 1 AS INTEGER) END AS comp{k}_rate,\n"
    f"  CASE WHEN h < {5 * k} THEN CAST(l_suppkey % 2 AS INTEGER) END AS comp{k}_inv,\n"
    f"  CASE WHEN h < {4 * k} THEN l_quantity END AS comp{k}_rate_percent_diff"
    for k in range(1, 9)
)

LOG_SELECT = f"""
SELECT
  l_orderkey AS srch_id,
  l_partkey AS prop_id,
  l_linenumber AS position,
  l_suppkey AS supp_id,
  o_orderdate AS date_time,
  CAST(c_custkey % 34 AS INTEGER) AS site_id,
  c_nationkey AS visitor_location_country_id,
  s_nationkey AS prop_country_id,
  CAST(l_orderkey % 97 AS INTEGER) AS srch_destination_id,
  CASE WHEN l_orderkey % 10 < 3 THEN 1 ELSE 0 END AS random_bool,
  CASE WHEN c_custkey % 4 = 0 THEN CAST(1 + c_custkey % 5 AS DOUBLE) END AS visitor_hist_starrating,
  CASE WHEN c_custkey % 4 = 0 THEN abs(c_acctbal) END AS visitor_hist_adr_usd,
  CAST(p_size % 6 AS DOUBLE) AS prop_starrating,
  CASE WHEN (l_partkey + l_suppkey) % 7 <> 0 THEN CAST(l_partkey % 11 AS DOUBLE) / 2.0 END AS prop_review_score,
  CASE WHEN l_suppkey % 9 <> 0 THEN l_tax * 100.0 END AS prop_location_score1,
  CASE WHEN (l_suppkey + l_linenumber) % 5 <> 0 THEN l_discount END AS prop_location_score2,
  ln(p_retailprice) AS prop_log_historical_price,
  CASE WHEN (l_partkey + l_linenumber) % 13 <> 0 THEN l_extendedprice END AS price_usd,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS promotion_flag,
  CAST(1 + l_suppkey % 7 AS INTEGER) AS srch_length_of_stay,
  CAST(l_orderkey % 60 AS INTEGER) AS srch_booking_window,
  CAST(l_orderkey % 3 AS INTEGER) AS srch_adults_count,
  CAST(l_orderkey % 2 AS INTEGER) AS srch_children_count,
  CAST(1 + l_orderkey % 2 AS INTEGER) AS srch_room_count,
  CASE WHEN l_partkey % 16 = 0 THEN -1.0 * l_quantity END AS srch_query_affinity_score,
  CASE WHEN l_orderkey % 3 <> 0 THEN o_totalprice / 100.0 END AS orig_destination_distance,
{_COMP},
  CASE WHEN l_linestatus = 'F' OR l_partkey % 10 = 3 THEN 1 ELSE 0 END AS click_bool,
  CASE WHEN l_partkey % 10 = 3 THEN 1 ELSE 0 END AS booking_bool,
  CASE WHEN l_partkey % 10 = 3 THEN l_extendedprice END AS gross_bookings_usd
FROM (
  SELECT l.*, o.*, c.*, p.*, s.*,
         (l_partkey * 31 + CASE WHEN l_partkey % 2 = 0 THEN l_linenumber * 7 ELSE 0 END) % 100 AS h
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
) j
"""

# "WITH log AS (...)" prefix; oracle queries append ", more AS (...) SELECT ...".
LOG_CTE = f"WITH log AS ({LOG_SELECT})"

# The unlabeled test set: holdout searches without label columns.
TEST_CTE = (LOG_CTE + ", test AS (SELECT * EXCLUDE (position, click_bool, booking_bool, "
            "gross_bookings_usd) FROM log WHERE srch_id % 10 = 1)")


def with_log(body: str) -> str:
    """Prefix an oracle body (which may start with ', x AS (...)') by the log CTE."""
    body = body.strip()
    if body.startswith(","):
        return LOG_CTE + body
    return LOG_CTE + "\n" + body


def with_test(body: str) -> str:
    body = body.strip()
    if body.startswith(","):
        return TEST_CTE + body
    return TEST_CTE + "\n" + body
