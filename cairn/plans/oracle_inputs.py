"""The logical inputs as SQL common table expressions (DuckDB dialect).

Twins of ``cairn.sources.testdata``; an oracle query names the inputs it needs
and ``with_inputs`` prepends their definitions.
"""

from __future__ import annotations

from cairn.sources.testdata import RANGE_LENGTHS, REFERRER_BY_K

_REF_CASE = "CASE " + " ".join(
    f"WHEN (k % 7) = {i} THEN '{u}'" for i, u in enumerate(REFERRER_BY_K)) + " END"

INPUTS: dict[str, str] = {
    "player_seasons": """
SELECT c.c_name AS player_name, c.c_mktsegment AS college, n.n_name AS country,
       s.season, s.gp, s.pts
FROM (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS season, COUNT(*) AS gp,
             CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) // (COUNT(*) * 100) AS BIGINT) AS pts
      FROM orders GROUP BY 1, 2) s
JOIN customer c ON c.c_custkey = s.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "actor_films": """
SELECT l_partkey AS actorid, l_orderkey AS filmid,
       CAST(min(year(l_shipdate)) AS BIGINT) AS year,
       CAST(sum(l_quantity) AS BIGINT) AS votes,
       CAST(max(round(l_discount * 100)) AS BIGINT) AS rating,
       'Film#' || CAST(l_orderkey AS VARCHAR) AS film
FROM lineitem GROUP BY l_partkey, l_orderkey""",
    "game_details": """
SELECT l.l_orderkey AS game_id, CAST(s.s_nationkey AS BIGINT) AS team_id, n.n_name AS team_abbreviation,
       l.l_suppkey AS player_id, s.s_name AS player_name,
       CASE l.l_linenumber WHEN 1 THEN 'F' WHEN 2 THEN 'C' WHEN 3 THEN 'G' END AS start_position,
       CASE WHEN l.l_returnflag = 'R' THEN 'DNP - Coach Decision'
            WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'DND - Injury'
            WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' AND l.l_linenumber > 5 THEN 'NWT - Personal' END AS comment,
       CASE WHEN l.l_returnflag = 'R' THEN NULL
            ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || ':' || lpad(CAST((l.l_linenumber * 7) % 60 AS VARCHAR), 2, '0') END AS min,
       CAST(l.l_quantity AS BIGINT) AS pts, CAST(l.l_linenumber AS BIGINT) AS reb,
       CAST(round(l.l_discount * 100) AS BIGINT) AS ast,
       CAST(round((l.l_tax - l.l_discount) * 100) AS BIGINT) AS plus_minus
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "games": """
SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date_est,
       CAST(year(o.o_orderdate) AS BIGINT) AS season, CAST(c.c_nationkey AS BIGINT) AS home_team_id,
       CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS BIGINT) AS visitor_team_id,
       CAST(floor(o.o_totalprice / 1000) AS BIGINT) % 60 + 80 AS pts_home,
       CAST(floor(o.o_totalprice / 100) AS BIGINT) % 60 + 80 AS pts_away,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS home_team_wins
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "teams": """
SELECT CAST(s.s_nationkey AS BIGINT) AS team_id, 'T' || lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS abbreviation,
       s.s_name AS nickname, r.r_name AS city, n.n_name || ' Arena' AS arena,
       CAST(s.s_nationkey + 1900 AS BIGINT) AS yearfounded
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "web_events": f"""
SELECT '/' || event_type AS url, {_REF_CASE} AS referrer, user_id, k AS device_id,
       'host' || CAST(user_id % 3 AS VARCHAR) || '.example.org' AS host,
       '10.' || CAST(user_id % 200 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.1' AS ip,
       ts AS event_time, event_type, value
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e""",
    "geo_lookup": """
SELECT c.c_custkey AS user_id,
       CAST(json_object('country', n.n_name, 'state', r.r_name, 'city', c.c_mktsegment) AS VARCHAR) AS geodata
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE c.c_acctbal >= 0""",
    "ip_events": """
SELECT event_id, ts AS event_time,
       CASE WHEN k % 31 = 0 THEN 'unknown' WHEN k % 37 <> 1 THEN concat_ws('.', 10, user_id % 256, user_id % 7, k + 1) END AS ip
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e""",
    "ip_ranges": f"""
SELECT concat_ws('.', 10, c_custkey % 200, c_custkey % 7, c_custkey % 100 + 1) AS address,
       CAST({list(RANGE_LENGTHS)}[c_custkey % {len(RANGE_LENGTHS)} + 1] AS INTEGER) AS bits,
       CAST(json_object('country', n_name, 'state', r_name, 'city', c_mktsegment) AS VARCHAR) AS geodata
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal >= 0""",
    "devices": """
SELECT c.c_custkey AS device_id, n.n_name AS browser_type, r.r_name AS os_type, c.c_mktsegment AS device_type
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "matches": """
SELECT o_orderkey AS match_id, CAST(o_custkey % 25 AS BIGINT) AS mapid, o_orderstatus = 'F' AS is_team_game,
       o_orderpriority AS playlist_id, o_orderdate AS completion_date
FROM orders""",
    "maps": "SELECT CAST(n_nationkey AS BIGINT) AS mapid, n_name AS map_name FROM nation",
    "match_details": """
SELECT l_orderkey AS match_id, 'P' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
       CAST(sum(l_quantity) AS BIGINT) AS player_total_kills, count(*) AS player_total_deaths
FROM lineitem GROUP BY 1, 2""",
    "medals_matches_players": """
SELECT l.l_orderkey AS match_id, 'P' || CAST(l.l_suppkey AS VARCHAR) AS player_gamertag, p.p_brand AS medal_id,
       count(*) AS count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2, 3""",
    "medals": "SELECT p_brand AS medal_id, max(p_brand) AS name FROM part GROUP BY p_brand",
    "match_scores": """
SELECT 'M' || CAST(l_suppkey AS VARCHAR) AS match_id, 'P' || CAST(l_partkey AS VARCHAR) AS player,
       CAST(l_quantity AS BIGINT) AS score FROM lineitem""",
    "order_revenue": """
SELECT p.l_orderkey AS order_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, p.net_cents
FROM (SELECT l_orderkey, CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS BIGINT) AS net_cents
      FROM lineitem GROUP BY l_orderkey) p
JOIN orders o ON p.l_orderkey = o.o_orderkey""",
}


def with_inputs(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <inputs>, <extra ctes> <body>``."""
    ctes = [f"{n} AS ({INPUTS[n]}\n)" for n in names]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
