"""Logical inputs of the workloads, derived from the driver's parquet tables.

The only module that knows the test-data table names. Every logical table is a
lazy DataFrame over the whole parquet tables, so its size grows with the scale
factor. Metrics are integer-valued where a threshold or a sum depends on them,
so that any engine computes the same values regardless of summation order.

Joins carry no hints: AQE turns one into a broadcast once it has measured the
materialised side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.files import path_version

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


_READS: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``; the (lazy, immutable) DataFrame is reused per session and path as
    long as its files are the same, so their footers are read once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, path_version(spark, path))
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


def _nation(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation")


def _region(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "region")


def player_seasons(spark: SparkSession, sf_dir: str, first: int | None = None,
                   last: int | None = None) -> DataFrame:
    """player_name, college, country, season, gp, pts: one row per (player, season).

    A player is a customer, a season a calendar year of orders; gp = orders,
    pts = mean order value in whole units (cents summed exactly, then divided).
    ``first`` / ``last`` bound the seasons with a range on the raw order date, so
    the scan prunes (a yearly step reads one year).
    """
    o = table(spark, sf_dir, "orders")
    if first is not None:
        o = o.where(F.col("o_orderdate") >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
    if last is not None:
        o = o.where(F.col("o_orderdate") < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))
    per = (o.groupBy(F.col("o_custkey"), F.year("o_orderdate").cast("bigint").alias("season"))
           .agg(F.count(F.lit(1)).alias("gp"),
                F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = _nation(spark, sf_dir).select("n_nationkey", "n_name")
    return (per.join(c, per.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_name").alias("player_name"),
                    F.col("c_mktsegment").alias("college"),
                    F.col("n_name").alias("country"),
                    "season", "gp",
                    F.expr("cents div (gp * 100)").alias("pts")))


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """actorid, film, filmid, year, votes, rating: unique on (actorid, filmid)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_partkey").alias("actorid"), F.col("l_orderkey").alias("filmid"))
            .agg(F.min(F.year("l_shipdate")).cast("bigint").alias("year"),
                 F.sum("l_quantity").cast("bigint").alias("votes"),
                 F.max(F.round(F.col("l_discount") * 100)).cast("bigint").alias("rating"))
            .withColumn("film", F.concat(F.lit("Film#"), F.col("filmid").cast("string"))))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (game, player) line, with real duplicates (same supplier twice in an order)."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = _nation(spark, sf_dir).select("n_nationkey", "n_name")
    ln = F.col("l_linenumber")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
            .join(n, s.s_nationkey == n.n_nationkey)
            .select(F.col("l_orderkey").alias("game_id"),
                    F.col("s_nationkey").cast("bigint").alias("team_id"),
                    F.col("n_name").alias("team_abbreviation"),
                    F.col("l_suppkey").alias("player_id"),
                    F.col("s_name").alias("player_name"),
                    F.when(ln == 1, "F").when(ln == 2, "C").when(ln == 3, "G").alias("start_position"),
                    F.when(rf == "R", "DNP - Coach Decision")
                     .when((rf == "A") & (ls == "O"), "DND - Injury")
                     .when((rf == "N") & (ls == "O") & (ln > 5), "NWT - Personal").alias("comment"),
                    F.when(rf == "R", F.lit(None).cast("string"))
                     .otherwise(F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(":"),
                                         F.lpad(((ln * 7) % 60).cast("string"), 2, "0"))).alias("min"),
                    F.col("l_quantity").cast("bigint").alias("pts"),
                    ln.cast("bigint").alias("reb"),
                    F.round(F.col("l_discount") * 100).cast("bigint").alias("ast"),
                    F.round((F.col("l_tax") - F.col("l_discount")) * 100).cast("bigint").alias("plus_minus")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("game_id"),
                    F.to_date("o_orderdate").alias("game_date_est"),
                    F.year("o_orderdate").cast("bigint").alias("season"),
                    F.col("c_nationkey").cast("bigint").alias("home_team_id"),
                    ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("bigint").alias("visitor_team_id"),
                    (F.floor(F.col("o_totalprice") / 1000).cast("bigint") % 60 + 80).alias("pts_home"),
                    (F.floor(F.col("o_totalprice") / 100).cast("bigint") % 60 + 80).alias("pts_away"),
                    F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("bigint").alias("home_team_wins")))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several candidate rows per team (one per supplier of the nation): needs a dedupe."""
    s = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    n = _nation(spark, sf_dir)
    r = _region(spark, sf_dir)
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("s_nationkey").cast("bigint").alias("team_id"),
                    F.concat(F.lit("T"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("abbreviation"),
                    F.col("s_name").alias("nickname"),
                    F.col("r_name").alias("city"),
                    F.concat(F.col("n_name"), F.lit(" Arena")).alias("arena"),
                    (F.col("s_nationkey") + 1900).cast("bigint").alias("yearfounded")))


# Referrer URL assigned by k % 7 of the event's props; 6 = direct (NULL).
REFERRER_BY_K = (
    "https://www.linkedin.com/feed/",
    "https://t.co/x1",
    "https://www.google.com/",
    "https://lnkd.in/abc",
    "https://host1.example.org/blog",
    "https://www.pinterest.com/pin/1",
)


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, referrer, user_id, device_id, host, ip, event_time (timestamp_ntz), event_type, value."""
    return web_events_from(table(spark, sf_dir, "events"))


def web_events_from(e: DataFrame) -> DataFrame:
    """The web-event projection of the ``events`` table; works on batch and streaming frames."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    ref = None
    for i, url in enumerate(REFERRER_BY_K):
        ref = F.when(k % 7 == i, url) if ref is None else ref.when(k % 7 == i, url)
    return e.select(
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        ref.alias("referrer"),
        F.col("user_id"),
        k.alias("device_id"),
        F.concat(F.lit("host"), (F.col("user_id") % 3).cast("string"), F.lit(".example.org")).alias("host"),
        F.concat(F.lit("10."), (F.col("user_id") % 200).cast("string"), F.lit("."),
                 (F.col("user_id") % 7).cast("string"), F.lit(".1")).alias("ip"),
        F.col("ts").alias("event_time"),
        F.col("event_type"),
        F.col("value"),
    )


def geo_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> geodata JSON (country, state, city); customers with a negative
    balance have no entry, so some lookups miss."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    n = _nation(spark, sf_dir)
    r = _region(spark, sf_dir)
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("c_custkey").alias("user_id"),
                    F.to_json(F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("state"),
                                       F.col("c_mktsegment").alias("city"))).alias("geodata"))


def ip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ip, event_time: a fuller spread of addresses than ``web_events`` (whose mapping is fixed)."""
    return ip_events_from(table(spark, sf_dir, "events"))


def ip_events_from(e: DataFrame) -> DataFrame:
    """The address projection of ``events``, batch or stream: some rows have no address, some no valid one."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    octets = [F.lit("10"), (F.col("user_id") % 256).cast("string"), (F.col("user_id") % 7).cast("string"), (k + 1).cast("string")]
    ip = F.when(k % 31 == 0, F.lit("unknown")).when(k % 37 != 1, F.concat_ws(".", *octets))
    return e.select("event_id", ip.alias("ip"), F.col("ts").alias("event_time"))


# Prefix lengths of the address ranges, dealt by customer number.
RANGE_LENGTHS = (14, 16, 20, 24, 32)


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cidr -> geodata JSON: overlapping ranges of several lengths, one per customer with a balance."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    j = (c.join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(_region(spark, sf_dir), F.col("n_regionkey") == F.col("r_regionkey")))
    key = F.col("c_custkey")
    octets = [F.lit("10"), *(x.cast("string") for x in (key % 200, key % 7, key % 100 + 1))]
    length = F.element_at(F.array(*map(F.lit, RANGE_LENGTHS)), (key % len(RANGE_LENGTHS) + 1).cast("int"))
    return j.select(F.concat(F.concat_ws(".", *octets), F.lit("/"), length.cast("string")).alias("cidr"),
                    F.to_json(F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("state"),
                                       F.col("c_mktsegment").alias("city"))).alias("geodata"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _nation(spark, sf_dir)
    r = _region(spark, sf_dir)
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("device_id"),
                    F.col("n_name").alias("browser_type"),
                    F.col("r_name").alias("os_type"),
                    F.col("c_mktsegment").alias("device_type")))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    (F.col("o_custkey") % 25).cast("bigint").alias("mapid"),
                    (F.col("o_orderstatus") == "F").alias("is_team_game"),
                    F.col("o_orderpriority").alias("playlist_id"),
                    F.col("o_orderdate").alias("completion_date"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("mapid"),
                                                 F.col("n_name").alias("map_name"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("match_id"),
                       F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("player_gamertag"))
            .agg(F.sum("l_quantity").cast("bigint").alias("player_total_kills"),
                 F.count(F.lit(1)).alias("player_total_deaths")))


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .groupBy(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
                     F.col("p_brand").alias("medal_id"))
            .agg(F.count(F.lit(1)).alias("count")))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.groupBy(F.col("p_brand").alias("medal_id")).agg(F.max("p_brand").alias("name"))


def match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(match_id, player, score): the bucketing workload's rows, one per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("match_id"),
                     F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("player"),
                     F.col("l_quantity").cast("bigint").alias("score"))


def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit-level profit facts: one row per order with its day and net revenue in cents."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    per = (li.groupBy("l_orderkey")
           .agg(F.sum(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("bigint"))
                .alias("net_cents")))
    return (per.join(o, per.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"), "net_cents"))
