"""Match analytics over a bucketed layout (match_details, matches, medals per
player) with two small dimensions (maps, medals).

Aggregates are taken at the grain of their fact before any fan-out: kills per
match from match_details, never after the join with medal rows (which repeats
a player's match row once per medal type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.operators.sequence import global_rank
from cairn.session import written

BUCKETS = 16
BUCKET_BYTES = 1 << 30


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = BUCKETS) -> int:
    """Buckets of about ``bucket_bytes`` for a table, a power of two so that tables of unequal counts
    can still be joined bucket by bucket. The size is that of all the tables ``df`` reads, nothing is
    run: the optimizer's estimate of a join is the product of its sides, far above what it returns."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    n = least
    while n * bucket_bytes < size and n < 1 << 17:
        n *= 2
    return n


def avg_kills_per_player(match_details: DataFrame, matches: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` players by kills per match played (ties by gamertag)."""
    md = match_details.join(matches.select("match_id"), "match_id", "left_semi")
    agg = md.groupBy("player_gamertag").agg(
        (F.sum("player_total_kills") / F.count(F.lit(1))).alias("avg_kills_per_game"),
        F.count(F.lit(1)).alias("games"))
    return agg.orderBy(F.col("avg_kills_per_game").desc(), F.col("player_gamertag")).limit(k)


def matches_played_by(matches: DataFrame, match_details: DataFrame, dim_col: str, maps: DataFrame | None = None
                      ) -> DataFrame:
    """Matches with details, counted per ``dim_col`` (playlist_id, or map_name via the maps dimension),
    ranked by count (ties by name)."""
    m = matches.join(match_details.select("match_id"), "match_id", "left_semi")
    if maps is not None:
        m = m.join(maps, "mapid")
    counts = m.groupBy(dim_col).agg(F.count(F.lit(1)).alias("match_count"))
    return global_rank(counts, [F.col("match_count").desc(), F.col(dim_col)])


def medal_count_by_map(medals_matches_players: DataFrame, medals: DataFrame, matches: DataFrame,
                       maps: DataFrame, medal_name: str) -> DataFrame:
    """Total count of one medal per map, ranked (ties by name)."""
    med = medals.where(F.col("name") == medal_name).select("medal_id")
    mmp = medals_matches_players.join(med, "medal_id")
    per_match = mmp.groupBy("match_id").agg(F.sum("count").alias("_n"))       # reduce before the join
    j = per_match.join(matches.select("match_id", "mapid"), "match_id").join(maps, "mapid")
    totals = j.groupBy("map_name").agg(F.sum("_n").cast("bigint").alias("total_medals"))
    return global_rank(totals, [F.col("total_medals").desc(), F.col("map_name")])


# ------------------------------------------------------------ bucketed layout ---

def write_bucketed(df: DataFrame, table: str, path: str, key: str | None = "match_id",
                   buckets: int = BUCKETS) -> None:
    """Parquet table at ``path`` (a shared folder), bucketed and sorted on ``key``
    (plain when ``key`` is None), registered in the catalog as ``table``.

    Rows are dealt by the bucket key before the write, so a bucket is one file, not one per task.
    ``buckets`` is a layout parameter, e.g. ``bucket_count(df)`` (100 TB at 1 GB: 131,072); Spark's
    bound on it is raised to it where it is lower, as it is read when the write is planned."""
    if key is not None:
        df = df.repartition(buckets, key)
        spark = df.sparkSession
        most = max(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", str(most))
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if key is not None:
        w = w.bucketBy(buckets, key).sortBy(key)
    w.saveAsTable(table)


def bucketed_match_join(spark: SparkSession, details_table: str, matches_table: str, medals_table: str,
                        maps: DataFrame, medals: DataFrame) -> DataFrame:
    """match_details JOIN matches JOIN medals_matches_players, all bucketed on match_id:
    the three scans are co-partitioned, so the joins need no exchange; the two
    dimensions are broadcast where their measured size allows.

    Joining on (match_id, player_gamertag) reuses the match_id bucketing when
    ``spark.sql.requireAllClusterKeysForCoPartition`` is false (set by this function).
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    md = spark.table(details_table)
    m = spark.table(matches_table)
    mmp = spark.table(medals_table)
    j = md.join(m, "match_id").join(mmp, ["match_id", "player_gamertag"])
    j = j.join(maps, "mapid", "left")
    j = j.join(medals.select("medal_id", F.col("name").alias("medal_name")), "medal_id", "left")
    return j.select("match_id", "player_gamertag", "player_total_kills", "player_total_deaths", "mapid",
                    "map_name", "playlist_id", "is_team_game", "medal_id", "medal_name",
                    F.col("count").alias("medal_count"))


def unequal_bucket_join(spark: SparkSession, left_table: str, right_table: str, key: str) -> DataFrame:
    """INNER JOIN of two tables bucketed on ``key`` into different numbers of buckets.

    Where the larger number is a multiple of the smaller, Spark reads several buckets of the finer
    table as one (``spark.sql.bucketing.coalesceBucketsInJoin.enabled``, set by this function, as it
    is read when the returned frame is planned), and neither side is shuffled. The ratio is bounded
    by ``...maxBucketRatio``, raised here to the tables' own ratio: tasks are as many as the coarser
    table has buckets.
    """
    counts = sorted(_buckets(spark, t) for t in (left_table, right_table))
    if counts[1] % counts[0] == 0:
        spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
        ratio = max(counts[1] // counts[0], int(spark.conf.get("spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio")))
        spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio", str(ratio))
    return spark.table(left_table).join(spark.table(right_table), key)


def _buckets(spark: SparkSession, table: str) -> int:
    told = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(told.data_type)


def bucket_filter_avg(spark: SparkSession, table: str, match_id: str, layout: str) -> DataFrame:
    """Mean score of one match id; on a bucketed table the filter prunes to one bucket."""
    t = spark.table(table).where(F.col("match_id") == match_id)
    return t.groupBy("match_id").agg(F.avg("score").alias("avg_score"), F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit(layout).alias("layout"), "match_id", "avg_score", "n_rows")


# --------------------------------------------------------------- layout size ---

LAYOUTS = ("ranged", "sorted", "global")


def write_layouts(df: DataFrame, root: str, sort_cols: list[str], n: int | None = None) -> None:
    """Write ``df`` in three layouts: dealt by ``n`` ranges of ``sort_cols`` (the session's shuffle
    partitions by default, so ranges follow the size the session is set up for), the same sorted
    within each file, and globally sorted. Ranges of several columns split a hot value of the first.
    The input is computed once."""
    base = written(df, "layout-input")
    ranged = base.repartitionByRange(n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *sort_cols)
    ranged.write.mode("overwrite").parquet(f"{root}/ranged")
    ranged.sortWithinPartitions(*sort_cols).write.mode("overwrite").parquet(f"{root}/sorted")
    base.orderBy(*sort_cols).write.mode("overwrite").parquet(f"{root}/global")


def layout_size_report(spark: SparkSession, root: str) -> DataFrame:
    """Bytes and files of each layout ``write_layouts`` wrote."""
    parts = [spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{root}/{layout}").select("length")
             .agg(F.sum("length").cast("bigint").alias("size_bytes"), F.count(F.lit(1)).alias("num_files"))
             .select(F.lit(layout).alias("layout"), "size_bytes", "num_files") for layout in LAYOUTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def layout_order_report(spark: SparkSession, root: str, sort_cols: list[str]) -> DataFrame:
    """What each layout promises, checked on its files: rows, first and last value of the first sort
    column, rows out of order within their file, and files whose range overlaps another's."""
    key = F.struct(*sort_cols)
    out = None
    for layout in LAYOUTS:
        rows = spark.read.parquet(f"{root}/{layout}").select(
            key.alias("k"), F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
        first = f"k.{sort_cols[0]}"
        if layout == "ranged":
            late = F.lit(None).cast("bigint")                  # no order promised within a file
            marked = rows.withColumn("late", F.lit(0))
        else:
            late = F.sum("late").cast("bigint")
            back = F.col("k") < F.lag("k").over(Window.partitionBy("f").orderBy("i"))
            marked = rows.withColumn("late", F.coalesce(back, F.lit(False)).cast("int"))
        files = marked.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("late").alias("late"), F.min("k").alias("lo"),
                                        F.max("k").alias("hi"), F.min(first).alias("first"), F.max(first).alias("last"))
        overlap = F.coalesce(F.col("lo") < F.lag("hi").over(Window.orderBy("lo", "hi")), F.lit(False))   # a row per file
        r = (files.withColumn("overlap", overlap.cast("int"))
             .agg(F.sum("n").cast("bigint").alias("n_rows"), F.min("first").alias("first_value"), F.max("last").alias("last_value"),
                  late.alias("rows_out_of_order"), F.sum("overlap").cast("bigint").alias("overlapping_files"))
             .select(F.lit(layout).alias("layout"), "*"))
        out = r if out is None else out.unionByName(r)
    return out
