"""Property graph as two tables: vertices(identifier, type, properties) and
edges(subject_identifier, subject_type, object_identifier, object_type, edge_type, properties).

Properties are JSON text (nulls kept). Player vertices and all edges are built
from the deduplicated game details, so their counts agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.json import json_object
from cairn.operators.core import dedupe
from cairn.session import written


def _s(c):
    return F.col(c).cast("string")


def game_vertices(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return games.select(_s("game_id").alias("identifier"), F.lit("game").alias("type"),
                        json_object(pts_home=F.col("pts_home"), pts_away=F.col("pts_away"),
                                    winning_team=winner).alias("properties"))


def player_vertices(details: DataFrame) -> DataFrame:
    """details: deduplicated player-game rows."""
    agg = details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").cast("bigint").alias("total_points"),
        F.sort_array(F.collect_set("team_id")).alias("teams"))
    return agg.select(_s("player_id").alias("identifier"), F.lit("player").alias("type"),
                      json_object(player_name=F.col("player_name"), number_of_games=F.col("number_of_games"),
                                  total_points=F.col("total_points"), teams=F.col("teams")).alias("properties"))


def team_vertices(teams: DataFrame, prefer: str = "nickname") -> DataFrame:
    """One vertex per team (deterministic survivor: greatest ``prefer``); properties as a map."""
    t = dedupe(teams, ["team_id"], prefer=[prefer])
    props = F.create_map(F.lit("abbreviation"), F.col("abbreviation"), F.lit("nickname"), F.col("nickname"),
                         F.lit("city"), F.col("city"), F.lit("arena"), F.col("arena"),
                         F.lit("year_founded"), F.col("yearfounded").cast("string"))
    return t.select(F.col("team_id").alias("identifier"), F.lit("team").alias("type"), props.alias("properties"))


def plays_in_edges(details: DataFrame) -> DataFrame:
    return details.select(
        _s("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        _s("game_id").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(start_position=F.col("start_position"), pts=F.col("pts"), team_id=F.col("team_id"),
                    team_abbreviation=F.col("team_abbreviation")).alias("properties"))


def plays_on_edges(details: DataFrame) -> DataFrame:
    agg = details.groupBy("player_id", "team_id").agg(F.count(F.lit(1)).alias("num_games"),
                                                      F.sum("pts").cast("bigint").alias("total_points"))
    return agg.select(_s("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
                      _s("team_id").alias("object_identifier"), F.lit("team").alias("object_type"),
                      F.lit("plays_on").alias("edge_type"),
                      json_object(num_games=F.col("num_games"), total_points=F.col("total_points"))
                      .alias("properties"))


PAIR_BLOCK = 2048


def pair_cells(side: DataFrame, block: int = PAIR_BLOCK) -> tuple[DataFrame, DataFrame]:
    """The two sides of a pair join inside games, cut so that no task meets more than about
    ``block`` x ``block`` pairs: ``side`` with ``i`` and ``j``, to be joined on (game_id, i, j).

    Group sizes are measured once, and only games of more than ``block`` players are kept, a small
    written table that the planner broadcasts by its measured size. Such a game's players are dealt
    to ceil(m / block) blocks by a hash, and each block meets each other in a cell of its own; all
    other games are one cell, and none of their rows is repeated.
    """
    large = written(side.groupBy("game_id").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > block)
                    .select("game_id", F.ceil(F.col("_m") / block).cast("int").alias("_parts")), "large-games")
    parts = F.coalesce("_parts", F.lit(1))
    cut = side.join(large, "game_id", "left").withColumn("_b", F.pmod(F.xxhash64("player_id"), parts).cast("int"))
    low = cut.select(*side.columns, F.col("_b").alias("i"), F.explode(F.sequence(F.col("_b"), parts - 1)).alias("j"))
    high = cut.select(*side.columns, F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("i"), F.col("_b").alias("j"))
    return low, high


def player_pair_stats(details: DataFrame, block: int = PAIR_BLOCK, stored: bool = False) -> DataFrame:
    """(subject, object, edge_type) pair statistics over shared games; the subject has the greater id.

    The output is by definition one row per co-occurring pair, so pairs of one game are the
    operator itself; large games are joined block by block (``pair_cells``), each pair once. The
    input is written once and read by both sides, unless it is ``stored`` already. Two players are
    told apart by their id alone, so players of one name make pairs too.
    """
    side = details.select("game_id", "player_id", "player_name", "team_abbreviation", "pts")
    side = side if stored else written(side, "pair-input")
    low, high = pair_cells(side, block)
    a, b = low.alias("a"), high.alias("b")
    later = F.col("a.player_id") > F.col("b.player_id")
    j = a.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
               & (later | ((F.col("a.i") < F.col("a.j")) & (F.col("a.player_id") < F.col("b.player_id")))))
    et = F.when(F.col("a.team_abbreviation") == F.col("b.team_abbreviation"), "shares_team").otherwise("plays_against")

    def sided(name: str, greater: bool):
        first, second = (F.col(f"{s}.{name}") for s in ("ab" if greater else "ba"))
        return F.when(later, first).otherwise(second)

    pairs = j.select(sided("player_id", True).alias("subject_player_id"), sided("player_id", False).alias("object_player_id"),
                     et.alias("edge_type"), sided("player_name", True).alias("_sn"), sided("player_name", False).alias("_on"),
                     sided("pts", True).alias("_sp"), sided("pts", False).alias("_op"))
    return (pairs.groupBy("subject_player_id", "object_player_id", "edge_type")
            .agg(F.max("_sn").alias("subject_player_name"), F.max("_on").alias("object_player_name"),
                 F.count(F.lit(1)).alias("num_games"), F.sum("_sp").cast("bigint").alias("subject_points"),
                 F.sum("_op").cast("bigint").alias("object_points")))


def player_player_edges(details: DataFrame, stored: bool = False) -> DataFrame:
    p = player_pair_stats(details, stored=stored)
    return p.select(_s("subject_player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
                    _s("object_player_id").alias("object_identifier"), F.lit("player").alias("object_type"),
                    "edge_type",
                    json_object(num_games=F.col("num_games"), subject_points=F.col("subject_points"),
                                object_points=F.col("object_points")).alias("properties"))


def matchups(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Player vertex joined to its player-player edges on (identifier, type); JSON fields read back,
    a vertex's once and not per edge, an edge's in one pass."""
    games = F.get_json_object("properties", "$.number_of_games").cast("double")
    pts = F.get_json_object("properties", "$.total_points").cast("double")
    v = vertices.select(F.col("identifier").alias("_id"), F.col("type").alias("_type"),
                        F.get_json_object("properties", "$.player_name").alias("player_name"),
                        (games / F.when(pts == 0, F.lit(1.0)).otherwise(pts)).alias("game_point_ratio"))
    told = F.from_json("properties", "subject_points string, num_games string")
    e = edges.where(F.col("object_type") == "player").withColumn("_told", told)
    j = v.join(e, (v["_id"] == e["subject_identifier"]) & (v["_type"] == e["subject_type"]))
    return j.select("player_name", F.col("object_identifier").alias("opponent_id"), "game_point_ratio",
                    F.col("_told.subject_points").alias("player_points"), F.col("_told.num_games").alias("matchup_games"))
