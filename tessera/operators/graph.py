"""Property graph from facts: vertices, edges and graph reads.

Vertices are (identifier, type, properties) and edges (subject_identifier,
subject_type, object_identifier, object_type, edge_type, properties);
properties are JSON strings at rest (NULL fields kept) and typed structs
while being built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.facts import dedup_first, split_groups
from tessera.session import partitions_for
from tessera.sources.writers import stage

# Vertex and edge type enums of the graph model.
VERTEX_TYPES = ["player", "team", "game"]
EDGE_TYPES = ["plays_against", "shares_team", "plays_in", "plays_on"]

JSON_OPTS = {"ignoreNullFields": "false"}


def props(*cols: Column) -> Column:
    """JSON object of the given (aliased) columns, NULL fields kept."""
    return F.to_json(F.struct(*cols), JSON_OPTS)


def vertices_event(games: DataFrame, id_col: str = "game_id", vtype: str = "game") -> DataFrame:
    """G1: one vertex per source row; the winner is home when ``home_team_wins = 1``, else visitor."""
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return games.select(
        F.col(id_col).cast("string").alias("identifier"), F.lit(vtype).alias("type"),
        props(F.col("pts_home"), F.col("pts_away"), winner.alias("winning_team")).alias("properties"),
    )


# Columns of a (player, game) row that any vertex or edge reads.
PLAYER_GAME_COLS = ["game_id", "player_id", "player_name", "team_id", "team_abbreviation", "start_position", "pts"]


def player_game_rows(details: DataFrame) -> DataFrame:
    """(player, game) rows deduped with a total tie-break (one row per pair).

    The rows are projected to the graph's columns first: the tie-break over
    those columns is total for everything the graph reads (rows equal on all
    of them are interchangeable), and the shuffle and sort carry 7 columns.
    """
    return dedup_first(details.select(*PLAYER_GAME_COLS), ["player_id", "game_id"])


def vertices_aggregate(details: DataFrame, dedup: bool = True) -> DataFrame:
    """Per player: a name, number of games, total points and the sorted distinct teams.

    ``dedup=True`` first keeps one row per (player, game); ``False`` counts raw rows.
    """
    d = player_game_rows(details) if dedup else details
    agg = d.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"), F.array_sort(F.collect_set("team_id")).alias("teams"),
    )
    return agg.select(
        F.col("player_id").cast("string").alias("identifier"), F.lit("player").alias("type"),
        props(F.col("player_name"), F.col("number_of_games"), F.col("total_points"), F.col("teams")).alias("properties"),
    )


def vertices_dedup(teams: DataFrame) -> DataFrame:
    """A reference table with repeated rows -> one vertex per id."""
    t = dedup_first(teams, ["team_id"])
    return t.select(
        F.col("team_id").cast("string").alias("identifier"), F.lit("team").alias("type"),
        props(F.col("abbreviation"), F.col("nickname"), F.col("city"),
              F.col("yearfounded").alias("year_founded")).alias("properties"),
    )


def vertices_union(*vertex_sets: DataFrame) -> DataFrame:
    """Union of typed vertex sets."""
    out = vertex_sets[0]
    for v in vertex_sets[1:]:
        out = out.unionByName(v)
    return out


def vertex_type_counts(vertices: DataFrame) -> DataFrame:
    """Number of vertices per type."""
    return vertices.groupBy("type").agg(F.count(F.lit(1)).alias("n_vertices"))


def edges_bipartite(details: DataFrame, dedup: bool = True) -> DataFrame:
    """Deduped player -> game ``plays_in`` edges with JSON properties."""
    d = player_game_rows(details) if dedup else details
    return d.select(
        F.col("player_id").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        props(F.col("start_position"), F.col("pts"), F.col("team_id"), F.col("team_abbreviation")).alias("properties"),
    )


PART_BYTES = 8 << 20  # of the input's files, for each part of the pairs' work at most


def _bounded_group_pairs(rows: DataFrame, group: str, member: str, residual=None) -> DataFrame:
    """All (a, b) member pairs with a.member > b.member inside each group of bounded size, columns prefixed a_/b_.

    Each row meets those before it in its group's order, so rows that come
    dealt out by group and sorted are neither shuffled nor sorted again.
    """
    cols = [c for c in rows.columns if c != group]
    before = Window.partitionBy(group).orderBy(member).rowsBetween(Window.unboundedPreceding, -1)
    a = rows.withColumn("_before", F.collect_list(F.struct(*cols)).over(before)).select(
        *[F.col(c).alias("a_" + c) for c in cols], F.explode("_before").alias("_b"))
    pairs = a.select(*["a_" + c for c in cols], *[F.col("_b")[c].alias("b_" + c) for c in cols])
    c = F.col("a_" + member) > F.col("b_" + member)
    return pairs.where(c if residual is None else c & residual)


SALTS = 32  # parts that a group's rows meet the block counts in


def _group_pairs(rows: DataFrame, group: str, member: str, block_rows: int, residual=None) -> DataFrame:
    """All (a, b) member pairs with a.member > b.member inside each group, columns prefixed a_/b_.

    A group of n members is cut into k = ceil(n / block_rows) blocks by a hash
    of the member (one block for most groups): left rows are copied once per
    partner block and right rows once per own-block partner, so the join key
    (group, left block, right block) spreads one hot group over k*k tasks of
    at most ``block_rows`` squared pairs. Every pair of members meets exactly
    once; nothing is capped.

    Only groups of more than one block have a row in the table of block counts
    (at most rows / block_rows of them). Rows meet it on (group, salt), so the
    members of a hot group are not gathered to learn its size.
    """
    cols = rows.columns
    many = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_k")) \
        .where(F.col("_k") > 1).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    r = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(member)), F.lit(SALTS)).cast("int")) \
        .join(many, [group, "_salt"], "left").withColumn("_k", F.coalesce("_k", F.lit(1))) \
        .withColumn("_blk", F.pmod(F.xxhash64(F.lit("block"), F.col(member)), F.col("_k")).cast("int"))

    def pref(df, p):
        return df.select(*[F.col(c).alias(p + c) for c in [*cols, "_lb", "_rb"]])

    partners = F.sequence(F.lit(0), F.col("_k") - 1)
    left = pref(r.withColumn("_lb", F.col("_blk")).withColumn("_rb", F.explode(partners)), "a_")
    right = pref(r.withColumn("_rb", F.col("_blk")).withColumn("_lb", F.explode(partners)), "b_")
    c = F.col("a_" + member) > F.col("b_" + member)
    for k in (group, "_lb", "_rb"):
        c = c & (F.col("a_" + k) == F.col("b_" + k))
    pairs = left.join(right, c if residual is None else c & residual, "inner")
    return pairs.select(*[p + c for p in ("a_", "b_") for c in cols])


def edges_cooccurrence(details: DataFrame, require_distinct_names: bool = True, block_rows: int = 2048,
                       dedup: bool = True) -> DataFrame:
    """Player-player edges from sharing a game, one-sided (subject id > object id).

    ``shares_team`` when both rows have the same team abbreviation, else
    ``plays_against`` (a NULL abbreviation counts as different). Per pair and
    type: number of games and both players' points; a pair may own both
    types. Rows are deduped per (player, game) first. They are dealt out by
    game once, into parts that grow in number with the input: dedupe and pairs
    both use that shuffle. Games of more than ``block_rows`` rows are deduped
    by (player, game) and paired in blocks (see ``_group_pairs``). The pair
    aggregate is a partial + final hash aggregate. Rows that are deduped
    already are passed with ``dedup=False``.
    """
    cols = ["game_id", "player_id", "player_name", "team_abbreviation", "pts"]
    n = partitions_for(details, PART_BYTES)
    usual, large = split_groups(details.select(*(PLAYER_GAME_COLS if dedup else cols)), "game_id", block_rows)
    usual = usual.where(F.col("player_id").isNotNull()).repartition(n, "game_id")
    if dedup:
        usual = dedup_first(usual, ["game_id", "player_id"])
    names_differ = (F.col("a_player_name") != F.col("b_player_name")) if require_distinct_names else None
    j = _bounded_group_pairs(usual.select(*cols), "game_id", "player_id", names_differ)
    if large is not None:
        # deduped once for its three branches (group sizes, left and right rows)
        large = stage(player_game_rows(large), "large-games") if dedup else large
        j = j.unionByName(_group_pairs(large.select(*cols), "game_id", "player_id", block_rows, names_differ).select(*j.columns))
    same = F.coalesce(F.col("a_team_abbreviation") == F.col("b_team_abbreviation"), F.lit(False))
    # a flag instead of the type's name goes through the shuffle
    g = j.groupBy(F.col("a_player_id").alias("subject_player_id"), F.col("b_player_id").alias("object_player_id"),
                  same.alias("_same")).agg(
        F.count(F.lit(1)).alias("num_games"), F.sum("a_pts").alias("subject_points"), F.sum("b_pts").alias("object_points"),
    ).withColumn("edge_type", F.when(F.col("_same"), F.lit("shares_team")).otherwise(F.lit("plays_against")))
    return g.select(
        F.col("subject_player_id").cast("string").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("object_player_id").cast("string").alias("object_identifier"), F.lit("player").alias("object_type"),
        "edge_type",
        props(F.col("num_games"), F.col("subject_points"), F.col("object_points")).alias("properties"),
    )


def build_graph(details: DataFrame, games: DataFrame, teams: DataFrame, rows: DataFrame | None = None):
    """The whole graph: (vertices, edges) with the game, player and team vertex sets and the
    ``plays_in`` and player-player edge sets. ``rows`` may pass pre-deduped (player, game)
    rows (e.g. staged once) so both edge sets read them without a second dedupe."""
    r = rows if rows is not None else player_game_rows(details)
    vertices = vertices_union(vertices_event(games), vertices_aggregate(r, dedup=False), vertices_dedup(teams))
    edges = edges_bipartite(r, dedup=False).unionByName(edges_cooccurrence(r, dedup=False))
    return vertices, edges


def graph_max_property(vertices: DataFrame, edges: DataFrame, vertex_prop: str, edge_prop: str,
                       cast: str = "double") -> DataFrame:
    """Vertex JOIN edge on (id, type); max of an edge property per vertex property."""
    v = vertices.select(F.col("identifier"), F.col("type"),
                        F.get_json_object("properties", f"$.{vertex_prop}").alias(vertex_prop))
    e = edges.select("subject_identifier", "subject_type",
                     F.get_json_object("properties", f"$.{edge_prop}").try_cast(cast).alias("_p"))
    j = v.join(e, (e.subject_identifier == v.identifier) & (e.subject_type == v.type))
    return j.groupBy(vertex_prop).agg(F.max("_p").alias(f"max_{edge_prop}"))


def graph_edge_report(vertices: DataFrame, edges: DataFrame, object_type: str = "player") -> DataFrame:
    """Per player-player edge: the subject's points per game (0 games -> 1) and edge totals."""
    v = vertices.select(
        "identifier", "type",
        F.get_json_object("properties", "$.player_name").alias("player_name"),
        F.get_json_object("properties", "$.number_of_games").try_cast("double").alias("_g"),
        F.get_json_object("properties", "$.total_points").try_cast("double").alias("_p"),
    )
    # an edge's properties are parsed once, and two numbers meet the vertices instead of the text
    ends = ["subject_identifier", "subject_type", "object_identifier", "edge_type"]
    e = edges.where(F.col("object_type") == object_type).select(
        *ends, F.json_tuple("properties", "subject_points", "num_games").alias("_points", "_n")).select(
        *ends, F.col("_points").try_cast("double").alias("total_points"), F.col("_n").try_cast("long").alias("total_games"))
    j = v.join(e, (v.identifier == e.subject_identifier) & (v.type == e.subject_type))
    return j.select(
        "player_name", "object_identifier", "edge_type",
        (F.col("_p") / F.when(F.col("_g") == 0, F.lit(1.0)).otherwise(F.col("_g"))).alias("avg_pts_per_game"),
        "total_points", "total_games",
    )


def neighbours(edges: DataFrame, edge_types: Sequence[str] | None = None) -> DataFrame:
    """Both directions of one-sided edges: (vertex, neighbour, edge_type)."""
    e = edges if edge_types is None else edges.where(F.col("edge_type").isin(list(edge_types)))
    fwd = e.select(F.col("subject_identifier").alias("vertex"), F.col("subject_type").alias("vertex_type"),
                   F.col("object_identifier").alias("neighbour"), "edge_type")
    bwd = e.select(F.col("object_identifier").alias("vertex"), F.col("object_type").alias("vertex_type"),
                   F.col("subject_identifier").alias("neighbour"), "edge_type")
    return fwd.unionByName(bwd)


def vertex_degree(edges: DataFrame, edge_types: Sequence[str] | None = None) -> DataFrame:
    """Degree (edge count) and distinct neighbours per vertex."""
    parts = partitions_for(edges, PART_BYTES)
    # few rows repeat a neighbour: both directions are dealt out as they are, into parts that grow in number with the
    # input, and a task holds the counts of its part alone
    n = neighbours(edges, edge_types).select("vertex", "vertex_type", "neighbour").repartition(parts, "vertex", "neighbour")
    each = n.groupBy("vertex", "vertex_type", "neighbour").agg(F.count(F.lit(1)).alias("_n"))
    return each.groupBy("vertex", "vertex_type").agg(F.sum("_n").alias("degree"),
                                                     F.count("neighbour").alias("n_neighbours"))
