"""Fact tables: dedupe, build, rates, sampling, retention and fact kinds."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.expr import clock_to_minutes, text_flag
from tessera.functions.expr import key_list as _keys
from tessera.operators.sequence import with_previous
from tessera.sources.writers import stage


def duplicate_audit(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Keys that occur more than once (partial + final count, like HAVING count > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Keep one row per key: the first by ``order``, ties broken by every other column.

    ``row_number() = 1`` is planned as a partial WindowGroupLimit before the
    shuffle, so a heavily duplicated key ships one row per map task.
    """
    ks = set(_keys(keys))
    # column names sort ascending with NULLs last (as the tie-break); pass Column expressions for other orders
    order_cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    tie = [F.col(c).asc_nulls_last() for c in df.columns if c not in ks]
    w = Window.partitionBy(*keys).orderBy(*order_cols, *tie)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


MAX_BROADCAST_GROUPS = 1_000_000  # ids of large groups sent to all tasks; more are matched by a shuffle join


def split_groups(df: DataFrame, group: str, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups of at most ``max_rows`` rows, rows of larger groups or None if there are none).

    Groups of bounded size can be dealt out by the group alone, so that later
    steps by the group need no second shuffle. Rows without a group are in
    neither part. Only the ids of the large groups (at most rows / max_rows)
    are written and met by the rows.
    """
    known = df.where(F.col(group).isNotNull())
    large = stage(known.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(group),
                  "large-groups")
    n = large.count()
    if not n:
        return known, None
    large = F.broadcast(large) if n <= MAX_BROADCAST_GROUPS else large
    return known.join(large, group, "left_anti"), known.join(large, group, "left_semi")


def dedup_window_profile(df: DataFrame, key, ts: str, tiebreak: Sequence[str] = (),
                         bounds_minutes: Sequence[int] = (1, 5, 15, 60, 1440), bucket_seconds: int = 3600,
                         segments: int | None = None) -> DataFrame:
    """D3: distribution of the gap to the previous same-key event, to choose a dedupe window.

    Output: ``gap_bucket`` ('<=N min' or '>N min'), ``n_events``. First events of a key
    are not counted.
    """
    p = with_previous(df, key, ts, tiebreak, bucket_seconds=bucket_seconds, prefix="_p_", segments=segments)
    gap = F.timestamp_diff("MICROSECOND", F.col("_p_" + ts), F.col(ts)) / 6e7
    label = None
    for b in bounds_minutes:
        cond = gap <= F.lit(b)
        label = F.when(cond, F.lit(f"<={b} min")) if label is None else label.when(cond, F.lit(f"<={b} min"))
    label = label.otherwise(F.lit(f">{bounds_minutes[-1]} min"))
    return p.where(gap.isNotNull()).groupBy(label.alias("gap_bucket")).agg(
        F.count(F.lit(1)).alias("n_events"))


def dedup_within_window(df: DataFrame, key, ts: str, window_minutes: float, tiebreak: Sequence[str] = (),
                        bucket_seconds: int = 3600, segments: int | None = None) -> DataFrame:
    """D4 (batch): drop an event when the previous same-key event is at most W earlier."""
    p = with_previous(df, key, ts, tiebreak, bucket_seconds=bucket_seconds, prefix="_p_", segments=segments)
    # wall-clock difference for timestamp_ntz (no session time-zone involved), instant difference otherwise
    gap_us = F.timestamp_diff("MICROSECOND", F.col("_p_" + ts), F.col(ts))
    # no previous event, or no time to compare (NULL ts): nothing proves a duplicate, keep it
    keep = gap_us.isNull() | (gap_us > F.lit(int(window_minutes * 60_000_000)))
    return p.where(keep).drop("_p_" + ts)


#: The seventeen measures of the box score: output column and details column (minutes come from the clock text).
MEASURES = {f"m_{c}": c for c in ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk",
                                  "turnovers", "pf", "pts", "plus_minus")}


def fact_build(details: DataFrame, games: DataFrame, measures: dict[str, str] | None = None,
               names: DataFrame | None = None, game_rows: int = 100_000) -> DataFrame:
    """dedupe + join to the header + typed, renamed columns with boolean dimensions.

    Dedupe on the business key (game, team, player). The header's game date
    is constant inside a key, so ordering by it decides nothing: the dedupe
    runs on the details alone, before the join. The details are dealt out by
    game once, and dedupe and join both use that: the wide rows are shuffled
    and sorted a single time. Games of more than ``game_rows`` rows are deduped
    by their business keys first, so neither a hot game nor a hot key gathers
    in one task, and one row per key then moves to the join.

    ``measures`` maps output to details columns (default: all of ``MEASURES``
    that the details have; an empty mapping for none). ``names`` (player_id,
    player_name), if given, is joined after the dedupe. Minutes are left out if
    the details have no clock. The dedupe breaks ties by the columns in their
    order, so details cut to their first columns give the same rows.
    """
    measures = {o: c for o, c in MEASURES.items() if c in details.columns} if measures is None else measures
    g = games.select("game_id", "game_date_est", "season", "home_team_id")
    keys = ["game_id", "team_id", "player_id"]
    usual, large = split_groups(details, "game_id", game_rows)
    d = dedup_first(usual.repartition("game_id"), keys).join(g, "game_id", "inner")
    if large is not None:
        d = d.unionByName(dedup_first(large, keys).join(g, "game_id", "inner"))
    if names is not None:
        d = d.join(names, "player_id", "left")
    return d.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        text_flag("comment", "DNP").alias("dim_did_not_play"),
        text_flag("comment", "DND").alias("dim_did_not_dress"),
        text_flag("comment", "NWT").alias("dim_not_with_team"),
        *([clock_to_minutes("min").alias("m_minutes")] if "min" in details.columns else []),
        *[F.col(c).alias(o) for o, c in measures.items()],
        F.col("game_id").alias("dim_game_id"),
    )


def fact_keys(details: DataFrame, games: DataFrame) -> DataFrame:
    """The keys of ``fact_build``'s rows alone (date, team, player, game): one narrow row of each business key is shuffled."""
    g = games.select("game_id", "game_date_est")
    return details.select("game_id", "team_id", "player_id").distinct().join(g, "game_id", "inner").select(
        F.col("game_date_est").alias("dim_game_date"), F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"), F.col("game_id").alias("dim_game_id"))


def conditional_rate(df: DataFrame, group: str, flag: str, counted: str | None = None) -> DataFrame:
    """non-null count, conditional count and their ratio per group (NULL-safe division)."""
    c = counted or group
    n = F.count(c)
    hits = F.count_if(F.col(flag))
    return df.groupBy(group).agg(n.alias("num_games"), hits.alias("num_flagged"),
                                 F.try_divide(hits.cast("double"), n).alias("flag_rate"))


def denormalise_fact(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """add dimension attributes to a fact.

    ``dims`` = [(dim_df, fact_key, dim_key, attrs)]. Left joins on equality;
    Spark chooses broadcast when a dimension's statistics fall under
    ``autoBroadcastJoinThreshold`` (AQE re-checks the real size at runtime),
    sort-merge otherwise -- the size check is Spark's, not a blind hint.
    """
    out = fact
    for dim, fk, dk, attrs in dims:
        d = dim.select(F.col(dk).alias("_dk_" + dk), *attrs)
        out = out.join(d, out[fk] == d["_dk_" + dk], "left").drop("_dk_" + dk)
    return out


def normalise_fact(denorm: DataFrame, fact_cols: Sequence[str], dim_key: str, dim_attrs: Sequence[str]):
    """F5 inverse: keep ids on the fact, move attributes to a distinct dimension table."""
    return denorm.select(*fact_cols), denorm.select(dim_key, *dim_attrs).distinct()


def sample_fact(df: DataFrame, key: str, modulus: int, keep_below: int, method: str = "hash") -> DataFrame:
    """deterministic, whole-entity sample: all rows of a sampled key are kept.

    ``method='hash'`` buckets by ``xxhash64(key)``; ``'modulo'`` by the
    integer key itself and ``'md5'`` by the digest of its text (both
    reproducible in any SQL engine).
    """
    if method == "md5":
        return df.where(F.md5(F.col(key).cast("string")) < F.lit(format(keep_below * (1 << 32) // modulus, "08x")))
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(modulus)) if method == "hash" else F.pmod(F.col(key), F.lit(modulus))
    return df.where(bucket < F.lit(keep_below))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli row sample (each row independently; reproducible for a fixed input layout)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(df: DataFrame, column: str, fractions: dict, seed: int = 42) -> DataFrame:
    """per-stratum Bernoulli sample (``sampleBy``); strata missing from ``fractions`` are dropped."""
    return df.sampleBy(column, fractions=fractions, seed=seed)


def bucketed_join(spark: SparkSession, left: DataFrame, right: DataFrame, key: str, n_buckets: int,
                  location: str, names: tuple[str, str], how: str = "inner") -> DataFrame:
    """write both sides bucketed and sorted on ``key``; the join then needs no Exchange.

    Tables are written under ``location`` (shared storage) with
    ``bucketBy(n).sortBy(key)`` and registered in the session catalog.
    """
    for df, name in ((left, names[0]), (right, names[1])):
        # dealt out by key first: a bucket is one file, not one for each task
        (df.repartition(n_buckets, key).write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key)
         .option("path", f"{location.rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(names[0]).join(spark.table(names[1]), key, how)


def retention_split(df: DataFrame, ts: str, cutoff: str, pii: Sequence[str], secret: str | None = None):
    """F8: split at the ``cutoff`` day -> (recent rows unchanged, old rows without PII, rows without a time).

    PII columns of old rows are dropped; with a ``secret`` they are replaced by
    a keyed hash (HMAC form: ids cannot be found by trial without the key), so
    archived rows of one person can still be joined. Rows whose time is NULL
    come back as a part of their own, unchanged, for the caller to place.
    """
    cut = F.lit(cutoff).cast(df.schema[ts].dataType)
    old = df.where(F.col(ts) < cut)  # pushable to the scan
    recent, undated = df.where(F.col(ts) >= cut), df.where(F.col(ts).isNull())
    if secret is None:
        return recent, old.drop(*pii), undated
    key = hashlib.sha256(secret.encode()).hexdigest()

    def keyed(c):
        inner = F.sha2(F.concat(F.lit(key + "/inner/"), F.col(c).cast("string")), 256)
        return F.sha2(F.concat(F.lit(key + "/outer/"), inner), 256).alias(c + "_hash")

    return recent, old.select(*[keyed(c) if c in pii else F.col(c) for c in df.columns]), undated


def daily_aggregate(df: DataFrame, key: str, ts: str, who: str, exact: bool = True) -> DataFrame:
    """events and distinct visitors per key per day.

    Exact ``count(DISTINCT)`` by default; ``exact=False`` uses HyperLogLog++.
    """
    distinct = F.count_distinct(who) if exact else F.approx_count_distinct(who)
    return df.where(F.col(key).isNotNull()).groupBy(key, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("hits"), distinct.alias("unique_visitors"))


def snapshot_fact(df: DataFrame, key: str, ts: str, value: str, as_of: str) -> DataFrame:
    """state at each day end (last value of the day, carried forward to ``as_of``).

    Per (key, day) ``max_by`` (partial aggregate), then the interval form: a
    day's value holds until the next active day - 1. No calendar join.
    """
    daily = df.groupBy(key, F.to_date(ts).alias("_d")).agg(
        F.max_by(F.col(value), F.struct(F.col(ts), F.col(value))).alias("_v"))
    w = Window.partitionBy(key).orderBy("_d")
    until = F.coalesce(F.date_sub(F.lead("_d", 1).over(w), 1), F.to_date(F.lit(as_of)))
    d = daily.where(F.col("_d") <= F.to_date(F.lit(as_of))).select(key, "_d", "_v", until.alias("_u"))
    return d.select(key, F.explode(F.sequence("_d", "_u")).alias("snapshot_date"),
                    F.col("_v").alias(value), F.col("_d").alias("last_change_date"))


def accumulating_snapshot(df: DataFrame, key: str, stage: str, ts: str, milestones: Sequence[str]) -> DataFrame:
    """one row per process, first timestamp of each milestone (conditional min, one pass)."""
    return df.groupBy(key).agg(
        *[F.min(F.when(F.col(stage) == m, F.col(ts))).alias(f"{m}_at") for m in milestones])


def factless_fact(df: DataFrame, who: str, ts: str) -> DataFrame:
    """occurrence without measures: distinct (who, day) presence rows."""
    return df.select(who, F.to_date(ts).alias("day")).distinct()


def factless_coverage(presence: DataFrame, who: str, by: str = "day") -> DataFrame:
    """F12 report: how many distinct ``who`` occur per ``by`` value (coverage of a factless fact)."""
    return presence.groupBy(by).agg(F.count_distinct(who).alias(f"n_{who}"))


def olap_cube(df: DataFrame, dims: Sequence[str], measures: Sequence[Column], kind: str = "cube") -> DataFrame:
    """slice-and-dice groupings (cube / rollup) with ``grouping_id``."""
    g = df.cube(*dims) if kind == "cube" else df.rollup(*dims)
    return g.agg(F.grouping_id().alias("grouping_id"), *measures)


def master_entity(parts: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """merge several production sets on one entity key (full joins, attributes coalesced by name).

    Each part is deduplicated on the key first (D2: the first row by its other columns), so an entity is one row.
    """
    out = None
    for df, _name in parts:
        d = dedup_first(df, [key]).withColumnRenamed(key, "_k")
        if out is None:
            out = d
            continue
        common = [c for c in d.columns if c in out.columns and c != "_k"]
        j = out.join(d, out["_k"] == d["_k"], "full")
        cols = [F.coalesce(out["_k"], d["_k"]).alias("_k")]
        cols += [F.coalesce(out[c], d[c]).alias(c) for c in common]
        cols += [out[c] for c in out.columns if c not in common and c != "_k"]
        cols += [d[c] for c in d.columns if c not in common and c != "_k"]
        out = j.select(*cols)
    return out.withColumnRenamed("_k", key)
