"""Late corrections of cumulative snapshots (C2) and SCD-2 intervals (S1): only what they touch is built anew.

A correction adds, changes or removes facts of a past period. It can change a
key's snapshots from that period on, and nothing of other keys. So the keys
with their first changed period are taken from the corrections, their rows are
rebuilt from all facts as they stand now, and a versioned table replaces just
the files that hold such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import key_list as _keys
from tessera.operators.cumulative import cumulative_backfill
from tessera.operators.scd import scd2_backfill
from tessera.sources.versioned import VersionedTable
from tessera.sources.writers import match_null_safe, stage

_FROM = "_from"


def first_changes(corrections: DataFrame, key, period: str) -> DataFrame:
    """One row for each corrected key with the first period that changed."""
    return corrections.groupBy(*_keys(key)).agg(F.min(period).alias(_FROM))


def _since(rows: DataFrame, changes: DataFrame, keys: Sequence[str], current: str) -> DataFrame:
    """The rows of changed keys from their first changed period on."""
    c = changes.select(*[F.col(k).alias("_c_" + k) for k in keys], _FROM)
    cond = F.col(current) >= F.col(_FROM)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("_c_" + k))
    return rows.join(c, cond, "left_semi")


def corrected_snapshots(facts: DataFrame, changes: DataFrame, key, period: str, fields: Sequence[str], as_of,
                        carry: Sequence[str] = (), history: str | None = "history",
                        current: str = "current_period") -> DataFrame:
    """Snapshot rows of the changed keys from their first changed period on, from all facts as they stand now."""
    keys = _keys(key)
    own = match_null_safe(facts, changes, keys, "left_semi")
    return _since(cumulative_backfill(own, keys, period, fields, as_of, carry, history, current), changes, keys, current)


def correct_snapshots(table: VersionedTable, facts: DataFrame, corrections: DataFrame, key, period: str,
                      fields: Sequence[str], as_of, carry: Sequence[str] = (), history: str | None = "history",
                      current: str = "current_period") -> int:
    """C2 after late corrections: the stored table, keyed by (key, ``current``), as a full rebuild would give it.

    ``corrections`` names the changed (key, period) pairs; ``facts`` are the
    facts with the corrections in them. Returns the table's new version.
    """
    keys = _keys(key)
    changes = stage(first_changes(corrections, keys, period), "changes")
    rows = stage(corrected_snapshots(facts, changes, keys, period, fields, as_of, carry, history, current), "corrected")
    least = changes.agg(F.min(_FROM)).first()[0]
    if least is None:
        return table.versions()[-1]
    # a fact that was removed may take snapshots with it, so the stored rows are in the scope too
    stored = _since(table.read().where(F.col(current) >= F.lit(least)), changes, keys, current)
    scope = stored.select(*keys, current).unionByName(rows.select(*keys, current))
    return table.replace(scope, rows, [*keys, current])


def corrected_intervals(snapshots: DataFrame, changes: DataFrame, key, period: str, tracked: Sequence[str], as_of,
                        **names) -> DataFrame:
    """All SCD-2 intervals of the changed keys (an interval may reach across the changed period)."""
    return scd2_backfill(match_null_safe(snapshots, changes, _keys(key), "left_semi"), key, period, tracked, as_of, **names)


def correct_intervals(table: VersionedTable, snapshots: DataFrame, corrections: DataFrame, key, period: str,
                      correction_period: str, tracked: Sequence[str], as_of, **names) -> int:
    """S1 after late corrections: the stored SCD-2 table with the changed keys' intervals replaced."""
    changes = stage(first_changes(corrections, key, correction_period), "changes")
    rows = stage(corrected_intervals(snapshots, changes, key, period, tracked, as_of, **names), "corrected")
    return table.replace(changes, rows, _keys(key))
