"""Marts stored by day and kept up by what changed in their facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.committed import CommittedTable

NEWEST = "newest"
SEEN = "seen"


def keep_mart(mart: CommittedTable, facts: dict[str, CommittedTable], build: Callable[[dict[str, DataFrame]], DataFrame],
              keys: Sequence[str] = ()) -> DataFrame:
    """Bring a mart up to date with its facts and return it.

    The mart and every fact are partitioned by one day column, and a row of
    the mart depends on fact rows of its own day only. Which days changed is
    read from the commits of the facts, not from rows: the days that loads wrote
    or cleared since the mart last looked. ``build`` gets those days of each
    fact and returns their rows of the mart, which replace them all at once; a
    day without rows is cleared. With ``keys`` the newest day of every key is
    stored beside the mart, for ``newest_rows``.
    """
    commit = mart.commit()
    (day,) = commit.partitions
    seen = commit.notes.get(SEEN, {})
    reached = {name: fact.commit().number for name, fact in facts.items()}
    changed = {_value(slot) for name, fact in facts.items() for slot in fact.slots_since(seen.get(name, 0))}
    if commit.number and not changed:
        return mart.read()
    frames = {name: fact.read(f"{fact.commit().partitions[0]}={value}" for value in changed) for name, fact in facts.items()}
    sides = {NEWEST: lambda rows: rows.groupBy(*keys).agg(F.max(day).alias(day))} if keys else None
    mart.replace(build(frames), clear={f"{day}={value}" for value in changed}, sides=sides, notes={SEEN: reached})
    return mart.read()


def _value(slot: str) -> str:
    return slot.split("=", 1)[1]


def newest_rows(mart: CommittedTable, keys: Sequence[str]) -> DataFrame:
    """The rows of the newest day of every key; only days that are the newest of some key are read.

    The mart has been stored with these ``keys``; a row without a day is the
    newest where its key has no other.
    """
    (day,) = mart.commit().partitions
    newest = mart.side(NEWEST)
    rows = mart.read(mart.slots(newest))
    wanted = newest.withColumnsRenamed({c: f"__n_{c}" for c in newest.columns})
    condition = F.lit(True)
    for c in (*keys, day):
        condition = condition & rows[c].eqNullSafe(wanted[f"__n_{c}"])
    return rows.join(wanted, condition, "left_semi")
