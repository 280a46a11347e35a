"""Insert-only history tables: hubs of keys, links between them, satellites of attributes.

``new_*`` gives just the rows to append to a stored table; ``load_*`` gives the
table with them; ``store_satellite`` keeps a satellite stored with its current rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import DATE_FORMAT, SECOND_FORMAT, hash_of, normalised
from tidemark.operators.committed import CommittedTable
from tidemark.operators.groups import written
from tidemark.operators.joins import rows_absent
from tidemark.operators.windows import latest_per_key

BOOKKEEPING = ("load_date", "record_source", "load_end_date")


def name_hash(name: str | Column) -> Column:
    return hash_of(normalised(name))


def day_hash(ts: str | Column) -> Column:
    return hash_of(F.date_format(F.to_date(ts), DATE_FORMAT))


def reading_hash(name: str | Column, ts: str | Column) -> Column:
    return hash_of(normalised(name), F.date_format(ts, SECOND_FORMAT))


# --- hubs and links --------------------------------------------------------------


def new_hub_rows(hub: DataFrame, source: DataFrame, hash_key: Column, natural: Column, *, key: str, name: str,
                 load_date: str, record_source: str) -> DataFrame:
    """The source's business keys that the hub lacks.

    Spellings that hash alike become one row; of them the lowest is kept.
    """
    # the distinct spellings first: hashed per task, where a minimum of text would sort every row
    spellings = source.select(hash_key.alias(key), natural.alias(name)).where(F.col(key).isNotNull()).distinct()
    rows = spellings.groupBy(key).agg(F.min(name).alias(name))
    return _stamped(rows_absent(rows, hub, {key: key}), load_date, record_source)


def load_hub(hub: DataFrame, source: DataFrame, hash_key: Column, natural: Column, **how) -> DataFrame:
    return hub.unionByName(new_hub_rows(hub, source, hash_key, natural, **how))


def new_link_rows(link: DataFrame, source: DataFrame, hashes: dict[str, Column], carried: Sequence[str], *,
                  load_date: str, record_source: str) -> DataFrame:
    """The source's relationships that the link lacks; the first hash is its key."""
    key = next(iter(hashes))
    rows = source.select(*[h.alias(n) for n, h in hashes.items()], *carried)
    rows = rows.where(F.col(key).isNotNull()).dropDuplicates([key])
    return _stamped(rows_absent(rows, link, {key: key}), load_date, record_source)


def load_link(link: DataFrame, source: DataFrame, hashes: dict[str, Column], carried: Sequence[str],
              **how) -> DataFrame:
    return link.unionByName(new_link_rows(link, source, hashes, carried, **how))


# --- satellites ------------------------------------------------------------------


def new_satellite_rows(satellite: DataFrame, source: DataFrame, hash_key: Column, *, key: str,
                       attributes: Sequence[str], order: Sequence[str | Column], required: str | None,
                       load_date: str, record_source: str, mode: str = "changed") -> DataFrame:
    """The rows a load adds, all open-ended.

    ``mode='append'`` adds every source row on every load. ``mode='changed'``
    takes the source's first row by ``order`` per key, and that only when its
    attributes differ from the key's newest stored version.
    """
    rows = source if required is None else source.where(F.col(required).isNotNull())
    keyed = rows.withColumn(key, hash_key)
    if mode == "append":
        fresh = keyed.select(key, *attributes)
    elif mode == "changed":
        latest = latest_per_key(keyed, [key], order).select(key, *attributes)
        # only the keys of this load are looked up: stored versions of others are neither shuffled nor sorted
        touched = satellite.join(latest.select(key), key, "left_semi")
        newest = latest_per_key(touched, [key], [F.col("load_date").desc(), _row_hash(touched, key).desc()])
        known = newest.select(F.col(key).alias("__key"), *[F.col(a).alias(f"__{a}") for a in attributes])
        same = F.lit(True)
        for a in attributes:
            same = same & F.col(a).eqNullSafe(F.col(f"__{a}"))
        fresh = latest.join(known, (latest[key] == known["__key"]) & same, "left_anti")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return _stamped(fresh, load_date, record_source).withColumn("load_end_date", F.lit(None).cast("timestamp_ntz"))


def end_dated(satellite: DataFrame, key: str) -> DataFrame:
    """Every version ended by the load of the next one.

    Derived on reading, so that a load only ever appends. A key has one version
    per load that changed it; of several with one load time the one of the
    highest hash of its attributes counts as the last, as for loads.
    """
    following = F.lead("load_date").over(Window.partitionBy(key).orderBy("load_date", _row_hash(satellite, key)))
    return satellite.withColumn("load_end_date", following)


def _row_hash(satellite: DataFrame, key: str) -> Column:
    return F.xxhash64(*[F.col(c) for c in satellite.columns if c != key and c not in BOOKKEEPING])


def load_satellite(satellite: DataFrame, source: DataFrame, hash_key: Column, *, key: str, mode: str = "changed",
                   **how) -> DataFrame:
    """The satellite after a load; with ``mode='changed'`` replaced versions are ended."""
    fresh = new_satellite_rows(satellite, source, hash_key, key=key, mode=mode, **how)
    loaded = satellite.unionByName(fresh)
    return end_dated(loaded, key) if mode == "changed" else loaded


def vault_view(link: DataFrame, hubs: Sequence[tuple[DataFrame, str]], satellite: DataFrame, key: str) -> DataFrame:
    """Links with their hubs and current satellite rows, the newest of each key."""
    return current_view(link, hubs, end_dated(satellite, key).where(F.col("load_end_date").isNull()), key)


# --- a satellite stored with its current rows ------------------------------------------


CURRENT = "current"


def store_satellite(table: CommittedTable, source: DataFrame, hash_key: Column, *, key: str, attributes: Sequence[str],
                    order: Sequence[str | Column], required: str | None, load_date: str, record_source: str) -> DataFrame:
    """Append what changed to a satellite stored by ``load_date``, and keep a table of current rows beside it.

    The changes come from one join with the current rows, never from the
    history. History and current rows are committed together; a load whose time
    is stored already is left out, so a repeated load changes nothing. Returns
    the current rows: key, load time and attributes.
    """
    current = table.side(CURRENT)
    rows = source if required is None else source.where(F.col(required).isNotNull())
    latest = latest_per_key(rows.withColumn(key, hash_key), [key], order).select(key, *attributes)
    stamp = F.lit(load_date).cast("timestamp_ntz")
    if current is not None and table.slots(table.spark.range(1).select(stamp.alias("load_date"))) & set(table.commit().live):
        return current
    if current is not None:
        known = current.select(F.col(key).alias("__key"), F.lit(True).alias("__known"), *[F.col(a).alias(f"__{a}") for a in attributes])
        same = F.coalesce(F.col("__known"), F.lit(False))
        for a in attributes:
            same = same & F.col(a).eqNullSafe(F.col(f"__{a}"))
        latest = latest.join(known, F.col(key).eqNullSafe(F.col("__key")), "left").where(~same).select(key, *attributes)
    fresh = written(_stamped(latest, load_date, record_source), "satellite-load")

    def renewed(_: DataFrame) -> DataFrame:
        made = fresh.select(key, "load_date", *attributes)
        if current is None:
            return made
        replaced = fresh.select(F.col(key).alias("__key"))
        return current.join(replaced, F.col(key).eqNullSafe(F.col("__key")), "left_anti").unionByName(made)

    table.replace(fresh, append=True, sides={CURRENT: renewed})
    return table.side(CURRENT)


def current_view(link: DataFrame, hubs: Sequence[tuple[DataFrame, str]], current: DataFrame, key: str) -> DataFrame:
    """Links with their hubs and the stored current rows: no history is read and nothing is windowed."""
    view = link.drop(*BOOKKEEPING)
    for hub, hub_key in hubs:
        view = view.join(hub.drop(*BOOKKEEPING), hub_key)
    return view.join(current.drop(*BOOKKEEPING), key)


def _stamped(rows: DataFrame, load_date: str, record_source: str) -> DataFrame:
    return rows.withColumns({
        "load_date": F.lit(load_date).cast("timestamp_ntz"),
        "record_source": F.lit(record_source),
    })
