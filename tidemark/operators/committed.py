"""Stored tables that change by partitions, all or nothing.

A change is a load: its rows go to a folder of their own, and a commit, one
small file put in place last, lists for every partition the loads that hold it.
Readers follow the newest commit, so they see a load whole or not at all, and a
run that dies leaves the table as it was; the next run writes over what is left
of it. Folders that only older commits name are removed after the next commit,
so a reader keeps its files for one more load.

A table has one writer at a time. Its driver handles one entry per partition,
as it does for any partitioned table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "__load"
KEY_HASH = "__key"


@dataclass(frozen=True)
class Commit:
    """What a table consists of: the loads of each partition, and of each side table."""

    number: int = 0
    partitions: tuple[str, ...] = ()
    schema: str = ""
    live: dict[str, list[int]] = field(default_factory=dict)
    cleared: dict[str, int] = field(default_factory=dict)
    sides: dict[str, list] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    notes: dict = field(default_factory=dict)

    def held(self) -> set[tuple[str, int]]:
        return {(slot, load) for slot, loads in self.live.items() for load in loads}


class CommittedTable:
    """A table below ``path``; a partition is known by its folder name, its slot."""

    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = _Files(spark, self.path)
        self._partitions = tuple(partitions)

    # --- reading ----------------------------------------------------------------------

    def commit(self) -> Commit:
        """The newest commit; number 0 before the first."""
        numbers = self._files.numbers("commits", ".json")
        return self._commit(max(numbers)) if numbers else Commit(partitions=self._partitions)

    def _commit(self, number: int) -> Commit:
        values = json.loads(self._files.text(f"commits/{number}.json"))
        return Commit(**{**values, "partitions": tuple(values["partitions"]), "keys": tuple(values["keys"])})

    def exists(self) -> bool:
        return self.commit().number > 0

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        """The table as last committed, or only the partitions ``slots`` of it; no other folder is listed."""
        return self._rows(self.commit(), slots)

    def _rows(self, commit: Commit, slots: Iterable[str] | None = None) -> DataFrame:
        if not commit.number:
            raise ValueError(f"no table is stored at {self.path}")
        schema = T.StructType.fromJson(json.loads(commit.schema))
        wanted = commit.live if slots is None else {s: commit.live[s] for s in set(slots) if s in commit.live}
        paths = [f"{self.path}/rows/{LOAD}={load}/{slot}" for slot, loads in sorted(wanted.items()) for load in loads]
        if not paths:
            return self.spark.createDataFrame([], schema)
        placed = T.StructType([*schema.fields, T.StructField(LOAD, T.LongType())])
        found = self.spark.read.schema(placed).option("basePath", f"{self.path}/rows").parquet(*paths)
        return found.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])

    def side(self, name: str) -> DataFrame | None:
        """A side table of the newest commit, None if it has none of that name."""
        held = self.commit().sides.get(name)
        if held is None:
            return None
        load, schema = held
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/{name}/{LOAD}={load}")

    def slots(self, df: DataFrame) -> set[str]:
        """The partitions the rows of ``df`` fall in."""
        partitions = self.commit().partitions
        values = df.select(*[F.col(p).cast("string") for p in partitions]).distinct().collect()
        return {self._files.slot(partitions, row) for row in values}

    def slots_since(self, number: int) -> set[str]:
        """The partitions written or cleared by loads after ``number``; no data is read for it."""
        commit = self.commit()
        written = {slot for slot, loads in commit.live.items() if max(loads) > number}
        return written | {slot for slot, load in commit.cleared.items() if load > number}

    def former_slots(self, batch: DataFrame) -> set[str]:
        """Partitions that hold a key of ``batch`` elsewhere than ``batch`` does, by the stored index of keys.

        An entry stays until its whole load is gone, so a partition may be named
        that held a key once; none that holds one is left out.
        """
        commit = self.commit()
        stored = T.StructType.fromJson(json.loads(commit.schema))
        places = T.StructType([T.StructField(KEY_HASH, T.LongType()), *[stored[p] for p in commit.partitions]])
        paths = [f"{self.path}/keys/{LOAD}={load}" for load in sorted({load for _, load in commit.held()})]
        if not paths:
            return set()
        moved = F.lit(False)
        for p in commit.partitions:
            moved = moved | ~F.col(p).eqNullSafe(F.col(f"__new_{p}"))
        arriving = batch.select(_key_hash(commit.keys).alias(KEY_HASH), *[F.col(p).alias(f"__new_{p}") for p in commit.partitions])
        index = self.spark.read.schema(places).parquet(*paths)
        return self.slots(index.join(arriving, KEY_HASH).where(moved).select(*commit.partitions)) & set(commit.live)

    # --- writing ----------------------------------------------------------------------

    def replace(self, df: DataFrame, clear: Iterable[str] = (), full: bool = False, append: bool = False,
                keys: Sequence[str] | None = None, sides: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
                notes: dict | None = None) -> Commit:
        """Commit ``df`` in place of the partitions it has rows for, of those in ``clear``, or of all (``full``).

        With ``append`` the rows join those already there. ``keys`` keeps an
        index of which partition a key is in (hashes, so that it stays narrow).
        ``sides`` are tables computed from the table as it will be, stored and
        committed with it; those not given stay. ``df`` may read the table.
        """
        old = self.commit()
        number, partitions = old.number + 1, old.partitions or self._partitions
        target = f"rows/{LOAD}={number}"
        few_files(df, partitions).write.mode("overwrite").partitionBy(*partitions).parquet(f"{self.path}/{target}")
        written = self._files.slots(target, len(partitions))
        live = {} if full else {s: loads for s, loads in old.live.items() if s not in set(clear)}
        for slot in written:
            live[slot] = [*live.get(slot, []), number] if append else [number]
        gone = {slot: number for slot in old.live if slot not in live}
        new = replace(old, number=number, partitions=partitions, live=live, keys=old.keys if keys is None else tuple(keys),
                      cleared={**{s: n for s, n in old.cleared.items() if s not in live}, **gone},
                      schema=old.schema or df.schema.json(), notes={**old.notes, **(notes or {})})
        fresh = self._rows(replace(new, live={s: [number] for s in written}))
        if new.keys:
            places = fresh.select(_key_hash(new.keys).alias(KEY_HASH), *partitions)
            places.write.mode("overwrite").parquet(f"{self.path}/keys/{LOAD}={number}")
        stored = dict(old.sides)
        for name, make in (sides or {}).items():
            made = make(self._rows(new))
            made.write.mode("overwrite").parquet(f"{self.path}/{name}/{LOAD}={number}")
            stored[name] = [number, made.schema.json()]
        new = replace(new, sides=stored)
        self._put(new)
        self._remove_old(new)
        return new

    def _put(self, commit: Commit) -> None:
        self._files.put(f"commits/{commit.number}.json", json.dumps(commit.__dict__))

    def _remove_old(self, newest: Commit) -> None:
        """Remove what neither the newest commit nor the one before it names."""
        numbers = sorted(self._files.numbers("commits", ".json"))
        kept = [newest, *[self._commit(n) for n in numbers[-2:-1]]]
        held = set().union(*[c.held() for c in kept])
        for number in numbers[:-2]:
            for slot, load in self._commit(number).held() - held:
                self._files.delete(f"rows/{LOAD}={load}/{slot}")
            self._files.delete(f"commits/{number}.json")
        loads = {load for _, load in held}
        for kind in ("rows", "keys", *newest.sides):
            named = loads if kind in ("rows", "keys") else {c.sides[kind][0] for c in kept if kind in c.sides}
            for load in self._files.numbers(kind, "", f"{LOAD}="):
                if load not in named:
                    self._files.delete(f"{kind}/{LOAD}={load}")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    return CommittedTable(spark, path).read()


def few_files(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value for writing, a large partition over several tasks.

    Without this every task would write a file into every partition.
    """
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


class _Files:
    """Names and small files below a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def numbers(self, folder: str, suffix: str, prefix: str = "") -> list[int]:
        found = [n.removeprefix(prefix).removesuffix(suffix) for n in self.names(folder) if n.startswith(prefix) and n.endswith(suffix)]
        return [int(n) for n in found if n.isdigit()]

    def slots(self, folder: str, depth: int) -> list[str]:
        """Relative paths of the partition folders below ``folder``."""
        found = [n for n in self.names(folder) if "=" in n]
        return found if depth == 1 else [f"{n}/{rest}" for n in found for rest in self.slots(f"{folder}/{n}", depth - 1)]

    def slot(self, partitions: Sequence[str], values: Sequence[str | None]) -> str:
        """The folder Spark gives a partition."""
        name = self.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join(name(p, v) for p, v in zip(partitions, values))

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file under another name and move it into place, which happens at once or not at all."""
        target, draft = self._path(name), self._path(f"{name}.draft")
        if self.fs.exists(target):
            raise RuntimeError(f"{target} was committed by another writer")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(draft, target):
            raise RuntimeError(f"{target} could not be put in place")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
