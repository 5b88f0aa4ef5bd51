"""Published tables. A table is a set of version folders, listed in the manifest of a release; readers
see the release with the highest number.

Parquet tables take no UPDATE or DELETE, so a refresh writes new versions and then publishes them
with one small file, the next manifest, which is created only if no one else has. A run that dies
half-way leaves the published versions untouched. Two publishers at once: the later one starts again
from the manifest of the earlier one, and is refused if that one changed what it had read or replaces.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satmart.sources.guards import MissingInputError
from satmart.sources.schemas import CLUSTERING, LOAD_ORDER, PARTITIONING, SCHEMAS, conform
from satmart.sources.storage import child_names, create_only, read_text, remove

#: partition (None: the whole version) -> version folders, oldest first
Parts = dict[str | None, list[str]]


class ConflictError(RuntimeError):
    """Another publisher changed a table that this one had read or wanted to replace."""


class Snapshot:
    """The tables of one release. Reads of later releases do not change it."""

    def __init__(self, house: Warehouse, number: int, tables: dict[str, Parts]):
        self.house = house
        self.number = number
        self.tables = tables
        self.seen: set[str] = set()

    def names(self) -> list[str]:
        return sorted(self.tables)

    def read(self, table: str) -> DataFrame:
        parts = self.tables.get(table)
        if parts is None:
            raise MissingInputError(f"table {table} is not in the warehouse {self.house.root}")
        self.seen.add(table)
        root = f"{self.house.root}/{table}"
        paths = sorted({
            f"{root}/version={version}" + (f"/{part}" if part else "")
            for part, versions in parts.items() for version in versions
        })
        reader = self.house.spark.read.option("basePath", root)
        if table in SCHEMAS:
            columns = SCHEMAS[table]
            if not paths:
                return self.house.spark.createDataFrame([], columns)
            return conform(reader.schema(f"{columns}, version string").parquet(*paths), columns)
        return reader.parquet(*paths).drop("version")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _manifests(self) -> list[int]:
        names = child_names(self.spark, f"{self.root}/_releases")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/_releases/{number:08d}.json"

    def snapshot(self) -> Snapshot:
        """What is published now. One listing and one small file, however many releases there were."""
        numbers = self._manifests()
        if not numbers:
            return Snapshot(self, 0, {})
        listed = json.loads(read_text(self.spark, self._manifest(numbers[-1])))
        return Snapshot(self, numbers[-1], {
            table: {part or None: versions for part, versions in parts.items()}
            for table, parts in listed.items()
        })

    def tables(self) -> list[str]:
        return self.snapshot().names()

    def read(self, table: str) -> DataFrame:
        return self.snapshot().read(table)

    def replace(
        self, tables: dict[str, DataFrame], drop: tuple[str, ...] = (),
        since: Snapshot | None = None, partitions: dict[str, Sequence[str]] | None = None,
        append: tuple[str, ...] = (),
    ) -> None:
        """Write the given tables, parents first, and publish them together.

        Other tables keep their version, except those in ``drop``. ``partitions`` names the partitions
        of a partitioned table that its new rows stand for; the others keep their rows, unread. Rows
        of a table in ``append`` are added to those it has. With ``since``, the release is refused if
        a table read from that snapshot has changed meanwhile; a table or partition that is replaced
        or dropped must not have changed since, or, without it, since this call began.
        """
        since = since or self.snapshot()
        partitions = partitions or {}
        order = [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]
        written = {table: self._written(table, tables[table]) for table in order}
        while True:
            now = self.snapshot()
            self._check(since, now, written, drop, partitions, append)
            changed = {t: p for t, p in now.tables.items() if t not in drop}
            for table, (version, parts) in written.items():
                old = changed.get(table, {})
                if table in append:
                    new = {p: [*old.get(p, []), version] for p in parts}
                    changed[table] = old | new
                elif table in partitions:
                    kept = {p: v for p, v in old.items() if p not in partitions[table]}
                    if not set(parts) <= set(partitions[table]):
                        raise ValueError(f"{table} has rows of other partitions than named")
                    changed[table] = kept | {p: [version] for p in parts}
                else:
                    changed[table] = {p: [version] for p in parts}
            if self._published(now.number + 1, changed):
                return

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a table: a further version folder, published beside the earlier ones.

        A run that dies half-way leaves the published rows as they were, so it can be repeated. Two
        appends at once both count.
        """
        self.replace({table: rows}, append=(table,))

    def _check(self, since, now, written, drop, partitions, append) -> None:
        if now.number == since.number:
            return
        for table in {*since.seen, *written, *drop}:
            old, new = since.tables.get(table), now.tables.get(table)
            if old == new:
                continue
            only = table in written and table not in since.seen
            if only and table in append:
                continue
            if only and table in partitions and old and new and all(
                old.get(p) == new.get(p) for p in partitions[table]
            ):
                continue
            raise ConflictError(f"{table} was changed by release {now.number}; start again")

    def _written(self, table: str, df: DataFrame) -> tuple[str, list[str | None]]:
        """Write a new version folder, which no reader sees until it is published.

        Returns it and its partitions; a table that is not partitioned has one, None."""
        if table in SCHEMAS:
            df = conform(df, SCHEMAS[table])
        if table in CLUSTERING:
            keys = CLUSTERING[table]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        version, own = uuid.uuid4().hex, PARTITIONING.get(table, ())
        folder = f"{self.root}/{table}/version={version}"
        df.write.partitionBy(*own).parquet(folder)
        if not own:
            return version, [None]
        return version, sorted(n for n in child_names(self.spark, folder) if "=" in n)

    def _published(self, number: int, tables: dict[str, dict]) -> bool:
        """Whether this run was the one to make the release of that number."""
        listed = {t: {p or "": v for p, v in parts.items()} for t, parts in tables.items()}
        return create_only(self.spark, self._manifest(number), json.dumps(listed))

    def remove_old_versions(self) -> None:
        """Free the space of unpublished versions and drop old manifests, when no reader or writer
        is under way."""
        now = self.snapshot()
        for number in self._manifests():
            if number < now.number:
                remove(self.spark, self._manifest(number))
        for table in child_names(self.spark, self.root):
            folder = f"{self.root}/{table}"
            if table in SCHEMAS or table in now.tables:
                live = {v for versions in now.tables.get(table, {}).values() for v in versions}
                for name in child_names(self.spark, folder):
                    if name.removeprefix("version=") not in live:
                        remove(self.spark, f"{folder}/{name}")


def partition_name(column: str, value: object) -> str:
    """A partition as its folder is called."""
    return f"{column}={value}"


def stamped(df: DataFrame, at: Column | None = None) -> DataFrame:
    """A result table with the time of the run that made it."""
    return df.withColumn("fecha_ejecucion", F.current_timestamp() if at is None else at)
