"""Tables in hash buckets, changed together by moving one pointer.

A store holds several tables. The rows of a table lie in buckets by the hash of its
columns `by`; a bucket is one or more folders of Parquet files that are never changed. A
state names the folders of every bucket of every table, and the newest complete state is
what readers see.

A change writes new folders beside the old ones: `merge` rewrites only buckets that the
batch's keys fall into, `append` adds a folder to them. `commit` then writes the next
state. It counts only with its success marker, which comes last; so a run that dies in between
leaves the tables as they were, all of them, and the next run writes over what is left.
Two writers cannot both write the same state. `vacuum` removes folders that no late
state names.

The number of buckets is fixed when a store is made: rows of a bucket should fit a few
tasks at the size the tables will reach. The driver handles bucket numbers and folder names,
never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.operators.merge import insert_if_absent, merge_upsert
from lodestrata.session import delete_path, dropped_shuffles, folder_names, path_exists

_STATE = "name STRING, bucket INT, folder STRING, buckets INT"


@dataclass(frozen=True)
class Table:
    """Columns of a table, the key of a row, and the columns that pick its bucket."""

    schema: str | StructType
    keys: tuple[str, ...] = ()
    by: tuple[str, ...] = ()
    #: Columns that a merge replaces in known rows; None: a known row stays as it is.
    updates: tuple[str, ...] | None = None

    @property
    def bucketed_by(self) -> tuple[str, ...]:
        return self.by or self.keys

    def struct(self) -> StructType:
        return self.schema if isinstance(self.schema, StructType) else StructType.fromDDL(self.schema)


class Store:
    def __init__(
        self, spark: SparkSession, root: str, tables: Mapping[str, Table], buckets: int = 64
    ) -> None:
        self.spark, self.root, self.tables = spark, root.rstrip("/"), dict(tables)
        self._number, self._folders = self._newest(buckets)

    def _states(self) -> list[int]:
        """Numbers of the complete states, oldest first."""
        found = folder_names(self.spark, f"{self.root}/_states/*")
        return [int(n) for n in found if path_exists(self.spark, f"{self.root}/_states/{n}/_SUCCESS")]

    def _load(self, number: int) -> list:
        return self.spark.read.schema(_STATE).parquet(f"{self.root}/_states/{number:012d}").collect()

    def _newest(self, buckets: int) -> tuple[int, dict[str, dict[int, list[str]]]]:
        states = self._states()
        self.buckets = buckets
        folders: dict[str, dict[int, list[str]]] = {name: {} for name in self.tables}
        if not states:
            return 0, folders
        for row in self._load(states[-1]):
            self.buckets = row.buckets
            if row.folder:
                folders.setdefault(row.name, {}).setdefault(row.bucket, []).append(row.folder)
        return states[-1], folders

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[name].bucketed_by), F.lit(self.buckets)).cast("int")

    def touched(self, name: str, rows: DataFrame) -> list[int]:
        """Buckets of a table that the rows' columns fall into."""
        found = rows.select(self.bucket(name).alias("bucket")).distinct().collect()
        return sorted(r.bucket for r in found)

    def files(self, name: str, buckets: Iterable[int] | None = None) -> list[str]:
        """Folders that a read of these buckets opens."""
        own = self._folders.get(name, {})
        wanted = own if buckets is None else [b for b in buckets if b in own]
        return [f"{self.root}/{name}/{folder}/bucket={b}" for b in wanted for folder in own[b]]

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or only some of its buckets."""
        paths, schema = self.files(name, buckets), self.tables[name].struct()
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def change(self) -> Change:
        return Change(self)

    def vacuum(self, keep: int = 2) -> int:
        """Remove states but the last `keep`, and folders that these do not name; how many."""
        states = self._states()
        used = {(r.name, r.folder) for n in states[-keep:] for r in self._load(n)}
        old = [f"{self.root}/_states/{n:012d}" for n in states[:-keep]]
        for name in self.tables:
            there = folder_names(self.spark, f"{self.root}/{name}/*")
            old += [f"{self.root}/{name}/{x}" for x in there if (name, x) not in used]
        for path in old:
            delete_path(self.spark, path)
        return len(old)


class Change:
    """New folders of a store, not seen before `commit`. Its own reads see them."""

    def __init__(self, store: Store) -> None:
        self.store, self.label = store, uuid.uuid4().hex
        self._folders = {name: {b: list(f) for b, f in own.items()} for name, own in store._folders.items()}

    def _view(self) -> Store:
        view = object.__new__(Store)
        view.__dict__.update(self.store.__dict__, _folders=self._folders)
        return view

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        return self._view().read(name, buckets)

    def files(self, name: str, buckets: Iterable[int] | None = None) -> list[str]:
        return self._view().files(name, buckets)

    def clear(self) -> None:
        """Empty all tables."""
        self._folders.clear()

    def folders(self, name: str) -> dict[int, list[str]]:
        return self._folders.get(name, {})

    def _write(self, name: str, rows: DataFrame) -> dict[int, str]:
        """Write rows by bucket; the folder of every bucket that got some."""
        folder = f"{self.label}-{uuid.uuid4().hex[:8]}"
        path = f"{self.store.root}/{name}/{folder}"
        schema = self.store.tables[name].struct()
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        rows = rows.withColumn("bucket", self.store.bucket(name))
        with dropped_shuffles(self.store.spark):
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        found = folder_names(self.store.spark, f"{path}/bucket=*")
        return {int(f.removeprefix("bucket=")): folder for f in found}

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """Add rows; nothing that is there is read or rewritten. The rows, read from where they were written."""
        added = self._write(name, rows)
        for bucket, folder in added.items():
            self._folders.setdefault(name, {}).setdefault(bucket, []).append(folder)
        view = self._view()
        view._folders = {name: {bucket: [folder] for bucket, folder in added.items()}}
        return view.read(name)

    def replace(self, name: str, rows: DataFrame, buckets: Sequence[int] | None = None) -> None:
        """The rows take the place of the whole table, or of these buckets."""
        written = self._write(name, rows)
        own = self._folders.setdefault(name, {})
        for bucket in list(own) if buckets is None else buckets:
            own.pop(bucket, None)
        for bucket, folder in written.items():
            own[bucket] = [folder]

    def rewrite(
        self, name: str, rows: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> list[int]:
        """Replace the buckets of the rows' keys by `merged(old rows of them, rows)`."""
        buckets = self.store.touched(name, rows)
        if buckets:
            self.replace(name, merged(self.read(name, buckets), rows), buckets)
        return buckets

    def merge(self, name: str, rows: DataFrame) -> list[int]:
        """Merge a batch (one row per key) by the table's rule; the buckets rewritten."""
        table = self.store.tables[name]
        keys = list(table.keys)

        def merged(old: DataFrame, new: DataFrame) -> DataFrame:
            new = new.select(*old.columns)
            if table.updates is None:
                return insert_if_absent(old, new, keys)
            return merge_upsert(old, new, keys, table.updates)

        return self.rewrite(name, rows, merged)

    def compact(self, name: str) -> list[int]:
        """Make one folder of every bucket that has several."""
        many = [b for b, folders in self._folders.get(name, {}).items() if len(folders) > 1]
        if many:
            self.replace(name, self.read(name, many), many)
        return many

    def commit(self) -> None:
        """Show the change to readers, all tables at once."""
        store = self.store
        number = store._number + 1
        path = f"{store.root}/_states/{number:012d}"
        if path_exists(store.spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"another writer has changed {store.root}")
        delete_path(store.spark, path)  # what a lost run has left
        rows = [
            (name, bucket, folder, store.buckets)
            for name, own in self._folders.items()
            for bucket, folders in own.items()
            for folder in folders
        ]
        rows = rows or [("", 0, "", store.buckets)]
        state = store.spark.createDataFrame(rows, _STATE)
        state.coalesce(1).write.parquet(path)
        store._number, store._folders = number, self._folders
