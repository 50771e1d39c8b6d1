"""Versions of a set of tables, published at once (O-25, O-26, O-28), and what builds on them: merges
that rewrite only the buckets an increment touches (O-19, O-93) and keep the high-water marks of
their tables (O-52), loads in batches that keep what was committed before a failing one (O-21), and
an append-only registry of surrogate keys (O-89).

Data folders are written once and never changed.  A version is a small numbered file in ``_log``
that names the folders of every table; it is created last and must not exist before, so a reader
sees a whole version or the one before it, and of two writers that started from the same version
one fails.  A job that dies leaves folders nobody names, which ``vacuum`` removes.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import keys as key_ops
from ledgerlake.operators import merge
from ledgerlake.session import cut_lineage
from ledgerlake.sources import fs

BUCKET = "__ll_bucket"
PIECE = "__ll_piece"
#: Stored bytes that one task of a merge writes, about.
TASK_BYTES = 16 << 20


class VersionConflict(RuntimeError):
    """Another writer published a version since this one was read."""


class VersionLog:
    """The versions under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> list[int]:
        return sorted(int(n[:-5]) for n in fs.names(self.spark, f"{self.root}/_log") if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, version: int) -> dict | None:
        try:
            return json.loads(fs.read_text(self.spark, f"{self.root}/_log/{version:012d}.json"))
        except ValueError:
            return None                     # its writer died while writing it: never published

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return next((v for v in reversed(self._entries()) if self._load(v) is not None), 0)

    def read(self, version: int | None = None) -> dict:
        """``{"tables": {name: ...}, "notes": {name: ...}}`` of a version (default: the newest)."""
        version = self.version() if version is None else version
        found = self._load(version) if version else {"tables": {}, "notes": {}}
        if found is None:
            raise ValueError(f"version {version} of {self.root} was never published")
        return found

    def commit(self, since: int, tables: dict, notes: dict | None = None) -> int:
        """Publish the tables and notes of version ``since`` with these put over them."""
        if self.version() != since:
            raise VersionConflict(f"{self.root} is at version {self.version()}, not {since}")
        old = self.read(since)
        entry = {"tables": old["tables"] | tables, "notes": old["notes"] | (notes or {})}
        number = max(self._entries(), default=0) + 1
        if not fs.write_new(self.spark, f"{self.root}/_log/{number:012d}.json", json.dumps(entry, sort_keys=True)):
            raise VersionConflict(f"version {number} of {self.root} was published meanwhile")
        return number

    def folder(self, name: str) -> str:
        """Name of a new data folder, relative to the root."""
        return f"data/{name}-{uuid.uuid4().hex[:16]}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def write(self, name: str, df: DataFrame) -> dict:
        """Write a table into a new folder; its entry for ``commit``."""
        folder = self.folder(name)
        df.write.parquet(self.path(folder))
        return {"folders": [folder]}

    def table(self, name: str, version: int | None = None) -> DataFrame:
        found = self.read(version)["tables"]
        if name not in found:
            raise KeyError(f"{self.root} holds no table {name}")
        return self.spark.read.parquet(*[self.path(f) for f in found[name]["folders"]])

    def vacuum(self, keep: int = 2, older_than: float = 24 * 3600) -> list[str]:
        """Remove all but the newest ``keep`` versions, then the data folders that no version left
        names and that are older than ``older_than`` seconds (a running job's are younger)."""
        published = [v for v in self._entries() if self._load(v) is not None]
        for v in published[:-keep]:
            fs.remove(self.spark, f"{self.root}/_log/{v:012d}.json")
        used = {f.split("/")[1] for v in published[-keep:] for t in self.read(v)["tables"].values()
                for f in [*t.get("folders", ()), *t.get("buckets", {}).values()]}
        gone = [n for n in fs.names(self.spark, f"{self.root}/data")
                if n not in used and time.time() - fs.modified(self.spark, f"{self.root}/data/{n}") >= older_than]
        for n in gone:
            fs.remove(self.spark, f"{self.root}/data/{n}")
        return gone


@dataclass(frozen=True)
class Mark:
    """``MAX(column)`` of a table, or of its rows whose ``by`` column holds ``value``."""
    column: str
    by: str | None = None
    value: str | None = None

    @property
    def name(self) -> str:
        return self.column if self.by is None else f"{self.column} where {self.by}={self.value}"

    def expression(self) -> Column:
        return F.max(self.column if self.by is None else F.when(F.col(self.by) == F.lit(self.value), F.col(self.column)))


def _mark_text(value, kind: T.DataType):
    """A mark as it stands in a version file."""
    if value is None or isinstance(kind, (T.IntegralType, T.StringType)):
        return value
    if isinstance(kind, T.DecimalType):
        return str(value)
    if isinstance(kind, T.DateType):
        return value.isoformat()
    return value.isoformat(sep=" ", timespec="microseconds")


def _mark_value(text, kind: T.DataType):
    """What a version file says, as a value that compares like the column."""
    if isinstance(kind, T.DecimalType):
        return Decimal(text)
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return dt.datetime.fromisoformat(text)
    return text


def _stored_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame scans, by the optimizer's estimate (0: none)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if df.inputFiles() else 0


class BucketedTable:
    """A merge target cut into ``buckets`` by a hash of its conflict keys.

    The version names the folder of every bucket, so a merge reads and writes the buckets that
    hold a key of the increment and carries the others over.  It also holds the ``marks`` of every
    bucket, taken from the files just written: the mark of the table is their maximum, known from
    the version alone and right also where a merge lowers or removes the highest value.
    """

    def __init__(self, log: VersionLog, name: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64,
                 marks: Sequence[Mark] = ()):
        self.log, self.name, self.schema, self.keys, self.buckets = log, name, schema, list(keys), buckets
        self.marks = list(marks)
        for m in self.marks:
            kind = schema[m.column].dataType
            if not isinstance(kind, (T.IntegralType, T.StringType, T.DecimalType, T.DateType, T.TimestampNTZType, T.TimestampType)):
                raise TypeError(f"{m.column}: no marks are kept of {kind.simpleString()}")

    def mark(self, mark: Mark, version: int | None = None) -> Column | None:
        """The mark as a literal of the column's type; None for a table without such a value.  Only
        the version file is read."""
        version = self.log.version() if version is None else version
        entry = self.log.read(version)["tables"].get(self.name)
        if entry is None:
            return None
        held = entry.get("marks", {})
        if mark.name not in held:
            raise KeyError(f"{self.name} keeps no mark {mark.name}")
        kind = self.schema[mark.column].dataType
        if not held[mark.name]:
            return None
        value = max(_mark_value(text, kind) for text in held[mark.name].values())
        if isinstance(kind, T.TimestampType):           # kept in UTC, whatever the session's zone is
            return F.timestamp_micros(F.lit((value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)))
        return F.lit(_mark_text(value, kind)).cast(kind)

    def _bucket_marks(self, folder: str, touched: Sequence[int], held: dict) -> dict:
        """The marks of all buckets after ``touched`` were written to ``folder``: one narrow scan of
        the new files, a row a bucket."""
        if not self.marks:
            return {}
        found = (self.log.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())]))
                 .parquet(self.log.path(folder)).groupBy(BUCKET)
                 .agg(*[(F.unix_micros(m.expression()) if isinstance(self.schema[m.column].dataType, T.TimestampType)
                         else m.expression()).alias(f"m{i}") for i, m in enumerate(self.marks)]).collect())
        out = {}
        for i, m in enumerate(self.marks):
            kind = self.schema[m.column].dataType
            kept = {b: v for b, v in held.get(m.name, {}).items() if int(b) not in set(touched)}
            for row in found:
                value = row[f"m{i}"]
                if value is not None and isinstance(kind, T.TimestampType):
                    value = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=value)
                if value is not None:
                    kept[str(row[BUCKET])] = _mark_text(value, kind)
            out[m.name] = kept
        return {"marks": out}

    def bucket_of(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def _folders(self, version: int) -> dict[str, str]:
        found = self.log.read(version)["tables"].get(self.name, {"buckets": {}, "count": self.buckets})
        if found["count"] != self.buckets:
            raise ValueError(f"{self.name} is stored in {found['count']} buckets, not {self.buckets}")
        return found["buckets"]

    def read(self, only: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        held = self._folders(self.log.version() if version is None else version)
        wanted = sorted(held if only is None else {str(b) for b in only} & held.keys(), key=int)
        paths = [f"{self.log.path(held[b])}/{BUCKET}={b}" for b in wanted]
        reader = self.log.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.log.spark.createDataFrame([], self.schema)

    def merge(self, source: DataFrame, update_cols: Sequence[str] | None = None, notes: dict | None = None,
              since: int | None = None, **audit) -> list[int]:
        """Upsert ``source`` (keys unique but for NULLs) and publish it with ``notes``; the buckets
        that were rewritten.  A source without rows publishes the notes alone."""
        since = self.log.version() if since is None else since
        held = self._folders(since)
        marked = self.log.read(since)["tables"].get(self.name, {}).get("marks", {})
        if held and (lacking := [m.name for m in self.marks if m.name not in marked]):
            raise ValueError(f"{self.name} was written without the marks {lacking}")
        src = cut_lineage(source.withColumn(BUCKET, self.bucket_of()), "increment")
        touched = sorted(r[0] for r in src.select(BUCKET).distinct().collect())          # at most ``buckets`` numbers
        entry = {}
        if touched:
            stored = self.read(touched, since)
            merged = merge.upsert(stored, src.drop(BUCKET), self.keys, update_cols, **audit)
            folder = self.log.folder(self.name)
            # a task and a file a bucket; a large bucket is cut into pieces of about TASK_BYTES
            pieces = max(1, -(-sum(_stored_bytes(df) for df in (stored, src)) // (len(touched) * TASK_BYTES)))
            out = merged.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(BUCKET, self.bucket_of())
            if pieces > 1:
                row = F.xxhash64(*[F.col(f.name) for f in self.schema.fields])
                out = (out.withColumn(PIECE, F.pmod(row, F.lit(pieces)))
                       .repartition(len(touched) * pieces, BUCKET, PIECE).drop(PIECE))
            else:
                out = out.repartition(len(touched), BUCKET)
            out.write.partitionBy(BUCKET).parquet(self.log.path(folder))
            entry = {self.name: {"count": self.buckets, "buckets": held | {str(b): folder for b in touched},
                                 **self._bucket_marks(folder, touched, marked)}}
        if touched or notes:
            self.log.commit(since, entry, notes)
        return touched


class BatchFailed(RuntimeError):
    """A batch that the target refuses; the ones before it are committed."""

    def __init__(self, load_id: str, batch: int, committed: int):
        super().__init__(f"load {load_id}: duplicate conflict key inside batch {batch + 1}; {committed} batches are committed")
        self.load_id, self.batch, self.committed = load_id, batch, committed


LEDGER_SCHEMA = "load_id string, batch_size long, batches long, committed long, rows long, failed_batch long"


def ledger(log: VersionLog) -> DataFrame:
    """One row a load: its batches, how many are committed with how many rows, and the batch that
    failed (from 1; NULL where none did)."""
    notes = log.read()["notes"]
    rows = [tuple(n[c] for c in ("load_id", "batch_size", "batches", "committed", "rows", "failed_batch"))
            for k, n in sorted(notes.items()) if k.startswith("load:")]
    return log.spark.createDataFrame(rows, LEDGER_SCHEMA)


def load_in_batches(table: BucketedTable, source: DataFrame, order: Sequence[Column], load_id: str,
                    update_cols: Sequence[str] | None = None, batch_size: int = 10_000, **audit) -> int:
    """The batched loader with a commit a batch (O-21): rows in ``order`` (total) are cut into
    batches; a later batch wins over an earlier one; a key repeated inside a batch is refused.

    The batches before the first refused one are published together with the ledger row, in one
    version, then ``BatchFailed`` is raised.  A later call with the same ``load_id`` and the mended
    source, cut alike, starts after the batches already committed.  Returns the rows committed by
    this call; an empty source commits nothing.
    """
    log = table.log
    since = log.version()
    known = log.read(since)["notes"].get(f"load:{load_id}")
    if known and known["batch_size"] != batch_size:
        raise ValueError(f"load {load_id} was cut into batches of {known['batch_size']}")
    done = known["committed"] if known else 0
    batched = merge.number_batches(merge.nan_to_null_columns(source), order, batch_size)
    last = batched.agg(F.max(merge.BATCH)).first()[0]
    if last is None:
        return 0
    rest = batched.where(F.col(merge.BATCH) >= done)
    failed = merge.failing_batch(rest, table.keys).first()[0]
    if failed is not None:
        rest = rest.where(F.col(merge.BATCH) < failed)
    upto = last + 1 if failed is None else failed
    rows = rest.count()
    note = {"load_id": load_id, "batch_size": batch_size, "batches": last + 1, "committed": upto,
            "rows": rows + (known["rows"] if known else 0), "failed_batch": None if failed is None else failed + 1}
    table.merge(merge.latest_rows(rest, table.keys), update_cols, {f"load:{load_id}": note}, since, **audit)
    if failed is not None:
        raise BatchFailed(load_id, failed, upto)
    return rows


class KeyRegistry:
    """Every natural key a dimension ever had, with its id, apart from the dimension itself.

    Keys are only added, so a key that vanishes from the dimension keeps its id for the day it
    comes back, and no other key is given it.
    """

    #: Folders of added keys from which on they are rewritten as one.
    MOST_FOLDERS = 64

    def __init__(self, log: VersionLog, name: str, key_cols: Sequence[str], id_col: str):
        self.log, self.name, self.key_cols, self.id_col = log, f"keys_{name}", list(key_cols), id_col

    def _folders(self, version: int) -> list[str]:
        return self.log.read(version)["tables"].get(self.name, {"folders": []})["folders"]

    def read(self, version: int | None = None) -> DataFrame | None:
        """(id, keys) of all keys so far; None before the first registration."""
        folders = self._folders(self.log.version() if version is None else version)
        return self.log.spark.read.parquet(*[self.log.path(f) for f in folders]) if folders else None

    def extend(self, current: DataFrame, since: int) -> dict:
        """Write the keys of ``current`` that the registry of version ``since`` lacks; the entry for
        ``commit``.  ``current`` holds the keys alone (ids follow the highest one, in key order) or
        with ids already given by the registry's rule."""
        known = self.read(since)
        if self.id_col in current.columns:
            found = current.select(self.id_col, *self.key_cols).distinct()
            fresh = found if known is None else found.join(known.select(F.col(self.id_col)), self.id_col, "left_anti")
        elif known is None:
            fresh = key_ops.dense_keys(current, self.key_cols, self.id_col)
        else:
            numbered = key_ops.stable_keys(current, known, self.key_cols, self.id_col)
            fresh = numbered.join(known.select(F.col(self.id_col)), self.id_col, "left_anti")
        fresh = fresh.select(self.id_col, *self.key_cols)
        folders = self._folders(since)
        if len(folders) >= self.MOST_FOLDERS:
            return {self.name: self.log.write(self.name, known.select(self.id_col, *self.key_cols).unionByName(fresh))}
        return {self.name: {"folders": [*folders, *self.log.write(self.name, fresh)["folders"]]}}

    def register(self, current: DataFrame) -> DataFrame:
        """Add the keys of ``current``, publish, and return the whole registry."""
        since = self.log.version()
        self.log.commit(since, self.extend(current, since))
        return self.read()
