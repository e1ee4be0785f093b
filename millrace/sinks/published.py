"""Result tables whose changes become visible all at once.

Every run writes its files below a folder of its own, ``data/run=<id>``, in one
folder for each partition value. A small version file then names, for each
partition, the runs that make it up:

    <table>/data/run=<id>/<partition>=<value>/part-*.parquet
    <table>/versions/00000007.json

The file of the next number is put in place by one rename that fails if it is
already there. So a reader sees the old version or the new one, never a mixture,
whenever the writer dies, and of two writers at a time one starts over from what
the other published. The rename is atomic and exclusive on HDFS and local disks;
a store without such a rename needs one writer at a time for each table.

Version files also keep the last batch of each writer, published in the same
step as its rows: a batch that is repeated publishes nothing. They can also keep
a mark for each partition that says what its rows were computed from; a writer
that gives none takes the mark of what it changes away.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from dataclasses import replace as replaced

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import files

#: Times a writer starts over because others published meanwhile.
ATTEMPTS = 20


class Changed(RuntimeError):
    """What a run was computed from is no longer the newest version."""


@dataclass(frozen=True)
class Version:
    """Runs and mark of each partition folder, and the last batch of each writer."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    def runs(self) -> set[str]:
        return {run for runs in self.folders.values() for run in runs}

    def done(self, writer: str | None, batch: int | None) -> bool:
        """Whether this batch of the writer, or a later one, is in."""
        return writer is not None and self.batches.get(writer, -1) >= batch


@dataclass(frozen=True)
class Staged:
    """Files of one run that no version names yet."""

    run: str
    folders: list[str]
    rows: int


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}/versions"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.names(spark, _versions(path))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version of the table, the newest one by default; number 0 is the empty table."""
    if number is None:
        number = max(_numbers(spark, path), default=0)
    if not number:
        return Version()
    found = json.loads(files.read_text(spark, f"{_versions(path)}/{number:08d}.json"))
    return Version(number, found["folders"], found["batches"], found.get("marks", {}))


def stage(df: DataFrame, path: str, partition: str, coalesce: int | None = None) -> Staged:
    """Write the files of a run in one job; nothing becomes visible."""
    run, seen = uuid.uuid4().hex, Observation()
    shaped = df.coalesce(coalesce) if coalesce else df.hint("rebalance", partition)
    (
        # Observed behind the shuffle, where a row of a repeated task counts once.
        shaped.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(f"{_data(path)}/run={run}")
    )
    names = files.folders(df.sparkSession, f"{_data(path)}/run={run}")
    return Staged(run, sorted(n for n in names if n.startswith(f"{partition}=")), seen.get["rows"])


def commit(spark: SparkSession, path: str, change: Callable[[Version], Version | None]) -> Version:
    """Publish ``change`` of the newest version; None leaves it as it is.

    ``change`` is called again if another writer was first, and may raise
    :class:`Changed` if its rows rest on what that writer replaced.
    """
    for _ in range(ATTEMPTS):
        now = version(spark, path)
        new = change(now)
        if new is None:
            return now
        new = replaced(new, number=now.number + 1)
        parts = {"folders": new.folders, "batches": new.batches, "marks": new.marks}
        text = json.dumps(parts, indent=1)
        if files.put_new(spark, f"{_versions(path)}/{new.number:08d}.json", text):
            return new
    raise Changed(f"{path}: other writers were first {ATTEMPTS} times")


def _with_batch(now: Version, writer: str | None, batch: int | None) -> dict[str, int]:
    return now.batches if writer is None else {**now.batches, writer: batch}


def _unmarked(now: Version, folders: Iterable[str]) -> dict[str, str]:
    changed = set(folders)
    return {f: mark for f, mark in now.marks.items() if f not in changed}


def replace(
    df: DataFrame,
    path: str,
    partition: str,
    folders: Iterable[str] | None = None,
    coalesce: int | None = None,
    base: Version | None = None,
    writer: str | None = None,
    batch: int | None = None,
    marks: dict[str, str] | None = None,
) -> int:
    """Rows written. The partitions of ``df`` replace those of the table; of
    ``folders``, those without rows become empty.

    If ``df`` was computed from the version ``base`` of the table, its partitions
    must not have changed since then. ``marks`` are kept by folder, also of
    folders that become empty.
    """
    spark = df.sparkSession
    if version(spark, path).done(writer, batch):
        return 0
    new = stage(df, path, partition, coalesce)
    gone = set(folders or ()) | set(new.folders)

    def change(now: Version) -> Version | None:
        if now.done(writer, batch):
            return None
        if base and any(now.folders.get(f) != base.folders.get(f) for f in gone):
            raise Changed(path)
        kept = {f: runs for f, runs in now.folders.items() if f not in gone}
        return Version(
            folders=kept | {f: [new.run] for f in new.folders},
            batches=_with_batch(now, writer, batch),
            marks=_unmarked(now, gone) | (marks or {}),
        )

    commit(spark, path, change)
    return new.rows


def append(
    df: DataFrame, path: str, partition: str, writer: str | None = None, batch: int | None = None
) -> int:
    """Rows written. A batch that a writer has published before adds nothing."""
    spark = df.sparkSession
    if version(spark, path).done(writer, batch):
        return 0
    new = stage(df, path, partition)

    def change(now: Version) -> Version | None:
        if now.done(writer, batch):
            return None
        added = {f: [*now.folders.get(f, ()), new.run] for f in new.folders}
        return Version(
            folders=now.folders | added,
            batches=_with_batch(now, writer, batch),
            marks=_unmarked(now, new.folders),
        )

    commit(spark, path, change)
    return new.rows


def append_once(path: str, partition: str, query: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends each micro-batch of ``query`` once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, path, partition, query, batch_id)

    return write


def drop(spark: SparkSession, path: str, expired: Callable[[str], bool]) -> list[str]:
    """Take the partition folders for which ``expired`` holds out of the table."""
    gone: list[str] = []

    def change(now: Version) -> Version | None:
        gone[:] = sorted(f for f in now.folders if expired(f))
        if not gone:
            return None
        return Version(
            folders={f: r for f, r in now.folders.items() if f not in gone},
            batches=now.batches,
            marks=_unmarked(now, gone),
        )

    commit(spark, path, change)
    return gone


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    wanted: Callable[[str], bool] | None = None,
    number: int | None = None,
) -> DataFrame:
    """The rows of a version, the newest one by default.

    Only the folders of the version are listed, and of these the ``wanted`` ones.
    Without ``schema`` the files tell the columns; an empty table needs one.
    """
    found = version(spark, path, number)
    paths = sorted(
        f"{_data(path)}/run={run}/{folder}"
        for folder, runs in found.folders.items()
        if wanted is None or wanted(folder)
        for run in runs
    )
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"{path} has no rows to tell its columns from")
        return spark.createDataFrame([], schema)
    if schema is None:
        return spark.read.option("basePath", _data(path)).parquet(*paths).drop("run")
    layout = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(layout).option("basePath", _data(path)).parquet(*paths).select(*schema.names)


def vacuum(
    spark: SparkSession, path: str, keep: int = 2, older_than: dt.timedelta = dt.timedelta(hours=24)
) -> list[str]:
    """Delete versions but the last ``keep``, and runs that none of these names.

    A run younger than ``older_than`` stays: its writer may be about to publish.
    Readers of a version that goes must be done within that time.
    """
    numbers = _numbers(spark, path)
    kept = numbers[-keep:]
    used = set().union(*(version(spark, path, n).runs() for n in kept)) if kept else set()
    for number in numbers[:-keep]:
        files.delete(spark, f"{_versions(path)}/{number:08d}.json")
    gone = []
    for name in sorted(files.folders(spark, _data(path))):
        folder = f"{_data(path)}/{name}"
        if name.removeprefix("run=") not in used and files.age(spark, folder) >= older_than:
            files.delete(spark, folder)
            gone.append(name)
    return gone
