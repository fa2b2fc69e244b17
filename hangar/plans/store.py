"""The warehouse on shared storage: versions, one pointer, one log of rejects.

A refresh writes every table into a folder of its own
(``versions/<version>/<table>``) and the rejected rows beside them
(``rejects/<rule>/run=<run>/<version>``).  A manifest lists them, and the last
step replaces the file ``CURRENT``, which names the manifest, by one atomic
rename.  So a reader sees the warehouse of one refresh, whole, whenever it
looks, and a refresh that fails midway leaves nothing but files that no
manifest names.

Rejects are a log over all runs: the manifest carries the parts of the earlier
runs on, and a run that is repeated under its id replaces its part.  Old
versions stay until ``retire`` removes them, so queries that were opened before a
refresh finish on the files they started with.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hangar import schemas

POINTER = "CURRENT"
#: Versions that are left when a refresh has published the next.
KEEP = 3


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever file system holds it."""
    target, fs = _fs(spark, path)
    fs.delete(target, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is no such file."""
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return None
    lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    stream = fs.open(target)
    try:
        return lines.toString(stream, "UTF-8")
    finally:
        stream.close()


def _swap(spark: SparkSession, path: str, text: str) -> None:
    """Replace a file's text: readers find the old one or the new one."""
    jvm = spark.sparkContext._jvm
    fresh = f"{path}.{uuid.uuid4().hex}"
    _write_text(spark, fresh, text)
    source, _ = _fs(spark, fresh)
    target, fs = _fs(spark, path)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(source, target, how)


@dataclass(frozen=True)
class Snapshot:
    """What one manifest names: paths below the root, by table, and by rule and run."""

    version: str
    tables: dict[str, str] = field(default_factory=dict)
    rejects: dict[str, dict[str, str]] = field(default_factory=dict)
    reject_format: str = "csv"

    def to_text(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The published version, None before the first."""
    version = _read_text(spark, os.path.join(root, POINTER))
    if version is None:
        return None
    text = _read_text(spark, os.path.join(root, "versions", version.strip(), "manifest.json"))
    if text is None:
        raise ValueError(f"{root}: version {version.strip()} has no manifest")
    return Snapshot(**json.loads(text))


def write_table(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    """One table as Parquet, partitioned by ``by``.  Rows of a partition should lie
    together (``etl.by_year``): each task writes a file for each one it has rows of."""
    df.write.partitionBy(*by).parquet(path)


class Publication:
    """The writes of one refresh; ``commit`` shows them all at once."""

    def __init__(self, spark: SparkSession, root: str, run: str, reject_format: str = "csv"):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run
        self.version = f"{run}-{uuid.uuid4().hex[:8]}"
        self.before = current(spark, self.root)
        if self.before and self.before.rejects and self.before.reject_format != reject_format:
            raise ValueError(f"the log of rejects is {self.before.reject_format}, not {reject_format}")
        self._format = reject_format
        self._tables: dict[str, str] = {}
        self._rejects: dict[str, str] = {}

    def table(self, name: str, df: DataFrame, by: Iterable[str] = ()) -> str:
        """Writes one table of this version."""
        self._tables[name] = os.path.join("versions", self.version, name)
        path = os.path.join(self.root, self._tables[name])
        write_table(df, path, by)
        return path

    def reject(self, rule: str, df: DataFrame) -> str:
        """Writes this run's part of a rule's log."""
        self._rejects[rule] = os.path.join("rejects", rule, f"run={self.run}", self.version)
        path = os.path.join(self.root, self._rejects[rule])
        df.write.format(self._format).option("header", True).save(path)
        return path

    def commit(self, keep: int = KEEP) -> Snapshot:
        """Replaces the pointer, then removes what is older than ``keep`` versions.
        Fails if another refresh has published since this one began."""
        now = current(self.spark, self.root)
        if (now and now.version) != (self.before and self.before.version):
            raise ValueError(f"{self.root}: version {now and now.version} was published meanwhile")
        log = {rule: dict(parts) for rule, parts in (self.before.rejects if self.before else {}).items()}
        for rule, path in self._rejects.items():
            log.setdefault(rule, {})[self.run] = path
        done = Snapshot(self.version, self._tables, log, self._format)
        _write_text(self.spark, os.path.join(self.root, "versions", self.version, "manifest.json"), done.to_text())
        _swap(self.spark, os.path.join(self.root, POINTER), self.version)
        retire(self.spark, self.root, keep)
        return done


def retire(spark: SparkSession, root: str, keep: int = KEEP) -> list[str]:
    """Removes versions and parts of the log that no kept version names; returns the
    versions.  Kept are the newest ``keep`` by the time of their manifests, the
    published one always.  Folders without a manifest belong to a refresh that is
    running or has failed; only those older than the published version go."""
    now = current(spark, root)
    folder, fs = _fs(spark, os.path.join(root, "versions"))
    if now is None or not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        manifest, _ = _fs(spark, os.path.join(status.getPath().toString(), "manifest.json"))
        whole = fs.exists(manifest)
        at = (fs.getFileStatus(manifest) if whole else status).getModificationTime()
        found.append((status.getPath().getName(), at, whole))
    published = next(at for name, at, _ in found if name == now.version)
    whole = sorted((x for x in found if x[2] and x[0] != now.version), key=lambda x: -x[1])
    gone = [name for name, _, _ in whole[max(0, keep - 1):]]
    gone += [name for name, at, ok in found if not ok and at < published]
    kept = [name for name, _, ok in found if ok and name not in gone]
    named = set()
    for name in kept:
        snapshot = json.loads(_read_text(spark, os.path.join(root, "versions", name, "manifest.json")))
        named |= {path for parts in snapshot["rejects"].values() for path in parts.values()}
    children = lambda path: [x.getPath().toString() for x in fs.listStatus(_fs(spark, path)[0])]
    log = os.path.join(root, "rejects")
    for rule in children(log) if fs.exists(_fs(spark, log)[0]) else []:
        for run in children(rule):
            for part in children(run):
                path = os.path.join("rejects", *part.rsplit("/", 3)[1:])
                if os.path.basename(part) in gone and path not in named:
                    delete_folder(spark, part)
    for name in gone:
        delete_folder(spark, os.path.join(root, "versions", name))
    return gone


# ---- reading ------------------------------------------------------------------

#: Columns that a table is partitioned by, beyond its declared ones.
PARTITIONS = {"daily_aircraft_stats": ("year",)}


def read_tables(spark: SparkSession, root: str, snapshot: Snapshot, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables of one version, each checked against its declared columns and types."""
    out = {}
    declared = {**schemas.WAREHOUSE_SCHEMAS, **schemas.KEY_MAP_SCHEMAS, "aircraft_sets": schemas.AIRCRAFT_SETS}
    for name in names:
        df = spark.read.parquet(os.path.join(root, snapshot.tables[name]))
        want = [(f.name, f.dataType) for f in declared[name]]
        want += [(c, T.IntegerType()) for c in PARTITIONS.get(name, ())]
        got = [(f.name, f.dataType) for f in df.schema]
        if got != want:
            raise ValueError(f"{name} of version {snapshot.version}: columns {got}, declared {want}")
        out[name] = df
    return out


def read_rejects(spark: SparkSession, root: str, rule: str, schema: T.StructType) -> DataFrame:
    """The log of a rule: the rejected rows of all runs, with their ``run``."""
    snapshot = current(spark, root)
    parts = (snapshot.rejects if snapshot else {}).get(rule, {})
    run = T.StructField("run", T.StringType())
    whole = T.StructType([*schema.fields, run])
    if not parts:
        return spark.createDataFrame([], whole)
    base = os.path.join(root, "rejects", rule)
    # a ``run=<id>`` folder is a partition: one scan of the parts of all runs
    return (spark.read.format(snapshot.reject_format).schema(whole).option("header", True)
            .option("basePath", base).load([os.path.join(root, p) for p in parts.values()]))
