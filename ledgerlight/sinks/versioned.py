"""Sets of tables that a run replaces all at once, by the swap of one pointer.

A root folder holds data folders, which are written once and never changed, and numbered manifests.  A manifest
names, for each table and each of its keys (a month, a day), the folder with the rows of that key, and keeps marks such as
the high-water mark of an incremental source.  A run writes new folders, then one manifest; the manifest with the highest
number is what readers see.  A run that ends before that leaves the old tables and the old marks; two runs
that began from one manifest can't both commit.  Keys are few (months, days), rows never pass the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    folders: dict[str, dict[str, str]] = field(default_factory=dict)  #: table -> key -> folder below the root
    schemas: dict[str, str] = field(default_factory=dict)  #: table -> JSON schema
    marks: dict[str, object] = field(default_factory=dict)

    def replacing(self, table: str, new: dict[str, str], schema: T.StructType, drop: Callable[[str], bool] = lambda key: False) -> Manifest:
        """The manifest with the keys of ``new`` replaced and those that ``drop`` accepts removed."""
        kept = {k: f for k, f in self.folders.get(table, {}).items() if not drop(k)}
        return replace(self, folders=self.folders | {table: kept | new}, schemas=self.schemas | {table: schema.json()})

    def marking(self, **marks: object) -> Manifest:
        return replace(self, marks=self.marks | marks)


def _files(spark: SparkSession, root: str):
    """Hadoop's file context for ``root``, and its Path class."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    files, path = _files(spark, name)
    return files.util().exists(path(name))


def touch(spark: SparkSession, name: str) -> None:
    """Make an empty file."""
    _write(spark, name, "")


def _write(spark: SparkSession, name: str, text: str) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files, path = _files(spark, name)
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE)
    stream = files.create(path(name), flags, gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 0))
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, path = _files(spark, folder)
    if not files.util().exists(path(folder)):
        return []
    return [s.getPath().getName() for s in files.util().listStatus(path(folder))]


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, root: str, version: int) -> Manifest:
    files, path = _files(spark, root)
    stream = files.open(path(f"{root}/{MANIFESTS}/{version:012d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(version, **json.loads(text))


def current(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; an empty one of version 0 where nothing was committed yet."""
    versions = _versions(spark, root)
    return load(spark, root, versions[-1]) if versions else Manifest()


def commit(spark: SparkSession, root: str, new: Manifest) -> Manifest:
    """Make ``new``, derived from the current manifest, the current one: written aside, then renamed, which fails if
    the number is taken."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files, path = _files(spark, root)
    new = replace(new, version=new.version + 1)
    text = json.dumps({"folders": new.folders, "schemas": new.schemas, "marks": new.marks}, sort_keys=True)
    folder = f"{root}/{MANIFESTS}"
    files.mkdir(path(folder), None, True)
    aside = path(f"{folder}/.{uuid.uuid4().hex}")
    _write(spark, aside.toString(), text)
    try:
        if _versions(spark, root)[-1:] >= [new.version]:
            raise CommitConflict(f"{root}: version {new.version} is taken")
        files.rename(aside, path(f"{folder}/{new.version:012d}.json"), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        files.delete(aside, False)
        if "FileAlreadyExists" in str(e):
            raise CommitConflict(f"{root}: version {new.version} is taken") from e
        raise
    return new


def new_run(label: str) -> str:
    """A folder of its own, below the root, for what one run writes."""
    return f"runs/{label}-{uuid.uuid4().hex[:12]}"


def write_keyed(df: DataFrame, root: str, folder: str, by: dict[str, Column], facts: dict[str, Column] | None = None) -> tuple[list[dict], dict]:
    """Write ``df`` once, dealt into subfolders by the columns of ``by`` (names from ``_`` on, so readers don't see them).

    Returns the keys that have rows, as dicts with their ``folder``, and the values of the aggregates ``facts``.  The keys are
    the subfolders that the job has committed; the facts are observed by the tasks that write, whose results count once even
    if executors are lost.  There is no other pass.
    The rebalance hint puts a key into few large files and lets a key that holds much of the data go to many writers.
    """
    names = list(by)
    seen = Observation(uuid.uuid4().hex)
    keyed = df.withColumns(by).hint("rebalance", *names)
    if facts:
        keyed = keyed.observe(seen, *[c.alias(n) for n, c in facts.items()])
    keyed.write.partitionBy(*names).parquet(f"{root}/{folder}")
    keys = [{"folder": folder}]
    for n in names:
        keys = [k | {n: _value(sub), "folder": f"{k['folder']}/{sub}"}
                for k in keys for sub in _names(df.sparkSession, f"{root}/{k['folder']}") if sub.startswith(f"{n}=")]
    return keys, dict(seen.get) if facts else {}


def _value(folder: str) -> str | None:
    """The value in the name of a partition's folder, where Spark writes some characters as % and two digits."""
    text = unquote(folder.split("=", 1)[1])
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text


def read(spark: SparkSession, root: str, manifest: Manifest, table: str, keys: Callable[[str], bool] = lambda key: True) -> DataFrame:
    """The rows of ``table``, only those of the accepted ``keys``: other folders are neither listed nor opened."""
    if table not in manifest.schemas:
        raise PySparkException(f"{root} has no table {table}")
    schema = T.StructType.fromJson(json.loads(manifest.schemas[table]))
    folders = [f"{root}/{f}" for k, f in sorted(manifest.folders[table].items()) if keys(k)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete runs that none of the ``keep`` newest manifests names, and older manifests; not while another run writes."""
    versions = _versions(spark, root)
    named = {"/".join(f.split("/")[:2]) for v in versions[-keep:] for keys in load(spark, root, v).folders.values() for f in keys.values()}
    gone = [f"runs/{n}" for n in _names(spark, f"{root}/runs") if f"runs/{n}" not in named]
    files, path = _files(spark, root)
    for old in [*gone, *[f"{MANIFESTS}/{v:012d}.json" for v in versions[:-keep]]]:
        files.delete(path(f"{root}/{old}"), True)
    return gone
