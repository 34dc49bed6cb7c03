"""Versioned snapshots of a dataset: immutable data folders and one manifest.

::

    <path>/data/snapshot_run=<run>/epoch=<N>/*.parquet written once, never renamed or changed
    <path>/_manifests/m-<version>.json               which folder holds each epoch

A run writes its epochs to a folder of its own and then publishes a manifest that
points to them and, for all other epochs, to the folders of earlier runs. Publishing
is one rename of a small file onto a name that must not exist. Readers resolve the
newest manifest when they start, so they see the dataset as it was before or after a
run, whatever happens in between; a run that stops halfway leaves folders that no
manifest names. Of two runs that publish the same version, the second fails. The
manifest also holds what the next run has to know: unsettled epochs, processed
epochs, fingerprints of the source files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS, DATA, RUN = "_manifests", "data", "snapshot_run"      # RUN: no dataset has a column of this name


class Conflict(RuntimeError):
    """Another run has published the version that this one wanted to."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str, folders: bool = True) -> list[str]:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if bool(s.isDirectory()) == folders)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """``text`` as a new file ``name``: written aside, then renamed onto a name
    that must be free. :class:`Conflict` if it is not."""
    fs, target = file_system(spark, f"{folder}/{name}")
    _, aside = file_system(spark, f"{folder}/_{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Conflict(f"{folder}/{name} has been published by another run")


def newest(spark: SparkSession, folder: str, prefix: str) -> tuple[int, dict] | None:
    """(version, content) of the newest ``<prefix><version>.json`` in ``folder``."""
    names = [n for n in list_names(spark, folder, folders=False) if n.startswith(prefix) and n.endswith(".json")]
    if not names:
        return None
    name = max(names)
    return int(name[len(prefix):-5]), json.loads(read_text(spark, f"{folder}/{name}"))


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest of the dataset at ``path``; None if it has none."""
    found = newest(spark, f"{path}/{MANIFESTS}", "m-")
    return None if found is None else {**found[1], "version": found[0]}


def stage(df: DataFrame, path: str) -> dict[str, str]:
    """Write ``df`` (laid out by the caller) to a new data folder, by epoch.
    Returns the folder of each epoch in it; nothing is visible to readers yet."""
    spark, run = df.sparkSession, f"{RUN}=r{uuid.uuid4().hex[:16]}"
    df.write.partitionBy("epoch").parquet(f"{path}/{DATA}/{run}")
    return {n.split("=", 1)[1]: f"{run}/{n}" for n in list_names(spark, f"{path}/{DATA}/{run}") if n.startswith("epoch=")}


def commit(spark: SparkSession, path: str, schema: StructType, change: Callable[[dict], dict], base: dict | None) -> dict:
    """Publish the manifest that ``change`` makes of ``base`` (its parts, unsettled
    epochs and state). Fails if another run has published since ``base`` was read."""
    old = base or {"version": 0, "parts": {}, "unsettled": [], "state": {}}
    new = change({k: old[k] for k in ("parts", "unsettled", "state")})
    new = {"schema": schema.jsonValue(), **new}
    publish_text(spark, f"{path}/{MANIFESTS}", f"m-{old['version'] + 1:010d}.json", json.dumps(new, sort_keys=True))
    return {**new, "version": old["version"] + 1}


def _paths(manifest: dict, path: str, wanted: Iterable[str] | None) -> list[str]:
    parts = manifest["parts"]
    keep = set(parts) if wanted is None else set(parts) & {str(e) for e in wanted}
    return [f"{path}/{DATA}/{parts[e]}" for e in sorted(keep)]


def read(spark: SparkSession, path: str, manifest: dict | None = None, epochs: Sequence[int] | None = None) -> DataFrame | None:
    """The dataset as the newest (or the given) manifest has it, with its columns
    in order; ``epochs``: only their folders are listed and read. None if it was
    never published."""
    manifest = manifest or current(spark, path)
    if manifest is None:
        return None
    schema = StructType.fromJson(manifest["schema"])
    paths = _paths(manifest, path, epochs)
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("basePath", f"{path}/{DATA}").parquet(*paths)
            .select(*[f.name for f in schema.fields]))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete data folders that none of the newest ``keep`` manifests names, and
    older manifests. Run it when no reader of an older version is left and no run
    is under way. Returns the deleted folders."""
    folder = f"{path}/{MANIFESTS}"
    names = [n for n in list_names(spark, folder, folders=False) if n.startswith("m-")]
    kept, old = names[-keep:], names[:-keep]
    used = {p.split("/", 1)[0] for n in kept for p in json.loads(read_text(spark, f"{folder}/{n}"))["parts"].values()}
    gone = [run for run in list_names(spark, f"{path}/{DATA}") if run.startswith(f"{RUN}=") and run not in used]
    for name in [f"{folder}/{n}" for n in old] + [f"{path}/{DATA}/{run}" for run in gone]:
        fs, p = file_system(spark, name)
        fs.delete(p, True)
    return gone
