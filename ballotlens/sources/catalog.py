"""Readers and view registration for exported tables and written datasets.

* Source exports: one directory per table, hive-partitioned (``epoch=N/``,
  ``date=YYYY-MM-DD/``) or flat; an empty directory is no table.
* Outputs: one directory per dataset, partitioned by ``epoch``.
Paths go through the Hadoop FileSystem of the session, so the same code lists
HDFS/S3/ABFS folders on a cluster and local folders in tests.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ballotlens.sources import snapshots
from ballotlens.sources.fixtures import DERIVATIONS
from ballotlens.sources.snapshots import file_system, list_names, path_exists


def source_schema(name: str) -> str | None:
    """DDL of the columns we read from export ``name`` (None if unknown).
    Reading with it prunes every other column at the scan."""
    spec = DERIVATIONS.get(name)
    if spec is None:
        return None
    return ", ".join(f"{n} {t}" for n, t, _ in spec.columns)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, path) if not n.startswith(("_", "."))]


def file_fingerprints(spark: SparkSession, source_dir: str) -> dict[str, dict[str, str]]:
    """Per table folder of ``source_dir`` and epoch folder in it ("" for files
    outside one): number of parquet files and a hash of their names, sizes and
    times. One distributed listing; the files are not opened."""
    names = list_dirs(spark, source_dir)
    if not names:
        return {}
    fs, p = file_system(spark, source_dir)
    prefix = len(fs.makeQualified(p).toString()) + 2
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load([f"{source_dir}/{n}" for n in names]).select("path", "modificationTime", "length"))
    inside = F.substring("path", prefix, 1 << 20)
    prints = (listed.select(inside.alias("file"), "modificationTime", "length")
              .groupBy(F.substring_index("file", "/", 1).alias("table"), F.regexp_extract("file", "/epoch=([^/]+)/", 1).alias("epoch"))
              .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("file", "modificationTime", "length")).alias("h")))
    found: dict[str, dict[str, str]] = {n: {} for n in names}
    for r in prints.collect():                                  # one row per table and epoch
        found[r.table][r.epoch] = f"{r.n}:{r.h}"
    return found


def read_parquet_dir(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """Flat or hive-partitioned parquet folder; None when it holds no data."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.option("basePath", path)
    if schema:
        reader = reader.schema(schema)
    try:
        df = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None                    # empty folder: nothing to infer
    if schema and not list_dirs(spark, path):
        # flat folder with a user schema still needs at least one file
        if not any(n.endswith(".parquet") for n in list_names(spark, path, folders=False)):
            return None
    return df


def read_source_table(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    """Export ``name`` with the columns we read; an error if it has no data or
    lacks one of them (a schema alone would read a missing column as NULL)."""
    found = read_parquet_dir(spark, f"{source_dir}/{name}")
    if found is None:
        raise FileNotFoundError(f"source table {name!r} has no data under {source_dir}")
    if lacking := missing_columns(name, found):
        raise ValueError(f"export {name!r} lacks the column(s) {', '.join(lacking)}")
    schema = source_schema(name)
    return found if schema is None else read_parquet_dir(spark, f"{source_dir}/{name}", schema)


def missing_columns(name: str, df: DataFrame) -> list[str]:
    """Columns that the plans read from export ``name`` and ``df`` lacks."""
    spec = DERIVATIONS.get(name)
    have = {c.lower() for c in df.columns}
    return [] if spec is None else [n for n, _, _ in spec.columns if n.lower() not in have]


def register_source_tables(spark: SparkSession, source_dir: str, prefix: str = "") -> list[str]:
    """One temp view per table folder (hive-partitioned or flat) with all its
    columns; empty folders register nothing, and a known table that lacks a
    column we read is an error. Returns the view names."""
    names = []
    for name in list_dirs(spark, source_dir):
        df = read_parquet_dir(spark, f"{source_dir}/{name}")
        if df is None:
            continue
        if lacking := missing_columns(name, df):
            raise ValueError(f"export {name!r} lacks the column(s) {', '.join(lacking)}")
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def _dataset(spark: SparkSession, path: str) -> DataFrame | None:
    """A written dataset: its newest snapshot, or a plain folder of parquet files."""
    df = snapshots.read(spark, path)
    return df if df is not None else read_parquet_dir(spark, path)


def register_outputs(spark: SparkSession, output_dir: str, names: list[str] | None = None) -> list[str]:
    """Datasets under ``output_dir`` as views: all folders found (SRC5), or those
    of ``names`` (SRC3, SRC4); missing ones are skipped, not an error."""
    done = []
    for name in list_dirs(spark, output_dir) if names is None else names:
        if (df := _dataset(spark, f"{output_dir}/{name}")) is not None:
            df.createOrReplaceTempView(name)
            done.append(name)
    return done


def register_kpi_views(spark: SparkSession, registry=None) -> list[str]:
    """KPI views in registry order, after the dataset views exist."""
    from ballotlens.plans.kpis import KPI_VIEWS
    done = []
    for view_name, build in (registry or KPI_VIEWS):
        try:
            build(lambda n: spark.table(n)).createOrReplaceTempView(view_name)
        except AnalysisException as error:
            if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                raise
            continue                   # a dataset it needs is not written
        done.append(view_name)
    return done


# ------------------------------------------------------- a catalog in files

CATALOG = "_catalog"


def save_catalog(spark: SparkSession, output_dir: str, source_dir: str | None = None, prefix: str = "") -> dict:
    """Publish which views there are: tables of ``source_dir``, datasets under
    ``output_dir`` with their columns, KPI views whose datasets exist. It outlives the
    session: :func:`open_catalog` registers the same views in any other."""
    from ballotlens.plans.kpis import KPI_VIEWS
    from ballotlens.plans.kpis import KPI_VIEW_DATASETS as needs
    datasets = {}
    for name in list_dirs(spark, output_dir):
        if (df := _dataset(spark, f"{output_dir}/{name}")) is not None:
            datasets[name] = df.columns
    tables = []
    for name in list_dirs(spark, source_dir) if source_dir else []:
        if (df := read_parquet_dir(spark, f"{source_dir}/{name}")) is not None:
            if lacking := missing_columns(name, df):
                raise ValueError(f"export {name!r} lacks the column(s) {', '.join(lacking)}")
            tables.append(name)
    content = {"datasets": datasets, "source_dir": source_dir, "source_prefix": prefix, "tables": tables,
               "kpi_views": [view for view, _ in KPI_VIEWS if set(needs[view]) <= set(datasets)]}
    found = snapshots.newest(spark, f"{output_dir}/{CATALOG}", "c-")
    snapshots.publish_text(spark, f"{output_dir}/{CATALOG}", f"c-{(found[0] if found else 0) + 1:010d}.json", json.dumps(content))
    return content


def open_catalog(spark: SparkSession, output_dir: str) -> list[str]:
    """Register in ``spark`` the views that :func:`save_catalog` published last, in
    its order: source tables, datasets (their newest snapshots), KPI views.
    A dataset that lost a column since then is an error."""
    from ballotlens.plans.kpis import KPI_VIEWS
    found = snapshots.newest(spark, f"{output_dir}/{CATALOG}", "c-")
    if found is None:
        raise FileNotFoundError(f"no catalog under {output_dir}")
    content, names = found[1], []
    for name in content["tables"]:
        df = read_parquet_dir(spark, f"{content['source_dir']}/{name}")
        df.createOrReplaceTempView(content["source_prefix"] + name)
        names.append(content["source_prefix"] + name)
    for name, columns in content["datasets"].items():
        df = _dataset(spark, f"{output_dir}/{name}")
        if df is None or not set(columns) <= set(df.columns):
            raise ValueError(f"dataset {name!r} is gone or lacks columns that the catalog names")
        df.createOrReplaceTempView(name)
        names.append(name)
    return names + register_kpi_views(spark, [(v, build) for v, build in KPI_VIEWS if v in content["kpi_views"]])
