"""The set of governance source tables a plan reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ballotlens.session import ensure_session
from ballotlens.sources.fixtures import GOV_TABLES, derive_spark


class Tables:
    """Lazy, memoised map ``name -> DataFrame`` of governance source tables.

    Frames are only plans; nothing is read until an action runs, so listing
    a table that a plan does not use costs nothing.
    """

    def __init__(self, spark: SparkSession, loader: Callable[[str], DataFrame]):
        self.spark = ensure_session(spark)
        self._loader = loader
        self._frames: dict[str, DataFrame] = {}
        self._replaced: set[str] = set()
        self._partitions: Callable[[str], list[int]] | None = None
        self._listing: Callable[[], dict[str, dict[str, str]]] | None = None
        self._prints: dict[str, dict[str, str]] | None = None
        self.plans: dict = {}           # epoch plans made so far, by their parameters

    def partition_epochs(self, name: str) -> list[int] | None:
        """Epochs that table ``name`` has partition folders for; None if it is
        not a folder partitioned by epoch (no data is read)."""
        if self._partitions is None or name in self._replaced:
            return None
        return self._partitions(name) or None

    def fingerprints(self, name: str) -> dict[str, str] | None:
        """Per epoch folder of table ``name`` ("" for files outside one), a
        fingerprint of its files; None if the table is not read from files. All
        tables are listed by one job, at the first call. Frames made before are
        forgotten, so that none is older than the fingerprints."""
        if self._listing is None or name in self._replaced:
            return None
        if self._prints is None:
            self._prints = self._listing()
            self._frames = {n: f for n, f in self._frames.items() if n in self._replaced}
        return self._prints.get(name, {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._loader(name)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def override(self, **frames: DataFrame) -> "Tables":
        """Copy with some tables replaced (unit tests, incremental batches)."""
        t = Tables(self.spark, self._loader)
        t._frames = {**self._frames, **frames}
        t._partitions, t._replaced = self._partitions, self._replaced | set(frames)
        t._listing, t._prints = self._listing, self._prints
        return t

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Governance tables derived from the driver's test tables (each driver
        table is listed and its footer read once per instance)."""
        base: dict[str, DataFrame] = {}

        def read(table: str) -> DataFrame:
            if table not in base:
                base[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            return base[table]
        return cls(spark, lambda name: derive_spark(spark, sf_dir, name, read))

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Tables":
        def missing(name: str) -> DataFrame:
            raise KeyError(f"table {name!r} not provided")
        t = cls(spark, missing)
        t._frames = dict(frames)
        return t

    @classmethod
    def from_catalog(cls, spark: SparkSession, source_dir: str) -> "Tables":
        """Real exports: one directory per table (see ``catalog``)."""
        from ballotlens.sources.catalog import file_fingerprints, list_dirs, read_source_table
        t = cls(spark, lambda name: read_source_table(spark, source_dir, name))
        t._partitions = lambda name: sorted(int(d.split("=", 1)[1]) for d in list_dirs(spark, f"{source_dir}/{name}")
                                            if d.startswith("epoch="))
        t._listing = lambda: file_fingerprints(spark, source_dir)
        return t


__all__ = ["Tables", "GOV_TABLES"]
