"""Scan the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import session_key

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_SCANS: dict = {}


class TableSource:
    """Lazily opens ``{root}/{name}.parquet``; each access is a fresh scan node.

    Nothing is read until an action runs, so Catalyst prunes columns and
    pushes predicates into every scan the queries build on top.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(f"unknown table {name!r}")
        # One scan node per (session, folder, table): file listing and the
        # footer/schema read happen once, not once per query.  The driver
        # tables are read-only, so the shared scan stays valid.
        key = (session_key(self.spark), self.root, name)
        if key not in _SCANS:
            _SCANS[key] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return _SCANS[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self(name)
        raise AttributeError(name)
