"""The load job: publish the star schema and its views, report what was loaded.

Mirrors the reference's job order -- the loads run side by side, the views
are created after both -- as one Spark application.  The per-table row
counts are observed while the tables are written, not by re-scanning them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import catalog
from .star import star_from_driver


def run(spark: SparkSession, sf_dir: str, schema: str, location: str | None = None, parallel: int = 4) -> dict:
    """Publish the six tables and four views of ``sf_dir`` into ``schema``.

    Returns ``{table: rows written}``.
    """
    report: dict = {}
    catalog.publish(spark, star_from_driver(spark, sf_dir), schema, location=location, parallel=parallel, report=report)
    return report
