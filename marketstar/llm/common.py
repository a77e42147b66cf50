"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstar.session import scratch_path

#: A word: a run of bytes other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage for lost executors and lets several consumers share one
    computation; the folder is the one named by ``spark.checkpoint.dir``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a broadcast side, at most; a larger one is joined by a shuffle.
FEW_ROWS = 100_000


def beside(df: DataFrame) -> DataFrame | None:
    """A small side of a join, counted first: None if it has no row, marked for broadcast if it has ``FEW_ROWS`` at most."""
    n = df.limit(FEW_ROWS + 1).count()
    if not n:
        return None
    return F.broadcast(df) if n <= FEW_ROWS else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def unique_name(prefix: str) -> str:
    """A column name that no input table has."""
    return f"__{prefix}_{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder (set on the context here only where nothing set it before)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        from marketstar.session import shared_dir

        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package also where it is not installed but beside the driver's program."""
    import os

    import marketstar

    root = os.path.dirname(os.path.dirname(os.path.abspath(marketstar.__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    env.setdefault("OMP_NUM_THREADS", "1")  # a task has one core: its matrix products start no threads of their own
    return spark
