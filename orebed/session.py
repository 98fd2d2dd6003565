"""Session settings and lineage cutting shared by every operator."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "orebed", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution, skew splitting and Arrow switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # call-site capture costs several JVM calls per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder.

    Where no such folder is set, as in tests, it is one below the warehouse,
    which all tasks of a session reach by definition.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/orebed-tables")
    return sc.getCheckpointDir()


_noted = threading.local()


@contextmanager
def passing_tables() -> Iterator[None]:
    """Deletes at the end the tables that ``cut_lineage`` writes inside, in this thread; no later plan may read them."""
    outer, _noted.tables = getattr(_noted, "tables", None), []
    try:
        yield
    finally:
        made, _noted.tables = _noted.tables, outer
        release(*made)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of that table.

    Later passes read only the columns they need, and a lost executor re-reads
    files instead of re-running the whole chain.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._cut_path = path
    if getattr(_noted, "tables", None) is not None:
        _noted.tables.append(table)
    return table


def release(*tables: DataFrame | None) -> None:
    """Delete tables of ``cut_lineage`` that no later plan reads."""
    for table in tables:
        path = getattr(table, "_cut_path", None)
        if path is not None:
            jvm = table.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
            table._cut_path = None
