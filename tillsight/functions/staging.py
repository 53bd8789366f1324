"""Hand-off tables between stages, written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PACKAGE = "tillsight"
# The shuffle files behind a written table are not needed again; without this they wait for the driver's garbage collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Both are shared by all executors. Only a local session with neither gets a
    folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        root = _local_roots.setdefault(app, _local_roots.get(app) or tempfile.mkdtemp(prefix=f"{PACKAGE}-"))
    return root.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    The scan keeps column pruning and filter pushdown, has a short lineage and
    does not depend on any executor staying alive.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{staging_root(spark)}/{PACKAGE}/{app}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the staged table that ``df``, as returned by :func:`stage`, scans."""
    spark = df.sparkSession
    own = f"/{PACKAGE}/{spark.sparkContext.applicationId}/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if own in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables staged by this application, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/{PACKAGE}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
