"""Session and storage helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "braidlake", cores: str = "*", **conf: str) -> SparkSession:
    """A session with the settings that the operators are tuned for; an existing one is reused."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if SparkSession.getActiveSession() is None:
        builder = builder.master(f"local[{cores}]")
    return builder.config(map=defaults | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; the path may belong to any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, as in
    tests on one machine, a temporary folder is set as the session's own; a cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="braidlake-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/braidlake/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what this application's ``materialize`` has written to the shared folder. Call it once results are stored."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of an Arrow batch, so that a worker's memory doesn't grow with the size of rows.
ARROW_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors; done once per context."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    context = spark.sparkContext
    if getattr(context, "_braidlake_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="braidlake-ship-")) / "braidlake.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(Path(root.name) / source.relative_to(root)))
    context.addPyFile(str(target))
    context._braidlake_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def spread(df: DataFrame) -> DataFrame:
    """The same rows in at least as many partitions as there are cores: a small file is one task otherwise.

    For inputs whose rows grow into many; a large input has more partitions than that and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
