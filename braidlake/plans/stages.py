"""Runs in named stages, each written before the next, that can be taken up again where they ended."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]


def done(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether a stage was written to its end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_DONE")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _mark(spark: SparkSession, folder: str, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_DONE")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True).close()


def run(spark: SparkSession, stages: Sequence[tuple[str, Stage]], inputs: dict[str, DataFrame], folder: str, start: str | None = None) -> dict[str, DataFrame]:
    """Run stages in order; each takes the tables so far and gives more.

    Tables are written as Parquet below folder/stage/table. A stage that was finished is read instead of run, up to
    ``start``: that stage and all after it are run again.
    """
    tables, fresh = dict(inputs), False
    for name, stage in stages:
        fresh = fresh or name == start or not done(spark, folder, name)
        if fresh:
            made = stage(spark, tables)
            for table, df in made.items():
                df.write.mode("overwrite").parquet(f"{folder}/{name}/{table}")
            names = spark.createDataFrame([(t,) for t in made] or [("",)], "name string")
            names.coalesce(1).write.mode("overwrite").text(f"{folder}/{name}/tables.txt")
            _mark(spark, folder, name)
        names = [r.value for r in spark.read.text(f"{folder}/{name}/tables.txt").collect() if r.value]
        tables |= {t: spark.read.parquet(f"{folder}/{name}/{t}") for t in names}
    return tables
