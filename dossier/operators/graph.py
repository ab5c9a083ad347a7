"""Steps of operators that go on in rounds, and connected components by label propagation with pointer jumping."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where none is set."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="dossier-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what follows starts from files that outlive any executor, without its plan."""
    return _written(df, f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}")


class Steps:
    """The tables of one run in rounds. They are deleted when it ends; what it returns is a table of its own (`result`).

    with Steps(spark) as steps: ... state = steps.keep(state) ... return steps.result(state)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/steps/{uuid.uuid4().hex}", 0

    def __enter__(self) -> Steps:
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        return _written(df, f"{self.folder}/{self.n}")

    def result(self, df: DataFrame) -> DataFrame:
        return cut(df)

    def __exit__(self, *_) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id each id on a pair can reach. Each round takes the least label of all neighbours, then that label's own."""
    with Steps(pairs.sparkSession) as steps:
        one = pairs.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x <> y")
        edges = steps.keep(one.union(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
        labels = steps.keep(edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("id"), F.least("x", "m").alias("component")))
        while True:
            near = edges.join(labels, edges["y"] == labels["id"]).groupBy("x").agg(F.min("component").alias("m"))
            spread = labels.join(near, labels["id"] == near["x"]).select("id", F.least("component", "m").alias("component"))
            own = spread.select(F.col("id").alias("component"), F.col("component").alias("up"))
            new = steps.keep(spread.join(own, "component", "left").select("id", F.coalesce("up", "component").alias("component")))
            changed = not new.join(labels.withColumnRenamed("component", "before"), "id").where("component <> before").isEmpty()
            labels = new
            if not changed:
                return steps.result(labels)
