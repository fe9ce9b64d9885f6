"""Session construction and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (the logs are zone-less
# TIMESTAMP_NTZ), AQE for runtime coalescing and skew splitting, no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, app: str = "yieldspark",
          extra: dict | None = None) -> SparkSession:
    """A session with the settings above; master and shuffle partitions are the cluster's unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``.

    Where it is unset a scratch folder is made, but only for a master whose
    executors live in this process (tests); anywhere else that is an error,
    since executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="yieldspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)


class Cuts:
    """Lineage cuts of one job run: Parquet tables under the shared checkpoint folder, deleted when the run ends.

    One job computes and writes a cut (a reliable RDD checkpoint would compute
    it twice unless cached); later stages read the columnar files, so a lost
    executor re-reads them instead of recomputing from the raw log.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, name: str = "cut") -> DataFrame:
        path = scratch_table_path(self.spark, f"{name}-{uuid.uuid4().hex}")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Cuts:
        return self

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            p = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            p.getFileSystem(conf).delete(p, True)
