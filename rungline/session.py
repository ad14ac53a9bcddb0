"""Session settings the library expects.

Nothing here is needed on a cluster that already sets these; ``build`` exists
for local runs and tests, ``shared_folder`` for jobs that cut lineage.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "rungline", master: str | None = None, partitions: int | None = None,
          extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # text rules are heavy on little data: keep small shuffles on several cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where none is named and Spark runs in one local process (as in
    tests) is a folder made; on a cluster a missing setting is an error,
    because a machine-local folder is lost together with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="rungline-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs no rerun, and later readers take only the columns they need."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
