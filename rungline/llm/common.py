"""Small helpers the operators share: inputs, written tables, ranks without a hot window."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def text_batches(spark: SparkSession, rows: int = 256) -> None:
    """Fewer rows per Arrow batch: texts may be long, and a batch is held in memory as a whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of its own only in a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut, a lost executor costs no rerun,
    and later readers take only the columns they need."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` gave, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank", blocks: int = 1024) -> DataFrame:
    """Numbers the rows of each key from 0, in an order that is the same in every run.

    A key may hold any share of the rows: rows are numbered within (key, block), a block being a hash of
    the ordering values; the rows of earlier blocks are added from a table of block sizes.
    Rows equal in all ordering values are exchangeable.
    """
    block, first, near = "__block", "__first", [F.col(k) for k in keys]
    df = df.withColumn(block, F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = df.groupBy(*near, block).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*near).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(block).alias("__b"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(first))
    local = df.withColumn(name, F.row_number().over(Window.partitionBy(*near, block).orderBy(*order)) - 1)
    met = local[block] == starts["__b"]
    for i, k in enumerate(keys):
        met = met & local[k].eqNullSafe(starts[f"__k{i}"])
    return (local.join(starts, met, "inner")
            .withColumn(name, (F.col(name) + F.col(first)).cast("long"))
            .drop(block, first, "__b", *[f"__k{i}" for i in range(len(keys))]))
