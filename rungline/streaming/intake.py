"""Incremental reading: only documents that were not read before.

A document is skipped if its URL or its content is known. What is known is keyed state of the stream: a micro-batch looks up its own URLs and hashes in
the state store, which is written with the stream's progress and recovered with it, whatever has been read before. Only if the
progress is lost does a new generation of it begin; that one skips, besides, what the manifests of earlier generations list.
"""
from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import only_new
from ..operators.extract import extract_increases

SCHEMA = "url string, text string, validity_from date, validity_to date"
MANIFEST = "url string, sha256 string, generation string, batch bigint"


def _read(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def _generation(spark: SparkSession, progress: str) -> str:
    """The name of the progress that stands in a folder; a new one where there is none."""
    told = _read(spark, f"{progress}/generation", "value string", "text")
    if told is not None:
        return told.first().value
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").write.mode("overwrite").text(f"{progress}/generation")
    return name


def _earlier(spark: SparkSession, manifest: str, generation: str) -> DataFrame | None:
    """What earlier generations have read, if there are any."""
    listed = _read(spark, manifest, MANIFEST, "parquet")
    if listed is None:
        return None
    others = listed.where(~F.col("generation").eqNullSafe(generation))
    return None if others.isEmpty() else others


def read_new_documents(spark: SparkSession, source: str, target: str, name: str = "intake") -> StreamingQuery:
    """Extract increases from the Parquet documents that appear under ``source``.

    Of documents that arrive together with one URL or one content any one is read. Documents without a URL are known by their content alone. Each
    micro-batch writes its own folder, so repeating a batch after a failure replaces its output instead of doubling it. The stream's progress and state
    stand beside its output; if they are lost, all documents come again, and what the manifest has is not read twice.
    """
    manifest, increases, progress = f"{target}/manifest", f"{target}/increases", f"{target}/progress-{name}"
    generation = _generation(spark, progress)
    earlier = _earlier(spark, manifest, generation)

    def write(batch: DataFrame, number: int) -> None:
        fresh = (batch if earlier is None else only_new(batch, earlier)).persist()
        extract_increases(fresh, ["url"]).write.mode("overwrite").parquet(f"{increases}/generation={generation}/batch={number}")
        fresh.select("url", "sha256").write.mode("overwrite").parquet(f"{manifest}/generation={generation}/batch={number}")
        fresh.unpersist()

    hashed = spark.readStream.schema(SCHEMA).parquet(source).withColumn("sha256", F.sha2("text", 256))
    named = hashed.withColumn("_name", F.coalesce(F.nullif("url", F.lit("")), F.col("sha256")))
    return (
        named.dropDuplicates(["_name"]).dropDuplicates(["sha256"]).drop("_name").writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
