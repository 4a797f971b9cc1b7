"""Structured Streaming over append-only tables: windows, first-seen ids, idempotent upserts, sessions.

Every query reads a folder as a stream and runs with the ``availableNow`` trigger, so it
takes what is there and ends; state is bounded by watermarks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.plans.storage import scratch_root


def event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 8) -> DataFrame:
    """The events table as a stream with a proper timestamp."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder, glob = (path, "*.parquet") if _is_folder(spark, path) else (sf_dir, "events.parquet")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", glob).parquet(folder)
    return rows.withColumn("ts", F.to_timestamp(F.col("ts").cast("string")))


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into a table of the shared scratch folder and read it."""
    spark = stream.sparkSession
    root = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    else:

        def keep(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{root}/out")

        q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(schema).parquet(f"{root}/out")


def upsert_batches(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Latest row of each key, kept by merging every micro-batch into the table written before; a batch that is run again changes nothing."""
    spark = stream.sparkSession
    root = f"{scratch_root(spark)}/upsert-{uuid.uuid4().hex}"
    state = {"at": None}
    schema = stream.schema

    def merge(batch: DataFrame, epoch: int) -> None:
        both = batch if state["at"] is None else batch.unionByName(spark.read.schema(schema).parquet(state["at"]))
        latest = both.groupBy(key).agg(F.max_by(F.struct(*[c for c in both.columns if c != key]), F.struct(order, F.xxhash64(*both.columns))).alias("r")).select(key, "r.*").select(*both.columns)
        latest.write.mode("overwrite").parquet(f"{root}/v{epoch}")
        state["at"] = f"{root}/v{epoch}"

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(state["at"]) if state["at"] else spark.createDataFrame([], schema)
