"""Structured Streaming: incremental intake, windows with watermarks, deduplication, merges by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.sources.io import scratch


def read_files(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed(stream: DataFrame, time: str, width: str, slide: str | None, late: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per event-time window; rows later than the watermark are dropped."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(*aggs)


def sessions(stream: DataFrame, time: str, gap: str, late: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per session of each key."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(*aggs)


def deduplicated(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """All data present now, processed and written exactly once to a new shared folder; the result read back."""
    out = scratch(spark)
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def merge_batches(stream: DataFrame, spark: SparkSession, keys: list[str], order: list[str], parts: int = 16) -> DataFrame:
    """The latest row per key (greatest ``order``), kept as one folder per hash part and version: a batch rewrites only the parts it touches.

    The current version of a part is its highest batch number not above the last one of the stream's log, read from the folders, so a restarted driver
    goes on where the log says. A batch that runs again after a failure overwrites its own versions only, so rows count once.
    """
    out = scratch(spark)
    shape = stream.schema

    def versions(jvm_spark: SparkSession, below: int) -> dict[int, str]:
        """The newest folder of each part among batches before ``below``."""
        path = jvm_spark._jvm.org.apache.hadoop.fs.Path(f"{out}/data")
        fs = path.getFileSystem(jvm_spark._jsc.hadoopConfiguration())
        best: dict[int, tuple[int, str]] = {}
        if fs.exists(path):
            for batch in fs.listStatus(path):
                number = int(batch.getPath().getName()[1:])
                if number < below:
                    for part in fs.listStatus(batch.getPath()):
                        name = part.getPath().getName()
                        if name.startswith("part="):
                            p = int(name[5:])
                            if p not in best or best[p][0] < number:
                                best[p] = (number, part.getPath().toString())
        return {p: folder for p, (_, folder) in best.items()}

    def merge(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        new = batch.withColumn("part", part)
        touched = {r.part for r in new.select("part").distinct().collect()}  # at most ``parts`` numbers
        old = [folder for p, folder in versions(s, batch_id).items() if p in touched]
        both = new.unionByName(s.read.schema(shape).parquet(*old).withColumn("part", part)) if old else new
        rest = [c for c in both.columns if c not in (*keys, "part")]
        latest = both.groupBy("part", *keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("b")) if rest else both.select("part", *keys).distinct()
        latest.select("part", *keys, *[F.col(f"b.{c}").alias(c) for c in rest]).write.mode("overwrite").partitionBy("part").parquet(f"{out}/data/b{batch_id}")

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    folders = list(versions(spark, 1 << 62).values())
    return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)


def new_only(batch: DataFrame, snapshot: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Rows whose content was not seen before, however often they are delivered again."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in content]), 256)
    b = batch.withColumn("__d", digest).dropDuplicates([key, "__d"])
    return b.join(snapshot.withColumn("__d", digest).select(key, "__d"), [key, "__d"], "left_anti").drop("__d")
