"""Streaming forms of the checkpoint log and, as an extension, of event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators import planning
from corpusflow.schemas import PAGE_STATE

BUCKETS = 64


def resume_stream(spark: SparkSession, folder: str, schema: str = PAGE_STATE, files_per_batch: int = 100) -> DataFrame:
    """State rows from the files of a folder, taken up where the last run left off."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """Per bucket its versions, rising; at most BUCKETS folders of a few versions each."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for b in fs.listStatus(root) if fs.exists(root) else ():
        if b.getPath().getName().startswith("bucket="):
            names = [v.getPath().getName() for v in fs.listStatus(b.getPath())]
            out[int(b.getPath().getName()[7:])] = sorted(int(n[8:]) for n in names if n.startswith("version="))
    return out


def read_latest(spark: SparkSession, path: str, schema, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The table that keep_latest has folded so far (before a batch, where one is given)."""
    held = {b: [v for v in vs if before is None or v < before] for b, vs in _versions(spark, path).items() if buckets is None or b in buckets}
    folders = [f"{path}/bucket={b}/version={vs[-1]}" for b, vs in held.items() if vs]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def keep_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], values: list[str], buckets: int = BUCKETS):
    """Fold a state stream into the latest row of each key.

    The table is in buckets of keys: a batch writes a new version of the buckets that it has keys of, and of these only the
    version before it stays. A batch that runs again writes its own version again, so a lost executor or driver repeats no change.
    """
    spark = stream.sparkSession
    columns = [*keys, *order, *values]

    def fold(batch: DataFrame, number: int) -> None:
        new = batch.select(*columns)
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")
        touched = [r["bucket"] for r in new.select(bucket).distinct().collect()]
        if not touched:
            return
        both = new.unionByName(read_latest(spark, path, new.schema, number, touched))
        folded = planning.latest_state(both, keys, order, values).select(*columns, bucket, F.lit(number).alias("version"))
        folded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(path)
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for b, vs in _versions(spark, path).items():
            for v in [v for v in vs if v < number][:-1] if b in touched else ():
                old = fs_path(f"{path}/bucket={b}/version={v}")
                old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts of events by kind and tumbling window; rows later than the watermark are left out. Works on streams and tables."""
    dated = events.withColumn("_time", F.col(time).cast("timestamp"))
    if dated.isStreaming:
        dated = dated.withWatermark("_time", late)
    counts = dated.groupBy(F.window("_time", width), kind).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), kind, "n")
