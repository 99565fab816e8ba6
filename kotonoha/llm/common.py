"""Small helpers that several operators share."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all machines share. Only a local master does without: a temporary one."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if place is None and context._jsc.sc().getCheckpointDir().isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="kotonoha-")
        context.setCheckpointDir(place)
    elif place is None:
        place = context._jsc.sc().getCheckpointDir().get()
    elif context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(place)
    return place


def job_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{shared_dir(spark)}/kotonoha-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application. Results that were not written elsewhere can no longer be read."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(job_dir(spark))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def tidy(spark: SparkSession) -> None:
    """Collects garbage on the driver: Spark's cleaner then drops the shuffles and broadcasts of what is settled by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder, compressed, and reads them back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{job_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, key: str) -> DataFrame:
    """Like ``settle``, bucketed by ``key``: later joins on it need not move these rows again.

    ``df`` should come out of a join or repartition by ``key``, so that each task has few buckets to write.
    """
    spark = df.sparkSession
    name = f"kotonoha_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.write.option("compression", "zstd").option("path", f"{job_dir(spark)}/{name}")
        .bucketBy(parts, key).format("parquet").saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # of an external table only the name goes
    return table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample_of(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows with the lowest hashes of ``key``: the same rows at every run and partitioning."""
    return df.orderBy(F.xxhash64(F.lit(17), F.col(key)), F.col(key)).limit(most)


def arrays(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``pos``, the row's place from 0 in the order of the columns, without one task seeing all rows.

    Rows are dealt by ranges of the whole order, so one hot value of the first column is spread as well; counts of the
    sorted parts (one number each) give the parts' offsets. Rows equal in all of ``order`` are placed arbitrarily.
    """
    spark = df.sparkSession
    parts = settle(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    bits = F.shiftright("_id", 33)
    sizes = parts.groupBy(bits.alias("_part")).agg(F.count("*").alias("_n")).collect()
    done, rows = 0, []
    for part, n in sorted((r["_part"], r["_n"]) for r in sizes):
        rows.append((part, done))
        done += n
    starts = spark.createDataFrame(rows, "_part long, _from long")
    return (
        parts.withColumn("_part", bits)
        .join(F.broadcast(starts), "_part")
        .withColumn("pos", F.col("_from") + F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_from", "_id")
    )
