"""Written intermediate tables, bounded broadcasts and ordered positions.

Iterative operators must not drag a growing lineage along, and must survive the
loss of an executor.  ``keep`` therefore writes an intermediate table as parquet
to the shared folder named by ``spark.checkpoint.dir`` and reads it back: the
lineage ends at the files, and the optimizer knows the table's real size.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows a table may have at most to be broadcast by ``small``.
BROADCAST_ROWS = 100_000

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python functions of the operators are pickled by reference, so the workers must be able
    to import the package whatever their working directory is.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="topicloom-code-"), "topicloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the session's ``spark.checkpoint.dir`` says."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/") + "/topicloom"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="topicloom-")
    return _local_roots[app]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of the written files."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_all(**tables: DataFrame) -> list[DataFrame]:
    """``keep`` several independent tables at once, so that their jobs overlap."""
    spark = next(iter(tables.values())).sparkSession
    scratch_root(spark)
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [
            pool.submit(inheritable_thread_target(spark)(keep), table, name)
            for name, table in tables.items()
        ]
        return [job.result() for job in jobs]


def drop_kept(*tables: DataFrame | None) -> None:
    """Delete the files behind tables written by ``keep`` that nothing reads any more."""
    for table in tables:
        if table is None:
            continue
        spark = table.sparkSession
        root = scratch_root(spark)
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            if root.split(":", 1)[-1] in folder:
                path = hadoop.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table is counted to have at most ``limit`` rows.

    A larger table is returned without a hint and joins by shuffle.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, 1)


def global_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the total order ``order``.

    A range sort places the rows; each row then adds the number of rows in the
    earlier partitions.  Only one small count per partition is joined back, so
    no task sees the whole table (an unpartitioned window would).
    """
    placed = keep(
        df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()), "ordered"
    )
    # The upper bits of the id hold the partition, the lower 33 the position in it.
    part = F.shiftright("_pos", 33).alias("_part")
    counts = placed.groupBy(part).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", F.shiftright("_pos", 33))
        .join(F.broadcast(offsets), "_part")  # one row per sort partition
        .withColumn(name, F.col("_offset") + F.col("_pos").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_pos", "_offset")
    )


def range_placed(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """Range-partition by (key, order) and keep the result with its bucket in ``_b``.

    Buckets have even size whatever the keys are, so a hot key spreads over many.
    """
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = df.repartitionByRange(buckets, key, order)
    return keep(placed.withColumn("_b", F.spark_partition_id()), name)


def running_sum(placed: DataFrame, key: str, order: str, value: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order``, on ``range_placed`` rows.

    Sums run inside each (key, bucket); keys that span buckets get the totals of
    their earlier buckets added.  At most one key crosses each bucket border, so
    the carried table has no more rows than there are buckets.
    """
    rows = placed.withColumn("_v", value)
    local = Window.partitionBy("_b", key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(key, "_b")
        .agg(F.sum("_v").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(earlier))
        .where(F.col("_carry").isNotNull())
        .select(key, "_b", "_carry")
    )
    return (
        rows.withColumn(name, F.sum("_v").over(local))
        .join(F.broadcast(carried), [key, "_b"], "left")  # at most one row per bucket
        .withColumn(name, F.col(name) + F.coalesce("_carry", F.lit(0)))
        .drop("_v", "_carry")
    )
