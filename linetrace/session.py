"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linetrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a temporary folder; a cluster
    must name a folder all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="linetrace-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder, with the writer's ``options``, and read it back.

    Unlike ``DataFrame.checkpoint`` the new plan starts from files alone: loops do
    not pile up plan constraints, and joins see the real size of the table.
    """
    path = f"{scratch_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Filter on a costly computed column that must not be computed twice.

    A plain filter is pushed below the projection, which repeats the computation.
    It stays above one that numbers its rows.
    """
    numbered = df.withColumn("row_id", F.monotonically_increasing_id())
    return numbered.where(predicate & (F.col("row_id") >= 0)).drop("row_id")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle into all configured partitions, also when the bytes are few.

    For steps whose work per row is large; adaptive execution would merge them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def numbered(df: DataFrame, name: str, *order: str, start: int = 0) -> DataFrame:
    """Add the place of every row in the order of the columns, without gaps.

    Range parts are numbered each for itself; prefix sums of their counts, one row a
    part, give where each begins. Rows that are equal in the order get any of their places.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(df.repartitionByRange(parts, *order).withColumn("part_of_order", F.spark_partition_id()))
    sizes = ranged.groupBy("part_of_order").count()
    before = Window.orderBy("part_of_order").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("part_of_order", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin_of_part"))
    inside = F.row_number().over(Window.partitionBy("part_of_order").orderBy(*order))
    placed = ranged.withColumn("inside_part", inside).join(begins, "part_of_order")
    number = (F.col("begin_of_part") + F.col("inside_part") - 1 + start).cast("bigint")
    return placed.withColumn(name, number).drop("part_of_order", "inside_part", "begin_of_part")


def first_of_groups(df: DataFrame, group: list[str], order: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of every group; range parts number them, so no task sorts a whole group."""
    ranked = checkpointed(numbered(df, "place_of_all", *group, *order))
    begins = ranked.groupBy(*group).agg(F.min("place_of_all").alias("place_of_first"))
    inside = F.col("place_of_all") < F.col("place_of_first") + count
    return ranked.join(begins, group).where(inside).drop("place_of_all", "place_of_first")
