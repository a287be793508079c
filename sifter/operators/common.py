"""Small plan helpers shared by operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Bytes of a broadcast side at most, by its columns' values.
BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only after measuring it: at most ``max_rows`` rows and ``max_bytes`` of
    values; otherwise it is returned as is and Spark shuffles both sides."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(0) for c, kind in df.dtypes),
               F.lit(16 * len(df.columns)))
    rows, used = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    if rows <= max_rows and (used or 0) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def by_key(df: DataFrame, key: str, *cols: str, num_partitions: int | None = None) -> DataFrame:
    """``df[key, *cols]`` hash-partitioned by ``key`` into ``num_partitions`` (default:
    ``spark.sql.shuffle.partitions``, to be set for the size of the corpus; nothing runs
    to find it out).

    Used once at the start of a corpus plan: the one exchange is reused by every
    branch that reads the corpus (the plan holds the same subtree), it spreads the
    per-row text work evenly over all tasks whatever the input file layout, and
    every later per-document aggregate (``groupBy(key, ...)``, joins on ``key``)
    finds its input already clustered and adds no shuffle.

    Applied again to the preprocessed corpus, it lets two branches (term counts and
    MinHash signatures) share one preprocessing pass: shuffling the compact processed
    text once is far cheaper than repeating the regex work per branch.

    Rows with a NULL key are dropped here (no join can match them). Stating the
    filter below the exchange also keeps the subtree identical in every branch:
    otherwise each join infers its own ``isnotnull(key)`` and pushes it under the
    repartition, the branches differ, and the exchange is not reused."""
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.where(F.col(key).isNotNull()).select(key, *cols).repartition(num_partitions, key)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small driving table that several later jobs read (e.g. a
    pair list derived from a ranking): a reliable checkpoint into the session's
    ``spark.checkpoint.dir`` (a shared folder on a cluster), so each later job reads
    the stored rows instead of recomputing the ranking, and a lost executor does
    not force the ranking to be redone."""
    from sifter.session import shared_dir

    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share."""
    from sifter.session import shared_dir

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: later jobs start
    from the files, also after executors are lost. The shuffle files of the writing job
    are removed when it ends."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... in the given order. Rows are range-partitioned and sorted, frozen
    by a checkpoint, and offset by the rows of earlier partitions (one row each)."""
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    parts = rows.groupBy("_pid").agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    parts = parts.withColumn("_off", F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
    return (rows.join(parts.drop("_n"), "_pid").withColumn(name, F.col("_off") + F.col("_mid") - F.col("_m0"))
            .drop("_pid", "_mid", "_m0", "_off"))
