"""Reading the driver's tables, deliveries counted once, size-checked broadcast, even partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a table may be broadcast; larger ones are joined by shuffle.
BROADCAST_LIMIT = 32 << 20
#: Estimated input bytes of a task of spread(); an input whose size no source states is estimated as endless.
TASK_BYTES, UNKNOWN_BYTES = 8 << 20, 1 << 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a DataFrame, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """df with a broadcast hint if its estimated size is within the limit, else df as it is."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def spread(df: DataFrame, *keys: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """A scan in even partitions by the keys' hash: as many as the session can run four times over, more once the
    estimated input exceeds `task_bytes` a partition. For work that costs far more than moving its rows.

    An input whose files alone make more tasks than that stays as it is: there is nothing to even out, and a shuffle of the whole
    texts would cost more than it saves."""
    size, spark = plan_bytes(df), df.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    known = size < UNKNOWN_BYTES
    if known and size // _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")) >= 4 * tasks:
        return df
    return df.repartition(max(tasks, size // task_bytes if known else 0), *keys)


def rebalance(df: DataFrame, *keys: str) -> DataFrame:
    """df, behind joins whose size no estimate tells, in even partitions by the keys' hash: as many as the session can run four times
    over, or its shuffle partitions if these are more."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def _bytes(size: str) -> int:
    """Bytes of a setting like 134217728, 134217728b, 128m or 1g."""
    digits = size.lower().rstrip("bkmgt")
    return int(digits) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(size.lower().rstrip("b")[-1:], 0)


def once(df: DataFrame, stamp: str = "written_at") -> DataFrame:
    """Rows delivered more than once (equal but for `stamp`) count once; the stamp column goes.

    A missing stamp column is no error. Empty in, empty out. Nulls compare as equal."""
    return df.drop(stamp).distinct()
