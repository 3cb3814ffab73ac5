"""Natural-key dedupe while streaming (T-S6).

The keys that a stream has written are kept as two 64-bit hashes each, in a table
partitioned by the month of the event (the date is part of every natural key, so copies
share it).  A batch reads the partitions of its own months only and keeps the rows whose key
is not among them; of copies inside the batch the row numbered first stays.  Because ids are
issued by arrival, this is what the dedupe of the whole output would keep.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import ID_PARTS, dedupe_natural_key
from ..schema import natural_key
from ..session import materialize
from ..sources.batches import path_exists

KEYS = "_k1 long, _k2 long, m int, s int, batch long"


def key_columns(table: str) -> dict[str, Column]:
    """The hashes of a row's natural key, nulls told apart, and its month."""
    parts = [c for n in natural_key(table) for c in (F.col(n), F.col(n).isNull())]
    day = F.col(ID_PARTS[table][0]).cast("date")
    month = F.coalesce(F.year(day) * 12 + F.month(day), F.lit(0)).cast("int")
    return {"_k1": F.xxhash64(*parts), "_k2": F.xxhash64(F.lit(1), *parts), "m": month}


def unseen(spark: SparkSession, rows: DataFrame, table: str, keys_dir: str, stream_no: int, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key no earlier batch has written, the written table they are read from)."""
    own = materialize(dedupe_natural_key(rows, table).withColumns(key_columns(table)))
    months = [r.m for r in own.select("m").distinct().collect()]  # calendar months of a micro-batch
    paths = [p for m in sorted(months) if path_exists(spark, p := f"{keys_dir}/m={m}")]
    fresh = own
    if paths:
        seen = spark.read.schema(KEYS).option("basePath", keys_dir).parquet(*paths)
        earlier = (F.col("s") < stream_no) | ((F.col("s") == stream_no) & (F.col("batch") < batch_id))
        fresh = own.join(seen.where(earlier).select("_k1", "_k2"), ["_k1", "_k2"], "left_anti")
    return fresh.drop("_k1", "_k2", "m"), own


def remember(written: DataFrame, table: str, keys_dir: str, stream_no: int, batch_id: int) -> None:
    """Add the keys of a batch's written rows; done again for the same batch, it replaces them."""
    keys = written.withColumns(key_columns(table)).select("_k1", "_k2", "m", F.lit(stream_no).alias("s"), F.lit(batch_id).cast("long").alias("batch"))
    keys.repartition("m").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("m", "s", "batch").parquet(keys_dir)
