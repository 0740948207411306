"""Small DataFrame helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per value of ``key``: the least by ``order``, ties broken by the row's own hash.

    Rows with a null key can't be matched to one another; each distinct one is kept. The aggregate
    combines map-side, so a key that holds a third of all rows sends one row per task.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[df[c] for c in rest])
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.xxhash64(*[df[c] for c in rest])])])
    orphan = F.when(df[key].isNull(), F.xxhash64(*[df[c] for c in rest]))
    kept = df.groupBy(df[key].alias("__k"), orphan.alias("__n")).agg(F.min_by(row, by).alias("__r"))
    return kept.select(*[F.col("__k").alias(c) if c == key else F.col(f"__r.{c}").alias(c) for c in df.columns])


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the notes: the join is a sort-merge join, whatever sizes are estimated.

    Estimates come from compressed files, also through a checkpoint, and may be a thousandth of the rows'
    size; by them such a side would be collected in the driver and broadcast.
    """
    return df.hint("merge")


def spread(df: DataFrame, rounds: int | None = None) -> DataFrame:
    """A scan over fewer partitions than there are cores, dealt out to all of them; any other as it is.

    For frames without a shuffle, before a stage that is bound by Python's CPU time. With ``rounds`` each core
    gets so many partitions, if the scan has fewer: files are split by bytes, and rows may be few bytes in them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    least, parts = (cores // 2, cores) if rounds is None else (rounds * cores, rounds * cores)
    return df.repartition(parts) if df.rdd.getNumPartitions() < least else df
