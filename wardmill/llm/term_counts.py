"""Occurrences and record counts of every distinct token, over all records.

1. Blocks: each batch of records is dictionary-encoded on its own, and two count arrays (occurrences,
   records that hold the token) are accumulated over the block's codes. A token that stands in a third of
   all records leaves a block as one entry. The blocks are checkpointed in the shared folder: both steps
   below read them, and the records are read once.
2. Global integer dictionary: the distinct tokens of all blocks, sorted over the whole collection; a
   token's identifier is its place in that order (its partition's offset and its rank within).
3. Encoded: each block entry gets its token's identifier and drops the token. Pairs of numbers are dealt
   out by identifier range, where the block arrays are added into one array per range; the dictionary
   gives the tokens back.

Defined cases: tokens are compared in lower case without outer white space; null and empty tokens and
null or empty arrays count nothing; rows that share a record id are one record; an empty table gives no
rows. A token can be both too rare and too common in a tiny collection; it then has both marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.frames import first_per_key
from wardmill.session import checkpoint

_SPACE = " \t\n\r\f\v 　"
#: Identifiers of one range: its two count arrays are held in memory while they are summed.
RANGE = 1 << 16


def _records(df: DataFrame, key: str, tokens: str) -> DataFrame:
    clean = F.filter(F.transform(tokens, lambda t: F.lower(F.btrim(t, F.lit(_SPACE)))), lambda t: t.isNotNull() & (t != ""))
    one = df.select(F.col(key).alias("__id"), F.coalesce(clean, F.array().cast("array<string>")).alias("__tokens"))
    return first_per_key(one, "__id", [])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """token, occurrences, records of each batch; a first entry without a token counts the records that hold any."""
    for b in batches:
        column = b.column(0)
        codes = column.flatten().dictionary_encode()
        if not len(codes):
            continue
        size = len(codes.dictionary)
        code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        record = np.repeat(np.arange(len(column)), lengths)
        occurrences = np.bincount(code, minlength=size)
        presence = np.bincount(np.unique(record * size + code) % size, minlength=size)
        tokens = pa.concat_arrays([pa.array([None], pa.string()), codes.dictionary.cast(pa.string())])
        yield pa.RecordBatch.from_arrays([tokens, pa.array(np.concatenate([[0], occurrences]), pa.int64()), pa.array(np.concatenate([[np.count_nonzero(lengths)], presence]), pa.int64())], names=["token", "occurrences", "records"])


def blocks(df: DataFrame, key: str = "term_id", tokens: str = "tokens") -> DataFrame:
    return checkpoint(_records(df, key, tokens).select("__tokens").mapInArrow(_blocks, "token string, occurrences long, records long"))


def dictionary(counted: DataFrame) -> DataFrame:
    """token_id, token: the distinct tokens of the blocks, numbered without gaps in their order."""
    ordered = checkpoint(counted.filter("token IS NOT NULL").select("token").distinct().sort("token").select("token", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("rank")))
    # a row per partition of the sort, with the tokens in all partitions before it
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")).collect()
    before, offsets = 0, []
    for r in sorted(sizes, key=lambda r: r.part):
        offsets.append((r.part, before - r.first))
        before += r.n
    shift = ordered.sparkSession.createDataFrame(offsets or [(0, 0)], "part int, shift long")
    return ordered.join(F.broadcast(shift), "part").select((F.col("rank") + F.col("shift")).alias("token_id"), "token")


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of identifier ranges; the batches come sorted by range."""
    at, sums = -1, np.zeros((2, RANGE), np.int64)

    def done() -> pa.RecordBatch:
        ids = np.flatnonzero(sums[0])
        return pa.RecordBatch.from_arrays([pa.array(ids + at * RANGE, pa.int64()), pa.array(sums[0][ids], pa.int64()), pa.array(sums[1][ids], pa.int64())], names=["token_id", "occurrences", "records"])

    for b in batches:
        ids, occurrences, records = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        ranges = ids // RANGE
        for r in np.unique(ranges).tolist():
            if r != at:
                if at >= 0:
                    yield done()
                    sums[:] = 0
                at = r
            mine = ranges == r
            np.add.at(sums[0], ids[mine] - r * RANGE, occurrences[mine])
            np.add.at(sums[1], ids[mine] - r * RANGE, records[mine])
    if at >= 0:
        yield done()


def counted_ids(counted: DataFrame, words: DataFrame) -> DataFrame:
    """token_id, occurrences, records: the block entries encoded, and their arrays summed by identifier range."""
    encoded = counted.filter("token IS NOT NULL").join(words, "token").select(F.floor(F.col("token_id") / RANGE).cast("long").alias("range"), "token_id", "occurrences", "records")
    dealt = encoded.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(_sum_ranges, "token_id long, occurrences long, records long")


def _counts(counted: DataFrame) -> DataFrame:
    words = dictionary(counted)
    return counted_ids(counted, words).join(words, "token_id").select("token_id", "token", "occurrences", "records")


def term_counts(df: DataFrame, key: str = "term_id", tokens: str = "tokens") -> DataFrame:
    """token_id, token, occurrences, records: one row per distinct token."""
    return _counts(blocks(df, key, tokens))


def marked(df: DataFrame, key: str = "term_id", tokens: str = "tokens", rare: int = 2, common_percent: int = 2) -> DataFrame:
    """term_counts with n_records (records that hold a counted token) and the two marks as booleans."""
    counted = blocks(df, key, tokens)
    total = F.coalesce(counted.filter("token IS NULL").agg(F.sum("records")).scalar(), F.lit(0))
    return _counts(counted).withColumn("n_records", total).withColumns({"too_rare": F.col("records") <= rare, "too_common": F.col("records") * 100 > F.col("n_records") * common_percent})


def found(df: DataFrame) -> DataFrame:
    """token, mark: tokens in at most 2 records, or in more than 2 % of those that hold a counted token."""
    marks = F.filter(F.array(F.when(F.col("too_rare"), "too_rare"), F.when(F.col("too_common"), "too_common")), lambda m: m.isNotNull())
    return marked(df).select("token", F.explode(marks).alias("mark"))
