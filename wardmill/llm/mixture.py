"""A mix of sources with given shares of the tokens.

A source gives ``share x total`` tokens as far as ``max_repeats`` copies of its records reach; what
short sources can't give is spread over the others in proportion to their shares. Within a source each
record gets the same expected number of copies: its whole part for sure, the fraction as an inclusion
probability. The cube method draws the sample: it moves the probabilities through the null space of the
constraints (tokens and records of the source) until few stay fractional in a block. The shortest records and a
ladder of longer ones, none longer than all below it together, are held back from the flight, so that
whatever it leaves can be evened out by some of them. The leftovers of up to ``FAN`` blocks are balanced together, those of up to
``FAN`` such groups again, and so on; the last few dozen of a source are landed on the corner whose tokens
are nearest to the total. A source is off its plan by less than its shortest records, at any size, as long
as these leave room.

A source of any size is spread over blocks of bounded size; only the leftovers of ``FAN`` blocks (some dozens of
records each) and one row per source meet in a task. Token counts and each step are checkpointed in the
shared folder, and the sums of the few sources are collected, so jobs run while the frames are built.

Defined cases: records of sources without a target share, and records without tokens, aren't drawn; a
source without records gives nothing; repeated record ids are drawn as separate records; null or
negative shares and repeats count as 0.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.frames import spread

from wardmill.llm import tokenizers as tk
from wardmill.session import checkpoint

#: Records of a source that are balanced in one task.
BLOCK_ROWS = 20_000
#: Records that the flight leaves to the landing: rungs of a ladder of lengths, and the shortest.
RUNGS, SHORT = 64, 40
RESERVE = RUNGS + SHORT
#: The landing counts tokens in units that keep its sums below this.
MOST_SUM = 2_000_000
#: Blocks whose leftovers are balanced together.
FAN = 1_000


def token_counts(documents: DataFrame, tokenizer: str = tk.DEFAULT, folder: str = tk.FOLDER) -> DataFrame:
    """doc_id, source, n_tokens of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tk.encoding(tokenizer, folder)
        for b in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int32())], names=["doc_id", "source", "n_tokens"])

    return spread(documents.select("doc_id", "source", "text")).mapInArrow(run, "doc_id long, source string, n_tokens int")


def allocate(have: dict[str, int], share: dict[str, float], repeats: dict[str, int], total: float) -> dict[str, float]:
    """Tokens to take from each source."""
    supply = {s: float(have.get(s, 0) * max(0, repeats[s])) for s in share}
    take, open_ = {s: 0.0 for s in share}, {s for s in share if share[s] > 0 and supply[s] > 0}
    left = float(total)
    while open_ and left > 1e-9:
        weight = sum(share[s] for s in open_)
        full = [s for s in open_ if share[s] / weight * left >= supply[s]]
        if not full:
            for s in open_:
                take[s] = share[s] / weight * left
            break
        for s in full:
            take[s] = supply[s]
            left -= supply[s]
            open_.discard(s)
    return take


def reserve(size: list[float], todo: list[int]) -> set[int]:
    """The units held back: the ``SHORT`` smallest, and up to ``RUNGS``, each no larger than all smaller ones held
    together, so that their sums leave no gap, until together they are as large as the largest unit."""
    order = sorted(todo, key=lambda i: (size[i], i))
    kept, rest = set(order[:SHORT]), order[SHORT:]
    sizes, cover = [size[i] for i in rest], sum(size[i] for i in order[:SHORT])
    largest = size[order[-1]] if order else 0.0
    while cover < largest and len(kept) < RESERVE and (k := bisect.bisect_right(sizes, cover) - 1) >= 0:
        kept.add(rest.pop(k))
        cover += sizes.pop(k)
    return kept


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities to 0 or 1 along null vectors of (x, 1) over three units at a time, keeping both totals."""
    p = p.tolist()
    size = (x / max(1.0, float(x.mean()))).tolist()
    todo = [i for i, v in enumerate(p) if 1e-9 < v < 1 - 1e-9]
    kept = reserve(size, todo)
    todo = sorted((i for i in todo if i not in kept), key=lambda i: int(4 * math.log2(size[i] + 1e-9)))  # the largest meet first
    held = [todo.pop() for _ in range(min(3, len(todo)))]
    draws = rng.random(len(todo) + 8).tolist()
    while len(held) == 3:
        i, j, k = held
        a, b, c = size[i], size[j], size[k]
        u = (c - b, a - c, b - a)
        if abs(u[0]) + abs(u[1]) + abs(u[2]) < 1e-12:
            u = (1.0, -1.0, 0.0)
        up = down = 1e18
        for unit, v in zip(held, u):
            if v > 0:
                up, down = min(up, (1 - p[unit]) / v), min(down, p[unit] / v)
            elif v < 0:
                up, down = min(up, p[unit] / -v), min(down, (1 - p[unit]) / -v)
        move = up if (draws.pop() if draws else rng.random()) * (up + down) < down else -down
        still = []
        for unit, v in zip(held, u):
            q = p[unit] + move * v
            if q < 1e-9:
                p[unit] = 0.0
            elif q > 1 - 1e-9:
                p[unit] = 1.0
            else:
                p[unit] = q
                still.append(unit)
        while len(still) < 3 and todo:
            still.append(todo.pop())
        held = still
    return np.array(p)


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The few probabilities that are left, to a corner whose tokens are nearest to the expected ones.

    All sums that some corner reaches are found as the bits of a number, unit by unit; on the way back a unit
    goes where its probability leans, if the sum can be reached so.
    """
    open_ = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9))
    p = p.copy()
    if len(open_):
        unit = max(1, -(-int(x[open_].sum()) // MOST_SUM))
        sizes = [max(1, round(v / unit)) for v in x[open_].tolist()]
        reached = [1]
        for v in sizes:
            reached.append(reached[-1] | reached[-1] << v)
        goal = round(float(p[open_] @ x[open_]) / unit)
        at = next(s for d in range(sum(sizes) + 1) for s in (goal - d, goal + d) if s >= 0 and reached[-1] >> s & 1)
        for k in range(len(sizes) - 1, -1, -1):
            out, in_ = bool(reached[k] >> at & 1), at >= sizes[k] and bool(reached[k] >> at - sizes[k] & 1)
            take = bool(in_ and (not out or p[open_[k]] > 0.5))
            p[open_[k]] = float(take)
            at -= sizes[k] if take else 0
    return p.round()


def _seed(*parts: object) -> np.random.Generator:
    return np.random.default_rng(list("|".join(map(str, parts)).encode()))


def mix(documents: DataFrame, weights: DataFrame, total_tokens: int | None = None, tokenizer: str = tk.DEFAULT, folder: str = tk.FOLDER) -> tuple[DataFrame, DataFrame]:
    """(drawn, shares). drawn: doc_id, source, n_tokens, copies (1 or more). shares: a row per source.

    ``weights`` is one row per source, a parameter table. ``total_tokens`` defaults to the tokens that
    the listed sources hold.
    """
    spark = documents.sparkSession
    rows = {r.source: r for r in weights.select("source", "target_share", "max_repeats").filter(F.col("source").isNotNull()).collect()}
    share = {s: max(0.0, r.target_share or 0.0) for s, r in rows.items()}
    repeats = {s: max(0, r.max_repeats or 0) for s, r in rows.items()}
    counts = checkpoint(token_counts(documents, tokenizer, folder).filter(F.col("source").isin(list(rows)) & (F.col("n_tokens") > 0)))
    sums = {r.source: r for r in counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).collect()}
    have = {s: r.tokens for s, r in sums.items()}
    take = allocate(have, share, repeats, total_tokens if total_tokens is not None else sum(have.values()))
    plan = [(s, take[s] / have[s], max(1, -(-sums[s].docs // BLOCK_ROWS))) for s in rows if have.get(s)]
    schema = "doc_id long, source string, n_tokens int, copies int, part double"
    if not plan:
        drawn = spark.createDataFrame([], schema).drop("part")
    else:
        rate = F.create_map(*[F.lit(v) for s, r, _ in plan for v in (s, float(r))])[F.col("source")]
        blocks = F.create_map(*[F.lit(v) for s, _, k in plan for v in (s, int(k))])[F.col("source")]
        units = counts.withColumns({"rate": rate, "block": F.pmod(F.xxhash64("doc_id", "n_tokens"), blocks)}).withColumns({"copies": F.floor("rate").cast("int"), "part": F.col("rate") - F.floor("rate")}).drop("rate")

        def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["doc_id", "n_tokens"], ignore_index=True)
            order = _seed(*key).permutation(len(pdf))
            pdf = pdf.iloc[order].reset_index(drop=True)
            pdf["part"] = flight(pdf["part"].to_numpy(), pdf["n_tokens"].to_numpy(float), _seed(*key, "flight"))
            return pdf.assign(block=key[1])[["doc_id", "source", "n_tokens", "copies", "part", "block"]]

        def finish(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["doc_id", "n_tokens"], ignore_index=True)
            x = pdf["n_tokens"].to_numpy(float)
            pdf["part"] = land(flight(pdf["part"].to_numpy(), x, _seed(*key, "landing")), x)
            return pdf[["doc_id", "source", "n_tokens", "copies", "part"]]

        kept = "doc_id long, source string, n_tokens int, copies int, part double, block long"
        whole = (F.col("part") < 1e-9) | (F.col("part") > 1 - 1e-9)
        flown = checkpoint(units.withColumn("block", F.col("block").cast("long")).groupBy("source", "block").applyInPandas(fly, kept))
        settled, open_, most = flown.filter(whole), flown.filter(~whole), max(k for _, _, k in plan)
        while most > max(FAN, 1):
            most = -(-most // max(FAN, 2))
            flown = checkpoint(open_.withColumn("block", F.floor(F.col("block") / max(FAN, 2))).groupBy("source", "block").applyInPandas(fly, kept))
            settled, open_ = settled.unionByName(flown.filter(whole)), flown.filter(~whole)
        rest = open_.groupBy("source").applyInPandas(finish, schema)
        drawn = settled.drop("block").unionByName(rest).select("doc_id", "source", "n_tokens", (F.col("copies") + F.round("part").cast("int")).alias("copies")).filter("copies > 0")
    got = drawn.groupBy("source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("mixed_records"), F.max("copies").alias("most_copies"))
    listed = spark.createDataFrame([(s, share[s], repeats[s], int(have.get(s, 0)), float(take[s])) for s in sorted(rows)], "source string, target_share double, max_repeats int, available_tokens long, planned_tokens double")
    joined = listed.join(got, "source", "left").fillna(0, ["mixed_tokens", "mixed_records", "most_copies"])
    total = got.agg(F.sum("mixed_tokens")).scalar()
    return drawn, joined.withColumn("actual_share", F.coalesce(F.col("mixed_tokens") / total, F.lit(0.0)))
