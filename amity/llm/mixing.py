"""Sources mixed to target weights by balanced sampling with the cube method.

Each document of a source gets the same expected number of repetitions, the
source's target over its size. The whole part is taken as it is; the fraction
is an inclusion probability. The flight of the cube method moves these
probabilities through the null space of the constraints, which keeps the words
and the documents of the source where they were expected until all but two are
0 or 1. It runs in blocks of bounded size; what the blocks leave open flies on
in blocks of blocks, and only the last two documents of a source are landed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK = 1000
SEED = 7

# So many documents of a source wait for its landing, where all their choices
# are compared.
LANDED = 10


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of each text, 0 for null."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("bigint").alias("size"))


def source_targets(rows: DataFrame) -> DataFrame:
    """(source, n_docs, source_size, target), written to the shared folder.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. They share
    the sum of all sizes by weight; no target is above MAX_REPEATS times the
    size of its source, and what that leaves over is shared again by weight.
    """
    totals = rows.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("size").alias("source_size")
    )
    # The rank is found part by part, so that no task sorts all sources.
    parts = written(
        totals.orderBy(F.col("source").asc_nulls_last()).select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"),
        ),
        "sources",
    )
    before, starts = 0, {}
    for part, n in sorted(parts.groupBy("part").count().collect()):  # one row per partition
        starts[part], before = before, before + n
    start = F.lit(0)
    for part, n in starts.items():
        start = F.when(F.col("part") == part, n).otherwise(start)
    rank = (F.col("at") + start) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank + 1).cast("int"))
    ranked = parts.select("source", "n_docs", "source_size", weight.alias("weight"))

    cap = MAX_REPEATS * F.col("source_size")
    total, level, full = None, None, -1
    while True:
        capped = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.sum("source_size"),
            F.sum(F.when(capped, cap)),
            F.sum(F.when(~capped, F.col("weight"))),
            F.count_if(capped),
        ).first()
        total = row[0] or 0
        if row[3] == full or not row[2]:
            break
        full, level = row[3], (total - (row[1] or 0)) / row[2]
    target = F.least(cap.cast("double"), F.lit(float(level or 0)) * F.col("weight"))
    return ranked.select("source", "n_docs", "source_size", target.alias("target"))


def mixed(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, repeats, taken) for each row of `docs`.

    Null texts have no words and are never more than nothing; the null source
    is a source. Rows with equal ids are separate documents. The same rows give
    the same mix. Columns beside doc_id, text and source are ignored.
    """
    rows = written(sized(docs), "sizes")
    sources = source_targets(rows)
    largest = sources.agg(F.max("n_docs")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    blocks = F.ceil(F.col("n_docs") / block)
    same = sources.select(F.col("source").alias("of"), "n_docs", "source_size", "target")
    # Hashed anew on both sides, adaptive execution can split a large source.
    units = (
        rows.join(same, F.hash(rows["source"], F.lit(1)).eqNullSafe(F.hash("of", F.lit(1))) & rows["source"].eqNullSafe(F.col("of")))
        .select(
            "doc_id",
            rows["source"],
            "size",
            "source_size",
            "target",
            whole.alias("whole"),
            (ratio - whole).alias("x"),
            blocks.alias("blocks"),
            F.xxhash64("doc_id", "size", F.lit(seed)).alias("place"),
        )
    )
    decided: list[DataFrame] = []
    while True:
        at = F.pmod(F.xxhash64("place", F.lit(len(decided))), F.col("blocks"))
        flown = written(
            units.withColumn("block", at).groupBy("source", "block").applyInPandas(
                _fly, units.schema.simpleString()[7:-1]
            ),
            "mix",
        )
        if largest <= block:
            decided.append(flown)
            break
        decided.append(flown.where("x = 0 OR x = 1"))
        largest = 2 * -(-largest // block)  # at most two of each block are open
        units = flown.where("x > 0 AND x < 1").withColumn("blocks", F.ceil(2 * F.col("blocks") / block))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    repeats = (F.col("whole") + F.col("x")).cast("bigint")
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (repeats * F.col("size")).alias("taken"),
    )


def _fly(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "doc_id", "size"], kind="stable")
    random = np.random.default_rng(abs(int(rows["place"].iloc[0])))
    x, size = rows["x"].to_numpy().copy(), rows["size"].to_numpy()
    last = rows["blocks"].iloc[0] <= 1
    flying = len(x) - LANDED if last else len(x)
    x[: max(0, flying)] = fly(x[: max(0, flying)], size[: max(0, flying)], random)
    if last:
        x = land(x, size)
    return rows.assign(x=x).drop(columns="block")


def fly(x: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Moves `x` to 0 or 1 but for two at most; sum(x) and sum(x * size) stay."""
    rest = iter(np.flatnonzero((x > 0) & (x < 1)).tolist())
    taken = x.tolist()
    sizes = size.tolist()
    draws = iter(random.random(len(taken) + 1).tolist())
    active: list[int] = []
    while True:
        while len(active) < 3 and (unit := next(rest, None)) is not None:
            active.append(unit)
        step = _direction([sizes[i] for i in active])
        if step is None:
            break
        up = min((1 - taken[i]) / u if u > 0 else -taken[i] / u for i, u in zip(active, step) if u)
        down = min(taken[i] / u if u > 0 else (taken[i] - 1) / u for i, u in zip(active, step) if u)
        length = up if next(draws) * (up + down) < down else -down
        for i, u in zip(active, step):
            moved = taken[i] + length * u
            taken[i] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        active = [i for i in active if 0 < taken[i] < 1]
    return np.array(taken)


def _direction(sizes: list[int]) -> list[float] | None:
    """A vector that changes neither the count nor the words of the units."""
    if len(sizes) == 3:
        a, b, c = sizes
        if a == b == c:
            return [1.0, -1.0, 0.0]
        scale = max(abs(a - b), abs(b - c), abs(c - a))
        return [(b - c) / scale, (c - a) / scale, (a - b) / scale]
    if len(sizes) == 2 and sizes[0] == sizes[1]:
        return [1.0, -1.0]
    return None


def land(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decides the open documents so that words and documents are off by little.

    There are LANDED + 2 at most. An empty document more or less is worth less
    than a word.
    """
    open_ = np.flatnonzero((x > 0) & (x < 1))
    choices = ((np.arange(2 ** len(open_))[:, None] >> np.arange(len(open_))) & 1).astype(float)
    off = choices - x[open_]
    cost = np.abs(off @ size[open_].astype(float)) + 0.5 * np.abs(off.sum(axis=1))
    x[open_] = choices[np.argmin(cost)]
    return x
