"""Vectors as short codes: the nearest codebook entry of each part.

Components are integers, so a dimension has few distinct values. Vectors are
kept in blocks with a dictionary of values for each dimension. For a codebook
the squared differences of all values in a dictionary to all entries are
tabulated once a block; the distances of its parts are gathers from these
tables by dictionary code, added up over the dimensions of a part.

Codebooks follow Lloyd's rounds in whole numbers: every task sums up its parts
by entry, the sums are added by Spark, and the codebooks, whose size does not
depend on the data, are made anew from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

# Components this large or larger have no code: their squares would not fit.
LARGEST = float(1 << 18)

BLOCK = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): rows of finite vectors, components as floor(256 * x).

    Rows whose vector is null or has null or non-finite components are left out.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    x = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("bigint"))
    fits = F.forall("embedding", lambda x: F.abs(x) < LARGEST)
    return vectors.where(F.col("embedding").isNotNull() & whole).select(
        "vec_id", "label", F.when(fits, x).alias("x")
    )


def _first(rows: DataFrame, n: int) -> list[list[int]]:
    """The vectors of the n smallest ids, ties by the vector; null ids last."""
    return [r["x"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(n).select("x").collect()]


def blocks(rows: DataFrame) -> DataFrame:
    """Up to BLOCK vectors a row: ids, labels, values by dimension, codes.

    All vectors in `rows` have the same length. `values` are the distinct
    integers of each dimension, `sizes` how many there are, and `codes` say
    which of them a vector has, dimension by dimension.
    """
    ids, labels = rows.schema["vec_id"].dataType, rows.schema["label"].dataType
    schema = StructType(
        [StructField("ids", ArrayType(ids)), StructField("labels", ArrayType(labels))]
        + [StructField(name, BinaryType()) for name in ("sizes", "values", "codes")]
    )

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                columns = np.stack(part["x"].to_list()).astype(np.int64).T
                found = [np.unique(column, return_inverse=True) for column in columns]
                yield pd.DataFrame(
                    {
                        "ids": [_listed(part["vec_id"])],
                        "labels": [_listed(part["label"])],
                        "sizes": [np.array([len(v) for v, _ in found], np.int32).tobytes()],
                        "values": [b"".join(v.tobytes() for v, _ in found)],
                        "codes": [b"".join(c.astype(np.uint16).tobytes() for _, c in found)],
                    }
                )

    # As objects, so that a column with nulls keeps its numbers.
    return rows.select("vec_id", "label", "x").mapInPandas(packed, schema)


def _listed(column: pd.Series) -> list:
    return [None if pd.isna(x) else (int(x) if isinstance(x, float) and x.is_integer() else x) for x in column]


def nearest(block, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(entry, squared distance) of each vector and part; values and codes by dimension."""
    parts, entries, width = books.shape
    sizes = np.frombuffer(block.sizes, np.int32)
    values = np.split(np.frombuffer(block.values, np.int64), np.cumsum(sizes)[:-1])
    codes = np.frombuffer(block.codes, np.uint16).reshape(len(sizes), -1)
    n = codes.shape[1]
    best, error = np.zeros((parts, n), np.int64), np.zeros((parts, n), np.int64)
    for p in range(parts):
        distance = np.zeros((n, entries), np.int64)
        for j in range(width):
            d = p * width + j
            table = np.square(values[d][:, None] - books[p, :, j][None, :])
            distance += table[codes[d]]
        # The first of the smallest.
        best[p] = distance.argmin(axis=1)
        error[p] = distance[np.arange(n), best[p]]
    return best, error, values, codes


def train(packed: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after some rounds over all blocks."""
    parts, entries, width = books.shape
    for _ in range(rounds):
        now = books

        def summed(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            sums = np.zeros((parts, entries, width + 1), np.int64)
            for batch in batches:
                for block in batch.itertuples(index=False):
                    best, _, values, codes = nearest(block, now)
                    for p in range(parts):
                        sums[p, :, width] += np.bincount(best[p], minlength=entries)
                        for j in range(width):
                            x = values[p * width + j][codes[p * width + j]]
                            # Whole numbers below 2 ** 53 here, so exact.
                            sums[p, :, j] += np.bincount(best[p], x, entries).astype(np.int64)
            slot = np.flatnonzero(sums.reshape(-1))
            yield pd.DataFrame({"slot": slot, "s": sums.reshape(-1)[slot]})

        total = np.zeros(books.size + parts * entries, np.int64)
        found = packed.select("sizes", "values", "codes").mapInPandas(summed, "slot long, s long")
        for row in found.groupBy("slot").agg(F.sum("s").alias("s")).collect():  # as large as the codebooks
            total[row["slot"]] = row["s"]
        total = total.reshape(parts, entries, width + 1)
        count = total[:, :, width :]
        books = np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)
    return books


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of all usable vectors, and the codebooks.

    `vectors` has vec_id, embedding and label; other columns are ignored. Codes
    are entry numbers in the order of parts, two hex digits each (256 entries at
    most). The length of vectors is that of the one with the smallest id. A
    vector of another length, or with components of LARGEST or more, or of a
    length that `parts` does not divide, has a null code and a null error. Rows
    with equal ids are coded each. Fewer vectors than entries make shorter
    codebooks, none make none.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits tell 256 entries at most")
    rows = usable(vectors)
    first = _first(rows.where("x IS NOT NULL"), 1)
    length = len(first[0]) if first else 0
    fits = F.col("x").isNotNull() & (F.size("x") == length) & F.lit(length > 0 and length % parts == 0)
    good = rows.where(fits)
    first = _first(good, entries)
    books = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2) if first else np.zeros((parts, 0, 0), np.int64)
    schema = StructType(
        [rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())]
    )
    rest = rows.where(~F.coalesce(fits, F.lit(False))).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")
    )
    if not first:
        return rest, books
    packed = written(blocks(good), "blocks")
    books = train(packed, books, rounds)

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                best, error, _, _ = nearest(block, books)
                codes = best.T.astype(np.uint8)
                yield pd.DataFrame(
                    {
                        "vec_id": pd.Series(list(block.ids), dtype=object),
                        "label": pd.Series(list(block.labels), dtype=object),
                        "code": [row.tobytes().hex() for row in codes],
                        "error": error.sum(axis=0),
                    }
                )

    return packed.mapInPandas(assigned, schema).unionByName(rest), books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components as decimal text by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """`rows` with label_error: `error` summed over equal labels, nulls together."""
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = sums.select("of", F.xxhash64("of").alias("of_key"), "label_error")
    # Both sides are shuffled by a key made anew, so that adaptive execution can
    # split a label that very many rows have.
    same = (F.xxhash64("label") == F.col("of_key")) & F.col("label").eqNullSafe(F.col("of"))
    return rows.join(sums, same).drop("of", "of_key")
