"""Keys of many documents, packed for a shuffle by key.

A row per (document, key) costs more than the key itself. Here a task packs the
keys of its documents by bucket, and a bucket holds the same keys of all
documents, whoever has them.

Keys that a noticeable share of all documents has would still fill one bucket.
`common_keys` finds them in a bounded sample of documents; callers count them
over all documents before the shuffle (`counts_of`). So the sample decides on
the way only, never on a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

BLOBS = "bucket int, docs binary, sizes binary, keys binary, times binary, extra binary"

# Keys in more than this share of the sampled documents are common.
COMMON_SHARE = 0.01
SAMPLED_DOCS = 4000

_M = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    keys = keys + _M[0]
    keys = (keys ^ (keys >> np.uint64(30))) * _M[1]
    keys = (keys ^ (keys >> np.uint64(27))) * _M[2]
    return keys ^ (keys >> np.uint64(31))


def word_hashes(unique: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, from all their bytes."""
    if not unique:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(b"".join(unique), np.uint8).astype(np.uint64)
    sizes = np.array([len(x) for x in unique])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = (np.arange(len(codes)) - np.repeat(starts, sizes)).astype(np.uint64)
    # Each byte is hashed with its place; sums of these tell words apart.
    each = mixed(codes + (at << np.uint64(8)))
    sums = np.zeros(len(unique), np.uint64)
    full = sizes > 0
    if full.any():
        sums[full] = np.add.reduceat(each, starts[full])
    return mixed(sums + sizes.astype(np.uint64))


def numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, list[bytes]]:
    """Words as numbers in order of appearance, and the distinct words."""
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(word, len(seen)) for words in lists for word in words]
    return np.array(ids, np.int64), list(seen)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def blobs(
    ids: np.ndarray, bucket: np.ndarray, doc: np.ndarray, keys: np.ndarray, times: np.ndarray, extra: np.ndarray
) -> pd.DataFrame:
    """A row per bucket of entries sorted by bucket and document.

    `doc` indexes `ids` and `extra`, a number per document that goes along.
    """
    rows = []
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            continue
        part = doc[a:b]
        first = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1])
        sizes = np.diff(np.append(first, b - a)).astype(np.int32)
        owners = part[first]
        rows.append(
            (
                int(bucket[a]),
                ids[owners].tobytes(),
                sizes.tobytes(),
                keys[a:b].tobytes(),
                times[a:b].astype(np.int32).tobytes(),
                extra[owners].astype(np.int32).tobytes(),
            )
        )
    return pd.DataFrame(rows, columns=["bucket", "docs", "sizes", "keys", "times", "extra"])


def joined(column: pd.Series, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype)


def narrow(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest takes."""
    most = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"u{width}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def common_keys(
    docs: DataFrame,
    keys_of: Callable[[pd.Series], tuple[np.ndarray, np.ndarray]],
    total: int | None = None,
    share: float = COMMON_SHARE,
) -> np.ndarray:
    """Keys (sorted) of more than `share` of about SAMPLED_DOCS of `total` documents.

    `keys_of` gives (document index, key) pairs, each once. A document has few
    keys, so the result is bounded by its mean length over `share`. Documents
    are drawn by their id, so copies are drawn apart.
    """
    total = docs.count() if total is None else total
    if not total:
        return np.zeros(0, np.uint64)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, SAMPLED_DOCS / total) * (1 << 20)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, "text"):
            keys, n = np.unique(keys_of(batch["text"])[1], return_counts=True)
            yield pd.DataFrame({"k": keys.astype(np.int64), "n": n})

    sample = docs.where(F.col("text").isNotNull()).where(drawn).select("text")
    limit = max(8.0, share * min(total, SAMPLED_DOCS))
    found = (
        sample.mapInPandas(counted, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") > limit)
    )
    return np.sort(np.array([r["k"] for r in found.collect()], np.int64).astype(np.uint64))


def counts_of(
    docs: DataFrame, keys: np.ndarray, keys_of: Callable[[pd.Series], tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """In how many documents each of some sorted keys is, over all documents."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(len(keys), np.int64)
        for batch in slices(batches, "text"):
            found = keys_of(batch["text"])[1]
            sums += np.bincount(np.searchsorted(keys, found[is_in(found, keys)]), minlength=len(keys))
        yield pd.DataFrame({"place": np.arange(len(keys)), "n": sums})

    out = np.zeros(len(keys), np.int64)
    if len(keys):
        rows = docs.select("text").mapInPandas(counted, "place long, n long")
        for row in rows.groupBy("place").agg(F.sum("n").alias("n")).collect():  # as many as keys
            out[row["place"]] = row["n"]
    return out


def is_in(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return ordered[at] == keys
