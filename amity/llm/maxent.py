"""A hashed maximum-entropy language model and an exact unigram base.

The model predicts a word in two steps: its class, by a softmax over hashed
features of the words before it, and the word within its class, by counts.
Features are the previous word, the pair of previous words, and skips to the
second and third word back. Weights are trained in rounds: each round takes a
share of the documents, every task follows the gradient from the common
weights on its own documents, and what the tasks learned is averaged.

Counts of words come from a bucketed shuffle of all words of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import remainder, shuffle_partitions, slices, written

CLASSES = 32
TABLE_BITS = 14
FEATURES = 4
ROUNDS = 2
RATE = 0.5
STEP_TOKENS = 4096
WEIGHT_ROWS = 1 << 10

# Rows of the table that this many tokens of a step have, or fewer, are summed place by place.
SHORT_RUN = 6

# Tasks whose weights are averaged in one group first.
PIECES = 128
ADDED = 0.1

END = b"\n"
_SKIPS = ((1, 0), (1, 2), (2, 0), (3, 0))


def tokens(texts: pd.Series) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Numbers of all tokens in order, the distinct tokens, tokens per text.

    Tokens are UTF-8 words in lower case (A to Z only) between ASCII white
    space, and one end for each text, written as a line end.
    """
    lists = [[*t.encode().lower().split(), END] if isinstance(t, str) else [END] for t in texts]
    ids, unique = packed.numbered(lists)
    return ids, unique, np.array([len(x) for x in lists])


def classes_of(unique: list[bytes]) -> np.ndarray:
    """The class of each token: a hash of its last two bytes; 0 for the end."""
    tails = [w[-2:] for w in unique]
    known = {t: i for i, t in enumerate(dict.fromkeys(tails))}
    hashed = (packed.word_hashes(list(known)) % np.uint64(CLASSES - 1)).astype(np.int64) + 1
    out = hashed[[known[t] for t in tails]] if tails else np.zeros(0, np.int64)
    return np.where(np.array([w == END for w in unique], bool), 0, out)


def features(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of the weight table for each token, FEATURES of them."""
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(hashes)) - starts

    def back(n: int) -> np.ndarray:
        moved = np.concatenate([np.zeros(min(n, len(hashes)), np.uint64), hashes[: max(0, len(hashes) - n)]])
        return np.where(place >= n, moved, np.uint64(n))

    out = np.empty((len(hashes), FEATURES), np.uint16)
    for i, (first, second) in enumerate(_SKIPS):
        key = back(first) * np.uint64(2 * i + 3)
        if second:
            key = key + packed.mixed(back(second))
        out[:, i] = (packed.mixed(key + np.uint64(i)) >> np.uint64(64 - TABLE_BITS)).astype(np.uint16)
    return out


def probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Probabilities of all classes for each token."""
    logits = weights[rows[:, 0]] + bias
    for i in range(1, FEATURES):
        logits += weights[rows[:, i]]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def train(
    docs: DataFrame, rounds: int = ROUNDS, common: np.ndarray = np.zeros(0, np.uint64)
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights (table row, class) and bias, trained on all texts of `docs`.

    The weights have a fixed size. Every document is used in one round, in
    full; null texts count as empty. On the way the `common` words, sorted
    hashes, are counted in all texts: their numbers and classes come as well.
    """
    weights = np.zeros((1 << TABLE_BITS, CLASSES), np.float32)
    bias = np.zeros(CLASSES, np.float32)
    counts, classes = np.zeros(len(common), np.int64), np.zeros(len(common), np.int64)
    for turn in range(rounds):
        share = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).select("text")
        old_weights, old_bias = weights, bias

        def learn(batches: Iterator[pd.DataFrame], start=old_weights, start_bias=old_bias) -> Iterator[pd.DataFrame]:
            w, b = start.copy(), start_bias.copy()
            used = np.zeros(len(w), np.int64)
            often, kind = np.zeros(len(common), np.int64), np.zeros(len(common), np.int64)
            part = TaskContext.get().partitionId() // PIECES
            seen = 0
            for batch in slices(batches, "text"):
                ids, unique, sizes = tokens(batch["text"])
                hashes, of = packed.word_hashes(unique), classes_of(unique)
                hit = packed.is_in(hashes, common)
                at = np.searchsorted(common, hashes[hit])
                np.add.at(often, at, np.bincount(ids, minlength=len(unique))[hit])
                kind[at] = of[hit]
                rows = features(hashes[ids], sizes)
                target = of[ids]
                for at in range(0, len(ids), STEP_TOKENS):
                    _step(w, b, rows[at : at + STEP_TOKENS], target[at : at + STEP_TOKENS], used)
                seen += len(ids)
            if not seen:
                return
            for at in range(0, len(w), WEIGHT_ROWS):
                rows = slice(at, at + WEIGHT_ROWS)
                yield _piece(at, part, (w[rows] - start[rows]) * used[rows, None], used[rows])
            yield _piece(_BIAS, part, (b - start_bias) * seen, [seen])
            # Classes of a word are all alike, so they come out as a mean.
            yield _piece(_COUNTS, part, often, np.zeros(0))
            yield _piece(_CLASSES, part, kind * (often > 0), often > 0)

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            moved, used = (np.sum([np.frombuffer(x) for x in rows[c]], axis=0) for c in ("moved", "used"))
            return _piece(int(rows["block"].iloc[0]), 0, moved, used)

        # A group holds PIECES pieces, and then one for each PIECES tasks.
        schema = "block int, part int, moved binary, used binary"
        few = share.mapInPandas(learn, schema).groupBy("block", "part").applyInPandas(add, schema)
        weights, bias = weights.copy(), bias.copy()
        for row in few.groupBy("block").applyInPandas(add, schema).collect():  # the weights, of fixed size
            moved, used = np.frombuffer(row["moved"]), np.frombuffer(row["used"])
            if row["block"] == _COUNTS:
                counts += moved.astype(np.int64)
            elif row["block"] == _CLASSES:
                found = used > 0
                classes[found] = np.rint(moved[found] / used[found])
            elif row["block"] == _BIAS:
                bias += (moved / used).astype(np.float32)
            else:
                mean = moved.reshape(len(used), -1) / np.maximum(used, 1)[:, None]
                weights[row["block"] : row["block"] + WEIGHT_ROWS] += mean.astype(np.float32)
    return weights, bias, counts, classes


_BIAS, _COUNTS, _CLASSES = -1, -2, -3


def _piece(block: int, part: int, moved: np.ndarray, used: np.ndarray) -> pd.DataFrame:
    """What a task adds to a block: sums, and the numbers they are to be divided by."""
    data = [np.asarray(x, np.float64).tobytes() for x in (moved, used)]
    return pd.DataFrame({"block": [block], "part": [part], "moved": data[:1], "used": data[1:]})


def _step(w: np.ndarray, b: np.ndarray, rows: np.ndarray, target: np.ndarray, used: np.ndarray) -> None:
    """One gradient step on some tokens; often used rows take smaller steps."""
    error = probabilities(w, b, rows)
    error[np.arange(len(target)), target] -= 1
    b -= RATE * error.mean(axis=0)
    flat = rows.T.reshape(-1)
    order = np.argsort(flat, kind="stable")
    flat = flat[order].astype(np.int64)
    first = np.flatnonzero(np.diff(flat, prepend=-1))
    touched = flat[first]
    often = np.diff(np.append(first, len(order)))
    sums = _sums(error.take(order % len(target), axis=0), first, often)
    used[touched] += often
    w[touched] -= RATE * sums / (np.sqrt(used[touched]) * 2 + 1)[:, None]


def _sums(rows: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of rows. Most runs are short: what is at one place in them is added at once."""
    out = rows.take(first, axis=0)
    # The first row is added last, as `reduceat` does: the weights stay the same to the bit.
    short = np.flatnonzero((sizes > 1) & (sizes <= SHORT_RUN))
    rest = rows.take(first[short] + 1, axis=0)
    for at in range(2, SHORT_RUN):
        more = np.flatnonzero(sizes[short] > at)
        rest[more] += rows.take(first[short[more]] + at, axis=0)
    out[short] += rest
    long = sizes > SHORT_RUN
    if long.any():
        held = sizes[long]
        out[long] = np.add.reduceat(rows[np.repeat(long, sizes)], np.cumsum(held) - held, axis=0)
    return out


def scored(docs: DataFrame, held_out_of: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Documents whose crc32(doc_id as text) is divisible by `held_out_of` are
    scored only; all others, those with a null id too, are learned from as
    well. A null text is empty and has the end as its only token. Rows are told
    apart by a hash of id and text, so equal rows get equal results. Other
    columns are ignored.
    """
    held = remainder(F.col("doc_id"), held_out_of) == 0
    docs = docs.select("doc_id", "text", held.alias("held_out"), F.xxhash64("doc_id", "text").alias("row"))
    learned = docs.where(~F.col("held_out"))
    n = shuffle_partitions(docs.sparkSession)
    common = packed.common_keys(docs, _document_words)
    weights, bias, common_counts, common_classes = train(learned, common=common)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 32
        for turn, batch in enumerate(slices(batches, "text")):
            ids, unique, sizes = tokens(batch["text"])
            hashes = packed.word_hashes(unique)
            each = hashes[ids]
            owner = np.repeat(np.arange(len(batch)), sizes)
            target = classes_of(unique)
            rows = features(each, sizes)
            logs = np.empty(len(ids))
            for at in range(0, len(ids), STEP_TOKENS):
                part = slice(at, at + STEP_TOKENS)
                p = probabilities(weights, bias, rows[part])
                logs[part] = np.log10(p[np.arange(len(p)), target[ids[part]]])
            in_class = np.bincount(owner * CLASSES + target[ids], minlength=len(batch) * CLASSES)
            # What is known of a document here travels as its own row.
            hot = packed.is_in(hashes, common)[ids]
            counts = common_counts[np.minimum(np.searchsorted(common, each), max(0, len(common) - 1))] if len(common) else np.zeros(len(each))
            known = np.bincount(owner[hot], counts[hot] > 0, len(batch))
            sums = np.bincount(owner[hot], np.log10(counts[hot] + ADDED), len(batch))
            row = batch["row"].to_numpy(np.int64)
            out = pd.DataFrame(
                {
                    "bucket": packed.bucket_of(packed.mixed(row.astype(np.uint64)), n).astype(np.int32),
                    "batch": task | turn,
                    "row": row,
                    "n_tokens": sizes,
                    "model": np.bincount(owner, logs, len(batch)),
                    "known": known.astype(np.int64),
                    "sums": sums,
                    "in_class": list(in_class.reshape(-1, CLASSES).astype(np.int32)),
                }
            )
            yield _dealt(out)
            cold = ~hot
            pair, times = np.unique(owner[cold] << 32 | ids[cold], return_counts=True)
            key = hashes[pair & 0xFFFFFFFF]
            bucket = packed.bucket_of(key, n)
            order = np.argsort(bucket, kind="stable")
            # A negative count: the document is held out and isn't learned from.
            sign = np.where(batch["held_out"].to_numpy(bool), -1, 1)[pair >> 32]
            blobs = packed.blobs(row, bucket[order], (pair >> 32)[order], key[order], (sign * times)[order], np.zeros(len(batch)))
            blobs["extra"] = [
                target[pair & 0xFFFFFFFF][order][a:b].astype(np.uint8).tobytes()
                for a, b in _edges(bucket[order])
            ]
            # No nulls: pandas would turn the row ids of a whole group to floats.
            blobs = blobs.assign(batch=task | turn, row=0, n_tokens=0, model=0.0, known=0, sums=0.0)
            yield _dealt(blobs.astype({"bucket": np.int32}))

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["keys"].isna()]
        out = [
            pd.DataFrame(
                {
                    "batch": own["batch"].astype(np.int64),
                    "row": own["row"].astype(np.int64),
                    "n_tokens": own["n_tokens"].astype(np.int64),
                    "model": own["model"],
                    "known": own["known"].astype(np.int64),
                    "sums": own["sums"],
                    "in_class": own["in_class"],
                    "in_train": None,
                    "docs": None,
                    "known_of": None,
                    "sums_of": None,
                }
            )
        ]
        blobs = rows[rows["keys"].notna()]
        if len(blobs):
            keys = packed.joined(blobs["keys"], np.uint64)
            times = packed.joined(blobs["times"], np.int32).astype(np.int64)
            classes = packed.joined(blobs["extra"], np.uint8)
            docs_ = packed.joined(blobs["docs"], np.int64)
            sizes = packed.joined(blobs["sizes"], np.int32)
            distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            counts = np.bincount(inverse, np.maximum(times, 0), len(distinct))
            owner = np.repeat(np.arange(len(docs_)), sizes)
            often = np.abs(times)
            known = np.bincount(owner, often * (counts[inverse] > 0), len(docs_))
            sums = np.bincount(owner, often * np.log10(counts[inverse] + ADDED), len(docs_))
            # One row for each batch that asked, not one for each of its documents.
            ends = np.cumsum([len(x) // 8 for x in blobs["docs"]])
            of_blob = list(zip([0, *ends[:-1]], ends))
            out.append(
                _told(
                    len(blobs),
                    batch=blobs["batch"].to_numpy(np.int64),
                    docs=list(blobs["docs"]),
                    known_of=[known[a:b].astype(np.int64).tobytes() for a, b in of_blob],
                    sums_of=[sums[a:b].tobytes() for a, b in of_blob],
                )
            )
            of = classes[first]
            totals = np.concatenate([np.bincount(of, counts, CLASSES), np.bincount(of, counts > 0, CLASSES)])
            out.append(_told(1, in_train=[totals]))
        return pd.concat([x for x in out if len(x)], ignore_index=True) if any(len(x) for x in out) else out[0]

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        distinct, inverse = np.unique(packed.joined(rows["docs"], np.int64), return_inverse=True)
        known = np.bincount(inverse, packed.joined(rows["known_of"], np.int64))
        sums = np.bincount(inverse, packed.joined(rows["sums_of"], np.float64))
        return pd.DataFrame({"row": distinct, "known": known.astype(np.int64), "sums": sums})

    parts = written(
        docs.select("row", "text", "held_out")
        .mapInPandas(deal, _DEAL_SCHEMA)
        .groupBy("bucket")
        .applyInPandas(look, _TOLD_SCHEMA),
        "words",
    )
    # One row: tokens and distinct words of the training documents by class.
    sums = [F.sum(F.col("in_train")[i]).alias(f"c{i}") for i in range(2 * CLASSES)]
    totals = np.array([x or 0 for x in parts.where("in_train IS NOT NULL").agg(*sums).first()], float)
    counts, distinct = totals[:CLASSES].copy(), totals[CLASSES:].copy()
    np.add.at(counts, common_classes, common_counts)
    np.add.at(distinct, common_classes, common_counts > 0)
    size, vocabulary = float(counts.sum()), float(distinct.sum())
    within = np.log10(counts + ADDED * (distinct + 1))
    whole = float(np.log10(size + ADDED * (vocabulary + 1)))

    lost = F.aggregate(
        F.zip_with("in_class", F.array(*[F.lit(float(x)) for x in within]), lambda n, d: n * d),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    own = parts.where("in_class IS NOT NULL").select("row", "known", "sums", "n_tokens", "model", "in_class")
    asked = parts.where("docs IS NOT NULL").select("batch", "docs", "known_of", "sums_of")
    met = asked.groupBy("batch").applyInPandas(gather, "row long, known long, sums double")
    # Equal rows are counted as often as they occur, so shares are taken.
    per_row = (
        own.unionByName(met, allowMissingColumns=True)
        .groupBy("row")
        .agg(
            F.count("in_class").alias("copies"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("known").alias("n_known"),
            F.sum("sums").alias("sums"),
            F.sum(F.col("model") - F.coalesce(lost, F.lit(0.0))).alias("model"),
        )
        .select(
            F.bitwise_not("row").alias("of"),
            (F.col("n_tokens") / F.col("copies")).cast("bigint").alias("n_tokens"),
            (F.col("n_known") / F.col("copies")).cast("bigint").alias("n_known"),
            (F.col("sums") / F.col("copies")).alias("sums"),
            (F.col("model") / F.col("copies")).alias("model"),
        )
    )
    return docs.select("doc_id", "held_out", "row").join(per_row, F.bitwise_not("row") == F.col("of")).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(size)).cast("bigint").alias("train_tokens"),
        (F.col("sums") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + F.col("sums")).alias("score"),
    )


_DEALT = [
    "bucket", "batch", "row", "n_tokens", "model", "known", "sums", "in_class", "docs", "sizes", "keys", "times", "extra",
]
_DEAL_SCHEMA = (
    "bucket int, batch long, row long, n_tokens long, model double, known long, sums double, "
    "in_class array<int>, docs binary, sizes binary, keys binary, times binary, extra binary"
)


_TOLD_SCHEMA = (
    "batch long, row long, n_tokens long, model double, known long, sums double, "
    "in_class array<int>, in_train array<double>, docs binary, known_of binary, sums_of binary"
)


def _told(n: int, **columns) -> pd.DataFrame:
    """`n` rows of what a bucket tells, with the given columns and nothing else."""
    plain = {"batch": 0, "row": 0, "n_tokens": 0, "model": 0.0, "known": 0, "sums": 0.0}
    none = dict.fromkeys(["in_class", "in_train", "docs", "known_of", "sums_of"])
    return pd.DataFrame(plain | none | columns, index=range(n))


def _dealt(rows: pd.DataFrame) -> pd.DataFrame:
    missing = {name: None for name in _DEALT if name not in rows}
    return rows.assign(**missing)[_DEALT]


def _edges(bucket: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


def _document_words(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    ids, unique, sizes = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), sizes)
    pair = np.unique(owner << 32 | ids)
    return pair >> 32, packed.word_hashes(unique)[pair & 0xFFFFFFFF]
