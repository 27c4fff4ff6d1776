"""Long strings that occur more than once in a corpus, byte for byte.

1. The smallest hash of all grams in a string of `LENGTH` bytes is its key, so
   equal strings have equal keys. Neighbouring strings with the same key make
   one stretch of text: every string of the corpus is in just one stretch.
2. Only stretches with a key that occurs again matter. Equal stretches are
   counted, and one of them is sent on with its number.
3. The stretches of a key meet in one task. Their suffixes are sorted by twice
   as many bytes each round, and only those that still share all bytes with
   another. From the last number of bytes up to `LENGTH` on, intervals of the
   suffix array are extended backward on the Burrows-Wheeler transform, breadth
   first: the round for strings of n bytes finds all places where neighbouring
   suffixes share n - 1 bytes. It stops at `LENGTH`; what has not been parted by
   then shares `LENGTH` bytes or more.
4. What occurs twice is told to all documents that have the stretch.

A gram that very many documents have, with other text around it, would bring all
their stretches to one task. The stretches of such a key are dealt anew, as texts
of their own, by the smallest hash of longer grams, and once more where that is
not enough. Grams of `LENGTH` bytes come last: there only equal strings meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import packed
from .common import give_back, slices, written

LENGTH = 400

# Bytes of the grams whose hashes are keys; the last ones are the strings themselves.
GRAMS = (32, 128, 256, 384)

# Bytes of distinct stretches that one key may have before they are dealt anew.
KEY_BYTES = 1 << 19

# Stretches up to this number are told to all tasks; there are no more than that to broadcast.
BROADCAST_PARTS = 100_000

# Strings of one stretch at most; longer ones are cut, which loses nothing.
STRETCH = 1 << 16

# Bytes that are sorted together, unless one key has more.
BATCH_BYTES = 1 << 19

# Bits of a place in what is sorted together; more is sorted by wider numbers.
_PLACE_BITS = 21

# No byte of UTF-8: it parts stretches and is greater than all bytes.
BREAK = 0xFF


def gram_hashes(data: np.ndarray, gram: int = GRAMS[0]) -> np.ndarray:
    """Hashes of the `gram` bytes from each place on; the last ones are not valid."""

    def after(h: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros_like(h)
        out[: max(0, len(h) - step)] = h[step:]
        return out

    h = packed.mixed(np.arange(256, dtype=np.uint64))[data]
    step, odd = 1, 0x9E3779B97F4A7C15
    while step < gram:
        # The last two runs overlap if the length is no power of two.
        h = h * np.uint64(odd) + after(h, min(step, gram - step))
        odd = (odd * 0xD1342543DE82EF95 + 2) % (1 << 64)
        step *= 2
    return packed.mixed(h)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of `width` values from each place on, as far as there are."""
    n = len(values)
    whole = -(-n // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAMS[0]) -> tuple[np.ndarray, ...]:
    """(text index, first start, number of starts, key, times) of the stretches of all texts.

    `times` is how often the stretch has the gram that is its key. Strings that
    are equal have it at the same place, so one alone in the corpus can't be in
    two equal strings.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, np.zeros(0, np.uint64), empty
    grams = gram_hashes(data, gram)[: len(data) - gram + 1]
    width = length - gram + 1
    keys = smallest(grams, width)
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(keys))
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(keys)]
    inside = place + length <= (begins + sizes)[owner]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    new |= (place - begins[owner]) % STRETCH == 0
    first = np.flatnonzero(new & inside)
    count = np.add.reduceat(inside.astype(np.int64), np.flatnonzero(new))[inside[np.flatnonzero(new)]]
    times = [
        np.count_nonzero(grams[a : a + n + width - 1] == key)
        for a, n, key in zip(first.tolist(), count.tolist(), keys[first])
    ]
    return owner[first], first - begins[owner[first]], count, keys[first], np.array(times, np.int64)


def sorted_suffixes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of `data` in the order of their first `length` bytes or more; ends, and their bytes.

    Each round doubles the bytes that suffixes are ordered by, and orders only
    those that share all bytes so far with another one. `ends` tells the first
    suffix of each group that shares the given number of bytes, which is
    `length` at most; there is one more at the end.
    """
    n = len(data)
    small = n < 1 << _PLACE_BITS
    done = min(length, 5 if small else 8)
    padded = np.concatenate([data, np.full(done, BREAK, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(done):
        key = key << np.uint64(8) | padded[i : i + n]
    order, new = _in_order(key, np.arange(n), small)
    # The rank of a suffix is where its group begins, counted from 1.
    rank = np.empty(n, np.uint64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
    ends = np.append(new, True)
    known, bytes_known = ends.copy(), done
    while done < length:
        open_ = np.flatnonzero(~(ends[:-1] & ends[1:]))
        if not len(open_):
            break
        suffixes = order[open_]
        after = np.zeros(len(open_), np.uint64)
        inside = suffixes + done < n
        after[inside] = rank[suffixes[inside] + done]
        # Groups are numbered anew, so that both numbers fit beside a place.
        groups = np.cumsum(ends[open_]).astype(np.uint64)
        if small:
            packed_keys = np.sort(groups << np.uint64(2 * _PLACE_BITS) | after << np.uint64(_PLACE_BITS) | suffixes.astype(np.uint64))
            suffixes = (packed_keys & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
            packed_keys >>= np.uint64(_PLACE_BITS)
        else:
            packed_keys = groups << np.uint64(32) | after
            by = np.argsort(packed_keys)
            packed_keys, suffixes = packed_keys[by], suffixes[by]
        new = np.concatenate([[True], packed_keys[1:] != packed_keys[:-1]])
        order[open_] = suffixes
        rank[suffixes] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1
        ends[open_[new]] = True
        done *= 2
        if done <= length:
            known, bytes_known = ends.copy(), done
    return (order, ends, length) if done < length else (order, known, bytes_known)


def _in_order(key: np.ndarray, places: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places by key, and whether a key is another than the one before."""
    if small:
        held = np.sort(key << np.uint64(_PLACE_BITS) | places.astype(np.uint64))
        order = (held & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        key = held >> np.uint64(_PLACE_BITS)
    else:
        order = np.argsort(key)
        key = key[order]
    return order, np.concatenate([[True], key[1:] != key[:-1]])


def parted(data: np.ndarray, suffixes: np.ndarray, ends: np.ndarray, known: int, length: int) -> np.ndarray:
    """Whether each suffix in order shares less than `length` bytes with the one before.

    `ends` tells it for `known` bytes. Intervals of suffixes that begin with the
    same n bytes are extended to n + 1 bytes on the left: the bytes before them
    are read from the transform, and the inverse array says where the longer
    strings stand. An interval goes on only if its end was not known to part
    suffixes yet, so that over all rounds there are no more intervals than
    suffixes. Suffixes that reach a BREAK within `length` bytes are not told apart.
    """
    n = len(data)
    place = np.empty(n, np.int64)
    place[suffixes] = np.arange(n)
    before = data[suffixes - 1]
    moved = place[suffixes - 1]
    ends = ends.copy()
    # What is extended to a string that no other suffix shares parts nothing new.
    rows = np.flatnonzero((before != BREAK) & ~(ends[moved] & ends[moved + 1]))
    group = np.cumsum(ends[:n])[rows]
    for _ in range(length - known):
        if not len(rows):
            break
        group = group << 8 | before[rows]
        order = np.argsort(group)
        group = group[order]
        cut = np.flatnonzero(np.diff(group, prepend=-1))
        starts = np.minimum.reduceat(moved[rows[order]], cut)
        many = np.diff(np.append(cut, len(rows)))
        fresh = ~ends[starts + many]
        starts, many = starts[fresh], many[fresh]
        ends[starts + many] = True
        offset = np.cumsum(many) - many
        rows = np.repeat(starts - offset, many) + np.arange(many.sum())
        group = np.repeat(np.arange(len(many)), many)
        keep = before[rows] != BREAK
        rows, group = rows[keep], group[keep]
    return ends[:n]


def repeated_starts(texts: list[bytes], times: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each text the starts of `length` bytes that occur twice or more.

    A text that stands for several equal ones counts that often.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    suffixes, ends, known = sorted_suffixes(data, length)
    run = np.cumsum(parted(data, suffixes, ends, known, length))
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)[suffixes]
    full = suffixes + length <= (begins + sizes)[owner]
    often = np.bincount(run[full], times[owner[full]], run[-1] + 1)
    hit = full & (often[run] >= 2)
    starts = np.sort(suffixes[hit])
    cuts = np.searchsorted(starts, np.append(begins, len(data)))
    return [starts[a:b] - begin for a, b, begin in zip(cuts[:-1], cuts[1:], begins)]


def spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """What strings of `length` bytes from the given starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    first = np.concatenate([starts[:1], starts[cut + 1]])
    last = np.concatenate([starts[cut], starts[-1:]])
    return [(int(a), int(b) + length) for a, b in zip(first, last)]


def repeated_spans(docs: DataFrame, length: int = LENGTH, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """(id, hash, spans): bytes of each text covered by repeated strings.

    `docs` has `_id`, `_hash` (of the text) and `text`, a string or binary; a row
    with `_times` stands for so many. Spans may overlap. Texts without any are
    left out. `grams` are the lengths of the grams that keys come from.
    """
    gram, *longer = [g for g in grams if g < length] or [length]
    longer = longer or ([length] if gram < length else [])
    counted = "_times" in docs.columns

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, "text"):
            texts = [_bytes(t) for t in batch["text"]]
            owner, start, count, key, times = stretches(texts, length, gram)
            if counted:
                # Strings with other keys before can't be equal.
                key = key ^ batch["_id"].to_numpy().view(np.uint64)[owner]
            yield pd.DataFrame(
                {
                    "id": batch["_id"].to_numpy()[owner],
                    "hash": batch["_hash"].to_numpy()[owner],
                    "times": batch["_times"].to_numpy()[owner] if counted else np.ones(len(owner), np.int64),
                    "start": start.astype(np.int32),
                    "size": (count + length - 1).astype(np.int32),
                    "key": key.view(np.int64),
                    "grams": times,
                    "part": packed.joined(
                        [
                            hashlib.blake2b(texts[o][s : s + n + length - 1], digest_size=8).digest()
                            for o, s, n in zip(owner, start, count)
                        ],
                        np.int64,
                    ),
                }
            )

    of_text = ["_id", "_hash", "text", *(["_times"] if counted else [])]
    found = written(
        docs.select(*of_text).mapInPandas(
            cut, "id long, hash long, times long, start int, size int, key long, grams long, part long"
        ),
        "stretches",
    )
    # Equal stretches count once in the bytes of their key. Rows of a key that has
    # but one string are gone before anything else is done.
    of_key = Window.partitionBy("key")
    met = written(
        found.groupBy("key", "part")
        .agg(
            F.sum("times").alias("times"),
            F.sum(F.col("grams") * F.col("times")).alias("n"),
            F.min(F.struct("id", "hash", "start", "size")).alias("at"),
        )
        .withColumns({"n": F.sum("n").over(of_key), "bytes": F.sum("at.size").over(of_key)})
        .where("n > 1")
        .select("key", "part", "times", "at", "bytes"),
        "met",
    )

    def asked(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("at.id").alias("asked_id"), F.col("at.hash").alias("asked_hash")).agg(
            F.collect_list(F.struct("key", "part", "times", "at.start", "at.size")).alias("parts")
        )

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, "text"):
            rows = []
            for text, parts in zip(batch["text"], batch["parts"]):
                data = _bytes(text)
                for p in parts:
                    rows.append((p["key"], p["part"], p["times"], data[p["start"] : p["start"] + p["size"]]))
            yield pd.DataFrame(rows, columns=["key", "part", "times", "text"])

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                # Rows come by key; a batch of keys ends where a key does.
                if size >= BATCH_BYTES and row[0] != held[-1][0]:
                    yield _matched(held, length)
                    held, size = [], 0
                    give_back()
                held.append(row)
                size += len(row[3])
        if held:
            yield _matched(held, length)

    @F.pandas_udf("array<struct<first:int,last:int>>")
    def as_one(spans: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in merged(found)] for found in spans])

    same = (F.col("_id") == F.col("asked_id")) & (F.col("_hash") == F.col("asked_hash"))
    sent = "key long, part long, times long, text binary"
    deeper = None
    if longer:
        crowded = met.where(F.col("bytes") > KEY_BYTES)
        if not crowded.isEmpty():
            met = met.where(F.col("bytes") <= KEY_BYTES)
            picked = written(asked(crowded), "picked")
            few = (picked.agg(F.sum(F.size("parts"))).first()[0] or 0) <= BROADCAST_PARTS
            parts = written(
                docs.select(*of_text).join(F.broadcast(picked) if few else picked, same).mapInPandas(send, sent), "parts"
            )
            texts = parts.select(
                F.col("key").alias("_id"), F.col("part").alias("_hash"), "text", F.col("times").alias("_times")
            )
            deeper = repeated_spans(texts, length, (*longer, length))

    # All columns stay in, so that this shuffle of texts is the same as the one
    # for the join of the result and is made once.
    covered = (
        docs.join(asked(met), same)
        .mapInPandas(send, sent)
        .repartition(F.col("key"))
        .sortWithinPartitions("key", "part")
        .mapInPandas(match, "key long, part long, spans array<struct<first:int,last:int>>")
    )
    # A stretch that very many documents have is split by adaptive execution:
    # both sides are shuffled for this join.
    told = covered.select(F.col("key").alias("of_key"), F.col("part").alias("of"), "spans")
    if deeper is not None:
        # Strings dealt one by one have a span each; all that have the stretch would be told each.
        told = told.unionByName(
            deeper.select(F.col("id").alias("of_key"), F.col("hash").alias("of"), as_one("spans").alias("spans"))
        )
    places = found.select("id", "hash", "start", "key", "part")
    return (
        places.join(told, (F.col("part") == F.col("of")) & (F.col("key") == F.col("of_key")))
        .select("id", "hash", "start", F.inline("spans"))
        .groupBy("id", "hash")
        .agg(
            F.collect_set(
                F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last"))
            ).alias("spans")
        )
    )


def _bytes(text: str | bytes | None) -> bytes:
    return text.encode() if isinstance(text, str) else text if isinstance(text, bytes) else b""


def _matched(held: list[tuple], length: int) -> pd.DataFrame:
    starts = repeated_starts([r[3] for r in held], np.array([r[2] for r in held]), length)
    rows = [
        (row[0], row[1], [{"first": a, "last": b} for a, b in spans(found, length)])
        for row, found in zip(held, starts)
        if len(found)
    ]
    return pd.DataFrame(rows, columns=["key", "part", "spans"])


def merged(found: list) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch as one."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in found):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with `kept` (binary), `n_bytes` and `removed` (first, last) spans.

    Every byte covered by a string of `length` bytes that starts anywhere else
    as well is removed, the first occurrence too. A null text is empty. Rows
    with equal id and text are separate occurrences. All columns stay, but for
    those of one of these three names.
    """
    stay = [c for c in docs.columns if c not in ("kept", "n_bytes", "removed")]
    cut, names = _cut(docs, length, whole_characters=False)
    return cut.select(*[F.col(names[c]).alias(c) for c in stay], "_cut.*")


def trimmed(docs: DataFrame, size: str | None = None, length: int = LENGTH) -> DataFrame:
    """`docs` with its repeats taken out of `text`, all columns as they were.

    A character of which a byte is covered goes as a whole, so nothing but
    repeats is lost; other characters stay, U+FFFD too. Texts of which nothing
    is left go; empty and null ones stay as they are. `size` names a column that
    gets the number of characters of texts that changed.
    """
    cut, names = _cut(docs, length, whole_characters=True)
    changed = F.size("_cut.removed") > 0
    kept = F.col("_cut.kept").cast("string")
    new = {"text": F.when(changed, kept).otherwise(F.col("text"))}
    if size in docs.columns:
        old = F.col(names[size])
        new[size] = F.when(changed, F.char_length(kept).cast(docs.schema[size].dataType)).otherwise(old)
    return cut.where(~changed | (F.octet_length("_cut.kept") > 0)).select(
        *[new.get(c, F.col(names[c])).alias(c) for c in docs.columns]
    )


def _cut(docs: DataFrame, length: int, whole_characters: bool) -> tuple[DataFrame, dict[str, str]]:
    """Documents with a struct `_cut` (kept, n_bytes, removed), and what columns are named in it."""

    @F.pandas_udf("kept binary, n_bytes long, removed array<struct<first:int,last:int>>")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        kept, sizes, removed = [], [], []
        for text, found in zip(texts, spans):
            data = text.encode() if isinstance(text, str) else b""
            gone = merged(found) if found is not None else []
            if whole_characters:
                gone = [_widened(data, a, b) for a, b in gone]
            edges = [0, *[x for span in gone for x in span], len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(data))
            removed.append([{"first": a, "last": b} for a, b in gone])
        return pd.DataFrame({"kept": kept, "n_bytes": sizes, "removed": removed})

    # Columns get names of their own, so that none can clash with those made here.
    names = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = docs.select(
        *[docs[c].alias(name) for c, name in names.items()], _id(docs).alias("_id"), F.xxhash64(docs["text"]).alias("_hash")
    )
    found = repeated_spans(keyed, length).select(
        F.col("id").alias("_of"), F.col("hash").alias("_of_hash"), F.col("spans").alias("_spans")
    )
    same = (F.col("_id") == F.col("_of")) & (F.col("_hash") == F.col("_of_hash"))
    joined = keyed.join(found, same, "left")
    # Told not to be deterministic, a function is not run again for a filter on it.
    cut = cut.asNondeterministic()
    return joined.select(*names.values(), cut("text", "_spans").alias("_cut")), names


def _widened(data: bytes, first: int, last: int) -> tuple[int, int]:
    """A span moved outward to where characters of UTF-8 begin."""
    while first and data[first] & 0xC0 == 0x80:
        first -= 1
    while last < len(data) and data[last] & 0xC0 == 0x80:
        last += 1
    return first, last


def _id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-1).cast("bigint"))


def _spread(key: str) -> Column:
    return F.bitwise_not(F.col(key))
