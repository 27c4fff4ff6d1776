"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

1. Words become shingles of five words; a bucketed shuffle counts in how many
   documents each shingle is. A batch of documents asks a bucket for all its
   shingles there in one row and is answered in one row. Shingles of one document
   only can't be shared, so of them a document keeps just the total weight. A
   document whose shared weight is too small for any partner is done.
2. Improved consistent weighted sampling draws samples from the shared
   shingles. Two documents draw the same with a probability not below their
   weighted Jaccard similarity. Samples are banded, equal bands are candidates.
3. Candidates are verified by their exact weighted Jaccard similarity. A band
   with n documents isn't n * n pairs: all are compared with one pivot first,
   then those not yet connected with a few more, and at last what is still
   apart is compared in full, in blocks.
4. Verified links make connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import give_back, shuffle_partitions, slices, written
from .components import components

SHINGLE = 5
SIMILARITY = 0.8

# Weight of a shingle: its count times 1 for the most common to 1 + RARITY for
# the rarest; documents beyond packed.COMMON_SHARE don't lower it further.
RARITY = 0.5

# Text whose shingles make about one bucket.
BUCKET_CHARS = 1 << 23

BANDS = 10
ROWS = 3
PIVOTS = 6

# What two documents can share is bounded group by group.
GROUPS = 32
SEED = 11

_QUANTILES = 1 << 16


def shingled(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle) for each shingle of each text, by document.

    Words are in lower case and end at ASCII white space. A text of fewer words, but
    not none, is one shingle.
    """
    lists = [t.lower().encode().split() if isinstance(t, str) else [] for t in texts]
    ids, unique = packed.numbered(lists)
    if not unique:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = packed.word_hashes(unique)[ids]
    sizes = np.array([len(x) for x in lists])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(lists)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(words))
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    keys = np.zeros(len(words), np.uint64)
    for i in range(SHINGLE):
        part = np.where(left > i, padded[i : i + len(words)], np.uint64(0))
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + part
    begins = (left >= SHINGLE) | (np.arange(len(words)) == np.repeat(starts, sizes))
    return owner[begins], packed.mixed(keys[begins])


def idf(df: np.ndarray | float, total: int) -> np.ndarray | float:
    most = np.maximum(packed.COMMON_SHARE * total, 2)
    df = np.minimum(df, most)
    return 1 + RARITY * np.log((1 + total) / (1 + df)) / np.log(1 + total)


def vectors(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(row, doc_id, total, shared, vector) of the rows that may have a near duplicate.

    `docs` has `row`, doc_id and text. `vector` packs the shared shingles, sorted:
    40 bits of hash, 24 of weight in units of 1/256. `shared` is their weight by
    GROUPS groups of hashes, and `total` the weight of all shingles, in the same
    units. Weights follow from exact numbers of documents.
    """
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars")).first()
    total = max(size["n"], 2)
    common = packed.common_keys(docs, _shingles_of, size["n"])
    common_weight = idf(packed.counts_of(docs, common, _shingles_of), total)
    n = max(shuffle_partitions(docs.sparkSession), size["chars"] // BUCKET_CHARS + 1)
    single = idf(1, total)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId() << 32
        for turn, batch in enumerate(slices(batches, "text")):
            owner, keys = shingled(batch["text"])
            many = np.bincount(owner, minlength=len(batch))
            owner, keys, times = _counted(owner, keys)
            # Common shingles are known already and go along with the batch.
            hot = packed.is_in(keys, common)
            weight = common_weight[np.searchsorted(common, keys[hot])] if hot.any() else np.zeros(0)
            own = {
                "rows": batch["row"].to_numpy(np.int64).tobytes(),
                "ids": batch["doc_id"].to_numpy(np.int64).tobytes(),
                "many": many.astype(np.int64).tobytes(),
                "owner": packed.narrow(owner[hot]),
                "times": packed.narrow(times[hot]),
                "entry": _entries(keys[hot], times[hot] * weight).tobytes(),
            }
            yield _told(batch=task | turn, bucket=hash(task | turn) % n, **{k: [v] for k, v in own.items()})
            owner, keys, times = owner[~hot], keys[~hot], times[~hot]
            bucket = packed.bucket_of(keys, n)
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            parts = [x for x in np.split(order, edges[1:]) if len(x)]
            yield _told(
                batch=task | turn,
                bucket=[int(bucket[x[0]]) for x in parts],
                owner=[packed.narrow(owner[x]) for x in parts],
                times=[packed.narrow(times[x]) for x in parts],
                entry=[_low_bits(keys[x]) for x in parts],
            )

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["rows"].notna()]
        asks = rows[rows["rows"].isna()]
        if not len(asks):
            return own
        give_back()
        seed = np.uint64(asks["bucket"].iloc[0]) << np.uint64(40)
        ordered = np.concatenate([seed | _from_low_bits(x) for x in asks["entry"]])
        ordered.sort()
        out = []
        for row in asks.itertuples(index=False):
            key = seed | _from_low_bits(row.entry)
            often = np.searchsorted(ordered, key, "right") - np.searchsorted(ordered, key, "left")
            keep = often > 1
            if keep.any():
                times = packed.widened(row.times)[keep]
                entry = _entries(key[keep], times * idf(often[keep], total))
                owner = packed.narrow(packed.widened(row.owner)[keep])
                out.append((row.batch, owner, packed.narrow(times), entry.tobytes()))
        answers = pd.DataFrame(out, columns=["batch", "owner", "times", "entry"])
        told = _told(bucket=0, **{c: answers[c].to_list() for c in answers})
        return pd.concat([own, told], ignore_index=True) if len(own) else told

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows["rows"].notna()].iloc[0]
        row, ids = np.frombuffer(own["rows"], np.int64), np.frombuffer(own["ids"], np.int64)
        many = np.frombuffer(own["many"], np.int64)
        owner = np.concatenate([packed.widened(x) for x in rows["owner"]])
        times = np.concatenate([packed.widened(x) for x in rows["times"]])
        entry = packed.joined(rows["entry"], np.uint64)
        order = np.lexsort((entry, owner))
        owner, entry = owner[order], entry[order]
        ends = np.searchsorted(owner, np.arange(len(row) + 1))
        group = (entry >> np.uint64(24) & np.uint64(GROUPS - 1)).astype(np.int64)
        units = (entry & np.uint64(0xFFFFFF)).astype(float)
        shared = np.bincount(owner * GROUPS + group, units, len(row) * GROUPS).astype(np.int64).reshape(-1, GROUPS)
        known = np.bincount(owner, times[order], len(row)).astype(np.int64)
        whole = shared.sum(axis=1) + np.rint((many - known) * single * 256).astype(np.int64)
        keep = np.flatnonzero((shared.sum(axis=1) >= similarity * whole) & (many > 0))
        return pd.DataFrame(
            {
                "row": row[keep],
                "doc_id": ids[keep],
                "total": whole[keep],
                "shared": pd.Series([shared[i] for i in keep], dtype=object),
                "vector": pd.Series([entry[ends[i] : ends[i + 1]].tobytes() for i in keep], dtype=object),
            }
        )

    # Buckets of a given size each, as many tasks as there are of them.
    dealt = docs.mapInPandas(deal, _TOLD).repartition(n, "bucket")
    answers = dealt.groupBy("bucket").applyInPandas(look, _TOLD)
    return answers.groupBy("batch").applyInPandas(
        gather, "row long, doc_id long, total long, shared array<long>, vector binary"
    )


_TOLD = "bucket int, batch long, rows binary, ids binary, many binary, owner binary, times binary, entry binary"


def _told(**columns) -> pd.DataFrame:
    """Rows of an exchange with the given columns and nulls in the others."""
    kinds = dict(part.split() for part in _TOLD.split(", "))
    made = pd.DataFrame(columns)
    made = made.assign(**{name: None for name in kinds if name not in made})[list(kinds)]
    return made.astype({name: object for name, kind in kinds.items() if kind == "binary"})


def _low_bits(keys: np.ndarray) -> bytes:
    """40 bits of each key; the bucket has the highest ones."""
    return keys.astype(np.uint32).tobytes() + (keys >> np.uint64(32)).astype(np.uint8).tobytes()


def _from_low_bits(data: bytes) -> np.ndarray:
    n = len(data) // 5
    low = np.frombuffer(data, np.uint32, n).astype(np.uint64)
    return np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32) | low


def _entries(keys: np.ndarray, weight: np.ndarray) -> np.ndarray:
    units = np.minimum(np.rint(weight * 256), (1 << 24) - 1).astype(np.uint64)
    return packed.mixed(keys) >> np.uint64(24) << np.uint64(24) | units


def _counted(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's distinct shingles and how often it has them."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (np.diff(owner) != 0) | (keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    return owner[first], keys[first], np.diff(np.append(first, len(keys)))


def _shingles_of(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return _counted(*shingled(texts))[:2]


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for each row of `docs`: the smallest id of its class.

    Documents are in one class if links of `similarity` or more connect them.
    Documents without words and rows with a null id are classes of their own
    (a null id has a null class). Rows with equal ids and texts have one class;
    rows with equal ids and other texts are documents of their own. Columns
    beside doc_id and text are ignored.
    """
    return _classes(docs, similarity).select("doc_id", "class_id")


def _row(docs: DataFrame) -> Column:
    """What stands for a row: equal for equal ids and texts only."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, row, class_id, first): `first` is the row that stands for the class."""
    rows = docs.select(docs["doc_id"], docs["text"], _row(docs).alias("row"))
    found = written(vectors(rows.where(F.col("doc_id").isNotNull()), similarity), "vectors")
    keyed = found.withColumn("same", F.md5("vector"))
    # Equal vectors are one class; from here on one row stands for it.
    classes = written(
        keyed.groupBy("same", "total").agg(F.min(F.struct("row", "shared", "vector")).alias("least"))
        .select("same", "total", F.col("least.row").alias("rep"), "least.shared", "least.vector"),
        "classes",
    )
    bands = written(classes.mapInPandas(_bands, "band long, rep long, total long, known long, shared array<long>"), "bands")
    # The pivot of a band is its document with the smallest share of shingles of
    # its own: what the others were made from, or near it.
    rooms = bands.groupBy("band").agg(F.count("*").alias("n"), _least_changed().alias("pivot")).where("n > 1")
    members = written(
        bands.join(
            rooms.select(F.bitwise_not("band").alias("room"), "pivot"), F.bitwise_not("band") == F.col("room")
        ).select("room", _member().alias("x"), "pivot"),
        "members",
    )
    links = written(_verified(_pairs(members, F.col("pivot"), similarity), classes, similarity), "links")
    roots = components(links)
    for more in (_pivot_pairs, _all_pairs):
        pairs = more(_apart(members, roots), similarity)
        links = written(links.unionByName(_verified(pairs, classes, similarity)), "links")
        roots = components(links)

    named = roots.select(F.col("node").alias("named"), "root")
    reps = keyed.select("row", "doc_id", F.concat("same", F.lit("#")).alias("k"), "total").join(
        classes.select(F.concat("same", F.lit("#")).alias("ck"), F.col("total").alias("ct"), "rep"),
        (F.col("k") == F.col("ck")) & (F.col("total") == F.col("ct")),
    )
    grouped = written(
        reps.join(named, F.col("rep") == F.col("named"), "left").select(
            F.col("row").alias("member"), "doc_id", F.coalesce("root", "rep").alias("group")
        ),
        "groups",
    )
    least = (
        grouped.groupBy("group")
        .agg(F.min(F.struct("doc_id", "member")).alias("least"))
        .select(F.bitwise_not("group").alias("of"), "least.*")
        .toDF("of", "class", "first")
    )
    told = (
        grouped.select("member", "group")
        .distinct()
        .join(least, F.bitwise_not("group") == F.col("of"))
        .select("member", "class", "first")
    )
    return rows.select("doc_id", "row").join(told, F.bitwise_not("row") == F.bitwise_not("member"), "left").select(
        "doc_id", "row", F.coalesce("class", "doc_id").alias("class_id"), F.coalesce("first", "row").alias("first")
    )


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with one document of each class: the one with the smallest id.

    All columns stay. Documents without words and null ids all stay. If a row is
    there several times as a whole (its id and text), all of them stay or go; of
    other texts with the smallest id one stays.
    """
    classes = _classes(docs, similarity)
    gone = classes.where("row <> first").select(F.bitwise_not("row").alias("_gone")).distinct()
    return docs.join(gone, F.bitwise_not(_row(docs)) == F.col("_gone"), "left_anti")


def _gamma_table() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution, by Newton's method."""
    p = (np.arange(_QUANTILES) + 0.5) / _QUANTILES
    x = np.where(p < 0.5, np.sqrt(2 * p), 2 - np.log(1 - p))
    for _ in range(40):
        x = np.maximum(1e-9, x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)))
    return x


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Banded samples of vectors, 64 of them drawn together at a time."""
    gamma = _gamma_table().astype(np.float32)
    log_gamma = np.log(gamma)
    low = np.uint64(0xFFFF)
    for batch in batches:
        for at in range(0, len(batch), 64):
            part = batch.iloc[at : at + 64]
            entries = [np.frombuffer(v, np.uint64) for v in part["vector"]]
            starts = np.concatenate([[0], np.cumsum([len(e) for e in entries])[:-1]])
            entry = np.concatenate(entries)
            log_weight = np.log((entry & np.uint64(0xFFFFFF)).astype(np.float32) / 256)
            key = entry >> np.uint64(24)
            bands = np.zeros((BANDS, len(part)), np.uint64)
            for k in range(BANDS * ROWS):
                h = packed.mixed(key + (np.uint64(k + 1) << np.uint64(42)))
                r = gamma[(h & low).astype(np.int64)]
                log_c = log_gamma[(h >> np.uint64(16) & low).astype(np.int64)]
                beta = (h >> np.uint64(32) & low).astype(np.float32) / np.float32(_QUANTILES)
                t = np.floor(log_weight / r + beta)
                log_a = log_c - r * (t - beta + 1)
                # The smallest wins; its order and a hash of (shingle, t) are the sample.
                bits = log_a.astype(np.float32).view(np.uint32)
                rank = np.where(bits >> 31 == 1, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
                tag = packed.mixed(h + t.astype(np.int64).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
                drawn = np.minimum.reduceat(rank << np.uint64(32) | tag, starts)
                bands[k // ROWS] = packed.mixed(bands[k // ROWS] + drawn + np.uint64(k // ROWS))
            yield pd.DataFrame(
                {
                    "band": bands.T.reshape(-1).astype(np.int64),
                    "rep": np.repeat(part["rep"].to_numpy(np.int64), BANDS),
                    "total": np.repeat(part["total"].to_numpy(np.int64), BANDS),
                    "known": np.repeat(part["shared"].map(np.sum).to_numpy(np.int64), BANDS),
                    "shared": [shared for shared in part["shared"] for _ in range(BANDS)],
                }
            )


def _verified(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) pairs whose weighted Jaccard similarity is high enough."""
    left = classes.select(F.col("rep").alias("ra"), F.col("total").alias("ta"), F.col("vector").alias("va"))
    right = classes.select(F.col("rep").alias("rb"), F.col("total").alias("tb"), F.col("vector").alias("vb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(0xFFFFFF)
        for batch in batches:
            # Vectors are read where they lie; as objects they would be there twice.
            weight = batch.column("ta").to_numpy() + batch.column("tb").to_numpy()
            keep = []
            for va, vb, both_totals in zip(batch.column("va"), batch.column("vb"), weight.tolist()):
                x, y = np.frombuffer(va.as_buffer(), np.uint64), np.frombuffer(vb.as_buffer(), np.uint64)
                kx, ky = x >> np.uint64(24), y >> np.uint64(24)
                at = np.minimum(np.searchsorted(ky, kx), len(ky) - 1)
                same = ky[at] == kx
                both = int(np.minimum(x[same] & mask, y[at[same]] & mask).sum())
                keep.append(both >= similarity * (both_totals - both) - 1)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            give_back()

    met = pairs.join(right, F.col("b") == F.col("rb")).join(left, F.col("a") == F.col("ra"))
    return met.select("a", "b", "ta", "va", "tb", "vb").mapInArrow(check, "a long, b long")


def _member() -> Column:
    return F.struct("rep", "total", "known", "shared")


def _changed() -> Column:
    """The share of shingles of its own, with the id for ties."""
    return F.struct(1 - F.col("known") / F.col("total"), F.col("rep"))


def _least_changed() -> Column:
    return F.min_by(_member(), _changed())


def _pairs(met: DataFrame, other: Column, similarity: float) -> DataFrame:
    """The pairs of x and `other` that can be similar, each once.

    Of each group of shingles they share what the poorer one shares with
    anybody at most. This leaves out no link.
    """
    return (
        met.where(_possible(F.col("x"), other, similarity))
        .select(F.least("x.rep", other["rep"]).alias("a"), F.greatest("x.rep", other["rep"]).alias("b"))
        .distinct()
    )


def _possible(x: Column, y: Column, similarity: float) -> Column:
    weight = x["total"] + y["total"]
    at_most = F.least(x["known"], y["known"])
    both = F.aggregate(
        F.zip_with(x["shared"], y["shared"], lambda a, b: F.least(a, b)),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    return (
        (x["rep"] != y["rep"])
        & ((1 + similarity) * at_most + 2 >= similarity * weight)
        & ((1 + similarity) * both + 2 >= similarity * weight)
    )


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(room, x, root) of the rooms whose members are in several components."""
    named = roots.select(F.col("node").alias("named"), "root")
    placed = members.join(named, F.col("x.rep") == F.col("named"), "left").select(
        "room", "x", F.coalesce("root", "x.rep").alias("root")
    )
    mixed = placed.groupBy("room").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rooms = mixed.select(F.bitwise_not("room").alias("of"))
    return written(placed.join(rooms, F.bitwise_not("room") == F.col("of"), "left_semi"), "apart")


def _pivot_pairs(apart: DataFrame, similarity: float) -> DataFrame:
    """Each member with the least changed ones of PIVOTS parts of its room."""
    drawn = (
        apart.select("room", "root", "x.*")
        .groupBy("room", F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(PIVOTS)).alias("part"))
        .agg(_least_changed().alias("pivot"), F.min_by("root", _changed()).alias("pivot_root"))
        .select(F.bitwise_not("room").alias("of"), "pivot", "pivot_root")
    )
    same = (F.bitwise_not("room") == F.col("of")) & (F.col("root") != F.col("pivot_root"))
    met = apart.join(drawn, same & _possible(F.col("x"), F.col("pivot"), similarity))
    return _pairs(met, F.col("pivot"), similarity)


def _all_pairs(apart: DataFrame, similarity: float) -> DataFrame:
    """Each member with every member of its room's other components it can be like."""
    other = apart.select(F.col("room").alias("of"), F.col("x").alias("y"), F.col("root").alias("y_root"))
    same = (F.col("room") == F.col("of")) & (F.col("root") < F.col("y_root"))
    met = apart.join(other, same & _possible(F.col("x"), F.col("y"), similarity))
    return _pairs(met, F.col("y"), similarity)
