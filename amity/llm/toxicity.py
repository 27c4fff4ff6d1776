"""Toxicity by the votes of the most similar labelled examples.

Texts are vectors of TF-IDF weights over all words of the examples, and over
beginnings of words that a chi-squared test finds to tell the labels apart.
Terms that don't pass the test weigh a small share, so that they decide
where no telling term does. Examples stand in an inverted index whose posting
lists are cut into blocks that know their largest weight. A query visits
blocks in the order of the highest cosine they can reach and stops when no
block can enter the nearest examples, so the nearest are exact. Their votes,
weighted by similarity and by how often each label occurs, are calibrated by a
logistic curve fitted on the examples, each scored without its own vote; the
nearest examples are the evidence.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice
from statistics import NormalDist

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, slices, written

# The model is fitted on about this many examples of each label.
EXAMPLES_PER_LABEL = 5000

CERTAINTY = 0.01
PREFIXES = (3, 4, 5, 6)
# What a term weighs that doesn't tell the labels apart.
PLAIN_SHARE = 0.05
NEIGHBOURS = 25
BLOCK = 64
# Blocks looked at first, and how many times as many each time after: each time costs a look
# at all lists of the query.
FIRST_BLOCKS = 32
MORE_BLOCKS = 4
# Terms of more than this share of the examples are kept as dense rows too. There
# are at most as many as a vector has terms on average, divided by the share.
DENSE_SHARE = 0.25
# Cosines that differ by less are taken as equal: rows are in single precision.
ROUNDING = 1e-6
SHARPNESS = 4.0
PRIOR_WEIGHT = 1.0
EVIDENCE = 3
MEMO = 500_000
TEXT_MEMO = 20_000
# How firmly the calibration holds to the votes as they are.
CALIBRATION_PRIOR = 1.0

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Index:
    """Distinct example vectors, their votes, and posting lists in blocks.

    `terms` are sorted hashes. The blocks of term t are `starts[t]` to
    `starts[t + 1]`: `blocks` has their numbers, `sizes` how many entries they
    hold; `offsets` and `times` have each entry's place in its block and its
    count of the term, block after block. `norms` are lengths of the vectors.
    """

    terms: np.ndarray
    term_weights: np.ndarray
    votes: np.ndarray
    examples: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    blocks: np.ndarray
    sizes: np.ndarray
    offsets: np.ndarray
    times: np.ndarray
    norms: np.ndarray
    prior: float
    plain: float
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self) -> None:
        """What follows from the fields: the list ends, weights, and largest weight of each block."""
        self._seen: dict[bytes, tuple[float, list]] = {}
        self._shared: Broadcast | None = None
        self._ends = np.cumsum(self.sizes, dtype=np.int64)
        entry = np.repeat(self.blocks.astype(np.int32) * BLOCK, self.sizes) + self.offsets
        self._entry = entry
        of_term = np.append(0, self._ends)[self.starts]
        per_term = np.diff(of_term)
        self._weights = (1 + np.log(self.times)) / self.norms[entry] * np.repeat(self.term_weights, per_term)
        self._most = np.maximum.reduceat(self._weights, self._ends - self.sizes) if len(self.sizes) else np.zeros(0)
        dense = np.flatnonzero(per_term > DENSE_SHARE * len(self.examples))
        self._row = np.full(len(self.terms), -1)
        self._row[dense] = np.arange(len(dense))
        self._rows = np.zeros((len(dense), len(self.examples)), np.float32)
        self._rows_most = np.zeros((len(dense), -(-len(self.examples) // BLOCK)))
        for row, term in enumerate(dense):
            listed = slice(of_term[term], of_term[term + 1])
            self._rows[row, entry[listed]] = self._weights[listed]
            blocks = slice(self.starts[term], self.starts[term + 1])
            self._rows_most[row, self.blocks[blocks]] = self._most[blocks]

    def __getstate__(self) -> bytes:
        fields = {k: v for k, v in self.__dict__.items() if not k.startswith("_")}
        return zstandard.compress(pickle.dumps(fields, protocol=5))

    def __setstate__(self, state: bytes) -> None:
        self.__dict__.update(pickle.loads(zstandard.decompress(state)))
        self.__post_init__()

    def shared(self, spark: SparkSession) -> Broadcast:
        """The index on all executors, sent once; its size is that of the drawn examples."""
        if self._shared is None:
            self._shared = spark.sparkContext.broadcast(self)
        return self._shared

    def score(self, text: str | None, memo: _Memo) -> tuple[float, list]:
        """Calibrated score and evidence of a text."""
        key = hashlib.blake2b((text or "").encode(errors="surrogatepass"), digest_size=16).digest()
        if key not in self._seen:
            if len(self._seen) >= TEXT_MEMO:
                self._seen.clear()
            terms, times = memo.counts(text)
            if len(terms):
                entries, cosines = self.nearest(terms, times)
                evidence = [
                    (int(self.examples[e]), float(c), int(self.labels[e]))
                    for e, c in zip(entries[:EVIDENCE], cosines[:EVIDENCE])
                ]
                raw = self.vote(entries, cosines)
            else:
                raw, evidence = self.plain, []
            self._seen[key] = self.calibrated(raw), evidence
        return self._seen[key]

    def nearest(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entries and their cosines, all that tie with the last included."""
        query = _unit(terms, times, self.term_weights)
        size = len(self.examples)
        row = self._row[terms]
        often = row >= 0
        common, row, rare = query[often], row[often], terms[~often]
        dense = common.astype(np.float32) @ self._rows.take(row, axis=0)
        first, last = self.starts[rare], self.starts[rare + 1]
        lists = _ranges(first, last)
        share = np.repeat(query[~often], last - first)
        block = self.blocks.take(lists)
        reach = np.bincount(block, share * self._most.take(lists), minlength=-(-size // BLOCK))
        reach = reach + common @ self._rows_most.take(row, axis=0)
        held, end = self.sizes.take(lists), self._ends.take(lists)
        order = np.argsort(-reach, kind="stable")
        order = order[: np.count_nonzero(reach)]
        entries, cosines = np.zeros(0, np.int64), np.zeros(0)
        done, step = 0, FIRST_BLOCKS
        while done < len(order):
            if len(cosines) >= NEIGHBOURS:
                floor = cosines[NEIGHBOURS - 1]
                if reach[order[done]] < floor - ROUNDING:
                    break
                step = min(step, int(np.searchsorted(-reach[order[done:]], ROUNDING - floor, side="right")))
            now = np.zeros(len(reach), bool)
            now[order[done : done + step]] = True
            done, step = done + step, step * MORE_BLOCKS
            some = np.flatnonzero(now.take(block))
            many, stop = held.take(some), end.take(some)
            rows = _ranges(stop - many, stop)
            each = np.repeat(share.take(some), many) * self._weights.take(rows)
            sums = np.bincount(self._entry.take(rows), each, minlength=size)
            sums = sums + np.where(np.repeat(now, BLOCK)[:size], dense, 0)
            hits = np.flatnonzero(sums > 0)
            if len(hits) > NEIGHBOURS:
                hits = hits[sums[hits] >= np.partition(sums[hits], -NEIGHBOURS)[-NEIGHBOURS] - ROUNDING]
            entries, cosines = np.append(entries, hits), np.append(cosines, np.minimum(sums[hits], 1.0))
            best = np.lexsort((entries, -cosines))
            entries, cosines = entries[best], cosines[best]
            if len(cosines) > NEIGHBOURS:
                kept = cosines >= cosines[NEIGHBOURS - 1] - ROUNDING
                entries, cosines = entries[kept], cosines[kept]
        return entries, cosines

    def vote(self, entries: np.ndarray, cosines: np.ndarray, own=(0.0, 0.0)) -> float:
        """The share of toxic votes, less the votes `own` of an entry equal to the query."""
        against, toxic = np.maximum(self.votes[entries].T @ cosines**SHARPNESS - own, 0)
        return float((toxic + PRIOR_WEIGHT * self.prior) / (toxic + against + PRIOR_WEIGHT))

    def calibrated(self, share: float) -> float:
        return float(1 / (1 + np.exp(-(self.slope * _logit(share) + self.offset))))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES_PER_LABEL) -> Index:
    """An index of labelled texts: `docs` (doc_id, text), `labels` (doc_id, toxic).

    About `per_label` examples of each label are drawn by a hash of the id;
    equal texts count once. Their votes are weighted so that labels weigh as in
    all of `labels`. Null labels and texts are left out; of several labels of
    a document the highest counts. Without examples every score is one half.
    All words of the examples are indexed, so the index is as large as their texts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.col("toxic") == 1, min(1.0, per_label / sizes.get(1, 1))).otherwise(
        min(1.0, per_label / sizes.get(0, 1))
    )
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    # About 2 * per_label rows of two numbers, whatever the size of the corpus.
    examples = (
        docs.where(F.col("text").isNotNull())
        .join(F.broadcast(drawn), "doc_id")
        .groupBy(F.sha2("text", 256).alias("key"))
        .agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    )

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, "text"):
            held: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for term in {t for w in set(_words(text)) for t in _terms(w)}:
                    held.setdefault(term, [0, 0])[toxic] += 1
            times = np.array(list(held.values()), np.int64).reshape(-1, 2)
            yield pd.DataFrame(
                {
                    "term": term_hashes(held).view(np.int64),
                    "word": np.array([t[0] == "=" for t in held], bool),
                    "n0": times[:, 0],
                    "n1": times[:, 1],
                }
            )

    counts = (
        examples.select("text", "toxic")
        .mapInPandas(counted, "term long, word boolean, n0 long, n1 long")
        .groupBy("term", "word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )
    drawn_sizes = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    total0, total1 = drawn_sizes.get(0, 0), drawn_sizes.get(1, 0)
    total = total0 + total1
    telling = F.lit(False)
    counts = written(counts, "terms")
    if total0 and total1:
        chance = CERTAINTY / max(1, counts.count())
        limit = NormalDist().inv_cdf(1 - chance / 2) ** 2
        a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
        c, d = total1 - a, total0 - b
        chi = total * (a * d - b * c) ** 2 / (F.greatest(F.lit(1.0), (a + b) * (c + d)) * float(total0 * total1))
        telling = chi > limit
    # The words of the drawn examples, and the beginnings that tell labels apart.
    chosen = (
        counts.select("term", (F.col("n0") + F.col("n1")).alias("n"), telling.alias("telling"), "word")
        .where(F.col("telling") | F.col("word"))
        .select("term", "n", "telling")
        .toPandas()
    )
    hashes = chosen["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    terms = hashes[order]
    idf = np.log((1 + total) / (1 + chosen["n"].to_numpy(float)[order])) + 1
    term_weights = np.where(chosen["telling"].to_numpy(bool)[order], 1.0, PLAIN_SHARE) * idf
    del chosen, hashes, order

    def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _Memo(terms)
        for batch in slices(batches, "text"):
            found = [memo.counts(text) for text in batch["text"]]
            yield batch[["doc_id", "toxic"]].assign(
                terms=[t.astype(np.int32).tobytes() for t, _ in found],
                times=[n.astype(np.int32).tobytes() for _, n in found],
            )

    vectors = written(
        examples.select("doc_id", "toxic", "text").mapInPandas(
            reduced, "doc_id long, toxic int, terms binary, times binary"
        ),
        "examples",
    )
    scale = [sizes.get(k, 0) / max(1, drawn_sizes.get(k, 0)) for k in (0, 1)]
    rows = vectors.toPandas()  # the drawn examples, 8 bytes for each of their words
    index = _indexed(
        [
            (doc, toxic, np.frombuffer(t, np.int32), np.frombuffer(n, np.int32))
            for doc, toxic, t, n in rows[["doc_id", "toxic", "terms", "times"]].itertuples(index=False)
        ],
        terms,
        term_weights,
        scale,
    )
    return _with_calibration(index, vectors, scale)


def _with_calibration(index: Index, vectors: DataFrame, scale: list[float]) -> Index:
    """The index with the curve that fits the votes of its examples best.

    Each example is scored as if it weren't in the index itself.
    """
    shared = index.shared(vectors.sparkSession)
    unit = max(scale + [1.0])

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            shares = []
            for toxic, t, n in zip(batch["toxic"], batch["terms"], batch["times"]):
                own = np.zeros(2)
                own[toxic] = scale[toxic] / unit
                if t:
                    shares.append(index.vote(*index.nearest(np.frombuffer(t, np.int32), np.frombuffer(n, np.int32)), own))
                else:
                    shares.append(index.plain)
            yield pd.DataFrame({"share": shares, "toxic": batch["toxic"]})

    got = vectors.mapInPandas(alone, "share double, toxic int").toPandas()  # two numbers for each example
    if len(got):
        toxic = got["toxic"].to_numpy(float)
        index.slope, index.offset = calibration(
            got["share"].to_numpy(), toxic, np.where(toxic > 0, scale[1], scale[0])
        )
    return index


def calibration(shares: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from votes to labels.

    Newton steps on the weighted loss, held to slope 1 and offset 0 by a prior,
    so that a few examples move the curve little.
    """
    x = np.column_stack([_logit(shares), np.ones(len(shares))])
    weights = weights * len(weights) / max(weights.sum(), 1e-9)
    start = np.array([1.0, 0.0])
    at = start.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(weights @ (np.logaddexp(0, z) - toxic * z) + CALIBRATION_PRIOR * ((w - start) ** 2).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (weights * (p - toxic)) + CALIBRATION_PRIOR * (at - start)
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + CALIBRATION_PRIOR * np.eye(2)
        move, held = np.linalg.solve(curve, slope), loss(at)
        while loss(at - move) > held + 1e-12:
            move = move / 2
        at = at - move
        if np.abs(move).max() < 1e-9:
            break
    # A falling curve would turn the order round.
    return max(float(at[0]), 0.0), float(at[1])


def _indexed(rows: list, terms: np.ndarray, term_weights: np.ndarray, scale: list[float]) -> Index:
    """`rows` are (doc_id, toxic, numbers of terms in order, times)."""
    vectors: dict[tuple[bytes, bytes], list] = {}
    plain = [0.0, 0.0]
    for doc, toxic, found, times in sorted(rows, key=lambda r: (r[0], r[1])):
        if not len(found):
            plain[toxic] += scale[toxic]
            continue
        found, times = np.asarray(found, np.int32), np.asarray(times, np.int32)
        held = vectors.setdefault(_key(found, times), [doc, toxic, found, times, [0.0, 0.0]])
        held[4][toxic] += scale[toxic]
    total = np.sum([*(v[4] for v in vectors.values()), plain], axis=0)
    prior = float(total[1] / total.sum()) if total.sum() else 0.5

    def heaviest(vector: list) -> list[int]:
        weight = (1 + np.log(vector[3])) * term_weights[vector[2]]
        return vector[2][np.argsort(-weight, kind="stable")[:3]].tolist()

    # Like vectors stand near each other, so that few blocks hold a term's best:
    # by their heaviest terms.
    entries = sorted(vectors.values(), key=lambda v: (heaviest(v), v[0], v[1]))
    none = [np.zeros(0, np.int32)]
    term = np.concatenate([v[2] for v in entries] or none)
    times = np.concatenate([v[3] for v in entries] or none)
    entry = np.repeat(np.arange(len(entries), dtype=np.int32), [len(v[2]) for v in entries])
    norms = np.array([np.sqrt((((1 + np.log(v[3])) * term_weights[v[2]]) ** 2).sum()) for v in entries])
    order = np.argsort(term, kind="stable")
    term, times, entry = term[order], times[order], entry[order]
    del order
    block = entry // BLOCK
    new = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
    return Index(
        terms,
        term_weights,
        np.array([v[4] for v in entries]).reshape(-1, 2) / max(scale + [1.0]),
        np.array([v[0] for v in entries], np.int64),
        np.array([v[1] for v in entries], np.int8),
        np.searchsorted(term[new], np.arange(len(terms) + 1)),
        block[new],
        np.diff(np.append(new, len(term))).astype(np.uint8),
        (entry % BLOCK).astype(np.uint8),
        times,
        norms,
        prior,
        (plain[1] + prior) / (sum(plain) + 1),
    )


def _key(terms: np.ndarray, times: np.ndarray) -> bytes:
    return hashlib.blake2b(terms.tobytes() + times.tobytes(), digest_size=16).digest()


def score(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, score, predicted, evidence) for each row of `docs`.

    Null texts and texts without any word of the examples get the calibrated
    share of toxic ones among such examples. `evidence` are (doc_id, similarity,
    toxic) of the nearest examples. Other columns are ignored; ids are copied as
    they are.
    """

    shared, curve = index.shared(docs.sparkSession), (index.slope, index.offset)

    @F.pandas_udf(
        "score double, predicted int, "
        "evidence array<struct<doc_id:long,similarity:double,toxic:int>>"
    )
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = shared.value
        index.slope, index.offset = curve
        memo = _Memo(index.terms)
        for batch in texts:
            found = [index.score(text, memo) for text in batch]
            scores = np.array([s for s, _ in found])
            yield pd.DataFrame(
                {
                    "score": scores,
                    "predicted": (scores >= 0.5).astype(np.int32),
                    "evidence": [
                        [{"doc_id": d, "similarity": s, "toxic": t} for d, s, t in e] for _, e in found
                    ],
                }
            )
            give_back()

    return docs.select("doc_id", scored("text").alias("s")).select("doc_id", "s.*")


class _Memo(dict):
    """The numbers of known terms of words met before."""

    def __init__(self, terms: np.ndarray) -> None:
        super().__init__()
        self.terms = terms
        self.heads: dict[str, tuple[int, ...]] = {}

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Known terms of a text in order, and how often it has them."""
        words = Counter(_words(text))
        if len(self) >= MEMO:
            self.clear()
        self._learn([w for w in words if w not in self])
        found = [self[word] for word in words]
        each = np.fromiter(chain.from_iterable(found), np.int64)
        if not len(each):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        times = np.repeat(np.fromiter(words.values(), np.int64), np.fromiter(map(len, found), np.int64))
        terms, at = np.unique(each, return_inverse=True)
        return terms, np.bincount(at, times).astype(np.int64)

    def _learn(self, words: list[str]) -> None:
        # Many words begin alike: what is known of a beginning is looked up once.
        if len(self.heads) >= MEMO:
            self.heads.clear()
        fresh = list({h for h in (w[: PREFIXES[-1]] for w in words) if h not in self.heads})
        forms = [_terms(h)[1:] for h in fresh]
        hashes = term_hashes(chain((f"={w}" for w in words), chain.from_iterable(forms)))
        at = np.searchsorted(self.terms, hashes)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == hashes[known]
        numbers = np.where(known, at, -1).tolist()
        found = iter(numbers[len(words) :])
        for head, form in zip(fresh, forms):
            self.heads[head] = tuple(t for t in islice(found, len(form)) if t >= 0)
        for word, number in zip(words, numbers):
            head = self.heads[word[: PREFIXES[-1]]]
            self[word] = (number, *head) if number >= 0 else head


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if isinstance(text, str) else []


def _terms(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]


def term_hashes(terms: Iterable[str]) -> np.ndarray:
    """64-bit hashes of terms."""
    return np.array([xxhash.xxh64_intdigest(t) for t in terms], np.uint64)


def _unit(terms: np.ndarray, times: np.ndarray, term_weights: np.ndarray) -> np.ndarray:
    """Unit vector of (1 + log count) * weight."""
    raw = (1 + np.log(times)) * term_weights[terms]
    return raw / np.sqrt((raw * raw).sum())


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each first up to, without it, its last."""
    sizes = (last - first).astype(np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)


def _logit(share: float | np.ndarray) -> float | np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))
