"""Languages of texts, word by word.

A word's script narrows the languages it may be in. Hashed character n-grams
score the word in each of them, and Viterbi finds the labels of all words that
score best if every change of language costs a penalty. Neighbouring words with
the same label are a span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_slices, slices

UNKNOWN = "und"

# The model is fitted on about this many texts of each language.
TEXTS_PER_LANGUAGE = 1500

# Text that is labelled together.
LABEL_BYTES = 1_000_000

TABLE_BITS = 15
SMOOTHING = 0.05
SWITCH = 12.0
OUTSIDE = 500.0
SCRIPT_SHARE = 0.01

# First code points of scripts, in order.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD800, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB1D, "hebrew"),
    (0xFB50, "arabic"),
    (0xFE00, "other"),
    (0xFF21, "latin"),
    (0xFF66, "kana"),
    (0x10000, "other"),
    (0x20000, "han"),
    (0x30000, "other"),
)
NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([first for first, _ in SCRIPTS])
_SCRIPT = np.array([NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class Model:
    """Languages in order, log-probabilities (n-gram slot, language), and which
    scripts each language is written in."""

    languages: list[str]
    grams: np.ndarray
    scripts: np.ndarray


def fit(labelled: DataFrame, texts: int = TEXTS_PER_LANGUAGE) -> Model:
    """A model from (text, lang) rows; rows with a null in either are left out.

    About `texts` different texts of each language are used, chosen by a hash
    of the text. Copies count once. Their number is the only thing bounded:
    each is used in full.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    different = rows.select("lang", F.xxhash64("text").alias("key")).distinct()
    counts = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(counts)
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, min(1.0, texts / counts[name])).otherwise(share)
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, "text"):
            for lang, part in batch.groupby("lang"):
                grams, scripts = held.setdefault(
                    lang, (np.zeros(1 << TABLE_BITS), np.zeros(len(NAMES)))
                )
                ids, unique = _numbered(_tokens(part["text"]))
                if not unique:
                    continue
                codes, starts, letters, script = _characters(unique)
                often = np.bincount(ids, minlength=len(unique))
                times = np.repeat(often, np.diff(np.append(starts, len(codes))))
                for slot in _slots(codes):
                    grams += np.bincount(slot[letters], times[letters], 1 << TABLE_BITS)
                scripts += np.bincount(script[letters], times[letters], len(NAMES))
        for lang, (grams, scripts) in held.items():
            yield pd.DataFrame({"lang": [lang], "counts": [np.concatenate([grams, scripts])]})

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "counts": [np.sum(rows["counts"].to_list(), axis=0)]})

    schema = "lang string, counts array<double>"
    parts = rows.where(drawn).select("text", "lang").distinct().mapInPandas(counted, schema)
    sums = {r["lang"]: np.array(r["counts"]) for r in parts.groupBy("lang").applyInPandas(summed, schema).collect()}
    size = 1 << TABLE_BITS
    nothing = np.zeros(size + len(NAMES))
    both = np.array([sums.get(name, nothing) for name in languages]).reshape(len(languages), nothing.size)
    grams, scripts = both[:, :size], both[:, size:]
    total = grams.sum(axis=1, keepdims=True)
    logs = np.log((grams + SMOOTHING) / (total + SMOOTHING * size))
    used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(languages, logs.T.astype(np.float32).copy(), used.T.copy())


def label(docs: DataFrame, model: Model, spans: bool = True) -> DataFrame:
    """`docs` with lang_pred, score and, if asked for, spans.

    `lang_pred` is the language of most letters, `und` if the text is null or
    has no letter; `score` is its share of the letters, 0 for `und`. `spans`
    are (first_word, last_word, lang), words counted from 0. Without any
    learned language everything is `und`. All columns of `docs` stay, but for
    one of these three names.
    """
    stay = [c for c in docs.columns if c not in ("lang_pred", "score", "spans")]
    names = {c: f"c{i}" for i, c in enumerate(stay)}
    return _labelled(docs.select(*[docs[c].alias(n) for c, n in names.items()], docs["text"].alias("text")), model, spans).select(
        *[F.col(n).alias(c) for c, n in names.items()], "lang_pred", "score", *(["spans"] if spans else [])
    )


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of `docs` with `least` of their letters or more in one language, unchanged."""
    names = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    labelled = _labelled(docs.select(*[docs[c].alias(n) for c, n in names.items()]), model, False)
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return labelled.where(kept).select(*[F.col(n).alias(c) for c, n in names.items()])


def _labelled(docs: DataFrame, model: Model, spans: bool) -> DataFrame:
    span = "array<struct<first_word:int,last_word:int,lang:string>>"
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if spans:
        added.append(StructType.fromDDL(f"spans {span}")["spans"])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, max_bytes=LABEL_BYTES):
            langs, scores, found = _label_texts(pd.Series(part.column("text").to_pylist(), dtype=object), model)
            made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            if spans:
                made.append(pa.array(found, pa.list_(_SPAN)))
            yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *_ADDED[: len(made)]])

    return docs.mapInArrow(labelled, StructType([*docs.schema.fields, *added]))


_ADDED = ["lang_pred", "score", "spans"]
_SPAN = pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())])


def _label_texts(texts: pd.Series, model: Model) -> tuple[list, np.ndarray, list]:
    n = len(texts)
    langs, shares, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    lists = _tokens(texts)
    ids, unique = _numbered(lists)
    if not unique or not model.languages:
        return langs, shares, spans
    scores, weight = _word_scores(unique, model)
    sizes = np.array([len(x) for x in lists])
    first = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at, k = 0, len(model.languages)
    while at < len(order):
        # Texts of like length are decoded together.
        end = at + 1
        while end < len(order) and (end + 1 - at) * int(sizes[order[end]]) * k <= 2_000_000:
            end += 1
        group = order[at:end]
        at = end
        length = int(sizes[group[-1]])
        step = np.arange(length)
        inside = step[None, :] < sizes[group][:, None]
        word = ids[np.where(inside, first[group][:, None] + step[None, :], 0)]
        paths = _viterbi(scores, word, inside)
        letters = np.where(inside, weight[word], 0)
        share = np.stack([(letters * (paths == lang)).sum(axis=1) for lang in range(k)], axis=1)
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        for row, doc in enumerate(group):
            if not total[row]:
                continue
            path = paths[row, : sizes[doc]]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
            langs[doc] = model.languages[best[row]]
            shares[doc] = share[row, best[row]] / total[row]
            spans[doc] = [
                {"first_word": int(a), "last_word": int(b) - 1, "lang": model.languages[path[a]]}
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
    return langs, shares, spans


def _viterbi(scores: np.ndarray, word: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The best language of each word, one text per row of `word`."""
    rows, length = word.shape
    best = scores[word[:, 0]].copy()
    came = np.empty((length, rows), np.int16)
    switched = np.zeros((length, rows, scores.shape[1]), bool)
    for t in range(1, length):
        top = best.argmax(axis=1)
        change = best[np.arange(rows), top][:, None] - SWITCH
        came[t], switched[t] = top, change > best
        moved = np.maximum(best, change) + scores[word[:, t]]
        best = np.where(inside[:, t][:, None], moved, best)
        switched[t][~inside[:, t]] = False
    path = np.empty((rows, length), np.int16)
    at = best.argmax(axis=1).astype(np.int16)
    every = np.arange(rows)
    for t in range(length - 1, -1, -1):
        path[:, t] = at
        if t:
            at = np.where(switched[t][every, at], came[t], at)
    return path


def _tokens(texts: pd.Series) -> list[list[str]]:
    return [t.split() if isinstance(t, str) else [] for t in texts]


def _numbered(lists: list[list[str]]) -> tuple[np.ndarray, list[str]]:
    seen: dict[str, int] = {}
    ids = [seen.setdefault(word, len(seen)) for words in lists for word in words]
    return np.array(ids, np.int64), list(seen)


def _characters(unique: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each with a line end; where words start; which
    code points are letters; the script of each."""
    lowered = [word.lower() for word in unique]
    joined = "\n".join(lowered) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(word) + 1 for word in lowered])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    present, inverse = np.unique(codes, return_inverse=True)
    alpha = np.array([chr(int(c)).isalpha() for c in present])
    letters = alpha[inverse]
    script = _SCRIPT[np.searchsorted(_FIRST, codes, side="right") - 1]
    return codes, starts, letters, script


def _slots(codes: np.ndarray) -> list[np.ndarray]:
    """Table slots of the 1-, 2- and 3-grams at each position."""
    shift = np.uint64(64 - TABLE_BITS)
    before = np.concatenate([codes[-1:], codes[:-1]])
    after = np.concatenate([codes[1:], codes[:1]])
    a, b, c = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    return [
        (((codes + np.uint64(1)) * a) >> shift).astype(np.int64),
        (((codes * b + after) * a) >> shift).astype(np.int64),
        ((((before * c + codes) * b + after) * a) >> shift).astype(np.int64),
    ]


def _word_scores(unique: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each word in each language, and its number of letters."""
    codes, starts, letters, script = _characters(unique)
    each = sum(model.grams[slot] for slot in _slots(codes)) * letters[:, None]
    scores = np.add.reduceat(each, starts, axis=0)
    weight = np.add.reduceat(letters.astype(np.int64), starts)
    used = np.zeros((len(unique), len(NAMES)), np.int64)
    owner = np.repeat(np.arange(len(unique)), np.diff(np.append(starts, len(codes))))
    np.add.at(used, (owner[letters], script[letters]), 1)
    fits = model.scripts[used.argmax(axis=1)]
    narrowed = fits.any(axis=1) & (weight > 0)
    scores = np.where(fits | ~narrowed[:, None], scores, scores - OUTSIDE)
    return scores - scores.max(axis=1, keepdims=True), weight
