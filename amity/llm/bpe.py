"""Byte-pair encoding and decoding through a table of distinct words.

A tokenizer of the `tokenizers` library cuts a text into words and encodes each
of them alone, so a word has the same ids wherever it stands. A blank before
anything but white space begins a word whatever is before it; texts are cut
there first, and what lies between two such blanks is cut into words once.

1. Texts are cut into words batch by batch. What stays of a batch is which word
   stands where, as numbers.
2. The distinct words of all batches make one table, dealt over buckets by a hash
   of the word. Each of its words is encoded once. A batch asks a bucket for all
   its words there in one row, since a row per word would be mostly overhead.
   Buckets are as many as the corpus is long, so that one fits a task.
3. The ids go back to the batches that asked, and are set in by position.

Words that a bounded sample of documents has more than once would be asked for
by every batch. They are a table of their own of bounded size, encoded once as
well and sent to all tasks. A word has the same ids in either table, so the
sample decides on the way only.

Decoding joins ids to their pieces, bytes that are set together and read as
UTF-8. The table of pieces is as large as the vocabulary.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .common import arrow_slices, give_back, shuffle_partitions

# Words that occur more than once in about so many documents, at most so many.
SAMPLED_DOCS = 8000
KNOWN_WORDS = 1 << 17

BATCH_CHARS = 2_000_000

# Text whose rarer words make about one bucket.
BUCKET_CHARS = 1 << 26

_BATCH = "batch long, docs array<long>, sizes binary, seq binary, known binary, lengths binary, words binary"


@dataclass
class Files:
    """What a tokenizer file says: its text, its cutting pattern, its added tokens."""

    text: str
    pattern: str
    added: list[str]

    def tokenizer(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_str(self.text)
        made.no_truncation()
        made.no_padding()
        return made


def load(path: str) -> Files:
    """The byte-level BPE tokenizer in a file of the `tokenizers` library.

    Tokenizers that change texts before they cut them, or cut them in another
    way, are refused: for them a word is not encoded alone.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    told = json.loads(text)
    cut = told["pre_tokenizer"] or {}
    plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"])
    if (
        told["model"]["type"] != "BPE"
        or told["model"].get("dropout")
        or told["normalizer"]
        or cut.get("type") != "ByteLevel"
        or cut.get("add_prefix_space")
        or not cut.get("use_regex", True)
        or (told["decoder"] or {}).get("type") != "ByteLevel"
        or not plain
    ):
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    # Truncation and padding are not used.
    told |= {"truncation": None, "padding": None}
    added = sorted((t["content"] for t in told["added_tokens"]), key=len, reverse=True)
    return Files(json.dumps(told), _pattern(), added)


@cache
def _pattern() -> str:
    """The cutting pattern of byte-level tokenizers, with all classes spelled out.

    Python and the library may follow different versions of Unicode, so the
    library itself is asked which characters are letters, numbers and space.
    """
    from tokenizers import Regex, pre_tokenizers

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))

    def members(name: str) -> str:
        out, at = [], 0
        others = pre_tokenizers.Split(Regex(f"{name}+"), "removed").pre_tokenize_str(every)
        for first, end in [*(place for _, place in others), (len(points), len(points))]:
            if first > at:
                out.append(f"\\U{points[at]:08x}-\\U{points[first - 1]:08x}")
            at = end
        return "".join(out)

    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    # Fixed value: the public cutting pattern; the words of letters may come
    # first, since no other alternative begins as they do.
    return (
        f" ?[{letter}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{number}]+"
        f"| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class _Pieces(dict):
    """Numbers of what stands between blanks, in order of appearance.

    What a text begins with is no piece after a blank; it is kept as a tuple.
    """

    def __missing__(self, piece: str | tuple[str]) -> int:
        self[piece] = number = len(self)
        return number


class _Cutter:
    """Words of texts by number, words being numbered as they come."""

    def __init__(self, files: Files) -> None:
        self.words = re.compile(files.pattern).findall
        self.names = set(files.added)
        self.added = re.compile("|".join(map(re.escape, files.added))) if files.added else None
        self.apart = re.compile(r" (?=\S)").split
        # Python's white space has all of the library's.
        self.wide = re.compile(r" \s| $").search

    def numbers(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words of some texts, which of them stand where, words per text."""
        pieces = _Pieces()
        runs, sizes = [], np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            for part in self._parts(text) if isinstance(text, str) else ():
                runs.append(np.fromiter(map(pieces.__getitem__, part), np.int64, len(part)))
                sizes[row] += len(part)
        seen: dict[str, int] = {}
        found, each = [], np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            whole = piece[0] if isinstance(piece, tuple) else " " + piece
            cut = [whole] if whole in self.names else self.words(whole)
            found += [seen.setdefault(w, len(seen)) for w in cut]
            each[i] = len(cut)
        piece = np.concatenate([np.zeros(0, np.int64), *runs])
        per_text = np.bincount(np.repeat(np.arange(len(texts)), sizes), each[piece], len(texts)).astype(np.int64)
        return list(seen), _gathered(np.array(found, np.int64), np.cumsum(each) - each, each, piece), per_text

    def _parts(self, text: str) -> Iterator[list]:
        at = 0
        for hit in self.added.finditer(text) if self.added else ():
            yield self._plain(text[at : hit.start()])
            yield [(hit.group(),)]
            at = hit.end()
        yield self._plain(text[at:])

    def _plain(self, text: str) -> list:
        pieces = self.apart(text) if self.wide(text) else text.split(" ")
        pieces[0] = (pieces[0],)
        return pieces


def _gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `first`, `size` long, in the order of `which`."""
    each = size[which]
    ends = np.cumsum(each)
    return flat[np.repeat(first[which] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]


def _encoded(files: Files, words: list[str], tokenizer=None) -> list[bytes]:
    # The library's results take over a kilobyte a word, so a few are made at a time.
    made = tokenizer or files.tokenizer()
    return [
        np.array(e.ids, np.int32).tobytes()
        for at in range(0, len(words), 4096)
        for e in made.encode_batch(words[at : at + 4096], add_special_tokens=False)
    ]


def known_words(docs: DataFrame, files: Files, total: int) -> tuple[list[str], list[bytes]]:
    """Words that occur more than once in a sample of `total` documents, and their ids.

    The most frequent first, ties in order of the word, at most KNOWN_WORDS.
    """
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < min(1.0, SAMPLED_DOCS / max(1, total)) * (1 << 20)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _Cutter(files)
        for rows in arrow_slices(batches, max_bytes=BATCH_CHARS):
            words, seq, _ = cut.numbers(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"word": words, "n": np.bincount(seq, minlength=len(words))})

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = files.tokenizer()
        for batch in batches:
            yield batch.assign(ids=_encoded(files, batch["word"].tolist(), tokenizer))

    sample = docs.where(F.col("text").isNotNull()).where(drawn).select("text")
    counts = sample.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    most = counts.where("n > 1").orderBy(F.desc("n"), "word").limit(KNOWN_WORDS)
    # A bounded number of words, encoded in tasks.
    rows = most.mapInPandas(encoded, "word string, n long, ids binary").toPandas().sort_values(
        ["n", "word"], ascending=[False, True]
    )
    return rows["word"].tolist(), [bytes(x) for x in rows["ids"]]


def encode(docs: DataFrame, files: Files) -> DataFrame:
    """(doc_id, ids) for each row of `docs`: the ids of the whole text.

    The same ids as the library's `encode` with add_special_tokens=False gives;
    added tokens in a text get their own ids. A null text is empty, an empty
    one has no ids. Repeated rows and null ids stay, each with the ids of its
    own text. Columns beside doc_id and text are ignored. A text must fit a
    cell, and so must its ids.
    """
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars")).first()
    known, known_ids = known_words(docs, files, size["n"])
    buckets = max(shuffle_partitions(docs.sparkSession), size["chars"] // BUCKET_CHARS + 1)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _Cutter(files)
        place = {word: i for i, word in enumerate(known)}
        none = len(known)
        task = TaskContext.get().partitionId() << 32
        for turn, rows in enumerate(arrow_slices(batches, max_bytes=BATCH_CHARS)):
            words, seq, sizes = cut.numbers(rows.column("text").to_pylist())
            # Known words come first, in order of their number, which is that of
            # their frequency: small numbers are frequent and pack well.
            at = np.array([place.get(w, none) for w in words], np.int64)
            order = np.argsort(at, kind="stable")
            rank = np.empty(len(words), np.int32)
            rank[order] = np.arange(len(words), dtype=np.int32)
            lengths, cold = _blobs([words[i].encode() for i in order[np.count_nonzero(at < none) :]])
            made = {
                "batch": [task | turn],
                "docs": [rows.column("doc_id").cast(pa.int64()).to_pylist()],
                "sizes": [sizes.astype(np.int32).tobytes()],
                "seq": [_packed(rank[seq])],
                "known": [_packed(np.diff(np.sort(at[at < none]), prepend=0))],
                "lengths": [lengths],
                "words": [cold],
            }
            yield pa.RecordBatch.from_pydict(made)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, lengths, words in zip(*(rows.column(c).to_pylist() for c in ("batch", "lengths", "words"))):
                word = _words(lengths, words)
                bucket = packed.bucket_of(packed.word_hashes(word), buckets)
                order = np.argsort(bucket, kind="stable")
                first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                made = [
                    (int(bucket[at[0]]), batch, _packed(at), *_blobs([word[i] for i in at]))
                    for at in np.split(order, first[1:])
                    if len(at)
                ]
                columns = ["bucket", "batch", "place", "lengths", "words"]
                yield pa.RecordBatch.from_pandas(pd.DataFrame(made, columns=columns), _ASK, False)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = files.tokenizer()
        held: list[dict] = []
        for rows in batches:
            for i in range(rows.num_rows):
                row = rows.slice(i, 1).to_pylist()[0]
                # Rows come by bucket.
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from _answers(held, files, tokenizer)
                    held = []
                    give_back()
                held.append(row)
        if held:
            yield from _answers(held, files, tokenizer)
        held.clear()
        give_back()

    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in known_ids])]).astype(np.int64)
    flat = np.frombuffer(b"".join(known_ids), np.int32)

    def set_in(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"doc_id": pd.Series([], dtype="Int64"), "ids": []})
        give_back()
        row = rows.iloc[0]
        at = np.cumsum(_unpacked(row["known"]))
        # Ids of all words of the batch: the known ones, then the answers.
        none = [np.zeros(0, np.int64)]
        place = np.concatenate([*map(_unpacked, answers["place"]), *none])
        told = np.concatenate([*map(_unpacked, answers["sizes"]), *none])
        ids = np.concatenate([flat, *map(_unpacked, answers["ids"])])
        first, size = np.empty(len(at) + len(place), np.int64), np.empty(len(at) + len(place), np.int64)
        first[: len(at)], size[: len(at)] = starts[at], starts[at + 1] - starts[at]
        first[len(at) + place], size[len(at) + place] = len(flat) + np.cumsum(told) - told, told
        seq = _unpacked(row["seq"])
        token = _gathered(ids, first, size, seq)
        ends = np.concatenate([[0], np.cumsum(size[seq])])
        cuts = ends[np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int32))])]
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row["docs"]], "Int64"),
                "ids": [token[a:b] for a, b in zip(cuts[:-1], cuts[1:])],
            }
        )

    # Both uses below read this shuffle, so that texts are cut once.
    batches = docs.mapInArrow(split, _BATCH).repartition("batch")
    asks = batches.mapInArrow(asked, "bucket int, batch long, place binary, lengths binary, words binary")
    table = asks.repartition("bucket").sortWithinPartitions("bucket")
    answers = table.mapInArrow(answered, "batch long, place binary, sizes binary, ids binary")
    return (
        batches.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInPandas(set_in, "doc_id long, ids array<int>")
    )


_ASK = pa.schema(
    [
        ("bucket", pa.int32()),
        ("batch", pa.int64()),
        ("place", pa.binary()),
        ("lengths", pa.binary()),
        ("words", pa.binary()),
    ]
)
_ANSWER = pa.schema(
    [("batch", pa.int64()), ("place", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())]
)


def _answers(asks: list[dict], files: Files, tokenizer) -> Iterator[pa.RecordBatch]:
    """Ids for all that asked a bucket; each distinct word in it is encoded once."""
    number: dict[bytes, int] = {}
    places = [
        np.array([number.setdefault(w, len(number)) for w in _words(row["lengths"], row["words"])], np.int64)
        for row in asks
    ]
    encoded = _encoded(files, [w.decode() for w in number], tokenizer)
    size = np.array([len(x) // 4 for x in encoded], np.int64)
    flat = np.frombuffer(b"".join(encoded), np.int32)
    first = np.cumsum(size) - size
    made = [
        (row["batch"], row["place"], _packed(size[at]), _packed(_gathered(flat, first, size, at)))
        for row, at in zip(asks, places)
    ]
    yield pa.RecordBatch.from_pandas(pd.DataFrame(made, columns=_ANSWER.names), _ANSWER, False)


def _blobs(words: list[bytes]) -> tuple[bytes, bytes]:
    """The lengths of words, and the words."""
    lengths = np.array([len(w) for w in words], np.int64)
    return _packed(lengths), zstandard.ZstdCompressor(level=1).compress(b"".join(words))


def _words(lengths: bytes, words: bytes) -> list[bytes]:
    ends = np.cumsum(_unpacked(lengths)).tolist()
    text = zstandard.ZstdDecompressor().decompress(words)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def pieces(files: Files) -> list[bytes]:
    """The bytes of each id; ids that a vocabulary leaves out have none."""
    told = json.loads(files.text)
    # Fixed rule: printable bytes stand for themselves, the others follow in order from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    names = told["model"]["vocab"] | {t["content"]: t["id"] for t in told["added_tokens"]}
    out = [b""] * (max(names.values(), default=-1) + 1)
    for name, i in names.items():
        known = all(c in byte for c in name)
        out[i] = bytes(byte[c] for c in name) if known else name.encode()
    return out


def decode(tokens: DataFrame, files: Files) -> DataFrame:
    """`tokens` with `text`, what its `ids` stand for; special tokens included.

    The same text as the library's `decode` with skip_special_tokens=False
    gives: bytes that are no UTF-8 become U+FFFD, ids without a piece nothing.
    Null ids give a null text, null members nothing. All columns stay, but for
    one named `text`. Only built-in functions: no Python workers.
    """
    # As many as the vocabulary has, whatever there is to decode. A byte travels
    # as the character of its number; the table is folded into the plan once.
    table = F.from_json(F.lit(json.dumps([p.decode("latin-1") for p in pieces(files)])), "array<string>")
    joined = F.array_join(F.transform("ids", lambda i: F.get(table, i)), "")
    text = F.make_valid_utf8(F.encode(joined, "ISO-8859-1").cast("string"))
    return tokens.select(*[c for c in tokens.columns if c != "text"], text.alias("text"))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, in few bytes."""
    width = np.uint16 if numbers.max(initial=0) < 1 << 16 else np.uint32
    # High and low bytes apart: the high ones are nearly all alike.
    raw = numbers.astype(width).view(np.uint8).reshape(-1, np.dtype(width).itemsize).T
    return bytes([raw.shape[0]]) + zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return raw.T.copy().view(f"u{data[0]}").reshape(-1).astype(np.int64)
