"""Byte-pair encoding, spelling variants and vector codes against plain ways."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from amity.llm import bpe, codes, queries, spelling

PATH = public_tokenizers.path("byte_bpe_50k.json")
CLASH = "doc_id long, text string, ids string, word string, n long"


@pytest.fixture(scope="module")
def files():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ODD = [
    None,
    "",
    " ",
    "\n\n\n  x  \t y   z ",
    "it's we'll I'D 'tis ''s don't’s",
    "naïve \U0001f600\U0001f1e9\U0001f1ea café 漢字かな한글 ١٢٣ ² Ⅷ",
    "<|endoftext|>",
    "a <|endoftext|>  <|endoftext|>b<|endoftext|",
    "\x00\x01\x7f\x80͸\U00010940\U0001e4d0\U000323af�﻿",
    "x" * 5000,
    "word " * 4000,
    "".join(map(chr, range(0x20, 0x3000))),
]


def test_ids_and_texts_of_the_library(spark, files, library):
    rows = [(i, t, "a", "b", 1) for i, t in enumerate(ODD)]
    rows += [(3, ODD[3], None, None, None), (None, ODD[4], "a", "b", 1)]
    made = bpe.decode(bpe.encode(spark.createDataFrame(rows, CLASH).repartition(3), files), files)
    assert made.columns == ["doc_id", "ids", "text"]
    want = Counter()
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in made.collect()) == want
    assert bpe.encode(spark.createDataFrame([], CLASH), files).count() == 0


def test_words_between_blanks(files, library):
    rng = random.Random(8)
    cut = bpe._Cutter(files)
    marks = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "a", "é9", "'s", "!", "<|endoftext|>", "7"]
    texts = ["".join(rng.choices(marks, k=12)) for _ in range(3000)]
    words, numbers, sizes = cut.numbers([*texts, None, ""])
    assert sizes[-2:].tolist() == [0, 0] and len(numbers) == sizes.sum()
    alone = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    for text, a, b in zip(texts, np.cumsum(sizes) - sizes, np.cumsum(sizes)):
        assert "".join(words[n] for n in numbers[a:b]) == text
        assert [i for n in numbers[a:b] for i in alone[n]] == library.encode(text, add_special_tokens=False).ids


def test_known_words_decide_on_the_way_only(spark, files, monkeypatch):
    docs = spark.createDataFrame([(i, f"the same words and {i} others" * 3) for i in range(40)], "doc_id long, text string")
    before = sorted(map(str, bpe.encode(docs, files).collect()))
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    assert sorted(map(str, bpe.encode(docs, files).collect())) == before


def test_any_ids_decode_as_in_the_library(spark, files, library):
    rng = random.Random(6)
    rows = [(i, [rng.randrange(50257) for _ in range(rng.randrange(30))]) for i in range(200)]
    rows += [(200, list(range(50257))), (201, [])]
    got = dict(bpe.decode(spark.createDataFrame(rows, "text long, ids array<int>").withColumnRenamed("text", "k"), files).select("k", "text").collect())
    assert all(got[i] == library.decode(ids, skip_special_tokens=False) for i, ids in rows)
    odd = spark.createDataFrame([(0, None), (1, [None, 15, 99999999, -5])], "k int, ids array<int>")
    assert dict(bpe.decode(odd, files).select("k", "text").collect()) == {0: None, 1: "0"}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))


def counted(rows, letters=5, delete=None):
    out = Counter()
    for i, text in rows:
        for run in spelling.re.findall(spelling.RUN + "+", (text or "").encode().lower().decode()):
            if delete:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % delete == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                out[run] += 1
    return out


def near(words):
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
    out = {(a, b) for s in holes.values() for a in s for b in s if a < b}
    whole = set(words)
    for w in words:
        out |= {tuple(sorted((w, x))) for i in range(len(w)) if (x := w[:i] + w[i + 1 :]) in whole and x != w}
    return out


def test_words_are_counted_as_told(spark):
    rows = [(i, " ".join("Straße ÉCOLE×÷x naïve-abcde's fghij2klmno".split() * 3)) for i in range(300)]
    rows += [(None, "Under under UNDER"), (7, None), (8, ""), (9, "ünder" * 3000)]
    docs = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], "doc_id long, text string, n int, word string, doc long")
    for delete in (None, 7):
        got = {r.word: r.n for r in spelling.word_counts(docs, delete_one_in=delete).collect()}
        assert got == counted(rows, delete=delete)
    assert spelling.word_counts(docs.limit(0)).count() == 0


def test_near_words_against_brute_force(spark):
    rng = random.Random(4)
    words = {"".join(rng.choices("abé", k=rng.randrange(2, 9))) for _ in range(1500)}
    words |= {"a" * n for n in range(2, 20)} | {"a" * n + "b" + "a" * (12 - n) for n in range(12)}
    words |= {"".join(rng.choices("abcdefghijÿ", k=12)) for _ in range(500)}
    long = "".join(rng.choices("abcdefgh", k=3000))
    words |= {long, long[:1500] + long[1501:], "z" + long, long[:2999] + "z"}
    rows = [(w,) for w in sorted(words)]
    df = spark.createDataFrame([*rows, (None,), ("x",), ("",)], "word string").repartition(5)
    got = [(r.a, r.b) for r in spelling.near_words(df).collect()]
    assert len(got) == len(set(got)) and set(got) == near(words)
    assert spelling.near_words(df.limit(0)).count() == 0


def test_forms_and_roots(spark):
    # Ties go to the smaller word; a form needs twice the count; forms lead on to a root.
    rows = [("house", 100), ("mouse", 100), ("rouse", 40), ("hose", 30), ("hoses", 15), ("houses", 60), ("zebra", 3)]
    got = {r.word: r[1:] for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["house"] == (None, "house", 100, 4, None)
    assert got["rouse"] == ("house", "house", 40, 2, 100)
    assert got["houses"] == (None, "houses", 60, 2, None)
    assert got["hoses"] == ("houses", "houses", 15, 2, 60)
    assert got["hose"] == ("house", "house", 30, 2, 100)
    assert got["zebra"] == (None, "zebra", 3, 0, None)
    chain = [("a" * (5 + i), 3 * 2**i) for i in range(12)]
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 16}


def test_variants_of_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in counted(docs, delete=97).items() if n >= 3}
    others = defaultdict(list)
    for a, b in near(list(counts)):
        others[a].append(b)
        others[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(others[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    want = {(w, form[w], root(w), n, len(others[w]), counts.get(form[w])) for w, n in counts.items()}
    assert {tuple(r) for r in queries.QUERIES["op12_spelling_variants"](spark, sf).collect()} == want


def lloyd(rows, parts, entries, rounds):
    """Codes the plain way; `rows` are (id, integer vector) in order of id."""
    x = np.array([v for _, v in rows]).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2)
    for turn in range(rounds + 1):
        distance = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        best = distance.argmin(-1)
        if turn == rounds:
            return best, distance.min(-1).sum(-1), books
        books = np.array(
            [
                [x[best[:, p] == e, p].sum(0) // (best[:, p] == e).sum() if (best[:, p] == e).any() else books[p, e] for e in range(books.shape[1])]
                for p in range(parts)
            ]
        )


VECTORS = "vec_id long, embedding array<float>, label int, x string, code int"


@pytest.mark.parametrize("entries", [5, 64])
def test_codes_against_plain_rounds(spark, monkeypatch, entries):
    monkeypatch.setattr(codes, "BLOCK", 37)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 0.2, 8).round(3).tolist(), int(i % 3), "x", 1) for i in rng.permutation(150)]
    nan, inf = float("nan"), float("inf")
    bad = [(500, None, 1, "x", 1), (501, [None] + [0.0] * 7, 1, "x", 1), (502, [nan] * 8, None, "x", 1), (503, [-inf] * 8, 2, "x", 1)]
    left = [(504, [0.5] * 4, 1, None, 1), (505, [1e30] * 8, None, None, 1), (506, [], None, None, 1)]
    more = [(None, [0.25] * 8, None, "x", 1)] * 2
    df = spark.createDataFrame(rows + bad + left + more, VECTORS).repartition(4)
    made, books = codes.coded(df, parts=4, entries=entries)
    got = sorted(codes.with_label_error(made).collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0))
    kept = sorted(rows, key=lambda r: r[0]) + more
    whole = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, *_ in kept]
    best, error, plain = lloyd(whole, 4, entries, codes.ROUNDS)
    by_label = Counter()
    for (_, _, label, *_), e in zip(kept, error):
        by_label[label] += int(e)
    want = [(i, label, bytes(b.tolist()).hex(), int(e), by_label[label]) for (i, _, label, *_), b, e in zip(kept, best, error)]
    none = [(i, label, None, None, by_label[label]) for i, _, label, *_ in left]
    assert np.array_equal(books, plain)
    assert [tuple(r) for r in got] == sorted(want + none, key=lambda r: (r[0] is None, r[0] or 0))


def test_codes_of_few_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    made, books = codes.coded(empty)
    assert made.count() == 0 and codes.books_sha256(books) == hashlib.sha256(b"").hexdigest()
    made, books = codes.coded(spark.createDataFrame([(1, [0.1] * 16, None, "x", 1)] * 3, VECTORS))
    assert books.shape == (16, 3, 1) and {(r.code, r.error) for r in made.collect()} == {("00" * 16, 0)}
    made, _ = codes.coded(spark.createDataFrame([(1, [0.1] * 15, None, "x", 1)], VECTORS))
    assert made.first().code is None


def test_tables_of_words_are_not_broadcast(spark, monkeypatch):
    plans = []
    write = spelling.written

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(spelling, "written", written)
    # Many words share long beginnings, so there are levels with states.
    stems = [a + b + c for a in ("inter", "under") for b in ("national", "nation") for c in "abcdefghij"]
    words = [stem + end for stem in stems for end in ("", "a", "ab", "ba", "b", "bab", "s", "st", "sts", "ss")]
    df = spark.createDataFrame([(w, i % 7 + 3) for i, w in enumerate(words)], "word string, n long")
    answers = []
    for most in (0, 4_000_000):
        monkeypatch.setattr(spelling, "SENT_BYTES", most, raising=False)
        plans.clear()
        told = spelling.variants(df)
        plans.append(told._jdf.queryExecution().executedPlan().toString())
        answers.append(sorted(map(tuple, told.collect()), key=repr))
        sent = [p for p in plans if "BroadcastHashJoin" in p]
        # Only states that were measured to be few go to all tasks.
        assert len(plans) > 6 and bool(sent) == bool(most)
        assert all("u#" in p.split("BroadcastExchange")[1] and "MapInPandas" not in p for p in sent)
    assert answers[0] == answers[1] and len(answers[0]) == len(words)
