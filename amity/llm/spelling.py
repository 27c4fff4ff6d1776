"""Spelling variants: words one edit apart, found along a trie of all words.

1. All words of all texts are counted.
2. The words, forward and reversed, are sorted. What neighbours share tells how
   deep a word has company; paths down to there make the trie, a table of nodes
   and the edges that leave them. An edge with a few words behind it keeps hashes
   of their rests instead of more nodes.
3. A state is (word, position, node, edits). Without edits a word stands at its
   own prefixes. There one edit is made: a symbol of the trie instead of the
   word's, or before it. Edits in the second half of a word are made in the trie
   of words, the others in that of reversed words, so that they all are made
   deep down, where few edges leave a node. Deletions are insertions seen from
   the other word.
4. Level by level, states with one edit are joined with the nodes and follow the
   edge of their next symbol; those without such an edge end there. Where a few
   words are left, the one with an equal rest is a neighbour.

Hashes only stand for nodes and rests on the way: the pairs that are found are
compared as texts at last. There are as many levels as symbols in the longest
beginning that more than FEW words share.

Spark sizes what a Python function or an unfolded array gives by what they read,
and a table by its compressed file, many times too low here. So tables are
merged by key, and only states that were measured to be few are broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written

RUN = r"[A-Za-zÀ-ÿ]"
LETTERS = 5
TIMES = 3
RATIO = 2

# Distinct words a task holds before it sends their counts on.
HELD_WORDS = 500_000

# Up to so many words behind an edge are told by their rests.
FEW = 8

# States of a level that hold up to so many bytes are sent to all nodes.
SENT_BYTES = 4_000_000

_PRIME = (1 << 61) - 1
_BASE = 0x1D8AF06A9E3779B7 % _PRIME
_ENDS = 62


def word_counts(docs: DataFrame, letters: int = LETTERS, delete_one_in: int | None = None) -> DataFrame:
    """(word, n): how often each run of letters of `letters` or more is in all texts.

    Only A to Z are put in lower case. With `delete_one_in`, h being the crc32
    of "<doc_id>:<run>", a run with an h divisible by it loses its letter number
    h % length. A null text has no words; a null id counts as an empty one.
    """
    run = re.compile(RUN + "{%d,}" % letters)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in slices(batches, "text"):
            for doc, text in zip(batch["doc"], batch["text"]):
                if not isinstance(text, str):
                    continue
                found = Counter(run.findall(text.encode().lower().decode()))
                if not delete_one_in:
                    held.update(found)
                    continue
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_one_in == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield pd.DataFrame(held.items(), columns=["word", "n"])
                held.clear()
        yield pd.DataFrame(held.items(), columns=["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    return rows.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) for words that one inserted, deleted or replaced code point tells apart.

    `words` has distinct words of at least two code points in `word`; nulls and
    shorter ones are left out. Each pair is there once, a before b.
    """
    words = words.select("word").where(F.char_length("word") >= 2)
    both = words.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("word").alias("u")),
                F.struct(F.lit(1).alias("side"), F.reverse("word").alias("u")),
            )
        )
    )
    in_order = both.repartitionByRange("side", "u").sortWithinPartitions("side", "u")
    nodes = written(_nodes(in_order.mapInPandas(_edges, _EDGE)), "nodes")
    keyed = words.select("word", F.xxhash64("word").alias("key"))
    met = _merged(in_order.mapInPandas(_starts, _START)).join(
        nodes.where(F.size("kids") > 1), F.col("at_node") == F.col("node")
    )
    frontier = written(_edited(met), "frontier")
    found = [frontier.where("only IS NOT NULL").select("word_key", "only")]
    texts = keyed.select(F.col("key").alias("text_key"), "word")
    states = _merged(frontier.where("only IS NULL")).join(texts, F.col("word_key") == F.col("text_key")).select(
        "word_key",
        F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("u"),
        "at",
        F.col("child").alias("at_node"),
    )
    states = _merged(states)
    while True:
        frontier = written(_followed(states, nodes), "frontier")
        found.append(frontier.where("only IS NOT NULL").select("word_key", "only"))
        states = frontier.where("only IS NULL").select("word_key", "u", "at", F.col("child").alias("at_node"))
        # Fixed columns and what a row takes beside them, and the text.
        held = states.agg(F.sum(F.octet_length("u") + 100)).first()[0]
        if not held:
            break
        states = F.broadcast(states) if held <= SENT_BYTES else _merged(states)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.select(
        F.least("word_key", "only").alias("x"), F.greatest("word_key", "only").alias("y")
    ).distinct()
    of_x = keyed.select(F.col("key").alias("key_x"), F.col("word").alias("word_x"))
    of_y = keyed.select(F.col("key").alias("key_y"), F.col("word").alias("word_y"))
    named = pairs.join(_merged(of_x), F.col("x") == F.col("key_x"))
    named = named.join(_merged(of_y), F.col("y") == F.col("key_y"))
    return named.where(F.levenshtein("word_x", "word_y", 1) == 1).select(
        F.least("word_x", "word_y").alias("a"), F.greatest("word_x", "word_y").alias("b")
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the (word, n) rows.

    `form` is the near word with the largest n, of several the first in
    code-point order, if it has `ratio` times the word's n or more. `root` is
    the last form of forms, the word itself if it has none.
    """
    counts = words.select(F.col("word").alias("of"), F.col("n").alias("of_n"))
    pairs = near_words(words)
    arcs = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("left"), F.col("b").alias("right")),
                F.struct(F.col("b").alias("left"), F.col("a").alias("right")),
            )
        )
    )
    near = (
        arcs.join(_merged(counts), F.col("right") == F.col("of"))
        .groupBy("left")
        .agg(
            F.count("*").alias("n_near"),
            # Of the largest n the first word.
            F.min(F.struct((-F.col("of_n")).alias("less"), F.col("right").alias("word"))).alias("best"),
        )
    )
    most = -F.col("best.less")
    good = most >= ratio * F.col("n")
    named = written(
        words.join(_merged(near), F.col("word") == F.col("left"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(good, F.col("best.word")).alias("form"),
            F.when(good, most).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    roots = roots.select(F.col("word").alias("of"), "root")
    return named.join(_merged(roots), F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _merged(df: DataFrame) -> DataFrame:
    """`df`, to be sorted and merged by the key of its join and never broadcast."""
    return df.hint("merge")


def _roots(forms: DataFrame) -> DataFrame:
    """Forms followed to their last; each round doubles the steps taken.

    A form has a multiple of its word's n, so there are no circles and the
    rounds are few.
    """
    forms = written(forms, "roots")
    while True:
        above = forms.select(F.col("word").alias("up"), F.col("root").alias("up_root"))
        moved = written(
            forms.join(_merged(above), F.col("root") == F.col("up"), "left").select(
                "word", F.coalesce("up_root", "root").alias("root"), F.col("up_root").isNotNull().alias("moved")
            ),
            "roots",
        )
        forms = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return forms


_EDGE = (
    "node long, c string, child long, n long, rests array<struct<rest:long,only:long>>, lens long, next long"
)
_START = (
    "side int, word_key long, at int, at_node long, own string, ins_bit long, sub_bit long, "
    "ins_len long, sub_len long, ins_rest long, sub_rest long"
)


def _hash(text: str) -> int:
    """What xxhash64 of a text is in Spark."""
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def _bit(symbol: str) -> int:
    """The bit of a symbol in `next`; the end of a word is an empty one."""
    return 1 << (1 + ord(symbol) % 62 if symbol else 0)


def _length_bit(n: int) -> int:
    return 1 << min(n, _ENDS)


def _paths(batch: pd.DataFrame) -> Iterator[tuple[int, str, int, list[int]]]:
    """(side, word, depth, node of each prefix down to that depth) of sorted words.

    `depth` is how many symbols the word shares with a neighbour. The first and
    the last of a batch don't know all neighbours and are taken to the end.
    """
    sides, words = batch["side"].tolist(), batch["u"].tolist()
    shared = [
        _common(a, b) if s == t else 0 for s, t, a, b in zip(sides, sides[1:], words, words[1:])
    ]
    for i, (side, word) in enumerate(zip(sides, words)):
        edge = i == 0 or i == len(words) - 1
        depth = len(word) if edge else max(shared[i - 1], shared[i])
        node, nodes = side + 1, [side + 1]
        for symbol in word[:depth]:
            node = (node * _BASE + ord(symbol) + 1) % _PRIME
            nodes.append(node)
        yield side, word, depth, nodes


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _first_edit(side: int, length: int) -> int:
    """The first position a word is edited at: half of it is left to the other side."""
    return length // 2 if side == 0 else length - length // 2


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges that leave the nodes on the words' paths, summed up by batch."""
    for batch in batches:
        held: dict[tuple[int, str], list] = {}
        for side, word, depth, nodes in _paths(batch):
            key = _hash(word if side == 0 else word[::-1])
            # No state begins above the first place for an edit of a word that
            # is one symbol shorter or longer.
            for i in range(max(0, _first_edit(side, len(word) - 1) - 1), depth + 1):
                c = word[i : i + 1]
                kid = held.get((nodes[i], c))
                length, after = _length_bit(len(word) - i - 1 if c else 0), _bit(word[i + 1 : i + 2])
                if kid is None:
                    child = (nodes[i] * _BASE + (ord(c) + 1 if c else 0)) % _PRIME
                    held[nodes[i], c] = [child, 1, [(_hash(word[i + 1 :]), key)], length, after]
                else:
                    kid[1] += 1
                    if kid[1] <= FEW:
                        kid[2].append((_hash(word[i + 1 :]), key))
                    else:
                        kid[2] = []
                    kid[3] |= length
                    kid[4] |= after
        rows = [(node, c, *kid) for (node, c), kid in held.items()]
        yield pd.DataFrame(rows, columns=["node", "c", "child", "n", "rests", "lens", "next"])


def _nodes(edges: DataFrame) -> DataFrame:
    """(node, kids) of the nodes that two words or more pass or end at.

    A node has an edge for each symbol at most, so its kids fit a cell. Edges
    were summed up before this shuffle.
    """
    kids = (
        edges.repartition("node")
        .groupBy("node", "c")
        .agg(
            F.min("child").alias("child"),
            F.sum("n").alias("n"),
            F.when(F.sum("n") <= FEW, F.flatten(F.collect_list("rests"))).alias("rests"),
            F.bit_or("lens").alias("lens"),
            F.bit_or("next").alias("next"),
        )
    )
    kid = F.struct("c", "child", "rests", "lens", "next")
    return kids.groupBy("node").agg(F.collect_list(kid).alias("kids"), F.sum("n").alias("total")).where(
        "total > 1"
    ).drop("total")


def _starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The states without edits at which an edit can be made."""
    columns = [part.split()[0] for part in _START.split(", ")]
    for batch in batches:
        rows = []
        for side, word, depth, nodes in _paths(batch):
            length = len(word)
            key = _hash(word if side == 0 else word[::-1])
            for i in range(_first_edit(side, length), depth + 1):
                rows.append(
                    (
                        side,
                        key,
                        i,
                        nodes[i],
                        word[i : i + 1],
                        _bit(word[i : i + 1]),
                        _bit(word[i + 1 : i + 2]),
                        _length_bit(length - i),
                        _length_bit(max(0, length - i - 1)),
                        _hash(word[i:]),
                        _hash(word[i + 1 :]),
                    )
                )
        yield pd.DataFrame(rows, columns=columns)


def _goes_on(kid: Column, rest: Column, bit: Column, length: Column) -> Column:
    """Whether the rest of a word can be behind an edge."""
    told = F.exists(kid["rests"], lambda r: r["rest"] == rest)
    more = (kid["next"].bitwiseAND(bit) != 0) & (kid["lens"].bitwiseAND(length) != 0)
    return more & F.coalesce(told, F.lit(True))


def _edited(met: DataFrame) -> DataFrame:
    """States with one edit, from those without that met the edges of their node.

    A symbol equal to the next one is not inserted: it can as well be inserted
    later. A symbol is replaced by greater ones only.
    """
    inserted = F.filter(
        "kids",
        lambda k: (k["c"] != "")
        & (k["c"] != F.col("own"))
        & _goes_on(k, F.col("ins_rest"), F.col("ins_bit"), F.col("ins_len")),
    )
    replaced = F.filter(
        "kids",
        lambda k: (F.col("own") != "")
        & (k["c"] > F.col("own"))
        & _goes_on(k, F.col("sub_rest"), F.col("sub_bit"), F.col("sub_len")),
    )
    stays = F.transform(inserted, lambda k: _step(k, F.col("ins_rest"), F.col("at")))
    passes = F.transform(replaced, lambda k: _step(k, F.col("sub_rest"), F.col("at") + 1))
    return met.select("side", "word_key", F.inline(F.concat(stays, passes)))


def _followed(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """States one symbol on; those whose node has no edge for it are gone."""
    at, u = F.col("at"), F.col("u")
    own, after = F.substring(u, at + 1, F.lit(1)), F.substring(u, at + 2, F.lit(1))
    rest = F.xxhash64(F.substring(u, at + 2, F.char_length(u)))
    one = F.lit(1).cast("bigint")
    bit = F.call_function("shiftleft", one, F.when(after == "", 0).otherwise(1 + F.ascii(after) % 62))
    left = F.greatest(F.lit(0), F.char_length(u) - at - 1)
    length = F.call_function("shiftleft", one, F.least(left, F.lit(_ENDS)))
    met = states.join(nodes, F.col("at_node") == F.col("node")).select(
        "word_key", "u", "at", "kids", own.alias("own"), rest.alias("rest"), bit.alias("bit"), length.alias("length")
    )
    kids = F.filter(
        "kids",
        lambda k: (k["c"] == F.col("own")) & _goes_on(k, F.col("rest"), F.col("bit"), F.col("length")),
    )
    return met.select("word_key", "u", F.inline(F.transform(kids, lambda k: _step(k, F.col("rest"), F.col("at") + 1))))


def _step(kid: Column, rest: Column, at: Column) -> Column:
    """The word with that rest, if rests are told, or where a state goes on."""
    equal = F.filter(kid["rests"], lambda r: r["rest"] == rest)
    return F.struct(F.get(equal, F.lit(0))["only"].alias("only"), kid["child"].alias("child"), at.alias("at"))
