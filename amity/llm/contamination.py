"""Benchmark passages in documents, found by winnowing.

Of each text the smallest hash of k words is kept per sliding window of
positions. Two texts that share `SPAN` words keep a common hash, because the
shared span holds a whole window. Documents and benchmark meet on these hashes;
each hit is then extended word by word, and only runs of `SPAN` equal words
count. Everything is made of built-in expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 8
WINDOW = SPAN - GRAM + 1

# Benchmarks with at most this many hashes or short items are broadcast to the
# documents; beyond it both sides are shuffled.
BROADCAST_ROWS = 200_000

# A document is contaminated if a twentieth of its words or more is hit.
HIT_SHARE = 20

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_words(text: Column) -> Column:
    return words(F.translate(text, *LETTERS), GAP)


def grams(list_of_words: str) -> Column:
    """Hashes of all GRAM words in a row."""
    at = F.sequence(F.lit(1), F.size(list_of_words) - (GRAM - 1))
    return F.when(
        F.size(list_of_words) >= SPAN,
        F.transform(at, lambda i: F.xxhash64(F.slice(list_of_words, i, GRAM))),
    ).otherwise(F.array().cast("array<bigint>"))


def winnowed(hashes: str) -> Column:
    """The smallest hash of each sliding window, each once."""
    at = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
    least = F.transform(at, lambda i: F.array_min(F.slice(hashes, i, WINDOW)))
    return F.when(F.size(hashes) >= WINDOW, F.array_distinct(least)).otherwise(
        F.array().cast("array<bigint>")
    )


def hit_words(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, item_id, start, end): word positions hit, for each distinct text.

    `text_key` is md5 of the text. A window is 13 consecutive words of an item,
    or all words of a shorter item; positions run from 0, `end` is excluded.
    """
    read = docs.where(F.col("text").isNotNull()).select(F.md5("text").alias("text_key"), "text")
    items = benchmark.where(F.col("text").isNotNull()).select(
        "item_id", text_words(F.col("text")).alias("iw")
    ).distinct()
    return _long_hits(read, items).unionByName(_short_hits(read, items))


def _long_hits(read: DataFrame, items: DataFrame) -> DataFrame:
    hashed = items.select("item_id", "iw", grams("iw").alias("g"))
    hashed = hashed.select("item_id", "iw", "g", winnowed("g").alias("kept"))
    # Outer generators: Spark would put a filter on the array below them, where
    # it computes the array again, and in lambdas once for each element.
    places = hashed.select("item_id", "iw", "kept", F.posexplode_outer("g").alias("at", "gram")).where(
        F.array_contains("kept", F.col("gram"))
    ).select("gram", "item_id", *_around("iw", "i"))
    fingerprints = (
        hashed.select(F.explode_outer("kept").alias("kept_gram"))
        .where(F.col("kept_gram").isNotNull())
        .distinct()
    )

    prints = _with_words(read).select("text_key", grams("w").alias("g")).select(
        "text_key", F.explode_outer(winnowed("g")).alias("gram")
    )
    met = prints.join(
        _small(fingerprints), F.col("gram") == F.col("kept_gram"), "left_semi"
    )
    asked = met.groupBy("text_key").agg(F.collect_set("gram").alias("grams"))
    found = _of_texts(read, asked).select("text_key", "w", "grams", grams("w").alias("g"))
    hits = found.select("text_key", "w", "grams", F.posexplode_outer("g").alias("at", "gram")).where(
        F.array_contains("grams", F.col("gram"))
    ).select("text_key", "at", "gram", *_around("w", "d"))
    joined = hits.join(_small(places), "gram").where(F.col("d_mid") == F.col("i_mid"))
    left, right = _equal_run("left"), _equal_run("right")
    return joined.select(
        "text_key",
        "item_id",
        (F.col("at") - left).alias("start"),
        (F.col("at") + GRAM + right).alias("end"),
    ).where(F.col("end") - F.col("start") >= SPAN)


def _short_hits(read: DataFrame, items: DataFrame) -> DataFrame:
    """Whole items of fewer than 13 words, looked up by their longest word."""
    short = items.where(F.size("iw").between(1, SPAN - 1))
    longest = F.array_max(F.transform("iw", lambda x: F.struct(F.char_length(x).alias("n"), x.alias("x"))))
    short = short.select("item_id", "iw", longest["x"].alias("anchor"))
    if short.isEmpty():
        return short.select(
            F.lit("").alias("text_key"), "item_id", F.lit(0).alias("start"), F.lit(0).alias("end")
        )
    met = _with_words(read).select("text_key", F.explode_outer("w").alias("word")).join(
        _small(short), F.col("word") == F.col("anchor")
    )
    asked = met.groupBy("text_key").agg(F.collect_set(F.struct("item_id", "iw")).alias("items"))
    found = _of_texts(read, asked).select("text_key", "w", F.inline("items"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("w") - F.size("iw")),
        lambda i: F.slice("w", i + 1, F.size("iw")) == F.col("iw"),
    )
    starts = F.when(F.size("w") >= F.size("iw"), starts)
    return found.select(
        "text_key", "item_id", F.explode_outer(starts).alias("start"), F.size("iw").alias("n")
    ).where(F.col("start").isNotNull()).select("text_key", "item_id", "start", (F.col("start") + F.col("n")).alias("end"))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated per row of `docs`.

    Verdicts depend on the text alone, so null and repeated ids need no care; a
    null text has no words. Items with null texts or without words hit nothing.
    Null item ids are left out of the items. Other columns are ignored.
    """
    docs, benchmark = docs.select("doc_id", "text"), benchmark.select("item_id", "text")
    verdicts = _verdicts(hit_words(docs, benchmark))
    rows = docs.select(
        "doc_id",
        F.size(text_words(F.col("text"))).cast("bigint").alias("n_words"),
        F.concat(F.md5("text"), F.lit("#")).alias("key"),
    )
    n = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(verdicts, F.col("key") == F.col("hit_key"), "left").select(
        "doc_id",
        "n_words",
        n.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n > 0) & (HIT_SHARE * n >= F.col("n_words"))).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns."""
    hits = hit_words(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    hit = _verdicts(hits).select(F.col("hit_key").alias("_key"), F.col("n_hit").alias("_hit"))
    joined = docs.join(hit, F.concat(F.md5("text"), F.lit("#")) == F.col("_key"), "left")
    bad = (F.col("_hit") > 0) & (HIT_SHARE * F.col("_hit") >= F.size(text_words(F.col("text"))))
    return joined.where(~F.coalesce(bad, F.lit(False))).select(*[docs[c] for c in docs.columns])


def _verdicts(hits: DataFrame) -> DataFrame:
    """(hit_key, n_hit, items) per text, in one aggregation of its hits."""
    found = hits.groupBy("text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    walked = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("last")),
        lambda at, s: F.struct(
            (at["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at["last"]))).alias("n"),
            F.greatest(at["last"], s["end"]).alias("last"),
        ),
    )
    return found.select(
        F.concat("text_key", F.lit("#")).alias("hit_key"), walked["n"].alias("n_hit"), "items"
    )


def _small(side: DataFrame) -> DataFrame:
    """`side` marked for broadcast if it was counted to be small."""
    few = side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(side) if few else side


def _of_texts(read: DataFrame, asked: DataFrame) -> DataFrame:
    """One row per asked text with its words. Copies of a text are read once."""
    first = asked.withColumnRenamed("text_key", "asked_key")
    first = first.withColumn("asked_key", F.concat("asked_key", F.lit("#")))
    keyed = read.withColumn("key", F.concat("text_key", F.lit("#")))
    joined = keyed.join(first, F.col("key") == F.col("asked_key")).drop("key", "asked_key")
    return _with_words(joined)


def _with_words(read: DataFrame) -> DataFrame:
    """Texts travel as they are, which is half as large as their words in a list."""
    return read.withColumn("w", text_words(F.col("text"))).drop("text")


def _around(list_of_words: str, prefix: str) -> list[Column]:
    """The gram at `at`, and up to WINDOW - 1 words left (nearest first) and right of it."""
    reach = WINDOW - 1
    near = F.greatest(F.lit(0), F.col("at") - reach)
    return [
        F.slice(list_of_words, F.col("at") + 1, GRAM).alias(f"{prefix}_mid"),
        F.reverse(F.slice(list_of_words, near + 1, F.col("at") - near)).alias(f"{prefix}_left"),
        F.slice(list_of_words, F.col("at") + GRAM + 1, reach).alias(f"{prefix}_right"),
    ]


def _equal_run(side: str) -> Column:
    """How many words are equal, counted from the gram."""
    same = F.zip_with(f"d_{side}", f"i_{side}", lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")
