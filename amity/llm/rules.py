"""Quality rules: counts within a text, and lines that many documents of a host share.

Everything is made of built-in expressions, joins and aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"

# A line is removed if more documents of its host than this have it.
LINE_DOCS = 20

# A document is depleted if more than this share of its words is in such lines.
MAX_LOSS = 0.5

# Up to this many repeated windows of a text are looked up in a list; texts
# with more are sorted instead. Both ways give the same number.
LISTED_WINDOWS = 64

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_counts(docs: DataFrame) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Null texts count as empty. `n_dup_lines` are lines with a word that equal
    an earlier one; `n_repeat_words` are words inside windows of three words
    that occur twice or more in the text, first occurrences included. All columns
    stay, but for those of one of these five names.
    """
    stay = [c for c in docs.columns if c not in COUNTS]
    text = F.coalesce("text", F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))
    ready = docs.select(
        *[docs[c] for c in stay],
        words(F.col("text")).alias("_words"),
        full.alias("_lines"),
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).alias("_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).alias("_symbols"),
    )
    n = F.size("_words")
    windows = F.transform(
        F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.slice("_words", i, 3))
    )
    nothing = F.array().cast("array<bigint>")
    counted = ready.select(
        *stay,
        n.cast("bigint").alias("n_words"),
        F.col("_chars").cast("bigint").alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n >= 4, windows).otherwise(nothing).alias("_windows"),
    )
    repeated = counted.select(
        "*",
        F.when(
            F.size("_windows") > F.size(F.array_distinct("_windows")),
            F.sort_array("_windows"),
        ).otherwise(nothing).alias("_sorted"),
    ).select(
        "*",
        F.expr("array_distinct(filter(_sorted, (x, i) -> i > 0 AND x = get(_sorted, i - 1)))").alias("_twice"),
    ).drop("_sorted")
    placed = repeated.select(
        "*",
        F.when(
            F.size("_twice") > LISTED_WINDOWS,
            F.expr("array_sort(transform(_windows, (x, i) -> struct(x AS h, i AS i)))"),
        ).alias("_placed"),
    )
    at = F.expr(
        f"""CASE WHEN size(_twice) = 0 THEN array()
            WHEN size(_twice) <= {LISTED_WINDOWS} THEN
              filter(sequence(0, size(_windows) - 1), i -> array_contains(_twice, get(_windows, i)))
            ELSE array_sort(transform(filter(_placed, (x, k) ->
              coalesce(get(_placed, k - 1).h = x.h, false) OR
              coalesce(get(_placed, k + 1).h = x.h, false)), x -> x.i)) END"""
    )
    found = placed.select("*", at.alias("_at")).drop("_windows", "_twice", "_placed")
    covered = F.expr(
        """aggregate(_at, struct(0L AS n, -3 AS last),
             (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)"""
    )
    return found.select("*", covered.alias("n_repeat_words")).drop("_at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def normal_line(line: Column) -> Column:
    """A line in lower case, with single blanks and every number as 0."""
    one = F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " ")
    return F.regexp_replace(F.trim(one), "[0-9]+", "0")


def host_lines(docs: DataFrame) -> DataFrame:
    """(host, text_key, doc, line, n) for each line with a word; n counts its words.

    `doc` is the id, or what stands for the text if there is none.
    """
    entry = F.transform(
        F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD)),
        lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line"), F.size(words(x)).alias("n")),
    )
    # The outer form keeps Spark from testing the array before it is made.
    doc = F.coalesce("doc_id", F.xxhash64("text")).alias("doc")
    return docs.select(*_keys(), doc, F.inline_outer(entry)).where(F.col("line").isNotNull())


def frequent_lines(lines: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, line) of the lines that more than `line_docs` documents of their host have.

    Every document counts, copies too, and counts once however often it has the
    line. The limit is the same for a host of any size.
    """
    counts = lines.groupBy("host", "line").agg(F.count_distinct("doc").alias("n_docs"))
    return counts.where(F.col("n_docs") > line_docs).select("host", "line")


def depleted_texts(docs: DataFrame, lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(host, text_key, lost): words in frequent lines, for texts that have any."""
    # Keys made anew on both sides let adaptive execution split a crowded line.
    marks = frequent.select(
        F.concat("host", F.lit(" ")).alias("mark_host"), F.bitwise_not("line").alias("mark_line")
    )
    same = (F.concat("host", F.lit(" ")) == F.col("mark_host")) & (
        F.bitwise_not("line") == F.col("mark_line")
    )
    lost = (
        lines.join(marks, same, "left_semi")
        .groupBy("host", "text_key")
        .agg(F.sum("n").alias("lost"))
    )
    # Copies of a text all add the same, so their sum is shared out again.
    copies = docs.select(*_keys()).groupBy("host", "text_key").agg(F.count("*").alias("copies"))
    return copies.join(lost, ["host", "text_key"]).select(
        "host", "text_key", (F.col("lost") / F.col("copies")).cast("bigint").alias("lost")
    )


def judged(docs: DataFrame) -> DataFrame:
    """doc_id with the counts, base_failed, n_lost_words and kept.

    A null source is a host of its own with an empty name. Rows with equal ids
    are judged each by its own text; null ids stay. Columns beside doc_id, text
    and source are ignored.
    """
    docs = docs.select("doc_id", "text", "source")
    lines = host_lines(docs)
    lost = depleted_texts(docs, lines, frequent_lines(lines))
    lost = lost.select(
        F.concat("host", F.lit(" ")).alias("lost_host"),
        F.bitwise_not("text_key").alias("lost_text"),
        "lost",
    )
    counted = with_counts(docs).select("*", *_keys()).drop("text", "source")
    same = (F.concat("host", F.lit(" ")) == F.col("lost_host")) & (
        F.bitwise_not("text_key") == F.col("lost_text")
    )
    n_lost = F.coalesce("lost", F.lit(0)).cast("bigint")
    return counted.join(lost, same, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        n_lost.alias("n_lost_words"),
        (~base_failed() & (n_lost <= MAX_LOSS * F.col("n_words"))).alias("kept"),
    )


def without_frequent_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the frequent lines taken out of `text`; other columns stay.

    Line order stays; a null text stays null.
    """
    lines = host_lines(docs)
    marks = frequent_lines(lines).select(
        F.concat("host", F.lit(" ")).alias("mark_host"), F.bitwise_not("line").alias("mark_line")
    )
    same = (F.concat("host", F.lit(" ")) == F.col("mark_host")) & (
        F.bitwise_not("line") == F.col("mark_line")
    )
    drop = (
        lines.join(marks, same, "left_semi")
        .groupBy("host", "text_key")
        .agg(F.collect_set("line").alias("_drop"))
        .select(
            F.concat("host", F.lit(" ")).alias("_host"),
            F.bitwise_not("text_key").alias("_text"),
            "_drop",
        )
    )
    host, key = _keys()
    joined = docs.join(
        drop,
        (F.concat(host, F.lit(" ")) == drop["_host"]) & (F.bitwise_not(key) == drop["_text"]),
        "left",
    )
    stays = F.filter(
        F.split(docs["text"], "\n"),
        lambda x: ~x.rlike(HAS_WORD) | ~F.array_contains(drop["_drop"], F.xxhash64(normal_line(x))),
    )
    text = F.when(drop["_drop"].isNull(), docs["text"]).otherwise(F.array_join(stays, "\n"))
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def _keys() -> tuple[Column, Column]:
    return F.coalesce("source", F.lit("")).alias("host"), F.xxhash64("text").alias("text_key")
