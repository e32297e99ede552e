"""Quality rules with cross-document line frequency, in DataFrame functions only.

Each text is read once into a narrow table: its counts, and a hash and a word count for every normalised
line. From that table the distinct documents of each (host, line) are counted. Lines above the limits of
their host are removed, and documents that are left with too little are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.frames import spread_join, text_or_empty
from churnkit.scratch import materialize

WINDOW = 5
# Fixed values of the word and symbol definitions.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

_BREAK = r"[\x20\x09-\x0D]+"


def _without(column: Column, characters: str) -> Column:
    return F.translate(column, characters, "")


def _words(column: Column) -> Column:
    return F.filter(F.split(column, _BREAK), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row: a lambda argument is never inlined."""
    return F.transform(F.array(value), body)[0]


def _tail(array: Column, skip: int) -> Column:
    return F.slice(array, skip + 1, F.greatest(F.size(array) - skip, F.lit(0)))


def _windows(hashes: Column) -> Column:
    """Hash of each run of five word hashes, from pairs of pairs; shorter texts have none."""

    def both(a: Column, b: Column) -> Column:
        # zip_with pads the shorter side; cut to its length.
        return F.slice(F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)), 1, F.size(b))

    pairs = lambda h: both(h, _tail(h, 1))
    fours = lambda p: both(p, _tail(p, 2))
    return _let(hashes, lambda h: _let(_let(pairs(h), fours), lambda f: both(f, _tail(h, 4))))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur at least twice in the text."""

    def covered(w: Column) -> Column:
        # Windows in the order of their hashes: equal ones are neighbours.
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        places = lambda s: _let(
            F.zip_with(s, _tail(s, 1), lambda a, b: a["h"] == b["h"]),
            lambda same: F.filter(
                F.transform(s, lambda x, j: F.when(F.get(same, j) | F.coalesce(F.get(same, j - 1), F.lit(False)), x["at"])),
                lambda i: i.isNotNull(),
            ),
        )
        at = F.sort_array(_let(ordered, places))
        # A window adds five words, less those that reach into the next repeated one.
        gaps = lambda p: F.zip_with(p, _tail(p, 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        total = lambda p: F.aggregate(
            gaps(p), F.lit(0).cast("long"), lambda s, x: s + F.coalesce(x, F.lit(WINDOW))
        )
        return _let(at, total)

    # Most texts repeat nothing; distinct counting settles them.
    return _let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)),
    )


def text_counts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    hashes = F.transform(_words(text), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n"), lambda line: _without(line, SPACES) != "")
    per_word = _let(
        hashes,
        lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"), _repeat_words(_windows(h)).alias("n_repeat_words")
        ),
    )
    return {
        "_counts": per_word,
        "word_chars": F.char_length(_without(text, SPACES)).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(_without(text, SYMBOLS))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def line_marks(text: Column) -> Column:
    """(hash, words) of every line with a word: lower case, runs of white space as one space."""
    plain = lambda line: F.trim(F.regexp_replace(F.lower(line), _BREAK, " "))
    spaces = lambda p: F.char_length(p) - F.char_length(_without(p, " "))
    lines = F.filter(F.transform(F.split(text, "\n"), plain), lambda p: p != "")
    return F.transform(lines, lambda p: F.struct(F.xxhash64(p).alias("h"), (spaces(p) + 1).alias("n")))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 10,
    max_repeat_pct: int = 20,
    line_docs: int = 20,
    line_share: float = 0.02,
    min_left_pct: int = 50,
) -> DataFrame:
    """One row per input row: id, counts, base_failed, n_line_words_removed, kept.

    A line is removed where more than ``line_docs`` documents of its host hold it and they are more than
    ``line_share`` of the host's documents. A document is rejected if it fails the base rules
    (fewer than ``min_words`` words, or more than ``max_repeat_pct`` of its words in repeated five-word
    windows), or if less than ``min_words`` words or ``min_left_pct`` of its words are left.

    A null text has no words and fails. Null hosts form one host. Rows that repeat an id count as one document in
    the line counts; rows without an id are judged, but add nothing to them. An empty table gives an empty one.
    Window and line equality is that of 64-bit hashes.
    """
    text = text_or_empty(text_col)
    # A null host and any text are told apart by the first letter.
    host = F.coalesce(F.concat(F.lit("h"), F.col(host_col).cast("string")), F.lit("none"))
    read = docs.select(F.col(id_col).alias("_id"), host.alias("_host"), text.alias("_text"))
    counts = text_counts(F.col("_text"))
    measured = materialize(
        read.select("_id", "_host", *[c.alias(n) for n, c in counts.items()], line_marks(F.col("_text")).alias("_lines")),
        "lines",
    )
    lines = measured.select("_id", "_host", F.explode(F.array_distinct("_lines.h")).alias("_line"))
    frequent = (
        lines.groupBy("_host", "_line").agg(F.countDistinct("_id").alias("_docs")).where(F.col("_docs") > line_docs)
    )
    hosts = measured.groupBy("_host").agg(F.count("_id").alias("_host_docs"))
    # Both sides are a row per host or per frequent line by now.
    removed = (
        frequent.join(hosts, "_host")
        .where(F.col("_docs") > F.col("_host_docs") * F.lit(line_share))
        .groupBy("_host")
        .agg(F.collect_set("_line").alias("_removed"))
    )
    judged = spread_join(measured, removed, ["_host"], F.col("_id"), row_bytes=8 * 1024)
    gone = F.when(
        F.col("_removed").isNotNull(),
        F.aggregate(
            F.filter("_lines", lambda x: F.array_contains(F.col("_removed"), x.h)),
            F.lit(0).cast("long"),
            lambda s, x: s + x.n,
        ),
    ).otherwise(F.lit(0).cast("long"))
    n, repeats = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    failed = (n < min_words) | (100 * repeats > max_repeat_pct * n)
    left = n - F.col("n_line_words_removed")
    return judged.withColumn("n_line_words_removed", gone).select(
        F.col("_id").alias(id_col),
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeats.alias("n_repeat_words"),
        failed.alias("base_failed"),
        "n_line_words_removed",
        (~failed & (left >= min_words) & (100 * left >= min_left_pct * n)).alias("kept"),
    )
