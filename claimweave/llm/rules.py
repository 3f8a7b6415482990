"""Quality rules as a short-circuit cascade, ordered by rejections per cost as measured on a sample.

Everything is a column expression; texts are judged whole and rows never leave the JVM. Cases: a null
or empty text has no words and is rejected; repeated rows are judged alike; an empty table gives an
empty result; other columns of the input are ignored by `quality_features` and passed through by
`apply_cascade`.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import bind, words_of

WINDOW = 8
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named test that is true for texts to reject."""

    name: str
    rejects: Column


def _neighbours_equal(rows: Column, key: str) -> Column:
    """The elements of a sorted array whose key equals that of the element before or after."""
    last = F.size(rows) - 1
    return F.filter(
        rows,
        lambda e, i: (
            ((i > 0) & (e[key] == F.get(rows, i - 1)[key])) | ((i < last) & (e[key] == F.get(rows, i + 1)[key]))
        ),
    )


def _covered(starts: Column) -> Column:
    """Words covered by windows at sorted distinct start positions."""
    return F.aggregate(
        F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, n: total + n,
    )


def repeated_words(words: Column) -> Column:
    """Number of words inside 8-word windows that occur twice or more in the text.

    Hashes find the windows that may repeat; those are compared as text, so the count is exact.
    """

    def exact(hashes: Column) -> Column:
        rows = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("k"), i.alias("p"))))

        def by_text(maybe: Column) -> Column:
            texts = F.array_sort(
                F.transform(
                    maybe,
                    lambda e: F.struct(
                        F.array_join(F.slice(words, e["p"] + 1, WINDOW), " ").alias("k"), e["p"].alias("p")
                    ),
                )
            )
            positions = bind(
                texts, lambda t: F.array_sort(F.transform(_neighbours_equal(t, "k"), lambda e: e["p"]))
            )
            return bind(positions, _covered)

        return bind(bind(rows, lambda r: _neighbours_equal(r, "k")), by_text)

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )
    whole = bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact(h)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(whole).cast("long")


def symbol_count(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long")


def worded_lines(text: Column) -> Column:
    """The lines of a text that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def stuttered_words(words: Column) -> Column:
    """Words that equal the word before them."""
    return F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))).cast("long")


def quality_features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts the rules read, of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    features = bind(
        words_of(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            stuttered_words(w).alias("n_stutter"),
        ),
    )
    lines = bind(
        worded_lines(text),
        lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("kinds")),
    )
    return docs.select(
        "doc_id",
        features.alias("f"),
        lines.alias("l"),
        word_chars(text).alias("word_chars"),
        symbol_count(text).alias("n_symbols"),
    ).select(
        "doc_id",
        "f.n_words",
        "word_chars",
        "n_symbols",
        (F.col("l.n") - F.col("l.kinds")).alias("n_dup_lines"),
        "f.n_repeat_words",
        F.col("l.n").alias("n_lines"),
        "f.n_stutter",
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


# Thresholds of the rules, as whole-number comparisons so that no rounding decides.
def _word_length(chars: Column, n: Column) -> Column:
    return (chars > 15 * n) | (chars < 2 * n)


def _symbols(symbols: Column, n: Column) -> Column:
    return 10 * symbols > n


def _lines(duplicates: Column, n: Column) -> Column:
    return 2 * duplicates > n


def _stutter(stutter: Column, n: Column) -> Column:
    return 10 * stutter > 3 * n


def text_rules(text: Column, words: Column | None = None) -> list[Rule]:
    """The rules as expressions over a whole text, each on its own, so that each can be skipped.

    `words` is the text's array of words where it is at hand.
    """
    text = F.coalesce(text, F.lit(""))
    words = words_of(text) if words is None else words
    return [
        Rule("few_words", F.size(words) < 20),
        Rule("word_length", _word_length(word_chars(text), F.size(words))),
        Rule("symbols", _symbols(symbol_count(text), F.size(words))),
        Rule(
            "duplicate_lines",
            bind(worded_lines(text), lambda x: _lines(F.size(x) - F.size(F.array_distinct(x)), F.size(x))),
        ),
        Rule("stutter", bind(words, lambda w: _stutter(stuttered_words(w), F.size(w)))),
        Rule("repeated_words", bind(words, lambda w: 100 * repeated_words(w) > 30 * F.size(w))),
    ]


def feature_rules() -> list[Rule]:
    """The same rules over the columns of `quality_features`."""
    n = F.col("n_words")
    return [
        Rule("few_words", n < 20),
        Rule("word_length", _word_length(F.col("word_chars"), n)),
        Rule("symbols", _symbols(F.col("n_symbols"), n)),
        Rule("duplicate_lines", _lines(F.col("n_dup_lines"), F.col("n_lines"))),
        Rule("stutter", _stutter(F.col("n_stutter"), n)),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 30 * n),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = 1000, repeats: int = 3) -> list[Rule]:
    """The rules by rejections per second on about `sample_rows` rows drawn from the whole table, best first.

    `docs` holds what the rules share, such as the split words; it is made once, before any rule is
    timed. A rule's cost is the least of some runs, so that compiling it doesn't count. The order
    changes how long the cascade takes, never which rows it keeps. The driver sees one number per
    rule, and a rule that rejects nothing goes by its cost.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.sample(share, seed=3).repartition(1).persist()  # a bounded number of rows, timed in one task
    try:
        if not sample.count():
            return rules
        rank = {}
        for rule in rules:
            counted = sample.agg(F.sum(rule.rejects.cast("int")))
            cost = math.inf
            for _ in range(repeats):
                start = time.perf_counter()
                hits = counted.first()[0] or 0
                cost = min(cost, time.perf_counter() - start)
            rank[rule.name] = (-hits / cost, cost)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda r: rank[r.name])


def measured_order(docs: DataFrame, sample_rows: int) -> dict[str, int]:
    """The place of each text rule in the cascade."""
    shared = docs.select("text", words_of(F.col("text")).alias("words"))
    return {r.name: i for i, r in enumerate(order_rules(shared, text_rules(F.col("text"), F.col("words")), sample_rows))}


def verdict(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules aren't evaluated then."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(rule.rejects, F.lit(rule.name)).otherwise(found)
    return found


def apply_cascade(docs: DataFrame, sample_rows: int = 1000) -> DataFrame:
    """The rows that no rule rejects, with their columns unchanged."""
    text = F.col("text")
    place = measured_order(docs, sample_rows)

    def first_rejection(words: Column) -> Column:
        return verdict(sorted(text_rules(text, words), key=lambda r: place[r.name]))

    return docs.where(bind(words_of(text), first_rejection).isNull())


def quality(docs: DataFrame, sample_rows: int = 1000) -> DataFrame:
    """Counts, base verdict and the cascade's verdict of every document.

    `rejected_by` is the first rule of the measured order that rejects; with several it depends on the
    measured costs, `kept` does not.
    """
    text = docs.select("doc_id", "text")
    place = measured_order(text, sample_rows)
    rules = sorted(feature_rules(), key=lambda r: place[r.name])
    return quality_features(text).select(
        "*", base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"), verdict(rules).alias("rejected_by")
    ).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
