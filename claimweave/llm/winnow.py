"""Benchmark decontamination by winnowing.

A text's fingerprints are the lowest 5-gram hash of each run of six 5-grams, which is the leftmost one
where several are equal. Two texts that share ten words in a row share the run, so they share its
fingerprint at the same place in it: no shared window is missed. Hits are extended over the five words
on either side and compared word by word, so hash collisions don't count.

An item of fewer than ten words is one window of its own length. Those lengths present in the items
(nine at most) are matched by their whole n-gram.

Cases: null and empty texts have no words; each row has counts of its own text, rows that repeat a doc_id
with another text and rows without a doc_id included; repeated items with one id are one item; a null item
id is an item without a name; empty tables give no hits; further columns are ignored. Ties between equal hashes fall to the leftmost place
on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import bind, row_name, stored

SPAN = 10  # words of a window
GRAM = 5
RUN = SPAN - GRAM + 1  # 5-grams of a window

#: Fingerprints that are broadcast: this many and this many bytes of ids and context words at most.
BROADCAST_FINGERPRINTS = 200_000
BROADCAST_BYTES = 32 << 20


def item_words(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs of digits, letters a-z and anything beyond ASCII."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)  # ASCII only: lower() is the same and faster
    lower = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def word_count(text: Column) -> Column:
    """The number of item words, for which case doesn't matter."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.size(F.array_remove(parts, "")).cast("long")


def _row(length: int, hash_: Column, start: Column) -> Column:
    return F.struct(F.lit(length).alias("length"), hash_.alias("hash"), start.cast("int").alias("start"))


def _none() -> Column:
    return F.slice(F.array(_row(0, F.lit(0).cast("long"), F.lit(0))), 1, 0)


def winnowed(words: Column) -> Column:
    """Fingerprints: length 0, hash and start (from 1).

    Runs are ordered by the upper half of the hash, then by place, in one number, so that the lowest is the
    leftmost of equal ones.
    """

    def chosen(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.shiftleft(F.shiftright(h, 32), 32) + i)
        lowest = bind(
            placed,
            lambda keys: F.transform(
                F.sequence(F.lit(1), F.size(keys) - (RUN - 1)), lambda i: F.array_min(F.slice(keys, i, RUN))
            ),
        )
        return F.transform(
            F.array_distinct(lowest),
            lambda key: _row(0, F.get(hashes, key.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")), key.bitwiseAND(F.lit(0xFFFFFFFF)) + 1),
        )

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(words, i, GRAM))
    )
    return F.when(F.size(words) < SPAN, _none()).otherwise(bind(hashes, chosen))


def whole_grams(words: Column, length: int) -> Column:
    """All n-grams of one length below ten."""
    return F.when(F.size(words) < length, _none()).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(words) - (length - 1)),
            lambda i: _row(length, F.xxhash64(F.slice(words, i, length)), i),
        )
    )


def _context(words: Column, length: Column, start: Column) -> Column:
    """left, words: a whole n-gram, or a 5-gram with up to five words on either side and how many are before."""
    first = F.when(length > 0, start).otherwise(F.greatest(start - (SPAN - GRAM), F.lit(1)))
    size = F.when(length > 0, length).otherwise(start + SPAN - first)
    return F.struct((start - first).cast("int").alias("left"), F.slice(words, first, size).alias("words"))


def _exploded(texts: DataFrame, key: str, rows: Column) -> DataFrame:
    """The key, all words w of the text, and the fingerprints."""
    return texts.select(key, "w", F.explode(rows).alias("f")).select(key, "w", "f.*")


def item_fingerprints(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """Fingerprints of the items, and the lengths below ten that occur among them."""
    worded = items.select("item_id", item_words(F.col("text")).alias("w"))
    size = F.size("w")
    short = sorted(r[0] for r in worded.where((size > 0) & (size < SPAN)).select(size).distinct().collect())
    found = _exploded(worded.where(size >= SPAN), "item_id", winnowed(F.col("w")))
    for n in short:
        found = found.unionByName(_exploded(worded.where(size == n), "item_id", whole_grams(F.col("w"), n)))
    context = _context(F.col("w"), F.col("length"), F.col("start"))
    return found.select("item_id", "length", "hash", context.alias("context")), short


def _hit_words(doc: str, item: str, start: Column) -> Column:
    """Places of document words in windows that both contexts share around the common 5-gram."""
    d, i = F.col(doc), F.col(item)
    left = F.least(d["left"], i["left"])
    right = F.least(F.size(d["words"]) - d["left"], F.size(i["words"]) - i["left"])

    def places(same: Column) -> Column:
        whole = F.filter(
            F.sequence(F.lit(1), F.size(same) - (SPAN - 1)), lambda s: F.forall(F.slice(same, s, SPAN), lambda x: x)
        )
        spans = F.transform(whole, lambda s: F.sequence(s, s + (SPAN - 1)))
        return F.transform(F.array_distinct(F.flatten(spans)), lambda p: p + start - left - 1)

    same = F.zip_with(
        F.slice(d["words"], d["left"] - left + 1, left + right),
        F.slice(i["words"], i["left"] - left + 1, left + right),
        lambda a, b: a == b,
    )
    empty = F.slice(F.array(F.lit(0)), 1, 0)
    return F.when(left + right < SPAN, empty).otherwise(bind(same, places))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id and the places (from 1) of document words that one shared window covers.

    The items' fingerprints are broadcast while their number and their bytes, both counted before, are
    within bounds; beyond that both sides are shuffled by hash, and adaptive execution splits hot hashes.
    """
    prints, short = item_fingerprints(items)
    held = F.octet_length(F.concat_ws(" ", F.col("item_id").cast("string"), F.col("context.words")))
    n, size = prints.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    side = prints.select(
        F.col("item_id"), F.col("length").alias("l"), F.col("hash").alias("h"), F.col("context").alias("i")
    ).distinct()
    w = F.col("w")
    rows = F.concat(winnowed(w), *[whole_grams(w, k) for k in short])
    found = _exploded(docs.select("doc_id", item_words(F.col("text")).alias("w")), "doc_id", rows)
    same = (F.col("hash") == F.col("h")) & (F.col("length") == F.col("l"))
    context = _context(w, F.col("length"), F.col("start")).alias("d")
    if n <= BROADCAST_FINGERPRINTS and size <= BROADCAST_BYTES:
        # no shuffle: contexts are cut out of the texts for matches only
        joined = found.join(F.broadcast(side), same).select("doc_id", "item_id", "length", "start", context, "i")
    else:
        joined = found.select("doc_id", "length", "hash", "start", context).join(side, same)
    short_places = F.when(
        F.col("d.words") == F.col("i.words"), F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)
    ).otherwise(F.slice(F.array(F.lit(0)), 1, 0))
    places = F.when(F.col("length") > 0, short_places).otherwise(_hit_words("d", "i", F.col("start")))
    return joined.select("doc_id", "item_id", places.alias("places")).where(F.size("places") > 0)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, items with a window in it, their digest, and whether any word is hit."""
    named = docs.select("doc_id", "text", row_name().alias("row"))
    found = stored(hits(named.select(F.col("row").alias("doc_id"), "text"), items), "hits")  # read twice, made once
    words = (
        found.select("doc_id", F.explode("places").alias("p")).distinct().groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    )
    names = (
        found.select("doc_id", F.col("item_id").cast("string").alias("name"))
        .distinct()
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list("name")).alias("names"))
    )
    hit = words.join(names, "doc_id").select(F.col("doc_id").alias("__id"), "n_hit", "names")
    counted = named.select("doc_id", "row", word_count(F.col("text")).alias("n_words"))
    none = F.slice(F.array(F.lit("")), 1, 0)
    return (
        counted.join(hit, F.col("row") == F.col("__id"), "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("names", none).alias("names"),
        )
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("names").cast("long").alias("n_items"),
            F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )
