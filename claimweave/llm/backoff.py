"""Stupid-backoff scores of documents under n-grams of the corpus, computed by joins and sums.

Tokens are those of a byte-level BPE vocabulary below 65,536 entries, so an n-gram of up to three is one whole
number and no hash collides. A document isn't scored by its own text: its own occurrences are taken off
every count, so c(..) below is the corpus count less the document's. For a token w after u v, at order three:

    c(u v w) / c(u v)                       if that n-gram is found outside the document, else
    backoff * c(v w) / c(v)                 if that one is, else
    backoff^2 * (c(w) + 1) / (N + V)        with N less the tokens of the doc_id.

At order two the chain begins with c(v w) / c(v), with one factor less. A token with fewer before it begins with the
n-gram it has; a document's first one scores backoff * (c(w) + 1) / (N + V).

Three steps. N-gram counts: exploded n-grams, combined before the shuffle, summed by n-gram and stored; at
order three the counts of a trigram's two bigrams are joined to it, where one bigram has V trigrams at most.
Head: the longest n-grams above one in HEAD of all tokens, fewer than HEAD rows an order by that definition, and the
unigrams, V rows at most, are broadcast; no other n-gram can make a hot key. Tail: the documents' other n-grams, each
once with its number, join the count table, both partitioned by hash, and sums per document combine before
their shuffle.

Cases: a null or empty text has no tokens, and score null; repeated rows of one doc_id are scored apart
and summed; null doc_ids are scored together as one; very long texts are scored whole; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.bpe import encoder_for, read_ranks
from claimweave.llm.common import map_batches, stored

HEAD = 262_144
BACKOFF = 0.4
SLICE = 256  # documents that a task counts together
TRIGRAM = 1 << 48  # added to the 48 bits of a trigram; below it lie the 32 bits of bigrams
PAIR = 0xFFFFFFFF


def tokenised(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the text's tokens, two bytes each, stored: both passes read them."""
    make_encoder = encoder_for(docs.sparkSession, ranks_path, pattern)

    def make():
        encode = make_encoder().encode

        def apply(rows):
            return {
                "doc_id": rows["doc_id"],
                "tokens": [np.array(encode(t or ""), dtype="<u2").tobytes() for t in rows["text"]],
            }

        return apply

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_batches(docs.select("doc_id", "text"), make, f"doc_id {kind}, tokens binary", rows=SLICE)
    return stored(found, "tokens")


def _over_slices(tokens: DataFrame, emit, schema: str) -> DataFrame:
    """emit(doc places, tokens, doc ids, sizes) over slices of documents; a place is that of a token's document."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                own = [np.frombuffer(t, dtype="<u2").astype(np.int64) for t in part.column(1).to_pylist()]
                sizes = np.array([len(x) for x in own])
                yield from emit(np.repeat(np.arange(len(own)), sizes), np.concatenate(own), part.column(0), sizes)

    return tokens.mapInArrow(run, schema)


def _bigrams(place: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of each document, one after another, and the places of their documents."""
    inside = place[1:] == place[:-1]
    return ((tokens[:-1] << 16) | tokens[1:])[inside], place[1:][inside]


def _trigrams(place: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of each document, without TRIGRAM, and the places of their documents."""
    inside = place[2:] == place[:-2]
    return ((tokens[:-2] << 32) | (tokens[1:-1] << 16) | tokens[2:])[inside], place[2:][inside]


class _Counts:
    """How often each document of a slice has an n-gram of up to 48 bits."""

    def __init__(self, place: np.ndarray, grams: np.ndarray):
        self.found, self.n = np.unique((place << 48) | grams, return_counts=True)

    def of(self, place: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """For n-grams that the documents have."""
        return self.n[np.searchsorted(self.found, (place << 48) | grams)]


class _Tokens:
    """How often each document has a token: what its bigrams begin with, and its last token once more."""

    def __init__(self, bigrams: _Counts, last_place: np.ndarray, last: np.ndarray):
        first = bigrams.found >> 16
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        self.found = np.append(first[starts], 1 << 62)
        self.n = np.append(np.add.reduceat(bigrams.n, starts) if len(starts) else bigrams.n, 0)
        keys = (last_place << 32) | last
        at = np.searchsorted(self.found, keys)
        self.n[at[self.found[at] == keys]] += 1

    def of(self, place: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """For tokens that the documents have: one that begins no bigram is found once, at the end."""
        keys = (place << 32) | tokens
        at = np.searchsorted(self.found, keys)
        return np.where(self.found[at] == keys, self.n[at], 1)


def ngram_counts(tokens: DataFrame, order: int = 2) -> DataFrame:
    """ngram, n over all documents: tokens below 0 as -1 - token, bigrams u * 65536 + w, trigrams above TRIGRAM."""

    def emit(place, tokens, _ids, _sizes):
        grams = [_bigrams(place, tokens)[0], -1 - tokens]
        if order == 3:
            grams.append(TRIGRAM | _trigrams(place, tokens)[0])
        found, n = np.unique(np.concatenate(grams), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["ngram", "n"])

    counts = _over_slices(tokens, emit, "ngram long, n long")
    return counts.groupBy("ngram").agg(F.sum("n").alias("n"))


def _chains(counts: DataFrame, order: int) -> DataFrame:
    """g, total of bigrams and trigrams, at order three with the counts of a trigram's first and last two tokens."""
    if order == 2:
        return counts.where("ngram >= 0").select(F.col("ngram").alias("g"), F.col("n").alias("total"))
    two = counts.where(f"ngram >= 0 AND ngram < {TRIGRAM}")
    three = counts.where(f"ngram >= {TRIGRAM}").select(F.col("ngram").alias("g"), F.col("n").alias("total"))
    first = two.select(F.col("ngram").alias("first"), F.col("n").alias("context"))
    last = two.select(F.col("ngram").alias("last"), F.col("n").alias("shorter"))
    pair = F.lit(PAIR).cast("long")
    three = three.join(first, F.shiftright("g", 16).bitwiseAND(pair) == F.col("first"))
    three = three.join(last, F.col("g").bitwiseAND(pair) == F.col("last")).select("g", "total", "context", "shorter")
    none = F.lit(None).cast("long")
    two = two.select(F.col("ngram").alias("g"), F.col("n").alias("total"), none.alias("context"), none.alias("shorter"))
    return stored(three.unionAll(two), "chains")


def scores(
    docs: DataFrame, ranks_path: str, pattern: str, head: int = HEAD, backoff: float = BACKOFF, order: int = 2
) -> DataFrame:
    """doc_id, n_tokens, n_backoff (tokens scored by their unigram), log_prob and score, its mean."""
    if order not in (2, 3):
        raise ValueError("n-grams of two or three tokens are packed into a whole number")
    spark = docs.sparkSession
    vocab = max(read_ranks(ranks_path).values()) + 1
    if vocab > 1 << 16:
        raise ValueError("n-grams are packed for vocabularies of at most 65,536 entries")
    texts = tokenised(docs, ranks_path, pattern)
    counts = stored(ngram_counts(texts, order), "ngrams")
    unigrams = np.zeros(vocab, dtype=np.int64)
    for r in counts.where("ngram < 0").collect():  # a row per vocabulary entry at most
        unigrams[-1 - r["ngram"]] = r["n"]
    total = int(unigrams.sum())
    chains = _chains(counts, order)
    frequent = chains.where(F.col("total") * head > F.lit(total))  # fewer than `head` of an order
    rows = np.array(sorted(tuple(x or 0 for x in r) for r in frequent.collect()) or [(-1,) + (0,) * (len(chains.columns) - 1)])
    shared = spark.sparkContext.broadcast((rows.T.copy(), unigrams))
    low = math.log(backoff)
    # What a row of a document's n-gram carries besides: its own counts, at order two the n-gram's is n. The
    # counts of its last two tokens share a column, which holds n_backoff in the rows of documents.
    owns = ["own", "own_context", "own_shorter"] if order == 3 else []

    def emit(place, tokens, ids, sizes):
        """A row for each document with all that the head decides, then its tail n-grams with their number."""
        table, unigrams = shared.value
        count = len(sizes)
        grams, where = _bigrams(place, tokens)
        two = _Counts(where, grams)
        ends = np.cumsum(sizes)[sizes > 0] - 1
        one = _Tokens(two, place[ends], tokens[ends])
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        opening = tokens[starts]
        value = np.zeros(count)
        value[sizes > 0] = low + np.log(unigrams[opening] - one.of(place[starts], opening) + 1.0)
        backed = (sizes > 0).astype(np.int64)
        longest = two
        flag = 0
        if order == 3:
            longest = _Counts(*reversed(_trigrams(place, tokens)))
            flag = TRIGRAM
        where, grams, n = longest.found >> 48, flag | (longest.found & (TRIGRAM - 1)), longest.n
        own = {}
        if order == 3:
            seconds = (np.cumsum(sizes) - sizes)[sizes > 1]
            pairs = (tokens[seconds] << 16) | tokens[seconds + 1]
            known_of = place[seconds]
            none = np.zeros(len(pairs), dtype=np.int64)
            own["own"] = np.concatenate([n, two.of(known_of, pairs)])
            own["own_context"] = np.concatenate([two.of(where, (grams >> 16) & PAIR), none])
            own["own_shorter"] = np.concatenate([two.of(where, grams & PAIR), none])
            where, grams = np.concatenate([where, known_of]), np.concatenate([grams, pairs])
            n = np.concatenate([n, none + 1])
        v, w = (grams >> 16) & 0xFFFF, grams & 0xFFFF
        last_two = (one.of(where, v) << 32) | one.of(where, w)
        at = np.minimum(np.searchsorted(table[0], grams), table.shape[1] - 1)
        known = table[0][at] == grams
        k, at = {name: x[known] for name, x in own.items()}, at[known]
        left = table[1][at] - k.get("own", n[known])
        rest = unigrams[v[known]] - (last_two[known] >> 32)
        context, left_2, steps = rest, np.zeros(len(at), dtype=np.int64), 1
        if order == 3:
            long = grams[known] >= TRIGRAM
            context = np.where(long, table[2][at] - k["own_context"], rest)
            left_2 = np.where(long, table[3][at] - k["own_shorter"], 0)
            steps = 1 + long
        floor = steps * low + np.log(unigrams[w[known]] - (last_two[known] & PAIR) + 1.0)
        second = low + np.log(np.maximum(left_2, 1)) - np.log(np.maximum(rest, 1))
        gain = np.where(left_2 > 0, second, floor)
        gain = np.where(left > 0, np.log(np.maximum(left, 1)) - np.log(np.maximum(context, 1)), gain) * n[known]
        miss = n[known] * ((left <= 0) & (left_2 <= 0))
        value = value + np.bincount(where[known], gain, count)
        backed = backed + np.bincount(where[known], miss, count).astype(np.int64)
        tail = ~known
        none = np.zeros(int(tail.sum()))
        # Keys of documents lie below all tokens and apart from each other, so that no task gets them all.
        keys = -(1 << 40) - np.random.default_rng(len(tokens)).integers(0, 1 << 40, count)
        blank = np.zeros(count, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(np.concatenate([np.arange(count), where[tail]]))),
                pa.array(np.concatenate([keys, grams[tail]])),
                pa.array(np.concatenate([sizes, n[tail]]).astype(np.int64)),
                pa.array(np.concatenate([backed, last_two[tail]])),
                pa.array(np.concatenate([value, none])),
                *(pa.array(np.concatenate([blank, own[name][tail]]).astype(np.int32)) for name in owns),
            ],
            names=["doc_id", "ngram", "n", "last_two", "log_prob", *owns],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    carried = "".join(f", {name} int" for name in owns)
    parts = _over_slices(texts, emit, f"doc_id {kind}, ngram long, n long, last_two long, log_prob double{carried}")
    terms = spark.createDataFrame(
        pd.DataFrame({"token": np.arange(vocab), "of": unigrams}), "token long, of long"
    )
    v = F.broadcast(terms.select(F.col("token").alias("v"), F.col("of").alias("c_v")))
    w = F.broadcast(terms.select(F.col("token").alias("w"), F.col("of").alias("c_w")))
    tail = F.col("ngram") >= 0
    rest = F.col("c_v") - F.shiftright("last_two", 32)
    left, context, left_2, steps = F.col("total") - F.col("n"), rest, F.lit(0), F.lit(1)
    if order == 3:
        long = F.col("ngram") >= TRIGRAM
        left = F.col("total") - F.col("own")
        context = F.when(long, F.col("context") - F.col("own_context")).otherwise(rest)
        left_2 = F.when(long, F.col("shorter") - F.col("own_shorter")).otherwise(0)
        steps = F.when(long, 2).otherwise(1)
    own_w = F.col("last_two").bitwiseAND(F.lit(PAIR).cast("long"))
    floor = steps * low + F.log(F.col("c_w") - own_w + 1)
    second = F.lit(low) + F.log(left_2.cast("double")) - F.log(rest)
    gain = F.when(left > 0, F.log(left) - F.log(context)).when(left_2 > 0, second).otherwise(floor)
    missed = F.when((left > 0) | (left_2 > 0), 0).otherwise(F.col("n"))
    return (
        parts.join(chains, F.col("ngram") == F.col("g"), "left")
        .join(v, F.shiftright("ngram", 16).bitwiseAND(0xFFFF) == F.col("v"), "left")
        .join(w, F.col("ngram").bitwiseAND(0xFFFF) == F.col("w"), "left")
        .select(
            "doc_id",
            F.when(tail, 0).otherwise(F.col("n")).alias("n_tokens"),
            F.when(tail, missed).otherwise(F.col("last_two")).alias("n_backoff"),
            F.when(tail, F.col("n") * gain).otherwise(F.col("log_prob")).alias("log_prob"),
        )
        .groupBy("doc_id")
        .agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_backoff").alias("n_backoff"), F.sum("log_prob").alias("log_prob"))
        .withColumn("log_prob", F.col("log_prob") - F.col("n_backoff") * F.log(F.lit(total + vocab) - F.col("n_tokens")))
        .withColumn("score", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
    )
