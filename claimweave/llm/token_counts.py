"""Token counts of a sentencepiece model by a two-tier lookup, without any shuffle of pre-tokens.

The model joins no piece across the place where a space follows another character, which is checked on
its vocabulary; so a text's tokens are those of its pre-tokens, a run of spaces and what follows it.
First tier: the lengths of the most frequent pre-tokens of about SAMPLE_ROWS rows drawn from the whole table, a table of at most
FREQUENT entries of at most FREQUENT_CHARS characters, broadcast. Second tier: other pre-tokens are
encoded by the library in one call a slice of rows and cached by the worker, in a table that starts
from the first tier. The tiers only save time:
each pre-token has the length that the library gives it.

Cases: null and empty texts have no tokens; very long texts are counted whole; repeated rows are counted
alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import map_batches

FREQUENT = 65_536
FREQUENT_CHARS = 24
SAMPLE_ROWS = 2_000
MAX_MODEL_BYTES = 64 << 20
CACHE_ENTRIES = 400_000
CACHED_CHARS = 64
_MARK = "▁"
_PRE_TOKEN = re.compile(" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """A text's pre-tokens, each with its leading spaces, after the space that the model puts in front."""
    return _PRE_TOKEN.findall(" " + text.replace(_MARK, " ")) if text else []


class Counts:
    """Token counts for one task."""

    def __init__(self, model: bytes, frequent: dict[str, int]):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.frequent = frequent
        self.cache = dict(frequent)

    def splits(self) -> bool:
        """Whether pre-tokens can be encoded apart: no piece has a space after another character."""
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        whole = "a  b▁ c\n d"
        return (
            not any(_MARK in p.lstrip(_MARK) for p in pieces)
            and self.model.encode(" ", out_type=str) == [_MARK * 2]
            and sum(len(self.model.encode(p[1:])) for p in pre_tokens(whole)) == len(self.model.encode(whole))
            and self.model.encode("  x", out_type=str)[0].startswith(_MARK * 2)
        )

    def learn(self, tokens: set[str]) -> None:
        """Encode pre-tokens in one call and cache their lengths."""
        todo = list(tokens)
        # The library puts a space in front of what it encodes, in place of the pre-token's first one,
        # but nothing into an empty text: a last space alone is one token.
        for token, ids in zip(todo, self.model.encode([t[1:] for t in todo], num_threads=1), strict=True):
            self.cache[token] = len(ids) or 1

    def count(self, texts: list[str | None]) -> list[int]:
        """Token counts of some texts; the cache begins anew with each call once it is full."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache = dict(self.frequent)
        tokens = [pre_tokens(t or "") for t in texts]
        known = self.cache
        new = {t for own in tokens for t in own if t not in known}
        if new:
            self.learn(new)
        out = [sum(map(known.__getitem__, own)) for own in tokens]
        for t in new:
            if len(t) > CACHED_CHARS:
                del known[t]
        return out


def frequent_pre_tokens(docs: DataFrame, rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> list[str]:
    """The most frequent short pre-tokens of about `rows` documents of the whole table, `entries` at most."""
    share = min(1.0, rows / max(1, docs.count()))

    def make():
        def apply(part):
            found = Counter()
            for text in part["text"]:
                found.update(t for t in pre_tokens(text or "") if len(t) <= FREQUENT_CHARS)
            return {"token": list(found), "n": list(found.values())}

        return apply

    counted = map_batches(docs.select("text").sample(share, seed=5), make, "token string, n long")
    top = counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(entries)
    return [r["token"] for r in top.collect()]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every document."""
    with open(model_path, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{model_path} is larger than {MAX_MODEL_BYTES} bytes")
    driver = Counts(model, {})
    if not driver.splits():
        raise ValueError("this model joins pieces over spaces: its pre-tokens can't be counted apart")
    top = frequent_pre_tokens(docs)
    sizes = [len(ids) or 1 for ids in driver.model.encode([t[1:] for t in top], num_threads=1)] if top else []
    shared = docs.sparkSession.sparkContext.broadcast((model, dict(zip(top, sizes, strict=True))))

    def make():
        counts = Counts(*shared.value)
        return lambda rows: {
            "doc_id": rows["doc_id"],
            "n_bytes": [len((t or "").encode("utf-8")) for t in rows["text"]],
            "n_tokens": counts.count(rows["text"]),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = map_batches(docs.select("doc_id", "text"), make, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
