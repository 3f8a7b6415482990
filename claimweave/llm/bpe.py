"""Byte-level BPE over rank files: a minimal perfect hash for whole pre-tokens, a heap for the rest.

The rank file is read once on the driver and broadcast (a vocabulary is a file of fixed size, checked
against MAX_VOCAB_BYTES), with the perfect hash built over it: keys fall into buckets, and each bucket,
largest first, gets the first displacement that sends its keys to free slots; a key alone in its bucket
gets what is left. A pre-token that is a
vocabulary entry gets its id by two array reads and one comparison of bytes. Any other is merged over
a linked list of its bytes: a heap yields the pair of lowest rank, leftmost first, and pairs that
changed meanwhile are skipped. Each distinct miss is merged once while it stays in the worker's cache.

Cases: a null text counts as empty and has no tokens; very long texts and pre-tokens take n log n steps;
repeated rows are encoded alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable

import regex
import xxhash
from pyspark.sql import DataFrame

from claimweave.llm.common import map_batches

MAX_VOCAB_BYTES = 64 << 20
CACHE_ENTRIES = 500_000  # of the cache of one worker, which is emptied when full
CACHED_BYTES = 64  # longer pre-tokens aren't cached, which bounds the cache in bytes

#: Encoder of the last vocabulary that this worker used: its cache serves all tasks of the worker.
_WORKER: dict[tuple, Encoder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: one base64 text and one number a line."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCAB_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class PerfectHash:
    """Minimal perfect hash of byte strings to their numbers, by hash and displace."""

    def __init__(self, keys: dict[bytes, int]):
        self.size = max(1, len(keys))
        self.buckets = self.size // 2 + 1
        self.shift = [0] * self.buckets  # a displacement, or -1 - slot for a bucket with one key
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [0] * self.size
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            groups.setdefault(h % self.buckets, []).append((h, key))
        alone = []
        for bucket, members in sorted(groups.items(), key=lambda g: (-len(g[1]), g[0])):
            if len(members) == 1:
                alone.append((bucket, members[0][1]))
                continue
            d = 0
            while True:
                slots = [self._slot(h, d) for h, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.shift[bucket] = d
            for s, (_, key) in zip(slots, members, strict=True):
                self._put(s, key, keys[key])
        free = (s for s, k in enumerate(self.keys) if k is None)
        for (bucket, key), s in zip(alone, free):
            self.shift[bucket] = -1 - s
            self._put(s, key, keys[key])

    def _put(self, slot: int, key: bytes, value: int) -> None:
        self.keys[slot] = key
        self.values[slot] = value

    def _slot(self, h: int, d: int) -> int:
        x = (h + d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.size

    def get(self, key: bytes) -> int:
        """The key's number, -1 if it is no key."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.values[s] if self.keys[s] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging the pair of lowest rank, leftmost first, until none is left."""
    n = len(piece)
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    end = list(range(1, n + 1))  # of the part that begins at a byte; 0 once it is part of another
    before = list(range(-1, n - 1))
    # A heap entry is one number: the rank, then the pair's first byte, then its end.
    bits = n.bit_length()
    low, wide = (1 << bits) - 1, 2 * bits
    heap = [
        (r << wide) | (i << bits) | (i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        stop = entry & low
        i = (entry >> bits) & low
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue  # one of the two parts has changed
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            z = end[stop]
            if (r := get(piece[i:z])) is not None:
                push(heap, (r << wide) | (i << bits) | z)
        p = before[i]
        if p >= 0 and (r := get(piece[p:stop])) is not None:
            push(heap, (r << wide) | (p << bits) | stop)
    out = []
    i = 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes texts for one task."""

    def __init__(self, ranks: dict[bytes, int], whole: PerfectHash, pattern: str):
        self.ranks = ranks
        self.whole = whole
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}
        self.bytes_of = {v: k for k, v in ranks.items()}

    def piece(self, token: str) -> tuple[int, ...]:
        raw = token.encode("utf-8")
        one = self.whole.get(raw)
        found = (one,) if one >= 0 else tuple(merge(raw, self.ranks))
        if len(raw) <= CACHED_BYTES:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[token] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        get, piece, extend = self.cache.get, self.piece, out.extend
        for token in self.find(text):
            extend(get(token) or piece(token))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encoder_for(spark, ranks_path: str, pattern: str) -> Callable[[], Encoder]:
    """A function for tasks that gives the encoder of a rank file, which the driver reads and broadcasts."""
    ranks = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((ranks, PerfectHash(ranks)))
    key = (xxhash.xxh3_128_hexdigest(repr(sorted(ranks.items())).encode()), pattern)

    def encoder() -> Encoder:
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Encoder(*shared.value, pattern)
        return _WORKER[key]

    return encoder


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded bytes of every document, with `ids` if wanted."""
    make_encoder = encoder_for(docs.sparkSession, ranks_path, pattern)

    def make():
        encoder = make_encoder()

        def apply(rows):
            out = {"doc_id": rows["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for text in rows["text"]:
                ids = encoder.encode(text or "")
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
            return out

        return apply

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return map_batches(docs.select("doc_id", "text"), make, schema, rows=64)
