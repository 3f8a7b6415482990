"""Word BPE with tree concatenation of long unsplit text.

Text is normalised and split into pre-tokens as the tokenizer file says; each pre-token's bytes are symbols, of which
the last carries the word's end. Short pre-tokens are merged by a heap over linked symbols, once while they stay in
the worker's cache. A long one is halved down to short stretches, and the ids of two halves are joined: a window of
ids around the join is encoded again and grows on both sides until its first id is the left side's own and its last
the right side's own. Merges never cross between two neighbours that, taken alone, stay two ids; every pair of
neighbours in the joined ids occurs in an encoding of both, so the joined ids are those of the whole exactly.

Texts beyond LONG_TEXT characters go the same way over the cluster: one row for each stretch of pre-tokens or piece of
a long one, encoded by whichever task is free, then rounds that join the pieces of a pre-token two by two. Each such
text is encoded once, however many rows have it. Only the digests, sequential by definition, read a text's ids in
order, as a stream.

Cases: a null text counts as empty and has no ids; the strings of added tokens become their ids; repeated rows are
encoded alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimweave.llm.common import map_batches, stored

MAX_FILE_BYTES = 64 << 20
STRETCH = 64  # symbols that are merged by one heap
LONG_TEXT = 1 << 16  # characters beyond which a text is dealt out in pieces
PIECE = 1 << 13  # characters of a stretch of pre-tokens, bytes of a piece of one
CACHE_ENTRIES = 500_000  # of the cache of one worker, which is emptied when full
CACHED_LENGTH = 64  # longer pre-tokens aren't cached, which bounds the cache in bytes
PLAIN_UPTO = 0x24F  # letters that are their own composed form; others go through the library's normaliser

_WORKER: dict[str, Encoder] = {}


class Encoder:
    """Encoder and decoder of one tokenizer file: BPE with an end-of-word suffix, byte-level symbols, no decoder."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["byte_fallback"] or model["continuing_subword_prefix"]:
            raise ValueError("not a plain BPE model")
        if model["ignore_merges"] or model["unk_token"] or spec["decoder"] or not model["end_of_word_suffix"]:
            raise ValueError("not a BPE model with word ends and no decoder")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with rules of their own")
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in added.items()}
        library = Tokenizer.from_str(text)
        self.normal, self.presplit = library.normalizer, library.pre_tokenizer
        self.symbol = byte_symbols()
        self.whole: dict[str, tuple[int, ...]] = {}  # by pre-token in byte symbols
        self.words: dict[str, tuple[int, ...]] = {}  # by plain pre-token
        self.plain = self._plain(spec)

    def _plain(self, spec: dict):
        """The split of plain letters by pattern, or None where it isn't what the library does with each of them."""
        splits = [p for p in spec["pre_tokenizer"].get("pretokenizers", []) if p["type"] == "Split"]
        if len(splits) != 1 or splits[0]["behavior"] != "Removed" or not splits[0]["invert"]:
            return None
        find = regex.compile(splits[0]["pattern"]["Regex"]).findall
        for code in range(PLAIN_UPTO + 1):
            for text in (chr(code), f"a{chr(code)}a", f"1{chr(code)}'", f"'{chr(code)} ."):
                if [self.spelled(t) for t in find(text.lower())] != self.split(text):
                    return None
        return find

    def spelled(self, word: str) -> str:
        return "".join(map(self.symbol.__getitem__, word.encode()))

    def split(self, text: str) -> list[str]:
        """Pre-tokens, in byte symbols, of a text without added tokens."""
        return [t for t, _ in self.presplit.pre_tokenize_str(self.normal.normalize_str(text))]

    def parts(self, text: str) -> Iterator[tuple[int | None, list[str], bool]]:
        """Added tokens' ids, and between them the pre-tokens: plain ones or in byte symbols."""
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                yield self.added[part], [], False
            elif part and self.plain and not _OTHER(part):
                yield None, self.plain(part.lower()), True
            elif part:
                yield None, self.split(part), False

    def symbols(self, word: str, ends: bool = True) -> list[int]:
        """Ids of the symbols of a pre-token in byte symbols; a piece of one that isn't its end has no suffix."""
        ids = [self.vocab[s] for s in word]
        if ends and word:
            ids[-1] = self.vocab[word[-1] + self.suffix]
        return ids

    def merged(self, ids: list[int]) -> list[int]:
        """Merges the pair of lowest rank, leftmost first, until none is left."""
        n = len(ids)
        ids = list(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.merges.get
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (m := get((ids[i], ids[j]))) is None or m[1] != new:
                continue  # one of the two has changed
            ids[i], ids[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := get((new, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (p := before[i]) >= 0 and (m := get((ids[p], new))):
                heapq.heappush(heap, (m[0], p, m[1]))
        return [i for i in ids if i >= 0]

    def unmerged(self, ids: list[int]) -> list[int]:
        """The symbols of ids."""
        out = []
        for i in ids:
            name = self.names[i]
            ends = name.endswith(self.suffix)
            out += self.symbols(name.removesuffix(self.suffix) if ends else name, ends)
        return out

    def concatenated(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring stretches from their own."""
        size = 1
        while left and right:
            size = min(2 * size, max(len(left), len(right)))
            a, b = left[-size:], right[:size]
            window = self.merged(self.unmerged(a + b))
            agrees_left = len(a) == len(left) or window[0] == a[0]
            agrees_right = len(b) == len(right) or window[-1] == b[-1]
            if agrees_left and agrees_right:
                return left[: len(left) - len(a)] + window + right[len(b) :]
        return left + right

    def encoded(self, ids: list[int]) -> list[int]:
        """Ids of a stretch of symbols: both halves, then their join."""
        if len(ids) <= STRETCH:
            return self.merged(ids)
        half = len(ids) // 2
        return self.concatenated(self.encoded(ids[:half]), self.encoded(ids[half:]))

    def word(self, word: str, plain: bool) -> tuple[int, ...]:
        cache = self.words if plain else self.whole
        found = cache.get(word)
        if found is None:
            found = tuple(self.encoded(self.symbols(self.spelled(word) if plain else word)))
            if len(word) <= CACHED_LENGTH:
                if len(cache) >= CACHE_ENTRIES:
                    cache.clear()
                cache[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for added, words, plain in self.parts(text):
            if added is not None:
                out.append(added)
            get, make = (self.words if plain else self.whole).get, self.word
            for w in words:
                out += get(w) or make(w, plain)
        return out

    def decode(self, ids: list[int]) -> str:
        """Without a decoder the library puts a space between tokens."""
        return " ".join(map(self.names.__getitem__, ids))


_OTHER = regex.compile(f"[^\\x00-{chr(PLAIN_UPTO)}]").search


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes of Latin-1 are themselves, the others follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(moved)) for b in range(256)]


def encoder_for(spark, path: str):
    """A function for tasks that gives the encoder of a tokenizer file, which the driver reads and broadcasts."""
    with open(path, "rb") as f:
        raw = f.read(MAX_FILE_BYTES + 1)
    if len(raw) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    shared = spark.sparkContext.broadcast(raw)
    key = hashlib.sha256(raw).hexdigest()

    def encoder() -> Encoder:
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Encoder(shared.value.decode())
        return _WORKER[key]

    return encoder


def digests(encoder: Encoder, ids: list[int]) -> tuple[int, str, str]:
    """n_tokens, ids_sha256 and decoded_sha256."""
    joined = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(encoder.decode(ids).encode()).hexdigest()


_RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, long_text: int = LONG_TEXT, piece: int = PIECE) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every document."""
    make_encoder = encoder_for(docs.sparkSession, path)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["doc_id"]

    def make():
        encoder = make_encoder()

        def apply(rows):
            found = [digests(encoder, encoder.encode(t)) for t in rows["text"]]
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            return {"doc_id": rows["doc_id"], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

        return apply

    is_long = F.length("text") > long_text
    short = map_batches(texts.where(~is_long), make, f"doc_id {kind}, {_RESULT}", rows=64)
    named = texts.where(is_long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    owners = stored(named.select("doc_id", "key"), "long-texts")
    if owners.limit(1).count() == 0:
        return short
    distinct = named.groupBy("key").agg(F.first("text").alias("text"))
    ids = long_ids(distinct, make_encoder, piece)
    return short.unionByName(owners.join(_digested(ids, make_encoder), "key").drop("key"))


# Long texts over the cluster

_PIECES = "key string, at long, piece long, words array<string>, plain boolean, ends boolean, added int"
_IDS = "key string, at long, piece long, ids array<int>"


def long_ids(texts: DataFrame, make_encoder, size: int) -> DataFrame:
    """key, at and ids of stretches of every text, in order of `at`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = texts.sparkSession
    dealt_schema, ids_schema = (to_arrow_schema(spark.createDataFrame([], s).schema) for s in (_PIECES, _IDS))

    def dealt(batches):
        encoder = make_encoder()
        for batch in batches:
            for row in range(batch.num_rows):
                key, text = batch.column("key")[row].as_py(), batch.column("text")[row].as_py()
                rows = _stretches(encoder, text, size)
                while some := [(key, *r) for _, r in zip(range(64), rows, strict=False)]:
                    yield _batch(some, dealt_schema)

    def encoded(batches):
        encoder = make_encoder()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(start, 64).to_pylist():
                    if r["added"] is not None:
                        ids = [r["added"]]
                    elif r["piece"] is None:
                        ids = [i for w in r["words"] for i in encoder.word(w, r["plain"])]
                    else:
                        ids = encoder.encoded(encoder.symbols(r["words"][0], r["ends"]))
                    out.append((r["key"], r["at"], r["piece"], ids))
                yield _batch(out, ids_schema)

    def joined(batches):
        encoder = make_encoder()
        rows = (r for b in batches for s in range(0, b.num_rows, 16) for r in b.slice(s, 16).to_pylist())
        for (key, at, half), pair in groupby(rows, key=lambda r: (r["key"], r["at"], r["piece"] >> 1)):
            ids = next(pair)["ids"]
            for r in pair:
                ids = encoder.concatenated(ids, r["ids"])
            yield _batch([(key, at, half, ids)], ids_schema)

    pieces = texts.select("key", "text").mapInArrow(dealt, _PIECES).repartition("key", "at", "piece")
    found = stored(pieces.mapInArrow(encoded, _IDS), "stretches")
    whole, open_ = found.where("piece IS NULL"), found.where("piece IS NOT NULL")
    most = open_.agg(F.max("piece")).first()[0]
    while most:
        half = F.shiftright("piece", 1)
        open_ = stored(
            open_.repartition("key", "at", half).sortWithinPartitions("key", "at", "piece").mapInArrow(joined, _IDS), "joined"
        )
        most >>= 1
    return whole.unionByName(open_).drop("piece")


def _stretches(encoder: Encoder, text: str, size: int) -> Iterator[tuple]:
    """at, piece, words, plain, ends, added: runs of pre-tokens of about `size` characters, and pieces of longer ones."""
    at, held, length = 0, [], 0
    for added, words, plain in encoder.parts(text):
        if added is not None:
            yield at, None, None, None, None, added
            at += 1
        for w in words:
            spelled = (encoder.spelled(w) if plain else w) if len(w) * (2 if plain else 1) > size else ""
            if held and (len(spelled) > size or length >= size):
                yield at, None, held, plain, None, None
                at, held, length = at + 1, [], 0
            if len(spelled) > size:
                for i, start in enumerate(range(0, len(spelled), size)):
                    yield at, i, [spelled[start : start + size]], False, start + size >= len(spelled), None
                at += 1
            else:
                held.append(w)
                length += len(w)
        if held:
            yield at, None, held, plain, None, None
            at, held, length = at + 1, [], 0


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _digested(ids: DataFrame, make_encoder) -> DataFrame:
    """key and digests of each text from the ids of its stretches in order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = f"key string, {_RESULT}"
    schema = to_arrow_schema(ids.sparkSession.createDataFrame([], target).schema)

    def run(batches):
        encoder = make_encoder()
        rows = (r for b in batches for s in range(0, b.num_rows, 16) for r in b.slice(s, 16).to_pylist())
        for key, parts in groupby(rows, key=lambda r: r["key"]):
            n, numbers, decoded = 0, hashlib.sha256(), hashlib.sha256()
            for r in parts:
                if r["ids"]:
                    gap = " " if n else ""
                    numbers.update((gap + " ".join(map(str, r["ids"]))).encode())
                    decoded.update((gap + encoder.decode(r["ids"])).encode())
                    n += len(r["ids"])
            yield _batch([(key, n, numbers.hexdigest(), decoded.hexdigest())], schema)

    return ids.repartition("key").sortWithinPartitions("key", "at").mapInArrow(run, target)
