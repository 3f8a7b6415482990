"""Merkle manifest of a dataset by bitmap ranks and slot arrays.

A row's leaf is a digest of its columns. Per language, leaves in order of doc_id are hashed two by two, level by
level, down to a subroot; subroots in order of language are hashed likewise down to the root.

Leaves are never sorted by doc_id. Every task packs the doc_ids that it reads into bitmaps of 4,096 ids, one for
each language and upper part of the id; bitmaps of one place are merged by counting. Popcounts of the merged bitmaps
are summed up a directory of three levels, with 65,536 children a parent (a million at its top), so that a bitmap
knows how many rows of its language are before it. Leaves then meet their bitmap, and a rank query (rows before the bitmap,
plus ones before the bit) gives a leaf's coordinate. Slot arrays keyed by language and coordinate reduce seven levels
of the tree at a time. On the way back, each array hands the siblings on its path to the arrays below it.

Rows that share a doc_id in a language, and rows without one, stand in order of their leaf: they are counted by the
first two bytes of the leaf, so that no task takes all of them, and equal leaves are one row with a count. A
bitmap's place with very many rows (a hot doc_id) is spread by the leaf, and its bitmap is sent to each part.

Cases: null columns enter a leaf as `-`; a null language is a language of its own and comes first; null doc_ids come
first in their language and are never tampered with; a null n_chars stays null when tampered with; repeated rows are
leaves of their own; an empty table gives an empty result; further columns don't enter the leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import map_batches, stored
from claimweave.llm.shards import ranked

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 7  # of the tree in one slot array, which so has 128 slots
SLOTS = 1 << LEVELS
ID_BITS = 12  # of a doc_id in one bitmap, which so has 4,096 ids in 512 bytes
IDS = 1 << ID_BITS
PACKED_IDS = 1 << 20  # ids that a task holds before it hands on its bitmaps
HOT_ROWS = 1 << 16  # rows of one bitmap's place beyond which it is spread over several tasks
COPIES = 4096  # copies of one leaf made in one go

KEYS = "lang string, high long"


def H(*hexes: str) -> str:
    """The tree's digest: SHA-256 of the inputs' concatenation, as lowercase hex."""
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values: `-` for null, else the bytes of UTF-8, a colon and the value."""
    parts = []
    for v in values:
        v = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(docs: DataFrame, every: int = 7) -> DataFrame:
    """lang, doc_id, leaf, and the leaf of the tampered row where `every` divides the crc32 of the doc_id."""
    columns = [F.col(c) for c in LEAF_COLUMNS]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    changed = [more if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    return docs.select(
        "lang",
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(*columns).alias("leaf"),
        F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(*changed)).alias("tampered"),
    )


# Bitmaps


def pack(counts: np.ndarray) -> tuple[bytes, bytes]:
    """A bitmap from the rows of each of its ids: a short list of ids or 512 bytes of bits, and the repeated ids."""
    lows = np.flatnonzero(counts)
    if len(lows) < IDS // 16:
        bits = lows.astype("<u2").tobytes()
    else:
        bits = np.packbits(counts > 0, bitorder="little").tobytes()
    again = np.flatnonzero(counts > 1)
    extra = np.empty(len(again), dtype=[("low", "<u2"), ("more", "<i8")])
    extra["low"], extra["more"] = again, counts[again] - 1
    return bits, extra.tobytes()


def unpack(bits: bytes | None, extra: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a bitmap and how many rows have each."""
    if bits is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(bits) == IDS // 8:
        lows = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    else:
        lows = np.frombuffer(bits, "<u2").astype(np.int64)
    rows = np.ones(len(lows), np.int64)
    again = np.frombuffer(extra or b"", dtype=[("low", "<u2"), ("more", "<i8")])
    rows[np.searchsorted(lows, again["low"])] += again["more"]
    return lows, rows


class Ranks:
    """Rank queries on one bitmap: a popcount directory over its 64-bit words, and the repeats before an id."""

    def __init__(self, bits: bytes, extra: bytes):
        lows, rows = unpack(bits, extra)
        present = np.zeros(IDS, np.uint8)
        present[lows] = 1
        self.words = np.packbits(present, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.again = lows[rows > 1]
        self.more = np.concatenate(([0], np.cumsum(rows[rows > 1] - 1)))

    def query(self, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each id, the rows before it and the rows that have it."""
        word, bit = lows >> 6, (lows & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        at = np.searchsorted(self.again, lows)
        upto = np.searchsorted(self.again, lows, side="right")
        rank = self.before[word] + np.bitwise_count(below).astype(np.int64) + self.more[at]
        return rank, 1 + self.more[upto] - self.more[at]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmaps of a task's ids, handed on whenever a million ids are held."""
    held: dict[tuple, list[np.ndarray]] = {}
    nulls: dict[str | None, int] = {}
    n = 0

    def out():
        rows = []
        for (lang, high), lows in held.items():
            ids, counts = np.unique(np.concatenate(lows), return_counts=True)
            full = np.zeros(IDS, np.int64)
            full[ids] = counts
            rows.append((lang, high, *pack(full), int(counts.sum())))
        rows += [(lang, None, None, None, k) for lang, k in nulls.items()]
        held.clear()
        nulls.clear()
        return _batch(rows, _PACKED)

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        code = langs.indices.fill_null(len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
        names.append(None)
        ids = batch.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        for c, k in zip(*np.unique(code[missing], return_counts=True), strict=True):
            nulls[names[c]] = nulls.get(names[c], 0) + int(k)
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)[~missing]
        code = code[~missing]
        high = value >> ID_BITS
        order = np.lexsort((high, code))
        code, high, low = code[order], high[order], (value & (IDS - 1))[order]
        cut = np.flatnonzero((np.diff(code) != 0) | (np.diff(high) != 0)) + 1
        for a, b in zip([0, *cut], [*cut, len(code)], strict=True):
            if b > a:
                held.setdefault((names[code[a]], int(high[a])), []).append(low[a:b])
        n += batch.num_rows
        if n >= PACKED_IDS:
            yield out()
            n = 0
    yield out()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one place, which follow one another, as one."""
    at, counts, total = None, np.zeros(IDS, np.int64), 0

    def done():
        return (*at, *(pack(counts) if at[1] is not None else (None, None)), total)

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            key = (r["lang"], r["high"])
            if at != key:
                if at is not None:
                    rows.append(done())
                at, total = key, 0
                counts[:] = 0
            lows, n = unpack(r["bits"], r["extra"])
            counts[lows] += n
            total += r["total"]
        yield _batch(rows, _PACKED)
    if at is not None:
        yield _batch([done()], _PACKED)


_PACKED = pa.schema(
    [("lang", pa.string()), ("high", pa.int64()), ("bits", pa.binary()), ("extra", pa.binary()), ("total", pa.int64())]
)
_PACKED_SQL = f"{KEYS}, bits binary, extra binary, total long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def bitmaps(leaf_rows: DataFrame) -> DataFrame:
    """lang, high, bits, extra, total: one bitmap for 4,096 doc_ids of a language, and one row for its null ids."""
    partial = leaf_rows.select("lang", "doc_id").mapInArrow(_packed, _PACKED_SQL)
    return partial.repartition("lang", "high").sortWithinPartitions("lang", "high").mapInArrow(_merged, _PACKED_SQL)


def directory(packed: DataFrame) -> DataFrame:
    """lang, high, total, before (rows of the language in earlier bitmaps) and n (rows of the language)."""
    counts = packed.select("lang", "high", "total")
    for level, below in (("p1", "high"), ("p2", "p1")):
        counts = counts.withColumn(level, F.shiftright(below, 16))
    first = counts.groupBy("lang", "p2", "p1").agg(F.sum("total").alias("t1"))
    second = first.groupBy("lang", "p2").agg(F.sum("t1").alias("t2"))

    def earlier(column: str, order: str, *group: str) -> Column:
        window = Window.partitionBy(*group).orderBy(F.col(order).asc_nulls_first())
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    second = second.withColumn("before2", earlier("t2", "p2", "lang")).withColumn(
        "n", F.sum("t2").over(Window.partitionBy("lang"))
    )
    first = first.withColumn("before1", earlier("t1", "p1", "lang", "p2"))
    counts = counts.withColumn("before0", earlier("total", "high", "lang", "p1"))
    parents = _null_safe_join(first, second, ["lang", "p2"])
    return _null_safe_join(counts, parents.drop("p2"), ["lang", "p1"]).select(
        "lang", "high", "total", (F.col("before0") + F.col("before1") + F.col("before2")).alias("before"), "n"
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    named = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    same = None
    for k in keys:
        one = left[k].eqNullSafe(named[f"__{k}"])
        same = one if same is None else same & one
    return left.join(named, same).drop(*[f"__{k}" for k in keys])


_STREAM = (
    f"{KEYS}, salt int, kind int, bits binary, extra binary, before long, n long, total long, "
    "doc_id long, leaf binary, tampered binary"
)
_RANKED = pa.schema(
    [("lang", pa.string()), ("n", pa.int64()), ("doc_id", pa.int64()), ("leaf", pa.binary()),
     ("tampered", pa.binary()), ("rank", pa.int64()), ("ties", pa.int64())]
)
_RANKED_SQL = "lang string, n long, doc_id long, leaf binary, tampered binary, rank long, ties long"


def _queried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of leaves, each run of which follows the bitmap of its place."""
    ranks, before, n, total = None, 0, 0, 0
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        heads = np.flatnonzero(kind == 0)
        rank = np.zeros(batch.num_rows, np.int64)
        ties = np.zeros(batch.num_rows, np.int64)
        size = np.zeros(batch.num_rows, np.int64)
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        for a, b in zip([-1, *heads], [*heads, batch.num_rows], strict=True):
            if a >= 0:
                bits = batch.column("bits")[a].as_py()
                ranks = None if bits is None else Ranks(bits, batch.column("extra")[a].as_py())
                before, n, total = (batch.column(c)[a].as_py() for c in ("before", "n", "total"))
            if b > a + 1:
                if ranks is None:  # rows without a doc_id
                    rank[a + 1 : b], ties[a + 1 : b] = before, total + 1
                else:
                    rank[a + 1 : b], ties[a + 1 : b] = ranks.query(ids[a + 1 : b] & (IDS - 1))
                    rank[a + 1 : b] += before
                size[a + 1 : b] = n
        rows = pa.array(kind == 1)
        yield pa.RecordBatch.from_arrays(
            [
                {"n": pa.array(size), "rank": pa.array(rank), "ties": pa.array(ties)}
                .get(f.name, batch.column(f.name) if f.name in batch.schema.names else None)
                .filter(rows)
                .cast(f.type)
                for f in _RANKED
            ],
            schema=_RANKED,
        )


def rank_queries(leaf_rows: DataFrame, packed: DataFrame) -> DataFrame:
    """Leaves with n (rows of the language), rank (rows before the doc_id) and ties (rows that may share it)."""
    placed = directory(packed)
    high = F.shiftright("doc_id", ID_BITS)
    hot = placed.where(F.col("total") > HOT_ROWS).select("lang", "high", F.expr(f"total div {HOT_ROWS}").alias("parts"))
    salts = hot.limit(1).count() > 0
    rows = leaf_rows.withColumn("high", high)
    heads = _null_safe_join(placed, packed.drop("total"), ["lang", "high"]).withColumn("salt", F.lit(0))
    rows = rows.withColumn("salt", F.lit(0))
    if salts:  # one row for each 65,536 of the table at most
        hot = hot.select(F.col("lang").alias("l"), F.col("high").alias("h"), "parts")
        same = F.col("lang").eqNullSafe(F.col("l")) & F.col("high").eqNullSafe(F.col("h"))
        part = F.coalesce(F.pmod(F.xxhash64("leaf"), F.col("parts") + 1).cast("int"), F.lit(0))
        rows = rows.join(hot, same, "left").withColumn("salt", part).drop("l", "h", "parts")
        each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(0)).cast("int")))
        heads = heads.join(hot, same, "left").withColumn("salt", each).drop("l", "h", "parts")
    blank = leaf_rows.sparkSession.createDataFrame([], _STREAM)

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        df = df.withColumn("kind", F.lit(kind))
        return df.select(
            *[
                F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in blank.schema
            ]
        )

    stream = shaped(heads, 0).unionByName(shaped(rows, 1))
    keys = ["lang", "high", "salt"]
    return stream.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(_queried, _RANKED_SQL)


def coordinates(leaf_rows: DataFrame) -> DataFrame:
    """lang, n, pos, doc_id, leaf, tampered: every leaf at its place, from 0, among the n leaves of its language."""
    packed = stored(bitmaps(leaf_rows), "bitmaps")
    repeated = packed.where(F.col("high").isNull() | (F.octet_length("extra") > 0)).limit(1).count() > 0
    found = rank_queries(leaf_rows, packed)
    if repeated:
        found = stored(found, "ranked")  # read twice
    out = ["lang", "n", "pos", "doc_id", "leaf", "tampered"]
    alone = found.where("ties = 1").withColumn("pos", F.col("rank")).select(*out)
    if not repeated:
        return alone
    same = ["lang", "n", "doc_id", "rank"]
    tied = (
        found.where("ties > 1")
        .groupBy(*same, "leaf", "tampered")
        .agg(F.count("*").alias("copies"))
        .withColumn("prefix", F.substring(F.hex("leaf"), 1, 4))
    )
    prefixes = tied.groupBy(*same, "prefix").agg(F.sum("copies").alias("size"))

    def earlier(column: str, order: str, *group: str) -> Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    prefixes = prefixes.withColumn("start", F.col("rank") + earlier("size", "prefix", *same)).drop("size")
    tied = tied.withColumn("within", earlier("copies", "leaf", *same, "prefix"))
    many = _null_safe_join(tied, prefixes, [*same, "prefix"]).withColumn("first", F.col("start") + F.col("within"))
    # Copies of one leaf are interchangeable: runs of copies are dealt out, then made.
    runs = many.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    if many.where(F.col("copies") > COPIES).limit(1).count() > 0:
        runs = runs.repartition("lang", "doc_id", "leaf", "run")
    each = F.sequence(F.col("run") * COPIES, F.least(F.col("copies"), (F.col("run") + 1) * COPIES) - 1)
    copies = runs.withColumn("pos", F.explode(each)).withColumn("pos", F.col("first") + F.col("pos"))
    return alone.unionByName(copies.select(*out))


# The tree


def height(n: int) -> int:
    """Levels from n nodes down to one."""
    return (n - 1).bit_length()


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the given number of levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree: list[list[str]], slot: int) -> str:
    """Siblings of a slot within one array, level by level."""
    found = []
    for nodes in tree[:-1]:
        other = slot ^ 1
        if other < len(nodes):
            found.append(nodes[other])
        slot >>= 1
    return "".join(found)


def fold(leaf: str, path: str, places: list[tuple[int, int]]) -> str:
    """The root from a leaf and its siblings; places are (pos, n) in the language's tree and in that of the languages."""
    at = 0
    for pos, n in places:
        while n > 1:
            if pos ^ 1 < n:
                other = path[at : at + 64]
                at += 64
                leaf = H(other, leaf) if pos & 1 else H(leaf, other)
            else:
                leaf = H(leaf)
            pos, n = pos >> 1, (n + 1) >> 1
    return leaf


def _arrays(nodes: DataFrame, *kept: str) -> DataFrame:
    """Slot arrays of nodes (lang, n, pos, ...): the rows of 128 neighbouring places in one row, in no order."""
    slot = F.struct((F.col("pos") % SLOTS).cast("int").alias("slot"), *kept)
    return nodes.groupBy("lang", "n", F.expr(f"pos div {SLOTS}").alias("block")).agg(F.collect_list(slot).alias("slots"))


def _filled(slots: list[dict], column: str) -> list:
    array = [None] * len(slots)
    for s in slots:
        array[s["slot"]] = s[column]
    return array


def _tops(arrays: DataFrame, level: int, packed: bool) -> DataFrame:
    """lang, n, pos and node above each slot array whose slots are nodes of the given level."""

    def make():
        def apply(rows):
            nodes = []
            for n, slots in zip(rows["n"], rows["slots"], strict=True):
                array = _filled(slots, "node")
                levels = min(LEVELS, height(n) - level)
                nodes.append(reduced([x.hex() for x in array] if packed else array, levels)[-1][0])
            return {"lang": rows["lang"], "n": rows["n"], "pos": rows["block"], "node": nodes}

        return apply

    return map_batches(arrays, make, "lang string, n long, pos long, node string", rows=64)


def _paths(arrays: DataFrame, above: DataFrame, level: int) -> DataFrame:
    """For every slot, lang, n, pos and the siblings from there up, given those of its array in `above`."""

    def make():
        def apply(rows):
            out = {"lang": [], "n": [], "pos": [], "path": [], "top": []}
            for lang, n, block, slots, path, top in zip(
                *(rows[c] for c in ("lang", "n", "block", "slots", "path", "top")), strict=True
            ):
                tree = reduced(_filled(slots, "node"), min(LEVELS, height(n) - level))
                for slot in range(len(tree[0])):
                    out["lang"].append(lang)
                    out["n"].append(n)
                    out["pos"].append(block * SLOTS + slot)
                    out["path"].append(siblings(tree, slot) + path)
                    out["top"].append(top)
            return out

        return apply

    joined = _above(arrays, above)
    return map_batches(joined, make, f"lang string, n long, pos long, path string, {_TOP}", rows=64)


_TOP = "top struct<subroot: string, root: string, pos: long, n: long>"


def _above(arrays: DataFrame, above: DataFrame) -> DataFrame:
    right = above.select(F.col("lang").alias("l"), F.col("pos").alias("p"), "path", "top")
    return arrays.join(right, F.col("lang").eqNullSafe(F.col("l")) & (F.col("block") == F.col("p"))).drop("l", "p")


class Tree:
    """The stored slot arrays of the trees of all groups (lang, n), lowest first, and their top nodes."""

    def __init__(self, nodes: DataFrame, *kept: str):
        self.arrays = [stored(_arrays(nodes, "node", *kept), "slots")]
        most = self.arrays[0].agg(F.max("n")).first()[0] or 0
        packed = dict(nodes.dtypes)["node"] == "binary"
        self.top = _tops(self.arrays[0], 0, packed)
        while most > SLOTS ** len(self.arrays):
            self.arrays.append(stored(_arrays(self.top, "node"), "slots"))
            self.top = _tops(self.arrays[-1], (len(self.arrays) - 1) * LEVELS, False)

    def paths(self, above: DataFrame, lowest: int = 0) -> DataFrame:
        """Siblings from the slots of one level of arrays up; `above` has those of each tree's top."""
        for i in range(len(self.arrays) - 1, lowest - 1, -1):
            above = _paths(self.arrays[i], above, i * LEVELS)
        return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    leaf_rows = stored(leaves(docs), "leaves")
    tree = Tree(coordinates(leaf_rows).withColumnRenamed("leaf", "node"), "doc_id", "tampered")
    subroots = stored(tree.top.select("lang", "n", "node"), "subroots")
    named = ranked(subroots, ["lang"], None, "languages")
    places = named.select("lang", "node", F.col("place").alias("pos"))
    count = places.count()
    over = Tree(places.select(F.lit(None).cast("string").alias("lang"), F.lit(count).cast("long").alias("n"), "pos", "node"))
    root = F.lit(None).cast("string")
    start = over.top.select(
        F.lit(None).cast("string").alias("lang"),
        F.lit(0).cast("long").alias("pos"),
        F.lit("").alias("path"),
        F.struct(root.alias("subroot"), F.col("node").alias("root"), F.col("pos"), F.col("n")).alias("top"),
    )
    roots = over.paths(start).select(F.col("pos").alias("rank"), F.col("path"), F.col("top.root").alias("root"))
    above = places.join(roots, F.col("pos") == F.col("rank")).select(
        "lang",
        F.lit(0).cast("long").alias("pos"),
        "path",
        F.struct(
            F.col("node").alias("subroot"), F.col("root"), F.col("rank").alias("pos"), F.lit(count).cast("long").alias("n")
        ).alias("top"),
    )
    found = _above(tree.arrays[0], tree.paths(stored(above, "tops"), lowest=1))

    def make():
        def apply(rows):
            out = {c: [] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")}
            for n, block, slots, path, top in zip(
                *(rows[c] for c in ("n", "block", "slots", "path", "top")), strict=True
            ):
                nodes = [x.hex() for x in _filled(slots, "node")]
                tampered, ids = _filled(slots, "tampered"), _filled(slots, "doc_id")
                inner = reduced(nodes, min(LEVELS, height(n)))
                for slot, leaf in enumerate(nodes):
                    proof = siblings(inner, slot) + path
                    seen = leaf if tampered[slot] is None else tampered[slot].hex()
                    out["doc_id"].append(ids[slot])
                    out["leaf"].append(leaf)
                    out["subroot"].append(top["subroot"])
                    out["root"].append(top["root"])
                    out["proof_sha256"].append(H(proof))
                    out["folded_root"].append(fold(seen, proof, [(block * SLOTS + slot, n), (top["pos"], top["n"])]))
            return out

        return apply

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return map_batches(found, make, schema, rows=16).withColumn("verified", F.col("folded_root") == F.col("root"))
