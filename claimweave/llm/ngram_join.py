"""Join of documents by the Jaccard similarity of their five-word shingles, by MinHash banding.

Documents with one set of shingles are one text, named by the digest of the set: the join works on such
texts, so copies never make pairs. Each text has a MinHash signature of TREES x DEPTH values; every tree
lists the texts by its own DEPTH values. Two texts meet in a tree where they share a prefix of a fixed length,
the longest at which the trees together reach the target recall for pairs at the threshold (base_length(): 3 values
at 0.8 and 0.99). The length replaces an LSH forest's, which adapts to the data; the deeper values only go
into the comparison of signatures. Texts that share no such prefix with another are
left out after a count of narrow rows. The rest is done in two ways that divide the pairs between them:

- Prefixes of up to GROUP texts: a pass over the sorted listing meets all pairs of such a group; sizes
  and signatures drop hopeless pairs, the rest are verified on their whole shingle sets.
- Prefixes of more texts: the group is cut into blocks of bounded size by hash, and a task compares two blocks
  of whole shingle sets. It returns the number of links of each text and the links of a spanning forest, so
  that rows grow with texts and blocks, not with pairs, and yet every link is verified and counted. A
  pair is compared in the first tree where it meets, and not at all where the first way has it.

Classes are the connected components of the links.

Shingles are five words (runs without ASCII white space) as they stand; a text of one to four words
is one shingle. 64-bit hashes stand for shingles.

Cases: null texts and texts without a word have no links and are classes of their own; a null doc_id
can't be named, so its row keeps a null class and no links; a doc_id that repeats with other texts takes the
smallest class of its texts and the sum of their links; repeated rows change nothing; very long texts are
compared whole; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import WORD, stored

SHINGLE = 5
THRESHOLD = 0.8
TREES = 8
DEPTH = 8
RECALL = 0.99
#: Texts of a prefix whose pairs are listed; those of larger groups are compared in blocks.
GROUP = 5
#: Most texts and shingles of a block, on average; two blocks are in a task's memory.
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 500_000
#: Keys broadcast to fetch their texts: 16 bytes each, checked by a count; beyond it the join is shuffled.
BROADCAST_IDS = 1_000_000
_CHUNK = 4096
_WORDS = re.compile(WORD)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def base_length(trees: int = TREES, threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold shares one in some tree with the target recall."""
    return max([1, *(x for x in range(1, depth + 1) if 1 - (1 - threshold**x) ** trees >= recall)])


def least_equal(threshold: float = THRESHOLD) -> int:
    """Equal values that a pair's signatures need: four standard deviations below the threshold's share."""
    n = TREES * DEPTH
    return max(0, math.ceil(threshold * n - 4 * math.sqrt(n * threshold * (1 - threshold))))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str, hashes: dict) -> np.ndarray:
    """The sorted hashes of a text's shingles, each once."""
    words = _WORDS.findall(text)
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(own) - SHINGLE + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(own))):
        total += _mixed(own[k : k + n] * _MIX[k])
    return np.unique(_mixed(total + np.uint64(min(SHINGLE, len(own)))))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240117)
    n = TREES * DEPTH
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def signature(own: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), _CHUNK):
        np.minimum(low, (own[at : at + _CHUNK, None] * a + b).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(">u4")


def _texts(docs: DataFrame, emit, schema: str) -> DataFrame:
    """emit(ids, list of shingle sets) over slices of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                if len(hashes) > 500_000:
                    hashes.clear()
                yield emit(part.column(0), [shingles(t or "", hashes) for t in part.column(1).to_pylist()])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, set_key, n (shingles) and sig of every document with a word."""

    def emit(ids, sets):
        a, b = _coefficients()
        worded = [i for i, s in enumerate(sets) if len(s)]
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(worded, pa.int64())),
                pa.array([xxhash.xxh3_128_digest(sets[i].tobytes()) for i in worded], pa.binary()),
                pa.array([len(sets[i]) for i in worded], pa.int64()),
                pa.array([signature(sets[i], a, b).tobytes() for i in worded], pa.binary()),
            ],
            names=["doc_id", "set_key", "n", "sig"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs.where(F.col("doc_id").isNotNull()), emit, f"doc_id {kind}, set_key binary, n long, sig binary")


def meetings(texts: DataFrame, base: int) -> DataFrame:
    """set_key, met: the trees in which other texts share its prefix, with the number of texts and blocks."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    listed = texts.select("set_key", "n", "sig", trees).select(
        "tree", F.expr(f"substring(sig, tree * {4 * DEPTH} + 1, {4 * base})").alias("prefix"), "set_key", "n"
    )
    shared = listed.groupBy("tree", "prefix").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_TEXTS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    shared = shared.select("tree", "prefix", "size", blocks.cast("int").alias("blocks"))
    met = listed.select("tree", "prefix", "set_key").join(shared, ["tree", "prefix"])
    return met.groupBy("set_key").agg(F.collect_list(F.struct("tree", "size", "blocks")).alias("met"))


def forest(met: DataFrame) -> DataFrame:
    """A row for each text and tree with a small group: tree, prefix, set_key, n, sketch (a byte of each value)."""
    low = F.concat(*[F.substring("sig", 4 * i + 4, 1) for i in range(TREES * DEPTH)])
    small = F.filter("met", lambda m: m["size"] <= GROUP)
    width = 4 * DEPTH
    return met.select("set_key", "n", "sig", low.alias("sketch"), F.explode(small["tree"]).alias("tree")).select(
        "tree", F.expr(f"substring(sig, tree * {width} + 1, {width})").alias("prefix"), "set_key", "n", "sketch"
    )


def candidates(listed: DataFrame, base: int, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs a < b of the groups of a listing that is sorted within its partitions and cuts no group."""
    ones = int.from_bytes(b"\x7f" * (TREES * DEPTH), "big")
    tops = int.from_bytes(b"\x80" * (TREES * DEPTH), "big")
    most = TREES * DEPTH - least_equal(threshold)
    cut = 4 * base

    def alike(x: tuple, y: tuple) -> bool:
        if x[1] < threshold * y[1] - 1e-9 or y[1] < threshold * x[1] - 1e-9:
            return False
        d = x[2] ^ y[2]
        return ((((d & ones) + ones) | d) & tops).bit_count() <= most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, near = None, []
        for batch in batches:
            found: set[tuple] = set()
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for tree, prefix, key, n, sketch in zip(*columns, strict=True):
                text = (key, n, int.from_bytes(sketch, "big"))
                if before != (tree, prefix[:cut]):
                    before, near = (tree, prefix[:cut]), []
                found.update((min(key, x[0]), max(key, x[0])) for x in near if alike(text, x))
                near.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

    return listed.mapInArrow(run, "a binary, b binary")


def candidate_pairs(met: DataFrame, recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct pairs a < b of the keys of texts that meet in a small group of some tree."""
    base = base_length(threshold=threshold, recall=recall)
    listed = forest(met).repartition("tree", F.substring("prefix", 1, 4 * base))
    return candidates(listed.sortWithinPartitions("tree", "prefix", "set_key"), base, threshold).distinct()


def shingle_sets(texts: DataFrame, keys: DataFrame, docs: DataFrame) -> DataFrame:
    """set_key, grams of the texts with the given keys; a repeated row of documents may repeat one."""
    keys = stored(keys, "keys")
    ids = texts.join(keys, "set_key", "left_semi").select(F.col("id").alias("__id")).distinct()
    ids = stored(ids, "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def emit(_, sets):
        raw = [s.tobytes() for s in sets]
        digests = [xxhash.xxh3_128_digest(x) for x in raw]
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(raw, pa.binary())], names=["set_key", "grams"])

    wanted = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("__id"), "left_semi")
    return _texts(wanted, emit, "set_key binary, grams binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose whole shingle sets have at least the threshold's Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(both >= threshold * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("set_key").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("set_key").alias("b"), F.col("grams").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a binary, b binary").distinct()


def block_links(tree: int, base: int, threshold: float, rows: list[tuple], same: bool) -> list[tuple]:
    """Links between two blocks of a group, or within one: (a, b, None) of a spanning forest, (a, None, links).

    rows: (set_key, side, big, sig, grams); big has a bit for each tree whose group of the text is large.
    """
    keys = [r[0] for r in rows]
    side = np.array([r[1] for r in rows])
    big = (np.array([r[2] for r in rows])[:, None] >> np.arange(TREES)) & 1 > 0
    sig = np.frombuffer(b"".join(r[3] for r in rows), ">u4").astype(np.uint32).reshape(len(rows), -1)
    size = np.array([len(r[4]) // 8 for r in rows])
    _, codes = np.unique(np.frombuffer(b"".join(r[4] for r in rows), np.uint64), return_inverse=True)
    codes = np.split(codes, np.cumsum(size)[:-1])
    mark = np.zeros(1 + max(int(c.max()) for c in codes), bool)
    links, part, ties = np.zeros(len(rows), np.int64), np.arange(len(rows)), []
    least = least_equal(threshold)
    for i in range(len(rows)):
        if not same and side[i]:
            continue
        near = (size >= threshold * size[i] - 1e-9) & (size[i] >= threshold * size - 1e-9)
        near &= (np.arange(len(rows)) > i) if same else (side == 1)
        to = np.flatnonzero(near)
        equal = sig[to] == sig[i]
        to, equal = to[alike := equal.sum(axis=1) >= least], equal[alike]
        meets = equal.reshape(-1, TREES, DEPTH)[:, :, :base].all(axis=2)
        to = to[~(meets & ~big[i]).any(axis=1) & (meets.argmax(axis=1) == tree)]
        if not len(to):
            continue
        mark[codes[i]] = True
        both = np.add.reduceat(mark[np.concatenate([codes[j] for j in to])], np.cumsum(size[to]) - size[to], dtype=np.int64)
        mark[codes[i]] = False
        to = to[both >= threshold * (size[i] + size[to] - both) - 1e-9]
        links[i] += len(to)
        links[to] += 1
        parts, first = np.unique(part[to], return_index=True)
        ties += [(min(keys[i], keys[j]), max(keys[i], keys[j]), None) for p, j in zip(parts, to[first], strict=True) if p != part[i]]
        part[np.isin(part, parts)] = part[i]
    return ties + [(keys[i], None, int(links[i])) for i in np.flatnonzero(links)]


def compared(met: DataFrame, sets: DataFrame, base: int, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, links: of all large groups, links (a, b, null) that connect what is linked, and counts (a, null, links)."""
    large = F.filter("met", lambda m: m["size"] > GROUP)
    big = F.aggregate(large, F.lit(0), lambda bits, m: bits + F.pow(F.lit(2), m["tree"]).cast("int"))
    rows = met.join(sets, "set_key").select("set_key", "sig", "grams", big.alias("big"), F.explode(large).alias("m"))
    rows = rows.select(
        "set_key", "sig", "grams", "big", "m.tree", "m.blocks", F.expr("pmod(xxhash64(set_key), m.blocks)").cast("int").alias("own"),
        F.expr(f"substring(sig, m.tree * {4 * DEPTH} + 1, {4 * base})").alias("prefix"),
    )
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["tree", "prefix", "x", "y"]
    rows = rows.select(
        "tree", "prefix", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        "set_key", (F.col("own") > F.col("other")).cast("int").alias("side"), "big", "sig", "grams",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def out():
            found = block_links(now[0], base, threshold, list(held.values()), now[2] == now[3]) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.binary(), pa.binary(), pa.int64()))],
                names=["a", "b", "links"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:4] != now:
                    if now:
                        yield out()
                    now, held = row[:4], {}
                held[row[4]] = row[4:]
        if now:
            yield out()

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a binary, b binary, links long")


def components(links: DataFrame) -> DataFrame:
    """id, root: the smallest id of each id's connected component, by alternating stars.

    Large star: every larger neighbour of a node is tied to the node's smallest neighbour; small star: so
    is every smaller one. The number of ties never grows. Ends when a round changes nothing.
    """

    def star(ties: DataFrame, large: bool) -> DataFrame:
        ways = ties.select("a", "b").unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
            ties.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        )
        low = ways.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        tied = ways.join(low, F.col("a") == F.col("n"))
        if large:
            tied = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            tied = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("n").alias("a"), F.col("m").alias("b"))
            )
        return tied.where("a != b").distinct()

    ties = stored(links, "ties")
    state = None
    while True:
        ties = stored(star(star(ties, True), False), "ties")
        now = ties.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return ties.select(F.col("a").alias("id"), F.col("b").alias("root"))
        state = now


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies of every document.

    class_id is the smallest doc_id of the class; n_links counts the links of the document's text to
    other texts; n_copies counts the rows with its shingles, itself included.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = base_length(threshold=threshold, recall=recall)
    signed = stored(signatures(docs), "signatures")
    texts = stored(
        signed.groupBy("set_key").agg(
            F.min("doc_id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")
        ),
        "texts",
    )
    met = stored(texts.select("set_key", "n", "sig").join(meetings(texts, base), "set_key"), "met")
    pairs = stored(candidate_pairs(met, recall, threshold), "pairs")
    large = met.where(F.exists("met", lambda m: m["size"] > GROUP))
    keys = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).union(large.select("set_key")).distinct()
    sets = stored(shingle_sets(texts, keys, docs), "sets")
    listed = stored(verified(pairs, sets, threshold), "links")
    blocks = stored(compared(large, sets, base, threshold), "block-links")
    ends = listed.select(F.col("a").alias("set_key"), F.lit(1).cast("long").alias("links")).union(
        listed.select("b", F.lit(1).cast("long"))
    )
    degree = ends.union(blocks.where("b IS NULL").select("a", "links")).groupBy("set_key").agg(F.sum("links").alias("links"))
    roots = components(listed.union(blocks.where("b IS NOT NULL").select("a", "b")).distinct())
    rooted = texts.select("set_key", "id", "copies").join(roots.withColumnRenamed("id", "set_key"), "set_key", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "set_key")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("class"))
    known = (
        rooted.join(smallest, "root")
        .join(degree, "set_key", "left")
        .select("set_key", "class", F.coalesce("links", F.lit(0)).alias("links"), "copies")
    )
    found = (
        signed.select("doc_id", "set_key")
        .distinct()
        .join(known, "set_key")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("class").alias("class"), F.sum("links").alias("links"), F.max("copies").alias("copies"))
    )
    return docs.select("doc_id").join(found, F.col("doc_id") == F.col("__id"), "left").select(
        "doc_id",
        F.coalesce("class", "doc_id").cast(kind).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """For each class of texts the rows of the smallest name: (doc_id, digest of the text), null doc_ids last.

    Rows that repeat a doc_id and its text stay together; of equal texts without a doc_id one row stays.
    """
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("text"))
    named = docs.withColumn("__name", name)
    classes = join(named.select(F.col("__name").alias("doc_id"), "text"))
    kept = classes.where("doc_id = class_id").select(F.col("doc_id").alias("__kept")).distinct()
    rows = named.join(kept, F.col("__name").eqNullSafe(F.col("__kept")), "left_semi")
    unnamed = rows.where("doc_id IS NULL").dropDuplicates(["__name"])
    return rows.where("doc_id IS NOT NULL").unionByName(unnamed).drop("__name")
