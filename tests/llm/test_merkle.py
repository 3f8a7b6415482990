"""Merkle manifest against a plain tree built in Python."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from claimweave.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    row = dict(r, n_chars=None if r["n_chars"] is None else r["n_chars"] + more)
    texts = [None if row[c] is None else str(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return H(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def proof_of(levels, i):
    found = []
    for nodes in levels[:-1]:
        found += nodes[i ^ 1 : (i ^ 1) + 1]
        i >>= 1
    return found


def refold(leaf, proof, trees):
    proof = list(proof)
    for levels, i in trees:
        for nodes in levels[:-1]:
            if i ^ 1 < len(nodes):
                other = proof.pop(0)
                leaf = H(other, leaf) if i & 1 else H(leaf, other)
            else:
                leaf = H(leaf)
            i >>= 1
    return leaf


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for lang in order:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append(levels_of([leaf_of(r) for r in groups[lang]]))
    top = levels_of([t[-1][0] for t in trees]) if trees else None
    out = Counter()
    for g, lang in enumerate(order):
        for i, r in enumerate(groups[lang]):
            proof = proof_of(trees[g], i) + proof_of(top, g)
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = refold(leaf_of(r, int(hit)), proof, [(trees[g], i), (top, g)])
            root = top[-1][0]
            out[(r["doc_id"], leaf_of(r), trees[g][-1][0], root, H(*proof), folded, folded == root)] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def made(docs):
    return Counter(tuple(r) for r in merkle.manifest(docs).select(*COLUMNS).collect())


def test_manifest_of_documents(sample_docs):
    rows = [r.asDict() for r in sample_docs.collect()]
    want = brute(rows)
    assert made(sample_docs) == want
    assert 0 < sum(n for r, n in want.items() if not r[-1]) < len(rows)


def test_null_repeated_and_distant_ids(docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "HOT_ROWS", 40)
    monkeypatch.setattr(merkle, "COPIES", 8)
    rows = [(None, f"t{i % 9}", "en") for i in range(60)]
    rows += [(7, f"t{i}", "en") for i in range(90)] + [(7, "same", "en", "s", 3)] * 30
    rows += [(i * 65536 * 9 - 2**40, "x", "de", None, i) for i in range(300)]
    rows += [(-(2**63), "", None), (2**63 - 1, None, None, None, 2**63 - 1), (None, None, None), (0, "é中", "é", "", 0)]
    docs = docs_of(rows)
    assert made(docs) == brute([r.asDict() for r in docs.collect()])


def test_more_than_one_array_of_slots(docs_of):
    docs = docs_of([(i * 3, str(i), "en", "s", 1) for i in range(129)] + [(1, "a", l) for l in map(str, range(140))])
    assert made(docs) == brute([r.asDict() for r in docs.collect()])


def test_a_lone_leaf_and_no_leaf(docs_of):
    ((_, leaf, subroot, root, proof, folded, _),) = made(docs_of([(5, "a")]))
    assert leaf == subroot == root and proof == H()
    assert merkle.manifest(docs_of([])).count() == 0


@pytest.mark.parametrize("size", [0, 1, 255, 256, 3000, 4096])
def test_bitmap_ranks(size):
    rng = np.random.default_rng(size)
    counts = np.zeros(merkle.IDS, np.int64)
    counts[rng.choice(merkle.IDS, size, replace=False)] = rng.integers(1, 4, size)
    bits, extra = merkle.pack(counts)
    lows, rows = merkle.unpack(bits, extra)
    assert (counts[lows] == rows).all() and rows.sum() == counts.sum()
    rank, ties = merkle.Ranks(bits, extra).query(lows)
    assert (rank == np.cumsum(counts)[lows] - rows).all() and (ties == rows).all()
