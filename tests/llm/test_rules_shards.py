"""Native operators: quality cascade, winnowing, sharding."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from claimweave.llm import rules, shards, winnow

WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features(text):
    text = text or ""
    w = re.findall(WORD, text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + o for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for o in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "a b c d e f g h"), (5, "a b c d e f g h a b c d e f g h"),
    (6, "x " * 40), (7, "#$%&|<>* " * 30), (8, "line one here\n" * 4 + "other\x0bword same"), (9, "é" * 3000),
    (10, "one two three four five six seven eight nine " * 3 + "ten"), (10, "again"), (11, "\U0001f642 á " * 30),
    (None, "no id at all"),
]


def test_quality_matches_brute_force(docs_of, sample_docs):
    rng = random.Random(3)
    rows = EDGE + [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(60)]
    for docs in (docs_of(rows), sample_docs):
        got = rules.quality(docs).collect()
        texts = Counter((r["doc_id"], *features(r["text"])) for r in docs.collect())
        assert texts == Counter(
            (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got
        )
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_cascade_keeps_what_quality_keeps(sample_docs):
    kept = {r["doc_id"] for r in rules.quality(sample_docs).where("kept").collect()}
    out = rules.apply_cascade(sample_docs)
    assert out.columns == sample_docs.columns
    assert {r["doc_id"] for r in out.collect()} == kept


def test_cascade_of_nothing(docs_of):
    assert rules.apply_cascade(docs_of([])).count() == 0
    assert rules.quality(docs_of([])).count() == 0


def test_rules_order_by_rejections_per_cost(docs_of):
    docs = docs_of([(i, "#### " * 30) for i in range(50)])
    order = [r.name for r in rules.order_rules(docs, rules.text_rules(docs["text"]))]
    rejecting = {"symbols", "stutter", "repeated_words"}
    assert set(order[:3]) == rejecting and len(order) == 6


def leaks(docs, items):
    windows = {}
    for ident, text in items:
        w = re.findall(ITEM_WORD, lowered(text))
        k = min(10, len(w))
        for i in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(ident)
    sizes = {len(g) for g in windows}
    out = {}
    for ident, text in docs:
        w = re.findall(ITEM_WORD, lowered(text))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= own
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out[ident] = (len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(names.encode()).hexdigest())
    return out


def test_winnowing_matches_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(5)
    pool = "a b c dd ee FF gg hh ii jj".split()
    items = [(i, " ".join(rng.choice(pool) for _ in range(n))) for i, n in enumerate((0, 1, 3, 5, 9, 10, 11, 14, 30, 60))]
    items += [(20, None), (21, items[8][1]), (22, "x " * 12), (23, "é-ü 1.2,3")]
    docs = []
    for i in range(150):
        text = " ".join(rng.choice(pool + [f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(40)))
        if i % 2:
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(w) + 1)
            text += ", " + " ".join(w[a : a + rng.randrange(25)]).upper() + ". " + text[:20]
        docs.append((i, text))
    docs += [(900, None), (901, ""), (902, "x " * 500), (903, "É-Ü é-ü 1 2 3"), (904, " ".join(pool * 2000))]
    frame = spark.createDataFrame([(*r, "q") for r in items], "item_id long, text string, doc_id string")
    for limit in (winnow.BROADCAST_FINGERPRINTS, 0):
        monkeypatch.setattr(winnow, "BROADCAST_FINGERPRINTS", limit)
        got = winnow.contamination(docs_of(docs), frame).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got} == leaks(docs, items)
        assert len(got) == len(docs) and all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_winnowing_judges_each_row_by_its_own_text(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(12))
    frame = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, "a b"), (1, item), (1, "a b c"), (1, item), (2, item + " x")]
    got = winnow.contamination(docs_of(rows).selectExpr("*", "text AS w", "text AS f", "text AS row"), frame)
    found = sorted(((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got.collect()))
    assert found == [
        (0, 2, 0, 0, False), (0, 12, 12, 1, True), (1, 3, 0, 0, False), (1, 12, 12, 1, True), (1, 12, 12, 1, True),
        (2, 13, 12, 1, True),
    ]


def test_winnowing_of_nothing(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert winnow.contamination(docs_of([]), none).count() == 0
    assert [r["n_hit"] for r in winnow.contamination(docs_of([(1, "a b c"), (None, "a")]), none).collect()] == [0, 0]


@pytest.mark.parametrize("n", [0, 1, 39, 40, 203])
def test_shards_are_even_and_mixed(docs_of, n):
    rows = [(i, "t" * (i % 7) if i % 11 else None, "en", "hot" if i % 3 else None if i % 2 else "cold") for i in range(n)]
    got = shards.shard(docs_of(rows)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    by = Counter(r["shard"] for r in got)
    assert not got or max(by.values()) - min(by.get(s, 0) for s in range(40)) <= 1
    for s, count in by.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count))
    source = {r[0]: r[3] for r in rows}
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]]))
        assert r["law"] == "rows" and r["grown_shard"] is None
    for name in set(source.values()):
        share = Counter(source.values())[name] / 40
        mix = Counter(r["shard"] for r in got if source[r["doc_id"]] == name)
        assert all(abs(mix.get(s, 0) - share) <= 2 for s in range(40))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    key = lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest()
    for name in set(source.values()):
        own = [i for i in order if source[i] == name]
        assert own == sorted(own, key=key)


def test_shards_place_repeated_rows(docs_of):
    rows = [(1, "a", "en", "s")] * 50 + [(None, None, None, None)] * 3
    got = shards.shard(docs_of(rows)).collect()
    assert len(got) == 53 and max(Counter(r["shard"] for r in got).values()) <= 2
