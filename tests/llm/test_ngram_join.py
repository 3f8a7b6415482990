"""The n-gram join and the pipeline against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from claimweave.llm import ngram_join, rules, winnow


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(rows):
    """doc_id -> class, and the links between different texts, by comparing all pairs."""
    sets = {i: grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = defaultdict(set)
    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
                if sets[i] != sets[j]:
                    links[i].add(sets[j])
                    links[j].add(sets[i])
    return {i: find(i) for i in sets}, {i: len(links[i]) for i in sets}


def corpus(seed=2, groups=40):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(rng.choice((1, 1, 2, 3))):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9999)}"
            rows.append(" ".join(copy))
            if rng.random() < 0.3:
                rows.append(" \n".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_join_matches_brute_force(docs_of):
    rows = corpus() + [(900, None), (901, ""), (902, "a b"), (903, "a  b"), (904, "x " * 50_000), (905, "x " * 40_000)]
    got = ngram_join.join(docs_of(rows)).collect()
    want, links = classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(rows)
    assert {r["doc_id"]: r["n_links"] for r in got} == links


def test_join_edge_cases(docs_of):
    assert ngram_join.join(docs_of([])).count() == 0
    assert ngram_join.one_of_each(docs_of([])).count() == 0
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (7, text), (3, "other words here"), (5, "other words here"), (None, text), (None, None)]
    got = Counter((r["doc_id"], r["class_id"]) for r in ngram_join.join(docs_of(rows)).collect())
    assert got == Counter({(5, 3): 3, (7, 5): 1, (3, 3): 1, (None, None): 2})


def test_large_groups_stay_whole(docs_of, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        copy = list(words)
        for _ in range(2):
            copy[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(words)) for i in range(500)] + [(5000 + i, f"word{i} " * 3 + "a b c d") for i in range(50)]
    docs = docs_of(rows).repartition(4)
    for texts in (1024, 50):  # one block, and many that are compared two by two
        monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", texts)
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(docs).collect()}
        want, links = classes(rows)
        assert {i: c for i, (c, _) in got.items()} == want
        # many pairs are just at the threshold, where the forest reaches its target recall
        assert all(got[i][1] <= links[i] for i in links)
        assert sum(n for _, n in got.values()) >= ngram_join.RECALL * sum(links.values())


def test_loose_group_keeps_every_link(docs_of):
    """Members of a large prefix group of which many are no links, in chains of slowly changing texts."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(docs_of(rows)).collect()}
    want, links = classes(rows)
    assert {i: c for i, (c, _) in got.items()} == want
    assert sum(n for _, n in got.values()) >= 0.97 * sum(links.values()) and all(got[i][1] <= links[i] for i in links)


def test_large_groups_make_few_rows(docs_of):
    """Rows of the comparison in blocks grow with texts, not with pairs, and no link is listed twice."""
    words = [f"w{i}" for i in range(200)]
    docs = docs_of([(i, " ".join([*words, f"e{i}"])) for i in range(300)])
    base = ngram_join.base_length()
    texts = ngram_join.signatures(docs).withColumnRenamed("doc_id", "id")
    met = texts.join(ngram_join.meetings(texts, base), "set_key")
    sets = ngram_join.shingle_sets(texts, texts.select("set_key"), docs)
    found = ngram_join.compared(met, sets, base).collect()
    assert len(found) < TREES_AND_TEXTS and sum(r["links"] or 0 for r in found) == 300 * 299
    assert not ngram_join.candidate_pairs(met).count()


#: Of 300 texts, each in up to eight trees: one count and one tie for each.
TREES_AND_TEXTS = 8 * 2 * 300


def test_recall_of_the_forest_against_all_pairs(docs_of):
    rng = random.Random(11)
    rows = []
    for g in range(150):
        words = [f"g{g}w{i}" for i in range(100)]
        copy = list(words)
        for at in rng.sample(range(0, 100, 5), 2):
            copy[at] = "changed"
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(copy))]
    got = {r["doc_id"]: r["class_id"] for r in ngram_join.join(docs_of(rows)).collect()}
    want, _ = classes(rows)
    linked = [i for i in want if want[i] != i]
    assert linked and sum(got[i] == want[i] for i in linked) >= 0.97 * len(linked)


def test_join_at_a_lower_threshold(docs_of):
    rows = []
    for g in range(60):
        words = [f"g{g}w{i}" for i in range(60)]
        changed = ["changed" if i in (20, 40) else w for i, w in enumerate(words)]  # 46 of 66 shingles shared
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(changed))]
    low = [r["n_links"] for r in ngram_join.join(docs_of(rows), threshold=0.6).collect()]
    assert len(low) == 120 and sum(low) >= 0.97 * 120
    assert sum(r["n_links"] for r in ngram_join.join(docs_of(rows)).collect()) == 0


def test_base_length_follows_the_recall():
    assert [ngram_join.base_length(8, 0.8, r) for r in (0.9, 0.99, 0.999)] == [6, 3, 2]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["id"]: r["root"] for r in ngram_join.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_pipeline_against_brute_force(spark, docs_of):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in rules.quality(docs).where("kept").collect()}
    want, _ = classes([(i, t) for i, t in rows.items() if i in kept])
    one = {i for i in kept if want[i] == i}
    left = {r["doc_id"] for r in winnow.contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").collect()}
    got = pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == one - left and all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_pipeline_stages_on_edge_cases(spark, docs_of):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    for rows in ([], [(1, None), (2, ""), (None, None), (3, "a b c " * 2000), (3, "a b c")]):
        docs = docs_of(rows)
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf).columns == docs.columns
            stage(spark, docs, sf).collect()
        assert pipeline.STAGES[-1][1](spark, docs, sf).count() == len(rows)


def test_pipeline_judges_rows_without_an_id(spark, docs_of):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").limit(150).collect()
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("text IS NOT NULL").first()["text"]
    clean = docs_of([(d["doc_id"], d["text"], d["lang"]) for d in docs] + [(None, "12 34 56 " * 20)])
    assert pipeline.language_id(spark, clean, sf).where("doc_id IS NULL").count() == 0
    leaked = docs_of([(None, f"before {item} after"), (None, "quite another text"), (7, item)])
    assert [r["text"] for r in pipeline.decontamination(spark, leaked, sf).collect()] == ["quite another text"]


def test_pipeline_judges_rows_that_repeat_an_id_by_their_text(spark, docs_of):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    t, u, v, w = (" ".join(f"{c}{i}" for i in range(40)) for c in "tuvw")
    docs = docs_of([(5, t), (7, t), (3, u), (5, u), (None, v), (None, v), (None, t), (9, w), (9, w)])
    got = [(r["doc_id"], r["text"]) for r in pipeline.near_duplicates(spark, docs, sf).collect()]
    assert sorted(got, key=str) == sorted([(5, t), (3, u), (None, v), (9, w), (9, w)], key=str)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("text IS NOT NULL").first()["text"]
    docs = docs_of([(5, f"before {item} after"), (5, "quite another text")])
    assert [r["text"] for r in pipeline.decontamination(spark, docs, sf).collect()] == ["quite another text"]
