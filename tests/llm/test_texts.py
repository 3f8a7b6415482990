"""Operators on single texts: main text, language, token counts, BPE, backoff scores, archives."""

import base64
import hashlib
import io
import math
import random
import zlib
from collections import Counter

import public_tokenizers as tokenizers
import numpy as np
import pytest

from claimweave.llm import backoff, bpe, html_main, langid, token_counts, warc

RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMALL = tokenizers.path("byte_bpe_50k.tiktoken")
MODEL = tokenizers.path("piece_bpe_32k.model")
EDGE = [
    None, "", " ", "   ", "\n", "a", "  a  b ", "▁", "a▁b", "▁▁ x ", "<|endoftext|>", "<s> </s><0x0A>", "don't we'll", "é\x00b",
    "\x1c\x1d\x85\xa0 　", "ab" * 6000, " " * 5000, "x" * 3000, "中文字 漢字。🙂", "1234567 ½ ²", "end ",
]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    letters = "ab 'stdré\n\t\x0b\x1c\x85\xa0▁12½ 中<>|endoftext  s's’​﻿🙂"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_bpe_is_that_of_the_library_and_round_trips(docs_of, sample_docs):
    import tiktoken

    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (docs_of(list(enumerate(EDGE + fuzz(400))) + [(None, "x"), (1, "y")]), sample_docs):
        expected = Counter()
        for r in docs.collect():
            raw = (r["text"] or "")
            ids = library.encode_ordinary(raw)
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            expected[(r["doc_id"], len(ids), digest, hashlib.sha256(raw.encode()).hexdigest())] += 1
        assert Counter(tuple(r) for r in bpe.encode_documents(docs, RANKS, tokenizers.PATTERN).collect()) == expected
    assert bpe.encode_documents(docs_of([]), RANKS, tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    keys = {f"k{i}".encode(): i * 3 for i in range(5000)}
    table = bpe.PerfectHash(keys)
    assert len(table.keys) == len(keys) and None not in table.keys
    assert all(table.get(k) == v for k, v in keys.items())
    assert table.get(b"other") == -1 and bpe.PerfectHash({}).get(b"") == -1


def test_token_counts_are_those_of_the_library(docs_of, sample_docs, monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(token_counts, "SAMPLE_ROWS", 50)
    for docs in (docs_of(list(enumerate(EDGE + fuzz(400, 2))) + [(None, "x"), (1, "y")]), sample_docs):
        expected = Counter()
        for r in docs.collect():
            n = len(library.encode(r["text"] or ""))
            expected[(r["doc_id"], len((r["text"] or "").encode()), n, n > 4096)] += 1
        assert Counter(tuple(r) for r in token_counts.token_counts(docs, MODEL).collect()) == expected
    assert token_counts.token_counts(docs_of([]), MODEL).count() == 0


def test_frequent_pre_tokens_are_of_the_whole_table(docs_of):
    docs = docs_of([(i, "early words" if i < 2000 else "late words") for i in range(4000)])
    found = "".join(token_counts.frequent_pre_tokens(docs, rows=400))
    assert "early" in found and "late" in found


@pytest.mark.parametrize(("head", "order"), [(1, 2), (40, 2), (1 << 18, 2), (1, 3), (40, 3), (1 << 18, 3)])
def test_backoff_matches_brute_force(docs_of, head, order):
    rng = random.Random(4)
    words = "the of and house garden winter x1 y2".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "Unseen!"), (53, rows[3][1]), (54, "the"), (55, "of the"), (None, "the of the of")]
    got = backoff.scores(docs_of(rows), SMALL, tokenizers.PATTERN, head=head, order=order).collect()
    got = {r["doc_id"]: r for r in got}
    ranks = bpe.read_ranks(SMALL)
    encode = bpe.Encoder(ranks, bpe.PerfectHash(ranks), tokenizers.PATTERN).encode
    tokens = {i: tuple(encode(t or "")) for i, t in rows}

    def grams(x):
        return Counter(x[at : at + k] for k in range(1, order + 1) for at in range(len(x) - k + 1))

    whole = sum((grams(x) for x in tokens.values()), Counter())
    total, vocab = sum(map(len, tokens.values())), max(ranks.values()) + 1
    assert set(got) == set(tokens)
    levels = Counter()
    for i, x in tokens.items():
        count = whole - grams(x)
        score = backed = 0.0
        for at in range(len(x)):
            factor = 0.4 if at == 0 else 1.0
            for k in range(min(order, at + 1), 1, -1):
                gram = x[at - k + 1 : at + 1]
                if count[gram]:
                    score += math.log(factor * count[gram] / count[gram[:-1]])
                    levels[k] += 1
                    break
                factor *= 0.4
            else:
                score += math.log(factor * (count[x[at : at + 1]] + 1) / (total - len(x) + vocab))
                backed += 1
        assert (got[i]["n_tokens"], got[i]["n_backoff"]) == (len(x), backed)
        assert got[i]["log_prob"] == pytest.approx(score)
        assert got[i]["score"] == (pytest.approx(score / len(x)) if x else None)
    assert all(levels[k] for k in range(2, order + 1))


def test_backoff_of_nothing(docs_of):
    for order in (2, 3):
        assert backoff.scores(docs_of([]), SMALL, tokenizers.PATTERN, order=order).count() == 0
    with pytest.raises(ValueError):
        backoff.scores(docs_of([]), SMALL, tokenizers.PATTERN, order=4)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in langid.predict(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(held)
    assert sum(got[i]["lang_pred"] == truth[i] for i in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def naive_phrases(text, sample):
    """Phrases of a text by the longest match in a sample that has its letters, block by block."""
    found = 0
    for start in range(0, len(text), langid.BLOCK):
        block, at = text[start : start + langid.BLOCK], 0
        while at < len(block):
            end = at + 1
            while end < len(block) and block[at : end + 1] in sample:
                end += 1
            found, at = found + 1, end
    return found


def test_phrases_are_those_of_a_naive_parser():
    rng = random.Random(6)
    samples = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in (("abc", 400), ("abcdef", 90), ("f", 5), ("ab", 1))]
    texts = ["", "a", "f", "ff", "gg", "agbga", "abc" * 400, "g" * 600]
    texts += ["".join(rng.choice("aabbccdefg") for _ in range(n)) for n in (3, 40, 511, 512, 513, 1024, 2000)]
    texts += ["".join(rng.choice("abc") for _ in range(n)) for n in (3, 40, 511, 512, 513, 1024, 2000)]
    texts += [samples[0] * 3, samples[1][20:70], samples[0][100:300] + "g" + samples[0][:50]]
    numbers = [np.array([ord(c) - 97 for c in t], dtype=np.int32) for t in texts]
    tables = [langid.Packed(langid.suffix_automaton([ord(c) - 97 for c in s]), 7) for s in samples]
    got = langid._phrases(numbers, tables)
    known = [(k, i) for k, s in enumerate(samples) for i, t in enumerate(texts) if set(t) <= set(s)]
    assert len(known) > 12
    assert [got[k, i] for k, i in known] == [naive_phrases(texts[i], samples[k]) for k, i in known]


def test_language_edge_cases(docs_of):
    rows = [(i, "the house and the garden of winter " * 3, "en") for i in range(30)]
    rows += [(100 + i, "das Haus und der Garten im Winter " * 3, "de") for i in range(30)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "123 ... !", None), (203, "der Garten " * 40_000, None), (203, "the garden"), (None, "the house")]
    docs = docs_of(rows)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs).collect()]
    assert len(got) == len(rows)
    assert {g[1] for g in got if g[0] in (200, 201, 202)} == {"und"} and all(g[2] == 0 for g in got if g[1] == "und")
    assert sorted(g[1] for g in got if g[0] == 203) == ["de", "en"]
    assert {g[1] for g in got if g[0] is None} == {"en"}
    assert langid.predict(docs_of([])).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs_of([(1, "abc"), (2, "x")])).collect()} == {"und"}


def words_in(letters, rng, n=300):
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 5))) for _ in range(n)]
    return lambda k: " ".join(rng.choice(words) for _ in range(k))


def test_every_label_and_every_letter_is_learned(docs_of):
    rng = random.Random(3)
    latin = "abcdefghijklmnopqrstuvwxyz"
    many = {f"l{i:02}": words_in(rng.sample(latin, 12), rng, 60) for i in range(18)}
    many["ko"] = words_in([chr(0xAC00 + 9 * i) for i in range(900)], rng)
    many["zh"] = words_in([chr(0x4E00 + 7 * i) for i in range(900)], rng)
    sizes = {lang: 60 - 2 * i for i, lang in enumerate(many)}
    sizes["l17"] = 4  # too few to set texts aside
    truth = [(lang, many[lang](60)) for lang in many for _ in range(sizes[lang])]
    docs = [(i, text, lang) for i, (lang, text) in enumerate(truth)]
    asked = [(1000 + i, many[lang](40), None) for i, lang in enumerate(many)] + [(2000, "".join(chr(0x0E01 + i % 40) + " " * (i % 6 == 5) for i in range(90)), None)]
    got = {r["doc_id"]: r for r in langid.predict(docs_of(docs + asked)).collect()}
    assert [got[1000 + i]["lang_pred"] for i in range(len(many))] == list(many)
    own = [got[i] for i in range(len(truth)) if i in got] + [got[1000 + i] for i in range(len(many))]
    assert all(r["rate"] <= r["usual_rate"] + 0.375 * (1 - r["usual_rate"]) for r in own)
    assert got[2000]["rate"] > 0.8


def test_pipeline_keeps_languages_of_many_letters(spark, docs_of):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(5)
    speak = words_in([chr(0xAC00 + 9 * i) for i in range(900)], rng, 2000)
    english = words_in("abcdefghijklmnopqrstuvwxyz", rng, 200)
    rows = [(i, english(60), "en") for i in range(60)] + [(100 + i, speak(60), "ko") for i in range(60)]
    rows.append((300, "".join(chr(0x0E01 + i % 40) + " " * (i % 6 == 5) for i in range(90)), None))
    kept = {r["doc_id"] for r in pipeline.language_id(spark, docs_of(rows), "").collect()}
    assert kept == {r[0] for r in rows} - {300}


def test_copies_take_one_place_of_the_sample(docs_of):
    rows = [(i, "copied words", "en") for i in range(3000)] + [(5000 + i, f"text number {i}", "en") for i in range(60)]
    learned = [t for _, t in langid.sample(docs_of(rows), 20, 4096)]
    assert len(learned) == len(set(learned)) == 20


def test_packed_tables_hold_the_automaton():
    rng = random.Random(7)
    for width in (4, 40, 3000):
        sequence = [rng.randrange(width) for _ in range(4000)]
        step = langid.suffix_automaton(sequence)
        packed = langid.Packed(step, width)
        for i, row in enumerate(step):
            cells = [packed.base[i] + c for c in range(width)] if i < 200 else [packed.base[i] + c for c in row]
            letters = range(width) if i < 200 else row
            assert [packed.next[x] if packed.owner[x] == i else None for x in cells] == [row.get(c) for c in letters]


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(6)
    for _ in range(30):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 25))]
        step = langid.suffix_automaton(s)
        inside = {tuple(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)}
        for _ in range(200):
            t = tuple(rng.randrange(3) for _ in range(rng.randrange(6)))
            state = 0
            for c in t:
                state = step[state].get(c, -1) if state >= 0 else -1
            assert (state >= 0) == (t in inside)


ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body><!-- c --><nav>menu one</nav><header>Site head</header>
<div class="cookie-notice">We use cookies.</div><script>var t="</p><p>no</p>";</script><div id="wrap"><div class="post"><h1>A &amp; B</h1>
<p><b>First paragraph, with <i>words</i> and more.<br>Next line, too.<p>Short.</p><p>Another long paragraph, which has commas, and stops.</p>
<ul><li>point one<li>point two</ul><form>Name <input> <button>Send</button></form></div><aside>side text</aside>
<div class="comments"><p>Reader says: this is great, really, a long comment indeed.</p></div></div><footer>&copy; foot</footer>"""


def test_main_text_of_a_plain_layout():
    assert html_main.main_text(ARTICLE) == (
        "A & B First paragraph, with words and more. Next line, too. Short. Another long paragraph, which has commas, "
        "and stops. point one point two"
    )


LONG = [
    f"Paragraph {i} of the text goes on for a while, as articles do, with commas, clauses, and a full stop at its end. "
    "It has a second sentence, too, which is nearly as long as the first one, and says little." for i in range(6)
]


def test_main_text_keeps_what_surrounds_a_nested_article():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    page = f"<body><nav>menu</nav><main><h1>Title</h1><p>A short lead.</p><article>{body}</article></main><footer>f</footer></body>"
    assert html_main.main_text(page) == " ".join(["Title", "A short lead.", *LONG])


def test_main_text_in_divs_beside_articles_of_other_kinds():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    comments = "".join(f'<article class="comment"><p>Reader {i} says: this is great, really, a long comment indeed, and more of it.</p></article>' for i in range(8))
    cards = "".join(f'<article class="card"><a href="/{i}">Other story {i}</a></article>' for i in range(6))
    for page in (
        f"<body><div class='post'><h1>Title</h1>{body}</div>{comments}</body>",
        f"<body><div class='post'><h1>Title</h1>{body}</div><section>{cards}</section></body>",
    ):
        assert html_main.main_text(page) == " ".join(["Title", *LONG])


def test_main_text_in_a_wrapper_with_a_word_of_furniture():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    for wrapper in ('div class="layout has-sidebar"', 'form id="form1"'):
        page = f"<body><{wrapper}><div><h1>Title</h1>{body}</div><div class='sidebar'><p>Side text.</p></div></{wrapper.split()[0]}></body>"
        assert html_main.main_text(page) == " ".join(["Title", *LONG])
    assert html_main.main_text("<body><div class='ad'>An advert that is longer than the text.</div><p>Short.</p></body>") == "Short."


def test_main_text_is_chosen_by_the_threshold(spark, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    whole = [html_main.main_text(p) for p in [*pages, ARTICLE]]
    monkeypatch.setattr(html_main, "content_paths", lambda page, blocks: {b.path for b in blocks})
    without = [html_main.main_text(p) for p in [*pages, ARTICLE]]
    assert all(len(a) < len(b) for a, b in zip(whole, without, strict=True))


def test_main_text_drops_menus_and_teasers_without_a_name():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    menu = "".join(f"<li><a href='/{i}'>Place {i}</a></li>" for i in range(30))
    teasers = "".join(f"<div class='x'><span>Story {i}</span></div>" for i in range(20))
    page = f"<body><ul class='a'>{menu}</ul><div class='b'><h1>Title</h1>{body}</div><div class='c'>{teasers}</div></body>"
    assert html_main.main_text(page) == " ".join(["Title", *LONG])


def test_main_text_keeps_the_header_of_an_article():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    page = f"<body><header>Site</header><article><header><h1>Title</h1></header>{body}<footer>By me</footer></article></body>"
    assert html_main.main_text(page) == " ".join(["Title", *LONG])


def test_main_text_with_furniture_named_by_id_only():
    body = "".join(f"<p>{p}</p>" for p in LONG)
    side = "".join(f"<p>{p.replace('Paragraph', 'Remark')}</p>" for p in LONG[:2])
    for attribute in ("id='comments'", "id='sidebar'", "role='complementary'"):
        page = f"<body><div id='a'><h1>Title</h1>{body}</div><div {attribute}>{side}</div></body>"
        assert html_main.main_text(page) == " ".join(["Title", *LONG])
    few = f"<body><div><p>A short text, of one line.</p></div><div id='comments'>{side}{side}</div><div><p>And its end, too.</p></div></body>"
    assert html_main.main_text(few) == "A short text, of one line. And its end, too."


def test_pages_are_read_in_linear_time():
    def counted(n):
        import sys

        calls = 0

        def count(frame, event, arg):
            nonlocal calls
            calls += 1

        sys.setprofile(count)
        try:
            html_main.read_page("<p><table><td>" + "<span>" * n + "x<div></div>" * n)
        finally:
            sys.setprofile(None)
        return calls

    assert counted(2000) < 2.2 * counted(1000)


def test_main_text_edge_cases(pages_of):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "just text &lt;b&gt;"), (4, "u", "<p>a<p>b"), (5, "u", "<nav>x"),
            (6, "u", "<div>" * 20_000 + "deep" + "</i>" * 20_000), (7, "u", "<a \"'" * 5_000), (8, "u", "<!--" * 5_000),
            (9, "u", "<script>" * 500), (3, "u", "again"), (None, "u", "<p>no id</p>")]
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in html_main.extract(pages_of(rows)).collect())
    texts = {1: "", 2: "", 3: "just text <b>", 4: "a b", 5: "", 6: "deep", 7: "", 8: "", 9: "", None: "no id"}
    assert got == Counter({**{(k, v, len(v)): 1 for k, v in texts.items()}, (3, "again", 5): 1})
    assert html_main.extract(pages_of([])).count() == 0


def test_main_text_of_the_sample_pages(spark):
    import html
    import re

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        plain = html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", body)))
        assert html_main.main_text(r["html"]) == " ".join(plain.split())


def expected_records(rows):
    first = {}
    for page, _, html in rows:
        key = html or ""
        if page is not None and (key not in first or first[key] is None or page < first[key]):
            first[key] = page
        first.setdefault(key, page)
    out = Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        original = first[html or ""]
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[(page, len(raw), sha, "response" if original == page else "revisit", None if original == page else original)] += 1
    return out


@pytest.mark.parametrize("limit", [0, 100_000])
def test_archives_read_back(pages_of, monkeypatch, limit):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", limit)
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rng = random.Random(8)
    rows = [(i, f"http://h.example/é ?{i}", f"<p>page {rng.randrange(60)} text " + "word " * 50) for i in range(300)]
    rows += [(900, None, None), (901, "u\r\nX: y", ""), (902, "u", "é\r\n\r\nWARC/1.1" * 9), (903, "u", "z" * 300_000)]
    rows += [(None, "u", rows[0][2]), (None, "u", "only null"), (902, "u", "é\r\n\r\nWARC/1.1" * 9)]
    got = warc.archived(pages_of(rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r) for r in got.collect()) == expected_records(rows)


def test_dictionary_is_learned_from_the_whole_table(spark, pages_of, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_ROWS", 400)
    seen = []
    monkeypatch.setattr(warc, "record", lambda *r: seen.append(r) or b"x" * 100)
    rows = [(i, "u", f"{i} " + "z" * 30_000) for i in range(1000)]
    warc.train(pages_of(rows + rows[:500]).repartitionByRange(10, "page_id"))
    assert 250 < len(seen) < 550 and {r[0] // 100 for r in seen} == set(range(10))
    assert len({r[2] for r in seen}) == len(seen) and all(len(r[2]) == warc.SAMPLE_CHARS for r in seen)


def test_folders_of_spark_schemes_are_opened(tmp_path):
    assert warc._open(f"file://{tmp_path}/a")[1] == warc._open(f"{tmp_path}/a")[1] == f"{tmp_path}/a"
    opened = []
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(warc, "fs", type("fs", (), {"FileSystem": type("F", (), {"from_uri": staticmethod(opened.append)})}))
        warc._open("s3a://bucket/a:b")
        warc._open("hdfs://node/a")
    assert opened == ["s3://bucket/a:b", "hdfs://node/a"]


def test_archives_of_few_pages_have_no_dictionary(pages_of):
    assert warc.archived(pages_of([])).count() == 0
    got = warc.archived(pages_of([(1, "u", "a"), (2, "u", "a")])).collect()
    assert sorted(r["record_type"] for r in got) == ["response", "revisit"]


def test_dictionary_is_in_a_leading_skippable_frame(pages_of, tmp_path):
    rng = random.Random(12)
    words = [f"word{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(i, "http://h.example/", "<html><body><p>" + " ".join(rng.choices(words, k=60))) for i in range(400)]
    index = warc.archive_pages(pages_of(rows), f"file://{tmp_path}").collect()
    assert sum(r["records"] for r in index) == 400
    for r in index:
        raw = open(r["path"].removeprefix("file://"), "rb").read()
        assert raw[:4] == (0x184D2A5D).to_bytes(4, "little") and len(raw) == r["bytes"]
        assert len(list(warc.frames(io.BytesIO(raw), chunk=100))) == r["records"]
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(warc.archive_pages(pages_of(rows))).collect()}
    assert payloads == {str(i): h for i, _, h in rows}
