"""Word BPE against the tokenizers library."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimweave.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGE = [
    None, "", " ", "\n\n", "a", "A's don't WE'LL", "<|endoftext|>", "x<|startoftext|>Y <|EndOfText|>", "<|<|endoftext|>|>",
    "İstanbul ŞİŞ", "é é ́ ẛ̣ ﬁ ½²Ⅷ", "ΑΣ ΣΑΣ", "中文字。漢字🙂‍👩", "\x1c\x1d\x85\xa0　​ x", "\x00\x7f", "…—«»", "'s'S 'T",
    "ab" * 4000, "Xyz" * 3000 + "!", "a" * 5000, "中" * 4000, "!" * 3000, "12345" * 300, "é" * 2000 + "x", "ǅ ǈ ŉ ß ẞ K Å", "한국어 한",
]


def fuzz(n, seed=4):
    rng = random.Random(seed)
    letters = "abetinshré \n\tA'sdl12½中İΣß́🙂<|endoftext|>.,!…"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(90))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH) as f:
        return word_bpe.Encoder(f.read())


def expected(library, rows):
    out = Counter()
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        out[(doc_id, len(ids), *digests)] += 1
    return out


@pytest.mark.parametrize(("long_text", "piece"), [(word_bpe.LONG_TEXT, word_bpe.PIECE), (40, 8), (900, 300)])
def test_documents_encode_as_the_library_does(docs_of, library, long_text, piece):
    rows = list(enumerate(EDGE + fuzz(300))) + [(None, "x"), (1, "y"), (7, "ab" * 4000), (8, "ab" * 4000)]
    found = word_bpe.encode_documents(docs_of(rows), PATH, long_text, piece)
    assert Counter(tuple(r) for r in found.collect()) == expected(library, rows)


def test_given_documents(sample_docs, library):
    found = word_bpe.encode_documents(sample_docs, PATH)
    rows = [(r["doc_id"], r["text"]) for r in sample_docs.collect()]
    assert Counter(tuple(r) for r in found.collect()) == expected(library, rows)
    assert word_bpe.encode_documents(sample_docs.limit(0), PATH).count() == 0


def test_joined_halves_are_the_whole(encoder):
    rng = random.Random(9)
    for alphabet in ("ab", "the", "aaab", "intheraning", "é中x"):
        for _ in range(150):
            word = encoder.spelled("".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 200))))
            whole = encoder.symbols(word)
            at = rng.randrange(1, len(whole))
            halves = [encoder.merged(whole[:at]), encoder.merged(whole[at:])]
            assert encoder.concatenated(*halves) == encoder.merged(whole) == encoder.encoded(whole)


def test_plain_letters_are_split_by_pattern(encoder):
    assert encoder.plain is not None


def test_every_letter_is_split_as_the_library_does(encoder):
    for code in range(word_bpe.PLAIN_UPTO + 1):
        for text in (f"{chr(code)}{chr(code)}", f"b{chr(code)}'s"):
            assert [encoder.spelled(t) for t in encoder.plain(text.lower())] == encoder.split(text)
