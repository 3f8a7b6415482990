"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled texts. A text is parsed
from left to right into the longest phrases that occur in the sample; the fewer phrases a text needs per
character, the better the language explains it. Phrase counts are normalised by the automaton's own
rate on held-back sample text, so that languages with samples of another size or variety compare fairly.

Automata become packed transition tables that numpy follows for many texts at once. Texts are parsed
whole, in blocks of BLOCK letters; a phrase ends at a block's end, for every language alike. Every label is
learned, and the alphabet holds every letter of every sample, whatever the script.

Bounds, as parameters: `sample_docs` distinct texts, an excerpt of `excerpt` characters from each (its place
follows from a hash) and `sample_chars` characters a language. The driver holds the excerpts of all labels, and
the tables broadcast have at most 3 x sample_chars transitions a language, so both grow with the number of
labels, as does the time for a text. They bound what is learned from; what is labelled has no bound.

Cases: a null text, or one without a letter, is `und` with score 0, as is every text where nothing is
labelled; very long texts are parsed whole; ties go to the label that sorts first; repeated rows are
labelled alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import map_batches

BLOCK = 512
HELD_BACK = 5  # each language sets aside every fifth sample text, or of few texts a fifth each, to measure its own rate


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id's text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, sample_docs: int, excerpt: int) -> list[tuple[str, str]]:
    """(lang, excerpt) of at most `sample_docs` distinct texts for each label.

    Hashes of the text decide, at a rate set by the label's count of distinct texts, so no label's rows meet in
    one task; the texts near the rate are then ranked, a bounded number for each label.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    start = F.pmod(F.xxhash64("text", F.lit("start")), F.greatest(F.char_length("text") - excerpt + 1, F.lit(1))) + 1
    known = known.select(
        "lang", F.substring("text", start.cast("int"), F.lit(excerpt)).alias("text"), F.xxhash64("text").alias("h")
    )
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()
    if not counts:
        return []
    shares = [(r["lang"], min(1.0, 2.0 * sample_docs / max(1, r["n"]))) for r in counts]
    shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))
    near = known.join(shares, "lang").where((F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < F.col("share"))
    near = near.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    rows = near.withColumn("r", F.row_number().over(place)).where(F.col("r") <= sample_docs)
    return [(r["lang"], r["text"]) for r in rows.orderBy("lang", "r").select("lang", "text").collect()]


def _letter(c: str) -> str:
    low = c.lower()
    return low if len(low) == 1 else c


def _fold_table(letters: list[str]) -> np.ndarray:
    """Code point -> letter number; 1 for letters that no sample has, 0 for what is no letter."""
    table = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    number = {c: i + 2 for i, c in enumerate(letters)}
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            table[code] = number.get(_letter(c), 1)
    return table


def folded(text: str, table: np.ndarray) -> np.ndarray:
    """Letter numbers of a text, with one 0 for each run of anything else."""
    codes = np.frombuffer(unicodedata.normalize("NFC", text).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = table[codes]
    keep = out != 0
    keep[1:] |= out[:-1] != 0
    return out[keep]


def suffix_automaton(sequence: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the sequence's substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link = [-1]
    length = [0]
    last = 0
    for c in sequence:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step


class Packed:
    """Transitions with the rows of all states laid into one another: a cell names the state that owns it.

    Room follows from the transitions, not from states x letters, so that any alphabet fits.
    """

    def __init__(self, step: list[dict[int, int]], width: int):
        self.base = np.zeros(len(step), dtype=np.int32)
        taken = bytearray(2 * len(step) + 2 * width)
        begin: dict[int, int] = {}  # by row size, where the search goes on; smaller rows fill what is passed over
        for i in sorted((i for i, row in enumerate(step) if row), key=lambda i: (-len(step[i]), i)):
            row = sorted(step[i])
            at = max(begin.get(len(row), 0), row[0])
            while any(taken[at - row[0] + c] for c in row):
                at = taken.find(0, at + 1)
                if at < 0 or at + width >= len(taken):
                    at = len(taken) - width if at < 0 else at
                    taken.extend(bytes(len(taken)))
            begin[len(row)] = at
            self.base[i] = at - row[0]
            for c in row:
                taken[at - row[0] + c] = 1
            if at + 2 * width >= len(taken):
                taken.extend(bytes(len(taken)))
        size = int(self.base.max(initial=0)) + width
        self.owner = np.full(size, -1, dtype=np.int32)
        self.next = np.zeros(size, dtype=np.int32)
        for i, row in enumerate(step):
            for c, j in row.items():
                self.owner[self.base[i] + c] = i
                self.next[self.base[i] + c] = j
        self.root = np.zeros(width, dtype=np.int32)  # a letter that the sample lacks is a phrase of its own
        for c, j in step[0].items():
            self.root[c] = j


class Model:
    """Automata, alphabet and rates of the learned languages."""

    def __init__(self, rows: list[tuple[str, str]], sample_chars: int):
        count: Counter[str] = Counter()
        own: dict[str, list[str]] = {}
        for lang, text in rows:
            own.setdefault(lang, []).append(text)
            count.update(_letter(c) for c in unicodedata.normalize("NFC", text) if c.isalpha())
        self.letters = [c for c, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))]
        fold = _fold_table(self.letters)
        self.langs = sorted(own)
        self.tables: list[Packed] = []
        rates: list[float | None] = []
        for lang in self.langs:
            texts = [folded(t, fold) for t in own[lang]]
            if len(texts) >= 2 * HELD_BACK:
                back = texts[::HELD_BACK]
                learn = [t for i, t in enumerate(texts) if i % HELD_BACK]
            else:
                cuts = [len(t) - len(t) // HELD_BACK for t in texts]
                back = [t[c:] for t, c in zip(texts, cuts, strict=True)]
                learn = [t[:c] for t, c in zip(texts, cuts, strict=True)]
            # Each text gives its share of the sample, so that one long text doesn't fill it.
            share = max(64, sample_chars // max(1, len(learn)))
            sequence = np.concatenate([np.append(t[:share], 0) for t in learn])[:sample_chars]
            self.tables.append(Packed(suffix_automaton(sequence.tolist()), len(self.letters) + 2))
            letters = sum(len(t) for t in back)
            rates.append(max(1e-9, _phrases(back, self.tables[-1:]).sum() / letters) if letters else None)
        measured = [r for r in rates if r is not None]
        mean = sum(measured) / len(measured) if measured else 1.0
        #: Phrases a letter of a language's held-back text; the mean of the others where it has none.
        self.usual = [mean if r is None else float(r) for r in rates]
        self.rates = [r / mean for r in self.usual]


def _phrases(texts: list[np.ndarray], tables: list[Packed]) -> np.ndarray:
    """Number of phrases per table and text. All blocks of all texts advance together, letter by letter."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    if not len(owner):
        return np.zeros((len(tables), len(texts)), dtype=np.int64)
    flat = np.concatenate(texts)
    first = np.cumsum(sizes) - sizes
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[owner] + inner * BLOCK
    length = np.minimum(sizes[owner] - inner * BLOCK, BLOCK)
    order = np.argsort(-length, kind="stable")
    begin, length, owner = begin[order], length[order], owner[order]
    alive = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")  # blocks of at least so many letters
    out = np.zeros((len(tables), len(texts)), dtype=np.int64)
    for k, table in enumerate(tables):
        state = np.zeros(len(begin), dtype=np.int32)
        ends = np.ones(len(begin), dtype=np.int64)  # the last phrase of each block
        for i in range(int(length[0])):
            n = alive[i]
            letter = flat[begin[:n] + i]
            cell = table.base[state[:n]] + letter
            stop = table.owner[cell] != state[:n]
            ends[:n] += stop
            state[:n] = np.where(stop, table.root[letter], table.next[cell])
        np.add.at(out[k], owner, ends)
    return out


def predict(
    docs: DataFrame,
    sample_docs: int = 400,
    sample_chars: int = 24_000,
    excerpt: int = 4_096,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rate (phrases a letter under the predicted language) and usual_rate
    (that of the language's own held-back text).

    Columns named in `carried` follow as they are. score is 0.5 where two languages explain the text equally well and nears 1 as the others need more
    phrases; 1 where only one language was learned.
    """
    rows = sample(docs, sample_docs, excerpt)
    model = Model(rows, sample_chars) if rows else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        fold = _fold_table(model.letters) if model else None

        def apply(part):
            out = {c: part[c] for c in ("doc_id", *carried)} | {"lang_pred": [], "score": [], "rate": [], "usual_rate": []}
            texts = [folded(t or "", fold) if model else np.zeros(0, np.int32) for t in part["text"]]
            counts = _phrases(texts, model.tables) if model else None
            for i, text in enumerate(texts):
                if not model or not text.any():
                    lang, score, rate, usual = "und", 0.0, None, None
                else:
                    need = [counts[k, i] / r for k, r in enumerate(model.rates)]
                    best = min(range(len(need)), key=need.__getitem__)
                    rest = min((x for k, x in enumerate(need) if k != best), default=None)
                    lang = model.langs[best]
                    score = 1.0 if rest is None else rest / (rest + need[best])
                    rate, usual = counts[best, i] / len(text), model.usual[best]
                out["lang_pred"].append(lang)
                out["score"].append(float(score))
                out["rate"].append(rate)
                out["usual_rate"].append(usual)
            return out

        return apply

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *carried)]
    schema = ", ".join([*kinds, "lang_pred string, score double, rate double, usual_rate double"])
    found = map_batches(docs.select("doc_id", "text", *carried), make, schema, rows=1024)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rate", "usual_rate", *carried
    )
