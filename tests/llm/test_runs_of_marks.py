"""No text, however long a run of marks it holds, stops a task or takes more than time in proportion; letters beyond ASCII are letters."""

import itertools
import math
import random
import re
import time
from collections import Counter

import pytest

from filingspark.llm import licenses, toxicity

MARKS = ["- ", "* ", "*", "/", "/* ", "# ", "-", ";", "%", "!", '" ', "1. ", "12) ", "rem ", "dnl ", " ", "<!--", "-->", "\n", "\n* ", "*/\n", "=", "."]


@pytest.mark.parametrize("size", [10 << 20])
def test_licenses_of_long_runs(spark, size):
    began = time.time()
    rows = [(i, m * (size // len(m)) + "\n* MIT License\n") for i, m in enumerate(MARKS)]
    rows += [(100, "".join(random.Random(1).choices(MARKS, k=size // 2)) + "\nMIT License\n"), (101, "MIT License\n")]
    for i in range(0, len(rows), 5):
        df = spark.createDataFrame(rows[i : i + 5], "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.sentence_ids for r in licenses.license_scan(df).collect()}
        assert set(got) == {x for x, _ in rows[i : i + 5]}
    assert time.time() - began < 200


def test_marks_are_taken_off_alike(spark):
    """Java's patterns against Python's on lines of marks, spaces and words."""
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices([*MARKS, " ", "\n", "MIT License", "word", "\t"], k=rng.randrange(1, 14)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def slow(t):
        t = re.sub(r"[\t\r\f\x0B]+", " ", t.lower())
        t = re.sub(licenses.CLOSE, r"\1", re.sub(licenses.BEGIN, r"\1", t))
        return re.sub(r" ?\n ?", "\n", re.sub(" +", " ", re.sub(licenses.NOISE, "", t)))

    got = dict(df.select("doc_id", licenses.normalised(df.text)).collect())
    for i, t in rows:
        assert got[i] == slow(t), t


TRIM = re.compile(rb"^[\"'(\[]+|[\"')\].,;:?!]+$|([^\w\s])\1{2,}$")
SPACED = re.compile(rb"(?<!\S)" + toxicity._ONE + rb"(?:[ ._-]+" + toxicity._ONE + rb")+(?![^\s.,;:!?])")


def test_ends_and_chains_alike():
    rng = random.Random(3)
    for _ in range(20_000):
        token = "".join(rng.choices("ab1!.,()'\"#*-é", k=rng.randrange(9))).encode()
        less = token
        while (cut := TRIM.sub(b"", less)) != less:
            less = cut
        assert toxicity.trimmed(token) == less, token
        text = "".join(rng.choices("ab1é. -_,@zz\n", k=rng.randrange(14))).encode()
        for i in range(len(text)):
            if (i == 0 or text[i - 1 : i].isspace()) and not text[i] & 0xC0 == 0x80:
                m = SPACED.match(text, i)
                assert toxicity.spaced_end(text, i)[0] == (m.end() if m else i), (text, i)


@pytest.mark.parametrize("text", ["x" + m * (10_000_000 // len(m)) + "y" for m in [".", "-", "*", "!", "(", "#", "@", "a", "é", ".-", "a ", "a- ", "a-", "- ", "!.", "'", "a.b@ "]])
def test_toxicity_of_long_runs(text):
    model = toxicity.CharacterModel(toxicity.trigram_counts(b"the quick brown fox"))
    raw = text.encode()[:2_000_000] if len(set(text[1:-1])) > 1 else text.encode()
    began = time.time()
    assert toxicity.restore(raw, model)
    assert time.time() - began < 60


def test_parts_of_long_spans(monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 3)
    assert ["".join(s[0][0] for s in x) for x in toxicity.lattices("abbbbcde")] == ["abb", "cde"]


@pytest.mark.parametrize("word", ["été", "niño", "größe", "naïve", "ÉTÉ"])
def test_model_and_lattice_share_letters(word):
    """Triples are of characters: counted here one by one, and a word's cost is that of its own triples."""
    word = word.lower()
    text = f" {word} {word.upper()}, und {word}" if word != "größe" else f" {word} {word}, und {word}"
    chars = [0, *(toxicity._class(c) for c in text.lower().replace(",", " ")), 0]
    slow = Counter(zip(chars, chars[1:], chars[2:]))
    counts = toxicity.trigram_counts(text.encode()).reshape(toxicity.N, toxicity.N, toxicity.N)
    assert {k: int(counts[k]) for k in itertools.product(range(toxicity.N), repeat=3) if counts[k]} == dict(slow)
    model = toxicity.CharacterModel(counts.ravel())
    x, y = 0, 0
    for c in word:
        z = toxicity._class(c)
        assert (x, y, z) in slow or (x, y) == (0, 0)  # what is looked up has been seen
        x, y = y, z
    assert model.decode(word.encode()).decode() == word.lower() and all(math.isfinite(c) for a in model.costs for b in a for c in b)
    assert toxicity.classes("e\u0301 – 你".encode()).tolist() == [5, 0, 0, 0, 0, 27]  # what isn't a letter is a boundary, as in the lattice
    assert toxicity.trigram_counts(b"a\xff\xfeb").sum() == toxicity.trigram_counts("a��b".encode()).sum()
