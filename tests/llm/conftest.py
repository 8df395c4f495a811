import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, found string, fp long, k int, rid int, digest string, norm string, n_rows int"
OWN = ("a", "b", 1, 2, 3, "d", "n", 4)


def make_docs(spark, rows):
    """rows: (doc_id, text, lang, source); the other columns clash with names that the operators use."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *OWN) for r in rows], DOCS)


WORDS = {
    "en": "the market and trading report shows that shares were sold with growth through winter months".split(),
    "de": "der markt und handel bericht zeigt dass aktien verkauft wurden mit wachstum durch wintermonate".split(),
    "fr": "le marché et commerce rapport montre que actions étaient vendues avec croissance pendant mois hiver".split(),
    "es": "el mercado y comercio informe muestra que acciones fueron vendidas con crecimiento durante meses invierno".split(),
}


def sentence(rng, lang, n=40):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang), lang, f"src{i % 5}") for i in range(80) for lang in [("en", "de", "fr", "es")[i % 4]]]
    rows += [(100, None, "en", "src0"), (101, "", "en", "src0"), (102, " \t\n ", None, None), (103, "!!! 123 ???", "en", "src1"), (104, "word", None, "other")]
    rows += [(None, "text without an id", "en", None), (None, None, None, None)]
    rows += [(200, rows[0][1], "en", "src2"), (201, rows[0][1].replace(" ", "  \n"), "en", "src2"), (202, rows[1][1], "de", None)]
    rows += [(203, "repeated row of text", "en", "src3")] * 3
    rows += [(204, "same id, first text here", "en", "src3"), (204, "same id, second text here", "en", "src3")]
    rows += [(205, sentence(rng, "en", 60_000), "en", "src0"), (206, "ab" * 150_000, "en", "src0"), (207, "é" * 10 + " ñandú 你好 мир", "es", "src0")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return make_docs(spark, edge_rows).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
