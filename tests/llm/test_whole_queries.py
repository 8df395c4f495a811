"""Whole queries and the pipeline against plain Python, and the classifiers on cases made for them."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from filingspark.llm import decontaminate, language_id, near_copies, pii, queries, toxicity
from filingspark.llm.common import hash_mod

from .conftest import WORDS, make_docs, sentence


TRIM = re.compile(rb"^[\"'(\[]+|[\"')\].,;:?!]+$|([^\w\s])\1{2,}$")


def shingles(text, width=5):
    w = text.lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_pipeline_against_plain_python(spark, tmp_path):
    """Stage by stage: rejected languages, equal texts, similar texts, benchmark passages; then what mixing may take."""
    rng = random.Random(12)
    rows = [(i, sentence(rng, lang, 60), lang, f"src{i % 3}") for i in range(120) for lang in [list(WORDS)[i % 4]]]
    rows += [(200 + i, rows[i][1].replace(" ", "\n\t", 3), "en", "src0") for i in range(5)]  # equal texts
    for i in range(10, 16):  # one word of 60 changed: a similarity of 0.8 and more, or less if it is two
        w = rows[i][1].split()
        w[30] = "altered"
        rows.append((300 + i, " ".join(w), rows[i][2], "src1"))
        w[10] = w[45] = "otherwise"
        rows.append((400 + i, " ".join(w), rows[i][2], "src1"))
    items = [(k, sentence(rng, "en", 25)) for k in range(4)]
    for k, text in items:
        rows.append((500 + k, sentence(rng, "en", 40) + " " + text + " " + sentence(rng, "en", 40), "en", "src2"))
    rows += [(600, None, None, None), (601, "12345 !!!", "en", "src0"), (602, "", "de", "src1")]
    docs = make_docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = language_id.train(docs, hash_mod("doc_id", 3) != 1)
    kept = []
    for r in rows:
        lang, score = model.predict([(r[1] or "").encode()])[0]
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            kept.append(r)
    first = {}
    for r in sorted(kept, key=lambda r: r[0]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
    kept = sorted(first.values(), key=lambda r: r[0])
    sets = {r[0]: shingles(r[1]) for r in kept}
    root = {i: i for i in sets}
    find = lambda i: i if root[i] == i else find(root[i])
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = [r for r in kept if find(r[0]) == r[0]]
    bags = [Counter(decontaminate.shingles(decontaminate.words(t))) for _, t in items]
    sizes = [len(decontaminate.words(t)) for _, t in items]

    def holds(text):
        w = decontaminate.words(text)
        return any(decontaminate.similarity(Counter(decontaminate.shingles(w[i : i + n])), bag) >= 0.8 for bag, n in zip(bags, sizes) for i in range(len(w) - n + 1))

    kept = [r for r in kept if not holds(r[1])]
    stage = docs
    for _, run in corpus_pipeline.STAGES[:-1]:
        stage = run(spark, stage, str(tmp_path))
    assert sorted(r.doc_id for r in stage.collect()) == sorted(r[0] for r in kept)
    ids = {r[0] for r in kept}
    assert not {200, 201, 310, 311, 500, 501, 600, 601, 602} & ids and {410, 411} & ids

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokens = {r[0]: len(r[1].split()) for r in kept}
    assert {r.doc_id for r in out} <= ids and all(r.n_tokens == tokens[r.doc_id] and 0 < r.taken <= r.n_tokens and 1 <= r.epoch <= queries.MAX_EPOCHS for r in out)
    assert abs(sum(r.taken for r in out) - queries.FRACTION * sum(tokens.values())) <= 1


def test_language_predictions_of_the_whole_query(spark):
    """Each row's prediction is the one that its features give, one by one."""
    rng = random.Random(8)
    rows = [(i, sentence(rng, lang, rng.randrange(3, 60)), lang, "s") for i in range(200) for lang in [list(WORDS)[i % 4]]] + [(900, None, None, None), (901, "42", "en", "s")]
    docs = make_docs(spark, rows)
    model = language_id.train(docs.select("doc_id", "text", "lang"), hash_mod("doc_id", 3) != 1, 30)
    n = len(model.families)
    for r in language_id.language_id(docs, 30).collect():
        text = dict((i, t) for i, t, *_ in rows)[r.doc_id] or ""
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        margins = model.weights[:, :-1] @ language_id.frequencies(text.encode()) + model.weights[:, -1]
        sure = 1 / (1 + np.exp(-2 * margins))
        best = int(np.argmax(margins[:n]))
        votes, least = Counter(), {}
        for k, (a, b) in enumerate(model.pairs, n):
            if a in model.families[best][1]:
                won, p = (a, sure[k]) if margins[k] >= 0 else (b, 1 - sure[k])
                votes[won] += 1
                least[won] = min(least.get(won, 1.0), p)
        lang = max(model.families[best][1], key=lambda x: (votes[x], least.get(x, 1.0), x))
        assert r.lang_pred == lang and np.isclose(r.score, sure[best] * least.get(lang, 1.0), atol=1e-3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_toxicity_scores_of_the_whole_query(spark):
    """Each row's score is the one that its restored words give, one by one."""
    rng = random.Random(9)
    rows = [(i, sentence(rng, "en", 20) + (" you id1ot" if i % 5 == 0 else "") + (" s t u p i d" if i % 10 == 5 else ""), "en", "s") for i in range(300)] + [(900, None, None, None)]
    docs, labels = make_docs(spark, rows), spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    characters = toxicity.character_model(docs.select("doc_id", "text"))
    classifier = toxicity.train(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), hash_mod("doc_id", 5) != 0, characters, 100)
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    for r in toxicity.toxicity(docs, labels, 100).collect():
        restored = []
        text, end = texts[r.doc_id], 0
        for s, e in toxicity.suspects(text):
            core = text[s:e]
            while (less := TRIM.sub(b"", core)) != core:
                core = less
            read = toxicity.viterbi(toxicity.lattice(core.decode().lower()), characters.costs).encode()
            restored += [text[end:s], read, b" ", core, b" "]
            end = e
        whole = b"".join([*restored, text[end:]])
        z = classifier.bias + sum(classifier.weights.get(w, 0.0) for w in toxicity.words(whole))
        assert np.isclose(r.score, 1 / (1 + np.exp(-z))) and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def planted(rng):
    """(text, span or None): personal data in forms that training doesn't make, and numbers and phrases that are none."""
    name, host = rng.choice(["ana.li", "bob77", "c_dee", "kim"]), rng.choice(["post.net", "uni.edu", "firm.de"])
    digits = "".join(rng.choice("0123456789") for _ in range(10))
    card = "5" + "".join(rng.choice("0123456789") for _ in range(14))
    card += next(c for c in "0123456789" if pii.luhn(card + c))
    before = rng.choice(["Reach me at ", "Contact: ", "my number is ", "see "])
    good = [f"{name} {{at}} {host.replace('.', ' {dot} ')}", f"{name}[at]{host}", f"+49 {digits[:3]} {digits[3:6]} {digits[6:]}", f"({digits[:3]}) {digits[3:6]}.{digits[6:]}", f"{card[:4]}/{card[4:8]}/{card[8:12]}/{card[12:]}", f"{rng.randint(11, 223)}[.]{rng.randint(0, 255)}[.]{rng.randint(0, 255)}[.]{rng.randint(1, 254)}"]
    bad = [f"on {rng.randint(10, 28)}.{rng.randint(10, 12)}.20{rng.randint(10, 27)}", f"order {digits[:4]} of {digits[4:7]} items", f"pages {digits[:2]}-{digits[2:4]}", "we met at the station. Then we left", f"v{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"EUR {digits[:3]},{digits[3:5]}", f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{rng.randint(300, 999)}.{rng.randint(300, 999)}"]
    if rng.random() < 0.5:
        span = rng.choice(good)
        return before + span + " soon", (len(before), len(before) + len(span))
    return before + rng.choice(bad) + " soon", None


def test_personal_data_of_other_forms(spark):
    """Added and base spans together: at least nine in ten found spans are right, and six in ten planted ones are found."""
    rng = random.Random(21)
    made = [planted(rng) for _ in range(600)]
    docs = make_docs(spark, [(i, t, "en", "s") for i, (t, _) in enumerate(made)])
    right = found = there = caught = 0
    for r in pii.pii_digest(docs).collect():
        want = made[r.doc_id][1]
        spans = [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if x]
        there += want is not None
        hit = [s for s in spans if want and s[0] < want[1] and want[0] < s[1]]
        found += len(spans)
        right += len(hit)
        caught += bool(hit)
    assert right >= 0.9 * found and caught >= 0.6 * there


def altered(rng, w, most):
    v = list(w)
    for at in rng.sample(range(len(v)), rng.randrange(most + 1)):
        v[at] = f"x{rng.randrange(10**6)}"
    return v


def test_least_hashes_are_exact_for_short_texts_and_lose_nothing_here():
    rng = random.Random(5)
    for n_words in (0, 3, 120, 255, 600, 3000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
        sets = [near_copies.shingle_set(" ".join(altered(rng, base, n_words // 40)).encode()) for _ in range(12)]
        own = near_copies.Sets([s[: near_copies.LEAST].tobytes() for s in sets], np.array([len(s) for s in sets]))
        for i, s in enumerate(sets):
            for t, whole, found in zip(sets, own.whole.tolist(), own.similarity(i, np.arange(len(sets))).tolist(), strict=True):
                exact = near_copies.similarity(s, t)
                assert found == exact if whole and own.whole[i] else abs(found - exact) <= near_copies.SHORT


def test_an_open_shard_gives_a_tree_of_what_is_similar_not_its_pairs():
    """A group of 300 short texts, many of them not quite similar: edges join what brute force joins, at most one a text."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    sets = [near_copies.shingle_set(" ".join(altered(rng, base, 6)).encode()) for _ in range(300)]
    prints = np.array([near_copies.sketch(" ".join(base).encode())[1]] * len(sets))
    n = len(sets)
    columns = [np.zeros(n), np.zeros(n), np.zeros(n), np.arange(n), prints, np.array([len(s) for s in sets]), np.arange(n), np.zeros(n), np.zeros(n)]
    names = ["key", "left", "right", "fp", "print", "n", "root", "main", "part", "least"]
    batch = pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in columns], pa.array([s[: near_copies.LEAST].tobytes() for s in sets], pa.binary())], names)

    def joined(edges):
        root = list(range(n))
        for u, v in edges:
            root = [root[u] if r == root[v] else r for r in root]
        return [root.index(r) for r in root]

    edges = [(r["u"], r["v"]) for b in near_copies._pairs_apart(64, 0.8, True)(iter([batch[:100], batch[100:]])) for r in b.to_pylist()]
    similar = [(u, v) for u in range(n) for v in range(u) if near_copies.similarity(sets[u], sets[v]) >= 0.8]
    assert n < len(similar) < n * (n - 1) / 4 and len(edges) < n
    assert joined(edges) == joined(similar)
    assert not list(near_copies._pairs_apart(64, 0.8, False)(iter([batch])))


def test_work_tables_are_removed(spark, edge_docs):
    from filingspark.llm import common

    before = common.tables()
    path = common.cut(edge_docs.select("doc_id").where("doc_id is not null"), "one").inputFiles()[0].rsplit("/", 1)[0]
    common.cut(edge_docs.select("doc_id"), "two")
    assert common.tables() == before + 2
    common.clean(before)
    assert common.tables() == before
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
