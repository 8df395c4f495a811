"""Disclosure operators on small cases with known answers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from filingspark.functions import text as T
from filingspark.operators import audit, dedup, export, filings, recovery, reduce, relational as R, rules, state, telemetry, timewin
from filingspark.plans import filing_queries  # noqa: F401
from filingspark.plans.registry import QUERIES, SQL


def day(n, hour=0):
    return dt.datetime(2026, 8, n, hour)


def ranges(spark, rows, names="k string, s timestamp, e timestamp"):
    return spark.createDataFrame(rows, names)


def test_intervals_merge_when_they_touch(spark):
    df = ranges(spark, [("a", day(6), day(8)), ("a", day(1), day(3)), ("a", day(5), day(6)), ("a", day(3), day(5)), ("a", day(10), day(11)), ("b", day(8), day(9))])
    out = sorted((r.k, r.s.day, r.e.day) for r in timewin.merge_intervals(df, "k").collect())
    assert out == [("a", 1, 8), ("a", 10, 11), ("b", 8, 9)]
    with pytest.raises(Exception, match="ends before it starts"):
        timewin.merge_intervals(ranges(spark, [("a", day(2), day(1))]), "k").collect()


@pytest.mark.parametrize(
    "request_,cover,want",
    [((2, 10), [(1, 3), (7, 8), (5, 6), (12, 13)], [(3, 5), (6, 7), (8, 10)]), ((2, 10), [(1, 11)], []), ((2, 10), [], [(2, 10)]), ((4, 4), [], [(4, 4)]), ((4, 4), [(4, 6)], [])],
)
def test_subtract(spark, request_, cover, want):
    requests = spark.createDataFrame([("a", day(request_[0]), day(request_[1]))], "k string, a timestamp, b timestamp")
    merged = timewin.merge_intervals(ranges(spark, [("a", day(s), day(e)) for s, e in cover]), "k")
    assert sorted((r.lo.day, r.hi.day) for r in timewin.subtract_intervals(requests, merged, "k").collect()) == want


def test_subtract_matches_a_loop(spark):
    rng = random.Random(4)
    cover, asked, want = [], [], []
    for k in range(150):
        own = [(s, s + rng.randrange(4)) for s in [rng.randrange(1, 20) for _ in range(rng.randrange(5))]]
        a = rng.randrange(1, 20)
        b = a + rng.randrange(6)
        cover += [(str(k), day(s), day(e)) for s, e in own]
        asked.append((str(k), day(a), day(b)))
        at, touched = a, False
        for s, e in sorted(own):
            if e < a or s > b:
                continue
            touched = True
            if s > at:
                want.append((str(k), at, s))
            at = max(at, e)
        if at < b or (a == b and not touched):
            want.append((str(k), at, b))
    requests = spark.createDataFrame(asked, "k string, a timestamp, b timestamp")
    out = timewin.subtract_intervals(requests, timewin.merge_intervals(ranges(spark, cover), "k"), "k")
    assert sorted((r.k, r.lo.day, r.hi.day) for r in out.collect()) == sorted(want)


def test_contained_across_midnight(spark):
    merged = ranges(spark, [("a", day(1, 20), day(3, 4))])
    rows = spark.createDataFrame([("a", day(1, 19)), ("a", day(1, 20)), ("a", day(2, 12)), ("a", day(3, 4)), ("a", day(3, 5)), ("b", day(2))], "k string, at timestamp")
    assert timewin.contained(rows, "at", merged, ["k"], "left_semi").count() == 3
    assert timewin.contained(rows, "at", merged, ["k"], "left_anti").count() == 3


def test_boundaries_and_daily_windows(spark):
    df = spark.createDataFrame([("2026-08-05",), ("2026-08-05T23:53:32",), ("2026-08-05T10:00:00Z",), ("bad",)], "t string")
    out = df.select(timewin.boundary(F.col("t")).alias("a"), timewin.boundary(F.col("t"), True).alias("b")).collect()
    assert [str(r.a) for r in out] == ["2026-08-04 17:00:00", "2026-08-05 16:53:32", "2026-08-05 10:00:00", "None"]
    assert str(out[0].b) == "2026-08-05 16:59:59.999999"
    now = day(20, 12)
    cases = spark.createDataFrame([(now, None), (now, now - dt.timedelta(hours=40)), (now, now - dt.timedelta(hours=1))], "now timestamp, c timestamp")
    assert [(now - r[0]).total_seconds() / 3600 for r in cases.select(timewin.daily_window(F.col("now"), F.col("c"))).collect()] == [30, 48, 30]
    with pytest.raises(Exception, match="ahead"):
        spark.createDataFrame([(now, now + dt.timedelta(minutes=10))], "now timestamp, c timestamp").select(timewin.daily_window(F.col("now"), F.col("c"))).collect()


TITLES = {
    "Paparan Publik Tahunan Mei 2027": "PUBLIC_EXPOSE",
    "Laporan Keuangan Triwulan III 2026": "FINANCIAL_REPORT",
    "Pembagian Dividen Interim": "DIVIDEND",
    "Penjelasan Hak Tagih Perseroan": "RIGHTS_ISSUE",
    "Buy Back Saham": "BUYBACK",
    "Surat Berharga Sukuk": "BOND",
    "Perubahan Anggota Direksi": "MANAGEMENT_CHANGE",
    "RUPSLB Tahun 2026": "RUPS",
    "Koreksi Laporan Keuangan": "CORRECTION",
    "Kegiatan Registrasi Pemegang Efek": "ROUTINE_REPORT",
    "Peristiwa Biasa": "ROUTINE_REPORT",
    "Bukti Iklan rancangan penggabungan usaha dua anak perusahaan": "MERGER",
}


def test_title_categories_and_materiality(spark):
    df = spark.createDataFrame([(t, c) for t, c in TITLES.items()], "t string, c string")
    assert df.where(rules.title_category(F.col("t")) != F.col("c")).count() == 0
    cases = [("MERGER", True, False, "HIGH"), ("MERGER", False, True, "MEDIUM"), ("FINANCIAL_REPORT", True, False, "HIGH"), ("DIVIDEND", False, True, "MEDIUM"), ("PUBLIC_EXPOSE", True, False, "ROUTINE"), ("MERGER", None, None, "ROUTINE")]
    df = spark.createDataFrame(cases, "c string, p boolean, w boolean, want string")
    assert df.where(rules.owner_materiality(F.col("c"), F.col("p"), F.col("w")) != F.col("want")).count() == 0


def test_taxonomy(spark):
    rows = [
        ("Unaudited Consolidated Financial Statements 1Q 2026", "buyback and divestment mentioned", "FINANCIAL_REPORT", "LOW", 0.75),
        ("Adjustment of Subsidiary Management of the Company", "financial statements mentioned", "MANAGEMENT_CHANGE", "MEDIUM", 0.75),
        ("Material Information Update", "share buyback", "BUYBACK", "MEDIUM", 0.60),
        ("Nothing", "known", "OTHER", "LOW", 0.45),
    ]
    df = spark.createDataFrame(rows, "title string, facts string, primary string, m string, conf double")
    tags = rules.taxonomy_tags(F.concat_ws(" ", "title", "facts"))
    df = df.withColumn("tags", rules.primary_first(F.col("title"), tags)).withColumn("anchored", rules.headline(F.col("title")).isNotNull())
    p = F.col("tags")[0]
    m = rules.tag_materiality(F.when(F.col("anchored"), F.array(p)).otherwise(F.col("tags")), F.lit(None).cast("string"))
    out = df.select("primary", p.alias("p"), "m", m.alias("got"), "conf", rules.confidence(p, F.col("anchored"), m).alias("c")).collect()
    assert [(r.p, r.got, r.c) for r in out] == [(r.primary, r.m, r.conf) for r in out]
    extra = spark.range(1).select(rules.taxonomy_tags(F.lit("plain"), F.array(F.lit("new mill")), F.array(F.lit(" ")), F.array(F.lit("x"))).alias("t")).first().t
    assert extra == ["EXPANSION", "REGULATORY"]
    hidden = spark.range(1).select(rules.taxonomy_tags(F.lit("pembukaan suspensi")).alias("t")).first().t
    assert hidden == ["SUSPENSION", "UNSUSPENSION"]


BUNDLES = [
    ("Laporan Keuangan Interim", ["Pernyataan Direksi.pdf", "Checklist.pdf", "FinancialStatement.xlsx", "instance.zip", "inlineXBRL.zip", "LK ABCD 31 Maret 2027.pdf"], [2, 5]),
    ("Laporan Keuangan Interim", ["Checklist LK.pdf", "FinancialStatement.xlsx", "a.zip", "Laporan Keuangan TW II 2026.pdf", "management statement.pdf"], [1, 3]),
    ("Keterbukaan", ["main.pdf", "lampiran.xlsx", "bundle.zip"], [0, 1]),
    ("Financial Statements", ["FinancialStatement.xlsx", "FinancialStatement.pdf", "LK X.pdf", "checklist.pdf"], [0, 2]),
    ("Financial Statements", ["FinancialStatement.xlsx", "FinancialStatement.pdf"], [0, 1]),
    ("Financial Statements", ["FinancialStatement.xlsx", "FinancialStatement.pdf", "LKTT Q1 2027_final.pdf", "x.zip"], [0, 2]),
    ("Financial Statements", ["opaque.pdf"], [0]),
]


def test_attachment_selection(spark):
    rows = [(i, t, k, n, k > 0) for i, (t, names, _) in enumerate(BUNDLES) for k, n in enumerate(names)]
    df = spark.createDataFrame(rows, "announcement_id int, title string, ordinal int, filename string, is_attachment boolean")
    out = filings.select_attachments(df).where("selected").collect()
    assert sorted((r.announcement_id, r.ordinal) for r in out) == sorted((i, k) for i, (*_, want) in enumerate(BUNDLES) for k in want)
    everything = filings.select_attachments(df, smart=False).where("announcement_id = 1 and selected").collect()
    assert {r.filename for r in everything} == {"Checklist LK.pdf", "FinancialStatement.xlsx", "Laporan Keuangan TW II 2026.pdf", "management statement.pdf"}


def test_triage(spark):
    routine, neutral = "Laporan Bulanan Registrasi Pemegang Efek", "Jumlah saham tercatat tetap sama. "
    cases = [
        (1, routine, neutral * 80, "routine_direct", []),
        (2, routine, "Terjadi perubahan pengendali perseroan. " * 50, "full", ["control-change"]),
        (3, "Lain", neutral * 80, "full", []),
        (4, routine, "pendek", "full", ["sparse-evidence"]),
        (5, routine, neutral * 3000, "full", ["large-evidence"]),
        (6, routine, None, "full", ["no-evidence"]),
        (7, routine, neutral * 20 + "\nKepemilikan pemegang A 5,10% menjadi 5,30%\n", "full", ["ownership-percentage-delta"]),
        (8, routine, neutral * 20 + "\nKepemilikan pemegang A 5,10% menjadi 5,15%\n", "routine_direct", []),
    ]
    df = spark.createDataFrame([(i, t, x, 0) for i, t, x, *_ in cases], "announcement_id int, title string, text string, ordinal int")
    out = {r.announcement_id: (r.mode, r.signals) for r in filings.triage(df).collect()}
    assert out == {i: (m, s) for i, _, _, m, s in cases}


def test_dedup_is_greedy_not_transitive(spark):
    label, body = "Label. ", "Perseroan menyampaikan informasi penting kepada seluruh pemegang saham. " * 180
    w = body.split()
    near = " ".join(w + ["tambahan", "kata"])
    rows = [
        ("x", "main.pdf", label + body, "sha1", False, 0),
        ("x", "lamp1.pdf", label + body, "sha1", True, 1),
        ("x", "FinancialStatement.xlsx", label + body, "sha2", True, 2),
        ("x", "near.pdf", label + near, "sha3", True, 3),
    ]
    df = spark.createDataFrame([(a, n, n, t, s, i, o) for a, n, t, s, i, o in rows], "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int")
    out = {r.url: (r.keep, r.category, r.duplicate_of_url) for r in dedup.deduplicate(df, 0.98).collect()}
    assert out["main.pdf"] == (True, "analysis_source", None)
    assert out["lamp1.pdf"] == (False, "exact_duplicate", "main.pdf")
    assert out["FinancialStatement.xlsx"][0] and out["near.pdf"][:2] == (False, "near_duplicate")


def test_long_texts_are_compared_whole(spark):
    """A word more in front puts all that a stride would take elsewhere; the other end keeps one text from lying in the other."""
    words = [f"w{i}" for i in range(13000)]
    texts = [" ".join(words), " ".join(["new", *words[:-1], "other"])]
    df = spark.createDataFrame([("x", f"u{i}", f"d{i}.pdf", t, f"sha{i}", False, i) for i, t in enumerate(texts)], "announcement_id string, url string, filename string, text string, sha256 string, is_attachment boolean, ordinal int")
    out = {r.url: (r.keep, r.category, r.similarity) for r in dedup.deduplicate(df).collect()}
    assert sorted(v[:2] for v in out.values()) == [(False, "near_duplicate"), (True, "analysis_source")]
    assert max(v[2] or 0 for v in out.values()) == 12995 / 12998
    assert "6000" not in SQL["dedup_greedy"] + SQL["near_dup_pairs"]


def test_pairs_of_long_texts_are_of_all_shingles(spark, tmp_path):
    words = [f"w{i}" for i in range(13000)]
    texts = [" ".join(words), " ".join(["new", *words[:-1], "other"])]
    docs = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    assert [tuple(r) for r in QUERIES["near_dup_pairs"](spark, str(tmp_path)).collect()] == [("doc:1", "doc:0", round(12995 / 12998, 6))]


def test_resolution_follows_rank(spark):
    pairs = spark.createDataFrame([("g", 2, 1, "near_duplicate", 0.99), ("g", 3, 2, "near_duplicate", 0.99), ("g", 4, 2, "near_duplicate", 0.99), ("g", 4, 3, "near_duplicate", 0.99)], "announcement_id string, later int, earlier int, category string, similarity double")
    # 2 gives way to 1; 3 is like 2 alone and stays; 4 then gives way to 3.
    assert sorted((r.later, r.earlier) for r in dedup.resolve(pairs).collect()) == [(2, 1), (4, 3)]


def test_lanes(spark):
    for n, want in ((20, [*range(19, 13, -1), *range(0, 10), 13, 12, 11, 10]), (6, [5, 4, 3, 2, 1, 0]), (9, [8, 7, 6, 5, 4, 3, 0, 1, 2])):
        df = spark.createDataFrame([("a", i, day(1) + dt.timedelta(minutes=i)) for i in range(n)], "k string, i int, at timestamp")
        assert [r.i for r in R.lanes(df, ["k"], "at", "i").orderBy("place").collect()] == want


def test_upserts_and_patches(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, "x", 0), (2, "y", 1), (3, "z", 0)], "id int, v string, _batch int")
    assert sorted(map(tuple, R.upsert(base, batch, ["id"]).collect())) == [(1, "a"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, R.patch(base, spark.createDataFrame([(1, None)], "id int, v string"), ["id"]).collect())) == [(1, None), (2, "b")]
    rows = spark.createDataFrame([("k", 1, 5), ("k", 2, 6)], "id string, o int, v int")
    assert tuple(R.first_wins(rows, ["id"], "o").first()) == ("k", 1, 5) and tuple(R.last_value(rows, ["id"], "o").first()) == ("k", 1, 6)
    ids = R.append_ids(spark.createDataFrame([(7,)], "n long"), spark.range(50), "n", F.col("id").desc()).orderBy("n").collect()
    assert [(r.n, r.id) for r in ids] == [(8 + i, 49 - i) for i in range(50)]


def test_telemetry(spark):
    runs = [(1, 20, 600.0, 4, 4, 3, 1, 8, 2, 4, 2, 0, 20, 1), (2, 30, 600.0, 4, 2, 3, 3, 8, 8, 4, 4, 0, 30, 0), (3, 40, 600.0, 4, 4, 3, 1, 8, 2, 4, 4, 0, 40, 0)]
    df = spark.createDataFrame(runs, "run int, done int, elapsed double, llm_max int, llm_peak int, workers int, worker_peak int, inflight_max int, inflight_peak int, provider_max int, provider_limit int, waited int, answered int, throttles int")
    out = {r.run: r for r in telemetry.advice(df).collect()}
    assert (out[1].bottleneck, out[1].llm_slots, out[1].changed) == ("provider", 2, True)
    assert (out[2].bottleneck, out[2].extraction_workers) == ("extraction", 4) and out[2].queue >= 12
    assert (out[3].bottleneck, out[3].llm_slots, out[3].per_minute) == ("llm-capacity", 5, 4.0)
    for n, want in ((4, (2, 1, 0)), (8, (3, 1, 1))):
        events = spark.createDataFrame([("p", i, o) for i, o in enumerate((["throttle"] + ["success"] * 7)[:n])], "p string, i int, o string")
        r = telemetry.adaptive_limit(events, "p", ["i"], "o", most=4, step=2).first()
        assert (r.limit, r.throttles, r.ramps) == want
    ewma = telemetry.ewma(spark.createDataFrame([("p", 0, 0.0), ("p", 1, 10.0), ("p", 2, 20.0)], "p string, i int, v double"), "p", ["i"], "v").first().ewma
    assert ewma == pytest.approx(0.22 * 20 + 0.78 * 10)


def test_checkpoints(spark):
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    one = spark.range(1)
    for seen, new, done, want in ((("A",), ("A", "B", "C"), ("B", "C"), (["A", "B", "C"], 2)), (("A",), ("A", "B", "C"), ("B",), (["A", "B"], 1)), ((), ("C",), ("C",), (["C"], 2))):
        ids, at = state.selective(arr(*seen), F.lit(1), arr(*new), F.lit(2), arr(*done))
        assert tuple(one.select(ids, at).first()) == want
    assert one.select(state.remember(arr("a", "b"), arr("b", "c"), 2)).first()[0] == ["b", "c"]


def test_coverage_commits_all_gaps_or_none(spark):
    store, gaps = ranges(spark, [("a", day(1), day(2))]), ranges(spark, [("a", day(2), day(3)), ("b", day(1), day(2))])
    named = lambda d: d.withColumnRenamed("k", "scope")
    runs = spark.createDataFrame([("a", True, 0, False), ("b", False, 0, False)], "scope string, complete boolean, errors int, filtered boolean")
    out = state.commit_coverage(named(store), named(gaps), runs).collect()
    assert [(r.scope, r.s.day, r.e.day) for r in out] == [("a", 1, 3)]


def test_recovery(spark):
    schema = "disclosure_id string, expected_status string, expected_updated_at timestamp, expected_external_id string, ticker string, bucket string, recovery_allowed boolean, declared_attachment_count int, expected_attachment_hashes array<string>"
    record = lambda i, bucket="A", n=1, status="PARTIAL", allowed=False: (i, status, day(1), "e", "BBRI", bucket, allowed, n, ["h"] * min(n, 1))
    manifest = spark.createDataFrame([record("a"), record("b"), record("c"), record("d"), record("e", "E"), record("f", "F", allowed=True), record("g", n=2), record("h", n=0, status="EXTRACTING"), record("i"), record("j")], schema)
    row = lambda i, n=1, done=False, **k: (i, i, "e", k.get("ticker", "bbri"), k.get("source", recovery.SOURCE), k.get("status", "PARTIAL"), day(1), k.get("scope", True), n, k.get("hashes", ["H"] * min(n, 1)), done)
    current = spark.createDataFrame(
        [row("a"), ("b", "z", "e2", "X", "other", "READY", day(2), False, 2, [], False), row("d", done=True), row("e"), row("f"), row("g", 2), row("h", 0, status="EXTRACTING"), row("i"), row("j")],
        "row_id string, disclosure_id string, external_id string, ticker string, source_id string, processing_status string, updated_at timestamp, is_stock_scope boolean, declared_attachment_count int, attachment_hashes array<string>, analysis_present boolean",
    )
    file = lambda i, url, text="ref", down="DOWNLOADED", out="EXTRACTED", there=None, local=None: (i, i, url, "h", down, out, text, there, local)
    files = spark.createDataFrame(
        [file("a", "u"), file("f", "u", down="PENDING"), file("g", "u"), file("g", "v", None, out="PENDING", there=True, local="h"), file("i", "u", there=True, local="x"), file("j", "u", None, out="PENDING", there=True, local="h")],
        "row_id string, disclosure_id string, source_url string, sha256 string, download_status string, extraction_status string, extracted_text_ref string, local_exists boolean, local_sha256 string",
    )
    found = {r.disclosure_id: r.reasons for r in recovery.mismatches(manifest, current).collect()}
    assert found["a"] == [] and found["c"] == [recovery.MISSING] and found["b"] == list(recovery.MISMATCHES)
    out = {r.disclosure_id: (r.outcome, r.action, r.attachments_needed, r.ai_documents) for r in recovery.preflight(manifest, current, files).collect()}
    assert out["a"] == ("READY", "AI_ONLY_RETRY", 0, 1)
    assert out["b"][:2] == out["c"][:2] == ("PRECONDITION_FAILED", "MANUAL_REVIEW")
    assert out["d"][:2] == ("ALREADY_READY", "NOOP") and out["e"][:2] == ("HELD", "HELD")
    assert out["f"] == ("READY", "ATTACHMENT_DOWNLOAD", 2, 3)
    assert out["g"] == ("READY", "AI_ONLY_RETRY", 0, 1) and out["j"] == ("READY", "EXTRACTION_RESUME", 0, 1)
    assert out["h"][:2] == ("READY", "METADATA_PROCESS_RESUME")
    assert out["i"][:2] == ("PRECONDITION_FAILED", "MANUAL_REVIEW")
    cap = recovery.first_cap(spark.createDataFrame([(5, 1), (6, 1)], "requests int, attachments int"), {"requests": 10, "attachments": 1}).first()
    assert cap.exceeded == "requests"
    yes, no = F.lit(True), F.lit(False)
    runs = [(0, 0, yes, yes, no, no), (1, 0, yes, yes, yes, yes), (0, 1, yes, yes, no, yes), (1, 0, no, no, no, no), (0, 0, no, yes, no, no), (0, 0, yes, no, no, no)]
    got = [tuple(spark.range(1).select(*recovery.outcome(F.lit(e), F.lit(p), *rest)).first()) for e, p, *rest in runs]
    assert got == [("COMPLETE", None), ("PARTIAL", "AI_RUN_DEADLINE"), ("PARTIAL", "AI_RATE_LIMITED"), ("PARTIAL", "SOURCE_PROCESSING_PARTIAL"), ("PARTIAL", "SOURCE_COVERAGE_UNPROVEN"), ("PARTIAL", "SOURCE_COVERAGE_NOT_AUTHORIZED")]


def test_chunks_join_to_the_text(spark):
    assert [len(c) for c in reduce.split_chunks("a" * 50_000, 45_000)] == [45_000, 5_000]
    assert len(reduce.split_chunks("a" * 50_000, 22_000)) == 3
    rng = random.Random(1)
    for _ in range(100):
        t = "".join(rng.choice("ab\n") for _ in range(rng.randrange(400)))
        parts = reduce.split_chunks(t, 37)
        assert "".join(parts) == t and all(len(p) <= 37 for p in parts)
    docs = spark.createDataFrame([("u", "x. " * 100), ("v", None)], "url string, text string")
    rows = reduce.chunks(docs, "url", "text", 100).collect()
    assert {r.url: r.chunk_count for r in rows} == {"u": 3, "v": 1}


def test_compatibility_forms_are_tokens(spark):
    df = spark.createDataFrame([("Ｆｕｌｌ ﬁle x²",), ("Plain-1",), (None,)], "t string")
    assert [r[0] for r in df.select(dedup.tokens(F.col("t"))).collect()] == [["full", "file", "x2"], ["plain", "1"], []]


def test_copies_give_way_to_the_first_kept_one(spark):
    """The first of three equal files gives way to another text; the second is then kept, the third gives way to it."""
    pairs = spark.createDataFrame([("g", 2, 1, "near_duplicate", 0.99)], "announcement_id string, later int, earlier int, category string, similarity double")
    same = spark.createDataFrame([("g", 2, "s"), ("g", 3, "s"), ("g", 4, "s")], "announcement_id string, later int, digest string")
    assert sorted((r.later, r.earlier, r.category) for r in dedup.resolve(pairs, same).collect()) == [(2, 1, "near_duplicate"), (4, 3, "exact_duplicate")]


def test_long_chains_resolve(spark):
    pairs = spark.createDataFrame([("g", k + 1, k, "near_duplicate", 0.99) for k in range(1, 500)], "announcement_id string, later int, earlier int, category string, similarity double")
    assert sorted(r.later for r in dedup.resolve(pairs).collect()) == list(range(2, 501, 2))


def test_cache_decisions(spark):
    rows = spark.createDataFrame([("a", "f", 2), ("b", "f", 1), ("c", "f", 3), ("d", "f", 0)], "t string, fingerprint string, n int")
    stored = spark.createDataFrame([("a", "f"), ("c", "old")], "t string, fingerprint string")
    assert {r.t: r.decision for r in reduce.cache_decision(rows, stored, ["t"], "n").collect()} == {"a": "hit", "b": "promoted", "c": "rebuild", "d": "skipped"}


def test_evidence_positions(spark):
    text = "intro\n===== PAGE 2 =====\nLaba bersih naik tajam\npada kuartal"
    df = spark.createDataFrame([(text, "LABA bersih naik"), (text, "laba bersih naik tajam pada kuartal"), (text, "absent"), (text, "")], "t string, e string")
    out = [tuple(r[0]) for r in df.select(audit.locate(F.col("t"), F.col("e"))).collect()]
    assert out == [("exact_text", 3, 2, None), ("normalized_text", None, None, None), ("not_located", None, None, None), (None, None, None, None)]


def test_share_blocks_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("BIRD", 1, ["b"], []), ("ANTM", None, ["a1", " ", "a2"], [])], "ticker string, announcement_count int, corporate_actions array<string>, limitations array<string>")
    out = {r.ticker: r.block for r in audit.share_blocks(df, ["limitations", "corporate_actions"]).collect()}
    assert out["ANTM"] == "---\n\n## ANTM\n\n### Corporate actions\n\n- a1\n- a2\n"
    assert out["BIRD"].startswith("---\n\n## BIRD\n\n**Announcements:** 1\n\n### Corporate actions")
    whole = audit.share_document(df, "2027-01-01", "2027-01-02", ["corporate_actions"]).first()[0]
    assert whole.startswith(f"# {audit.TITLE}\n\n**Window:** 2027-01-01 → 2027-01-02\n**Companies:** 2\n\n> {audit.NOTICE}\n\n---\n\n## ANTM\n")
    export.export_share(df, str(tmp_path / "share"), "2027-01-01", "2027-01-02", ["corporate_actions"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "share").glob("part-*")))
    assert text.rstrip() == whole.rstrip()
    export.export_companies(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    assert export.migrate(df.select("ticker"), "ticker string, added int").columns == ["ticker", "added"]


def test_text_functions(spark):
    df = spark.createDataFrame([("  bbri ", "A.PDF", "https://a.example.com/x", "2026-02-30"), ("", ".hidden", "http://u@example.com", "2026-02-28"), (None, "x", None, None)], "t string, f string, u string, d string")
    allowed = T.host_allowed(F.col("u"), F.array(F.lit("example.com")))
    out = [tuple(r) for r in df.select(T.ticker(F.col("t")), T.suffix(F.col("f")), allowed, T.iso_date(F.col("d")).cast("string")).collect()]
    assert out == [("BBRI", ".pdf", True, None), ("UNKNOWN", "", False, "2026-02-28"), ("UNKNOWN", "", False, None)]
    one = spark.range(1)
    assert one.select(T.truncate(F.lit("abcdef"), 4), T.byte_size(F.lit(2048)), T.byte_size(F.lit(5)), T.joined(F.array().cast("array<string>"))).first()[:] == ("abc…", "2.0 KiB", "5 B", None)
