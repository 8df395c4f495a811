"""Contracts, structured analyses, collection and rendering on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from filingspark.functions import render as X
from filingspark.operators import audit, collect, contracts, scans


def test_violations_and_strict_json(spark):
    df = spark.createDataFrame([(1, "ok", 5), (2, " ", None)], "k int, t string, n int")
    out = sorted(map(tuple, contracts.violations(df, "k", {"text": contracts.text_between(F.col("t"), 1, 9), "number": F.col("n") > 1}).collect()))
    assert out == [(2, "number"), (2, "text")]
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2}}',), ('{"a": 1}',), ('{"a": 1, "b": null, "z": 3}',), ("nope",)], "j string")
    assert [r.problem for r in contracts.parse_strict(df, "j", "a int, b struct<c:int,d:int>").collect()] == [None, "missing:b", "unknown:z", "invalid"]


def test_titles_sections_provenance(spark):
    one = spark.range(1)
    null = F.lit(None).cast("string")
    assert one.select(*contracts.title_of(F.lit(" "), F.lit("S "), null, F.lit("T"))).first()[:] == ("S", "subject")
    assert one.select(*contracts.title_of(null, null, null, F.lit("T"))).first()[:] == ("IDX disclosure T", "synthetic")
    known = ("a", "b", "c")
    arr = lambda *x: F.array(*map(F.lit, x))
    assert one.select(contracts.sections(arr("c", "a", "c"), known)).first()[0] == ["a", "c"]
    with pytest.raises(Exception, match="unknown sections"):
        one.select(contracts.sections(arr("z"), known)).collect()
    kept = one.select(contracts.provenance(F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2")), ("x",), arr("A.com", "a.com "))).first()[0]
    assert kept.metadata == {"x": "1"} and kept.hosts == ["a.com"]


def test_structured(spark):
    scenario = {"analysis": " maybe ", "classification": "derived_calculation", "confidence": "high", "basis": ["a", " ", "b"], "assumptions": None, "caveats": None}
    full = {"category": None, "executive_summary": " Sum ", "material_facts": ["fact", " "], "expansion_projects": ["mill"], "analytical_scenarios": [scenario], "financial_figures": [{"metric": "m", "value": "1", "period": None}, {"metric": "", "value": "2", "period": None}], "dates_and_deadlines": [{"date": "2026-13-01", "event": "e"}, {"date": "2026-01-31", "event": "f"}]}
    rows = spark.createDataFrame([("x", "T", "Pembagian Dividen", None, full), ("y", "T", "Plain", "routine_direct", {"executive_summary": " "})], f"announcement_id string, ticker string, title string, mode string, summary struct<{', '.join(f.replace(' ', ': ', 1) for f in contracts._split(contracts.SUMMARY))}>")
    x, y = contracts.structured(rows).orderBy("announcement_id").collect()
    assert (x.primary_category, x.tags, x.materiality, x.confidence, x.problem) == ("DIVIDEND", ["DIVIDEND", "EXPANSION"], "MEDIUM", 0.75, None)
    assert [(c.type, c.text, c.confidence, c.basis) for c in x.claims] == [("EXPLICIT_FACT", "fact", None, None), ("DERIVED_CALCULATION", "maybe", "HIGH", "a; b")]
    assert len(x.numbers) == 1 and [str(v.date) for v in x.dates] == ["None", "2026-01-31"]
    assert (y.primary_category, y.materiality, y.confidence) == ("OTHER", "ROUTINE", 0.65) and y.problem


def test_promotion_and_merge(spark):
    df = spark.createDataFrame([("x", ["a", " a", ""], ["b"])], "announcement_id string, material_facts array<string>, risks array<string>")
    assert [tuple(c) for c in contracts.promoted_claims(df, {"material_facts": "material_fact", "risks": "risk"}).first().claims] == [("material_fact", "a"), ("risk", "b")]
    schema = "g string, ordinal int, url string, name string, kind string"
    old = spark.createDataFrame([("g", 0, "u1", "A.pdf", ""), ("g", 1, "", "B.pdf", "main")], schema)
    new = spark.createDataFrame([("g", 0, "u1", "other", "pdf"), ("g", 1, "u2", "b.PDF", "x"), ("g", 2, "u3", "C.pdf", None)], schema)
    out = sorted((r.side, r.ordinal, r.url, r.name, r.kind) for r in contracts.keyed_merge(old, new, "g").collect())
    assert out == [(0, 0, "u1", "A.pdf", "pdf"), (0, 1, "u2", "B.pdf", "main"), (1, 2, "u3", "C.pdf", None)]


def test_collect(spark):
    at = lambda n: dt.datetime(2026, 8, 5, n)
    rows = [(1, "AAA", at(1), True, 1, False), (2, "AAA", at(9), True, 1, False), (3, "AAA", at(10), True, 1, False), (4, "aaa!", at(10), True, 1, False), (5, "B", at(10), False, 1, False), (6, " ", at(10), True, 1, False), (7, "B", at(11), True, 1, False)]
    df = spark.createDataFrame(rows, "announcement_id int, ticker string, announced_at timestamp, is_stock boolean, n_selected int, missing boolean").withColumn("scope", F.lit("s"))
    seen = spark.createDataFrame([(2,)], "announcement_id int")
    out = collect.collect_window(df, seen, "2026-08-05 08:00:00", "2026-08-05 12:00:00", 1, "scope")
    assert {r.announcement_id: r.outcome for r in out.collect()} == {1: "outside", 2: "seen", 3: "deferred", 4: "bad_ticker", 5: "non_stock", 6: "blank_ticker", 7: "accepted"}
    assert {r.outcome: (r.n, r.n_shown) for r in collect.diagnostics(out, 1).collect()}["seen"] == (1, 1)
    ids = spark.createDataFrame([("20260805101500-x", "BBRI ", True), ("20260805101500-y", "BBRI", False)], "id2 string, ticker string, is_stock boolean")
    assert collect.exact_disclosure(ids, "20260805101500-x", "bbri").count() == 1
    with pytest.raises(LookupError):
        collect.exact_disclosure(ids, "20260805101500-y", "bbri")
    assert str(ids.select(collect.day_of_id(F.col("id2"))).first()[0]) == "2026-08-05"


def test_render(spark):
    one = spark.range(1)
    t, v = F.lit(" a {x} {Y_1} {z} {9}"), F.create_map(F.lit("x"), F.lit("{Y_1}"), F.lit("Y_1"), F.lit(None).cast("string"))
    assert one.select(X.render(t, v)).first()[0] == "a {Y_1}  {z} {9}"
    with pytest.raises(Exception, match="missing values: w"):
        one.select(X.render(t, v, F.array(F.lit("x"), F.lit("w")))).collect()
    problems = one.select(X.placeholder_problems(t, F.array(F.lit("x"), F.lit("w")))).first()[0]
    assert problems.unknown == ["Y_1", "z"] and problems.missing == ["w"]
    text = "# Head\n### sub `x`\n- item **b** __c__\n> quote\n```\n# **code**\n```\nend\n\n"
    assert one.select(X.plain_markdown(F.lit(text))).first()[0] == "HEAD\nsub x\n- item b __c__\nquote\n# **code**\nend\n"
    assert one.select(X.mime(F.lit("a.pdf")), X.mime(F.lit("b.x")), X.mime(F.lit("b.x"), F.lit(" t/u "))).first()[:] == ("application/pdf", "application/octet-stream", "t/u")
    assert X.camel("announced_at_utc") == "announcedAtUtc"
    assert one.select(X.backoff(F.lit(3), 2.0, 60.0), X.backoff(F.lit(30), 2.0, 60.0), X.backoff(F.lit(1), 2.0, 60.0, F.lit(9.0))).first()[:] == (8.0, 60.0, 9.0)


def test_registered_queries_have_distinct_columns(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.001"
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)
    assert __spark_entry__.entry(spark).limit(1).count() == 1
    for name in ("collect_window", "attachment_select", "claim_traces"):
        out = queries[name](spark, sf)
        assert len(set(out.columns)) == len(out.columns) and out.count() > 0


def test_process_reads_each_table_once_and_large_companies_in_parts(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def touch(x):
        calls.add(1)
        return x

    name = F.udf(touch, "string")(F.concat(F.lit("f"), "id"))
    at = F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz")
    files = spark.range(200).select((F.col("id") % 2).alias("scope"), F.col("id").cast("string").alias("announcement_id"), F.col("id").cast("string").alias("url"), name.alias("filename"), at.alias("downloaded_at"), F.when(F.col("id") % 3 > 0, at).alias("extracted_at"), F.lit(None).cast("timestamp_ntz").alias("summary_at"))
    heads = spark.range(2).select(F.col("id").alias("scope"), F.lit("a").alias("announcement_id"), F.lit("t").alias("title"), F.lit(None).cast("timestamp_ntz").alias("announced_at"), at.alias("fetched_at"), at.alias("summary_at"))
    companies = spark.range(2).select(F.col("id").alias("scope"), F.lit("T").alias("ticker"), at.alias("updated_at"))
    none = spark.createDataFrame([], "scope long, audit_id long, stage string, filename string, announcement_id string, status string, started_at timestamp_ntz, finished_at timestamp_ntz, elapsed double, prompt_tokens long, completion_tokens long")
    seen = []
    for hot in (1_000_000, 50):
        monkeypatch.setattr(scans, "HOT", hot)
        before = calls.value
        rows = audit.process(heads, files, companies, none).collect()
        assert hot == 50 or calls.value - before == 200
        assert sorted(r.place for r in rows if r.scope == "0") == list(range(1, 100 + 66 + 3 + 1 + 1))
        seen.append(sorted(map(str, rows)))
    assert seen[0] == seen[1]
