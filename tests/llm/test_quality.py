"""Quality rules: against SQL on all documents, and small edge cases."""

from __future__ import annotations

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from salesmart.llm import quality
from salesmart.llm import queries as Q
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.execute(Q.llm_oracle_sql()["op8_quality"])
    names = [d[0] for d in res.description]
    want = res.fetchall()
    df = Q.op8_quality(spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(names, want)
    assert any(r[df.columns.index("n_repeat_words")] for r in got)


def brute(text):
    import re

    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


CASES = [
    None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 30,
    "a\xa0b\x85c d", "l\n l\nl\n\n\nl\r\nl\r", "# <b> & | $ % * >", "a b c d e f g a b c d e f g a b c d e f g",
    "日本 語 👍🏽 é", ("u v w x y z 1 2 3 " * 3 + "\n") * 4, "y" * 100_000, " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(4990, 5000))),
]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, None if i % 2 else "h", 0, "clash") for i, t in enumerate(CASES)]
    rows += [(None, "null id " * 12, None, 1, "x"), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, kept string")
    out = quality.quality_rules(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        text = "null id " * 12 if r.doc_id is None else CASES[r.doc_id]
        want = brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert quality.quality_rules(docs.limit(0)).count() == 0


def docs_with_boilerplate(spark):
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    notice = "Read  our terms of use and the whole of our privacy notice today\t"
    rows = [(i, f"{words(i)}\n{notice}", "a") for i in range(30)]
    rows += [(30, f"{notice}\nfew own words are left here once it goes away", "a")]
    rows += [(40 + i, f"{words(99)}\nexact copies of one text count once", "b") for i in range(60)]
    rows += [(200, words(200), "b"), (201, None, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_depleted_documents_go_and_copies_stay(spark):
    out = {r.doc_id: r for r in quality.quality_rules(docs_with_boilerplate(spark)).collect()}
    assert all(out[i].kept and out[i].n_removed_lines == 1 for i in range(30))
    assert not out[30].kept and not out[30].base_failed and out[30].n_removed_words == 13
    assert all(out[40 + i].kept for i in range(60))
    assert not out[201].kept


def test_stage_keeps_columns_and_equals_verdict(spark):
    docs = docs_with_boilerplate(spark)
    kept = quality.keep_good_documents(docs)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == want
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r.doc_id in want)


def test_stage_takes_columns_of_any_name(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "a", i, "r", True) for i in range(3)] + [(9, "few", None, 1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, doc string, base_failed boolean")
    kept = quality.keep_good_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_main_path_has_no_python(spark):
    plan = Q.op8_quality(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("n", [0, 1])
def test_frequent_line_limits(spark, n):
    rows = [(i, f"same line\nown {i}", "h") for i in range(quality.MIN_TEXTS + n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert quality.frequent_lines(docs).count() == n


def test_a_line_of_more_than_the_share_of_a_large_host_goes(spark):
    # 400 texts: the limit is 20 texts; 21 hold one line, 20 another
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(25))
    rows = [
        (i, own(i) + ("\nread this line" if i < 21 else "\nread that line" if i < 41 else ""), "h") for i in range(400)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.quality_rules(docs).where("n_removed_lines > 0").collect()
    assert sorted(r.doc_id for r in out) == list(range(21))


def test_the_line_rule_alone_rejects_documents_of_a_given_table(spark):
    sf = "/root/testdata/sf0.1"
    out = Q.op8_quality(spark, sf)
    cut = out.where("n_removed_lines > 0").count()
    rejected = out.where("NOT base_failed AND NOT kept").collect()
    assert cut > 500 and 0 < len(rejected) < 50
    assert all(r.n_words >= 20 > r.n_words - r.n_removed_words for r in rejected)


def test_pipeline_stage_removes_the_boilerplate_lines(spark):
    docs = docs_with_boilerplate(spark).withColumn("n_chars", F.length("text").cast("long"))
    kept = corpus_pipeline.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    want = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == good
    for r in rows:
        text = want[r.doc_id].split("\n")[0] if r.doc_id < 30 else want[r.doc_id]
        assert (r.text, r.n_chars) == (text, len(text))


def test_removal_keeps_other_lines_as_they_are(spark):
    own = " ".join(f"w{k}" for k in range(25))
    rows = [(i, f"  {own} {i}\t x\n\n same \x0b line\r\nsame line\nend{i}", "h", None) for i in range(30)]
    docs = spark.createDataFrame([*rows, (None, None, None, None)], "doc_id long, text string, source string, n_chars int")
    out = {r.doc_id: r for r in quality.clean_good_documents(docs).collect()}
    assert len(out) == 30
    assert all(out[i].text == f"  {own} {i}\t x\n\nend{i}" and out[i].n_chars is None for i in range(30))
