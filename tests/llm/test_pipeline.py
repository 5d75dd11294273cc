"""The corpus pipeline: its stages against brute force on all documents, and the query contract."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import __spark_entry__ as entry
from salesmart.llm import bpe, secret_scan
from salesmart.llm import decontamination as decon
from tests.llm.test_pairs_and_shards import brute_components

SF = "/root/testdata/sf0.01"


def plain_quality(rows):
    """(doc_id, text, host) to the rows that the quality stage keeps, without frequent lines."""

    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text)

    def normal(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")

    texts = defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text)
    frequent = {}
    for host, some in texts.items():
        n = Counter(x for t in some for x in {normal(line) for line in t.split("\n")} - {""})
        frequent[host] = {x for x, k in n.items() if k > 10 and k > 0.05 * len(some)}
    out = []
    for doc_id, text, host in rows:
        grams = [tuple(words(text)[i : i + 8]) for i in range(len(words(text)) - 7)]
        twice = {g for g, k in Counter(grams).items() if k > 1}
        covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(8)}
        left = "\n".join(x for x in text.split("\n") if normal(x) not in frequent[host])
        if len(words(text)) >= 20 and 100 * len(covered) <= 30 * len(words(text)) and len(words(left)) >= 20:
            out.append((doc_id, left))
    return out


def test_pipeline_equals_the_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = plain_quality([(r.doc_id, r.text or "", r.source or "") for r in docs.collect()])
    stage = corpus_pipeline.quality_stage(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in stage.collect()) == sorted(rows)
    unique = {r[0] for r in brute_components(rows, percent=80, k=5) if r[3]}
    rows = [r for r in rows if r[0] in unique]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    matcher = decon.Matcher(items)
    rows = [r for r in rows if not matcher.hits(r[1])]
    with open(bpe.default_vocabulary_path(), encoding="utf-8") as f:
        coder = bpe.WordBpe(f.read())
    want = sorted((i, len(coder.encode(secret_scan.redact(t))) // 4) for i, t in rows)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in docs.schema]


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(entry.oracle_sql()) <= set(names)


def test_stages_judge_rows_without_an_id_or_with_a_repeated_one(spark, tmp_path):
    item = "The quick brown fox jumps over the lazy dog by the river bank at noon"
    texts = [" ".join(f"t{i}w{k}" for k in range(40)) for i in range(5)]
    rows = [
        (None, texts[0]), (None, texts[0]), (None, texts[0] + " more"),  # one stays
        (3, texts[1]), (3, texts[1]), (None, texts[1]), (9, texts[1]),  # one row of id 3 stays
        (9, texts[2]),  # no copy, though another row of its id is one
        (None, ""), (None, None),
    ]
    schema = "doc_id long, text string, _row int"
    docs = spark.createDataFrame([(*r, 0) for r in rows], schema)
    kept = corpus_pipeline.dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(3, texts[1]), (9, texts[2]), (None, ""), (None, None)]
    assert [x for x in got if x in want] == sorted(want, key=str) and len(got) == 5
    assert sum(x[1] in (texts[0], texts[0] + " more") for x in got) == 1

    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item), (None, texts[0]), (5, f"say {item}"), (5, texts[1]), (6, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], schema)
    kept = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(None, texts[0]), (5, texts[1]), (6, None)], key=str
    )


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    words = " ".join(f"w{k}" for k in range(40))
    schema = "`_Row` int, `a.b` string, doc_id long, text string, `Text body` string, `row` long, doc string, c0 int, n_chars int"
    rows = [(777, "x", i, f"{words} own{i} password=hunter{i}22" if i else words, "t", 5, "d", i, 9) for i in range(2)]
    rows += [(888, "y", 0, words, None, 6, None, 7, None)]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, "no such passage")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        got = out.collect()
        others = [k for k, c in enumerate(docs.columns) if c not in ("text", "n_chars")]
        given = {tuple(r[k] for k in others) for r in rows}
        assert {tuple(r[k] for k in others) for r in got} <= given
        assert len(got) == (1 if name == "near_dedup" else 3)
