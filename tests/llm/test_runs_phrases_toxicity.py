"""Periodic runs, phrase collocations and toxicity: brute force, SQL, held-out accuracy, edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import boosting, periodic_runs, phrases, toxicity
from salesmart.llm import queries as Q
from salesmart.llm.lm_scoring import unpack_counts

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


# --- periodic runs


def plain_runs(words, min_length=6, exponent=4):
    """Every maximal stretch of every period, smallest periods only."""
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(min_length, exponent * q):
                part = words[i : i + n]
                if all(part[p:] != part[:-p] for p in range(1, q)):
                    found.append((i, n, q))
            i = j + 1 if j == i else j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    s, n, q = best[0] if best else (None, None, None)
    listing = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listing, kept)]
    return (doc_id, len(runs), s, n, q, 1000 * n // q if best else None, *sha)


tails = st.tuples(st.text("ab", max_size=30), st.text("abc", min_size=1, max_size=5), st.integers(1, 9))


@settings(max_examples=150, deadline=None)
@given(st.lists(tails, min_size=1, max_size=5), st.sampled_from([(6, 4), (2, 2), (5, 3), (9, 2)]))
def test_runs_equal_brute_force(parts, limits):
    texts = [[c.encode() for c in head + tail * times] for head, tail, times in parts]
    assert periodic_runs.find_runs(texts, *limits) == [plain_runs(w, *limits) for w in texts]


def test_runs_do_not_cross_documents():
    half = [b"x"] * 5
    assert periodic_runs.find_runs([half, half, []]) == [[], [], []]
    assert periodic_runs.find_runs([half + half, half]) == [[(0, 10, 1)], []]


def test_runs_of_long_text():
    words = [b"w%d" % (k % 1700) for k in range(20_000)]
    assert periodic_runs.find_runs([words, [b"a"] * 30_000]) == [[(0, 20_000, 1700)], [(0, 30_000, 1)]]


def test_runs_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in Q.op13_periodic_runs(spark, SF).collect())
    assert got == sorted(plain_digest(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 50


def test_runs_edge_rows(spark):
    rows = [(None, "a " * 8), (1, None), (1, ""), (1, " \t\n"), (2, "b c " * 5), (2, "b c " * 5)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string")
    got = periodic_runs.run_digest(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(plain_digest(*r)) for r in rows)
    full = {(r["doc_id"], r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()}
    assert full == {(None, "a"), (1, ""), (2, "b c")}
    assert periodic_runs.run_digest(docs.limit(0)).collect() == []


# --- phrases


def sql_rows(docs_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars INT)")
    if docs_rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs_rows)
    return sorted(con.execute(Q.llm_oracle_sql()["op12_phrases"]).fetchall())


def test_phrases_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = sorted(con.execute(Q.llm_oracle_sql()["op12_phrases"]).fetchall())
    got = sorted(tuple(r) for r in Q.op12_phrases(spark, SF).collect())
    assert got == expected and len(got) > 1000


def test_phrases_edge_rows(spark):
    repeated = "New York, new york city;New\tYork\x0bhall. New York x new  york! " * 4
    rows = [
        (1, repeated, None, "a", 1),
        (1, repeated, "en", "a", 1),
        (2, repeated, "en", "a", 1),
        (None, None, None, None, None),
        (3, "", "de", "a", 0),
        (4, ".,;:!?\n", "fr", "a", 0),
        (5, "É é Z z " * 12, "", "a", 0),
        (6, "ha " * 40, "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(tuple(r) for r in phrases.collocations(docs).collect())
    assert got == sql_rows(rows) and got
    assert phrases.collocations(docs.limit(0)).collect() == []


@pytest.mark.parametrize("parsing", [{"trigger": 2, "block_words": 50, "range_keys": 40}, {"trigger": 10**6}])
def test_phrases_do_not_depend_on_chunks_blocks_or_ranges(spark, parsing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = sorted(tuple(r) for r in phrases.collocations(docs, min_count=3).collect())
    got = sorted(tuple(r) for r in phrases.collocations(docs, min_count=3, **parsing).collect())
    assert got == expected and got


words_and_marks = st.lists(st.sampled_from(["a", "b", "c", "A", ",", ". !", "\n", "\t"]), max_size=60)


@settings(max_examples=100, deadline=None)
@given(words_and_marks, st.integers(1, 5))
def test_each_phrase_is_owned_by_one_chunk(tokens, trigger):
    text = " ".join(tokens)
    stream = phrases.tokens_of(text)
    owned = []
    for chunk in phrases.chunks_of(text, phrases.TokenHashes(), trigger):
        parts = chunk.split(b" ")
        owned += [parts[i : i + 3] for i in range(len(parts) - phrases.OVERLAP)]
    assert owned == [stream[i : i + 3] for i in range(len(stream) - phrases.OVERLAP)]


def test_equal_passages_give_equal_chunks(spark):
    passage = " ".join(f"w{k % 97}x{k % 13}" for k in range(2000))
    docs = spark.createDataFrame(
        [(k, f"start{k} " + passage + f" end{k}", "en") for k in range(50)], "id long, text string, lang string"
    )
    rows = phrases.parse(docs, "lang", "text", phrases.TRIGGER).collect()
    shared = sum(len(r["chunk"]) for r in rows if r["freq"] % 50 == 0)
    assert shared > 0.8 * sum(len(r["chunk"]) for r in rows if r["freq"] < 50)
    block = phrases.blocks_of(phrases.parse(docs, "lang", "text", 32), 1000).first()
    assert unpack_counts(block["freqs"]).max() >= 50


# --- toxicity


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    p = y.sum()
    return (rank[y == 1].sum() - p * (p - 1) / 2) / (p * (len(y) - p))


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    scored = Q.op11_toxicity(spark, sf)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = scored.toPandas()
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    y = held.toxic.to_numpy()
    assert auc(y, held.score.to_numpy()) > 0.97
    assert held.predicted[y == 1].mean() > 0.85 and held.predicted[y == 0].mean() < 0.01
    assert ((held.score - y) ** 2).mean() < 0.02


def test_toxicity_never_learns_from_the_held_out_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic"
    )
    a = toxicity.score_toxicity(docs, labels).orderBy("doc_id").collect()
    assert a == toxicity.score_toxicity(docs, flipped).orderBy("doc_id").collect()


def test_toxicity_edge_rows(spark):
    docs = spark.createDataFrame(
        [(None, "you idiot", 9), (1, None, 9), (1, "", 9), (2, "x " * 200_000, 9), (2, "fine day", 9)],
        "doc_id long, text string, toxic int",
    )
    none = spark.createDataFrame([], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, 1), (2, None), (2, 0), (2, 0), (77, 1)], "doc_id long, toxic int")
    for labels in (none, odd):
        got = toxicity.score_toxicity(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in got)
        assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert toxicity.score_toxicity(docs.limit(0), odd).collect() == []


def test_obfuscated_words_are_read():
    for token in ("Idiot!!", "1d1ot", "i.d.i.o.t", "IDIOOOOT", "id*iot", "$$idiot$$"):
        assert toxicity.core_of(token)[0] == "idiot", token
    assert toxicity.core_of("2024") == ("2024", False) and toxicity.core_of("don't")[1] is False


def test_near_second_person_is_a_feature():
    table = toxicity.TokenTable([{}])
    texts = ["you are an idiot", "idiot one two three four you", "you", None, "idiot"]
    x = toxicity.features(texts, table, np.zeros(5, np.int64))
    near = x[:, toxicity.FEATURES.index("near_hits")]
    assert near[0] > 0 and not near[1:].any()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 1)), min_size=1, max_size=40))
def test_isotonic_is_monotone_and_fits_the_pooled_shares(pairs):
    margins, y = (np.array(v, float) for v in zip(*pairs))
    fitted = boosting.fit_isotonic(margins, y)
    values = fitted(np.linspace(-1, 9, 50))
    assert (np.diff(values) >= 0).all() and (values > 0).all() and (values < 1).all()


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 1] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = boosting.fit_trees(x[:3000], y[:3000])
    assert ((trees.margins(x[3000:]) > 0) == (y[3000:] == 1)).mean() > 0.95
