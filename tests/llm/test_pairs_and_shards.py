"""Near duplicates, decontamination, licenses and sharding against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from salesmart.llm import decontamination as decon
from salesmart.llm import licenses, near_dedup, sharding
from salesmart.llm import queries as Q
from salesmart.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def shingles(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, percent=85, k=3):
    """``[(doc_id, n_shingles, component, kept)]`` by comparing all pairs."""
    sets = [shingles(t, k) if i is not None else set() for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for row, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(row)
    for row, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x] if j < row)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(j), find(row)
                parent[max(a, b)] = min(a, b)
    least = {}
    for row, (i, _) in enumerate(rows):
        if i is not None:
            least[find(row)] = min(i, least.get(find(row), i))
    out = []
    for row, (i, t) in enumerate(rows):
        c = least[find(row)] if i is not None else None
        out.append((i, len(shingles(t, k)), c, i is None or i == c))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], str(r)))


def test_near_duplicate_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Q.op9_near_dedup(spark, SF).collect()
    want = brute_components(rows)
    assert order(got) == order(want)
    assert sum(not r.kept for r in got) > 10


def variants(seed, words, copies, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [base]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_large_group_of_near_copies_loses_no_link(spark):
    rows = list(enumerate(variants(1, 120, 260, 9) + variants(2, 60, 40, 4) + variants(3, 7, 30, 2)))
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(near_dedup.near_duplicates(docs).collect()) == order(brute_components(rows))


def test_near_duplicate_edges(spark):
    rows = [
        (7, None), (8, ""), (9, " \n"), (3, "one"), (2, "ONE"), (5, "one two"), (6, "two one"), (4, "One\ttwo"),
        (None, "one"), (10, "x y z"), (10, "x y z"), (11, "x y z w"), (1, "x Y z"), (12, "é " * 20_000), (13, "é é é"),
    ]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, component_id string")
    assert order(near_dedup.near_duplicates(docs).collect()) == order(brute_components(rows))
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 6, 7, 8, 9, 11, 12]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    for size, share in ((2000, 0.5), (40, 0.8), (6, 0.5)):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2**63, 2 * size).astype(np.uint64) * np.uint64(2))
            common = int(size * share)
            a = np.sort(pool[rng.permutation(len(pool))[:size]])
            rest = np.setdiff1d(pool, a)
            b = np.sort(np.concatenate([a[rng.permutation(size)[:common]], rest[: size - common]]))
            inter = np.intersect1d(a, b).size
            agree.append((near_dedup.signature(a) == near_dedup.signature(b)).mean() - inter / (2 * size - inter))
        assert abs(np.mean(agree)) < 0.05


def test_components_of_a_path_and_stars(spark):
    rng = random.Random(9)
    ids = rng.sample(range(-(10**12), 10**12), 300)
    links = [(ids[k], ids[k + 1]) for k in range(99)] + [(ids[100], ids[k]) for k in range(101, 200)]
    links += [(ids[200], ids[200]), (None, ids[201]), *links[:5]]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: min(ids[:100]) for i in ids[:100]} | {i: min(ids[100:200]) for i in ids[100:200]}
    assert connected_components(df.limit(0)).count() == 0


# --- decontamination


def edit_distance_in(pattern, text):
    """Least edit distance of the pattern to any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(4)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 70)))
        t = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 90)))
        assert decon.myers_best(decon.masks_of(p), len(p), t)[0] == edit_distance_in(p, t)


def test_pieces_find_every_passage_within_budget():
    rng = random.Random(6)
    words = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("n", "rt", "sk")]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(3, 40)))) for k in range(30)]
    m = decon.Matcher(items)
    for trial in range(120):
        k, item = rng.choice(items)
        s = list(item)
        for _ in range(rng.randrange(0, len(item) // 8 + 2)):
            at = rng.randrange(len(s))
            rng.choice([lambda: s.__setitem__(at, "z"), lambda: s.insert(at, "y"), lambda: s.pop(at)])()
        text = " ".join(rng.choices(words, k=20)) + " " + "".join(s) + " " + " ".join(rng.choices(words, k=20))
        doc = decon.normal_form(text)
        got = {x[0]: x for x in m.hits(text)}
        for j, other in items:
            d = edit_distance_in(other, doc)
            assert (d <= decon.budget_of(len(other))) == (j in got)
            if j in got:
                _, distance, a, b = got[j]
                assert distance == d and edit_distance_in(doc[a:b], other) <= d


def test_contamination_query_equals_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in Q.op4_decontamination(spark, SF).collect()}
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if decon.normal_form(i.text) in decon.normal_form(d.text)}
    assert whole and whole <= got
    rng = random.Random(1)
    for d in rng.sample([d for d in docs if len(d.text) < 1500], 15):
        for i in rng.sample(items, 4):
            n = decon.normal_form(i.text)
            near = edit_distance_in(n, decon.normal_form(d.text)) <= decon.budget_of(len(n))
            assert near == ((d.doc_id, i.item_id) in got)


def test_contamination_edges(spark, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog by the river bank at noon"
    rows = [(1, f"say {item.upper()} end"), (None, item), (2, None), (3, ""), (4, "fox"), (5, item), (5, item)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(9, item), (8, None), (None, "fox"), (7, ""), (9, item)], "item_id long, text string")
    hits = decon.find_contamination(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in hits) == [(0, 9, 0), (1, 9, 0), (5, 9, 0), (5, 9, 0)]
    kept = decon.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4]
    assert decon.find_contamination(docs.limit(0), bench).count() == 0
    assert decon.find_contamination(docs, bench.limit(0)).count() == 0
    monkeypatch.setattr(decon, "BLOCK_CHARS", 40)
    more = bench.unionByName(spark.createDataFrame([(6, "fox " * 3)], "item_id long, text string"))
    assert decon.find_contamination(docs, more).count() == 4


# --- licenses


def test_license_query_finds_the_notices(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    notices = {
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    want = {d.doc_id: {v for k, v in notices.items() if k in (d.text or "")} for d in docs}
    got = Q.op10_license_scan(spark, SF).collect()
    assert len(got) == len(docs) and any(want.values())
    text = {d.doc_id: d.text for d in docs}
    for r in got:
        assert set(filter(None, r.licenses.split(","))) == want[r.doc_id]
        for m in r.matches:
            assert notices[text[r.doc_id][m.start : m.end]] == m.license


def best_alignment(template, words):
    """Most matched words of an unbanded alignment with the band's scores."""
    previous = [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(previous[0][0] - 1, previous[0][1])]
        for j, w in enumerate(words, 1):
            diagonal = (previous[j - 1][0] + (2 if w == t else -1), previous[j - 1][1] + (w == t))
            row.append(max(diagonal, (previous[j][0] - 1, previous[j][1]), (row[-1][0] - 1, row[-1][1])))
        previous = row
    return max(previous)[1]


def test_alignment_equals_the_full_table():
    rng = random.Random(8)
    for _ in range(150):
        t = np.array([rng.randrange(50) for _ in range(rng.randrange(5, 40))], np.uint64)
        w = [int(x) for x in t]
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(w))
            rng.choice([lambda: w.__setitem__(at, 99), lambda: w.insert(at, 98), lambda: w.pop(at)])()
        lead = rng.randrange(0, 9)
        words = np.array([60] * lead + w + [61] * rng.randrange(0, 9), np.uint64)
        matches, a, b = licenses.align(t, words, lead, 6)
        assert matches == best_alignment(t.tolist(), words.tolist())
        assert words[a] != 60 and words[b - 1] != 61


def test_changed_license_text_has_its_coverage():
    full = licenses.TEMPLATES["MIT/text"]
    words = full.split()
    words[20:24] = ["quite", "other"]
    text = "/* intro\n * " + "\n * ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)) + "\n */ code"
    scanner = licenses.Scanner(licenses.TEMPLATES)
    ((name, coverage, start, end),) = scanner.scan(text)
    n = len([w for w in full.split() if w.strip("*/")])
    assert name == "MIT/text" and coverage == pytest.approx((n - 4) / n, abs=0.02)
    assert text[start:end].startswith("Permission") and text[start:end].endswith("Software.")
    assert scanner.scan("the license of the dog under the table") == []


def test_winnowing_keeps_one_gram_of_every_window():
    g = np.array([random.Random(2).randrange(1000) for _ in range(200)], np.uint64)
    kept = set(licenses.winnow(g).tolist())
    assert all(kept & set(range(i, i + licenses.WINDOW)) for i in range(len(g) - licenses.WINDOW + 1))


def test_license_edges(spark):
    rows = [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "*** --- ***"), (3, "*** --- ***")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, matches int")
    out = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id or 0, r.licenses) for r in out) == [(0, "MIT"), (1, ""), (2, ""), (3, ""), (3, "")]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert licenses.scan_licenses(docs, templates={}).where("n_matches > 0").count() == 0


# --- sharding


def plain_shard(doc_id, leaves, draws=None):
    seed = 42
    if doc_id is not None:
        seed = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), seed)

    def draw(path, below):
        h = seed
        for v in path:
            h = xxhash.xxh64_intdigest(v.to_bytes(4, "little"), h)
        if draws is not None:
            draws.append(path)
        u = ((h >> 11) + 0.5) * 2.0**-53
        return -np.log(u) / sum(x.weight for x in below)

    path, here = (), leaves
    for level in (lambda x: (x.layer, x.region), lambda x: (x.rack,), lambda x: (x.shard,)):
        steps = sorted({level(x) for x in here})
        below = {step: [x for x in here if level(x) == step] for step in steps}
        step = min(steps, key=lambda s: draw(path + s, below[s])) if len(steps) > 1 else steps[0]
        path, here = path + step, below[step]
    return here[0].shard


def test_a_key_draws_along_one_path():
    draws = []
    plain_shard(7, sharding.balanced_tree(240, regions=4, racks=6), draws)
    assert len(draws) == 4 + 6 + 10  # of 240 shards


def test_shard_query_equals_plain_draws(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op5_sharding(spark, SF).collect()
    assert len(rows) == len(docs)
    now, grown = sharding.balanced_tree(24), sharding.balanced_tree(25, first=24)
    slots = {}
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "key"
        assert r.shard == plain_shard(r.doc_id, now) and r.grown_shard == plain_shard(r.doc_id, grown)
        assert r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24


def test_weights_set_shares_and_confine_movement(spark):
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    leaves = [sharding.Leaf(n % 2, n // 2 % 2, n, 1.0 + (n == 3)) for n in range(6)]
    heavier = [*leaves, sharding.Leaf(leaves[3].region, leaves[3].rack, 3, 2.0, layer=1)]
    a = {r.doc_id: r.shard for r in sharding.shard_rows(ids, leaves).collect()}
    b = {r.doc_id: r.shard for r in sharding.shard_rows(ids, heavier).collect()}
    assert all(a[i] == b[i] or b[i] == 3 for i in a)
    assert Counter(a.values())[3] / 6000 == pytest.approx(2 / 7, abs=0.03)
    assert Counter(b.values())[3] / 6000 == pytest.approx(4 / 9, abs=0.03)
    with pytest.raises(ValueError):
        sharding.shard_rows(ids, [sharding.Leaf(0, 0, 0, 0.0)])


def test_layers_take_rows_only_into_themselves(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = sharding.balanced_tree(12)
    rack = [sharding.Leaf(1, 7, 50 + k, 0.5 + k, layer=1) for k in range(3)]  # a rack of three shards
    more = [*tree, *rack, sharding.Leaf(0, 0, 99, 1.0, layer=2)]

    def shards(leaves):
        return {r.doc_id: r.shard for r in sharding.shard_rows(ids, leaves).collect()}

    steps = [shards(tree), shards([*tree, *rack]), shards(more)]
    assert all(steps[1][i] in (old, 50, 51, 52) for i, old in steps[0].items())
    assert all(steps[2][i] in (old, 99) for i, old in steps[1].items())
    counts = Counter(steps[2].values())
    assert counts[52] / 4000 == pytest.approx(2.5 / 17.5, abs=0.03)
    assert counts[99] / 4000 == pytest.approx(1 / 17.5, abs=0.03)


def test_shard_edges(spark):
    rows = [(None, None), (None, ""), (1, "é"), (1, "é"), (2, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    out = sharding.shard_documents(docs, 1).collect()
    assert sorted(r.slot for r in out) == [0, 1, 2, 3, 4] and {r.shard for r in out} == {0}
    assert sorted(r.size for r in out) == [8, 8, 8, 10, 10]
    assert sharding.shard_documents(docs.limit(0)).count() == 0
