"""Jaccard join, graph search, near-duplicate vectors, components: against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiframe.llm import graph_search, jaccard, polytope
from epiframe.llm.components import components


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5), (None, 3)]
    want = groups([e for e in edges if None not in e], range(500))
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").lower().split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if x and y and a is not None and b is not None and 100 * len(x & y) >= 90 * len(x | y)]
    root = groups(links, {i for i, _ in sets if i is not None})
    return sorted(((i, len(s), root.get(i)) for i, s in sets), key=repr)


def near_copies(seed, sizes, edits, copies):
    """Texts and copies of them with a few words changed, some just under the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 4)))
    rows, passage = [], [word() for _ in range(40)]
    for size in sizes:
        base = [word() for _ in range(size)]
        if rng.random() < 0.5:
            base[size // 3 : size // 3] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits(size))):
                k = rng.randrange(len(text))
                text[k : k + rng.randint(0, 2)] = [word()] * rng.randint(0, 2)
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("short_list,group", [(32, 2_000_000), (2, 2_000_000), (2, 700), (0, 300)])
def test_join_is_exact(make_docs, monkeypatch, short_list, group):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short_list)
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", group)
    rows = near_copies(7, [4, 9, 11, 12, 15, 18, 20, 21, 22, 24, 30, 45, 60, 90, 150], lambda n: max(1, n // 25), 9)
    got = sorted((tuple(r) for r in jaccard.join(make_docs(rows)).collect()), key=repr)
    want = brute(rows)
    assert got == want and len({r for _, _, r in want}) < len(rows) - 20


def brute_at(rows, n, t):
    """``brute`` for shingles of n words and a similarity of t hundredths."""
    words = [[w for w in (x or "").replace("\n", " ").replace("\t", " ").lower().split(" ") if w] for _, x in rows]
    sets = [(i, {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()) for (i, _), w in zip(rows, words)]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if x and y and a is not None and b is not None and 100 * len(x & y) >= t * len(x | y)]
    root = groups(links, {i for i, _ in sets if i is not None})
    return sorted(((i, len(s), root.get(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("n,t", [(3, 90), (5, 80)])
def test_one_word_more_at_either_end(make_docs, n, t):
    rows = []
    for size in range(n, 30):
        words = [f"s{size}w{k}" for k in range(size)]
        rows += [(len(rows) + k, " ".join(x)) for k, x in enumerate((words, [*words, "after"], ["before", *words]))]
    got = sorted((tuple(r) for r in jaccard.join(make_docs(rows), n, t).collect()), key=repr)
    assert got == brute_at(rows, n, t)


def test_a_large_group_of_near_copies(make_docs):
    rows = near_copies(3, [80], lambda n: 3, 150)
    assert sorted((tuple(r) for r in jaccard.join(make_docs(rows)).collect()), key=repr) == brute(rows)


def test_join_of_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (50, "A B"), (51, "a\tb"), (52, "b a"), (53, "One two  three four five")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(make_docs(rows)).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (4, 1, 4), (50, 1, 4), (51, 1, 4), (52, 1, 52), (11, len(shingle_set(odd_rows[11][1])), 10), (53, 3, 12), (None, 1, None), (None, 0, None)} <= got
    assert jaccard.join(make_docs([])).count() == 0
    kept = jaccard.one_of_each(make_docs([*rows, (7, "another text of the same id")]))
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 52] and ids.count(None) == 2
    assert "words" in kept.columns


def test_the_boundary_is_where_costs_cross():
    b = jaccard.boundary()
    assert jaccard.subsets(b) <= jaccard.LIST_COST * jaccard.postings(b) < jaccard.subsets(b + 1)
    for n in range(1, 3000):
        assert jaccard.certain(n) <= jaccard.certain(n + 1) and jaccard.needed(n) <= jaccard.certain(n) or n < 3


def make_vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "2 AS v", "3 AS id", "4 AS dim").repartition(4)


BAD = [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [None] + [1.0] * 7), (904, []), (None, [1.0] * 8), (905, [float("inf")] * 8)]


def test_search_finds_the_nearest(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(1500, 8)).astype(np.float32) * rng.uniform(0.2, 3, (1500, 1)).astype(np.float32)
    data[1000:1200] = data[7]  # a value that many rows share
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    found = graph_search.nearest(make_vectors(spark, [*rows, *BAD, rows[3], (2000, [1.0, 2.0])]), F.col("vec_id") % 20 == 0, 10).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 1500, 20))
    hits, x = 0, data.astype(np.float64)
    for q, got in by.items():
        scores = x @ x[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:10]
        hits += len({i for i, _ in got} & set(best.tolist()))
        assert len(got) == 10 and [s for _, s in got] == pytest.approx([scores[i] for i, _ in got])
        assert got == sorted(got, key=lambda p: (-p[1], p[0]))
    assert hits >= 0.95 * 10 * len(by)


def test_search_in_little(spark):
    df = make_vectors(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])])
    found = graph_search.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in found] == [(0, 20, 0.5), (0, 3, 0.0), (20, 0, 0.5), (20, 3, 0.5)]
    copies = make_vectors(spark, [(i, [1.0, 2.0]) for i in range(61)])
    found = graph_search.nearest(copies, F.col("vec_id") % 20 == 0, 5).collect()
    want = {q: [i for i in range(7) if i != q][:5] for q in (0, 20, 40, 60)}
    assert {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want} == want
    assert graph_search.nearest(make_vectors(spark, BAD), F.col("vec_id") % 20 == 0).count() == 0
    assert graph_search.nearest(make_vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_near_duplicate_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(polytope, "BLOCK", block)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 32))
    data = np.concatenate([b + rng.normal(size=(n, 32)) * s for b, n, s in zip(base, rng.integers(1, 14, 40), rng.uniform(0.05, 0.4, 40))]).astype(np.float32)
    data = np.concatenate([data, data[:10], 2 * data[:3]])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    found = {r["vec_id"]: r for r in polytope.near_duplicates(make_vectors(spark, [*rows, *BAD])).collect()}
    x = data.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    missed = sum(int(near[i].sum()) - found[i]["n_links"] for i in range(len(x)))
    assert 0 <= missed <= 0.01 * near.sum()
    assert all(found[i]["n_links"] <= near[i].sum() for i in range(len(x)))
    if missed == 0:
        want = groups(np.argwhere(near).tolist(), range(len(x)))
        assert {i: found[i]["component_id"] for i in range(len(x))} == want
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (900, 901, 902, 903, 904, 905, None))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_no_vectors(spark):
    assert polytope.near_duplicates(make_vectors(spark, [])).count() == 0
    assert polytope.near_duplicates(make_vectors(spark, BAD)).count() == len(BAD)
