import re

import numpy as np
import pytest

from graylane.llm import jaccard_join


def brute(rows):
    """(n_shingles, component) of each row over all pairs; a row without an id links with nothing."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((str(doc), len(s), least[root(i)] if doc is not None else None) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True)))


def made(seed, groups=12, copies=14, edits=0.02):
    """Groups of edited copies, a passage that many share, short texts."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passage, texts = word(60), []
    for _ in range(groups):
        base = word(int(rng.integers(30, 200)))
        for _ in range(copies):
            w = [x if rng.random() > edits else f"e{rng.integers(0, 9)}" for x in base]
            texts.append(" ".join(w if rng.random() < 0.6 else w + passage))
    texts += [" ".join(word(int(n)) + passage) for n in rng.integers(1, 80, 60)] + ["a b c", "a b c", "A\tb  c", "", None, "x " * 3000, "x " * 3001, "É é", "é É"]
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)) * 3, texts, strict=True)]


@pytest.mark.parametrize(("seed", "part", "frequent"), [(1, 512, 500_000), (2, 4, 500_000), (3, 512, 5)])
def test_components_match_brute_force(spark, monkeypatch, seed, part, frequent):
    """Also with cells split into small parts, and with hardly any shingle known to be frequent."""
    monkeypatch.setattr(jaccard_join, "PART", part)
    monkeypatch.setattr(jaccard_join, "FREQUENT_MOST", frequent)
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as cls", "'c' as cell").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect())
    assert got == brute(rows)


def test_edge_cases(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (4, text), (9, text), (9, text), (2, None), (3, " \n"), (5, "one")]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("None", 3, None), ("4", 3, 4), ("9", 3, 4), ("9", 3, 4), ("2", 0, 2), ("3", 0, 3), ("5", 1, 5)])
    assert jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_tree_finds_what_the_bound_allows(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(5, 400, 150)
    points = np.stack([np.bincount(rng.integers(0, jaccard_join.GROUPS, k), minlength=jaccard_join.GROUPS) for k in n]).astype(np.uint8)
    points[50:60], n[50:60] = points[:10], n[:10]
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if 9 * np.minimum(points[i], points[j]).sum(dtype=int) >= 4 * (n[i] + n[j])}
    a, b = (np.concatenate(x) for x in zip(*jaccard_join.tree_pairs(n.astype(np.int64), points), strict=True))
    assert {(min(x), max(x)) for x in zip(a.tolist(), b.tolist(), strict=True)} == want and len(want) >= 10


def test_counts_that_do_not_fit(spark):
    """A coordinate of FULL says nothing, so that pairs of very long texts stay."""
    points = np.full((2, jaccard_join.GROUPS), jaccard_join.FULL, np.uint8)
    assert jaccard_join.point_bound(points[:1], points[1:], np.array([200_000]), np.array([190_000])).tolist() == [190_000]
    rng = np.random.default_rng(0)
    w = [f"w{x}" for x in rng.integers(0, 10**6, 80_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:79_000])), (3, " ".join(w[40_000:])), (4, " ".join(w[::-1]))]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_representatives(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (4, text), (9, text), (9, text), (2, None), (None, "all of it alone"), (None, "all of it alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) as rk").distinct().join(jaccard_join.representatives(docs), "rk").collect()
    assert sorted((str(r.doc_id), r.kept, r.rows) for r in got) == [("4", True, 1), ("9", False, 2), ("None", False, 1), ("None", True, 2)]


@pytest.mark.parametrize(("most", "whole"), [(0, 0), (3, 3), (40, 3), (63, 63), (200, 63)])
def test_the_driver_gets_the_most_frequent_shingles_alone(spark, monkeypatch, most, whole):
    rows = [(k, 1000 + k) for k in range(3)] + [(100 + k, 9) for k in range(60)]
    monkeypatch.setattr(jaccard_join, "FREQUENT_MOST", most)
    shingles, seen = jaccard_join.most_frequent(spark.createDataFrame(rows, "shingle long, seen long"))
    got = dict(zip(shingles.tolist(), seen.tolist(), strict=True))
    assert shingles.dtype == np.uint64 and (np.diff(shingles.astype(np.int64)) > 0).all()
    assert len(got) <= most and got.items() <= dict(rows).items() and sum(k < 100 for k in got) == min(3, whole)
    assert len(got) == whole or 3 < len(got) <= most  # of equal counts some that a hash picks


def test_no_frequent_shingles(spark):
    shingles, seen = jaccard_join.most_frequent(spark.createDataFrame([], "shingle long, seen long"))
    assert len(shingles) == len(seen) == 0 and shingles.dtype == np.uint64
