import glob
import hashlib
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from graylane.llm import manifest, periodic_runs, quality_rules, registry, registry_records

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["*", "1 as row", "2 as key", "'x' as runs", "'y' as tree", "3 as idx", "'z' as h", "4 as host", "5 as n"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(registry_records.QUERIES))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got, want = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLES[name])
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want.select(", ".join(f'"{c}"' for c in cols)).fetchall())


# ---- periodic runs


def brute_runs(w, least, exponent):
    found = []
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and j > i:
                x = w[i : j + q]
                if not any(x[p:] == x[:-p] for p in range(1, q)):
                    found.append((i, len(x), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    r = random.Random(5)
    for _ in range(1500):
        least, exponent = r.choice([(2, 2), (4, 2), (6, 3), (24, 3), (5, 4)])
        n = r.randrange(0, 70)
        w = [b"%d" % r.randrange(r.choice([1, 2, 3, 8])) for _ in range(n)]
        if n and r.random() < 0.5:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randrange(2, 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert [tuple(x) for x in periodic_runs.runs_of_words(w, least, exponent).tolist()] == brute_runs(w, least, exponent)


def test_extensions_are_the_longest():
    r = random.Random(6)
    for _ in range(200):
        s = [r.randrange(1, 4) for _ in range(r.randrange(1, 60))] + [0]
        lce = periodic_runs.Extensions(s)
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s))]
        got = lce(*(periodic_runs.np.array(x) for x in zip(*pairs, strict=True))).tolist()
        for (i, j), n in zip(pairs, got, strict=True):
            k = 0
            while i + k < len(s) and j + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            assert n == k or i == j


def test_runs_of_odd_rows(spark):
    thrice, long = " ".join(["a", "b b", "c"] * 9), " ".join(str(i % 70_000) for i in range(220_000))
    rows = [(1, None, None, None, None), (2, "", "x", "s", 0), (None, thrice + "\n\t x", "x", "s", 1), (3, thrice, "x", "s", 1), (3, "no run", "x", "s", 1), (4, long, "x", "s", 1), (5, "w " * 30, "x", "s", 1)]
    out = periodic_runs.find_runs(spark.createDataFrame(rows, SCHEMA).selectExpr(*EXTRA)).collect()
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.kept_text) for r in out}
    assert len(out) == 7 and got[1, 0] == ([], "") and got[2, 0] == ([], "") and got[3, 2] == ([], "no run")
    assert got[None, 28] == ([(0, 27, 3)], "a b b c x") and got[3, 27] == ([(0, 27, 3)], "a b b c")
    assert got[4, 220_000] == ([(0, 220_000, 70_000)], " ".join(map(str, range(70_000)))) and got[5, 30] == ([(0, 30, 1)], "w")
    assert periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(spark.createDataFrame([], SCHEMA), min_exponent=1)


# ---- manifest


def brute_manifest(rows, claims):
    """(leaf, subroot, root, proof, folded, verified) of each row, by lang and doc_id, null first."""
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: H("".join(map(code, (r[0], r[3], r[2], n, r[1]))))
    tree = {}
    for r, n in sorted(((r, n) for r, n in zip(rows, claims, strict=True)), key=lambda x: (x[0][0] is not None, x[0][0] or 0, leaf(x[0], x[0][4]))):
        tree.setdefault(r[2], []).append((r, n))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    def path(all_levels, i):
        return [(("".join(x[i >> k ^ 1 : (i >> k ^ 1) + 1])), i >> k & 1) for k, x in enumerate(all_levels[:-1])]

    langs = sorted(tree, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: levels([leaf(r, r[4]) for r, _ in tree[g]]) for g in langs}
    top = levels([own[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, (r, n) in enumerate(tree[g]):
            steps, x = path(own[g], i) + path(top, k), leaf(r, n)
            for s, odd in steps:
                x = H(s + x if odd else x + s)
            out.append((r[0], leaf(r, r[4]), own[g][-1][0], top[-1][0], H("".join(s for s, _ in steps)), x, x == top[-1][0]))
    return sorted(out, key=repr)


def proven(df):
    hexed = lambda c: F.lower(F.hex(c))
    rows = df.select("key", hexed("leaf"), hexed("subroot"), hexed("root"), F.sha2(F.array_join(F.transform("proof", hexed), ""), 256), hexed("folded_root"), "verified").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(("step", "part"), [(1, 16), (2, 1), (3, 2), (8, 16)])
def test_manifest_against_python(spark, monkeypatch, step, part):
    monkeypatch.setattr(manifest, "PART", part)
    r = random.Random(step)
    rows = [(i, f"t{i}" if i % 9 else None, r.choice(["en", "de", "é", None, "zh"]), r.choice(["s", None]), i if i % 4 else None) for i in range(70)]
    rows += [(5, "t5", "en", "s", 5), (5, "t5", "en", "s", 5), (5, "other", "en", "s", 5), (None, "u", "en", None, None), (None, None, None, None, None), (900, "x", "alone", "s", 1)]
    claims = [r[4] + 1 if r[4] is not None and r[0] and r[0] % 3 == 0 else r[4] for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(*EXTRA).repartition(5)
    claim = F.when((F.col("doc_id") % 3 == 0) & (F.col("doc_id") != 0), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    assert proven(manifest.proofs(manifest.build(df, {"n_chars": claim}, step=step))) == brute_manifest(rows, claims)


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(i, "a", "en", "s", 1) for i in range(257)], [(i, "a", str(i), "s", 1) for i in range(9)]])
def test_manifest_of_few_and_many(spark, rows):
    step = 2 if len(rows) == 9 else 8  # more groups than one step spans
    assert proven(manifest.proofs(manifest.build(spark.createDataFrame(rows, SCHEMA), step=step))) == brute_manifest(rows, [r[4] for r in rows])


# ---- quality rules


def brute_rules(rows, share, least, left):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    normal = lambda t: " ".join(words(t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"))))
    texts, docs = {}, {}
    for _, text, _, host, _ in rows:
        texts.setdefault(host, set()).add(text)
    for host, found in texts.items():
        for text in found:
            for line in {normal(x) for x in (text or "").split("\n") if words(x)}:
                docs[host, line] = docs.get((host, line), 0) + 1
    out = []
    for i, text, _, host, _ in rows:
        text = text or ""
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        inside = {k + j for k, t in enumerate(tri) if tri.count(t) > 1 for j in range(3)}
        gone = sum(len(words(x)) for x in lines if docs[host, normal(x)] > least and 100 * docs[host, normal(x)] > share * len(texts[host]))
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed, gone, not failed and 100 * (len(w) - gone) >= left * len(w)))
    return sorted(out, key=repr)


def rule_rows():
    r = random.Random(3)
    rows = []
    for i in range(120):
        host = r.choice(["a", "a", "b", None])
        lines = [" ".join(f"{r.choice('xyzé')}{r.randrange(200)}" for _ in range(r.randrange(1, 15))) for _ in range(r.randrange(1, 12))]
        if host == "a" and i % 3:
            lines.insert(r.randrange(len(lines) + 1), f"  Posted  on {i} by\tADMIN  ")
        if i % 20 == 0:
            lines = ["Common line of many words that stands in a good part of all the texts of host a " * 3] * 2 + lines[:2]
        rows.append((i, "\n".join(lines) + "\n" * (i % 3), "en", host, 1))
    return rows + [(200, None, None, None, None), (201, "", "en", "a", 0), (202, "# * $\n\n \t\n#", "en", "b", 0), (None, rows[5][1], "en", rows[5][3], 1), (5, rows[5][1], "en", rows[5][3], 1), (5, "a b c " * 40, "en", "c", 1)]


@pytest.mark.parametrize("send", [0, 2_000_000])
def test_rules_against_python(spark, monkeypatch, send):
    monkeypatch.setattr(quality_rules, "SEND_ROWS", send)
    rows = rule_rows()
    out = quality_rules.judge(spark.createDataFrame(rows, SCHEMA).selectExpr(*EXTRA).repartition(3), line_share=15, least_docs=4)
    got = sorted(map(tuple, out.select("doc_id", *quality_rules._COUNTS, "base_failed", "n_removed_words", "kept").collect()), key=repr)
    want = brute_rules(rows, 15, 4, 50)
    assert got == want and any(r[7] for r in want)


def test_cleaned_texts(spark):
    page = "\n".join(["Share this page", *(f"line {k} of the {k} text" for k in range(12)), "share  THIS page", ""])
    rows = [(i, page.replace("text", f"text w{chr(97 + i)}"), "en", "a", i) for i in range(8)] + [(9, page, "en", "b", 1), (10, None, "en", "a", 1), (11, "Share this page", "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(*EXTRA)
    out = quality_rules.clean(docs, least_docs=3)
    assert out.columns == docs.columns
    lines = {r.doc_id: r.text.split("\n") for r in out.collect()}
    assert sorted(lines) == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert all(len(lines[i]) == 13 and not any("hare" in x for x in lines[i]) for i in range(8)) and len(lines[9]) == 15
    assert quality_rules.clean(docs.limit(0)).collect() == [] and quality_rules.judge(docs.limit(0)).collect() == []


def test_a_very_long_text_is_counted(spark):
    text = " ".join(f"w{i}" for i in range(300_000)) + "\n" + "tail " * 4
    row = quality_rules.judge(spark.createDataFrame([(1, text, "en", "a", 1)], SCHEMA)).first()
    assert (row.n_words, row.n_repeat_words, row.kept) == (300_004, 4, True)
