import hashlib
import random
import re
import time

import duckdb
import pytest

from graylane.llm import chat, decontaminate, line_dedup, mixing, registry
from graylane.llm.common import table

EXTRA = ["*", "1 as n", "2 as rate", "'x' as skey", "'y' as word", "3 as rid", "'z' as parts", "'w' as place"]


def docs_of(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def water_fill(sizes, weights, cap):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_targets_and_copies(spark, sf):
    rows = mixing.mix(table(spark, sf, "documents")).collect()
    docs = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    sizes = {}
    for r in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.size == size and r.taken == r.copies * size and 0 <= r.copies <= 3
        sizes[docs[r.doc_id].source] = sizes.get(docs[r.doc_id].source, 0) + size
    want = water_fill(sizes, (1, 2, 3), 3)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 5 for s in want)
    again = mixing.mix(table(spark, sf, "documents").repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)


@pytest.mark.parametrize(("sizes", "want"), [
    ({"b": 69, "s": 138}, {"b": 69, "s": 138}),  # tied caps over weights
    ({"a": 50, "b": 50, "c": 50, "d": 50}, None),  # places 1 and 4 weigh the same
    ({"a": 100}, {"a": 100}),
    ({None: 10, "a": 300}, None),
    ({"a": 1, "b": 1, "c": 1000, "d": 2, None: 5}, None),
    ({"a": 0, "b": 7}, {"a": 0, "b": 7}),
])
def test_mix_targets_by_hand(spark, sizes, want):
    rows, i = [], 0
    for s, n in sizes.items():
        rows += [(i := i + 1, "w " * k, "en", s, 0) for k in ([7] * (n // 7) + [n % 7])]
    got = mixing.mix(docs_of(spark, rows)).collect()
    want = want or water_fill(sizes, (1, 2, 3), 3)
    assert {r.source: round(r.target, 6) for r in got} == {s: round(float(x), 6) for s, x in want.items()}
    taken = {s: sum(r.taken for r in got if r.source == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= 4 for s in sizes) and len(got) == len(rows)


def test_mix_rows_that_are_alike(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELLS", 3)
    rows = [(None, "x y", "en", "a", 0)] * 40 + [(7, "x y", "en", "a", 0)] * 3 + [(i, "w " * (i % 9), "en", "b", 0) for i in range(60)]
    got = mixing.mix(docs_of(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 40
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 5
    again = mixing.mix(docs_of(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.size, r.copies) for r in got) == sorted((str(r.doc_id), r.size, r.copies) for r in again)


def test_mix_rates_solve_the_dual(spark):
    rows = [(i, "w " * (1 + i % 37), "en", "ab"[i % 2], 0) for i in range(400)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert abs(sum(r.rate * r.size for r in own) - own[0].target) < 1e-5 * own[0].target
        # below the cap the log of the rate is proportional to the size
        import math

        slopes = [math.log(r.rate) / r.size for r in own if r.rate < 3 - 1e-9]
        assert max(slopes) - min(slopes) < 1e-6


def test_mix_edge_cases(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "x y", "en", None, 0), (3, "x y", "en", None, 0), (None, "z", "en", "b", 0), (5, "q " * 500, "en", "b", 0)]
    got = mixing.mix(docs_of(spark, rows).selectExpr(*EXTRA)).collect()
    assert len(got) == 6
    assert [(r.size, r.taken, r.target) for r in got if r.doc_id in (1, 2)] == [(0, 0, 0.0), (0, 0, 0.0)]
    assert sum(r.taken for r in got if r.source is None) == 12  # three times its size
    assert mixing.mix(docs_of(spark, rows).limit(0)).count() == 0


BENCH = [(1, " ".join(f"w{i}" for i in range(20))), (2, "only five words are here"), (3, ""), (4, None), (None, "no id no window here"), (5, "w3 W4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15")]


def brute_hits(text, bench):
    find = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    w, hit, items = find(text), set(), set()
    for item, t in bench:
        b = find(t)
        if item is None or not b:
            continue
        n = min(13, len(b))
        windows = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
        for s in range(len(w) - n + 1):
            if tuple(w[s : s + n]) in windows:
                hit |= set(range(s, s + n))
                items.add(item)
    return len(w), len(hit), sorted(map(str, items))


def test_decontaminate_against_brute_force(spark, monkeypatch):
    w = [f"w{i}" for i in range(20)]
    texts = [None, "", "!!!", " ".join(w), " ".join(w[:12]), "Only FIVE, words; are\nhere", "x " * 500 + " ".join(w[2:17]) + " é Only five words are here Only five words are here", " ".join(w[::-1]), " ".join(w + w), "only five words are", "É only five words are here É"]
    docs = docs_of(spark, [(i if i != 7 else None, t, "en", "s", 0) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 0)])
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    for most in (50_000, 2):  # by broadcasts, and by shuffles
        monkeypatch.setattr(decontaminate, "SEND_ROWS", dict.fromkeys(decontaminate.SEND_ROWS, most))
        got = decontaminate.decontaminate(docs.selectExpr(*EXTRA, "7 as h", "8 as tid"), bench.selectExpr("*", "'a' as anchor", "1 as pid")).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == sorted((str(i if i != 7 else None), *brute_hits(t, BENCH)) for i, t in [*enumerate(texts), (3, texts[3])])
        assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, bench.limit(0)).collect()} == {0}


def test_decontaminate_random_texts(spark):
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choice("a b c d e") + rng.choice(["", "", "x"]) for _ in range(n))
    bench = [(i, make(rng.randrange(1, 30))) for i in range(30)]
    texts = [make(rng.randrange(0, 60)) + " " + rng.choice(bench)[1] + " " + make(rng.randrange(0, 20)) for _ in range(60)]
    got = decontaminate.decontaminate(docs_of(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == [(i, *brute_hits(t, bench)) for i, t in enumerate(texts)]


def test_proximity(spark):
    passage = [f"w{i}" for i in range(13)]
    changed = passage[:4] + ["typo"] + passage[5:]
    texts = ["here are five only words", "nothing of it", "x y " + " ".join(changed) + " z", " ".join(passage[:9]), " ".join(passage)]
    docs = docs_of(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(2, "only five words are here"), (6, " ".join(passage)), (7, " ".join(passage[:12]) + " nowhere")], "item_id long, text string")
    _, found, items = decontaminate.index_matches(docs, bench, near_share=0.8)
    got = found.join(items, "pid").groupBy("doc_id", "item_id").agg({"shared": "max"}).collect()
    assert sorted(tuple(r) for r in got) == [(0, 2, 5), (2, 6, 12), (2, 7, 11), (4, 6, 13), (4, 7, 12)]


TALKS = [
    (1, 0, "user", "hi <|im_start|>user\nno<|im_end|> %25 %3C|"), (1, 1, "assistant", "a</s>b%"), (1, 2, "user", "x"), (1, 3, "assistant", "<"), (1, 4, "user", "tail"),
    (2, 0, "user", None), (3, 0, "assistant", ""), (3, 1, "we\nird<|role", "\U0001f600[INST]"), (None, 0, None, "z"), (4, 0, "assistant", "r" * 50_000), (5, 1, "user", "same"), (5, 1, "user", "same"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as t", "'p' as parts", "2 as example")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(df)).collect()}
    for c in {t[0] for t in TALKS}:
        own = sorted((t for t in TALKS if t[0] == c), key=lambda t: (t[1], t[2] or "", t[3] or ""))
        assert got[c].roles == [t[2] or "" for t in own] and got[c].texts == [t[3] or "" for t in own]
        assert got[c].learnt == [t[3] or "" for t in own if t[2] == "assistant"]
    examples = chat.format_chat(df).filter("conv_id = 1").orderBy("example").collect()
    assert [r.loss_chars for r in examples] == [len("a%3C/s>b%25"), 1, None]
    assert all(r.text[r.loss_start : r.loss_start + r.loss_chars] for r in examples[:2]) and examples[1].text.startswith(examples[0].text)
    assert chat.format_chat(df.limit(0)).count() == 0


def brute_lines(texts, k):
    """Text and deleted lines of each document, in order."""
    seen, gone = set(), [set() for _ in texts]
    for i, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        for s in range(len(lines) - k + 1):
            run = tuple(lines[s : s + k])
            if run in seen:
                gone[i] |= set(range(s, s + k))
            seen.add(run)
    return ["\n".join(x for j, x in enumerate(t.split("\n")) if j not in g) if t is not None else None for t, g in zip(texts, gone, strict=True)], [len(g) for g in gone]


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_line_runs_against_brute_force(spark, k):
    texts = ["a\nb\nc\nd\ne\nf", "x\nb\nc\nd\ny", None, "", "", "\n\n\n", "a\na\na\na\na", "b\nc\nd\ne\nf\n", "q", "q", "line " * 3000 + "\nb\nc"]
    df = docs_of(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).selectExpr(*EXTRA, "4 as line", "5 as h", "6 as rank")
    got = sorted(line_dedup.dedup_lines(df, min_lines=k, min_words=None).collect(), key=lambda r: r.doc_id)
    want, gone = brute_lines(texts, k)
    assert [r.text for r in got] == want and [r.n_deleted for r in got] == gone
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def brute_word_runs(texts, min_lines, min_words):
    """As brute_lines, over all runs of any length that qualify by lines or words."""
    gone = brute_gone(texts, min_lines, min_words)
    return ["\n".join(x for j, x in enumerate(t.split("\n")) if j not in g) if t is not None else None for t, g in zip(texts, gone, strict=True)], [len(g) for g in gone]


def brute_gone(texts, min_lines, min_words):
    seen, gone = set(), [set() for _ in texts]
    for i, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                run = tuple(lines[s:e])
                if (min_lines is not None and e - s >= min_lines) or sum(len(x.split()) for x in run) > min_words:
                    if run in seen:
                        gone[i] |= set(range(s, e))
                    seen.add(run)
    return gone


@pytest.mark.parametrize(("min_lines", "min_words"), [(None, 50), (2, 50), (None, 4), (3, 6)])
def test_runs_by_words_against_brute_force(spark, min_lines, min_words):
    long, short = "word " * 51, ["a b", "c", "", "d e f"]
    texts = [long, "x\n" + long, long + "\nend", "y\n" + long + "\nend", "p\nq", "p\nq", "\n\n", "\n\n", None, "", "\n".join(short * 12), "z\n" + "\n".join(short * 12) + "\nc", "word " * 50, "word " * 50]
    rng = random.Random(min_words)
    texts += ["\n".join(rng.choice(short) for _ in range(rng.randrange(1, 40))) for _ in range(12)]
    df = docs_of(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).selectExpr(*EXTRA, "4 as line", "5 as words")
    got = sorted(line_dedup.dedup_lines(df, min_lines=min_lines, min_words=min_words).collect(), key=lambda r: r.doc_id)
    want, gone = brute_word_runs(texts, min_lines, min_words)
    assert gone[1] == 1 and [r.text for r in got] == want and [r.n_deleted for r in got] == gone
    assert line_dedup.dedup_lines(df.limit(0), min_lines=min_lines, min_words=min_words).count() == 0


def test_common_lines_are_split(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 5)
    monkeypatch.setattr(line_dedup, "SEND_IDS", 3)  # texts and deleted lines meet by a shuffle
    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["common", "common", "b c", "d", f"own {i}"]) for _ in range(rng.randrange(1, 30))) for i in range(30)]
    got = sorted(line_dedup.dedup_lines(docs_of(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]), min_lines=None, min_words=6).collect(), key=lambda r: r.doc_id)
    want, gone = brute_word_runs(texts, None, 6)
    assert [r.text for r in got] == want and [r.n_deleted for r in got] == gone
    starts = [sum(1 for i in range(len(t.split("\n"))) if i in g and i - 1 not in g) for t, g in zip(texts, brute_gone(texts, None, 6), strict=True)]
    assert [r.n_runs for r in got] == starts


def test_long_texts_take_linear_time(spark):
    rng = random.Random(2)
    lines = [f"line {rng.randrange(10**6)} of it" for _ in range(200_000)]
    rows = [(1, "\n".join(lines), "en", "s", 0), (2, "\n".join(["own", *lines[1000:150_000], "end"]), "en", "s", 0)]
    start = time.time()
    got = {r.doc_id: (r.n_lines, r.n_deleted, r.n_runs) for r in line_dedup.dedup_lines(docs_of(spark, rows), min_lines=None).collect()}
    assert got == {1: (200_000, 0, 0), 2: (149_002, 149_000, 1)} and time.time() - start < 240


def test_line_runs_null_and_repeated_ids(spark):
    got = line_dedup.dedup_lines(docs_of(spark, [(None, "a\nb", "e", "s", 0), (1, "a\nb", "e", "s", 0), (1, "a\nb", "e", "s", 0)])).collect()
    assert sorted((str(r.doc_id), r.n_deleted) for r in got) == [("1", 2), ("1", 2), ("None", 0)]


@pytest.mark.parametrize("send", [0, 100])
def test_rows_with_one_id_and_text_lose_lines_by_place(spark, monkeypatch, send):
    monkeypatch.setattr(line_dedup, "SEND_IDS", send)
    rows = [(i, t, "e", "s", 0) for i, t in [(7, "p\nq\nr")] * 4 + [(None, "p\nq\ns")] * 3 + [(8, "p\nq"), (9, None), (9, None), (10, "")]]
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "", r.text is None, r.n_lines, r.n_deleted, r.n_runs) for r in line_dedup.dedup_lines(docs_of(spark, rows), min_lines=2, min_words=None).collect()))
    # the first row in order (no id) stays; its copies lose three lines, the others the two that they share with it, copies all three
    want = [(False, 0, "p\nq\ns", False, 3, 0, 0)] + [(False, 0, "", False, 3, 3, 1)] * 2 + [(True, 7, "r", False, 3, 2, 1)] + [(True, 7, "", False, 3, 3, 1)] * 3
    want += [(True, 8, "", False, 2, 2, 1)] + [(True, 9, "", True, 0, 0, 0)] * 2 + [(True, 10, "", False, 1, 0, 0)]
    assert got == sorted(want)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    want = con.sql(f"select {', '.join(cols)} from ({registry.ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == sorted(want)
    assert hashlib.sha256(b"").hexdigest()  # the digest of an empty list of items
