import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from graylane.llm import embedding_dedup, registry, token_output
from graylane.llm.common import table


def brute_links(rows, threshold=0.95):
    """(links, component) by id over all pairs."""
    ids, xs = [], []
    for i, v in rows:
        ids.append(i)
        x = np.array([np.nan if c is None else c for c in v] if v is not None else [0.0], np.float64)
        ok = len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        xs.append(x / np.sqrt(x @ x) if ok else None)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = dict.fromkeys(ids, 0)
    for a in range(len(ids)):
        for b in range(a):
            if xs[a] is not None and xs[b] is not None and len(xs[a]) == len(xs[b]) and xs[a] @ xs[b] >= threshold:
                links[ids[a]] += 1
                links[ids[b]] += 1
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return links, {i: root(i) for i in ids}


def test_embedding_links_match_brute_force(spark, sf):
    # the small table has no near copies, so some are made from it
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    rng = np.random.default_rng(3)
    noise = np.abs(np.array(rows[0][1])).mean()
    rows += [(10_000 + 10 * i + k, (np.array(v) + noise * s * rng.standard_normal(len(v))).astype(np.float32).tolist()) for i, v in rows[:150] for k, s in enumerate((0.0, 0.1, 0.2, 0.3, 0.4))]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    links, comp = brute_links(rows)
    assert set(got) == set(links)
    found, want = sum(r.n_links for r in got.values()), sum(links.values())
    assert want > 0 and 0.9 * want <= found <= want
    assert all(got[i].n_links <= links[i] for i in links)
    assert np.mean([got[i].component_id == comp[i] for i in comp]) > 0.9
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embedding_edge_cases(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, e), (2, e), (3, [x * 1e-30 for x in e]), (4, [0.0, 0.0, 0.0]), (5, None), (6, [1.0, None, 2.0]), (7, [float("nan"), 1.0, 1.0]), (8, []), (9, [1.0, 2.0]), (None, e), (10, [float("inf"), 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as label", "2 as x", "'a' as bucket")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert {i: got[i].n_links for i in got} == {1: 2, 2: 2, 3: 2, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 0, None: 0}
    assert [got[i].component_id for i in (1, 2, 3, 4, 9, None)] == [1, 1, 1, 4, 9, None]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_one_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (3, [0.0, 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)]
    alone = embedding_dedup.near_duplicates(spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links) for r in alone) == [(1, 0), (1, 1), (2, 1)]


def test_bucket_larger_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 8)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(60)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    links, _ = brute_links([(i, np.float32(v).tolist()) for i, v in rows])
    assert sum(r.n_links for r in got) >= 0.98 * sum(links.values())
    assert {r.component_id for r in got} == {0}


def brute_ids(docs, end_id=2):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for i, text in sorted(docs, key=lambda d: d[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_null_ids_come_first(spark):
    rows = [(None, "b a"), (None, "b a"), (-(2**63), "x"), (3, "y z")]
    got = token_output.read_tokens(token_output.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"))).collect()
    want = brute_ids([(-2, "b a"), (-1, "b a"), (0, "x"), (3, "y z")])
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sorted(got, key=lambda r: r.start)] == [(i, *w[1:]) for i, w in zip([None, None, -(2**63), 3], want, strict=True)]


def test_tokens_come_back(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = sorted(tuple(r) for r in registry.QUERIES["op7_token_output"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == brute_ids(docs)


def test_token_edge_cases_and_random_access(spark):
    docs = [(-(2**63), "the least id"), (5, None), (1, ""), (3, "ab " * 5000), (2, "# # #\n\n"), (9, "\U0001f600 é"), (7, "ab ab ab <|endoftext|> ab")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as part", "1 as h", "2 as first")
    shards = token_output.write_tokens(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(tuple(r) for r in token_output.read_tokens(shards).collect()) == brute_ids(docs)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(docs)
    for row in shards.collect():
        for k, i in enumerate(np.frombuffer(row.doc_ids, "<i8").tolist()):
            want = [*t.encode(texts[i] or "", add_special_tokens=False).ids, 2]
            assert token_output.ids_of(row.asDict(), k).tolist() == want
            assert token_output.ids_of(row.asDict(), k, len(want) // 3, len(want) // 2 + 1).tolist() == want[len(want) // 3 : len(want) // 2 + 1]
    assert token_output.read_tokens(token_output.write_tokens(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, [2, 3, 10, 300, 50_000][seed], 20_000).astype(np.uint32)
    last = rng.random(len(ids)) < 0.01
    last[-1] = True
    seq, ends, rules = token_output.repair(ids, last, 50_257)
    assert ends.sum() == last.sum()
    back = token_output.expand(seq, 50_257, rules, token_output.spans_of(rules, 50_257))
    assert (back == ids).all()
    if seed < 3:
        assert len(seq) + 2 * len(rules) < 0.7 * len(ids)


def test_grammar_goes_on_while_pairs_pay():
    rng = np.random.default_rng(7)
    block = rng.integers(0, 50_000, 4096)
    ids = np.tile(block, 64).astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[4095::4096] = True
    seq, ends, rules = token_output.repair(ids, last, 50_257)
    assert len(seq) == 64 and ends.all()  # each copy is one symbol
    assert (token_output.expand(seq, 50_257, rules, token_output.spans_of(rules, 50_257)) == ids).all()
    ids, last = rng.zipf(1.3, 50_000).clip(0, 50_000).astype(np.uint32), rng.random(50_000) < 0.01
    last[-1] = True
    seq, ends, rules = token_output.repair(ids, last, 50_257)
    pairs = [(x, y) for x, y, e in zip(seq[:-1].tolist(), seq[1:].tolist(), ends[:-1].tolist(), strict=True) if not e and x != y]
    assert np.unique(np.array(pairs), axis=0, return_counts=True)[1].max() <= token_output.RULE_BYTES // 2  # a place saves two bytes here
    assert (token_output.expand(seq, 50_257, rules, token_output.spans_of(rules, 50_257)) == ids).all()


@pytest.mark.parametrize(("alphabet", "words", "size", "times", "wide"), [(5_000, 42_000, 2, 8, False), (60_000, 6_000, 8, 12, True), (60_000, 9_000, 2, 7, False)])
def test_grammar_has_all_rules_that_pay(alphabet, words, size, times, wide):
    rng = np.random.default_rng(words)
    code = rng.choice(alphabet * alphabet, words * size // 2, replace=False)
    each = np.stack([code // alphabet, code % alphabet], axis=1).reshape(words, size)
    ids = each[rng.permutation(np.repeat(np.arange(words), times))].ravel().astype(np.uint32)
    last = np.arange(len(ids)) % size == size - 1
    seq, ends, rules = token_output.repair(ids, last, alphabet)
    assert (token_output.expand(seq, alphabet, rules, token_output.spans_of(rules, alphabet)) == ids).all()
    assert (alphabet + len(rules) > 65_536) is wide
    if alphabet + words <= 65_536 or wide:  # each word is one symbol, by the numbers of two bytes or at the cost of four
        assert len(seq) == words * times and ends.all() and len(rules) >= words
    else:  # seven places pay as long as two bytes hold a symbol, and four bytes would take more in all
        assert len(rules) == 65_536 - alphabet


def test_look_ups_follow_only_what_they_need(spark):
    rng = np.random.default_rng(3)
    text = " ".join(f"w{k}" for k in rng.zipf(1.4, 200_000).clip(0, 5_000))
    shard = token_output.write_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json")).first().asDict()
    whole = token_output.ids_of(shard, 0)
    assert len(whole) == np.frombuffer(shard["lengths"], "<u4")[0] and len(whole) > 200_000
    for start in (0, 1, 777, len(whole) // 2, len(whole) - 3):
        assert (token_output.ids_of(shard, 0, start, start + 3) == whole[start : start + 3]).all()
    rules, spans = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), np.frombuffer(shard["spans"], "<u4")
    body = np.frombuffer(shard["body"], f"<u{shard['width']}").astype(np.int64)
    few = body[1000:1010]
    seconds = lambda f: min((t := time.perf_counter(), f(), time.perf_counter() - t)[2] for _ in range(5))
    one = seconds(lambda: token_output.expand_range(few, shard["base"], rules, spans, 2, 5))
    assert one < 0.1 * seconds(lambda: token_output.expand(body, shard["base"], rules, spans))


def test_a_word_is_encoded_once_whatever_mark_follows(monkeypatch):
    encoder, asked = token_output.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    assert encoder.cuts and encoder.pieces
    plain = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: (asked.extend(texts), plain(texts))[1])
    texts = [f"Ab zyxwvut{m} and Qponm{m}\nLkjih{m} gf" for m in ("", *".,;:!?")] + ["zyxwvut.. zyxwvut.\n\nLkjih zyxwvut's zyxwvut1, é, (zyxwvut) \nLkjih\n.", "", " ", "\n"]
    assert encoder.encode(texts) == plain(texts)
    asked.clear()
    more = [x.replace("Ab", "Qponm! zyxwvut?\nLkjih: Ab") for x in texts[:7]]
    assert encoder.encode(more) == plain(more) and not any("zyxwvut" in x for x in asked)


def test_pairs_are_counted_alike_in_four_and_eight_bytes():
    rng = np.random.default_rng(11)
    ids = rng.zipf(1.2, 60_000).clip(0, 60_000).astype(np.uint32)
    ids[1000:3000] = 7  # one symbol in a row
    last = rng.random(len(ids)) < 0.01
    last[-1] = True
    for base in (60_001, 65_535, 65_536, 65_537):
        seq, ends, rules = token_output.repair(ids, last, base)
        assert ends.sum() == last.sum() and (rules < base + np.arange(len(rules))[:, None]).all()
        assert (token_output.expand(seq, base, rules, token_output.spans_of(rules, base)) == ids).all()
