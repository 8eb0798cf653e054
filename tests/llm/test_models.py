import zlib

import numpy as np
import pyarrow as pa
import pytest

from graylane.llm import language, quality, registry, toxicity
from graylane.llm.common import table

SF = "/root/testdata/sf0.01"


def fold(i, k):
    return zlib.crc32(str(i).encode()) % k


@pytest.mark.parametrize(("name", "col", "k", "held", "least", "recall", "precision"), [("op2_quality", "quality", 5, 0, 0.9, 0.9, 0.9), ("op10_toxicity", "toxic", 4, 2, 0.85, 0.5, 0.5)])
def test_held_out_accuracy(spark, name, col, k, held, least, recall, precision):
    got = {r.doc_id: r for r in registry.QUERIES[name](spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r.held_out == (fold(i, k) == held) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    known = [(r.doc_id, r[col]) for r in table(spark, SF, "labels").collect() if fold(r.doc_id, k) == held and r.doc_id in got]
    hits, found, real = sum(got[i].predicted * y for i, y in known), sum(got[i].predicted for i, _ in known), sum(y for _, y in known)
    assert np.mean([got[i].predicted == y for i, y in known]) >= max(least, 1 - real / len(known), real / len(known))
    assert hits >= recall * real and hits >= precision * found


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in registry.QUERIES["op3_language"](spark, SF).collect()}
    assert got.keys() == docs.keys() and all(r.held_out == (fold(i, 3) == 1) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out and docs[i].lang]
    assert np.mean([got[i].lang_pred == docs[i].lang for i in held]) >= 0.97


TEXTS = [None, "", "!!! 123 --", "x", "word " * 20_000, "\U0001f600 ü", "normal words here"]


@pytest.mark.parametrize("model", [quality, toxicity])
def test_classifier_edge_cases(spark, model):
    docs = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6])], "doc_id long, text string").selectExpr("*", "1 as h", "2 as label", "'x' as score")
    schema = "doc_id long, quality int, toxic int"
    col = "quality" if model is quality else "toxic"
    none = spark.createDataFrame([], schema)
    assert {r.score for r in model.classify(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(i, 1, 1) for i in range(40)], schema)
    assert {r.score for r in model.classify(docs, one).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2, i % 2) for i in range(7)] + [(None, 1, 1), (2, None, None)], schema)
    got = model.classify(docs, both, col).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert model.classify(docs.limit(0), both).count() == 0


def test_misspellings_share_ngrams():
    rng = np.random.default_rng(0)
    plain = [" ".join(f"{a}{b}" for a, b in zip(rng.choice(list("bcdfgh"), 30), rng.choice(["ala", "eme", "iru", "olo"], 30), strict=True)) for _ in range(600)]
    texts = [t + " horrible idiotic person" if i % 2 else t for i, t in enumerate(plain)]
    model = toxicity.SubwordSoftmax.fit(texts, np.arange(600) % 2, 0.5)
    scores = model.score(pa.array([plain[0], plain[0] + " idiotiic horible", plain[0] + " horriblle persson"]))
    assert 10 * scores[0] < min(scores[1:]) and min(scores[1:]) > 0.3


def brute_phrases(text, known):
    """Cross-parsing by definition: the longest match, again and again."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in known:
            j += 1
        n, i = n + 1, max(j - 1, i + 1)
    return n


@pytest.mark.parametrize("seed", range(5))
def test_automaton_parses_like_brute_force(seed):
    rng = np.random.default_rng(seed)
    make = lambda n: "".join(rng.choice(list("abc d"), n))
    samples = {"x": [make(300).encode()], "y": [make(40).encode()]}
    parser = language.CrossParser(samples)
    for length in (1, 2, 17, 200):
        text = make(length).replace("a", "ae") + "z"
        symbols = language.plain(np.frombuffer(text.encode(), np.uint8))
        count = parser.phrases(parser.code[symbols], np.array([0]), np.array([len(symbols)]))[0]
        for k, name in enumerate(parser.languages):
            known = language.plain(np.frombuffer(samples[name][0], np.uint8)).tobytes().decode() + " "
            assert abs(count[k] - brute_phrases(symbols.tobytes().decode(), known)) <= 1


def test_texts_are_parsed_whole(monkeypatch):
    """Whether in steps with many others or one by one; a match goes over any border."""
    rng = np.random.default_rng(3)
    make = lambda n: "".join(rng.choice(list("abcdef "), n))
    known = make(5000)
    parser = language.CrossParser({"x": [known.encode()], "y": [make(500).encode()]})
    assert parser.phrases(parser.code[language.plain(np.frombuffer(known.encode(), np.uint8))], np.array([0]), np.array([len(language.plain(np.frombuffer(known.encode(), np.uint8)))]))[0][0] == 1
    texts = [make(int(n)) for n in rng.integers(0, 900, 60)] + [known[:3000] + make(2000)]
    want = parser.predict(pa.array(texts))
    for few in (0, 3, 100):
        monkeypatch.setattr(language, "FEW", few)
        got = parser.predict(pa.array(texts))
        assert (got[0] == want[0]).all() and np.allclose(got[1], want[1])


def brute_vote(model, text):
    """The score by dictionaries and all cosines, one text alone."""
    (_, _, _, term, n), = quality.terms(pa.array([text]))
    value = {int(t): np.log1p(k) * model.idf[t] for t, k in zip(term, n, strict=True) if model.idf[t] > 0}
    norm = np.sqrt(sum(v * v for v in value.values()))
    x = sum((v / norm) * model.v[t].astype(float) for t, v in value.items())
    cosine = model.known.astype(float) @ (x / np.sqrt(x @ x))
    near = sorted(range(len(cosine)), key=lambda i: -cosine[i])[: quality.NEIGHBOURS]
    w = [max(cosine[i], 0) ** 2 * model.weight[i] for i in near]
    return (sum(a * model.labels[i] for a, i in zip(w, near, strict=True)) + 0.1 * model.share) / (sum(w) + 0.1)


def test_votes_match_brute_force():
    rng = np.random.default_rng(1)
    make = lambda words: " ".join(rng.choice(words, int(rng.integers(5, 60))))
    good, bad = [f"word{i}" for i in range(80)], [f"#{i}!" for i in range(40)] + [f"word{i}" for i in range(40)]
    texts = [make(good if i % 2 else bad) for i in range(120)]
    model = quality.NearestVotes.fit(texts, np.arange(120) % 2, 0.4)
    new = [make(good), make(bad), make(good) + " " + make(bad)]
    assert np.allclose(model.score(pa.array(new)), [brute_vote(model, t) for t in new], atol=1e-3)


def brute_toxic(model, text):
    """The score from distinct words and their n-grams, hashed one by one."""
    words = list(dict.fromkeys("".join(c if c.isalnum() else " " for c in text.lower()).split()))
    bag = []
    for w in words:
        bag += [f for _, _, _, f in toxicity.subwords(pa.array([w]))][0].tolist()
    z = sum(float(model.weight[f]) for f in bag) / np.sqrt(max(sum(float(model.rarity[f]) ** 2 for f in bag), 1e-9))
    return 1 / (1 + np.exp(-(z * model.scale + model.bias)))


def test_toxic_scores_match_brute_force():
    rng = np.random.default_rng(2)
    plain = [" ".join(rng.choice([f"{a}{b}" for a in "bcdf" for b in ("ala", "eme", "iru")], 30)) for _ in range(200)]
    texts = [t + " horrible idiotic person" if i % 2 else t for i, t in enumerate(plain)]
    model = toxicity.SubwordSoftmax.fit(texts, np.arange(200) % 2, 0.5)
    new = ["A horrible, Idiotic day", plain[0] + " idiotic idiotic", "x", "bala; ceme"]
    assert np.allclose(model.score(pa.array(new)), [brute_toxic(model, t) for t in new], atol=1e-5)


def test_language_edge_cases(spark):
    more = [(i, "some words of it", "en") for i in range(100, 110)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)] + more + [(None, "words", None), (8, "words again", None)], "doc_id long, text string, lang string").selectExpr("*", "1 as letters", "2 as label")
    got = {r.doc_id: r for r in language.predict_language(docs).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {0, 1, 2}
    assert all(got[i].score == 0 for i in (0, 1, 2))
    empty = language.predict_language(docs.limit(0))
    assert empty.count() == 0 and {r.lang_pred for r in language.predict_language(docs.withColumn("lang", docs.lang.substr(1, 0)).selectExpr("doc_id", "text", "nullif(lang, '') as lang")).collect()} == {"und"}
