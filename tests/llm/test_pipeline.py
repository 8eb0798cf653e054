import pytest

import corpus_pipeline
from graylane.llm import decontaminate, jaccard_join, mixing, toxicity
from graylane.llm.common import table
from tests.llm.test_native import brute_hits
from tests.llm.test_vectors_tokens import brute_ids


@pytest.fixture(scope="module")
def results(spark, sf, tmp_path_factory):
    """Each stage's input and output rows, written and read again between the stages."""
    base, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{base}/{k}")
        after = spark.read.parquet(f"{base}/{k}")
        out.append((docs.collect(), after.collect()))
        docs = after
    return out


def test_stages_keep_the_columns(results):
    for before, after in results[:-1]:
        assert set(after[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}
        assert {r.doc_id for r in after} <= {r.doc_id for r in before}


def test_toxic_documents_go(spark, sf, results):
    before, after = results[0]
    scores = {r.doc_id: r.predicted for r in toxicity.scored(table(spark, sf, "documents"), toxicity.fit(table(spark, sf, "labels").selectExpr("doc_id", "toxic as label"), table(spark, sf, "documents"))).collect()}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not scores[r.doc_id])


def test_one_of_each_group_stays(spark, results):
    before, after = results[1]
    groups = jaccard_join.jaccard_components(spark.createDataFrame(before)).collect()
    assert sorted(r.doc_id for r in after) == sorted({r.component_id for r in groups})


def test_contaminated_documents_go(spark, sf, results):
    before, after = results[2]
    bench = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    kept = {r.doc_id for r in after}
    for r in before:
        words, hit, _ = brute_hits(r.text, bench)
        assert (r.doc_id in kept) == (not (hit and 20 * hit >= words))
    assert decontaminate.WORD


def test_mix_repeats_and_drops(results):
    before, after = results[3]
    counts = {}
    for r in after:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) in (2, 3) and {r.doc_id: r.text for r in after}.items() <= {r.doc_id: r.text for r in before}.items()


def test_ids_of_all_rows(results):
    before, after = results[4]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after) == sorted(brute_ids([(r.doc_id, r.text) for r in before]))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_null_and_repeated_rows(spark, sf):
    text, alone = "some clean words that stand here and in no other place at all", "this one stands alone and has no number of its own either"
    rows = [(None, text, "en", "s", 1), (1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", None, 1), (3, None, None, None, None), (4, "", "en", "s", 0), (None, alone, "en", "s", 1), (1, alone[::-1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    key = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    want = sorted([("1", text), ("3", None), ("4", ""), ("None", alone), ("1", alone[::-1])], key=str)
    near = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert sorted(key(near), key=str) == want
    clean = corpus_pipeline.drop_contaminated(spark, near, sf)
    assert sorted(key(clean), key=str) == want
    mixed = corpus_pipeline.mix_sources(spark, clean, sf)
    assert set(key(mixed)) <= set(want) and mixed.filter("doc_id is null").count() and {("3", None), ("4", "")} <= set(key(mixed))
    assert corpus_pipeline.write_ids(spark, mixed, sf).count() == mixed.count()


def test_rows_are_decided_on_by_their_own_text(spark, sf):
    """An id may be missing or stand for several texts."""
    bench = table(spark, sf, "benchmark").filter("length(text) > 200").first().text
    docs = spark.createDataFrame([(1, bench, "en", "s", 1), (1, "clean words", "en", "s", 1), (None, bench, "en", "s", 1), (None, "more clean words", "en", "s", 1)], SCHEMA)
    assert sorted(r.text for r in corpus_pipeline.drop_contaminated(spark, docs, sf).collect()) == ["clean words", "more clean words"]
    toxic = table(spark, sf, "documents").join(table(spark, sf, "labels").filter("toxic = 1"), "doc_id").select(*corpus_pipeline.COLUMNS)
    both = toxic.withColumn("doc_id", toxic.doc_id * 0).unionByName(toxic.selectExpr("cast(null as long) as doc_id", "text", "lang", "source", "n_chars"))
    scores = toxicity.scored(both, toxicity.fit(table(spark, sf, "labels").selectExpr("doc_id", "toxic as label"), both), keep=("text",)).filter("predicted = 0").count()
    assert corpus_pipeline.drop_toxic(spark, both, sf).count() == scores


def test_mix_takes_all_copies(spark, sf):
    rows = [(None, "x y", "en", "a", 0)] * 40 + [(7, "p q r", "en", "a", 0), (7, "other", "en", "a", 0)] + [(i, "w " * (i % 9), "en", "b", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {}
    for r in mixing.mix(docs).collect():
        want[str(r.doc_id), r.source, r.size] = want.get((str(r.doc_id), r.source, r.size), 0) + r.copies
    got = {}
    for r in corpus_pipeline.mix_sources(spark, docs, sf).collect():
        k = str(r.doc_id), r.source, len(r.text.split())
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_the_same_of_repeated_rows_stays(spark, sf):
    text = "words that are the same in all of these rows and stand in five of them"
    rows = [(1, text, lang, source, n) for lang, source, n in (("en", "b", 2), ("de", "b", 1), (None, "a", 5), ("en", None, 3), ("de", "b", 0))] + [(2, text + " more", "en", "z", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    near = {tuple(map(tuple, corpus_pipeline.drop_near_copies(spark, docs.repartition(k, c), sf).collect())) for k, c in ((1, "lang"), (4, "n_chars"), (3, "source"))}
    assert near == {((1, text, None, "a", 5),)}
    mixed = {tuple(sorted(map(tuple, corpus_pipeline.mix_sources(spark, docs.repartition(k, c), sf).collect()), key=repr)) for k, c in ((1, "lang"), (4, "n_chars"), (3, "source"))}
    assert len(mixed) == 1 and all(r[2:] == ("de", "b", 0) for r in next(iter(mixed)) if r[3] == "b")


def test_empty_tables_and_further_columns(spark, sf):
    odd = ["*", "1 as h", "2 as rk", "'x' as least", "3 as copies", "4 as label", "5 as rows"]
    for docs in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "one text that stays as it is here", "en", "s", 1)], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs.selectExpr(*odd), sf)
            assert out.count() == docs.count() or name == "mixing"
            assert name == "token ids" or sorted(out.columns) == sorted(corpus_pipeline.COLUMNS)
    docs = table(spark, sf, "documents")
    assert corpus_pipeline.drop_toxic(spark, docs.selectExpr(*odd), sf).columns == list(corpus_pipeline.COLUMNS)
