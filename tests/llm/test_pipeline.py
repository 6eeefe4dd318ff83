"""Every stage of the pipeline on the given documents and on odd ones, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import brute as brute_hits
from test_join import brute as brute_classes
from test_join import row_classes, shingles

from matchlake.llm import ngram_join

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def assert_one_of_each_class(kept, given):
    """Rows without words all stay; of each class the text of the smallest doc_id, once, null ids last."""
    classes = row_classes([(r.doc_id, r.text) for r in given], 5, 80)
    left = [str(tuple(r)) for r in kept]
    for members in classes:
        rows_of = [given[i] for i in members]
        stay = []
        for r in rows_of:
            if str(tuple(r)) in left:
                left.remove(str(tuple(r)))
                stay.append(r)
        if not shingles(rows_of[0].text, 5):
            assert len(stay) == len(rows_of)
            continue
        ids = [r.doc_id for r in rows_of if r.doc_id is not None]
        assert len(stay) == 1 and stay[0].doc_id == min(ids, default=None)
    assert not left


def test_texts_under_one_id_and_without_id(session):
    """Two families of near copies meet in one id; another family has no id at all."""
    base, other, third = (" ".join(f"{w}{i}" for i in range(80)) for w in "abc")
    near = lambda t: t.replace("40", "x40")
    given = [(1, base), (2, near(base)), (2, other), (7, near(other)), (None, near(third)), (None, third), (None, third),
             (8, "alone here with some words of its own"), (8, "and again another one under this very id"), (9, ""), (9, None)]
    docs = session.createDataFrame([(*r, "en", "s", 1) for r in given], "doc_id long, text string, lang string, source string, n_chars long")
    for partitions in (3, 4, 7):
        dealt = docs.repartition(partitions)
        assert_one_of_each_class(corpus_pipeline.drop_near_copies(session, dealt, SF_DIR).collect(), docs.collect())
        got = ngram_join.ngram_classes(dealt).collect()
        assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute_classes(given, 5, 80)


@pytest.mark.parametrize("which", ["odd_documents", "documents", "no_documents"])
def test_stages(which, request, session):
    docs = request.getfixturevalue(which)
    stage = dict(corpus_pipeline.STAGES)
    given = docs.collect()

    kept = stage["language_id"](session, docs, SF_DIR)
    assert kept.columns == docs.columns
    letters = [r for r in given if any(c.isalpha() for c in r.text or "")]
    assert rows(kept) == sorted(str(tuple(r)) for r in letters)

    kept = stage["ngram_jaccard_join"](session, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert_one_of_each_class(kept.collect(), given)

    kept = stage["decontamination"](session, docs, SF_DIR)
    items = session.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    hits = brute_hits([(i, r.text) for i, r in enumerate(given)], [(r.item_id, r.text) for r in items])
    clean = {int(h.split(", ")[0][1:]) for h in hits if h.split(", ")[2] == "0"}
    assert rows(kept) == sorted(str(tuple(r)) for i, r in enumerate(given) if i in clean)

    mixed = stage["mixing"](session, docs, SF_DIR)
    assert mixed.columns == docs.columns
    tokens = stage["token_output"](session, mixed, SF_DIR)
    assert tokens.count() == mixed.count()


def test_whole_run(session):
    got = corpus_pipeline.run(session, SF_DIR)
    assert got.select("doc_id").distinct().count() > 50
    assert got.agg(F.sum("n_tokens")).first()[0] == got.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]


def test_without_languages_to_learn_from(session):
    docs = session.createDataFrame([(1, "some words"), (2, "12 34"), (3, None), (4, "é")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(session, docs, SF_DIR).collect()) == [1, 4]
