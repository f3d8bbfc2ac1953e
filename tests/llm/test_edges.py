"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from buildlens.llm import (
    byte_bpe,
    class_lm,
    html_text,
    language_id,
    licenses,
    mixing,
    near_duplicates,
    rule_ledger,
    secret_scan,
    top_k,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = "id row size key n word score kept comp times seed p s spans found target held_out lang_pred".split()
LONG = "the quick brown fox jumps over a lazy dog and runs on " * 3000
ROWS = [
    (1, "the cat sat on the mat and looked at the dog", "en", "a"),
    (2, "le chat est sur la table et regarde le chien", "fr", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t ", "en", "b"),
    (6, LONG, "en", "a"),
    (7, "x" * 20000, None, "a"),
    (8, "the cat sat on the mat and looked at the dog", "en", None),
    (8, "the cat sat on the mat and looked at the dog", "en", None),
    (None, "the bird sat in the tree and sang a song", "en", "a"),
    (None, None, None, None),
    (9, "12 34 56 !!", "fr", "b"),
    (10, "日本語 \U0001f600 ümlaut", "en", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in ROWS]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.withColumns(
        {name: F.lit(name) for name in CLASHING}
    )


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, id="doc_id"):
    found = {}
    for row in df.collect():
        found.setdefault(row[id], []).append(row)
    assert sum(map(len, found.values())) == len(ROWS)
    return found


def test_language(edge, none):
    found = by_id(language_id.identify(edge))
    for i in (3, 4, 5, 9):
        assert found[i][0].lang_pred == "und" and found[i][0].score == 0
    assert found[6][0].lang_pred == "en" and found[8][0] == found[8][1]
    assert all(0 <= r.score <= 1 for rows in found.values() for r in rows)
    assert language_id.identify(none).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    kept = language_id.recognised(edge)
    assert kept.columns == edge.columns and {3, 4, 5, 9}.isdisjoint({r.doc_id for r in kept.collect()})


def test_class_lm(edge, none):
    found = by_id(class_lm.scores(edge))
    assert [found[i][0].n_tokens for i in (3, 4, 5, 7)] == [1, 1, 1, 2]
    assert found[6][0].n_tokens == len(LONG.split()) + 1
    assert found[3][0].base_score == found[4][0].base_score and found[8][0] == found[8][1]
    assert class_lm.scores(none).count() == 0
    untrained = class_lm.score(edge, class_lm.train(none))
    assert all(abs(r.base_score) < 1e-6 for r in untrained.collect())


def test_secrets(edge, none):
    found = by_id(secret_scan.report(edge))
    assert all(r.spans == "" and r.n_hex == 0 for rows in found.values() for r in rows)
    assert secret_scan.report(none).count() == 0 and secret_scan.redact(none).count() == 0
    assert sorted(map(str, secret_scan.redact(edge).collect())) == sorted(map(str, edge.collect()))


def test_rules(edge, none):
    found = by_id(rule_ledger.verdicts(edge))
    assert [found[i][0].n_words for i in (3, 4, 5, 7)] == [0, 0, 0, 1]
    assert found[6][0].n_repeat_words == found[6][0].n_words == len(LONG.split())
    assert found[8][0].n_words == 11 and found[8][0].kept and not found[3][0].kept
    assert rule_ledger.verdicts(none).count() == 0
    assert {r.failed for r in rule_ledger.ablation(rule_ledger.verdicts(none)).collect()} == {0}


def test_mixing(edge, none):
    found = by_id(mixing.taken(edge))
    assert [found[i][0]["size"] for i in (3, 4, 5)] == [0, 0, 0]
    assert all(r.taken <= 2 * r["size"] for rows in found.values() for r in rows)
    assert mixing.taken(none).count() == 0 and mixing.mix(none).columns == none.columns
    assert mixing.mix(edge).columns == edge.columns


def test_bpe(edge, none):
    found = by_id(byte_bpe.round_trip(edge))
    assert [found[i][0].n_tokens for i in (3, 4)] == [0, 0] and found[8][0] == found[8][1]
    assert byte_bpe.round_trip(none).count() == 0


def test_licenses(edge, none, spark):
    assert licenses.found(edge).count() == 0 and licenses.found(none).count() == 0
    text = LONG + "\nReleased under the MIT License.\n" + LONG
    rows = licenses.found(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")).collect()
    assert len(rows) == 3 and all(text[r.start : r.end] == "Released under the MIT License." for r in rows)


def test_near_duplicates(edge, none):
    found = by_id(near_duplicates.components(edge))
    assert [found[i][0].component_id for i in (1, 8, 3, 4, 5, 6)] == [1, 1, 3, 4, 5, 6]
    assert [found[i][0].n_shingles for i in (3, 4, 5, 7)] == [0, 0, 0, 1]
    assert all(r.component_id is None and r.kept for r in found[None])
    assert near_duplicates.components(none).count() == 0
    # a row whose id is kept twice stays once
    twice = edge.filter("doc_id = 8 OR doc_id IS NULL OR doc_id = 3")
    kept = near_duplicates.deduplicated(twice)
    assert kept.columns == edge.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "None", "None"]


def test_pages(spark):
    rows = [
        (1, "u", "<body><nav><a href=x>menu</a></nav><article><p>One &amp; two<p>three  four</article><footer>end</footer>"),
        (2, None, None),
        (3, "u", ""),
        (4, "u", "<script>var a = '<p>no</p>'</script>"),
        (None, "u", "<p>" * 300 + "deep " * 2000),
        (1, "u", "<article><p>a<br>b</p></article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {x: F.lit(0) for x in ("text", "n_chars", "s")}
    )
    found = {(r.page_id, r.n_chars): r.text for r in html_text.extract(pages).collect()}
    assert found[(1, 20)] == "One & two\nthree four" and found[(1, 3)] == "a b"
    assert found[(2, 0)] == found[(3, 0)] == found[(4, 0)] == ""
    assert html_text.extract(pages.limit(0)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, 0.5]), (6, [1.0, 0.5]),
            (7, [2.0]), (8, []), (None, [9.0, 9.0]), (50, [1.0, 0.5]), (50, [1.0, 0.5]), (9, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {x: F.lit(1) for x in ("id", "v", "block", "label")}
    )
    found = [tuple(r) for r in top_k.search(vectors).orderBy("query_id", "rank").collect()]
    near = 256 * 256 + 128 * 128
    assert found == [
        (0, 1, 7, 512 * 256), (0, 2, 5, near), (0, 3, 6, near), (0, 4, 50, near), (0, 5, 50, near),
        (50, 1, 7, 512 * 256), (50, 2, 0, near), (50, 3, 5, near), (50, 4, 6, near), (50, 5, 8, 0),
    ]
    assert top_k.search(vectors.limit(0)).count() == 0
    assert [tuple(r) for r in top_k.search(vectors.filter("vec_id IN (0, 9)")).collect()] == [(0, 1, 9, -(256 * 256))]


def test_pipeline(edge, none):
    for frame in (edge, none):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(frame.sparkSession, docs, "")
            assert docs.columns == frame.columns
            docs = corpus_pipeline.written(docs, "test")
        last = corpus_pipeline.STAGES[-1][1](frame.sparkSession, docs, "")
        assert last.count() == docs.count()
    assert re.match("doc_id", last.columns[0])
