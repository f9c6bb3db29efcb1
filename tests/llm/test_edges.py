"""Nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirescope.llm import chat, decontaminate, langid, lines, lm, mixing, pii, quality, simhash, toxicity
from hirescope.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
ROWS = [(1, "the cat sat on the mat " * 3, "en", "a", 5), (1, "the cat sat on the mat " * 3, "en", "a", 5), (2, None, None, None, None),
        (3, "", "de", "b", 0), (None, "die katze sitzt", "de", None, 1), (4, "x" * 200_000, None, "a", 2), (5, "wort " * 30_000 + "\nidiot", "de", "b", 3),
        (1, "another text with the same id", "en", "a", 5)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("row", "fp", "key", "id", "words", "score", "tokens", "topic", "p", "held_out", "kept", "value", "component_id", "cell_p", "gone", "toxic"):
        df = df.withColumn(name, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 0, None), (None, 1, 1), (99, 1, 1)], LABELS)


PER_ROW = {
    "langid": lambda d, _: langid.language_id(d), "pii": lambda d, _: pii.pii_digest(d), "lm": lambda d, _: lm.lm_scores(d),
    "simhash": lambda d, _: simhash.simhash_digest(d), "mixing": lambda d, _: mixing.mix(d), "quality": lambda d, _: quality.quality_rules(d),
    "toxicity": toxicity.toxicity,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_per_row(spark, odd, labels, name):
    got = PER_ROW[name](odd, labels)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(r[0]) for r in ROWS)
    empty = PER_ROW[name](odd.limit(0), labels.limit(0))
    assert empty.count() == 0 and empty.columns == got.columns


def test_undetermined_language(spark, odd):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_id(odd).collect()}
    assert got[2] == got[3] == ("und", 0.0) and got[5][0] in ("de", "en")


def test_filters_keep_columns_and_rows(spark, odd, labels):
    items = spark.createDataFrame([(1, "the cat sat on the mat the cat"), (2, None)], "item_id long, text string")
    for got in (toxicity.drop_toxic(odd, labels), lines.drop_repeated_lines(odd), simhash.drop_near_copies(odd),
                decontaminate.decontaminate(odd, items), mixing.sample_mixture(odd, rate=100.0)):
        assert got.columns == odd.columns and got.count() > 0
        assert got.where("row <> 'clash'").count() == 0
    clean = decontaminate.decontaminate(odd, items)
    assert clean.where("doc_id = 1").count() == 0 and clean.count() == 5
    for f in (lambda d: toxicity.drop_toxic(d, labels.limit(0)), lines.drop_repeated_lines, simhash.drop_near_copies,
              lambda d: decontaminate.decontaminate(d, items), mixing.sample_mixture):
        assert f(odd.limit(0)).count() == 0


def test_chat_without_rows_and_with_nulls(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    assert chat.chat_digest(spark.createDataFrame([], schema)).count() == 0
    got = chat.chat_digest(spark.createDataFrame([(None, None, None, None, "x"), (1, 0, "user", "y" * 500_000, "x")], schema)).collect()
    assert sorted(r.n_turns for r in got) == [1, 1] and not any(r.valid for r in got)


def test_pipeline_against_its_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    want = docs
    for name, stage in corpus_pipeline.STAGES:
        want = spark.createDataFrame(stage(spark, want, sf).toPandas(), docs.schema)
        assert want.columns == docs.columns, name
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and 0 < got.count() < docs.count()
