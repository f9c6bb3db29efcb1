"""H1-H3, A2, J32 on hand-made cases."""

import re


from hirescope.functions.text import all_ngrams, norm, tokens
from hirescope.operators.skills import build_lexicon, extract_skills, skill_wide


def py_norm(s):
    s = s.lower()
    s = re.sub(r"[^a-z0-9+#./\- ]", " ", s)
    return re.sub(r"\s+", " ", s).strip()


CASES = ["", "C++ / C#", "  Hello,   WORLD!! ", "!!!", "one", "Data-Science\tand\nML.", "déjà vu"]


def test_norm_matches_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, t string")
    got = {r.id: r.n for r in df.select("id", norm("t").alias("n")).collect()}
    for i, t in enumerate(CASES):
        assert got[i] == py_norm(t), (t, got[i])


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, ""), (3, "x")], "id int, t string")
    r = {x.id: (x.toks, x.g) for x in df.select("id", tokens(norm("t")).alias("toks"))
         .select("id", "toks", all_ngrams("toks", [1, 2, 3]).alias("g")).collect()}
    assert r[2] == ([], [])
    assert r[3] == (["x"], ["x"])
    assert sorted(r[1][1]) == sorted(["a", "b", "c", "d", "a b", "b c", "c d", "a b c", "b c d"])


def test_lexicon_first_column_and_bounds(spark):
    raw = spark.createDataFrame([("Python",), ("machine  learning",), (None,), ("!!!",), ("a b c d e",)], "word string")
    lex = build_lexicon(raw, 1, 3)
    assert sorted(r.phrase for r in lex.collect()) == ["machine learning", "python"]


def test_extract_nested_overlapping_and_missing(spark):
    lex = spark.createDataFrame([("machine learning", 2), ("learning", 1), ("c++", 1), ("deep learning", 2)],
                                "phrase string, n_words int")
    posts = spark.createDataFrame([(1, "Machine Learning and deep learning; C++"), (2, None), (1, "C++ again"),
                                   (3, "learning")], "posting_id long, description string")
    got = sorted((r.posting_id, r.skill) for r in extract_skills(posts, lex).collect())
    assert got == [(1, "c++"), (1, "deep learning"), (1, "learning"), (1, "machine learning"), (3, "learning")]


def test_skill_wide_zero_default(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "posting_id long, title string")
    s = spark.createDataFrame([(1, "python"), (1, "sql")], "posting_id long, skill string")
    rows = {r.posting_id: r for r in skill_wide(p, s).collect()}
    assert rows[1].skill_python == 1 and rows[1].skill_sql == 1 and rows[2].skill_python == 0 and rows[2].skill_sql == 0
