"""A1/A3 round trip, A4 shared table, and the streaming extraction."""

import tempfile


from hirescope.operators.skills import build_lexicon
from hirescope.sources.csv_io import read_lexicon_csv, read_postings_checked, read_postings_csv, share, write_csv
from hirescope.streaming.skill_stream import start_skill_stream


def test_csv_round_trip_multiline(spark):
    d = tempfile.mkdtemp(prefix="hs-csv-")
    df = spark.createDataFrame([(1, "ACME", 'Line one\nline "two", Python', 1.5e5, 1.7e12)],
                               "posting_id long, company_name string, description string, normalized_salary double, listed_time double")
    write_csv(df.coalesce(1), d)
    back = read_postings_csv(spark, d)
    r = back.collect()[0]
    assert r.description == 'Line one\nline "two", Python' and r.normalized_salary == 1.5e5
    assert dict(back.dtypes)["posting_id"] == "bigint"


def test_lexicon_csv_and_share(spark):
    d = tempfile.mkdtemp(prefix="hs-lex-")
    spark.createDataFrame([("Python",), ("SQL",)], "Skill string").coalesce(1).write.mode("overwrite") \
        .option("header", True).csv(d)
    lex = build_lexicon(read_lexicon_csv(spark, d), 1, 3)
    s = share(lex, "lexicon_view")
    assert spark.sql("SELECT count(*) FROM lexicon_view").first()[0] == 2 and s.is_cached


def test_stream_matches_batch(spark):
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("hs-src-", "hs-out-", "hs-ck-"))
    posts = spark.createDataFrame([(1, "python and sql", 10.0), (2, "Deep Learning", -1.0), (3, None, 5.0)],
                                  "posting_id long, description string, normalized_salary double")
    posts.write.mode("overwrite").parquet(src)
    lex_raw = spark.createDataFrame([("python",), ("deep learning",), ("sql",)], "Skill string")
    q = start_skill_stream(spark, src, posts.schema, lex_raw, out, ck, available_now=True)
    q.awaitTermination(120)
    got = sorted((r.posting_id, r.skill) for r in spark.read.parquet(out).collect())
    assert got == [(1, "python"), (1, "sql")]  # posting 2 has a negative salary and is dropped


def test_tables_shared_by_key_join_without_an_exchange(spark):
    """C2 and J20 on shared tables: no exchange on the posting id."""
    from hirescope.operators.cluster import cluster_skill_labels
    from hirescope.sources.csv_io import share

    plain = spark.createDataFrame([(i, i % 4) for i in range(400)], "posting_id long, cluster int")
    held = spark.createDataFrame([(i, f"s{(i * j) % 7}") for i in range(400) for j in range(3)], "posting_id long, skill string")
    labels, skills = share(plain, "shared_labels", "posting_id"), share(held, "shared_skills", "posting_id")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(cluster_skill_labels(labels, skills)._jdf.queryExecution(), "simple")
        assert "SortMergeJoin [posting_id" in plan and "hashpartitioning(posting_id" not in plan
        got = cluster_skill_labels(labels, skills).collect()
        assert sorted(got) == sorted(cluster_skill_labels(plain, held).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        spark.sql("DROP TABLE shared_labels")
        spark.sql("DROP TABLE shared_skills")


def test_one_csv_file_is_read_in_many_ranges(spark, tmp_path):
    """Records over several lines, quotes, blank lines and carriage returns, cut into
    ranges of a few bytes, give what Spark's one-task reader gives."""
    import random

    rng, rows = random.Random(4), []
    for i in range(300):
        body = "".join(rng.choice(['a', 'b ', '""', '\n', ',', '\n\n', 'é']) for _ in range(rng.randint(0, 40)))
        rows.append(f'{i},"{body}",{rng.randint(1, 9)}.5' if i % 3 else f"{i},plain text {i},{i}.25")
    rows[7] = "x7,bad id,1.5"
    (tmp_path / "a.csv").write_text("posting_id,description,normalized_salary\n" + "\n".join(rows) + "\n\n")
    (tmp_path / "b.csv").write_text('normalized_salary,posting_id\r\n2.5,900\r\n3.5,901')
    bound = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        good, bad = read_postings_checked(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10
        got = {r.posting_id: (r.description, r.normalized_salary) for r in good.collect()}
        assert [r["_rejected_line"] for r in bad.collect()] == [rows[7]]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bound)
    plain = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                  .schema("posting_id string, description string, normalized_salary double").csv(str(tmp_path / "a.csv")).collect())
    want = {int(r.posting_id): (r.description, r.normalized_salary) for r in plain if r.posting_id != "x7"}
    assert got == want | {900: (None, 2.5), 901: (None, 3.5)}
