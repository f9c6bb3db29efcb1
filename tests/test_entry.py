"""Driver contract: entry() runs; every query has a callable; SQL keys are a subset."""

import shutil
import subprocess
import sys

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"antecedent", "consequent", "support", "confidence", "lift", "correlation"}
    assert 0 < df.count() <= 100


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)


def test_the_rest_works_without_the_corpus_folders(tmp_path):
    """A copy without hirescope/llm and tests/llm registers all other queries, with and
    without the pipeline's module."""
    keep = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache")
    shutil.copytree(E.ROOT, tmp_path / "copy", ignore=keep)
    say = "import __spark_entry__ as E; print(*sorted(E.queries())); E.oracle_sql(); import bench"
    want = sorted(k for k in E.queries() if not k.startswith("op") or not k[2].isdigit())
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", say], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
        assert out.stdout.split() == [k for k in want if k != "pipeline"]
        (tmp_path / "copy" / "corpus_pipeline.py").unlink(missing_ok=True)
