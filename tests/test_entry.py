"""Driver contract: entry / queries / oracle_sql."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "cnt_historical_avg_raw" in df.columns and "split" in df.columns


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def test_queries_without_the_training_data_operators():
    """The registry holds none of them; the entry file alone adds them, where
    their subpackage is present."""
    from hourcast.registry import load_all
    from hourcast.registry.core import REGISTRY
    load_all()
    assert not [n for n in REGISTRY if n.startswith("op") or "pipeline" in n]
    added = set(E.queries()) - set(REGISTRY)
    assert added == (set(E._llm().QUERIES) if E._llm() else set())


def test_entry_imports_without_the_subpackage(tmp_path):
    """With the llm folder and corpus_pipeline.py deleted all else still loads."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(f"{root}/hourcast", tmp_path / "hourcast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    count, found = out.stdout.split()
    assert int(count) >= 100 and found == "False", out.stderr
