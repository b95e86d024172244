import importlib.util
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
BASE = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("name", BASE)
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, SF).collect() is not None


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 200


def test_without_the_llm_folder(tmp_path):
    """What is left works when the subpackage and the pipeline are gone."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("__spark_entry__.py", "grainloom"):
        os.symlink(os.path.join(root, name), tmp_path / name) if name.endswith(".py") else None
    (tmp_path / "grainloom").mkdir()
    for name in os.listdir(os.path.join(root, "grainloom")):
        if name not in ("llm", "__pycache__"):
            os.symlink(os.path.join(root, "grainloom", name), tmp_path / "grainloom" / name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(os.path.join(root, "__spark_entry__.py")).read())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env=env)
    assert done.returncode == 0, done.stderr
    assert importlib.util.find_spec("grainloom") is not None
