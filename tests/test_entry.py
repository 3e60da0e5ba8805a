import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_keys_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_training_data_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/hammerline", tmp_path / "hammerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'house_performance' in q and not any(k.startswith('op') for k in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=120).returncode == 0


def test_operators_work_without_the_pipeline(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    if not os.path.isdir(f"{root}/hammerline/llm"):
        return
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/hammerline", tmp_path / "hammerline", ignore=shutil.ignore_patterns("__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'op1_url_filter' in q and 'pipeline' not in q"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=120).returncode == 0
