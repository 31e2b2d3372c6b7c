"""The entry in a copy of the repository without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CORE = "import __spark_entry__ as e; q = e.queries(); assert 'top_users' in q and set(e.oracle_sql()) <= set(q); print(sum(n.startswith('op') or n == 'pipeline' for n in q))"


def _count(folder) -> str:
    return subprocess.run([sys.executable, "-c", CORE], cwd=folder, env=os.environ | {"PYTHONPATH": str(folder)}, capture_output=True, text=True, check=True).stdout.strip()


def test_entry_without_training_data(tmp_path):
    left_out = shutil.ignore_patterns(".git", "__pycache__", "llm")
    shutil.copytree(ROOT, tmp_path / "with_pipeline", ignore=left_out)
    assert _count(tmp_path / "with_pipeline") == "0"
    shutil.copytree(tmp_path / "with_pipeline", tmp_path / "without", ignore=shutil.ignore_patterns("corpus_pipeline.py"))
    assert _count(tmp_path / "without") == "0"
