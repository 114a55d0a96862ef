"""The entry works without the training-text subpackage and its pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()), 'pipeline' in e.queries())"


def _said(folder):
    return subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, check=True,
                          env=os.environ | {"PYTHONPATH": str(folder)}).stdout.split()


def test_entry_without_training_text(tmp_path):
    from fathom.plans import QUERIES
    keep = lambda d, names: [n for n in names if n in ("__pycache__", "llm")]
    shutil.copytree(f"{ROOT}/fathom", tmp_path / "fathom", ignore=keep)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    assert _said(tmp_path) == [str(len(QUERIES)), "True", "False"]
