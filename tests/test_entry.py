"""The entry module where the training-data operators are not installed."""

import os
import shutil
import subprocess
import sys

import pytest

from isobar.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def listed(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True)
    return [line.split() for line in done.stdout.splitlines()]


@pytest.mark.parametrize("kept", [[], ["corpus_pipeline.py"]])
def test_the_rest_stands_alone(tmp_path, kept):
    shutil.copytree(f"{ROOT}/isobar", f"{tmp_path}/isobar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *kept]:
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    names, with_sql = listed(tmp_path)
    assert names == with_sql == sorted(QUERIES)


def test_a_missing_library_leaves_the_rest(tmp_path):
    shutil.copytree(f"{ROOT}/isobar", f"{tmp_path}/isobar", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    (tmp_path / "public_tokenizers.py").write_text("raise ModuleNotFoundError('public_tokenizers')")
    names, _ = listed(tmp_path)
    assert names == sorted(QUERIES)
