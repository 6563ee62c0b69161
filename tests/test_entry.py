"""The entry module with and without the optional training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_imports_without_the_optional_folders(tmp_path, with_pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(HERE, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if with_pipeline else ["corpus_pipeline.py"])))
    assert not (copy / "lodestone" / "llm").exists()
    out = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 30 and out[1:] == ["True", "False"]
