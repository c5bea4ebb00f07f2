"""The entry module with and without the subpackage of training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"


@pytest.mark.parametrize("pipeline", [False, True])
def test_imports_without_the_subpackage(tmp_path, pipeline):
    from quadrangle.plans import ORACLES, QUERIES

    shutil.copytree(ROOT / "quadrangle", tmp_path / "quadrangle", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    ran = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "0"]
