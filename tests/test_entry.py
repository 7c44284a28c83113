"""The driver contract holds in a copy without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_corpus_operators(tmp_path, pipeline):
    for name in ("__spark_entry__.py", "viewloom", *(["corpus_pipeline.py"] if pipeline and os.path.exists(f"{TOP}/corpus_pipeline.py") else [])):
        copy = shutil.copytree if os.path.isdir(f"{TOP}/{name}") else shutil.copy
        copy(f"{TOP}/{name}", tmp_path / name)
    shutil.rmtree(tmp_path / "viewloom/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 80 and set(s) <= set(q) and 'pipeline' not in q; print('fine')"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.stdout.strip().endswith("fine"), said.stderr
