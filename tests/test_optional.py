"""The rest of the library without the training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from meterline.plans.catalog import QUERIES

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("kept", [["corpus_pipeline.py"], []])
def test_the_entry_loads_without_the_optional_part(tmp_path, kept):
    tree = tmp_path / "tree"
    hidden = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{TOP}/meterline", tree / "meterline", ignore=hidden)
    shutil.copytree(f"{TOP}/tests", tree / "tests", ignore=hidden)
    for name in ["__spark_entry__.py", "pytest.ini", *[k for k in kept if os.path.exists(f"{TOP}/{k}")]]:
        shutil.copy(f"{TOP}/{name}", tree)
    code = "import __spark_entry__ as e; print(','.join(sorted(e.queries())), set(e.queries()) == set(e.oracle_sql()))"
    run = lambda *args: subprocess.run([sys.executable, *args], cwd=tree, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert run("-c", code).stdout.split() == [",".join(sorted(QUERIES)), "True"]
    listed = run("-m", "pytest", "-q", "--collect-only", "tests")
    assert listed.returncode == 0, listed.stdout[-2000:]
