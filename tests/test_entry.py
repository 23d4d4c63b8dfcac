"""The entry module on a copy of the repository without the corpus operators."""
from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q), len(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [["assayframe/llm"], ["assayframe/llm", "corpus_pipeline.py"]])
def test_library_queries_stay(tmp_path, gone):
    leave = shutil.ignore_patterns(".git", "tests", "__pycache__", "*.json", "*.txt", "*.md", *[Path(g).name for g in gone])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=leave)
    found = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    queries, corpus, sql = map(int, found.stdout.split())
    assert queries >= 160 and corpus == 0 and sql == queries
