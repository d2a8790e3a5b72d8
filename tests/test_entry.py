"""The entry point without the optional training-data part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_optional_part(tmp_path, pipeline):
    copy = tmp_path / "repo"
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", "*.json", "*.md")
    shutil.copytree(ROOT, copy, ignore=skipped)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    run = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120, check=True)
    number, *rest = run.stdout.split()[-4:]
    assert int(number) >= 75 and rest == ["False", "False", "True"]
