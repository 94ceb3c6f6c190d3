"""The library and its other tests work without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [("tidelog/llm", "tests/llm"), ("tidelog/llm", "tests/llm", "corpus_pipeline.py")])
def test_without_the_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        else:
            path.unlink(missing_ok=True)
    run = lambda *words: subprocess.run([sys.executable, *words], cwd=copy, capture_output=True, text=True, timeout=300)
    told = run("-c", "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(x.startswith('op1') for x in q); assert set(e.oracle_sql()) <= set(q); print('works')")
    assert told.stdout.strip() == "works", told.stderr
    told = run("-m", "pytest", "tests", "-q", "--collect-only", "--deselect", "tests/test_isolation.py")
    assert told.returncode == 0, told.stdout + told.stderr
    told = run("-m", "pytest", "tests/test_planning.py", "-q", "-x", "-k", "breaker or event_parser or state_rules")
    assert told.returncode == 0, told.stdout + told.stderr
