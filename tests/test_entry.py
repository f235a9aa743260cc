"""The entry without the corpus part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
BLOCK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ImportError(name)
sys.meta_path.insert(0, Absent())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
names = e.queries()
assert "match_cascade" in names and not any(n.startswith("op") or n == "pipeline" for n in names), sorted(names)
assert set(e.oracle_sql()) <= set(names)
"""


@pytest.mark.parametrize("name", ["placeweave.llm", "corpus_pipeline", "regex"])
def test_entry_without(name):
    code = BLOCK.format(name=name, root=str(ROOT))
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, cwd="/tmp", text=True).returncode == 0, name


def test_nothing_else_imports_the_corpus_part():
    for path in (ROOT / "placeweave").rglob("*.py"):
        if "llm" not in path.parts:
            assert "placeweave.llm" not in path.read_text(), path


def test_the_rest_stands_without_the_corpus_part(tmp_path):
    """With the corpus folders and the pipeline deleted the entry imports and the other tests are collected."""
    home = tmp_path / "repo"
    shutil.copytree(ROOT, home, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".*_cache"))
    assert not (home / "placeweave/llm").exists() and not (home / "tests/llm").exists()
    code = f"import sys; sys.path.insert(0, {str(home)!r}); import __spark_entry__ as e; assert 'match_cascade' in e.queries() and not any(n.startswith('op') for n in e.queries()), sorted(e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=home).returncode == 0
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=home, capture_output=True, text=True)
    assert found.returncode == 0 and "error" not in found.stdout.lower(), found.stdout
