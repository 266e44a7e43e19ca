"""The entry works with the operators for training text and without them."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("gone", [["corpus_pipeline.py"], ["clickloom/llm", "tests/llm"],
                                  ["clickloom/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_optional_parts(tmp_path, gone):
    place = tmp_path / "copy"
    kept = lambda folder, names: [n for n in names if n in (".git", "__pycache__")
                                  or str((Path(folder) / n).relative_to(ROOT)) in gone]
    shutil.copytree(ROOT, place, ignore=kept)
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=place, env={"PATH": "/usr/bin:/bin"},
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, sql = (line.split() for line in done.stdout.splitlines())
    assert "domain_minutes" in queries and set(sql) <= set(queries)
    assert "pipeline" not in queries
    assert any(name.startswith("op1_") for name in queries) == ("clickloom/llm" not in gone)
