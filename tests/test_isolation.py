"""The engine without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_the_rest_imports_without_it(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'top_movers' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op') and n[2:3].isdigit()]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)


def test_nothing_else_imports_it():
    for path in (ROOT / "barline").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path
