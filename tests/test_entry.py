"""The entry module: the flagship query, names, and that the rest works without the training-data subpackage."""

import subprocess
import sys
import shutil
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 50


def test_import_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "strideway", tmp_path / "strideway", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'eps_pairs_2m' in q and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "strideway").rglob("*.py"):
        if "llm" not in p.parts:
            assert "strideway.llm" not in p.read_text(), p
