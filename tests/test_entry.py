"""The entry point stands without the optional subpackage."""

import re
import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.modules["revtide.llm"] = None
import __spark_entry__ as e
from revtide.plans import QUERIES
assert e.llm is None and set(e.queries()) == set(QUERIES) == set(e.oracle_sql()), sorted(e.queries())
"""


def test_entry_without_the_subpackage():
    subprocess.run([sys.executable, "-c", CODE], check=True)


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[1]
    for path in [*root.glob("revtide/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.parts and path.name != "test_entry.py":
            assert not re.search(r"revtide\.llm|import llm|corpus_pipeline", path.read_text()), path
