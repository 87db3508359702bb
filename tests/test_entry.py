"""The entry file registers everything, and works without the operators on training data."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
WITHOUT = """
import sys
sys.modules["ledgerlens.llm"] = None
import __spark_entry__ as e
assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())
assert not any(name.startswith("op") and name[2].isdigit() or name == "pipeline" for name in e.queries())
"""


def test_entry_without_the_package():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "ledgerlens")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in names:
            if name.endswith(".py"):
                assert "ledgerlens.llm" not in open(os.path.join(folder, name)).read()
