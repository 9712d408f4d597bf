"""The entry file with and without the optional folder."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

HIDE = """
import importlib.abc, sys

class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in HIDDEN or any(name.startswith(h + ".") for h in HIDDEN):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

HIDDEN = %r
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
from checks.queries import registered
found = entry.queries().keys() - registered().keys()
assert entry.oracle_sql().keys() <= entry.queries().keys()
print(len(found))
"""


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("hidden", [["floorline.llm"], ["floorline.llm", "corpus_pipeline"]])
def test_core_queries_are_left_without_the_folder(hidden):
    done = run(HIDE % (hidden,))
    assert done.returncode == 0, done.stderr
    assert done.stdout.split()[-1] == "0"


def test_other_missing_modules_are_errors():
    done = run(HIDE % (["floorline.operators.median"],))
    assert done.returncode and "floorline.operators.median" in done.stderr
