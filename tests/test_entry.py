"""The entry module stands without the optional operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

_BLOCKED = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len([n for n in entry.queries() if not n.startswith("op")]), len(entry.queries()), "pipeline" in entry.queries())
print(set(entry.oracle_sql()) <= set(entry.queries()))
"""


def loaded_without(*names):
    out = subprocess.run([sys.executable, "-c", _BLOCKED.format(names=names)], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("missing", ["stratum.llm", "public_tokenizers"])
def test_core_queries_need_nothing_else(missing):
    core, every, pipeline, covered = loaded_without(missing)
    assert int(core) == int(every) >= 77 and (pipeline, covered) == ("False", "True")


def test_operators_need_no_pipeline():
    _, _, pipeline, covered = loaded_without("corpus_pipeline")
    assert (pipeline, covered) == ("False", "True")
