"""The entry holds up when packages or whole folders it offers queries from are missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {names!r} or name in {names!r}:
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
found = entry.queries()
assert set(entry.oracle_sql()) <= set(found)
print(len([n for n in found if not n.startswith("op") and n != "pipeline"]), len([n for n in found if n.startswith("op")]), "pipeline" in found)
"""


def _offered(*blocked: str) -> list[str]:
    script = SCRIPT.format(names=blocked)
    done = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("blocked", ["xxhash", "commerce_lake.llm", "numpy", "tokenizers"])
def test_a_missing_package_costs_no_other_query(blocked):
    core, operators, pipeline = _offered(blocked)
    assert int(core) >= 218 and (int(operators), pipeline) in {(0, "False"), *([(int(operators), "True")] if blocked == "tokenizers" else [])}


def test_a_missing_pipeline_costs_no_operator():
    core, operators, pipeline = _offered("corpus_pipeline")
    whole = _offered()
    assert core == whole[0] and operators == whole[1] and pipeline == "False"
