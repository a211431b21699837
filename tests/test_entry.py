"""The library's own queries stay when the training-data subpackage cannot be imported."""

import os
import subprocess
import sys

import pytest

from conftest import ROOT
from lshark.plans import catalog

NAMES = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"


def names(code: str, root: str = ROOT) -> list[list[str]]:
    run = subprocess.run([sys.executable, "-c", code + NAMES], cwd=root, env=os.environ | {"PYTHONPATH": root},
                         capture_output=True, text=True, check=True)
    return [x.split() for x in run.stdout.split("|")]


@pytest.mark.parametrize("module", ["lshark.llm", "lshark.llm.queries", "regex", "public_tokenizers"])
def test_a_module_that_cannot_be_imported(module):
    queries, oracle = names(f"import sys; sys.modules[{module!r}] = None; ")
    assert set(catalog.queries()) <= set(queries) and set(catalog.oracle()) <= set(oracle)


def test_a_folder_that_was_left_behind(tmp_path):
    for name in ("__spark_entry__.py", "lshark"):
        (tmp_path / name).symlink_to(os.path.join(ROOT, name))
    (tmp_path / "lshark").unlink()
    (tmp_path / "lshark" / "llm" / "__pycache__").mkdir(parents=True)
    for name in os.listdir(os.path.join(ROOT, "lshark")):
        if name not in ("llm", "__pycache__"):
            (tmp_path / "lshark" / name).symlink_to(os.path.join(ROOT, "lshark", name))
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}]; sys.dont_write_bytecode = True; "
    # the entry module puts the folder of its own file first, here the scratch copy's target
    (tmp_path / "__spark_entry__.py").unlink()
    with open(os.path.join(ROOT, "__spark_entry__.py")) as f:
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    queries, oracle = names(code, str(tmp_path))
    assert set(queries) == set(catalog.queries()) and set(oracle) == set(catalog.oracle())
