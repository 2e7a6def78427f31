"""Every module imports on its own, in a fresh interpreter (no import-order cycles)."""

import pathlib
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
MODULES = sorted(
    ".".join(p.relative_to(ROOT).with_suffix("").parts).removesuffix(".__init__")
    for p in (ROOT / "ledgerline").rglob("*.py")
) + ["__spark_entry__"]


@pytest.mark.parametrize("module", MODULES)
def test_module_imports_alone(module):
    code = f"import sys; sys.path.insert(0, {str(ROOT)!r}); import {module}"
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert res.returncode == 0, res.stderr[-2000:]
