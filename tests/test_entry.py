"""The driver's entry point without the optional subpackage."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["lakeworks.llm", "xxhash", "numpy"])
def test_core_queries_stay_when_the_optional_package_cannot_be_imported(blocked):
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "class Block:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == sys.argv[2] or name.startswith(sys.argv[2] + '.'):\n"
            "            raise ImportError(name)\n"
            "sys.meta_path.insert(0, Block())\n"
            "import __spark_entry__ as e\n"
            "q, o = e.queries(), e.oracle_sql()\n"
            "print(len(q) > 100, any(k.startswith('op1_') for k in q), set(o) <= set(q))\n")
    out = subprocess.run([sys.executable, "-c", code, ROOT, blocked], capture_output=True, text=True, check=True).stdout.split()
    assert out == ["True", "False", "True"]
