"""A worker that goes on to the next stage gives back what the one before took."""

import subprocess
import sys

from tests.conftest import ROOT

CODE = """
from textloom.llm.common import lean
rss = lambda: int(next(l for l in open("/proc/self/status") if l.startswith("VmRSS")).split()[1])
kept = []
def run(batches):
    for b in batches:
        held = [bytes(1000 + i % 500) for i in range(200_000)]
        kept.append(held[-1])  # above the freed ones
        del held
        yield b
before = rss()
assert list(lean(run)([1, 2, 3])) == [1, 2, 3]
assert rss() - before < 60_000, (before, rss())
"""


def test_memory_goes_back(tmp_path):
    got = subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, capture_output=True, text=True, timeout=60)
    assert got.returncode == 0, got.stderr
