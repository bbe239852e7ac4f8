"""The worst task under a hot key, measured from the event log (tools/skew_report.py).

Runs in a subprocess: it needs its own session with the event log switched on.
One key holds about a third of the rows; the routed plan must give identical
rows while no task reads more than a small multiple of an even share.
"""

import os
import re
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def worst_tasks(*args):
    out = subprocess.run([sys.executable, os.path.join(REPO, "tools", "skew_report.py"), *args],
                         capture_output=True, text=True, timeout=900, cwd=REPO).stdout
    assert "identical results=True" in out, out
    worst = [int(m.replace(",", "")) for m in re.findall(r"max records read by one task:\s+([\d,]+)", out)]
    assert len(worst) == 2, out
    return worst


@pytest.mark.parametrize("order", ["time", "random"])
def test_routing_bounds_the_worst_task(order):
    """Whether seq follows the date or not: days and the blocks of a day are windowed apart."""
    plain, routed = worst_tasks("--rows", "150000", "--hot-rows", "5000", "--block-rows", "2000", "--seq-order", order)
    assert plain > 45_000          # the whole hot key (~50k rows) in one task
    assert routed < plain / 4      # spread over blocks
