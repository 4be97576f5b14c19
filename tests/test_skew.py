"""Hot-key behaviour measured from Spark's event log (tools/skew_probe.py)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_key_is_combined_map_side(tmp):
    n = 300_000
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_probe.py"), str(n), tmp],
                         capture_output=True, text=True, timeout=600)
    res = json.loads(out.stdout.strip().splitlines()[-1])
    hot = res["hot_key_rows"]
    m = res["max_shuffle_records_per_task"]
    assert m["whole_window_control"] >= hot  # the control really concentrates the hot key
    for name in ["upsert_latest_by_key", "dedup_by_text", "top3_per_key_row_number", "count_by_key", "cost_rollup"]:
        assert m[name] < hot / 4, (name, m[name], hot)
