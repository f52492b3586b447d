"""Jobs survive failed tasks: Spark retries them from the lineage (or the
written tables) and the result is unchanged."""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_train_detect_survive_task_failures():
    proc = subprocess.run([sys.executable, os.path.join(HERE, "scripts", "task_retry.py")],
                          capture_output=True, text=True, timeout=600)
    line = [x for x in proc.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, proc.stderr[-2000:]
    res = json.loads(line[0][len("RESULT "):])
    assert res.pop("injected_failures") > 0
    assert res["clean"]["flagged"] == [50, 72]
    assert res["failing"] == res["clean"]
