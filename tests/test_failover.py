import os
import subprocess
import sys

from tests.conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_silver_write_survives_failed_task_attempts(tmp_path):
    env = dict(os.environ, FAILOVER_MARKERS=str(tmp_path))
    proc = subprocess.run(
        [sys.executable, os.path.join(HERE, "failover_job.py"), SF_SMALL],
        capture_output=True, text=True, timeout=600, env=env,
    )
    assert "FAILOVER_OK 6000 1816" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-3000:]
    failures = int(proc.stdout.split("FAILURES")[1].split()[0])
    assert failures >= 1  # attempts really failed and were retried
