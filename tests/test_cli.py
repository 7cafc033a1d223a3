"""The command-line jobs, run as a user would (their own process and JVM)."""
import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args, timeout=300):
    return subprocess.run([sys.executable, "-m", "tidepool", "--master", "local[2]", *args],
                          cwd=REPO, capture_output=True, text=True, timeout=timeout)


def test_ingest_once_then_history(spark, tmp):
    os.makedirs(f"{tmp}/in")
    with open(f"{tmp}/in/a.json", "w") as f:
        for i in range(3):
            f.write(json.dumps({"order_id": 2000 + i, "order_ts": f"2026-04-01 10:0{i}:00",
                                "product": "phone", "region": "EU", "amount": 10.0,
                                "quantity": 1}) + "\n")
        f.write("{not json\n")
    r = run("ingest", "--events", f"{tmp}/in", "--table", f"{tmp}/t", "--checkpoint", f"{tmp}/c",
            "--quarantine", f"{tmp}/q", "--once")
    assert r.returncode == 0, r.stderr[-2000:]
    from tidepool.streaming.ingest import read_ingested
    from tidepool.tables import snapshots as T
    assert read_ingested(spark, f"{tmp}/t").count() == 3
    assert read_ingested(spark, f"{tmp}/q").count() == 1
    assert "rejected: 1" in r.stdout
    T.write(spark.range(3), f"{tmp}/s")
    T.write(spark.range(3), f"{tmp}/s", "append")
    h = run("history", "--table", f"{tmp}/s")
    assert h.returncode == 0, h.stderr[-2000:]
    assert "APPEND" in h.stdout and "2 versions" in h.stdout
