"""The command line runs the entry points end to end (own process)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args, cwd):
    env = dict(os.environ, PYTHONPATH=REPO)
    out = subprocess.run([sys.executable, "-m", "tickweave", *args], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_cli_ingest_status_validate_plan(spark, tmp_path):
    from tickweave.plans.registry import land_fixture_files
    from tickweave.session import scratch_path

    raw = land_fixture_files(spark, "/root/testdata/sf0.001")
    store, cat = scratch_path(spark, "cli-store"), scratch_path(spark, "cli-cat")
    out = run("ingest", "--raw", raw, "--store", store, "--catalog", cat, cwd=str(tmp_path))
    assert "errors 0" in out
    out = run("status", "--catalog", cat, "--store", store, "--raw", raw, cwd=str(tmp_path))
    assert "EURUSD" in out and "true" in out and "slots_processed" in out and "parquet_mb" in out
    out = run("validate", "--store", store, "--out", scratch_path(spark, "cli-report"), cwd=str(tmp_path))
    assert "no_data" in out  # USDCHF has no bars in the fixture
    out = run("plan", "--catalog", cat, "--as-of", "2024-01-31T00:00", "--max-hours", "12", cwd=str(tmp_path))
    assert "https://" in out
    out = run("compact", "--store", store, "--min-files", "1", cwd=str(tmp_path))
    assert "compacted" in out and "EURUSD" in out
