"""Queries run from a plain session in another working directory: the
package reaches the Python workers through addPyFile, not the cwd."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
qs = E.queries()
print("bars", E.entry(spark).count())
print("ticks", qs["load_ticks"](spark, "/root/testdata/sf0.001").count())
print("hash", qs["bar_hash"](spark, "/root/testdata/sf0.001").where("bar_hash IS NOT NULL").count())
spark.stop()
"""


def test_queries_from_plain_session_elsewhere(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO], cwd=str(tmp_path), env=env,
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.split()[0] in ("bars", "ticks", "hash"))
    assert int(lines["bars"]) > 0 and int(lines["ticks"]) == 1000 and int(lines["hash"]) == int(lines["bars"])


ANSI_OFF = r"""
import sys, importlib.util
sys.path.insert(0, sys.argv[1])
spec = importlib.util.spec_from_file_location("oc", sys.argv[1] + "/tools/oracle_check.py")
oc = importlib.util.module_from_spec(spec); spec.loader.exec_module(oc)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.ansi.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
qs, sq = E.queries(), E.oracle_sql()
sf = "/root/testdata/sf0.001"
con = oc.duck(sf)
for name in ["minute_bars", "merge_bars", "qa_report", "slot_outcome", "bar_hash"]:
    a = oc.normalise(qs[name](spark, sf).toPandas()); b = oc.normalise(con.execute(sq[name]).df())
    ok = len(a) == len(b) and list(a.columns) == list(b.columns) and bool((a == b).all(axis=None))
    print(name, "OK" if ok else "FAIL")
spark.stop()
"""


def test_queries_match_oracles_with_ansi_off(tmp_path):
    out = subprocess.run([sys.executable, "-c", ANSI_OFF, REPO], cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    results = [line.split() for line in out.stdout.splitlines() if line.endswith(("OK", "FAIL"))]
    assert len(results) == 5 and all(r[1] == "OK" for r in results), out.stdout
