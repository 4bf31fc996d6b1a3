"""The queries where workers cannot import the package: started in another folder, the repository only on the driver's path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as contract
from medlake.session import build_session
spark = build_session("anywhere", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
    spark__driver__memory="4g", spark__sql__warehouse__dir="warehouse", spark__checkpoint__dir="checkpoints")
def missing(batches):
    import importlib.util
    assert importlib.util.find_spec("medlake") is None
    yield from batches
spark.range(1).mapInArrow(missing, "id long").collect()
names = [n for n in contract.queries() if n.startswith("op") or n == "pipeline"]
for name in names:
    print(name, contract.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
print("ALL", len(names))
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    assert "ALL 14" in done.stdout, done.stdout[-2000:] + done.stderr[-4000:]


def test_entry_without_a_library_keeps_the_other_queries(tmp_path):
    script = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules['tiktoken'] = None; import __spark_entry__ as c; print(len(c.queries()), 'pipeline' in c.queries())"
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert int(done.stdout.split()[0]) > 90 and done.stdout.split()[1] == "False"
