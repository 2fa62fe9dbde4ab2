"""The daily-voted job in a process of its own, which has never asked for the
registered queries: the zip reader must ship its code to the workers itself."""

import os
import subprocess
import sys
import zipfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

JOB = """
from rollsnap.session import local_session
from rollsnap.plans import jobs
spark = local_session(cpus=2, shuffle_partitions=2)
print("APPENDED", jobs.run_daily_voted(spark, {root!r}, {out!r}, "or"))
print("LEFT", [f for f in __import__("os").listdir({shared!r}) if "-" in f and "zip" in f])
"""


def test_daily_voted_from_a_fresh_process(tmp_path):
    folder = tmp_path / "raw" / "2024_05_01"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "b.zip", "w") as z:
        z.writestr("x_Lane.txt", "VOTER_ID\tRECEIVE_DATE\n1\t04-20-2024\n2\t04-21-2024\n1\t04-20-2024\n")
        z.writestr("readme.txt", "no data")
    code = JOB.format(root=str(tmp_path / "raw"), out=str(tmp_path / "out"), shared=str(tmp_path / "shared"))
    (tmp_path / "shared").mkdir()
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir={tmp_path}/shared pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "APPENDED {'current': 2, 'history': 2, 'store': 2}" in run.stdout, run.stdout + run.stderr[-2000:]
    assert "LEFT []" in run.stdout, run.stdout
