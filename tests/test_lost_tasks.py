"""A Python worker dies in the middle of a copy; Spark repeats its task."""

import json
import os
import subprocess
import sys

REPOSITORY = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import json, os, sys
sys.path.insert(0, sys.argv[1])
source, target, shared, marks = sys.argv[2:6]
from pyspark.sql import SparkSession
import treeferry as tf
from treeferry.operators import copying

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", shared).getOrCreate())
real = copying.copy_bytes

def dies_once(reader, writer, *args, **kwargs):
    mark = os.path.join(marks, os.path.basename(reader.name))
    count = real(reader, writer, *args, **kwargs)
    if reader.name.endswith(("7", "23")) and not os.path.exists(mark):
        open(mark, "w").close()
        os._exit(1)
    return count

copying.copy_bytes = dies_once
report = tf.copy_tree(spark, source, target, num_tasks=3, range_bytes=int(sys.argv[6]))
rows = report.groupBy("outcome").count().collect()
print("RESULT" + json.dumps({row["outcome"]: row["count"] for row in rows}))
spark.stop()
"""


def run(tmp_path, range_bytes):
    source, target, shared, marks = (tmp_path / name for name in ("data", "target", "shared", "marks"))
    for folder in (source, target, shared, marks):
        folder.mkdir()
    for i in range(30):
        (source / f"f{i}").write_bytes(os.urandom(5000))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPOSITORY, source, target, shared, marks, str(range_bytes)],
        cwd=tmp_path, capture_output=True, text=True, timeout=240,
    )
    lines = [line for line in done.stdout.splitlines() if line.startswith("RESULT")]
    assert lines, done.stderr[-3000:]
    assert len(os.listdir(marks)) == 4  # f7, f17, f27, f23
    return source, target / "data", json.loads(lines[0].removeprefix("RESULT"))


def check(source, copied, outcomes):
    # What a lost attempt had put in place already is copied again, as the plan says.
    assert outcomes == {"dir_created": 1, "copied": 30}
    assert sorted(os.listdir(copied)) == sorted(os.listdir(source))
    for name in os.listdir(source):
        assert (copied / name).read_bytes() == (source / name).read_bytes()


def test_whole_files(tmp_path):
    check(*run(tmp_path, 1 << 30))


def test_ranges(tmp_path):
    check(*run(tmp_path, 2000))
