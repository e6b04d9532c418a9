"""The driver's entry points from another folder, with no package on the workers' path."""

import os
import subprocess
import sys

import pytest

REPOSITORY = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_DIR = "/root/testdata/sf0.001"

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("driver", sys.argv[1] + "/__spark_entry__.py")
driver = importlib.util.module_from_spec(spec)
spec.loader.exec_module(driver)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.sql.ansi.enabled", "false")
         .config("spark.checkpoint.dir", "file:" + sys.argv[3] + "/not/there/yet").getOrCreate())
print("ROWS", driver.queries()["copy_report"](spark, sys.argv[2]).where("outcome = 'failed'").count())
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the supplied tables")
def test_from_another_folder(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPOSITORY, SF_DIR, str(tmp_path)],
        cwd=tmp_path, capture_output=True, text=True, timeout=240,
    )
    assert "ROWS 0" in done.stdout, done.stderr[-3000:]
    written = os.listdir(tmp_path / "not" / "there" / "yet")
    assert any(name.startswith("treeferry-copy-stage-") for name in written)
