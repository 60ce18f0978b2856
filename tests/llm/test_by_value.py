"""Functions of the operators travel by value: a process without the package runs them."""

import os
import subprocess
import sys
import textwrap

import pytest
from conftest import ROOT

SCRIPT = textwrap.dedent("""
    import os, sys, tempfile
    sys.path.insert(0, {root!r})
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession
    # the workers start in a folder without the package and with a clean path
    spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="by-value-"))

    def there(batches):
        import importlib.util
        import pyarrow as pa
        for _ in batches:
            yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("reachlens") is not None]}})
    assert not any(r.found for r in spark.range(4).mapInArrow(there, "found boolean").collect())
    for name in {names!r}:
        rows = entry.queries()[name](spark, "/root/testdata/sf0.001").count()
        print(name, rows)
""")


@pytest.mark.parametrize("names", [["op4_near_duplicates", "op5_substring", "op6_quality"],
                                   ["op1_html_text", "op2_warc", "op10_chat_format"],
                                   ["op11_token_files", "op12_manifest", "op13_repair"]])
def test_queries_run_where_the_package_is_not(tmp_path, names):
    script = tmp_path / "outside.py"
    script.write_text(SCRIPT.format(root=ROOT, names=names))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    proc = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=900,
                          cwd=tmp_path, env=env)
    assert proc.returncode == 0, proc.stderr[-3000:]
    assert [line.split()[0] for line in proc.stdout.splitlines() if line.startswith("op")] == names
