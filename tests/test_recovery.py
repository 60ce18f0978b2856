"""Lost tasks are recomputed: a bridge source whose every partition fails on
its first attempt (a simulated executor loss) still yields the exact report.

Runs in a subprocess because task retries need a ``local[N, maxFailures]``
master, and the test session's master is fixed for its lifetime.
"""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent('''
    import json, os, sys
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class FlakyBridge(DataSource):
        """Serves a parquet bridge; each partition fails on its first attempt."""
        @classmethod
        def name(cls):
            return "flaky_bridge"

        def schema(self):
            return "student_id bigint, questionnaire_id bigint"

        def reader(self, schema):
            return FlakyReader(self.options)

    class FlakyReader(DataSourceReader):
        def __init__(self, options):
            self.path, self.marker = options["path"], options["marker"]

        def partitions(self):
            return [InputPartition(i) for i in range(4)]

        def read(self, partition):
            import pyarrow.parquet as pq
            mark = os.path.join(self.marker, str(partition.value))
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("simulated executor loss")
            rows = pq.read_table(self.path).to_pylist()
            for r in rows[partition.value::4]:
                yield (r["student_id"], r["questionnaire_id"])

    spark = (SparkSession.builder.master("local[4,3]")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.dataSource.register(FlakyBridge)
    from reachlens.plans import ReachReport
    from reachlens.sources.bindings import FIXTURE_AS_OF, FIXTURE_SCOPE, bound_catalog
    from reachlens.sources.catalog import Catalog
    from reachlens.specs import table_schemas

    scratch, sf = sys.argv[1], sys.argv[2]
    bound = bound_catalog(spark, sf)
    bridge = "questionnaire_live_has_students"
    bound.table(bridge).coalesce(1).write.parquet(os.path.join(scratch, "bridge"))
    os.makedirs(os.path.join(scratch, "marks"))
    flaky = (spark.read.format("flaky_bridge").option("path", os.path.join(scratch, "bridge"))
             .option("marker", os.path.join(scratch, "marks")).load())
    frames = {{n: bound.table(n) for n in table_schemas()}}
    frames[bridge] = flaky
    col = "total_live_assignment"
    got = ReachReport(Catalog.from_frames(spark, frames), FIXTURE_AS_OF,
                      scope=FIXTURE_SCOPE).metric_frame(col).collect()
    want = ReachReport(bound, FIXTURE_AS_OF, scope=FIXTURE_SCOPE).metric_frame(col).collect()
    # the production run (three written tables) with a source failing again
    os.makedirs(os.path.join(scratch, "marks2"))
    frames[bridge] = (spark.read.format("flaky_bridge")
                      .option("path", os.path.join(scratch, "bridge"))
                      .option("marker", os.path.join(scratch, "marks2")).load())
    paths = ReachReport(Catalog.from_frames(spark, frames), FIXTURE_AS_OF,
                        scope=FIXTURE_SCOPE).run(os.path.join(scratch, "out"))
    stored_total = spark.read.parquet(paths["usage_data"]).where("is_total").collect()[0]
    print(json.dumps({{"got": sorted([r.college_id, r[col]] for r in got),
                      "want": sorted([r.college_id, r[col]] for r in want),
                      "failed_partitions": len(os.listdir(os.path.join(scratch, "marks"))),
                      "failed_in_run": len(os.listdir(os.path.join(scratch, "marks2"))),
                      "stored_total": stored_total.total}}))
''')


def test_report_survives_failed_tasks(scratch):
    script = os.path.join(scratch, "flaky_run.py")
    with open(script, "w") as fh:
        fh.write(SCRIPT.format(root=ROOT))
    proc = subprocess.run([sys.executable, script, scratch, "/root/testdata/sf0.001"],
                          capture_output=True, text=True, timeout=600)
    lines = [line for line in proc.stdout.splitlines() if line.startswith("{")]
    assert proc.returncode == 0 and lines, proc.stderr[-3000:]
    result = json.loads(lines[-1])
    assert result["failed_partitions"] == 4          # every partition failed once
    assert result["got"] == result["want"]
    assert sum(n for _, n in result["got"]) == 5     # FIXTURES.md §3, sf0.001
    assert result["failed_in_run"] == 4 and result["stored_total"] == 149
