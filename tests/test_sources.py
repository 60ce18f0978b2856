"""Sources and sinks: parquet catalog, JDBC catalog (embedded in-memory Derby,
no server), production run with date-partitioned, dynamically overwritten
tables."""

import os

from pyspark.sql import functions as F

from helpers import enrol, make_catalog, ts
from reachlens.plans import ReachReport
from reachlens.sources.bindings import FIXTURE_AS_OF, FIXTURE_SCOPE, bound_catalog
from reachlens.sources.catalog import Catalog
from reachlens.specs import table_schemas

SF = "/root/testdata/sf0.001"


def _summary_rows(rep):
    return sorted(tuple(r) for r in rep.summary_with_total().collect())


def test_parquet_catalog_round_trip(spark, scratch):
    bound = bound_catalog(spark, SF)
    for name in table_schemas():
        bound.table(name).write.parquet(os.path.join(scratch, name))
    stored = Catalog.from_parquet(spark, scratch)
    assert _summary_rows(ReachReport(stored, FIXTURE_AS_OF, scope=FIXTURE_SCOPE)) == \
        _summary_rows(ReachReport(bound, FIXTURE_AS_OF, scope=FIXTURE_SCOPE))


def test_jdbc_catalog_partitioned_read(spark):
    url = "jdbc:derby:memory:reachlens_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    cat = make_catalog(spark, {
        "college": [(9, "C9"), (21, "C21")],
        "student_college_details": [enrol(s, 9 if s % 2 else 21) for s in range(1, 41)],
        "questionnaire_live": [(e, ts("2024-01-15 01:00:00")) for e in range(5)],
        "questionnaire_live_has_students": [(s, e) for s in range(1, 41) for e in range(5)
                                            if (s + e) % 3 == 0],
    })
    names = ["college", "student_college_details", "questionnaire_live",
             "questionnaire_live_has_students"]
    for n in names:
        cat.table(n).write.jdbc(url, n.upper(), mode="overwrite", properties=props)
    jdbc = Catalog.from_jdbc(spark, url, props, tables={n: n.upper() for n in names},
                             partitioning={"questionnaire_live_has_students":
                                           ("STUDENT_ID", 1, 40, 4)})
    assert jdbc.table("questionnaire_live_has_students").rdd.getNumPartitions() == 4
    via_jdbc = Catalog.from_frames(spark, {**{n: cat.table(n) for n in table_schemas()},
                                           **{n: jdbc.table(n) for n in names}})
    col = "total_live_assignment"
    a = ReachReport(via_jdbc, "2024-01-15", scope=[9, 21]).metric_frame(col).collect()
    b = ReachReport(cat, "2024-01-15", scope=[9, 21]).metric_frame(col).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sum(r[col] for r in a) > 0
    # without partitioning a table of students is split where the database counts
    # equally many rows, and its NULLs are a slice
    auto = Catalog.from_jdbc(spark, url, props, tables={n: n.upper() for n in names})
    sizes = (auto.table("questionnaire_live_has_students").groupBy(F.spark_partition_id().alias("p"))
             .count().collect())
    assert len(sizes) >= 16 and max(r["count"] for r in sizes) <= 4
    assert sorted(map(tuple, auto.table("questionnaire_live_has_students").collect())) == \
        sorted(map(tuple, cat.table("questionnaire_live_has_students").collect()))
    # the bridge id-range filter reaches the database query
    pruned = ReachReport(via_jdbc, "2024-01-15", scope=[9, 21], prune_bridges=True)
    df = pruned.metric_frame(col)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, b))
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = [line for line in plan.splitlines()
            if "JDBCRelation(QUESTIONNAIRE_LIVE_HAS_STUDENTS)" in line]
    assert scan and "*GreaterThanOrEqual(questionnaire_id," in scan[0]


def test_jdbc_slices_of_a_skewed_column_with_nulls(spark):
    """Nearly all ids in a narrow range, a far outlier, a hot id and NULLs."""
    from reachlens.sources.jdbc import read_table
    url = "jdbc:derby:memory:reachlens_slices;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    ids = [*range(-500, 2500), *range(10**15, 10**15 + 40), *[77] * 300, *[None] * 250]
    rows = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "student_id bigint, event_id int")
    rows.coalesce(1).write.jdbc(url, "LINKS", mode="overwrite", properties=props)
    back = read_table(spark, url, "LINKS", props, split_on="student_id", slices=16).toDF("student_id", "event_id")
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, map(tuple, rows.collect())))
    sizes = {r.p: (r.n, r.nulls, r.ids) for r in back.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.count_if(F.col("student_id").isNull()).alias("nulls"),
        F.count_distinct("student_id").alias("ids")).collect()}
    nulls = [x for x in sizes.values() if x[1]]
    assert nulls == [(250, 250, 0)]  # a slice of their own, no row lost
    most = -(-3340 // 16)
    assert all(n <= most or ids == 1 for n, _, ids in sizes.values() if ids)
    assert 16 <= len(sizes) <= 34
    plain = read_table(spark, url, "LINKS", props)
    assert plain.rdd.getNumPartitions() == 1
    spark.createDataFrame([], "student_id bigint").write.jdbc(url, "NOTHING", mode="overwrite", properties=props)
    assert read_table(spark, url, "NOTHING", props, split_on="student_id").count() == 0


def test_run_writes_partitioned_tables_and_overwrites_per_date(spark, scratch):
    cat = bound_catalog(spark, SF)
    out = os.path.join(scratch, "report")
    ReachReport(cat, "2024-01-14", "2024-01-15", scope=FIXTURE_SCOPE).run(out)
    paths = ReachReport(cat, FIXTURE_AS_OF, scope=FIXTURE_SCOPE).run(out)
    usage = spark.read.parquet(paths["usage_data"])
    dates = sorted(r.report_date.isoformat() for r in
                   usage.select("report_date").distinct().collect())
    assert dates == ["2024-01-14", "2024-01-15"]
    day = usage.where(F.col("report_date") == F.lit(FIXTURE_AS_OF).cast("date"))
    assert day.count() == 24
    total = day.where("is_total").collect()[0]
    assert total.total == 149
    wide = spark.read.parquet(paths["individual_data"])
    assert wide.count() == 46
    diag = spark.read.parquet(paths["diagnostics"]).where(
        F.col("report_date") == F.lit(FIXTURE_AS_OF).cast("date")).collect()[0]
    assert diag.total_activities == 149 and diag.colleges_processed == 23
    # one file per date partition in every table
    for table in paths.values():
        for part in os.listdir(table):
            if part.startswith("report_date="):
                files = [f for f in os.listdir(os.path.join(table, part))
                         if f.endswith(".parquet")]
                assert len(files) == 1, (table, part, files)


def test_session_catalog_tables(spark):
    bound = bound_catalog(spark, SF)
    names = sorted(table_schemas())
    for name in names:
        bound.table(name).createOrReplaceTempView(name)
    try:
        via_tables = Catalog.from_tables(spark)
        assert via_tables.names() == names
        assert _summary_rows(ReachReport(via_tables, FIXTURE_AS_OF, scope=FIXTURE_SCOPE)) == \
            _summary_rows(ReachReport(bound, FIXTURE_AS_OF, scope=FIXTURE_SCOPE))
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def test_command_line_run(spark, scratch):
    from reachlens.__main__ import main
    scope = ",".join(str(i) for i in FIXTURE_SCOPE)
    paths = main(["--testdata", SF, "--date", "2024-01-14", "--end", "2024-01-15",
                  "--scope", scope, "--out", os.path.join(scratch, "cli")])
    usage = spark.read.parquet(paths["usage_data"])
    totals = {r.report_date.isoformat(): r.total for r in usage.where("is_total").collect()}
    assert totals["2024-01-15"] == 149 and set(totals) == {"2024-01-14", "2024-01-15"}
    assert spark.read.parquet(paths["individual_data"]).count() == 46


def test_stored_tables_equal_lazy_report(spark, scratch):
    cat = bound_catalog(spark, SF)
    report = ReachReport(cat, "2024-01-10", "2024-01-16", scope=FIXTURE_SCOPE)
    paths = report.run(os.path.join(scratch, "eq"))

    def rows(df, cols):
        return sorted(tuple(r[c] for c in cols) for r in df.collect())

    wide = report.combined()
    assert rows(spark.read.parquet(paths["individual_data"]), wide.columns) == \
        rows(wide, wide.columns)
    summary = report.summary_with_total()
    assert rows(report.stored_summary(paths), summary.columns) == \
        rows(summary, summary.columns)
    diag = report.diagnostics()
    assert rows(spark.read.parquet(paths["diagnostics"]), diag.columns) == \
        rows(diag, diag.columns)


def _day(cat, scope, date="2024-01-15", end=None):
    return ReachReport(cat, date, end, scope=scope)


def test_rerun_replaces_every_date_of_its_range(spark, scratch):
    t = ts("2024-01-15 01:00:00")
    tables = {"college": [(9, "C9")], "student_college_details": [enrol(1, 9), enrol(2, 9)],
              "questionnaire_live": [(1, t)], "questionnaire_live_has_students": [(1, 1), (2, 1)]}
    out = os.path.join(scratch, "again")

    def totals(rep, paths):
        return {r.report_date.isoformat(): r.total
                for r in rep.stored_summary(paths).where("is_total").collect()}

    rep = _day(make_catalog(spark, tables), [9], "2024-01-15", "2024-01-16")
    assert totals(rep, rep.run(out)) == {"2024-01-15": 2, "2024-01-16": 0}
    # the activity is gone: the stored day follows
    rep = _day(make_catalog(spark, {**tables, "questionnaire_live": []}), [9])
    assert totals(rep, rep.run(out)) == {"2024-01-15": 0}
    # a scope that exists nowhere replaces the day too, and leaves the next one
    rep = _day(make_catalog(spark, tables), [777])
    paths = rep.run(out)
    assert totals(rep, paths) == {"2024-01-15": 0} and rep.stored_wide(paths).collect() == []
    both = _day(make_catalog(spark, tables), [9], "2024-01-15", "2024-01-16")
    assert [r.report_date.isoformat() for r in both.stored_wide(paths).collect()] == ["2024-01-16"]


def test_quiet_day_and_empty_college_in_a_fresh_folder(spark, scratch):
    quiet = _day(make_catalog(spark, {"college": [(9, "C9")]}), [9])
    paths = quiet.run(os.path.join(scratch, "quiet"))
    assert [(r.college_id, r.total_attendance) for r in quiet.stored_wide(paths).collect()] == [(9, 0)]
    empty = _day(make_catalog(spark), [9])
    paths = empty.run(os.path.join(scratch, "empty"))
    assert empty.stored_wide(paths).collect() == []
    assert [r.total for r in empty.stored_summary(paths).collect()] == [0]
    row = empty.stored_period(paths).head()
    assert (row.colleges_processed, row.total_activities) == (0, 0)
    assert row.period_end_label == "15-Jan-2024 (08:00 AM)"


def test_command_line_reports_today_by_default(spark, scratch, capsys):
    import datetime as dt
    from reachlens.__main__ import main
    before = dt.date.today().isoformat()
    main(["--testdata", SF, "--scope", "1,2", "--out", os.path.join(scratch, "today")])
    after = dt.date.today().isoformat()
    rows = [line for line in capsys.readouterr().out.splitlines() if '"S.No"' in line]
    assert len(rows) == 1 and (before in rows[0] or after in rows[0])
