import datetime as dt

from pyspark.sql import functions as F

from tabforge.operators import report, runlog
from tabforge.sources import history


def test_classification_report_by_hand(spark):
    rows = [(1, 1), (1, 1), (1, 0), (0, 0), (0, 1), (0, 0)]
    df = spark.createDataFrame(rows, "y int, yhat int")
    m = {r["metric"]: r["value"] for r in report.classification_report(df, "y", "yhat").collect()}
    assert abs(m["1_precision"] - 2 / 3) < 1e-12 and abs(m["0_recall"] - 2 / 3) < 1e-12
    assert m["1_support"] == 3 and m["weighted-avg_support"] == 6
    assert abs(m["macro-avg_f1-score"] - 2 / 3) < 1e-12


def test_duration_half_even_and_last_writer(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("r", "a", 1, "Completed", t0, 32.7), ("r", "a", 2, "Completed", t0, 0.3),
            ("r", "b", 3, "Failed", t0, 1.0)]
    df = runlog.with_end_time(spark.createDataFrame(
        rows, "run_id string, job string, seq long, status string, start_ts timestamp, metric double"))
    d = {r["seq"]: r["d"] for r in df.select("seq", runlog.duration_minutes(F.col("start_ts"), F.col("end_ts"))
                                             .alias("d")).collect()}
    assert d[1] == 0.54 and d[2] == 0.0  # 0.545 -> 0.54, 0.005 -> 0.00 (half-even)
    merged = {r["key"]: r for r in runlog.merge_last_writer(runlog.job_rows(df, metrics=["metric"])).collect()}
    assert "JOB_b.duration" not in merged  # failed jobs are skipped
    assert merged["metric"]["num_value"] == 32.7  # seq 1 ends later than seq 2


def test_compaction_groups_headers_and_is_idempotent(spark, tmp_path):
    folder = str(tmp_path / "runinfo")
    import os
    os.makedirs(folder)
    with open(f"{folder}/r1.csv", "w") as f:
        f.write("runId,a,b\nr1,1,x\n")
    with open(f"{folder}/r2.csv", "w") as f:
        f.write("b,runId,c\ny,r2,2.5\n")
    out = history.compact_history(spark, folder).orderBy("runId").collect()
    assert [(r["runId"], r["a"], r["b"], r["c"]) for r in out] == [("r1", 1, "x", None), ("r2", None, "y", 2.5)]
    again = history.compact_history(spark, folder)  # nothing new: same rows
    assert again.count() == 2


def test_stream_compaction_rerun_adds_nothing(spark, tmp_path):
    import os
    from tabforge.streaming.compact_stream import compact_history_stream
    folder = str(tmp_path / "deltas")
    os.makedirs(folder)
    for i in range(3):
        with open(f"{folder}/r{i}.csv", "w") as f:
            f.write("runId,m\n" if i % 2 else "m,runId\n")
            f.write(f"r{i},{i}\n" if i % 2 else f"{i},r{i}\n")
    ck = str(tmp_path / "ck")
    hist = str(tmp_path / "hist")
    first = compact_history_stream(spark, folder, ck, hist)
    assert sorted((r["runId"], r["m"]) for r in first.collect()) == [("r0", "0"), ("r1", "1"), ("r2", "2")]
    again = compact_history_stream(spark, folder, ck, hist)  # same checkpoint: nothing new
    assert again.count() == 3
    with open(f"{folder}/r9.csv", "w") as f:
        f.write("runId,m\nr9,9\n")
    assert compact_history_stream(spark, folder, ck, hist).count() == 4


def test_many_deltas_grouped_by_header_on_executors(spark, tmp_path):
    import os
    folder = str(tmp_path / "many")
    os.makedirs(folder)
    for i in range(30):
        with open(f"{folder}/r{i}.csv", "w") as f:
            f.write("runId,a\n" if i % 2 else "a,runId\n")
            f.write(f"r{i},{i}\n" if i % 2 else f"{i},r{i}\n")
    files = history.list_deltas(spark, folder)
    heads = history.file_headers(spark, files)
    assert len(heads) == 30 and set(heads.values()) == {"runId,a", "a,runId"}
    rows = history.read_deltas(spark, files).collect()
    assert len(rows) == 30 and all(r["runId"] == f"r{r['a']}" for r in rows)
