import datetime as dt
import hashlib
import os

import pytest
from conftest import plan_of, rows_by_id
from pyspark.sql import functions as F

from cardwatch import session
from cardwatch.functions.numeric import file_stem
from cardwatch.operators.filters import between_days, trailing_days, with_lookback
from cardwatch.operators.ordering import add_chronological_id
from cardwatch.plans.jobs import convert_job, feature_job, label_job
from cardwatch.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from cardwatch.session import clear_scratch, scratch, scratch_path, stored, use_utc
from cardwatch.sources import readers, writers

DAY = 86400


def files(path):
    return sorted(
        os.path.relpath(os.path.join(root, f), path)
        for root, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    )


def test_csv_cells(spark, tmp_path):
    (tmp_path / "2024-01-01.txt").write_text(
        "# transaction_id,tx_datetime,...\n"
        "1,2024-01-01 10:00:00,5,6,7.5,36000,0,0,0\n"
        "2,bad,5,,7.5,36000,0,0,0\n"
        "# the end\n"
        "3,2024-01-01 24:00:00,x,6,7.5,36000,0,1,2\n"
    )
    rows = {r[0]: r for r in readers.scan_csv(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1]["tx_datetime"] == dt.datetime(2024, 1, 1, 10) and rows[1]["tx_amount"] == 7.5
    assert rows[2]["tx_datetime"] is None and rows[2]["terminal_id"] is None
    assert rows[3]["tx_datetime"] is None and rows[3]["customer_id"] is None
    assert rows[3]["tx_fraud_scenario"] == 2


def test_convert_names_outputs_by_stem(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    for day in (1, 2, 3):
        lines = [f"{day * 10 + i},2024-01-0{day} 10:00:00,5,6,7.5,0,0,0,0" for i in range(day)]
        (raw / f"2024-01-0{day}.txt").write_text("# comment\n" + "\n".join(lines) + "\n")
    convert_job(spark, str(raw), [str(out), str(tmp_path / "copy")])
    assert {f.split("/")[0] for f in files(out)} == {f"source_file=2024-01-0{d}" for d in (1, 2, 3)}
    stored = spark.read.schema(TRANSACTION_SCHEMA).parquet(str(out / "source_file=2024-01-03"))
    assert stored.count() == 3
    convert_job(spark, str(raw / "2024-01-01.txt"), [str(out)])
    assert spark.read.parquet(str(out)).count() == 6
    copy = writers.read_converted(spark, str(tmp_path / "copy"))
    assert copy.filter("source_file = '2024-01-02'").count() == 2 and copy.count() == 6


def test_format_switch(spark):
    with pytest.raises(ValueError, match="unknown source format"):
        readers.scan(spark, "/nowhere", "orc")


def test_paths():
    assert readers.split_paths("/a/*.parquet, /b/*.parquet,") == ["/a/*.parquet", "/b/*.parquet"]
    assert readers.split_paths(["/a"]) == ["/a"]


def test_day_folders_skip_missing_days(spark, make, tmp_path):
    for d in (0, 1, 3):
        name = (dt.date(2024, 1, 1) + dt.timedelta(days=d)).isoformat()
        writers.overwrite(make([{"s": d * DAY}]), f"{tmp_path}/{name}.parquet")
    got = readers.scan_day_folders(spark, str(tmp_path), "2024-01-02", "2024-01-09")
    assert sorted(r["tx_time_days"] for r in got.collect()) == [1, 3]


def test_rewriting_a_day_leaves_the_others(spark, make, tmp_path):
    path = str(tmp_path / "days")
    df = make([{"s": d * DAY + i * 700, "tx_amount": 1.0} for d in range(5) for i in range(9)])
    writers.write_days(df, path)
    before = files(path)
    again = between_days(df, "2024-01-02", "2024-01-02").withColumn("tx_amount", F.lit(2.0))
    writers.write_days(again, path)
    writers.write_days(again, path)
    after = files(path)
    kept = {f for f in before if "2024-01-02" not in f}
    assert kept < set(after) and len(after) == len(before)
    stored = spark.read.parquet(path)
    assert stored.count() == 45
    assert stored.filter("tx_amount = 2").select("tx_date").distinct().count() == 1


def test_large_days_may_use_several_tasks(make):
    dated = make([{}]).withColumn("tx_date", F.to_date("tx_datetime"))
    plan = plan_of(dated.hint("rebalance", F.col("tx_date")))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_two_targets_and_single_file(spark, make, tmp_path):
    df = make([{"s": i} for i in range(20)], 4)
    writers.overwrite_copies(df, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert spark.read.parquet(f"{tmp_path}/b").exceptAll(df).count() == 0
    writers.overwrite_single_file(df, f"{tmp_path}/c")
    assert len(files(f"{tmp_path}/c")) == 1


def test_merged_schema(spark, make, tmp_path):
    writers.overwrite(make([{}]), f"{tmp_path}/a")
    writers.overwrite(make([{}]).drop("tx_fraud"), f"{tmp_path}/b")
    both = readers.scan_parquet(spark, f"{tmp_path}/a,{tmp_path}/b", merge_schema=True)
    assert sorted(r["tx_fraud"] is None for r in both.collect()) == [False, True]


def test_time_bounds_prune_day_folders(spark, make, tmp_path):
    writers.write_days(make([{"s": d * DAY} for d in range(30)]), str(tmp_path))
    rows = with_lookback(spark.read.parquet(str(tmp_path)), "2024-01-20", "2024-01-20")
    assert rows.count() == 15
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(tx_date" in plan


def test_feature_job_replaces_its_days_everywhere(spark, make, tmp_path):
    source, outputs = str(tmp_path / "in"), [str(tmp_path / "a"), str(tmp_path / "b")]
    df = make([{"s": i * 7919 % (30 * DAY), "customer_id": i % 4} for i in range(200)])
    writers.write_days(df, source)
    feature_job(spark, source, outputs, "2024-01-15", "2024-01-17")
    feature_job(spark, source, outputs, "2024-01-17", "2024-01-18")
    expected = between_days(df, "2024-01-15", "2024-01-18").count()
    for path in outputs:
        stored = spark.read.parquet(path)
        assert stored.count() == expected
        assert stored.select("tx_date").distinct().count() == 4
        assert len(stored.columns) == 24


def test_label_job_by_lists(spark, make, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = make(
        [{"s": i * 7919 % (9 * DAY), "customer_id": i % 4, "terminal_id": i % 6} for i in range(200)]
    )
    writers.write_days(df, source)
    label_job(spark, source, [target], by_lists=True, seed=1)
    stored = spark.read.parquet(target)
    assert stored.count() == 200
    assert {r[0] for r in stored.select("tx_fraud_scenario").distinct().collect()} == {0, 2, 3}


def test_chronological_ids_are_gap_free(spark, make):
    df = make([{"s": i * 7919 % 1000, "customer_id": i} for i in range(500)], 6)
    got = add_chronological_id(df, ties=["customer_id"])
    rows = got.orderBy("transaction_id").collect()
    assert [r["transaction_id"] for r in rows] == list(range(500))
    keys = [(r["tx_datetime"], r["customer_id"]) for r in rows]
    assert keys == sorted(keys)
    assert got.columns == TRANSACTION_COLUMNS


def test_equal_times_do_not_stop_the_numbering(spark):
    df = spark.range(1000).selectExpr("id AS customer_id", "timestamp'2024-01-01' AS tx_datetime")
    got = add_chronological_id(df.repartition(5), ties=["customer_id"])
    assert got.filter("transaction_id <> customer_id").count() == 0


def test_trailing_days_use_the_latest_row(make):
    df = make([{"s": 0}, {"s": DAY - 1}, {"s": DAY}, {"s": 91 * DAY}])
    assert sorted(rows_by_id(trailing_days(df, 90), "tx_time_days")) == [2, 3]


def test_trailing_days_prune_day_folders(spark, make, tmp_path):
    df = make([{"s": d * DAY + 5} for d in range(100)])
    writers.write_days(df, str(tmp_path))
    got = trailing_days(spark.read.parquet(str(tmp_path)), 7)
    assert sorted(rows_by_id(got, "tx_time_days")) == list(range(92, 100))
    assert "PartitionFilters: [isnotnull(tx_date" in plan_of(got)


def test_file_stem(spark):
    names = ["/a/b/2024-01-01.txt", "x.tar.gz", "plain", ".hidden", "dir.d/name"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(file_stem(F.col("n"))).collect()]
    assert got == ["2024-01-01", "x.tar", "plain", ".hidden", "name"]


def digests(path):
    return {f: hashlib.sha256(open(os.path.join(path, f), "rb").read()).hexdigest() for f in files(path)}


@pytest.mark.parametrize("by_lists", [False, True])
def test_second_label_day_leaves_the_first_as_it_is(spark, make, tmp_path, by_lists):
    outputs = [str(tmp_path / "a"), str(tmp_path / "b")]
    for day in (0, 1):
        source = str(tmp_path / f"in{day}")
        writers.write_days(make([{"s": day * DAY + i * 60, "customer_id": i % 4} for i in range(50)]), source)
        label_job(spark, source, outputs, by_lists=by_lists)
        if day == 0:
            before = [digests(p) for p in outputs]
    for path, old in zip(outputs, before):
        new = digests(path)
        assert len(old) == 1 and len(new) == 2 and old.items() <= new.items()
        assert spark.read.parquet(path).count() == 100


def test_copies_hold_the_days_of_the_run_alone(spark, make, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    writers.write_days(make([{"s": d * DAY} for d in range(4)]), a)
    run = make([{"s": 2 * DAY + 5}, {"s": None}, {"s": 9 * DAY}])
    writers.write_day_copies(run, [a, b])
    days = {f.split("/")[0] for f in files(b)}
    assert days == {"tx_date=2024-01-03", "tx_date=2024-01-10", "tx_date=__HIVE_DEFAULT_PARTITION__"}
    assert spark.read.parquet(a).count() == 6 and spark.read.parquet(b).count() == 3


def test_convert_keeps_true_names_and_refuses_clashes(spark, tmp_path):
    raw, out, copy = tmp_path / "raw", tmp_path / "out", tmp_path / "copy"
    raw.mkdir()
    names = ["a b", "50% off", "x+y", "a%20b", "é=1", "v1.2"]
    for i, name in enumerate(names):
        (raw / f"{name}.txt").write_text(f"{i},2024-01-01 10:00:00,5,6,7.5,0,0,0,0\n")
    convert_job(spark, str(raw), [str(out), str(copy)])
    for path in (out, copy):
        got = writers.read_converted(spark, str(path)).select("transaction_id", "source_file").collect()
        assert {r[0]: r[1] for r in got} == dict(enumerate(names))
    (raw / "x+y.csv").write_text("9,2024-01-01 10:00:00,5,6,7.5,0,0,0,0\n")
    with pytest.raises(ValueError, match=r"2 input files are named 'x\+y'"):
        convert_job(spark, str(raw), [str(tmp_path / "new")])
    assert not (tmp_path / "new").exists()


def test_feature_job_reads_day_folders(spark, make, tmp_path):
    df = make([{"s": i * 7919 % (30 * DAY), "customer_id": i % 4} for i in range(300)])
    whole, root, a, b = (str(tmp_path / n) for n in ("in", "root", "a", "b"))
    writers.write_days(df, whole)
    for d in range(30):
        day = (dt.date(2024, 1, 1) + dt.timedelta(days=d)).isoformat()
        if d != 12:  # a missing day
            writers.overwrite(between_days(df, day, day), f"{root}/{day}.parquet")
    kept = spark.read.parquet(whole).filter("tx_date <> '2024-01-13'")
    writers.write_days(kept.drop("tx_date"), f"{tmp_path}/less")
    feature_job(spark, f"{tmp_path}/less", [a], "2024-01-20", "2024-01-21")
    feature_job(spark, root, [b], "2024-01-20", "2024-01-21", day_folders=True)
    one, two = spark.read.parquet(a), spark.read.parquet(b)
    assert one.count() > 0 and one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    files_read = readers.scan_day_folders(spark, root, "2024-01-06", "2024-01-21").inputFiles()
    assert len({os.path.dirname(f) for f in files_read}) == 15


def tree(path):
    return [os.path.join(root, f) for root, _, names in os.walk(path) for f in names]


def test_jobs_leave_no_scratch_behind(spark, make, tmp_path, monkeypatch):
    shared = str(tmp_path / "shared")
    monkeypatch.setattr(session, "_shared_folder", lambda spark: shared)
    monkeypatch.setattr(session, "_MADE", {})
    source, outputs = str(tmp_path / "in"), [str(tmp_path / "a"), str(tmp_path / "b")]
    writers.write_days(make([{"s": i * 7919 % (9 * DAY), "customer_id": i % 4} for i in range(90)]), source)
    label_job(spark, source, outputs, by_lists=True)
    feature_job(spark, outputs[0], [str(tmp_path / "c")], "2024-01-05", "2024-01-06")
    assert tree(shared) == []
    with pytest.raises(RuntimeError, match="in the middle"):
        with scratch(spark) as folder:
            stored(make([{}]), "half")
            assert tree(folder)
            raise RuntimeError("in the middle")
    assert tree(shared) == []
    kept = stored(make([{}]), "kept")
    with scratch(spark):
        assert stored(kept, "inner").count() == 1
    assert kept.count() == 1 and tree(shared)
    clear_scratch(spark)
    assert tree(shared) == []


def test_another_zone_is_told(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    with pytest.warns(UserWarning, match="Europe/Paris"):
        use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if shared:
        assert path.startswith(shared.rstrip("/"))
