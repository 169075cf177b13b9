"""Raw ingest, snapshots, upserts and export."""

from __future__ import annotations

import gzip
import shutil
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roastery import schemas, storage
from roastery.operators import upsert as up
from roastery.plans.lakehouse import Layout, export_served, read_latest_sales, read_sales, with_sales_partition
from roastery.sources import export, headers, raw
from roastery.storage import (
    materialize,
    path_exists,
    read_snapshot,
    scratch_path,
    scratch_root,
    scratch_scope,
    side_by_side,
    snapshots,
    write_snapshot,
    write_table,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ingest_keeps_text_as_it_is(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "plain.csv").write_text('id,note\n1," padded "\n2,"say ""hi"", you"\n3,\n', encoding="utf-8")
    (src / "broken.csv").write_text('id,note\n1,"two\nlines"\n2,€5\n', encoding="utf-8")
    (src / "readme.txt").write_text("no table")
    parts = src / "parts.csv"
    parts.mkdir()
    for i in (1, 2):
        (parts / f"p{i}.csv").write_text(f"id\n{i}\n")
    assert not raw.spans_lines(spark, str(src / "plain.csv"))
    assert raw.spans_lines(spark, str(src / "broken.csv"))
    counts = raw.ingest_raw(spark, str(src), str(tmp_path / "raw"))
    assert counts == {"plain": 3, "broken": 2, "parts": 2}
    plain = spark.read.parquet(str(tmp_path / "raw" / "plain"))
    assert rows(plain.select("id", "note")) == [("1", " padded "), ("2", 'say "hi", you'), ("3", None)]
    assert plain.where("ingestion_timestamp is null or not endswith(source_file_name, 'plain.csv')").isEmpty()
    broken = spark.read.parquet(str(tmp_path / "raw" / "broken"))
    assert rows(broken.select("id", "note")) == [("1", "two\nlines"), ("2", "€5")]
    # Another run replaces, it does not add.
    assert raw.ingest_raw(spark, str(src), str(tmp_path / "raw"), {"plain": True}) == counts


def test_line_check_agrees_with_the_two_readers(spark, tmp_path):
    """Whenever the check allows splitting, both readers give the same records."""
    samples = ['a,b\n1,x"y\n2,"z"\n', 'a,b\n1,"x\n2,y"\n', 'a,b\n"1","x,""q"""\n', "a,b\n1,\n,2\n"]
    for number, text in enumerate(samples):
        path = tmp_path / f"{number}.csv"
        path.write_text(text)
        if not raw.spans_lines(spark, str(path)):
            whole = raw.read_raw(spark, str(path), multi_line=True)
            assert rows(whole) == rows(raw.read_raw(spark, str(path), multi_line=False))


def _sales(spark, *values):
    return spark.createDataFrame(
        [(i, day, 1, 1, Decimal(amount)) for i, day, amount in values], schemas.STAR["fact_sales"]
    )


def test_upsert_modes_are_idempotent(spark):
    base = _sales(spark, ("a", 10, "1"), ("b", 10, "2"))
    updates = _sales(spark, ("b", 20, "9"), ("c", 20, "3"))
    merged = up.upsert(base, updates, ["sale_id"], "merge")
    assert [(r[0], r[1], int(r[4])) for r in rows(merged)] == [("a", 10, 1), ("b", 20, 9), ("c", 20, 3)]
    assert rows(up.upsert(merged, updates, ["sale_id"], "merge")) == rows(merged)
    added = up.upsert(base, updates, ["sale_id"], "insert_new")
    assert [(r[0], r[1], int(r[4])) for r in rows(added)] == [("a", 10, 1), ("b", 10, 2), ("c", 20, 3)]
    assert rows(up.upsert(added, updates, ["sale_id"], "insert_new")) == rows(added)
    assert rows(up.upsert(base, updates.limit(0), ["sale_id"])) == rows(base)
    with pytest.raises(ValueError):
        up.upsert(base, updates, ["sale_id"], "guess")


def test_rows_with_a_null_key_are_not_added_again(spark):
    base = _sales(spark, ("a", 10, "1"), (None, 10, "2"))
    updates = _sales(spark, (None, 20, "9"), ("c", 20, "3"))
    merged = up.upsert(base, updates, ["sale_id"], "merge")
    assert [(r[0], r[1]) for r in rows(merged)] == [("a", 10), ("c", 20), (None, 20)]
    added = up.upsert(base, updates, ["sale_id"], "insert_new")
    assert [(r[0], r[1]) for r in rows(added)] == [("a", 10), ("c", 20), (None, 10)]
    assert rows(up.upsert(added, updates, ["sale_id"], "insert_new")) == rows(added)


def test_last_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("b", 0, "z")], "k string, t int, v string")
    assert rows(up.last_by_key(df, ["k"], ["t"])) == [("a", 2, "c"), ("b", 0, "z")]


def test_append_new_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "sales")
    first, batch = _sales(spark, ("a", 20260101, "1")), _sales(spark, ("a", 20260102, "5"), ("b", 20260102, "2"))
    assert up.append_new(None, path, first, ["sale_id"], "date_key") == 1
    stored = lambda: spark.read.schema(first.schema).parquet(path)
    assert up.append_new(stored(), path, batch, ["sale_id"], "date_key") == 1
    assert up.append_new(stored(), path, batch, ["sale_id"], "date_key") == 0
    assert [(r["sale_id"], int(r["amount"])) for r in stored().orderBy("sale_id").collect()] == [("a", 1), ("b", 2)]


def test_replace_partitions_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "spend")

    def spend(*values):
        return spark.createDataFrame(list(values), "date_key int, platform_key int, cost int")

    keys = ["date_key", "platform_key"]
    up.replace_partitions(spark, path, spend((1, 1, 10), (1, 2, 20), (2, 1, 30)), keys, "date_key")
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "spend" / "date_key=2").iterdir()}
    update = spend((1, 2, 25), (3, 1, 40))
    for _ in range(2):
        up.replace_partitions(spark, path, update, keys, "date_key")
        found = spark.read.parquet(path).select("date_key", "platform_key", "cost")
        assert rows(found) == [(1, 1, 10), (1, 2, 25), (2, 1, 30), (3, 1, 40)]
    assert untouched == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "spend" / "date_key=2").iterdir()}
    with pytest.raises(ValueError):
        up.replace_partitions(spark, path, update, ["platform_key"], "date_key")


def test_snapshots_merge_and_skip_the_unfinished(spark, tmp_path):
    path = str(tmp_path / "daily")

    def daily(*values):
        return spark.createDataFrame(list(values), "day int, cost int")

    up.merge_snapshot(spark, path, daily((1, 10), (2, 20)), ["day"])
    for _ in range(7):
        assert up.merge_snapshot(spark, path, daily((2, 25), (3, 30)), ["day"]) == 3
    (tmp_path / "daily" / "snapshot-000000000099").mkdir()
    schema = daily((1, 1)).schema
    assert rows(read_snapshot(spark, path, schema)) == [(1, 10), (2, 25), (3, 30)]
    assert len(snapshots(spark, path)) > 5  # none goes by count
    assert write_snapshot(daily((9, 9)), path) == 1
    assert snapshots(spark, path)[-1] == "snapshot-000000000100"
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, str(tmp_path / "none"), schema)


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")


def test_scratch_scope_leaves_nothing_behind(spark):
    with scratch_scope(spark, "test"):
        kept = materialize(spark.range(3).toDF("n"), "inner")
        found = side_by_side(spark, {"a": lambda: scratch_path(spark, "x"), "b": kept.count})
        folder = found["a"].rsplit("/", 1)[0]
        assert found["b"] == 3
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)
    assert not scratch_path(spark, "y").startswith(folder)


def test_partitioned_write_counts_rows_and_takes_an_empty_frame(spark, tmp_path):
    sales = _sales(spark, ("a", 20260101, "1"), ("b", 20260102, "2"))
    assert write_table(sales, str(tmp_path / "t"), "date_key") == 2
    assert write_table(sales.limit(0), str(tmp_path / "e"), "date_key") == 0
    assert path_exists(spark, str(tmp_path / "e"))


def test_export_keeps_text_and_exact_money(spark, tmp_path):
    users = spark.createDataFrame([(1, "u1", "Ann", None, "0049")], schemas.STAR["dim_user"])
    sales = _sales(spark, ("007", 20260101, "1234567.89"))
    tables = {"dim_user": users, "fact_sales": sales}
    for fmt in ("parquet", "csv"):
        options = {"path": str(tmp_path / fmt)}
        assert export.export_tables(tables, options, fmt) == ["dim_user", "fact_sales"]
        for name, df in tables.items():
            assert rows(export.read_exported(spark, name, options, fmt)) == rows(df)
        checked = export.verify_export(spark, tables, options, fmt)
        assert [r["matches"] for r in checked.collect()] == [True, True]
    doubled = {"dim_user": users.union(users)}
    assert rows(export.key_violations(doubled)) == [("dim_user", 1)]


def test_jdbc_options_pass_the_connection_through():
    options = export.jdbc_options("dim_user", {"url": "jdbc:x", "schema": "mart", "batchsize": "500"}, 4, 1000)
    assert options["dbtable"] == "mart.dim_user"
    assert (options["url"], options["batchsize"], options["numPartitions"]) == ("jdbc:x", "500", "4")
    assert options["truncate"] == "true"


@pytest.mark.parametrize("partition", ["month_key", "date_key"])
def test_sales_of_touched_days_open_only_their_partitions(spark, tmp_path, partition):
    layout = Layout(str(tmp_path), sales_partition=partition)
    sales = _sales(spark, ("a", 20260101, "1"), ("b", 20260102, "2"), ("c", 20260201, "3"))
    path = layout.serving("fact_sales")
    write_table(with_sales_partition(sales), path, layout.sales_partition, "date_key")
    assert rows(read_sales(spark, layout)) == rows(sales)
    touched = read_sales(spark, layout, [20260102])
    assert [r["sale_id"] for r in touched.collect()] == ["b"]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert partition in filters


def test_readers_outlive_many_merges(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = spark.createDataFrame([(0,)], "v int")
    write_snapshot(frame, path)
    opened = read_snapshot(spark, path, frame.schema)
    opened.createOrReplaceTempView("opened_before")
    for i in range(1, 9):
        write_snapshot(spark.createDataFrame([(i,)], "v int"), path)
    assert opened.collect() == [(0,)] and spark.sql("select v from opened_before").collect() == [(0,)]
    assert read_snapshot(spark, path, frame.schema).collect() == [(8,)]


def test_replaced_snapshots_go_by_age(spark, tmp_path):
    path = str(tmp_path / "table")
    for i in range(4):
        write_snapshot(spark.createDataFrame([(i,)], "v int"), path, keep_hours=1)
    write_snapshot(spark.createDataFrame([(4,)], "v int"), path, keep_hours=-1)
    assert snapshots(spark, path) == ["snapshot-000000000005"]


@pytest.mark.parametrize("partition", ["month_key", "date_key"])
def test_latest_sales_open_the_newest_partitions(spark, tmp_path, partition):
    layout = Layout(str(tmp_path / partition), partition)
    days = [20250101 + i for i in range(28)] + [20250201, 20250202] + [20250301]
    sales = schemas.conform(
        spark.createDataFrame([(str(d), d, 1, 1, 1) for d in days], "sale_id string, date_key int, user_key int, product_key long, amount int"),
        "fact_sales",
    )
    write_table(with_sales_partition(sales), layout.serving("fact_sales"), partition, "date_key")

    def latest(n):
        found = read_latest_sales(spark, layout, n)
        top = [r["date_key"] for r in found.orderBy(F.desc("date_key")).limit(n).collect()]
        assert top == sorted(days, reverse=True)[:n]
        return found

    for n in (1, 2, 3, 4, 30, 31, 40):
        latest(n)
    plan = latest(3)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({partition}" in plan
    assert latest(3).count() < len(days)


def test_cost_of_a_merge_does_not_follow_their_number(spark, tmp_path, monkeypatch):
    """File-system calls of a merge after a few others and after ten thousand, of which a day's are kept."""
    calls = []
    real = storage.filesystem_of
    monkeypatch.setattr(storage, "filesystem_of", lambda s, path: calls.append(path) or real(s, path))
    frame = spark.createDataFrame([(0,)], "v int")

    def cost(path):
        calls.clear()
        up.merge_snapshot(spark, path, frame, ["v"])
        return len(calls)

    few, many = str(tmp_path / "few"), tmp_path / "many"
    for _ in range(3):
        up.merge_snapshot(spark, few, frame, ["v"])
    up.merge_snapshot(spark, str(many), frame, ["v"])
    now = time.time()
    for number in range(2, 10_001):
        hour = time.strftime("hour=%Y%m%d%H", time.gmtime(now - 10 * (10_001 - number)))
        folder = many / hour / f"snapshot-{number:012d}"
        folder.mkdir(parents=True)
        (folder / "_SUCCESS").touch()
    last = f"{hour}/snapshot-{10_000:012d}"
    shutil.copytree(next((tmp_path / "many").glob("hour=*/snapshot-000000000001")), many / last, dirs_exist_ok=True)
    storage.write_text(spark, str(many / storage.HEAD), last)
    cost(str(many))  # expires what is older than a day
    assert cost(str(many)) == cost(few)
    assert storage.head(spark, str(many))[0].endswith("snapshot-000000010002")
    assert read_snapshot(spark, str(many), frame.schema).collect() == [(0,)]


def test_expired_hours_go_as_a_whole(spark, tmp_path, monkeypatch):
    path, frame = str(tmp_path / "t"), spark.createDataFrame([(0,)], "v int")
    clock = [time.time()]
    monkeypatch.setattr(storage.time, "time", lambda: clock[0])
    for _ in range(8):
        write_snapshot(frame, path, keep_hours=2)
        clock[0] += 3600
    hours = sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir())
    assert 3 <= len(hours) <= 5 and storage.head(spark, path)[0].startswith(hours[-1])


def test_store_of_before_there_were_hours_goes_on(spark, tmp_path):
    path, frame = str(tmp_path / "t"), spark.createDataFrame([(5,)], "v int")
    write_table(frame, f"{path}/snapshot-000000000007")
    assert read_snapshot(spark, path, frame.schema).collect() == [(5,)]
    write_snapshot(frame.selectExpr("v + 1 as v"), path)
    assert snapshots(spark, path) == ["snapshot-000000000007", "snapshot-000000000008"]
    assert read_snapshot(spark, path, frame.schema).collect() == [(6,)]


def test_parts_of_a_table_are_read_by_name(spark, tmp_path):
    parts = tmp_path / "in" / "t.csv"
    parts.mkdir(parents=True)
    (parts / "p1.csv").write_text("a,b\n1,2\n")
    (parts / "p2.csv").write_text('b,c,a\n3,"x\ny",4\n')
    (parts / "p3.csv").write_text("")
    (parts / "p4 [x].csv").write_text('"b"\n5\n')
    assert raw.ingest_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw")) == {"t": 3}
    found = spark.read.parquet(str(tmp_path / "raw" / "t"))
    assert rows(found.select("a", "b", "c")) == [("1", "2", None), ("4", "3", "x\ny"), (None, "5", None)]
    assert found.where("ingestion_timestamp is null or source_file_name is null").isEmpty()
    assert [f.rsplit("/", 1)[1] for f in raw.files_spanning_lines(spark, str(parts))] == ["p2.csv"]
    named = raw.read_raw(spark, str(parts / "p2.csv"), schemas._text("a", "b"))
    assert rows(named) == [("4", "3")]
    with pytest.raises(ValueError, match="columns missing"):
        raw.read_raw(spark, str(parts), schemas._text("a", "b"))


def test_absent_tables_are_skipped_and_named(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    write_table(spark.createDataFrame([(1, "u1", "Ann", None, "0049")], schemas.STAR["dim_user"]), layout.serving("dim_user"))
    write_snapshot(spark.createDataFrame([], schemas.STAR["fact_ad_spend"]), layout.serving("fact_ad_spend"))
    options = {"path": str(tmp_path / "export")}
    written, skipped = export_served(spark, layout, options, "parquet")
    assert (written, "fact_sales" in skipped, len(skipped)) == (["dim_user", "fact_ad_spend"], True, 6)
    assert export.read_exported(spark, "dim_user", options, "parquet").count() == 1


def test_headers_need_no_more_than_the_start_of_a_file(spark, tmp_path):
    """A file cut short fails every read to its end."""
    whole = gzip.compress(b"id,a note\n" + b"".join(f"{i},{i * 7919 % 104729}\n".encode() for i in range(400_000)))
    path = tmp_path / "cut short.csv.gz"
    path.write_bytes(whole[: len(whole) // 2])
    (tmp_path / "empty.csv").write_text("")
    found = headers.read_headers(spark, str(tmp_path))
    assert [(f.rsplit("/", 1)[1], h) for f, h in found.items()] == [("cut%20short.csv.gz", ("id", "a note"))]
