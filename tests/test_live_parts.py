"""Live sales as parts by batch: merged in tiers, replaced under open readers, repeated without harm."""

from __future__ import annotations

from decimal import Decimal

import pytest

from roastery import schemas
from roastery.plans import lakehouse
from roastery.plans.lakehouse import Layout, append_live, live_parts, merge_parts, read_latest_sales, read_sales, with_origin, with_sales_partition
from roastery.storage import write_table


def sales(spark, *ids, day=20260101):
    rows = spark.createDataFrame([(i, day, 1, 1, Decimal("1.00"), None, None) for i in ids], schema_of())
    return with_origin(rows, schemas.LIVE)


def schema_of():
    fields = schemas.STORED_SALES
    return type(fields)([f for f in fields.fields if f.name not in ("month_key", "origin")])


def ids(df):
    return sorted(r["sale_id"] for r in df.collect())


@pytest.mark.parametrize("partition", ["month_key", "date_key"])
def test_parts_stay_few_and_no_sale_is_lost(spark, tmp_path, monkeypatch, partition):
    monkeypatch.setattr(lakehouse, "FAN_IN", 3)
    layout = Layout(str(tmp_path), partition)
    base = sales(spark, "base", day=20251230).drop("origin")
    write_table(with_sales_partition(schemas.conform(base, "fact_sales")), layout.serving("fact_sales"), partition, "date_key")
    opened = None
    for n in range(30):
        claim = f"s-{n:012d}"
        assert append_live(spark, layout, sales(spark, f"{n}", day=20260101 + n % 5), claim) == 1
        assert append_live(spark, layout, sales(spark, f"{n}", day=20260101 + n % 5), claim) == 0  # repeated
        assert len(merge_parts(spark, layout, claim)) <= 9
        if n == 10:
            opened = read_sales(spark, layout)
    assert ids(read_sales(spark, layout)) == sorted(["base", *map(str, range(30))])
    assert ids(opened) == sorted(["base", *map(str, range(11))])  # its parts have been replaced since
    assert ids(read_sales(spark, layout, [20260103])) == sorted(str(n) for n in range(30) if n % 5 == 2)
    assert read_latest_sales(spark, layout, 2).count() >= 2
    plan = read_sales(spark, layout, [20260103])._jdf.queryExecution().executedPlan().toString()
    assert all(partition in scan.split("PartitionFilters: [")[1].split("]")[0] for scan in plan.split("FileScan parquet")[1:])
    merge_parts(spark, layout, f"s-{30:012d}", keep_hours=-1)
    merged = live_parts(spark, layout)
    assert len(list((tmp_path / "serving" / "_live_sales").glob("part=*"))) == len(merged)
    assert ids(read_sales(spark, layout)) == sorted(["base", *map(str, range(30))])


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lakehouse, "FAN_IN", 2)
    layout = Layout(str(tmp_path))
    for n in range(3):
        append_live(spark, layout, sales(spark, f"{n}"), f"s-{n:012d}")

    def die(*_args, **_options):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(lakehouse, "write_text", die)
        with pytest.raises(RuntimeError):
            merge_parts(spark, layout, f"s-{2:012d}")
    assert ids(read_sales(spark, layout)) == ["0", "1", "2"]
    # A batch of another stream may be repeated, and is no part of the merge.
    append_live(spark, layout, sales(spark, "x"), f"t-{0:012d}")
    assert f"b-t-{0:012d}" in merge_parts(spark, layout, f"s-{3:012d}")
    assert ids(read_sales(spark, layout)) == ["0", "1", "2", "x"]


def test_a_batch_has_one_file_a_month(spark, tmp_path):
    layout = Layout(str(tmp_path))
    months = [202601 + m for m in range(6)]
    rows = [(f"{m}-{d}", m * 100 + d, 1, 1, Decimal("1.00"), None, None) for m in months for d in range(1, 29)]
    batch = with_origin(spark.createDataFrame(rows, schema_of()), schemas.LIVE)
    assert append_live(spark, layout, batch, f"s-{0:012d}") == len(rows)
    files = list((tmp_path / "serving" / "_live_sales").glob("part=*/month_key=*/*.parquet"))
    assert sorted(f.parent.name for f in files) == [f"month_key={m}" for m in months]
    assert ids(read_sales(spark, layout)) == sorted(r[0] for r in rows)
