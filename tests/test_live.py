"""Live path: drops, replays, rejects, and agreement with the batch path."""

from __future__ import annotations

import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roastery import schemas
from roastery.operators import facts
from roastery.operators.metrics import marketing_performance
from roastery.plans import lakehouse
from roastery.plans.lakehouse import Layout, current, read_sales, read_served, run_pipeline
from roastery.storage import list_folder, snapshots
from roastery.streaming.live import process_sales, watch

SALES_HEAD = "sale_id,user_id,product_name,amount,timestamp\n"
SPEND_HEAD = "event_date,platform,cost\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("first")
    src = folder / "sources"
    src.mkdir()
    files = {
        "product_codes": "p_code,p_name,retail_price\nP1,Mug,$1\nP2,Hat,$2\n",
        "daily_ad_spend": SPEND_HEAD + "15/01/2026,fb,100\n15/01/2026,tiktok,50\n16/01/2026,fb,10\n",
        "raw_web_leads": "source,signup_date\norganic,20/01/2026\n",
        "sales_dump": SALES_HEAD + "1,u1,Mug,$10,2026-01-15 08:00:00\n2,u9,Hat,€10,2026-01-16 08:00:00\n",
        "website_interactions": "ts\n2026-01-14 00:00:00\n",
        "crm_users_export": "user_id,full_name,email,phone\nu1,Ann,a@x,1\nu2,Bob,b@x,2\n",
        "influencer_campaigns": 'inf_id,ref_code,metadata\ni1,r1,"{""handle"":""@B"",""reach"":5}"\n',
        "extra": "anything\n1\n",
    }
    for name, text in files.items():
        (src / f"{name}.csv").write_text(text, encoding="utf-8")
    run_pipeline(spark, str(src), Layout(str(folder / "lake")))
    return folder


@pytest.fixture
def store(first_run, tmp_path):
    """A lakehouse after its first batch run, and the sources of that."""
    for part in ("sources", "lake"):
        shutil.copytree(first_run / part, tmp_path / part)
    return Layout(str(tmp_path / "lake"))


def drop(incoming, name, text):
    os.makedirs(incoming, exist_ok=True)
    hidden = os.path.join(incoming, f".{name}")
    with open(hidden, "w", encoding="utf-8") as f:
        f.write(text)
    os.rename(hidden, os.path.join(incoming, name))


def drain(spark, incoming, layout, checkpoint):
    for query in watch(spark, incoming, layout, checkpoint, trigger={"availableNow": True}):
        query.awaitTermination()


def expected_performance(spark, layout):
    daily = marketing_performance(read_sales(spark, layout), read_served(spark, layout, "fact_ad_spend"))
    return rows(schemas.conform(daily, "fact_marketing_performance"))


def test_batch_run_and_rerun(spark, store, tmp_path):
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in rows(read_sales(spark, store))] == [
        ("1", 20260115, 1, 1, Decimal("10.00")),
        ("2", 20260116, 0, 2, Decimal("10.80")),
    ]
    before = {n: rows(read_served(spark, store, n)) for n in schemas.DIMENSIONS}
    performance = rows(read_served(spark, store, "fact_marketing_performance"))
    assert performance == expected_performance(spark, store)
    counts, reports = run_pipeline(
        spark,
        str(tmp_path / "sources"),
        store,
        export_options={"path": str(tmp_path / "export")},
        export_format="parquet",
        keep_rejects=True,
    )
    assert (counts["rejects_sales_dump"], counts["rejects_daily_ad_spend"]) == (0, 0)
    exported = spark.read.parquet(str(tmp_path / "export" / "fact_sales"))
    assert rows(exported) == rows(read_sales(spark, store))
    assert before == {n: rows(read_served(spark, store, n)) for n in schemas.DIMENSIONS}
    assert performance == rows(read_served(spark, store, "fact_marketing_performance"))
    assert counts["raw_extra"] == 1
    assert sum(r["orphan_rows"] for report in reports.values() for r in report.collect()) == 0


def test_drops_update_facts_and_metrics(spark, store, tmp_path):
    incoming, checkpoint = str(tmp_path / "incoming"), str(tmp_path / "checkpoint")
    drop(
        incoming,
        "sales_dump_1.csv",
        SALES_HEAD
        + '1,u2,Hat,$999,2026-01-15 09:00:00\n3, u2 ,"Mug",$5,2026-01-17 10:00:00\n'
        + "3,u2,Mug,$6,2026-01-17 11:00:00\n4,u1,Sofa,$7,someday\n,u1,Mug,$8,2026-01-17 10:00:00\n",
    )
    drop(incoming, "notes.csv", "free,text\n1,2\n")
    drop(incoming, "daily_ad_spend_1.csv", SPEND_HEAD + "15/01/2026,fb,1\n15/01/2026,fb,2.5\n17/01/2026,g_ads,9\n31/12/2030,fb,1\n")
    drain(spark, incoming, store, checkpoint)
    sales = {r["sale_id"]: (r["date_key"], r["user_key"], int(r["amount"])) for r in read_sales(spark, store).collect()}
    # Sale 1 was known, the later row of sale 3 counts, undated and unnamed sales are rejects.
    assert sales == {"1": (20260115, 1, 10), "2": (20260116, 0, 10), "3": (20260117, 2, 6)}
    rejected = spark.read.parquet(store.rejects("sales_dump"))
    assert rows(rejected.select("sale_id", "reason")) == sorted([("4", "bad_timestamp"), (None, "no_sale_id")], key=repr)
    spend = read_served(spark, store, "fact_ad_spend").join(read_served(spark, store, "dim_platform"), "platform_key")
    # google_ads was no platform of this lakehouse and 2030 no day of its calendar: both join their dimensions.
    assert rows(spend.select("date_key", "platform", "total_cost")) == [
        (20260115, "facebook", Decimal("3.50")),
        (20260115, "tiktok", Decimal("50.00")),
        (20260116, "facebook", Decimal("10.00")),
        (20260117, "google_ads", Decimal("9.00")),
        (20301231, "facebook", Decimal("1.00")),
    ]
    days, platforms = read_served(spark, store, "dim_date"), read_served(spark, store, "dim_platform")
    assert days.where("date_key = 20301231").count() == 1
    for name, count in (("date_key", days.count()), ("platform_key", platforms.count())):
        assert (days if name == "date_key" else platforms).select(name).distinct().count() == count
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)
    # A restart finds nothing new; a new file goes on where the checkpoint stands.
    taken = len(snapshots(spark, current(spark, store).serving("fact_ad_spend")))
    drain(spark, incoming, store, checkpoint)
    assert len(snapshots(spark, current(spark, store).serving("fact_ad_spend"))) == taken
    drop(incoming, "sales_dump_2.csv", SALES_HEAD + "5,u1,Mug,$1,2026-01-16 10:00:00\n")
    drain(spark, incoming, store, checkpoint)
    assert read_sales(spark, store).count() == 4
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


def test_replay_after_a_crash_between_append_and_refresh(spark, store, tmp_path, monkeypatch):
    batch = spark.createDataFrame(
        [("7", "u1", "Mug", "$4", "2026-01-16 10:00:00")], schemas.SOURCES["sales_dump"]
    ).select("*", F.lit("f.csv").alias("file_path"), F.current_timestamp().alias("file_time"))

    def crash(*_args, **_options):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("roastery.streaming.live.refresh_days", crash)
        with pytest.raises(RuntimeError):
            process_sales(batch, store, 5)
    assert read_sales(spark, store).where("sale_id = '7'").count() == 1
    assert process_sales(batch, store, 5) == 0
    assert read_sales(spark, store).where("sale_id = '7'").count() == 1
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


def test_columns_are_read_by_name(spark, store, tmp_path):
    """Reordered and further columns do no harm; a file that lacks a column is a reject and the stream goes on."""
    incoming, checkpoint = str(tmp_path / "incoming"), str(tmp_path / "checkpoint")
    drop(incoming, "daily_ad_spend_1.csv", "platform,event_date,cost\nfb,15/01/2026,5\n")
    drop(incoming, "daily_ad_spend_2.csv", "cost,note,platform,event_date\n7,hello,tiktok,15/01/2026\n")
    drop(incoming, "daily_ad_spend_3.csv", "platform,event_date\nfb,16/01/2026\n")
    drop(incoming, "daily_ad_spend_4.csv", "")
    drop(incoming, "sales_dump_1.csv", 'timestamp,amount,sale_id,product_name,user_id\n2026-01-15 09:00:00,$4,8,"Mu\ng",u1\n')
    drain(spark, incoming, store, checkpoint)
    spend = read_served(spark, store, "fact_ad_spend").join(read_served(spark, store, "dim_platform"), "platform_key")
    assert rows(spend.select("date_key", "platform", "total_cost")) == [
        (20260115, "facebook", Decimal("5.00")),
        (20260115, "tiktok", Decimal("7.00")),
        (20260116, "facebook", Decimal("10.00")),
    ]
    files = spark.read.parquet(store.rejects("files/daily_ad_spend"))
    assert [(r["file_path"].rsplit("/", 1)[1], r["reason"]) for r in files.collect()] == [("daily_ad_spend_3.csv", "missing_column:cost")]
    assert [r["product_key"] for r in read_sales(spark, store).where("sale_id = '8'").collect()] == [-1]
    drop(incoming, "daily_ad_spend_5.csv", SPEND_HEAD + "16/01/2026,fb,3\n")
    drain(spark, incoming, store, checkpoint)
    assert read_served(spark, store, "fact_ad_spend").where("date_key = 20260116").first()["total_cost"] == 3
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


STEPS = ["opened", "rejects", "members", "claimed", "appended", "measured", "refreshed", "closed"]


def sales_batch(spark, lines, file="f.csv"):
    frame = spark.createDataFrame([tuple(line.split(",")) for line in lines], schemas.SOURCES["sales_dump"])
    return frame.select("*", F.lit(file).alias("file_path"), F.lit("2026-01-20 00:00:00").cast("timestamp").alias("file_time"))


@pytest.mark.parametrize("step", [s if s in ("claimed", "appended") else pytest.param(s, marks=pytest.mark.slow) for s in STEPS])
def test_batch_that_dies_after_a_step_is_repeated(spark, store, step):
    def die(done):
        if done == step:
            raise RuntimeError(step)

    first = sales_batch(spark, ["7,u1,Mug,$4,2026-01-16 10:00:00", "1,u1,Mug,$9,2026-01-16 10:00:00", "8,u2,Hat,$5,2026-02-01 10:00:00"])
    with pytest.raises(RuntimeError):
        process_sales(first, store, 3, stream="s", after=die)
    process_sales(first, store, 3, stream="s")
    assert process_sales(sales_batch(spark, ["7,u1,Mug,$1,2026-01-16 10:00:00", "9,u1,Mug,$1,2026-01-16 10:00:00"]), store, 4, stream="s") == 1
    found = {r["sale_id"]: int(r["amount"]) for r in read_sales(spark, store).collect()}
    assert found == {"1": 10, "2": 10, "7": 4, "8": 5, "9": 1} and read_sales(spark, store).count() == 5
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)
    # The day of sale 8 is beyond the calendar of the batch run.
    assert read_served(spark, store, "dim_date").where("date_key = 20260201").count() == 1


def test_closed_batch_is_left_alone(spark, store):
    batch = sales_batch(spark, ["7,u1,Mug,$4,2026-01-16 10:00:00"])
    assert process_sales(batch, store, 0, stream="s") == 1
    other = sales_batch(spark, ["99,u1,Mug,$4,2026-01-16 10:00:00"])
    assert process_sales(other, store, 0, stream="s") == 1  # what the batch had returned
    assert read_sales(spark, store).where("sale_id = '99'").isEmpty()
    assert process_sales(other, store, 0, stream="another checkpoint") == 1


def test_plan_of_a_batch_reads_no_stored_sales(spark, store, monkeypatch):
    """Unseen ids come from the index and metrics from the batches' measures."""
    process_sales(sales_batch(spark, ["7,u1,Mug,$4,2026-01-16 10:00:00"]), store, 0, stream="s")
    for name in ("read_sales", "stored_sales"):
        def refuse(*_args, **_options):
            raise AssertionError("the stored sales were opened")

        for module in ("roastery.plans.lakehouse", "roastery.streaming.live"):
            monkeypatch.setattr(f"{module}.{name}", refuse, raising=False)
    assert process_sales(sales_batch(spark, ["8,u1,Mug,$4,2026-01-16 10:00:00", "7,u1,Mug,$4,2026-01-16 10:00:00"]), store, 1, stream="s") == 1
    monkeypatch.undo()
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


def test_measures_are_folded(spark, store, monkeypatch):
    monkeypatch.setattr("roastery.plans.lakehouse.OPEN_DELTAS", 3)
    for i in range(5):
        process_sales(sales_batch(spark, [f"x{i},u1,Mug,$4,2026-01-1{4 + i % 3} 10:00:00"]), store, i, stream="s")
    folder = current(spark, store).serving("_measures/deltas")
    assert len(list_folder(spark, folder)) < 4
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


def test_second_run_keeps_live_rows(spark, store, tmp_path):
    incoming, checkpoint = str(tmp_path / "incoming"), str(tmp_path / "checkpoint")
    drop(incoming, "sales_dump_1.csv", SALES_HEAD + "3,u3,Pan,$5,2026-03-17 10:00:00\n4,u2,Hat,$7,2026-01-15 10:00:00\n")
    drop(incoming, "daily_ad_spend_1.csv", SPEND_HEAD + "15/01/2026,fb,1\n18/03/2026,g_ads,9\n")
    drain(spark, incoming, store, checkpoint)
    before = current(spark, store)
    src = tmp_path / "sources"
    # Sale 4 is in the sources by now, with another amount; user 3 and the pan have come.
    (src / "sales_dump.csv").write_text(SALES_HEAD + "1,u1,Mug,$10,2026-01-15 08:00:00\n4,u2,Hat,$8,2026-01-15 10:00:00\n")
    (src / "crm_users_export.csv").write_text("phone,user_id,full_name,email\n1,u1,Ann,a@x\n2,u2,Bob,b@x\n3,u3,Cy,c@x\n")
    (src / "product_codes.csv").write_text("p_code,p_name,retail_price\nP1,Mug,$1\nP2,Hat,$2\nP3,Pan,$3\n")
    counts, _reports = run_pipeline(spark, str(src), store)
    assert (counts["live_sales"], counts["live_spend"], counts["fact_sales"]) == (1, 1, 3)
    sales = {r["sale_id"]: (r["date_key"], r["user_key"], r["product_key"], int(r["amount"])) for r in read_sales(spark, store).collect()}
    assert sales == {"1": (20260115, 1, 1, 10), "3": (20260317, 3, 3, 5), "4": (20260115, 2, 2, 8)}
    spend = read_served(spark, store, "fact_ad_spend").join(read_served(spark, store, "dim_platform"), "platform_key")
    # The sources' statement of 15 January counts, the live one of 18 March is kept.
    assert (20260318, "google_ads", Decimal("9.00")) in rows(spend.select("date_key", "platform", "total_cost"))
    assert (20260115, "facebook", Decimal("100.00")) in rows(spend.select("date_key", "platform", "total_cost"))
    days = read_served(spark, store, "dim_date")
    assert days.where("date_key in (20260317, 20260318)").count() == 2 and days.count() == days.distinct().count()
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)
    # Who opened the former generation still has it; the streams go on in the new one.
    assert read_sales(spark, before).count() == 4
    drop(incoming, "sales_dump_2.csv", SALES_HEAD + "3,u1,Mug,$1,2026-01-15 10:00:00\n5,u1,Mug,$1,2026-01-15 10:00:00\n")
    drain(spark, incoming, store, checkpoint)
    assert read_sales(spark, store).count() == 4
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)


@pytest.mark.parametrize("write", ["write_table", "write_snapshot", "publish"])
def test_run_that_dies_leaves_the_former_generation(spark, store, tmp_path, monkeypatch, write):
    before = {n: rows(read_served(spark, store, n)) for n in (*schemas.DIMENSIONS, *schemas.FACTS)}
    generation = current(spark, store).generation
    (tmp_path / "sources" / "sales_dump.csv").write_text(SALES_HEAD + "50,u1,Mug,$10,2026-01-15 08:00:00\n")

    def die(*_args, **_options):
        raise RuntimeError("lost")

    real = getattr(lakehouse, write)
    with monkeypatch.context() as broken:
        broken.setattr(lakehouse, write, lambda *a, **o: die() if "generation-" in str(a[1]) and generation not in str(a[1]) else real(*a, **o))
        with pytest.raises(RuntimeError):
            run_pipeline(spark, str(tmp_path / "sources"), store)
    assert current(spark, store).generation == generation
    assert before == {n: rows(read_served(spark, store, n)) for n in before}
    run_pipeline(spark, str(tmp_path / "sources"), store)
    assert [r["sale_id"] for r in read_sales(spark, store).collect()] == ["50"]


def test_replaced_generations_go_by_age(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    made = [lakehouse.new_generation(layout) for _ in range(3)]
    for fresh in made:
        (tmp_path / "lake" / "serving" / fresh.generation).mkdir(parents=True)
    lakehouse.publish(spark, made[0])
    lakehouse.publish(spark, made[1])
    assert [name for name, _ in lakehouse.published(spark, layout)] == [made[0].generation, made[1].generation]
    lakehouse.publish(spark, made[2], keep_hours=-1)
    assert [name for name, _ in lakehouse.published(spark, layout)] == [made[2].generation]
    assert sorted(p.name for p in (tmp_path / "lake" / "serving").iterdir() if p.is_dir()) == [made[2].generation]


def test_stream_of_pieces_equals_the_batch(spark, store, tmp_path):
    lines = [
        f"{i},u{i % 3},{'Mug' if i % 2 else 'Hat'},{'€' if i % 4 == 0 else '$'}{i}.5,2026-01-{14 + i % 5} 10:00:00"
        for i in range(100, 160)
    ]
    incoming, checkpoint = str(tmp_path / "incoming"), str(tmp_path / "checkpoint")
    for piece in range(3):
        drop(incoming, f"sales_dump_{piece}.csv", SALES_HEAD + "\n".join(lines[piece::3]) + "\n")
    drain(spark, incoming, store, checkpoint)
    whole = spark.createDataFrame([line.split(",") for line in lines], schemas.SOURCES["sales_dump"])
    batch = facts.with_product_fallback(
        facts.fact_sales(whole, read_served(spark, store, "dim_user"), read_served(spark, store, "dim_product"))
    )
    assert rows(read_sales(spark, store).where("length(sale_id) = 3")) == rows(batch)
    assert rows(read_served(spark, store, "fact_marketing_performance")) == expected_performance(spark, store)
