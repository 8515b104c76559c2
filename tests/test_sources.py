"""Landing files, contracts, layered tables, incremental ingest."""

import datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from stratalake.sources.contract import Contract, enforce, enforce_strict
from stratalake.sources.lake import Lake
from stratalake.sources.landing import list_files, file_inventory, scan_landing, sink_landing
from stratalake.sources.shared import checkpointed, new_folder, shared_root
from stratalake.streaming.ingest import IncrementalIngest

VISITS = Contract.of("id int!", "fk int", "status string!", "wait double!", "note string")


@pytest.fixture()
def folder(spark):
    return new_folder(spark, "test")


def test_contract_declares_the_schema(spark):
    schema = Contract.of("id int!", "day date", comments={"id": "Key"}).schema()
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [("id", "int", False), ("day", "date", True)]
    assert schema["id"].metadata == {"comment": "Key"}


def test_csv_keeps_awkward_text(spark, folder):
    given = [(1, 'comma, "quote"'), (2, "back\\slash"), (3, "é ñ ß"), (4, None), (5, "")]
    sink_landing(spark.createDataFrame(given, "id int, note string"), folder)
    back = {r.id: r.note for r in scan_landing(spark, folder, "id int, note string").collect()}
    assert back == {**dict(given), 5: None}  # an empty field is NULL


def test_csv_line_breaks_need_multiline(spark, folder):
    sink_landing(spark.createDataFrame([(1, "two\nlines")], "id int, note string"), folder)
    assert [r.note for r in scan_landing(spark, folder, "id int, note string", multiline=True).collect()] == ["two\nlines"]


def test_csv_corrupt_lines_are_kept(spark, folder):
    spark.createDataFrame([("id,wait",), ("1,5.5",), ("2,slow",)], "value string").coalesce(1).write.text(folder)
    got = scan_landing(spark, folder, "id int, wait double, _bad string", corrupt="_bad").cache()
    assert sorted((r.id, r.wait, r._bad) for r in got.collect()) == [(1, 5.5, None), (2, None, "2,slow")]


def test_csv_is_ordered_and_replaced(spark, folder):
    for n in (500, 300):
        sink_landing(spark.range(n).select((F.lit(n) - F.col("id")).alias("id")), folder, order_by="id")
    got = scan_landing(spark, folder, "id bigint")
    spans = got.groupBy(F.col("_metadata.file_name")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert got.count() == 300 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_csv_scan_is_pruned_and_filtered(spark, folder):
    sink_landing(spark.range(5).select("id", F.lit("F").alias("status"), F.lit("x").alias("note")), folder)
    plan = plan_of(scan_landing(spark, folder, "id bigint, status string, note string").where("status = 'F'").select("id"))
    assert "EqualTo(status,F)" in plan and "ReadSchema: struct<id:bigint,status:string>" in plan


def test_inventory_counts_every_row(spark, folder):
    sink_landing(spark.range(100).repartition(4), folder)
    files = file_inventory(scan_landing(spark, folder, "id bigint"))
    assert files.agg(F.sum("n_rows")).first()[0] == 100 and files.where("file_size <= 0").count() == 0


def test_enforce_splits_by_reason(spark):
    raw = spark.createDataFrame(
        [("1", "9", "ok", "2.5", None), ("x", None, "ok", "1", "n"), ("3", "z", None, "slow", "n"), (None, "1", "ok", "1", "")],
        VISITS.raw_schema())
    good, bad = enforce(raw, VISITS)
    assert good.schema.simpleString() == "struct<id:int,fk:int,status:string,wait:double,note:string>"
    assert [tuple(r) for r in good.collect()] == [(1, 9, "ok", 2.5, None)]
    assert {tuple(r._reasons) for r in bad.collect()} == {
        ("id is not int",), ("fk is not int", "status is null", "wait is not double"), ("id is null",)}
    assert bad.where("wait = 'slow'").count() == 1  # the row as it was given


def test_enforce_refuses_missing_columns(spark):
    with pytest.raises(ValueError):
        enforce(spark.range(1), VISITS)


def test_strict_contract_stops_the_job(spark):
    contract = Contract.of("id int!")
    assert enforce_strict(spark.createDataFrame([("7",)], "id string"), contract).collect()[0].id == 7
    with pytest.raises(Exception, match="id is null"):
        enforce_strict(spark.createDataFrame([(None,)], "id string"), contract).collect()


@pytest.fixture()
def lake(spark, folder):
    made = Lake(spark, folder, f"t{folder[-8:]}").setup()
    yield made
    made.drop()


def test_tables_are_replaced_and_described(spark, lake):
    contract = Contract.of("id bigint!", "v string", comments={"id": "Primary key"})
    for n in (5, 3):
        table = lake.sink_table(spark.range(n).withColumn("v", F.lit("a")), "bronze", "things", contract, comment="It's a table")
    assert table.count() == 3 and lake.setup().table("bronze", "things").count() == 3
    described = {r.col_name: (r.data_type, r.comment) for r in lake.describe("bronze", "things").collect()}
    assert described["id"] == ("bigint", "Primary key") and described["Comment"][0] == "It's a table"
    assert [r.tableName for r in lake.tables("bronze").collect()] == ["things"]
    assert lake.use("bronze").first().schema == lake.database("bronze") and spark.table("things").count() == 3
    spark.catalog.setCurrentDatabase("default")


def test_tables_refuse_bad_rows_and_unknown_layers(spark, lake):
    with pytest.raises(Exception, match="v is null"):
        lake.sink_table(spark.range(1).withColumn("v", F.lit(None).cast("string")), "bronze", "x", Contract.of("v string!"))
    with pytest.raises(ValueError):
        lake.table("copper", "x")


def test_bucketed_tables_join_without_a_shuffle(spark, lake):
    keys = spark.range(1000).withColumn("v", F.col("id") * 2)
    a = lake.sink_table(keys, "silver", "a", bucket_by=(8, "id"))
    b = lake.sink_table(keys.withColumnRenamed("v", "w"), "silver", "b", bucket_by=(8, "id"))
    joined = a.hint("merge").join(b, "id")
    assert "Exchange" not in plan_of(joined).split("(1)")[0] and joined.count() == 1000


def test_shared_folders(spark):
    assert new_folder(spark, "x").startswith(shared_root(spark)) and new_folder(spark, "x") != new_folder(spark, "x")
    kept = checkpointed(spark.range(10).where("id > 4"))
    assert kept.count() == 5 and "Filter" not in plan_of(kept)


EVENTS = Contract.of("id bigint!", "v double!")


def _ingest(spark, folder):
    return IncrementalIngest(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/checkpoint", EVENTS, files_per_batch=2)


def _deliver(spark, folder, lo, hi):
    v = F.when(F.col("id") % 20 == 0, F.lit("bad")).otherwise((F.col("id") / 2).cast("string"))
    sink_landing(spark.range(lo, hi, 1, 3).select("id", v.alias("v")), f"{folder}/landing", append=True)


def test_incremental_equals_batch(spark, folder):
    for lo, hi in ((0, 100), (100, 250), (250, 400)):
        _deliver(spark, folder, lo, hi)
        _ingest(spark, folder).run()  # a new object each time: what was taken is remembered in the checkpoint
    _ingest(spark, folder).run()
    done = _ingest(spark, folder)
    batch, refused = enforce(scan_landing(spark, f"{folder}/landing", EVENTS.raw_schema()), EVENTS)
    assert done.good().count() == 380 and done.good().drop("batch_id").exceptAll(batch).count() == 0
    assert done.quarantine().count() == refused.count() == 20
    assert {tuple(r._reasons) for r in done.quarantine().collect()} == {("v is not double",)}
    assert '"v":"bad"' in done.quarantine().first()._raw
    assert done.good().select("batch_id").distinct().count() > 3


def test_a_repeated_batch_leaves_the_same_rows(spark, folder):
    _deliver(spark, folder, 0, 60)
    ingest = _ingest(spark, folder)
    batch = list_files(spark, f"{folder}/landing").select(F.col("file_path").alias("file"))
    for _ in range(2):
        ingest._write_batch(batch, 5)
    assert ingest.good().count() == 57 and ingest.quarantine().count() == 3


def test_dates_and_numbers_convert_or_are_refused(spark):
    raw = spark.createDataFrame([("2024-02-30", "1"), ("2024-02-29", "99999999999")], "d string, n string")
    good, bad = enforce(raw, Contract.of("d date", "n bigint"))
    assert good.first().d == datetime.date(2024, 2, 29) and bad.first().d == "2024-02-30"


def test_lines_with_other_fields_are_quarantined(spark, folder):
    lines = ["id,v", "1,0.5", "2", "3,1.5,more", "4,", '5,"2.5"']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/landing")
    ingest = _ingest(spark, folder)
    ingest.run()
    assert sorted((r.id, r.v) for r in ingest.good().collect()) == [(1, 0.5), (5, 2.5)]
    refused = {r._raw: tuple(r._reasons) for r in ingest.quarantine().collect()}
    assert refused["3,1.5,more"] == ("line does not fit",) and refused["2"][0] == "line does not fit"
    assert refused['{"id":"4"}'] == ("v is null",)
    raw = scan_landing(spark, f"{folder}/landing", EVENTS.raw_schema("_line"), corrupt="_line")
    good, bad = enforce(raw, EVENTS, "_line")
    assert good.count() == 2 and bad.count() == 3 and bad.where("_line = '3,1.5,more'").count() == 1


def test_headers_decide_the_columns(spark):
    import os

    from stratalake.sources.contract import Contract, enforce
    from stratalake.sources.landing import list_files, scan_by_name, scan_landing
    from stratalake.sources.shared import new_folder

    contract = Contract.of("id bigint!", "status string!", "wait int!")
    folder = new_folder(spark, "headers")
    os.makedirs(folder)
    files = {"a": "id,status,wait\n1,ok,5\n", "b": "id,wait,status\n2,7,ok\n3,x,ok\n", "c": "id,status\n4,ok\n", "d": "id,status,wait,more\n5,ok,1,2\n", "e": "id,status,wait\n6,ok\n",
             "f": "id,status,wait\n"}
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    good, broken = enforce(scan_by_name(spark, folder, contract, "_line"), contract, "_line")
    assert sorted(map(tuple, good.collect())) == [(1, "ok", 5), (2, "ok", 7)]
    assert sorted(r._line or r.id for r in broken.collect()) == ["3", "4,ok", "5,ok,1,2", "6,ok"]
    import pytest

    with pytest.raises(Exception, match="(?i)header"):
        scan_landing(spark, f"{folder}/b.csv", contract.raw_schema()).collect()


def test_ingest_before_any_file(spark):
    from stratalake.sources.contract import Contract
    from stratalake.sources.shared import new_folder
    from stratalake.streaming.ingest import IncrementalIngest

    folder = new_folder(spark, "no-files")
    ingest = IncrementalIngest(spark, f"{folder}/in", f"{folder}/out", f"{folder}/check", Contract.of("id bigint!"))
    assert ingest.good().count() == 0 and ingest.quarantine().count() == 0 and ingest.good().columns == ["id", "batch_id"]
