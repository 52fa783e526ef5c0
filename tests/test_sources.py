import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sources import ingest, listing
from millrace.sources.ingest import ingest_since, read_loaded
from millrace.sources.load_log import Watermark
from millrace.sources.registry import (
    PURCHASING_KEYS,
    PURCHASING_PARTITIONS,
    SALES_KEYS,
    SALES_PARTITIONS,
    TableSpec,
    purchasing_spec,
    sales_spec,
    schema_of,
    with_types,
)
from millrace.sources.scans import (
    scan_dimension,
    scan_json,
    scan_or_empty,
    text_schema,
    with_source_file,
)
from millrace.sources.workspace import new_path, shared_dir
from millrace.sources.writers import (
    export_by_recipient,
    recipient_rows,
    recipient_slug,
    write_manifest,
    write_table,
)
from millrace.streaming import ingest as stream_ingest
from millrace.streaming.ingest import ingest_incremental

SCHEMA = text_schema(["a", "b"])


def put(folder, name, text, at=None):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if at is not None:
        os.utime(path, (at.timestamp(), at.timestamp()))
    return path


def test_json_values_stay_text(spark, tmp_path):
    put(tmp_path, "x.json", '{"a": 007.10, "b": "t"}\n{"a": 1.50, "b": 2}\n')
    got = scan_json(spark, str(tmp_path), SCHEMA, primitives_as_string=True).filter("b = '2'").first()
    assert (got["a"], got["b"]) == ("1.50", "2")


def test_multiline_json(spark, tmp_path):
    put(tmp_path, "x.json", '[\n {"a": "1",\n  "b": "2"},\n {"a": "3", "b": "4"}]')
    assert scan_json(spark, str(tmp_path), SCHEMA, multiline=True).count() == 2


def test_quarantine_keeps_the_load_going(spark, tmp_path):
    put(tmp_path, "good.json", '{"a": "1", "b": "2"}\n')
    put(tmp_path, "bad.json", '{"a": "3", "b": "4"}\n{"a": "5", "b"\n')
    good, bad = scan_json(spark, str(tmp_path), SCHEMA, quarantine=True)
    assert sorted(r["a"] for r in good.collect()) == ["1", "3"]
    (broken,) = bad.collect()
    assert broken["source_file"].endswith("bad.json") and broken["_corrupt_record"] == '{"a": "5", "b"'


def test_marks_are_strict(spark, tmp_path):
    mark = datetime(2024, 3, 1, 12, 0, 0, 500_000)
    put(tmp_path, "old.json", '{"a": "old"}', mark - timedelta(seconds=1))
    put(tmp_path, "same.json", '{"a": "same"}', mark)
    put(tmp_path, "new.json", '{"a": "new"}', mark + timedelta(milliseconds=200))
    got = scan_json(spark, str(tmp_path), SCHEMA, modified_after=mark)
    assert [r["a"] for r in got.collect()] == ["new"]


def test_listing_sees_empty_and_nested_files(spark, tmp_path):
    now = datetime.now()
    put(tmp_path, "empty.json", "", now)
    put(tmp_path, "t/2024/empty_old.json", "", now - timedelta(days=30))
    put(tmp_path, "t/full.json", "{}", now)
    assert listing.list_files(spark, str(tmp_path)).count() == 3
    recent = listing.zero_byte_files(spark, str(tmp_path), as_of=date.today())
    assert [r["name"] for r in recent.collect()] == ["empty.json"]
    assert listing.zero_byte_files(spark, f"file:{tmp_path}", within_days=None).count() == 2
    assert listing.new_files(spark, str(tmp_path), now - timedelta(days=2)).count() == 2


@pytest.mark.parametrize("per_task", [1, 7, 1000])
def test_listing_spreads_uneven_trees(spark, tmp_path, per_task):
    want = set()
    for i in range(60):  # one folder at the top, many below it
        want.add(str(put(tmp_path, f"top/d{i} x/f%20.json", "x" * i)))
    chain = tmp_path
    for i in range(12):
        chain = chain / f"c{i}"
    want.add(str(put(chain, "deep.json", "")))
    (tmp_path / "empty").mkdir()
    got = listing.list_files(spark, f"file://{tmp_path}", per_task).collect()
    assert {r["path"] for r in got} == {f"file://{p}" for p in want} and len(got) == len(want)
    assert {(r["name"], r["size"], r["modified"]) for r in got} == {
        (os.path.basename(p), os.path.getsize(p), datetime.fromtimestamp(os.stat(p).st_mtime_ns // 1000 / 1e6)) for p in want
    }


def test_recent_files_keeps_the_newest(spark, tmp_path):
    for i in range(4):
        put(tmp_path, f"v{i}/team.csv", "x", datetime(2024, 1, 1 + i))
    files = listing.list_files(spark, str(tmp_path))
    assert sorted(r["path"][-11:-9] for r in listing.recent_files(files, ["name"], 2).collect()) == ["v2", "v3"]


def test_scan_or_empty_reports_other_failures(spark, tmp_path):
    assert scan_or_empty(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    put(tmp_path, "t/x.parquet", "not parquet")
    with pytest.raises(Exception):
        scan_or_empty(spark, str(tmp_path / "t"), SCHEMA).count()


def test_dimension_from_csv(spark, tmp_path):
    put(tmp_path, "d.csv", "code,name,rest\n1,north,x\n")
    assert tuple(scan_dimension(spark, str(tmp_path / "d.csv"), ["code", "name"], upper=True).first()) == ("1", "NORTH")


def test_source_file(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    got = with_source_file(spark.read.parquet(str(tmp_path / "t"))).select("source_file").first()
    assert "part-" in got["source_file"]


def test_watermark_never_moves_back(spark, tmp_path):
    marks = Watermark(spark, str(tmp_path / "log"), datetime(2024, 1, 1))
    assert marks.get("t") == datetime(2024, 1, 1)
    marks.advance("t", datetime(2024, 5, 1, 1, 2, 3, 456_000))
    marks.advance("t", datetime(2024, 4, 1))
    assert marks.get("t") == datetime(2024, 5, 1, 1, 2, 3, 456_000)
    assert marks.get("other") == datetime(2024, 1, 1)


def test_batch_ingest_twice_adds_nothing(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "out")
    marks = Watermark(spark, str(tmp_path / "log"), datetime(2024, 1, 1))
    put(landing, "d1/a.json", '{"a": "1", "b": "x"}\n', datetime(2024, 2, 1, 6))
    put(landing, "b.json", '{"a": "2", "b": "y"}\n', datetime(2023, 2, 1, 6))

    def run():
        return ingest_since(spark, "t", str(landing), bronze, SCHEMA, marks, rename={"b": "client"})

    run()
    run()
    got = read_loaded(spark, "t", bronze, marks)
    assert [(r["a"], r["client"], r["YEAR"], r["MONTH"]) for r in got.collect()] == [("1", "x", 2024, 2)]
    put(landing, "c.json", '{"a": "3", "b": "z"}\n', datetime(2024, 2, 1, 7))
    assert run() == datetime(2024, 2, 1, 7)
    assert sorted(r["a"] for r in read_loaded(spark, "t", bronze, marks).collect()) == ["1", "3"]


def test_batch_ingest_takes_late_and_repeated_files(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "out")
    marks = Watermark(spark, str(tmp_path / "log"), datetime(2024, 1, 1))
    newest = datetime(2024, 2, 1, 6)
    for name, value, at in (("a", "1", newest), ("same [x]", "2", newest), ("older", "3", datetime(2024, 1, 15)), ("a", "4", datetime(2024, 1, 20))):
        put(landing, f"{name}.json", f'{{"a": "{value}", "b": "x"}}\n', at)
        for _ in range(2):
            assert ingest_since(spark, "t", str(landing), bronze, SCHEMA, marks) == newest
    assert sorted(r["a"] for r in read_loaded(spark, "t", bronze, marks).collect()) == ["1", "2", "3", "4"]


def test_a_load_that_died_is_not_seen_and_its_files_come_again(spark, tmp_path, monkeypatch):
    landing, bronze = tmp_path / "in", str(tmp_path / "out")
    marks = Watermark(spark, str(tmp_path / "log"), datetime(2024, 1, 1))
    for i in range(7):
        put(landing, f"f{i}.json", f'{{"a": "{i}", "b": "x"}}\n', datetime(2024, 2, 1, i))

    def run(**more):
        return ingest_since(spark, "t", str(landing), bronze, SCHEMA, marks, files_per_read=2, **more)

    for dies in (2, 4):  # in the middle of the rows, then between the rows and the log
        writes = []

        def write(*args, dies=dies, writes=writes, **kwargs):
            writes.append(1)
            if len(writes) == dies:
                raise RuntimeError("lost")
            write_table(*args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(ingest, "write_table", write)
            m.setattr(Watermark, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                run()
        assert writes
    assert marks.get("t") == datetime(2024, 1, 1)
    assert run() == run() == datetime(2024, 2, 1, 6)
    assert sorted(r["a"] for r in read_loaded(spark, "t", bronze, marks).collect()) == list("0123456")
    assert spark.read.parquet(bronze).count() > 7  # what the dead loads wrote is there, and not seen


def test_a_lease_keeps_a_second_loader_out(spark, tmp_path):
    marks = Watermark(spark, str(tmp_path / "log"), datetime(2024, 1, 1))
    put(tmp_path / "in", "f.json", '{"a": "1", "b": "x"}\n', datetime(2024, 2, 1))
    put(tmp_path, "log_leases/t", "another loader")

    def run(**more):
        return ingest_since(spark, "t", str(tmp_path / "in"), str(tmp_path / "out"), SCHEMA, marks, **more)

    with pytest.raises(FileExistsError, match="another loader"):
        run()
    assert run(take_over=True) == run() == datetime(2024, 2, 1)


def test_stream_ingest_is_idempotent_and_sets_bad_rows_aside(spark, tmp_path):
    landing, bronze, bad, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "cp")
    put(landing, "a.json", '{"a": "1", "b": "x"}\n{"a": "2"\n', datetime(2024, 2, 1, 6))

    def run():
        ingest_incremental(spark, str(landing), bronze, SCHEMA, progress, rename={"b": "client"}, quarantine=bad)

    run()
    run()
    put(landing, "sub/b.json", '{"a": "3", "b": "z"}\n', datetime(2025, 2, 1, 6))
    run()
    got = spark.read.parquet(bronze)
    assert sorted((r["a"], r["client"], r["YEAR"]) for r in got.collect()) == [("1", "x", 2024), ("3", "z", 2025)]
    assert [r["_corrupt_record"] for r in spark.read.parquet(bad).collect()] == ['{"a": "2"']


def test_stream_takes_files_delivered_again_and_late(spark, tmp_path):
    landing, bronze, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    newest = datetime(2024, 2, 1, 6)
    for name, value, at in (("a", "1", newest), ("same [x]", "2", newest), ("older", "3", datetime(2024, 1, 15)), ("a", "4", datetime(2024, 1, 20))):
        put(landing, f"sub/{name}.json", f'{{"a": "{value}", "b": "x"}}\n', at)
        put(landing, "_hidden/x.json", '{"a": "hidden"}')
        for _ in range(2):
            ingest_incremental(spark, f"file://{landing}", bronze, SCHEMA, progress)
    got = spark.read.parquet(bronze).collect()
    assert sorted((r["a"], r["LOAD"]) for r in got) == [("1", 1), ("2", 2), ("3", 3), ("4", 4)]


def test_stream_that_died_repeats_nothing(spark, tmp_path, monkeypatch):
    landing, bronze, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(5):
        put(landing, f"f{i}.json", f'{{"a": "{i}", "b": "x"}}\n', datetime(2024, 2, 1, i))

    def run():
        ingest_incremental(spark, str(landing), bronze, SCHEMA, progress, max_files_per_batch=2)

    for dies in (2, 3):
        writes = []

        def write(*args, dies=dies, writes=writes, **kwargs):
            write_table(*args, **kwargs)
            writes.append(1)
            if len(writes) == dies:
                raise RuntimeError("lost")

        with monkeypatch.context() as m:
            m.setattr(stream_ingest, "write_table", write)
            with pytest.raises(Exception, match="lost"):
                run()
        put(landing, f"late{dies}.json", f'{{"a": "late{dies}", "b": "x"}}\n', datetime(2024, 1, 1))
    run()
    run()
    got = sorted(r["a"] for r in spark.read.parquet(bronze).collect())
    assert got == ["0", "1", "2", "3", "4", "late2", "late3"]


def test_old_files_are_not_passed_over(spark, tmp_path):
    landing, bronze, progress = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "progress")
    for at, name in ((datetime(2024, 2, 1), "a"), (datetime(1995, 2, 1), "b")):
        put(landing, f"{name}.json", f'{{"a": "{name}", "b": "x"}}\n', at)
        ingest_incremental(spark, str(landing), bronze, SCHEMA, progress)
    assert sorted(r["a"] for r in spark.read.parquet(bronze).collect()) == ["a", "b"]


def test_write_table_copies_partition_columns_and_replaces_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "m string, v int")
    write_table(df, path, ["m"], copy_partition_cols=True)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == ["m", "m_1", "v"] and os.path.isdir(f"{path}/m_1=2024-01")
    plain = str(tmp_path / "u")
    write_table(df, plain, ["m"])
    write_table(spark.createDataFrame([("2024-02", 9)], df.schema), plain, ["m"], replace_partitions=True)
    assert sorted(r["v"] for r in spark.read.parquet(plain).collect()) == [1, 9]
    write_table(df, str(tmp_path / "f"), files=3)
    assert sum(n.endswith(".snappy.parquet") for n in os.listdir(tmp_path / "f")) <= 3


def test_reports_per_recipient(spark, tmp_path):
    df = spark.createDataFrame([("ana.lopez@example.org", 1), ("bo@example.org", 2), ("bo@example.org", 3)], "mail string, v int")
    export_by_recipient(df, "mail", str(tmp_path / "r"))
    assert {n for n in os.listdir(tmp_path / "r") if n.startswith("slug=")} == {"slug=ana_lopez", "slug=bo"}
    assert df.select(recipient_slug("mail")).first()[0] == "ana_lopez"
    write_manifest(df.select("mail"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 3


def test_recipient_rows_by_role(spark):
    df = spark.createDataFrame([(1, "ana", "chief"), (2, "chief", "chief"), (3, None, " ")], "id int, own string, coord string")
    got = recipient_rows(df, ["own", "coord"], see_all=["all"])
    assert sorted((r["id"], r["recipient"]) for r in got.collect()) == [(1, "all"), (1, "ana"), (1, "chief"), (2, "all"), (2, "chief"), (3, "all")]


def test_shared_dir_is_the_session_setting(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_specs(spark):
    assert purchasing_spec("EKET").keys == ("EBELN", "EBELP", "ETENR")
    assert sales_spec("A005").order_by == ("DATAB", "SEQ_DATE")
    assert (len(PURCHASING_KEYS), len(SALES_KEYS)) == (30, 21)
    assert set(PURCHASING_PARTITIONS) <= set(PURCHASING_KEYS) and set(SALES_PARTITIONS) <= set(SALES_KEYS)
    assert {t for t in PURCHASING_KEYS if purchasing_spec(t).load_mode == "append"} == {"EKKO", "MATDOC"}
    assert purchasing_spec("EBAN").partition_by == ("YEAR", "MONTH") and sales_spec("MVKE").partition_by == ("YEAR", "MONTH", "MANDANTE", "CDIS")
    assert sales_spec("VBAP").partition_by == ("YEAR",) and sales_spec("VBEP").partition_by == ()
    dictionary = spark.createDataFrame([("T", "N", "CURR"), ("T", "D", "DATS"), ("T", "C", "CHAR"), ("U", "X", "QUAN")], "table string, column string, datatype string")
    spec = with_types(TableSpec("T", ("K",)), dictionary)
    assert (spec.numeric, spec.dates) == (("N",), ("D",))
    ordered = dictionary.withColumn("position", F.expr("case column when 'C' then 1 when 'D' then 2 else 3 end"))
    assert schema_of(ordered, "T").simpleString() == "struct<C:string,D:string,N:string>"
    assert schema_of(ordered, "T", typed=True).simpleString() == "struct<C:string,D:date,N:double>"


def test_marks_compare_in_any_time_zone(spark, tmp_path):
    mark = datetime(2024, 3, 1, 12)
    put(tmp_path, "new.json", '{"a": "new"}', mark + timedelta(hours=1))
    put(tmp_path, "old.json", '{"a": "old"}', mark - timedelta(hours=1))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Mexico_City", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r["a"] for r in scan_json(spark, str(tmp_path), SCHEMA, modified_after=mark).collect()] == ["new"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
