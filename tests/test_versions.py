import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.snapshots import latest_by_key
from millrace.sources import shared_files, versioned
from millrace.sources.versioned import VersionedTable


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def files(table, version=None):
    return {r["file"] for r in table.manifest(version).collect()}


@pytest.fixture
def base(spark):
    return spark.range(0, 20_000, 2).select("id", F.lit("base").alias("v"), F.lit(0).alias("seq"), F.expr("id div 5000").alias("part"))


def change(spark, ids, seq, part=None):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    part = F.expr("id div 5000") if part is None else F.lit(part).cast("long")
    return df.select("id", F.lit(f"v{seq}").alias("v"), F.lit(seq).alias("seq"), part.alias("part"))


def test_merge_rewrites_only_files_with_its_keys(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], partition_by=["part"], rows_per_file=500)
    kept.merge(base, ["seq"])
    whole, first = base, files(kept)
    assert len(first) >= 20
    touched = []
    for seq, ids in enumerate([range(100, 140, 2), [14_000, 20_001, 20_003], [-7], []], 1):
        increment = change(spark, ids, seq)
        before = files(kept)
        kept.merge(increment, ["seq"])
        whole = latest_by_key(whole.union(increment), ["id"], ["seq"])
        assert rows(kept.read()) == rows(whole)
        touched.append(len(before - files(kept)))
    assert touched == [1, 1, 0, 0]
    assert rows(kept.read(1)) == rows(base)  # an older version is still whole


def test_filters_keep_files_out_whose_range_fits(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], rows_per_file=1000)
    kept.append(base)
    odd = spark.range(1, 2000, 100).select("id")  # between the keys of the table
    assert kept.files_of(odd).count() <= 1
    assert kept.files_of(odd.selectExpr("id + 1 as id")).count() >= 1


def test_no_file_with_a_key_is_missed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "CELLS", 5)
    rng = random.Random(3)
    keys = list({(rng.choice(["a", "é", "", None, "zz"]), rng.choice([None, *range(300)])) for _ in range(900)})
    df = spark.createDataFrame([(*k, i % 7) for i, k in enumerate(keys)], "k string, n long, part int")
    kept = VersionedTable(spark, str(tmp_path / "t"), ["k", "n"], rows_per_file=20)
    for part in range(7):
        kept.append(df.filter(F.col("part") == part))
    named = {}
    for r in kept._read(kept.manifest(), df.schema, "file").collect():
        named.setdefault((r["k"], r["n"]), set()).add(r["file"])
    for _ in range(5):
        asked = rng.sample(keys, 12)
        found = {r["file"] for r in kept.files_of(spark.createDataFrame(asked, "k string, n long")).collect()}
        assert set().union(*(named[k] for k in asked)) <= found


def test_a_row_moves_to_its_new_partition(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], partition_by=["part"])
    kept.merge(base, ["seq"])
    kept.merge(change(spark, [10], 1, part=77), ["seq"])
    assert [tuple(r) for r in kept.read().filter("id = 10").collect()] == [(10, "v1", 1, 77)]
    assert kept.read().count() == base.count()


def test_loads_come_once_and_failed_ones_leave_nothing(spark, tmp_path, base, monkeypatch):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    assert kept.append(base, load="a") == kept.append(base, load="a") == 1
    with monkeypatch.context() as m:
        m.setattr(versioned, "write_new", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            kept.append(base, load="b")
    assert kept.version() == 1 and kept.read().count() == base.count()
    assert kept.append(change(spark, [1], 1), load="b") == 2
    assert kept.read().count() == base.count() + 1


def test_two_changes_of_one_version_are_not_both_published(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    kept.append(base)
    late = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    late.version = lambda: 1
    kept.append(change(spark, [1], 1))
    with pytest.raises(FileExistsError):
        late.append(change(spark, [3], 1))
    assert kept.read().count() == base.count() + 1


def test_slice_is_replaced_in_one_step(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], partition_by=["part"])
    kept.append(base)
    pinned, before = kept.read(), files(kept)
    kept.replace_slice(change(spark, [5001, 5003], 9), F.col("part") != 1)
    assert rows(pinned) == rows(base)
    assert rows(kept.read()) == rows(base.filter("part <> 1").union(change(spark, [5001, 5003], 9)))
    assert {f for f in before - files(kept)} == {f for f in before if "part=1/" in f}
    kept.replace_slice(change(spark, [], 9), F.lit(None).cast("boolean"))  # nothing is known to stay
    assert kept.read().count() == 0


def test_snapshot_opens_no_more_files_when_old_loads_pile_up(spark, tmp_path):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], partition_by=["day"], load_time="day", load_group=["plant"])
    load = lambda day, plants: spark.range(40).selectExpr("id", f"element_at(array({plants}), cast(id % 2 as int) + 1) as plant", f"{day} as day")
    kept.append(load(10, "'a', 'b'"))
    kept.append(load(20, "'a', 'a'"))

    def newest():
        got = kept.snapshot(["plant"])
        return rows(got), len([f for f in got.inputFiles() if "/data/" in f])

    want = rows(load(20, "'a', 'a'").union(load(10, "'a', 'b'").filter("plant = 'b'")))
    before, opened = newest()
    assert before == want
    for day in range(1, 6):
        kept.append(load(day, "'a', 'b'"))
    assert newest() == (want, opened)
    assert rows(kept.snapshot([], "min")) == rows(load(1, "'a', 'b'"))
    assert len(kept.manifest().collect()) > opened


def test_a_new_column_is_null_in_older_rows(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    kept.merge(base, ["seq"])
    kept.merge(change(spark, [10, 12], 1).withColumn("extra", F.lit("e")), ["seq"])
    got = kept.read()
    assert got.columns[-1] == "extra" and got.filter("extra = 'e'").count() == 2 and got.count() == base.count()
    assert kept.replace(base.limit(3), load="x") == kept.replace(base.limit(3), load="x")
    assert kept.read().count() == 3 and kept.read().columns == base.columns


def test_shared_files(spark, tmp_path):
    path = f"{tmp_path}/d/x"
    shared_files.write_new(spark, path, "é")
    with pytest.raises(FileExistsError):
        shared_files.write_new(spark, path, "other")
    assert shared_files.read_text(spark, path) == "é" and shared_files.names(spark, f"{tmp_path}/d") == ["x"]
    with shared_files.lease(spark, f"{tmp_path}/lease", "one"):
        with pytest.raises(FileExistsError, match="one"):
            with shared_files.lease(spark, f"{tmp_path}/lease", "two"):
                pass
        with shared_files.lease(spark, f"{tmp_path}/lease", "three", take_over=True):
            pass
    assert shared_files.names(spark, str(tmp_path)) == ["d"]


def test_a_key_asks_one_row_of_a_filter(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"], rows_per_file=1000)
    kept.append(base)
    plan = kept.files_of(base.select("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1  # the ranges' cells; the bits of a key are not spread over rows
    assert {r["file"] for r in kept.files_of(base.select("id")).collect()} == files(kept)


def test_an_increment_is_worked_out_once(spark, tmp_path, base):
    kept = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    kept.append(base)
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda v: (seen.add(1), v)[1], "string").asNondeterministic()
    kept.merge(change(spark, range(0, 50), 1).withColumn("v", mark("v")), ["seq"])
    assert seen.value == 50
