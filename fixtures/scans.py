"""Scans, listings, ingest and writers."""

from __future__ import annotations

from datetime import date, datetime
from itertools import chain

from pyspark.sql import functions as F

from fixtures.base import AS_OF, money, number, query, table
from millrace.functions import to_day, to_number
from millrace.operators.columns import cast_columns
from millrace.sources.ingest import ingest_since, read_loaded
from millrace.sources.listing import list_files, new_files, path_part, recent_files, zero_byte_files
from millrace.sources.load_log import Watermark, latest_marks
from millrace.sources.scans import (
    scan_dimension,
    scan_json,
    scan_or_empty,
    scan_parquet,
    text_schema,
    with_source_file,
)
from millrace.sources.shared_files import names
from millrace.sources.workspace import new_path
from millrace.sources.writers import (
    export_by_recipient,
    recipient_rows,
    write_manifest,
    write_table,
)
from millrace.streaming.ingest import ingest_incremental

ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _order_text(spark, sf_dir):
    """Orders the way an ERP extract arrives: every value as text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        money("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


@query(
    "src_json_scan",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_orderdate,
    o_orderpriority from orders""",
)
def src_json_scan(spark, sf_dir):
    path = new_path(spark, "json")
    _order_text(spark, sf_dir).write.json(path)
    raw = scan_json(spark, path, text_schema(ORDER_TEXT))
    return cast_columns(raw, ["o_totalprice"], ["o_orderdate"]).withColumns(
        {c: F.col(c).try_cast("bigint") for c in ("o_orderkey", "o_custkey")}
    )


@query(
    "src_json_primitives",
    """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
    l_quantity from lineitem""",
)
def src_json_primitives(spark, sf_dir):
    path = new_path(spark, "json")
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").write.json(path)
    raw = scan_json(
        spark, path, text_schema(["l_orderkey", "l_linenumber", "l_quantity"]), primitives_as_string=True
    )
    return raw.withColumn("l_quantity", to_number("l_quantity"))


@query(
    "src_parquet_scan",
    """select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '1998-06-15'""",
)
def src_parquet_scan(spark, sf_dir):
    rows = scan_parquet(spark, f"{sf_dir}/lineitem.parquet", where=F.col("l_shipdate") >= F.lit(AS_OF))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "src_dimension",
    "select cast(c_custkey as varchar) as c_custkey, upper(c_name) as c_name, upper(c_mktsegment) as c_mktsegment from customer",
)
def src_dimension(spark, sf_dir):
    path = new_path(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return scan_dimension(spark, path, ["c_custkey", "c_name", "c_mktsegment"], upper=True)


@query("src_or_empty", "select c_custkey, c_name from customer")
def src_or_empty(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.unionByName(scan_or_empty(spark, f"{sf_dir}/no_such_table.parquet", c.schema))


@query("src_source_file", "select 'lineitem.parquet' as file, count(*) as n from lineitem")
def src_source_file(spark, sf_dir):
    rows = with_source_file(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    return rows.groupBy(F.substring_index("source_file", "/", -1).alias("file")).agg(F.count("*").alias("n"))


def _by_priority(spark, sf_dir):
    path = new_path(spark, "files")
    write_table(table(spark, sf_dir, "orders"), path, ["o_orderpriority"])
    return path


@query("src_list_files", "select distinct replace(o_orderpriority, ' ', '%20') as folder from orders")
def src_list_files(spark, sf_dir):
    files = list_files(spark, _by_priority(spark, sf_dir)).filter(F.col("name").startswith("part-"))
    folder = F.replace(F.regexp_extract("path", "o_orderpriority=([^/]+)/", 1), F.lit(" "), F.lit("%20"))
    return files.filter(F.col("size") > 0).select(folder.alias("folder")).distinct()


@query("src_new_files", "select distinct replace(o_orderpriority, ' ', '%20') as folder from orders")
def src_new_files(spark, sf_dir):
    files = new_files(spark, _by_priority(spark, sf_dir), datetime(2000, 1, 1)).filter(F.col("name").startswith("part-"))
    folder = F.replace(F.regexp_extract("path", "o_orderpriority=([^/]+)/", 1), F.lit(" "), F.lit("%20"))
    return files.select(folder.alias("folder")).distinct()


@query(
    "src_recent_files",
    """select replace(o_orderpriority, ' ', '%20') as team, status, version from (
      select *, dense_rank() over (partition by o_orderpriority, status order by version desc) as r
      from (select distinct o_orderpriority, o_orderstatus as status, year(o_orderdate) as version from orders)) where r <= 2""",
)
def src_recent_files(spark, sf_dir):
    # A backup tree team/version/status.json; the newest two of every file and team, read off a listing.
    landing = new_path(spark, "backups")
    o = table(spark, sf_dir, "orders")
    versions = o.select("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("version")).distinct()
    versions = versions.withColumns({"team": F.col("o_orderpriority"), "file": F.col("o_orderstatus")})
    write_table(versions, landing, ["team", "version", "file"])
    listed = list_files(spark, landing).filter(F.col("name").startswith("part-"))
    value = lambda n: F.substring_index(path_part(n), "=", -1)
    keyed = listed.select(
        "path",
        F.replace(value(4), F.lit(" "), F.lit("%20")).alias("team"),
        value(2).alias("status"),
        F.make_timestamp(value(3).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("modified"),
    )
    newest = recent_files(keyed, ["team", "status"], 2)
    return newest.select("team", "status", F.year("modified").cast("long").alias("version"))


@query("src_zero_byte_files", "select '_SUCCESS' as name, cast(0 as bigint) as size from orders limit 1")
def src_zero_byte_files(spark, sf_dir):
    # The marker that Spark leaves beside a finished table is an empty file.
    return zero_byte_files(spark, _by_priority(spark, sf_dir), as_of=date.today()).select("name", "size")


@query(
    "src_watermark_max",
    """select event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last_modified from events group by 1""",
)
def src_watermark_max(spark, sf_dir):
    marks = latest_marks(table(spark, sf_dir, "events"), "event_type", "ts")
    return marks.select("event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_modified"))


@query(
    "src_quarantine",
    """select case when o_orderpriority = '1-URGENT' then 'bad' else 'good' end as state, count(*) as n,
    count(case when o_orderpriority <> '1-URGENT' then o_orderkey end) as keys from orders group by 1""",
)
def src_quarantine(spark, sf_dir):
    path = new_path(spark, "lines")
    line = F.to_json(F.struct(*ORDER_TEXT))
    cut = F.when(F.col("o_orderpriority") == "1-URGENT", F.substring(line, 1, 20)).otherwise(line)
    _order_text(spark, sf_dir).select(cut.alias("value")).write.text(path)
    good, bad = scan_json(spark, path, text_schema(ORDER_TEXT), quarantine=True)
    states = good.select(F.lit("good").alias("state"), "o_orderkey").unionByName(
        bad.select(F.lit("bad").alias("state"), "o_orderkey")
    )
    return states.groupBy("state").agg(F.count("*").alias("n"), F.count("o_orderkey").alias("keys"))


INGEST_SQL = """select 2024 as "YEAR", 3 as "MONTH", o_orderstatus as status, count(*) as n,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount from orders group by 3"""


def _loaded(df):
    keys = [F.col("YEAR"), F.col("MONTH"), F.col("status")]
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), number(F.sum(F.col("o_totalprice").try_cast("decimal(18,2)"))).alias("amount")
    )


def _deliver(spark, rows, landing, modified):
    """Files ``part-0.json``, ``part-1.json``, ... in the landing folder, in place of older ones with the same names."""
    jvm, made = spark._jvm, new_path(spark, "made")
    rows.write.json(made)
    fs = jvm.org.apache.hadoop.fs.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(landing))
    for i, name in enumerate(n for n in names(spark, made) if n.startswith("part-")):
        at = jvm.org.apache.hadoop.fs.Path(f"{landing}/part-{i}.json")
        fs.delete(at, False)
        fs.rename(jvm.org.apache.hadoop.fs.Path(f"{made}/{name}"), at)
        fs.setTimes(at, int(modified.timestamp() * 1000), -1)


def _deliveries(spark, sf_dir, landing):
    """Orders in three deliveries: the second under the names of the first, the third with an older time."""
    o = _order_text(spark, sf_dir)
    for status, folder, at in (("F", "", datetime(2024, 3, 1)), ("O", "", datetime(2024, 3, 2)), ("P", "/late", datetime(2024, 2, 1))):
        yield _deliver(spark, o.filter(F.col("o_orderstatus") == status), landing + folder, at)


@query("src_ingest_stream", INGEST_SQL)
def src_ingest_stream(spark, sf_dir):
    source, target, checkpoint = (new_path(spark, n) for n in ("landing", "bronze", "progress"))
    for _ in chain(_deliveries(spark, sf_dir, source), [None]):  # the last run finds nothing new
        ingest_incremental(
            spark, source, target, text_schema(ORDER_TEXT), checkpoint,
            rename={"o_orderstatus": "status"}, loaded_at=datetime(2024, 3, 1, 6),
        )
    return _loaded(spark.read.parquet(target))


@query("src_ingest_batch", INGEST_SQL)
def src_ingest_batch(spark, sf_dir):
    source, target, log = (new_path(spark, n) for n in ("landing", "bronze", "log"))
    marks = Watermark(spark, log, datetime(2000, 1, 1))
    for _ in chain(_deliveries(spark, sf_dir, source), [None]):
        ingest_since(
            spark, "orders", source, target, text_schema(ORDER_TEXT), marks,
            rename={"o_orderstatus": "status"}, loaded_at=datetime(2024, 3, 1, 6), files=8,
        )
    return _loaded(read_loaded(spark, "orders", target, marks))


@query(
    "snk_roundtrip",
    """select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month,
    strftime(o_orderdate, '%Y-%m') as month_copy from orders""",
)
def snk_roundtrip(spark, sf_dir):
    path = new_path(spark, "table")
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    write_table(rows, path, ["month"], copy_partition_cols=True)
    back = scan_parquet(spark, path)
    copy = F.date_format(F.col("month_1").cast("string").cast("date"), "yyyy-MM")
    return back.select("o_orderkey", "o_totalprice", "month", copy.alias("month_copy"))


@query(
    "snk_append_replace",
    """select cast(year(o_orderdate) as integer) as year, o_orderstatus, count(*) as n from orders group by 1, 2""",
)
def snk_append_replace(spark, sf_dir):
    path = new_path(spark, "table")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    write_table(o.filter("year < 1998"), path, ["year"])
    write_table(o.filter("year >= 1998"), path, ["year"], mode="append")
    write_table(o.filter("year = 1997"), path, ["year"], replace_partitions=True)
    return spark.read.parquet(path).groupBy("year", "o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "snk_manifest",
    "select c_name as recipient, concat('reports/', c_mktsegment) as file from customer",
)
def snk_manifest(spark, sf_dir):
    path = new_path(spark, "manifest")
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_name").alias("recipient"), F.concat(F.lit("reports/"), "c_mktsegment").alias("file"))
    write_manifest(rows, path)
    return scan_json(spark, path, text_schema(["recipient", "file"]))


@query(
    "snk_recipients",
    """select replace(concat('team.', lower(c_mktsegment)), '.', '_') as slug, count(*) as n,
    cast(sum(cast(c_acctbal as decimal(18,2))) as double) as balance from customer group by 1""",
)
def snk_recipients(spark, sf_dir):
    path = new_path(spark, "recipients")
    c = table(spark, sf_dir, "customer")
    address = F.concat(F.lit("team."), F.lower("c_mktsegment"), F.lit("@example.org"))
    export_by_recipient(c.select("c_custkey", "c_acctbal", address.alias("recipient")), "recipient", path)
    back = spark.read.option("header", True).schema("c_custkey bigint, c_acctbal double, recipient string").csv(path)
    return back.groupBy("slug").agg(F.count("*").alias("n"), number(F.sum(money("c_acctbal"))).alias("balance"))


@query(
    "snk_recipient_roles",
    """select recipient, count(*) as n from (
      select c_mktsegment as recipient from customer
      union all select concat('NATION_', c_nationkey) from customer
      union all select 'ALL' from customer) group by 1""",
)
def snk_recipient_roles(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("desk")
    )
    rows = recipient_rows(c, ["c_mktsegment", "desk"], see_all=["ALL"])
    return rows.groupBy("recipient").agg(F.count("*").alias("n"))


@query(
    "src_day_parse",
    "select o_orderkey, cast(o_orderdate as date) as day, cast(null as date) as not_a_day from orders",
)
def src_day_parse(spark, sf_dir):
    o = _order_text(spark, sf_dir)
    return o.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        to_day("o_orderdate").alias("day"),
        to_day("o_orderpriority").alias("not_a_day"),
    )
