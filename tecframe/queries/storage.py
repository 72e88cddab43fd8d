"""Sources and sinks: tables go out to the shared scratch folder and come back."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tecframe.operators.sets import CANONICAL_ORDER, upsert
from tecframe.queries.base import LINKS, Tables, links, query
from tecframe.queries.filters import REGION_EVENTS, region_events
from tecframe.queries.matching import TIMED_EVENTS, timed_events
from tecframe.session import scratch_dir
from tecframe.sources import archives, catalogs, listing, manifests, tables
from tecframe.streaming.products import append_available, stream_products


@query("s01_read_parts", "SELECT event_id, value, CASE WHEN event_type = 'click' THEN props END AS props FROM events")
def s01(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "parts")
    e = t.events
    e.filter("event_type = 'click'").select("event_id", "value", "props").write.parquet(f"{root}/links.part0.parquet")
    e.filter("event_type <> 'click'").select("event_id", "value").write.parquet(f"{root}/links.part1.parquet")
    return tables.read_parts(t.spark, root, "links").select("event_id", "value", "props")


@query("s02_table_round_trip", "SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderdate FROM orders")
def s02(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "tables")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    tables.save_table(rows.filter("o_orderkey % 2 = 0"), f"{root}/a.csv")
    tables.save_table(rows.filter("o_orderkey % 2 = 1"), f"{root}/b.parquet")
    schema = "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING, o_orderdate TIMESTAMP"
    return tables.load_table(t.spark, f"{root}/a.csv", schema).unionByName(tables.load_table(t.spark, f"{root}/b.parquet"))


@query("s03_index_files", """
SELECT date_trunc('second', ts) AS "Time", nullif(CASE WHEN value < 5 THEN 9999.99 ELSE value END, 9999.99) AS "IMF_Bz_nT" FROM events
""")
def s03(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "omni") + ".csv"
    rows = t.events.select(F.col("ts").alias("Time"), F.when(F.col("value") < 5, 9999.99).otherwise(F.col("value")).alias("IMF_Bz_nT"))
    tables.write_omni(rows, path)
    return tables.read_omni(t.spark, path, "bz")


@query("l01_ordered_sink", f"""
WITH {LINKS}
SELECT time, station_id, sv, stec, ingest_pos, row_number() OVER (ORDER BY time, station_id, sv, stec, ingest_pos) - 1 AS position FROM links
""")
def l01_sink(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "ordered")
    rows = links(t).select("time", "station_id", "sv", "stec", "ingest_pos")
    tables.write_ordered(rows, path, CANONICAL_ORDER["links"])
    return tables.read_ordered(t.spark, path)


@query("s04_manifest_round_trip", """
SELECT CAST(event_id AS VARCHAR) AS path, CASE WHEN event_type <> 'view' THEN event_type END AS producer, CASE WHEN event_id % 2 = 0 THEN 'vtec,roti' ELSE '' END AS metrics,
       json_extract_string(props, '$.k') AS k, date_trunc('second', ts) AS time_start FROM events
""")
def s04(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "manifest") + ".csv"
    rows = t.events.select(
        F.lit("ev").alias("event_id"), F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("").alias("producer"),
        F.lit("gnss_grid").alias("source_kind"), F.col("event_id").cast("string").alias("path"),
        F.when(F.col("event_id") % 2 == 0, F.array(F.lit("VTEC"), F.lit("ROTI"))).otherwise(F.array().cast("array<string>")).alias("metrics"),
        F.date_trunc("second", "ts").alias("time_start"), F.col("ts").alias("time_end"), F.from_json("props", "map<string,string>").alias("metadata"),
    )
    manifests.write_manifest(rows, "gnss_products", path)
    back = manifests.read_manifest(t.spark, "gnss_products", path)
    return back.select("path", "producer", F.array_join("metrics", ",").alias("metrics"), F.try_element_at("metadata", F.lit("k")).alias("k"), "time_start")


REPLACED = """
SELECT o_orderkey, o_orderstatus AS producer, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, 'F', o_totalprice * 2 FROM orders WHERE o_orderpriority = '1-URGENT'
"""


@query("s05_replace_by_key", REPLACED)
def s05(t: Tables) -> DataFrame:
    old = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("producer"), "o_totalprice")
    new = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("F").alias("producer"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return upsert(old, new, "F")


@query("s05_replace_in_place", REPLACED)
def s05_in_place(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "producers")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("producer"), "o_totalprice")
    tables.save_by_key(rows, path)
    new = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    tables.replace_in_place(new, path, "F")
    return t.spark.read.schema("o_orderkey LONG, o_totalprice DOUBLE, producer STRING").parquet(path).select("o_orderkey", "producer", "o_totalprice")


@query("s06_asset_listing", "SELECT DISTINCT CAST(ts AS DATE) AS observation_date, event_type FROM events", texts=("observation_date",))
def s06(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "assets")
    rows = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    rows.repartition("event_type", "day").write.partitionBy("event_type", "day").parquet(root)
    found = listing.list_assets(t.spark, root, "*.parquet", r"/day=\d{4}-\d{2}-\d{2}/")
    keyed = found.select(
        "path", F.to_date(F.regexp_extract("path", r"/day=([^/]*)/", 1)).alias("observation_date"), F.regexp_extract("path", r"/event_type=([^/]*)/", 1).alias("event_type")
    )
    first = keyed.groupBy("observation_date", "event_type").agg(F.min("path").alias("path"))
    return first.select("observation_date", "event_type")


@query("s08_hourly_chunks", f"""
WITH {REGION_EVENTS}
SELECT e.event_id AS row_id, ev.event_id, strftime(date_trunc('hour', ts), '%Y%m%d_%H00') AS chunk, least(date_trunc('hour', ts) + INTERVAL 45 MINUTES, end_utc) AS chunk_end
FROM events e JOIN region ON r_regionkey = user_id % 5 JOIN ev ON ev.event_id = r_name WHERE ts BETWEEN start_utc AND end_utc
""")
def s08(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "hourly")
    rows = t.events.join(t.region, F.col("user_id") % 5 == F.col("r_regionkey")).select(
        F.col("event_id").alias("row_id"), F.col("r_name").alias("event_id"), F.col("ts").alias("time")
    )
    # a product holds the intervals of its event
    ev = region_events(t)
    rows = rows.join(ev, "event_id").filter(F.col("time").between(F.col("start_utc"), F.col("end_utc"))).drop("start_utc", "end_utc")
    chunks = tables.with_chunks(rows, ev, 15)
    tables.write_hourly(chunks, path)
    back = t.spark.read.schema("row_id LONG, chunk_end TIMESTAMP, event_id STRING, chunk STRING").parquet(path)
    return back.select("row_id", "event_id", "chunk", "chunk_end")


def write_archives(rows: DataFrame, root: str) -> DataFrame:
    """One tar file per archive name, written by the task that holds its members."""
    def save(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)
        system.create_dir(base, recursive=True)
        name = str(pdf["tar"].iloc[0])
        with system.open_output_stream(f"{base}/{name}.tar") as out, tarfile.open(fileobj=out, mode="w|") as tar:
            for member in pdf["member"]:
                info = tarfile.TarInfo(member)
                info.size = len(member)
                tar.addfile(info, io.BytesIO(member.encode()))
        return pd.DataFrame({"tar": [name]})

    return rows.groupBy("tar").applyInPandas(save, "tar string")


@query("s09_archive_index", f"""
WITH {TIMED_EVENTS}
SELECT 'u' || CAST(user_id AS VARCHAR) AS tar, CASE WHEN event_type = 'click' THEN 'CHA' ELSE 'CHB' END AS hemisphere, date_trunc('minute', time) AS obs_time, id, CAST(41 + length(CAST(id AS VARCHAR)) AS BIGINT) AS size
FROM me WHERE event_type IN ('click', 'view')
""")
def s09(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "archives")
    # one archive per user and month; members of other types have names that no swath has
    me = timed_events(t)
    head = F.when(F.col("event_type").isin("click", "view"), "d/GOLD_L1C_").otherwise("notes_")
    member = F.concat(
        head, F.when(F.col("event_type") == "click", "CHA").otherwise("CHB"), F.lit("_NI1_"), F.date_format("time", "yyyy_DDD_HH_mm"), F.lit("_v04_"), F.col("id").cast("string"), F.lit(".nc")
    )
    rows = me.select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.date_format("time", "'_'yyyyMM")).alias("tar"), member.alias("member"))
    write_archives(rows, root).write.format("noop").mode("overwrite").save()
    out = archives.index_archives(t.spark, root)
    return out.select(
        F.regexp_extract("tar_path", r"/(u\d+)_\d+\.tar$", 1).alias("tar"), "hemisphere", "obs_time",
        F.regexp_extract("member", r"_(\d+)\.nc$", 1).cast("long").alias("id"), "size",
    )


@query("s10_page_links", """SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""")
def s10(t: Tables) -> DataFrame:
    return catalogs.extract_links(t.pages, keep=("page_id",))


@query("s11_station_catalogs", """
SELECT 'kml' AS source, upper(s_name) AS station_id, lower(substr(s_name, 1, 4)) AS station_code4, CAST(s_suppkey % 160 - 80 AS DOUBLE) AS lat, CAST(NULL AS INTEGER) AS sampling_sec FROM supplier WHERE s_suppkey % 5 <> 0
UNION ALL SELECT 'json', 'S' || CAST(s_suppkey AS VARCHAR) || 'X', lower(substr('s' || CAST(s_suppkey AS VARCHAR) || 'x', 1, 4)), NULL, CAST(s_nationkey AS INTEGER) FROM supplier
UNION ALL SELECT DISTINCT 'list', '', 'c' || lpad(CAST(c_custkey % 300 AS VARCHAR), 3, '0'), CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER) FROM customer WHERE c_custkey % 2 = 0
""", texts=("sampling_sec",))
def s11(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    kml = t.supplier.select(
        F.concat(
            F.lit("<kml><Placemark><name>"), F.col("s_name"), F.lit("</name><Point><coordinates>"),
            F.when(k % 5 == 0, F.lit("")).otherwise(F.concat_ws(",", (k * 7 % 360 - 180).cast("string"), (k % 160 - 80).cast("string"), F.lit("12.5"))),
            F.lit("</coordinates></Point></Placemark></kml>"),
        ).alias("kml")
    )
    code = F.concat(F.lit("S"), k.cast("string"), F.lit("x"))
    js = t.supplier.select(F.to_json(F.array(F.struct(code.alias("cod_estacion"), F.col("s_nationkey").alias("intervalo_observacion")))).alias("json"))
    name = F.concat(F.lit("C"), F.lpad((F.col("c_custkey") % 300).cast("string"), 3, "0"))
    lines = t.customer.select(
        F.concat(F.lit("header line\n2024/001/"), F.lit(""), F.lit("x/"), name, F.lit("/f0010."), F.when(F.col("c_custkey") % 2 == 0, "24").otherwise("23"), F.lit("d.gz  100 bytes\n")).alias("text")
    )
    none = lambda ty: F.lit(None).cast(ty)
    a = catalogs.parse_placemarks(kml).select(F.lit("kml").alias("source"), "station_id", "station_code4", "lat", none("int").alias("sampling_sec"))
    b = catalogs.parse_station_json(js).select(F.lit("json"), "station_id", "station_code4", none("double"), "sampling_sec")
    c = catalogs.parse_file_list(lines, "24").select(F.lit("list"), F.lit(""), "station_code4", none("double"), none("int"))
    return a.union(b).union(c)


@query("x01_stream_products", "SELECT event_id, user_id, value FROM events")
def x01(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "stream")
    rows = t.events.select("event_id", "user_id", "value")
    rows.write.parquet(f"{root}/in")
    stream = stream_products(t.spark, f"{root}/in", rows.schema)
    append_available(stream, f"{root}/out", checkpoint=f"{root}/state").awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{root}/out")
