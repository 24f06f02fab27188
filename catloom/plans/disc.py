"""A catalogue-shaped view over the order tables, the same for Spark and for SQL.

``_ord`` is a hash of the row: rows that are equal throughout are interchangeable, all others ordered, without a
global numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom import schema
from catloom.runtime import bounded, table


def disc(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders, customer, part = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part"))
    # the shorter tables meet first, so that the lines move once
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderstatus", "o_orderdate", "c_name")
    part = bounded(part.select("p_partkey", "p_name", "p_brand", "p_type"))
    joined = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    key = F.col("l_partkey")
    text = lambda c: F.col(c).cast("string")
    kind = F.when(key % 11 == 0, "album").when(key % 13 == 0, "single").otherwise("track")
    suffix = F.when(F.col("l_returnflag") == "A", " - Remix").when(F.col("l_returnflag") == "R", " (Live)").otherwise("")
    length = F.when(F.col("o_orderkey") % 3 == 0, 4).when(F.col("o_orderkey") % 3 == 1, 7).otherwise(10)
    year = F.least(F.year("o_orderdate") - 1995, F.lit(5))
    era = F.lit(schema.ERAS[5])
    for i in range(4, -1, -1):
        era = F.when(year == i, schema.ERAS[i]).otherwise(era)
    cents = F.round(F.col("l_extendedprice") * 100).cast("long").cast("string")
    order = F.md5(F.concat_ws("|", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"), F.col("l_quantity").cast("int").cast("string"), cents,
                              "l_returnflag", "l_linestatus", text("l_shipdate").substr(1, 10)).cast("binary"))
    return joined.select(
        order.alias("_ord"),
        F.col("c_name").alias("artist"), F.concat("p_name", suffix).alias("song_name"), F.concat(F.lit("Order "), text("o_orderkey")).alias("album_name"),
        F.when(kind == "track", text("l_linenumber")).otherwise("").alias("track_position"), kind.alias("row_type"),
        F.when(F.col("o_orderstatus") == "P", "compilation").when(F.col("o_orderstatus") == "F", "original").otherwise("live").alias("release_category"),
        F.when(F.col("l_linestatus") == "F", "remaster").otherwise("standard").alias("edition_type"), F.lit("").alias("version_type"),
        F.substring(text("o_orderdate"), F.lit(1), length).alias("release_date"), F.col("p_brand").alias("label"), era.alias("era"), F.col("p_type").alias("genre"),
        F.when(key % 7 == 0, text("l_suppkey")).otherwise("").alias("chart_position"), F.when(key % 17 == 0, "award").otherwise("").alias("awards"),
        F.when(key % 3 == 0, F.concat(F.lit("https://open.spotify.com/track/"), text("l_partkey"))).otherwise("").alias("spotify_url"),
        F.when(key % 4 == 0, F.concat(F.lit("https://youtu.be/"), text("l_partkey"))).otherwise("").alias("youtube_url"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.when(key % 10 == 0, ".5").otherwise("")).alias("duration_seconds"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat_ws(", ", "p_brand", "p_type")).otherwise("").alias("alternative_names"),
        F.lit("").alias("source_release_id"), F.lit("").alias("work_id"), F.lit("").alias("version_id"),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("note "), (F.col("l_suppkey") % 5).cast("string"))).otherwise("").alias("notes"),
    ).select("_ord", *schema.FACT)


_ERA = " ".join(f"WHEN year(o_orderdate) - 1995 = {i} THEN '{e}'" for i, e in enumerate(schema.ERAS[:5]))
#: The same view as a common table expression.
DISC = f"""disc AS (
SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT), CAST(round(l_extendedprice * 100) AS BIGINT), l_returnflag, l_linestatus, substr(CAST(l_shipdate AS VARCHAR), 1, 10))) AS _ord,
 c_name AS artist, p_name || CASE l_returnflag WHEN 'A' THEN ' - Remix' WHEN 'R' THEN ' (Live)' ELSE '' END AS song_name, 'Order ' || o_orderkey AS album_name,
 CASE WHEN l_partkey % 11 = 0 OR l_partkey % 13 = 0 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS track_position,
 CASE WHEN l_partkey % 11 = 0 THEN 'album' WHEN l_partkey % 13 = 0 THEN 'single' ELSE 'track' END AS row_type,
 CASE o_orderstatus WHEN 'P' THEN 'compilation' WHEN 'F' THEN 'original' ELSE 'live' END AS release_category,
 CASE l_linestatus WHEN 'F' THEN 'remaster' ELSE 'standard' END AS edition_type, '' AS version_type,
 substr(CAST(o_orderdate AS VARCHAR), 1, CASE o_orderkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) AS release_date, p_brand AS label,
 CASE {_ERA} ELSE '{schema.ERAS[5]}' END AS era, p_type AS genre,
 CASE WHEN l_partkey % 7 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS chart_position, CASE WHEN l_partkey % 17 = 0 THEN 'award' ELSE '' END AS awards,
 CASE WHEN l_partkey % 3 = 0 THEN 'https://open.spotify.com/track/' || l_partkey ELSE '' END AS spotify_url,
 CASE WHEN l_partkey % 4 = 0 THEN 'https://youtu.be/' || l_partkey ELSE '' END AS youtube_url,
 CAST(l_quantity AS INT) || CASE WHEN l_partkey % 10 = 0 THEN '.5' ELSE '' END AS duration_seconds,
 CASE WHEN l_suppkey % 4 = 0 THEN p_brand || ', ' || p_type ELSE '' END AS alternative_names, '' AS source_release_id, '' AS work_id, '' AS version_id,
 CASE WHEN l_suppkey % 3 = 0 THEN 'note ' || (l_suppkey % 5) ELSE '' END AS notes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""
