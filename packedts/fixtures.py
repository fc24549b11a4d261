"""Cell tables made from an events table, for tests, queries and the benchmark.

Each event becomes one point. A cell holds the points of one series and hour:

* metric = event type, tag ``bot`` = user id modulo 2
* tag ``circuit`` = ``n/a`` for errors, else 10 + bot
* tag ``sign`` = ``p``, only if bot is 0
* tag ``src`` = ``web``, not for signups
* cells of even bots are packed, those of odd bots are append cells

Cells are also cut every ``BLOCK`` event ids, so that no cell, and no group here,
outgrows a bound however many events fall into one hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packedts.functions.packing import pack_points
from packedts.operators.lookup import lookup
from packedts.schemas import POINT_FAMILY, UID_FAMILY

BLOCK = 3600
SALTS = range(4)
TAG_KEYS = {"bot": 1, "circuit": 2, "sign": 3, "src": 4}
TAG_VALUES = {"0": 1, "1": 2, "10": 3, "11": 4, "n/a": 5, "p": 6, "web": 7}
UNKNOWN_ID = 0x7FFFFF

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def be_bytes(number: Column, size: int) -> Column:
    """A non-negative number as ``size`` big-endian bytes."""
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 2 * size, "0"))


def utc_seconds(ts: str) -> Column:
    """Whole seconds since the epoch of a zone-less UTC timestamp."""
    return F.expr(f"timestampdiff(SECOND, {EPOCH}, cast({ts} as timestamp_ntz))")


def utc_ntz(seconds: Column) -> Column:
    """Zone-less UTC timestamp, whatever the session time zone."""
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def metric_ids(events: DataFrame) -> DataFrame:
    """Ids for the event types that need no numbering pass: the first event's id + 1."""
    return events.groupBy("event_type").agg((F.min("event_id") + 1).alias("metric_id"), F.count("*").alias("_events"))


def with_metric_ids(rows: DataFrame, events: DataFrame) -> DataFrame:
    ids = metric_ids(events).withColumn("_size", F.octet_length("event_type") + 48)
    size = ids.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("n")).first()["n"]
    counts = ids.select("event_type", F.col("_events").alias("n"))
    return lookup(rows, ids.drop("_events", "_size"), ["event_type"], size, counts=counts, spread=["bot", "hour", "block"])


def dictionary_cells(events: DataFrame, id_size: int = 4) -> DataFrame:
    """Dictionary of the metrics and tags, with rows a reader has to skip."""
    spark = events.sparkSession
    fixed = [(name, "tagk", uid) for name, uid in TAG_KEYS.items()]
    fixed += [(name, "tagv", uid) for name, uid in TAG_VALUES.items()]
    tags = spark.createDataFrame(fixed, "name string, kind string, uid bigint")
    entries = tags.unionByName(
        metric_ids(events).select(F.col("event_type").alias("name"), F.lit("metrics").alias("kind"), F.col("metric_id").alias("uid"))
    )
    cells = entries.select(
        F.col("name").cast("binary").alias("row_key"),
        F.lit(UID_FAMILY).alias("family"),
        F.col("kind").cast("binary").alias("qualifier"),
        be_bytes(F.col("uid"), id_size).alias("value"),
        F.lit(1).cast("bigint").alias("version"),
    )
    reverse = cells.withColumn("family", F.lit(b"name")).withColumn("row_key", F.col("value"))
    highest = cells.groupBy("family", "qualifier").agg(F.max("value").alias("value"), F.max("version").alias("version"))
    highest = highest.withColumn("row_key", F.lit(b"\x00"))
    return cells.unionByName(reverse).unionByName(highest)


def _tag(key: str, value: Column | str, id_size: int) -> Column:
    value_id = F.lit(TAG_VALUES[value]) if isinstance(value, str) else value
    return F.concat(be_bytes(F.lit(TAG_KEYS[key]), id_size), be_bytes(value_id, id_size))


def row_key(id_size: int) -> Column:
    """Row key of the columns ``event_type, metric_id, bot, hour``."""
    nothing = F.lit(b"")
    error = F.col("event_type") == "error"
    return F.concat(
        be_bytes((F.col("metric_id") + F.col("bot")) % len(SALTS), 1),
        be_bytes(F.col("metric_id"), id_size),
        be_bytes(F.col("hour"), 4),
        _tag("bot", F.col("bot") + 1, id_size),
        F.when(error, _tag("circuit", "n/a", id_size)).otherwise(_tag("circuit", F.col("bot") + 3, id_size)),
        F.when(F.col("bot") == 0, _tag("sign", "p", id_size)).otherwise(nothing),
        F.when(F.col("event_type") != "signup", _tag("src", "web", id_size)).otherwise(nothing),
    )


def event_cells(events: DataFrame, *, id_size: int = 4, encoding: str = "float64", value: Column | None = None) -> DataFrame:
    """Cells of the events, with the ``day`` of each cell."""
    value = F.col("value") if value is None else value
    seconds = events.select(
        "event_id",
        "event_type",
        (F.col("user_id") % 2).alias("bot"),
        utc_seconds("ts").alias("second"),
        F.floor(F.col("event_id") / BLOCK).alias("block"),
        value.cast("double").alias("value"),
    ).withColumn("hour", F.col("second") - F.col("second") % 3600)
    groups = seconds.groupBy("event_type", "bot", "hour", "block").agg(
        F.max("event_id").alias("version"),
        F.sort_array(F.collect_list(F.struct((F.col("second") - F.col("hour")).cast("int").alias("offset"), "event_id", "value"))).alias("points"),
    )
    points = F.transform("points", lambda p: F.struct(p["offset"].alias("offset"), p["value"].alias("value")))
    return (
        with_metric_ids(groups, events)
        .withColumn("packed", pack_points(points, F.col("bot") == 1, encoding))
        .select(
            row_key(id_size).alias("row_key"),
            F.lit(POINT_FAMILY).alias("family"),
            F.col("packed.qualifier").alias("qualifier"),
            F.col("packed.value").alias("value"),
            "version",
            F.date_from_unix_date((F.col("hour") / 86400).cast("int")).alias("day"),
        )
    )


DENSE_EVENTS, DENSE_POINTS = 60, 60
DENSE_START = 1_704_067_200  # 2024-01-01


def dense_cells(events: DataFrame, *, append: bool = False) -> DataFrame:
    """Cells of 3600 points: 60 for each of 60 neighbouring events, whole numbers of all widths.

    Packed cells have a point each second of their hour; append cells reach offsets past it.
    Cell b holds the events from 60 b on; it is of the least type among them, of bot b % 2 and of hour b.
    """
    step = 68 if append else DENSE_POINTS  # 59 * 68 + 59 = 4071 fits the 12 offset bits
    scales = F.array(*(F.lit(s) for s in (1, -100, 10_000, -1_000_000_000)))

    def point(event: Column, k: Column) -> Column:
        scale = F.element_at(scales, ((event + k) % 4 + 1).cast("int"))
        return F.struct(
            (event % DENSE_EVENTS * step + k).cast("int").alias("offset"),
            (scale.cast("long") * (event % 100 + k)).cast("double").alias("value"),
        )

    # the events of a cell are gathered, not their points, which are many times as large; in structs, as lists drop nulls
    groups = events.groupBy(F.floor(F.col("event_id") / DENSE_EVENTS).alias("block")).agg(
        F.min("event_type").alias("event_type"), F.max("event_id").alias("version"), F.collect_list(F.struct("event_id")).alias("events")
    )
    places = F.sequence(F.lit(0), F.size("events") * DENSE_POINTS - 1)
    points = F.transform(places, lambda n: point(F.col("events")[F.floor(n / DENSE_POINTS).cast("int")]["event_id"], n % DENSE_POINTS))
    groups = groups.withColumns({"bot": F.col("block") % 2, "hour": F.lit(DENSE_START) + 3600 * F.col("block")})
    return (
        with_metric_ids(groups, events)
        .withColumn("packed", pack_points(F.sort_array(points), F.lit(append), "int"))
        .select(
            row_key(4).alias("row_key"),
            F.lit(POINT_FAMILY).alias("family"),
            F.col("packed.qualifier").alias("qualifier"),
            F.col("packed.value").alias("value"),
            "version",
            F.date_from_unix_date((F.col("hour") / 86400).cast("int")).alias("day"),
        )
    )


def with_bystanders(cells: DataFrame) -> DataFrame:
    """Add cells that hold no points: annotations, and another column family."""
    annotations = cells.filter(F.col("version") % 5 == 0)
    annotations = annotations.withColumn("qualifier", F.lit(b"\x01\x00\x00")).withColumn("value", F.lit(b"{}"))
    foreign = cells.filter(F.col("version") % 7 == 0)
    foreign = foreign.withColumn("family", F.lit(b"m")).withColumn("qualifier", F.lit(b"\x00\x00"))
    return cells.unionByName(annotations).unionByName(foreign)


def with_faults(cells: DataFrame, id_size: int = 4) -> DataFrame:
    """Damage nine cells of ten, in a way that follows from the cell's version."""
    fault = F.col("version") % 10
    key, qualifier, value = F.col("row_key"), F.col("qualifier"), F.col("value")
    append = qualifier == F.lit(b"\x05\x00\x00")
    unknown = be_bytes(F.lit(UNKNOWN_ID), id_size)

    def from_byte(column: Column, start: int) -> Column:
        return F.substring(column, F.lit(start), F.octet_length(column))

    def first_point(header: bytes) -> tuple[Column, Column]:
        def swapped(column: Column) -> Column:
            return F.concat(F.lit(header), from_byte(column, 3))

        return F.when(append, qualifier).otherwise(swapped(qualifier)), F.when(append, swapped(value)).otherwise(value)

    far_qualifier, far_value = first_point(b"\xf0\x0f")
    odd_qualifier, odd_value = first_point(b"\x00\x02")
    return cells.withColumns(
        {
            "row_key": F.when(fault == 1, F.substring(key, F.lit(1), F.octet_length(key) - 1))
            .when(fault == 2, F.concat(F.substring(key, 1, 1), unknown, from_byte(key, 2 + id_size)))
            .when(fault == 3, F.concat(key, be_bytes(F.lit(1), id_size), unknown))
            .when(fault == 4, F.concat(key, unknown, be_bytes(F.lit(1), id_size)))
            .otherwise(key),
            "qualifier": F.when(fault == 0, F.concat(qualifier, F.when(append, F.lit(bytes(8))).otherwise(F.lit(bytes(7)))))
            .when(fault == 7, far_qualifier)
            .when(fault == 8, odd_qualifier)
            .otherwise(qualifier),
            "value": F.when(fault == 5, F.substring(value, F.lit(1), F.octet_length(value) - 1))
            .when(fault == 6, F.concat(value, F.lit(b"\x01")))
            .when(fault == 7, far_value)
            .when(fault == 8, odd_value)
            .otherwise(value),
        }
    )


def write_cells(cells: DataFrame, path: str) -> None:
    """Store cells as an archive does: one folder per day, sorted by row key."""
    rows = cells.repartitionByRange("day", "row_key", "version").sortWithinPartitions("day", "row_key", "version")
    rows.write.partitionBy("day").parquet(path)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")

