"""Vehicle reports: flattening, alarms by rules, trip distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.geo import ellipsoid, haversine
from marketlens.operators.ordered import previous_row

# Fields lifted out of a position message.
POSITION_FIELDS = ["vec1", "vec2", "vec3", "encrypy", "altitude", "state", "lon", "lat", "msgId", "direction", "dateTime"]
REPORT_SCHEMA = (
    "vehicleno string, upexgmsgreallocation struct<"
    + ", ".join(f"{f}: string" for f in POSITION_FIELDS)
    + ", alarm: struct<emergencyAlarm: int>>, upexgmsgregister struct<platform: string>"
)
REGISTER_DAY = "99991231"


def flatten_vehicle(reports: DataFrame, line: str = "line") -> DataFrame:
    """Position fields as top-level text (empty when missing), day, and epoch ms at GMT+8."""
    p = reports.withColumn("_r", F.from_json(line, REPORT_SCHEMA)).withColumn("_p", F.col("_r.upexgmsgreallocation"))
    when = F.col("_p.dateTime")
    stamp = F.try_to_timestamp(F.concat(when, F.lit("+0800")), F.lit("yyyyMMddHHmmssZ"))
    registered = F.col("_r.upexgmsgregister").isNotNull()
    located = F.col("_p").isNotNull()
    return p.select(
        "id", F.col("_r.vehicleno").alias("vehicleno"),
        *[F.when(located, F.coalesce(F.col(f"_p.{f}"), F.lit(""))).alias(f) for f in POSITION_FIELDS],
        F.col("_p.alarm.emergencyAlarm").cast("long").alias("emergency_alarm"), F.when(located, "r").alias("op"),
        F.when(registered, REGISTER_DAY).when(located & (F.length(when) >= 8), F.substring(when, 1, 8)).otherwise("").alias("ds"),
        F.when(located, F.when(F.length(when) == 14, F.coalesce(F.unix_millis(stamp), F.lit(0))).otherwise(0)).cast("long").alias("ts"))


def vehicle_alarms(reports: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per report and rule kind that hits: emergency flag set, or plate on the watch list."""
    flag_rule = rules.where("rule_type = '1'").select(F.count(F.lit(1)) > 0).scalar()
    flagged = reports.where((F.col("emergency_alarm") == 1) & flag_rule).select("id", "vehicleno", F.lit("emergency").alias("alarm_kind"))
    plates = rules.where("rule_type = '2' and vehicleno is not null").select("vehicleno").distinct()
    listed = reports.join(plates, "vehicleno", "left_semi").select("id", "vehicleno", F.lit("vehicleno").alias("alarm_kind"))
    return flagged.unionByName(listed)


def trip_distance(fixes: DataFrame, method: str = "haversine", idle_m: float = 1000.0, jump_m: float = 80_000.0) -> DataFrame:
    """Metres driven per vehicle and day, with fixes that hardly moved and fixes that jumped.

    A vehicle's first fix of all has moved 0 m and counts neither as idle nor as a jump. Fixes
    without a readable time are left out.
    """
    rows = fixes.select("vehicleno", "id", "lon", "lat", "dateTime", F.substring("dateTime", 1, 8).alias("day"),
                        F.unix_millis(F.try_to_timestamp("dateTime", F.lit("yyyyMMddHHmmss"))).alias("ms")).where("ms is not null")
    back = previous_row(rows, ["vehicleno"], "ms", "id", ["lon", "lat"])
    measure = haversine if method == "haversine" else ellipsoid
    moved = back.withColumn("metres", F.when(F.col("prev").isNotNull(), measure(
        F.coalesce("prev.lon", "lon"), F.coalesce("prev.lat", "lat"), F.col("lon"), F.col("lat"))))
    return moved.groupBy("vehicleno", "day").agg(
        F.round(F.coalesce(F.sum("metres"), F.lit(0.0)), 0).alias("distance_m"), F.count_if(F.col("metres") > jump_m).alias("jumps"),
        F.count_if(F.col("metres") < idle_m).alias("idle_fixes"))
