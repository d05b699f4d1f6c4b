"""Alert stream and its routing to recipients."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weighline import settings as S
from weighline.functions import text as tx
from weighline.operators.slices import sized

COLUMNS = ["mqtt_topic", "topic", "alert_type", "product", "origin_line", "current_line", "batch_instance_id",
           "prev_start", "prev_end", "curr_start", "gap_seconds", "message"]


def all_alerts(returns: DataFrame, stops: DataFrame) -> DataFrame:
    return returns.select(*COLUMNS).unionByName(stops.select(*COLUMNS))


def describe(alerts: DataFrame, zone: str = S.FACTORY_ZONE) -> DataFrame:
    """Display texts of an alert: subject, formatted lines, times, date and gap."""
    return alerts.select(
        *alerts.columns,
        tx.alert_subject(F.col("alert_type"), F.col("topic")).alias("subject"),
        tx.format_line(F.col("origin_line")).alias("origin_text"),
        tx.format_line(F.col("current_line")).alias("current_text"),
        tx.display_time(F.col("prev_start"), zone).alias("prev_start_text"),
        tx.display_time(F.col("prev_end"), zone).alias("prev_end_text"),
        tx.display_time(F.col("curr_start"), zone).alias("curr_start_text"),
        tx.display_date(F.col("curr_start"), zone).alias("date_text"),
        tx.gap_text(F.col("gap_seconds")).alias("gap_text"))


def route_alerts(alerts: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row per alert and recipient with an address.

    Contacts are looked up by ``topic/line``, then by topic, then the default.  A contact entry without addresses
    sends nothing; it does not fall back.
    """
    people = contacts.groupBy("contact_topic").agg(
        F.collect_list(F.struct(F.coalesce("recipient_name", F.lit("")).alias("name"),
                                F.coalesce("recipient_email", F.lit("")).alias("email"))).alias("people"))
    named = people.where("contact_topic is not null")
    default = people.where("contact_topic is null").select(F.col("people").alias("_default"))
    rows = named.count()
    exact = named.select(F.col("contact_topic").alias("topic"), F.col("people").alias("_exact"))
    broad = named.select(F.col("contact_topic").alias("mqtt_topic"), F.col("people").alias("_broad"))
    routed = alerts.join(sized(exact, rows), "topic", "left").join(sized(broad, rows), "mqtt_topic", "left")
    fallback = default.first()
    general = (F.array(*[F.struct(F.lit(p["name"]).alias("name"), F.lit(p["email"]).alias("email"))
                         for p in fallback["_default"]]) if fallback else None)
    found = F.coalesce("_exact", "_broad", general) if general is not None else F.coalesce("_exact", "_broad")
    return (routed.withColumn("_r", F.explode(found)).where("_r.email <> ''")
            .withColumn("recipient_name", F.col("_r.name")).withColumn("recipient_email", F.col("_r.email"))
            .withColumn("subject", tx.alert_subject(F.col("alert_type"), F.col("topic")))
            .drop("_exact", "_broad", "_r"))
