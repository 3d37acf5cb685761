"""Schemas of the engine's tables, by name; reads never infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "venues": "venue_id string, name string, category string, website string, city string, county string, state string, address string, facebook string, instagram string, upscale_score double, zone_priority string, status string, source string, scraped_date timestamp, notes string, distance_miles double, drive_minutes double, contacted_date timestamp, contact_form string, linkedin_pending boolean, venue_vote string, venue_feedback string, check_status string, _ord bigint",
    "contacts": "contact_id string, venue_id string, name string, title string, email string, source string, verified string, verified_date timestamp, email_sent string, email_sent_date timestamp, ig_dm_sent string, fb_msg_sent string, _ord bigint",
    "outreach": "sent_at timestamp, venue_id string, contact_id string, channel string, template_used string, _ord bigint",
    "gigs": "gig_id string, venue_id string, venue_name string, date string, category string, rating_tips double, rating_rebooked double, rating_audience double, rating_venue_quality double, overall double, notes string, distance_miles double, _ord bigint",
    "config": "key string, value string, _ord bigint",
    "templates": "category string, subject string, body string, _ord bigint",
    "taste": "type string, key string, value string",
    "cache": "email string, status string, sub_status string, verified_at timestamp, source string",
    "usage": "used_at timestamp, usage_date date, run_id string, email string, status string, source string",
    "inflight": "email string, reserved_at timestamp, run_id string",
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def create(spark: SparkSession, folder: str) -> None:
    """Empty Parquet tables of every schema under a folder."""
    for name in SCHEMAS:
        empty(spark, name).write.parquet(f"{folder}/{name}.parquet")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
