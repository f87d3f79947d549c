"""Change feeds applied to the user-side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.groups import top_per_group
from postloom.sources.tables import merge_by_key

PROFILE_TEXTS = [
    "name", "email", "phone", "location", "summary", "github", "linkedin", "portfolio",
    "profile_picture_url",
]
PROFILE_LISTS = [
    "skills", "previous_roles", "projects", "certificates", "education", "experience",
    "recommended_roles",
]


def upsert_profiles(current: DataFrame, changes: DataFrame, order: list[Column], now: Column) -> DataFrame:
    """The newest change per user replaces the stored profile; absent lists are [], absent years 0."""
    def given(name: str, kind: str) -> Column:
        return F.col(name) if name in changes.columns else F.lit(None).cast(kind)

    no_list = F.array().cast("array<string>")
    latest = top_per_group(changes, ["user_id"], order)
    rows = latest.select(
        "user_id",
        *[given(c, "string").alias(c) for c in PROFILE_TEXTS],
        *[F.coalesce(given(c, "array<string>"), no_list).alias(c) for c in PROFILE_LISTS],
        F.coalesce(given("years_of_experience", "int"), F.lit(0)).alias("years_of_experience"),
        now.alias("updated_at"),
    )
    return merge_by_key(current, rows, "user_id")


def new_applications(requests: DataFrame, now: Column) -> DataFrame:
    """Application rows to append, status pending."""
    return requests.withColumns({"status": F.lit("pending"), "created_at": now})


def update_status(applications: DataFrame, changes: DataFrame, order: list[Column], now: Column) -> DataFrame:
    """The newest change per application sets status, and applied_at only where one is given."""
    # applied_at of an earlier change survives a later one without it.
    applied = changes.filter(F.col("applied_at").isNotNull())
    last_applied = top_per_group(applied, ["application_id"], order).select(
        "application_id", F.col("applied_at").alias("_applied_at")
    )
    latest = top_per_group(changes, ["application_id"], order).select(
        "application_id", F.col("status").alias("_status")
    )
    hit = F.col("_status").isNotNull()
    return (
        applications.join(latest, "application_id", "left")
        .join(last_applied, "application_id", "left")
        .withColumns(
            {
                "status": F.coalesce("_status", "status"),
                "applied_at": F.coalesce("_applied_at", "applied_at"),
                "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
            }
        )
        .select(*applications.columns)
    )


def save_drafts(applications: DataFrame, drafts: DataFrame, order: list[Column], now: Column) -> DataFrame:
    """Drafts in their order: status draft, the last material given, each template noted once.

    Several drafts of one application act like one after the other and leave one row.
    """
    place = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])

    def last(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), place))

    named = F.when(F.coalesce("template_name", F.lit("")) != "", F.struct(place.alias("at"), F.col("template_name").alias("name")))
    given = drafts.groupBy("application_id").agg(
        last("optimized_resume").alias("_resume"),
        last("optimized_cover_letter").alias("_letter"),
        F.transform(F.sort_array(F.collect_list(named)), lambda t: t["name"]).alias("_templates"),
        F.lit(True).alias("_hit"),
    )

    def add(note: Column, template: Column) -> Column:
        line = F.concat(F.lit("Template: "), template)
        return F.when(F.contains(F.coalesce(note, F.lit("")), line), note).otherwise(
            F.btrim(F.concat(F.coalesce(note, F.lit("")), F.lit("\n"), line), F.lit(" \t\r\n"))
        )

    no_template = F.array().cast("array<string>")
    noted = F.aggregate(F.coalesce("_templates", no_template), F.col("reasoning_note"), add)
    return (
        applications.join(given, "application_id", "left")
        .withColumns(
            {
                "status": F.when(F.col("_hit"), "draft").otherwise(F.col("status")),
                "optimized_resume_url": F.coalesce("_resume", "optimized_resume_url"),
                "optimized_cover_letter": F.coalesce("_letter", "optimized_cover_letter"),
                "reasoning_note": noted,
                "updated_at": F.when(F.col("_hit"), now).otherwise(F.col("updated_at")),
            }
        )
        .select(*applications.columns)
    )
