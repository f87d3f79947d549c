"""From free-text requests and role lists to search urls and schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.fixed_values import (
    ACTIVE_RUN_STATES,
    BOARDS,
    DEFAULT_LOCATION,
    JOB_SIGNALS,
    REMOTE_CAPABLE_BOARDS,
    REMOTE_LOCATION,
)
from postloom.functions.text import clean_text, contains_any, strip, title_case
from postloom.functions.urls import url_quote

# --- requests ------------------------------------------------------------------


def normalized(text: Column) -> Column:
    return clean_text(F.lower(text))


def role_of_query(query: Column, roles: list[str]) -> Column:
    """First configured role, in list order, whose words occur in the query; else null."""
    text = normalized(query)
    named = [(" ".join(r.lower().split()), r) for r in roles]
    tests = [F.when(F.contains(text, F.lit(n)), F.lit(r)) for n, r in named if n]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def allowed_roles(asked: DataFrame, permitted: DataFrame) -> DataFrame:
    """(role, ord) of the asked roles that are permitted, in configured spelling.

    Inputs are (role, ord).  Of permitted spellings that read the same the last
    counts; a role asked for twice keeps its first place.
    """
    key = normalized(F.col("role"))
    spelled = (
        permitted.filter(key != "")
        .groupBy(key.alias("_key"))
        .agg(F.max_by("role", "ord").alias("role"))
    )
    wanted = asked.groupBy(key.alias("_key")).agg(F.min("ord").alias("ord"))
    return wanted.join(spelled, "_key").groupBy("role").agg(F.min("ord").alias("ord"))


def has_job_intent(query: Column) -> Column:
    """Any of the signal words occurs anywhere in the query."""
    return contains_any(F.lower(F.coalesce(query, F.lit(""))), JOB_SIGNALS)


def query_location(query: Column) -> Column:
    """The piece after the first " in ", in title case; the default country without one."""
    parts = F.split(F.lower(query), " in ")
    return F.when(F.size(parts) > 1, title_case(strip(F.get(parts, F.lit(1))))).otherwise(DEFAULT_LOCATION)


def search_requests(requests: DataFrame, roles: list[str]) -> DataFrame:
    """Requests with job intent and a permitted role, as (request_id, role, location)."""
    query = F.col("search_query")
    return (
        requests.filter(has_job_intent(query))
        .select("request_id", role_of_query(query, roles).alias("role"), query_location(query).alias("location"))
        .filter(F.col("role").isNotNull())
    )


def title_matches_query(title: Column, query: Column) -> Column:
    """The title shares a word with the query; an empty query matches everything."""
    def words(text: Column) -> Column:
        return F.array_remove(F.split(normalized(text), " "), "")

    return (F.coalesce(query, F.lit("")) == "") | F.arrays_overlap(words(title), words(query))


# --- search plan -----------------------------------------------------------------


def search_plan(roles: DataFrame, remote_roles: list[str], boards: list[str] = BOARDS) -> DataFrame:
    """(role, board, location): every board, then a remote pass for listed roles on two boards."""
    remote = sorted({r.strip().lower() for r in remote_roles})
    here = F.array(*[F.struct(F.lit(b).alias("board"), F.lit(DEFAULT_LOCATION).alias("location")) for b in boards])
    away_boards = [b for b in boards if b in REMOTE_CAPABLE_BOARDS]
    away = F.array(
        *[F.struct(F.lit(b).alias("board"), F.lit(REMOTE_LOCATION).alias("location")) for b in away_boards]
    )
    searches = here
    if away_boards and remote:
        searches = F.when(F.lower(strip(F.col("role"))).isin(remote), F.concat(here, away)).otherwise(here)
    return roles.select("role", F.posexplode(searches).alias("ord", "s")).select("role", "ord", "s.board", "s.location")


def search_url(board: Column, query: Column, location: Column, page: Column) -> Column:
    """Listing url of one result page on a board."""
    q, place = url_quote(query), url_quote(location)
    remote = F.lower(strip(location)) == "remote"
    start25, start10 = ((page - 1) * 25).cast("string"), (page - 1) * 10
    numbered = F.when(page > 1, page.cast("string"))
    linkedin = F.concat(
        F.lit("https://www.linkedin.com/jobs/search/?keywords="), q, F.lit("&location="),
        F.when(remote, "Worldwide").otherwise(place), F.lit("&start="), start25,
        F.when(remote, "&f_WT=2").otherwise(""),
    )
    indeed = F.concat(
        F.lit("https://pk.indeed.com/jobs?q="), q, F.lit("&l="), place,
        F.when(start10 > 0, F.concat(F.lit("&start="), start10.cast("string"))).otherwise(""),
    )
    rozee = F.concat(
        F.lit("https://www.rozee.pk/job/jsearch/q/"), q,
        F.when(location != "", F.concat(F.lit("/lc/"), place)).otherwise(""),
        F.coalesce(F.concat(F.lit("/page/"), numbered), F.lit("")),
    )
    mustakbil = F.concat(
        F.lit("https://www.mustakbil.com/jobs/search?keywords="), q, F.lit("&location="),
        F.when(location != "", place).otherwise(DEFAULT_LOCATION),
        F.coalesce(F.concat(F.lit("&page="), numbered), F.lit("")),
    )
    return (
        F.when(board == "linkedin", linkedin)
        .when(board == "indeed", indeed)
        .when(board == "rozee", rozee)
        .when(board == "mustakbil", mustakbil)
    )


def pane_url(query: Column, location: Column, job_key: Column, page: Column) -> Column:
    """Results page with one posting's pane open; '' without a key."""
    start = (page - 1) * 10
    return F.when(
        F.coalesce(job_key, F.lit("")) != "",
        F.concat(
            F.lit("https://pk.indeed.com/jobs?q="), url_quote(F.coalesce(query, F.lit(""))), F.lit("&l="),
            url_quote(F.when(location != "", location).otherwise(DEFAULT_LOCATION)),
            F.lit("&vjk="), job_key,
            F.when(start > 0, F.concat(F.lit("&start="), start.cast("string"))).otherwise(""),
        ),
    ).otherwise("")


def search_urls(plan: DataFrame, pages: int) -> DataFrame:
    """One row per plan row and result page."""
    page = F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page")
    return plan.select("*", page).withColumn(
        "url", search_url(F.col("board"), F.col("role"), F.col("location"), F.col("page"))
    )


# --- schedule ----------------------------------------------------------------------


def uncovered_hours(runs: DataFrame) -> DataFrame:
    """Hours of the log's span in which no successful and no active run started."""
    hour = F.date_trunc("hour", F.col("run_started_at"))
    span = runs.agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    spine = span.select(F.explode(F.expr("sequence(a, b, INTERVAL '1' HOUR)")).alias("hour"))
    covered = runs.filter(
        (F.col("conclusion") == "success") | F.col("status").isin(ACTIVE_RUN_STATES)
    ).select(hour.alias("hour")).distinct()
    return spine.join(covered, "hour", "left_anti")


def may_start(runs: DataFrame, asking: DataFrame) -> DataFrame:
    """For each asking run (id, now): may it start?

    No while any other run is active, or when another run that started in the same UTC
    hour succeeded.  Hourly and overall counts are joined, minus the asker's own part.
    """
    active = F.col("status").isin(ACTIVE_RUN_STATES)
    success = F.coalesce(F.col("conclusion") == "success", F.lit(False)) & ~active
    hour = F.date_trunc("hour", F.col("run_started_at"))
    per_hour = runs.filter(success).groupBy(hour.alias("hour")).agg(F.count("*").alias("_wins"))
    own = runs.groupBy("id").agg(
        F.count_if(active).alias("_own_active"),
        F.max(F.when(success, hour)).alias("_own_hour"),
        F.count_if(success).alias("_own_wins"),
    )
    total = runs.agg(F.count_if(active).alias("n")).scalar()
    joined = (
        asking.withColumn("hour", F.date_trunc("hour", F.col("now")))
        .join(per_hour, "hour", "left")
        .join(own, "id", "left")
    )
    other_active = total - F.coalesce("_own_active", F.lit(0))
    own_wins = F.when(F.col("_own_hour") == F.col("hour"), F.col("_own_wins")).otherwise(0)
    other_wins = F.coalesce("_wins", F.lit(0)) - own_wins
    return joined.select(*asking.columns, ((other_active == 0) & (other_wins == 0)).alias("may_start"))


def hour_slot(at: Column) -> Column:
    """``struct<slot, board, role_set>`` that the UTC hour of a time serves."""
    slot = F.hour(at) % 4
    return F.struct(
        slot.alias("slot"),
        F.when(slot % 2 == 0, "linkedin").otherwise("indeed").alias("board"),
        F.when(slot < 2, 1).otherwise(2).alias("role_set"),
    )


def union_boards(parts: list[DataFrame]) -> DataFrame:
    """All boards' rows as one frame."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
