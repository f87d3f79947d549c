"""Read queries over the stored and the user-side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.arrivals import with_sessions
from postloom.operators.groups import blocks_of, running, top_per_group


def newest_first() -> list[Column]:
    """Nulls first when descending, as the store sorts them."""
    return [F.col("posted_at").desc_nulls_first(), F.col("date_scrapped").desc_nulls_first()]


def search_jobs(jobs: DataFrame, skills: list[str] | None, location: str | None, limit: int = 50) -> DataFrame:
    """Rows that carry every skill and whose location matches, newest first.

    '%' and '_' in ``location`` are wildcards.  ``job_id`` settles ties.
    """
    if skills:
        wanted = F.array(*[F.lit(s) for s in skills])
        jobs = jobs.filter(F.size(F.array_except(wanted, "skills_required")) == 0)
    if location:
        jobs = jobs.filter(F.col("location").ilike(f"%{location}%"))
    return jobs.orderBy(*newest_first(), "job_id").limit(limit)


def skill_lists(jobs: DataFrame) -> DataFrame:
    """(skill, job_id): the inverted list of the stored rows' skills."""
    return jobs.select(F.explode("skills_required").alias("skill"), "job_id").distinct()


def _list_bucket(skill: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(skill), F.lit(buckets)).cast("int")


def write_skill_lists(lists: DataFrame, path: str, buckets: int) -> None:
    """The lists in folders by skill, each sorted, so that a search reads the asked skills' row groups alone.

    Rebalanced: the list of a skill that most rows carry is split over tasks and files.
    """
    placed = lists.withColumn("bucket", _list_bucket(F.col("skill"), buckets))
    placed.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "skill").write.partitionBy("bucket").parquet(path)


def merge_skill_lists(lists: DataFrame, changed: DataFrame) -> DataFrame:
    """The lists after the rows of ``changed`` (one per job_id) were merged into the stored ones."""
    columns = ["skill", "job_id"]
    kept = lists.select(*columns).join(changed.select("job_id"), "job_id", "left_anti").select(*columns)
    return kept.unionByName(skill_lists(changed).select(*columns))


def search_lists(lists: DataFrame, jobs: DataFrame, skills: list[str], location: str | None, limit: int = 50, *, buckets: int) -> DataFrame:
    """As ``search_jobs``, by intersecting the asked skills' lists; only their folders are read of them."""
    asked = list(dict.fromkeys(skills))
    if not asked:
        return search_jobs(jobs, None, location, limit)
    folders = [_list_bucket(F.lit(s), buckets) for s in asked]
    found = lists.filter(F.col("bucket").isin(*folders) & F.col("skill").isin(asked))
    carry_all = found.groupBy("job_id").agg(F.count("*").alias("n")).filter(F.col("n") == len(asked))
    return search_jobs(jobs.join(carry_all.select("job_id"), "job_id", "left_semi"), None, location, limit)


def title_matches(title: Column, roles: list[str]) -> Column:
    found = F.lit(False)
    for role in roles:
        found = found | title.ilike(f"%{role.strip()}%")
    return found


def permitted_roles(asked: list[str], configured: list[str]) -> list[str]:
    """The asked roles that are configured, each once, in the configured spelling."""
    spelling = {" ".join(r.lower().split()): r for r in configured}
    found = [spelling.get(" ".join(r.lower().split())) for r in asked]
    return list(dict.fromkeys(r for r in found if r))


def jobs_for_roles(
    jobs: DataFrame, roles: list[str], offset: int = 0, limit: int = 50, *, configured: list[str] | None = None
) -> DataFrame:
    """A page of the rows whose title matches any of the roles.

    With ``configured``, only roles of that list count; asking for others gives nothing.
    """
    if configured is not None:
        roles = permitted_roles(roles, configured)
    return page(jobs.filter(title_matches(F.col("job_title"), roles)), offset, limit)


def page(jobs: DataFrame, offset: int, limit: int) -> DataFrame:
    """Stable page by key; with a limit Spark keeps only offset + limit rows per task."""
    return jobs.orderBy("job_id").offset(offset).limit(limit)


def page_after(jobs: DataFrame, last_id: str, limit: int) -> DataFrame:
    """The next page by key: deep pages cost no more than the first."""
    return jobs.filter(F.col("job_id") > last_id).orderBy("job_id").limit(limit)


def applications_with_jobs(applications: DataFrame, jobs: DataFrame, limit: int = 50) -> DataFrame:
    """Newest applications per user, each with its job as a struct (null when it is gone)."""
    newest = recent_applications(applications, limit)
    right = jobs.select(F.col("job_id").alias("_id"), F.struct(*jobs.columns).alias("job"))
    return newest.join(right, F.col("job_id") == F.col("_id"), "left").drop("_id")


def recent_applications(applications: DataFrame, limit: int = 50) -> DataFrame:
    order = [F.col("created_at").desc(), F.col("application_id").desc()]
    return top_per_group(applications, ["user_id"], order, limit)


def profiles_with_scores(profiles: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per profile and quiz score, the score as a struct; one row with null for a profile without any.

    The long form has one shape for every number of scores, and one join that may be
    split where a user has many.
    """
    entry = F.struct(*[c for c in scores.columns if c != "user_id"]).alias("quiz_score")
    return profiles.join(scores.select("user_id", entry), "user_id", "left")


def resume_versions(resumes: DataFrame, existing: DataFrame | None, order: list[Column]) -> DataFrame:
    """Number new resumes per user from the highest existing version + 1."""
    numbered = running(resumes, ["user_id"], order, blocks_of(resumes, ["user_id"], order), sums={"version": F.lit(1)})
    if existing is None:
        return numbered
    last = existing.groupBy("user_id").agg(F.max("version").alias("_last"))
    return (
        numbered.join(last, "user_id", "left")
        .withColumn("version", F.col("version") + F.coalesce("_last", F.lit(0)))
        .drop("_last")
    )


def vetted_since(vetted: DataFrame, since: int, order: list[Column]) -> DataFrame:
    """Each user's vetted rows from list index ``since`` on (0 is the oldest)."""
    indexed = running(vetted, ["user_id"], order, blocks_of(vetted, ["user_id"], order), sums={"idx": F.lit(1)}, before=True)
    return indexed.filter(F.col("idx") >= since)


def vetted_live(vetted: DataFrame, at: str, now: Column, ttl: str, since: int, order: list[Column]) -> DataFrame:
    """As ``vetted_since``, of the lists that are alive at ``now``.

    A user's list ends ``ttl`` after its last row and starts anew with the next one, so only
    the rows of the last lifetime count, if it has not ended by ``now``.
    """
    past = vetted.filter(F.col(at) <= now)
    lived = with_sessions(past, at, ttl, owners=["user_id"])
    last = lived.groupBy("user_id").agg(F.max("session").alias("_session"), F.max(at).alias("_last"))
    alive = last.filter(F.col("_last") + F.expr(f"INTERVAL {ttl}") > now)
    rows = lived.join(alive, "user_id").filter(F.col("session") == F.col("_session")).select(*vetted.columns)
    return vetted_since(rows, since, order)


def vetted_counts(vetted: DataFrame) -> DataFrame:
    return vetted.groupBy("user_id").agg(F.count("*").alias("n"))
