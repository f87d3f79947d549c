"""Read queries, change feeds, plans, schedules, and rows in arrival order."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.catalog import sql as S
from postloom.catalog.fixtures import view, with_views
from postloom.catalog.q_tables import seen_rows, stored_rows
from postloom.catalog.q_text import POSTED, now, posting_rows
from postloom.catalog.registry import ORACLES, query
from postloom.functions.urls import indeed_key
from postloom.operators import arrivals, feeds, report, serve
from postloom.plans import search
from postloom.session import keyed_state, work_folder
from postloom.streaming import stateful

STORED = ("stored_jobs",)
USERS = ("applications",)
LOG = ("fetch_log",)

# --- search --------------------------------------------------------------------------

_NEWEST = "posted_at DESC NULLS FIRST, date_scrapped DESC NULLS FIRST, job_id"


@query(
    "search_jobs",
    with_views(
        f"SELECT job_id, job_title, posted_at, date_scrapped FROM stored_jobs WHERE list_has_all(string_split(skills_csv, ','), ['Python', 'SQL']) AND location ILIKE '%laho_e%' ORDER BY {_NEWEST} LIMIT 50",
        *STORED,
    ),
)
def search_jobs(spark, sf_dir):
    found = serve.search_jobs(stored_rows(spark, sf_dir), ["Python", "SQL"], "laho_e", 50)
    return found.select("job_id", "job_title", "posted_at", "date_scrapped")


@query("search_lists", ORACLES["search_jobs"])
def search_lists(spark, sf_dir):
    """The same by the skills' inverted lists."""
    jobs, path = stored_rows(spark, sf_dir), work_folder(spark, "lists")
    serve.write_skill_lists(serve.skill_lists(jobs), path, 16)
    found = serve.search_lists(spark.read.parquet(path), jobs, ["Python", "SQL"], "laho_e", 50, buckets=16)
    return found.select("job_id", "job_title", "posted_at", "date_scrapped")


_ANY_ROLE = "(" + " OR ".join(f"job_title ILIKE '%{r}%'" for r in ("data engineer", "Backend Developer")) + ")"


@query("jobs_outside_roles", with_views("SELECT job_id, job_title FROM stored_jobs WHERE false", *STORED))
def jobs_outside_roles(spark, sf_dir):
    """Asking only for roles that are not configured gives nothing."""
    found = serve.jobs_for_roles(stored_rows(spark, sf_dir), ["Backend", "developer"], configured=["Backend Developer"])
    return found.select("job_id", "job_title")


@query("jobs_for_roles", with_views(f"SELECT job_id, job_title FROM stored_jobs WHERE {_ANY_ROLE} ORDER BY job_id LIMIT 50 OFFSET 100", *STORED))
def jobs_for_roles(spark, sf_dir):
    found = serve.jobs_for_roles(stored_rows(spark, sf_dir), ["DATA  engineer", "Backend Developer", "Backend"], 100, 50, configured=["Data Engineer", "Backend Developer", "Tester"])
    return found.select("job_id", "job_title")


@query("title_role_matches", with_views(f"SELECT job_id, job_title FROM stored_jobs WHERE {_ANY_ROLE}", *STORED))
def title_role_matches(spark, sf_dir):
    jobs = stored_rows(spark, sf_dir)
    return jobs.filter(serve.title_matches(F.col("job_title"), ["data engineer", "Backend Developer"])).select("job_id", "job_title")


@query("page_of_jobs", with_views("SELECT job_id, job_title FROM stored_jobs ORDER BY job_id LIMIT 100 OFFSET 200", *STORED))
def page_of_jobs(spark, sf_dir):
    return serve.page(stored_rows(spark, sf_dir), 200, 100).select("job_id", "job_title")


# --- users -------------------------------------------------------------------------------

_NEWEST_APPLICATIONS = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, application_id DESC) <= 5"


@query("recent_applications", with_views(f"SELECT * FROM applications {_NEWEST_APPLICATIONS}", *USERS))
def recent_applications(spark, sf_dir):
    return serve.recent_applications(view(spark, sf_dir, "applications"), 5)


@query(
    "applications_with_jobs",
    with_views(
        f"""SELECT a.application_id, a.user_id, a.job_id, a.status, a.created_at, s.job_title, s.company
        FROM (SELECT * FROM applications {_NEWEST_APPLICATIONS.replace('<= 5', '<= 50')}) a LEFT JOIN stored_jobs s ON a.job_id = s.job_id""",
        *USERS,
        *STORED,
    ),
)
def applications_with_jobs(spark, sf_dir):
    out = serve.applications_with_jobs(view(spark, sf_dir, "applications"), stored_rows(spark, sf_dir), 50)
    return out.select("application_id", "user_id", "job_id", "status", "created_at", "job.job_title", "job.company")


@query(
    "profile_scores",
    with_views(
        """SELECT c_custkey AS user_id, c_name AS name, order_id, line_no, quiz, CAST(score AS INTEGER) AS score
        FROM customer LEFT JOIN quiz_scores ON c_custkey = user_id""",
        "quiz_scores",
    ),
)
def profile_scores(spark, sf_dir):
    profiles = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    out = serve.profiles_with_scores(profiles, view(spark, sf_dir, "quiz_scores"))
    return out.select("user_id", "name", "quiz_score.order_id", "quiz_score.line_no", "quiz_score.quiz", F.col("quiz_score.score").cast("int").alias("score"))


@query(
    "resume_versions",
    "SELECT o_orderkey AS resume_id, o_custkey AS user_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + CASE WHEN o_custkey % 3 = 0 THEN 7 ELSE 0 END AS version FROM orders",
)
def resume_versions(spark, sf_dir):
    new = view(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("resume_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("created_at")
    )
    # A third of the users already have versions up to 7.
    existing = view(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 3 == 0, 7).otherwise(0).alias("version")
    )
    out = serve.resume_versions(new, existing, [F.col("created_at"), F.col("resume_id")])
    return out.select("resume_id", "user_id", F.col("version").cast("bigint").alias("version"))


@query(
    "vetted_since",
    with_views(
        "SELECT application_id, user_id, idx FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at, application_id) - 1 AS idx FROM applications) a WHERE idx >= 3",
        *USERS,
    ),
)
def vetted_since(spark, sf_dir):
    order = [F.col("created_at"), F.col("application_id")]
    return serve.vetted_since(view(spark, sf_dir, "applications"), 3, order).select("application_id", "user_id", "idx")


@query("vetted_counts", with_views("SELECT user_id, count(*) AS n FROM applications GROUP BY user_id", *USERS))
def vetted_counts(spark, sf_dir):
    return serve.vetted_counts(view(spark, sf_dir, "applications"))


# --- change feeds ----------------------------------------------------------------------------


@query(
    "upsert_profiles",
    with_views(
        f"""SELECT c_custkey AS user_id, coalesce(p.name, c_name) AS name, CASE WHEN p.user_id IS NULL THEN c_mktsegment ELSE p.summary END AS summary,
          CASE WHEN p.user_id IS NULL THEN 1 ELSE coalesce(p.years_of_experience, 0) END AS years_of_experience,
          CASE WHEN p.user_id IS NULL THEN 'Excel' ELSE '' END AS skills, CASE WHEN p.user_id IS NULL THEN NULL ELSE {S.NOW} END AS updated_at
        FROM customer LEFT JOIN (SELECT * FROM profile_changes QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY changed_at DESC, change_id DESC) = 1) p ON c_custkey = p.user_id""",
        "profile_changes",
    ),
)
def upsert_profiles(spark, sf_dir):
    customers = view(spark, sf_dir, "customer")
    no_list = F.array().cast("array<string>")
    current = customers.select(
        F.col("c_custkey").alias("user_id"),
        *[
            {"name": F.col("c_name"), "summary": F.col("c_mktsegment")}.get(c, F.lit(None).cast("string")).alias(c)
            for c in feeds.PROFILE_TEXTS
        ],
        *[(F.array(F.lit("Excel")) if c == "skills" else no_list).alias(c) for c in feeds.PROFILE_LISTS],
        F.lit(1).alias("years_of_experience"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    order = [F.col("changed_at").desc(), F.col("change_id").desc()]
    out = feeds.upsert_profiles(current, view(spark, sf_dir, "profile_changes"), order, now())
    return out.select("user_id", "name", "summary", "years_of_experience", F.array_join("skills", ",").alias("skills"), "updated_at")


@query("new_applications", with_views(f"SELECT user_id, job_id, 'fits ' || status AS reasoning_note, 'pending' AS status, {S.NOW} AS created_at FROM applications", *USERS))
def new_applications(spark, sf_dir):
    asked = view(spark, sf_dir, "applications").select("user_id", "job_id", F.concat(F.lit("fits "), "status").alias("reasoning_note"))
    return feeds.new_applications(asked, now())


def _application_rows(spark, sf_dir):
    note = F.when(F.col("application_id") % 2 == 0, F.lit("Template: modern")).otherwise(F.lit(None).cast("string"))
    absent = F.lit(None)
    return view(spark, sf_dir, "applications").withColumns(
        {
            "reasoning_note": note,
            "optimized_resume_url": absent.cast("string"),
            "optimized_cover_letter": F.concat(F.lit("Dear "), F.col("status")),
            "applied_at": absent.cast("timestamp"),
            "updated_at": absent.cast("timestamp"),
        }
    )


_LAST_LINE = "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1"
_LAST_SHIP = "SELECT * FROM lineitem WHERE l_returnflag = 'R' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1"


@query(
    "status_updates",
    with_views(
        f"""SELECT a.application_id, coalesce(CASE l.l_linestatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' END, a.status) AS status, r.l_shipdate AS applied_at,
          CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE {S.NOW} END AS updated_at
        FROM applications a LEFT JOIN ({_LAST_LINE}) l ON a.application_id = l.l_orderkey LEFT JOIN ({_LAST_SHIP}) r ON a.application_id = r.l_orderkey""",
        *USERS,
    ),
)
def status_updates(spark, sf_dir):
    changes = view(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("application_id"),
        F.when(F.col("l_linestatus") == "F", "approved").otherwise("rejected").alias("status"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("timestamp")).alias("applied_at"),
        "l_linenumber", "l_partkey", "l_shipdate", "l_suppkey", "l_linestatus", "l_returnflag",
    )
    # Lines may agree in number and part: of those the last shipped one counts, whatever order they are read in.
    order = [F.col(c).desc() for c in ("l_linenumber", "l_partkey", "l_shipdate", "l_suppkey", "l_linestatus", "l_returnflag")]
    out = feeds.update_status(_application_rows(spark, sf_dir), changes, order, now())
    return out.select("application_id", "status", "applied_at", "updated_at")


@query(
    "draft_updates",
    with_views(
        f"""SELECT a.application_id, CASE WHEN d.user_id IS NULL THEN a.status ELSE 'draft' END AS status,
          CASE WHEN d.user_id IS NOT NULL AND a.user_id % 3 <> 0 THEN '{{"name":"' || d.name || '"}}' END AS optimized_resume_url,
          CASE WHEN d.user_id IS NOT NULL AND a.user_id % 4 = 0 THEN 'Hello' ELSE 'Dear ' || a.status END AS optimized_cover_letter,
          CASE WHEN d.user_id IS NULL THEN n.note WHEN a.user_id % 5 = 0 THEN n.note WHEN n.note IS NULL THEN 'Template: modern' ELSE n.note END AS reasoning_note
        FROM applications a LEFT JOIN (SELECT c_custkey AS user_id, c_name AS name FROM customer WHERE c_acctbal > 0) d ON a.user_id = d.user_id
        JOIN (SELECT application_id, CASE WHEN application_id % 2 = 0 THEN 'Template: modern' END AS note FROM applications) n ON n.application_id = a.application_id""",
        *USERS,
    ),
)
def draft_updates(spark, sf_dir):
    rows = _application_rows(spark, sf_dir)
    people = view(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    drafts = rows.select("application_id", "user_id").join(
        people.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")), "user_id"
    ).select(
        "application_id",
        F.when(F.col("user_id") % 3 != 0, F.to_json(F.struct("name"))).alias("optimized_resume"),
        F.when(F.col("user_id") % 4 == 0, "Hello").alias("optimized_cover_letter"),
        F.when(F.col("user_id") % 5 != 0, "modern").alias("template_name"),
    )
    # Each draft comes in two parts: the resume, then the letter and the template.
    nothing = F.lit(None).cast("string")
    early = drafts.withColumns({"part": F.lit(1), "template_name": nothing, "optimized_cover_letter": nothing})
    late = drafts.withColumns({"part": F.lit(2), "optimized_resume": nothing})
    out = feeds.save_drafts(rows, early.unionByName(late), [F.col("part")], now())
    return out.select("application_id", "status", "optimized_resume_url", "optimized_cover_letter", "reasoning_note")


# --- requests and plans ------------------------------------------------------------------------

REQUESTS = ("search_requests",)
_SIGNALS = "job|jobs|hiring|career|careers|vacancy|vacancies|position|positions|role|roles|opening|openings|developer|engineer|analyst|manager|designer|intern|accountant|teacher|nurse|remote|onsite|full-time|part-time|contract|internship"
_ROLE_OF = "CASE " + " ".join(
    f"WHEN contains({S.collapse('lower(search_query)')}, '{' '.join(r.lower().split())}') THEN '{r}'" for r in S.ROLES
) + " END"
_TITLED = "array_to_string(list_transform(regexp_extract_all(trim(string_split(lower(search_query), ' in ')[2]), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"
_PLACE = f"CASE WHEN contains(lower(search_query), ' in ') THEN {_TITLED} ELSE 'Pakistan' END"


@query("query_intent", with_views(f"SELECT request_id, regexp_matches(lower(search_query), '{_SIGNALS}') AS is_job_query FROM search_requests", *REQUESTS))
def query_intent(spark, sf_dir):
    return view(spark, sf_dir, "search_requests").select("request_id", search.has_job_intent(F.col("search_query")).alias("is_job_query"))


@query("role_of_query", with_views(f"SELECT request_id, {_ROLE_OF} AS role FROM search_requests", *REQUESTS))
def role_of_query(spark, sf_dir):
    return view(spark, sf_dir, "search_requests").select("request_id", search.role_of_query(F.col("search_query"), S.ROLES).alias("role"))


@query("query_location", with_views(f"SELECT request_id, {_PLACE} AS location FROM search_requests", *REQUESTS))
def query_location(spark, sf_dir):
    return view(spark, sf_dir, "search_requests").select("request_id", search.query_location(F.col("search_query")).alias("location"))


@query(
    "search_requests",
    with_views(
        f"SELECT request_id, role, location FROM (SELECT request_id, {_ROLE_OF} AS role, {_PLACE} AS location FROM search_requests WHERE regexp_matches(lower(search_query), '{_SIGNALS}')) s WHERE role IS NOT NULL",
        *REQUESTS,
    ),
)
def search_requests(spark, sf_dir):
    return search.search_requests(view(spark, sf_dir, "search_requests"), S.ROLES)


@query(
    "allowed_roles",
    f"""SELECT role, min(ord) AS ord FROM (
      SELECT k, min(ord) AS ord FROM (SELECT {S.collapse("lower(p_name)")} AS k, p_partkey AS ord FROM part) a GROUP BY k) w
      JOIN (SELECT k, arg_max(role, ord) AS role FROM (SELECT {S.collapse("lower(replace(p_name, ' ', '  '))")} AS k, upper(replace(p_name, ' ', '  ')) AS role, p_partkey AS ord FROM part WHERE p_size > 25) b GROUP BY k) p ON w.k = p.k GROUP BY role""",
)
def allowed_roles(spark, sf_dir):
    part = view(spark, sf_dir, "part")
    asked = part.select(F.col("p_name").alias("role"), F.col("p_partkey").alias("ord"))
    permitted = part.filter(F.col("p_size") > 25).select(
        F.upper(F.replace("p_name", F.lit(" "), F.lit("  "))).alias("role"), F.col("p_partkey").alias("ord")
    )
    return search.allowed_roles(asked, permitted)


_PLAN_SQL = """SELECT role, CAST(ord AS INTEGER) AS ord, board, location FROM (
  SELECT p_name AS role, b.ord, b.board, 'Pakistan' AS location FROM (SELECT DISTINCT p_name FROM part) p, (SELECT unnest([0, 1, 2, 3]) AS ord, unnest(['rozee', 'mustakbil', 'indeed', 'linkedin']) AS board) b
  UNION ALL SELECT p_name, b.ord, b.board, 'Remote' FROM (SELECT DISTINCT p_name FROM part) p, (SELECT unnest([4, 5]) AS ord, unnest(['indeed', 'linkedin']) AS board) b WHERE lower(p_name) = REMOTE) s"""


def _plan(spark, sf_dir):
    roles = view(spark, sf_dir, "part").select(F.col("p_name").alias("role")).distinct()
    return search.search_plan(roles, ["Almond Antique ", "blue steel"])


@query("search_plan", _PLAN_SQL.replace("= REMOTE", "IN ('almond antique', 'blue steel')"))
def search_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


_Q, _LOC = "replace(role, ' ', '%20')", "location"


@query(
    "search_urls",
    f"""SELECT role, board, location, page, CASE board
      WHEN 'linkedin' THEN 'https://www.linkedin.com/jobs/search/?keywords=' || {_Q} || '&location=' || CASE WHEN location = 'Remote' THEN 'Worldwide' ELSE location END || '&start=' || CAST((page - 1) * 25 AS VARCHAR) || CASE WHEN location = 'Remote' THEN '&f_WT=2' ELSE '' END
      WHEN 'indeed' THEN 'https://pk.indeed.com/jobs?q=' || {_Q} || '&l=' || location || CASE WHEN page > 1 THEN '&start=' || CAST((page - 1) * 10 AS VARCHAR) ELSE '' END
      WHEN 'rozee' THEN 'https://www.rozee.pk/job/jsearch/q/' || {_Q} || '/lc/' || location || CASE WHEN page > 1 THEN '/page/' || CAST(page AS VARCHAR) ELSE '' END
      ELSE 'https://www.mustakbil.com/jobs/search?keywords=' || {_Q} || '&location=' || location || CASE WHEN page > 1 THEN '&page=' || CAST(page AS VARCHAR) ELSE '' END END AS url
    FROM ({_PLAN_SQL.replace("= REMOTE", "IN ('almond antique', 'blue steel')")}) plan, (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS page) pages""",
)
def search_urls(spark, sf_dir):
    return search.search_urls(_plan(spark, sf_dir), 3).select("role", "board", "location", "page", "url")


@query(
    "pane_urls",
    with_views(
        """SELECT doc_id, CASE WHEN jk = '' THEN '' ELSE 'https://pk.indeed.com/jobs?q=' || replace(replace(replace(title, '(', '%28'), ')', '%29'), ' ', '%20') || '&l=' || CASE WHEN location = '' THEN 'Pakistan' ELSE replace(replace(location, ',', '%2C'), ' ', '%20') END
          || '&vjk=' || jk || '&start=20' END AS url FROM (SELECT doc_id, title, location, regexp_extract(job_url, '[?&]jk=([a-f0-9]+)', 1) AS jk FROM postings) s""",
        *POSTED,
    ),
)
def pane_urls(spark, sf_dir):
    url = search.pane_url(F.col("title"), F.col("location"), indeed_key(F.col("job_url")), F.lit(3))
    return posting_rows(spark, sf_dir).select("doc_id", url.alias("url"))


# --- schedule -------------------------------------------------------------------------------------

RUNS = ("run_log",)


@query(
    "uncovered_hours",
    with_views(
        """SELECT CAST(h AS TIMESTAMP) AS hour FROM (SELECT unnest(generate_series(min(date_trunc('hour', run_started_at)), max(date_trunc('hour', run_started_at)), INTERVAL 1 HOUR)) AS h FROM run_log) s
        WHERE h NOT IN (SELECT date_trunc('hour', run_started_at) FROM run_log WHERE conclusion = 'success' OR status = 'in_progress')""",
        *RUNS,
    ),
)
def uncovered_hours(spark, sf_dir):
    runs = view(spark, sf_dir, "run_log").withColumn("run_started_at", F.col("run_started_at").cast("timestamp"))
    return search.uncovered_hours(runs)


@query(
    "run_gate",
    with_views(
        """SELECT a.id, (SELECT count(*) FROM run_log WHERE status = 'in_progress') - CASE WHEN a.status = 'in_progress' THEN 1 ELSE 0 END = 0
          AND coalesce(w.n, 0) - CASE WHEN coalesce(a.conclusion, '') = 'success' THEN 1 ELSE 0 END = 0 AS may_start
        FROM run_log a LEFT JOIN (SELECT date_trunc('hour', run_started_at) AS h, count(*) AS n FROM run_log WHERE conclusion = 'success' GROUP BY 1) w ON date_trunc('hour', a.run_started_at) = w.h""",
        *RUNS,
    ),
)
def run_gate(spark, sf_dir):
    runs = view(spark, sf_dir, "run_log").withColumn("run_started_at", F.col("run_started_at").cast("timestamp"))
    asking = runs.select("id", F.col("run_started_at").alias("now"))
    return search.may_start(runs, asking).select("id", "may_start")


@query(
    "hour_slot",
    with_views(
        "SELECT CAST(hour(run_started_at) % 4 AS INTEGER) AS slot, CASE WHEN hour(run_started_at) % 2 = 0 THEN 'linkedin' ELSE 'indeed' END AS board, CAST(CASE WHEN hour(run_started_at) % 4 < 2 THEN 1 ELSE 2 END AS INTEGER) AS role_set, count(*) AS n FROM run_log GROUP BY ALL",
        *RUNS,
    ),
)
def hour_slot(spark, sf_dir):
    slots = view(spark, sf_dir, "run_log").select(search.hour_slot(F.col("run_started_at")).alias("s")).select("s.*")
    return report.counts_by(slots, "slot", "board", "role_set")


# --- arrival order -----------------------------------------------------------------------------------


@query(
    "cap_per_board",
    with_views("SELECT doc_id, board, title FROM postings QUALIFY row_number() OVER (PARTITION BY title, board ORDER BY scraped_at, doc_id) <= 20", *POSTED),
)
def cap_per_board(spark, sf_dir):
    """The reading cap of one search: 20 rows per title and board."""
    return arrivals.cap_per_search(posting_rows(spark, sf_dir), ["title", "board"], [F.col("scraped_at"), F.col("doc_id")], 20).select("doc_id", "board", "title")


@query(
    "first_by_url",
    with_views("SELECT job_url, doc_id FROM postings QUALIFY row_number() OVER (PARTITION BY job_url ORDER BY scraped_at, doc_id) = 1", *POSTED),
)
def first_by_url(spark, sf_dir):
    return arrivals.first_by_url(posting_rows(spark, sf_dir), [F.col("scraped_at"), F.col("doc_id")]).select("job_url", "doc_id")


@query(
    "queued_distinct",
    with_views(f"SELECT DISTINCT job_id, CAST(length({S.text('description')}) AS INTEGER) AS text_length FROM postings WHERE coalesce(job_id, '') <> ''", *POSTED),
)
def queued_distinct(spark, sf_dir):
    return arrivals.queued_distinct(posting_rows(spark, sf_dir)).select("job_id", "text_length")


@query(
    "emit_if_longer",
    with_views(
        f"""SELECT doc_id, title, company FROM (SELECT *, max(len) OVER (PARTITION BY title ORDER BY scraped_at, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
          FROM (SELECT *, length({S.text('description')}) AS len FROM postings) a) b WHERE before IS NULL OR len > before""",
        *POSTED,
    ),
)
def emit_if_longer(spark, sf_dir):
    """Keyed by title, of which there are seven: every group is a hot one."""
    length = F.length(F.trim("description"))
    out = arrivals.emit_if_longer(posting_rows(spark, sf_dir), "title", length, [F.col("scraped_at"), F.col("doc_id")])
    return out.select("doc_id", "title", "company")


def _log_streaks(limit: int, keys: str, ok: str, failed: str) -> str:
    return f"""SELECT *, failures - coalesce(max(CASE WHEN {ok} THEN failures END) OVER (PARTITION BY {keys} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak
      FROM (SELECT *, sum(CASE WHEN {failed} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS failures FROM fetch_log) a"""


@query(
    "failure_streaks",
    with_views(
        "SELECT event_id, board, CAST(streak AS BIGINT) AS streak, outcome = 'timeout' AND streak > 0 AND streak % 3 = 0 AS cooldown FROM s",
        *LOG,
        s=_log_streaks(3, "board", "outcome = 'ok'", "outcome = 'timeout'"),
    ),
)
def failure_streaks(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log")
    out = arrivals.failure_streaks(
        log, ["board"], F.col("outcome") == "timeout", F.col("outcome") == "ok", 3, [F.col("ts"), F.col("event_id")]
    )
    return out.select("event_id", "board", "streak", "cooldown")


_COOLDOWNS = "SELECT board, ts AS cooling_from, ts + INTERVAL '300 seconds' AS cooling_until FROM s WHERE outcome = 'timeout' AND streak > 0 AND streak % 3 = 0"


def _intervals(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log")
    streaks = arrivals.failure_streaks(
        log, ["board"], F.col("outcome") == "timeout", F.col("outcome") == "ok", 3, [F.col("ts"), F.col("event_id")]
    )
    return arrivals.cooldowns(streaks, ["board"], "ts", 300)


@query("cooldowns", with_views(_COOLDOWNS, *LOG, s=_log_streaks(3, "board", "outcome = 'ok'", "outcome = 'timeout'")))
def cooldowns(spark, sf_dir):
    return _intervals(spark, sf_dir)


@query(
    "cooling_at",
    with_views(
        "SELECT event_id, board, coalesce(c.cooling_until > f.ts, false) AS cooling FROM fetch_log f ASOF LEFT JOIN (SELECT board AS b, cooling_from, cooling_until FROM c) c ON f.board = c.b AND f.ts >= c.cooling_from",
        *LOG,
        s=_log_streaks(3, "board", "outcome = 'ok'", "outcome = 'timeout'"),
        c=_COOLDOWNS,
    ),
)
def cooling_at(spark, sf_dir):
    probes = view(spark, sf_dir, "fetch_log").select("event_id", "board", "ts")
    out = arrivals.cooling_at(probes, _intervals(spark, sf_dir), ["board"], "ts")
    return out.select("event_id", "board", "cooling")


@query(
    "blocked_runs",
    with_views(
        """SELECT f.board, f.ts AS blocked_from, min(o.ts) AS blocked_until FROM (SELECT * FROM s WHERE outcome = 'auth_wall' AND streak = 3) f
        LEFT JOIN (SELECT * FROM fetch_log WHERE outcome = 'ok') o ON f.board = o.board AND (o.ts, o.event_id) > (f.ts, f.event_id) GROUP BY f.board, f.event_id, f.ts""",
        *LOG,
        s=_log_streaks(3, "board", "outcome = 'ok'", "outcome = 'auth_wall'"),
    ),
)
def blocked_runs(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log")
    return arrivals.blocked_runs(
        log, ["board"], F.col("outcome") == "auth_wall", F.col("outcome") == "ok", 3, "ts", [F.col("ts"), F.col("event_id")]
    )


@query(
    "seen_per_user",
    with_views(
        """SELECT event_id, user_id, board, outcome, CAST(session AS BIGINT) AS session FROM (SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session
          FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL '12 hours' THEN 1 ELSE 0 END AS gap FROM fetch_log) a) b
        QUALIFY row_number() OVER (PARTITION BY user_id, session, outcome ORDER BY ts, event_id) = 1""",
        *LOG,
    ),
)
def seen_per_user(spark, sf_dir):
    """Each user's own set: an add keeps only that user's members alive."""
    out = arrivals.dedup_within_ttl(view(spark, sf_dir, "fetch_log"), "outcome", "ts", "12 hours", [F.col("ts"), F.col("event_id")], owners=["user_id"])
    return out.select("event_id", "user_id", "board", "outcome", F.col("session").cast("bigint").alias("session"))


@query(
    "vetted_live",
    with_views(
        """SELECT event_id, user_id, idx FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx FROM (
            SELECT *, max(session) OVER (PARTITION BY user_id) AS newest, max(ts) OVER (PARTITION BY user_id) AS last_add FROM (
              SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM (
                SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL '12 hours' THEN 1 ELSE 0 END AS gap
                FROM fetch_log WHERE ts <= TIMESTAMP '2024-01-20 12:00:00') a) b) c
          WHERE session = newest AND last_add + INTERVAL '12 hours' > TIMESTAMP '2024-01-20 12:00:00') d WHERE idx >= 1""",
        *LOG,
    ),
)
def vetted_live(spark, sf_dir):
    at = F.lit("2024-01-20 12:00:00").cast("timestamp")
    out = serve.vetted_live(view(spark, sf_dir, "fetch_log"), "ts", at, "12 hours", 1, [F.col("ts"), F.col("event_id")])
    return out.select("event_id", "user_id", "idx")


@query(
    "listing_stop",
    with_views(
        """SELECT event_id, user_id, board FROM s WHERE outcome <> 'ok' AND streak > 0 AND streak % 2 = 0
        QUALIFY row_number() OVER (PARTITION BY user_id, board ORDER BY ts, event_id) = 1""",
        *LOG,
        s=_log_streaks(2, "user_id, board", "outcome = 'ok'", "outcome <> 'ok'"),
    ),
)
def listing_stop(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log")
    out = arrivals.listing_stops(
        log, ["user_id", "board"], F.col("outcome") != "ok", 2, [F.col("ts"), F.col("event_id")]
    )
    return out.select("event_id", "user_id", "board")


@query(
    "dedup_ttl",
    with_views(
        """SELECT event_id, user_id, ts, CAST(session AS BIGINT) AS session FROM (SELECT *, sum(gap) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session
          FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, event_id) > INTERVAL '12 minutes' THEN 1 ELSE 0 END AS gap FROM fetch_log) a) b
        QUALIFY row_number() OVER (PARTITION BY session, user_id ORDER BY ts, event_id) = 1""",
        *LOG,
    ),
)
def dedup_ttl(spark, sf_dir):
    out = arrivals.dedup_within_ttl(view(spark, sf_dir, "fetch_log"), "user_id", "ts", "12 minutes", [F.col("ts"), F.col("event_id")])
    return out.select("event_id", "user_id", "ts", F.col("session").cast("bigint").alias("session"))


# --- the same as streams -------------------------------------------------------------------


def _streamed(spark, sf_dir, run, *columns):
    """What a stream over the fetch log leaves, with a last row that lets the watermark pass all others."""
    folder = work_folder(spark, "stream")
    log = view(spark, sf_dir, "fetch_log")
    last = log.limit(1).withColumns({"event_id": F.lit(-1).cast("bigint"), "ts": F.lit("2100-01-01").cast("timestamp"), "outcome": F.lit("ok")})
    log.write.parquet(f"{folder}/log")
    last.withColumns({c: F.col(c).cast(log.schema[c].dataType) for c in log.columns}).write.mode("append").parquet(f"{folder}/log")
    found = run(spark.readStream.schema(log.schema).parquet(f"{folder}/log"))
    writer = found.writeStream.format("parquet").option("path", f"{folder}/found").option("checkpointLocation", f"{folder}/checkpoint")
    with keyed_state(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{folder}/found").select(*columns)


@query("seen_per_user_stream", ORACLES["seen_per_user"])
def seen_per_user_stream(spark, sf_dir):
    """Keyed state: one set per user."""
    told = ["event_id", "user_id", "board", "outcome"]
    run = lambda log: stateful.expiring_set_stream(log, "outcome", "ts", "12 hours", ["event_id"], "1 hour", owners=["user_id"], columns=told)
    return _streamed(spark, sf_dir, run, *told, "session").filter("event_id >= 0")


@query("dedup_ttl_stream", ORACLES["dedup_ttl"])
def dedup_ttl_stream(spark, sf_dir):
    """One set in all, spread over four tasks by its members."""
    run = lambda log: stateful.expiring_set_stream(log, "user_id", "ts", "12 minutes", ["event_id"], "1 hour", shards=4)
    return _streamed(spark, sf_dir, run, "event_id", "user_id", "ts", "session").filter("event_id >= 0")


@query(
    "cooldown_events_stream",
    with_views(
        "SELECT board, 'start' AS event, cooling_from AS at FROM c UNION ALL SELECT board, 'end', cooling_until FROM c",
        *LOG,
        s=_log_streaks(3, "board", "outcome = 'ok'", "outcome = 'timeout'"),
        c=_COOLDOWNS,
    ),
)
def cooldown_events_stream(spark, sf_dir):
    """Ends come from timers."""
    failed, ok = F.col("outcome") == "timeout", F.col("outcome") == "ok"
    run = lambda log: stateful.streak_event_stream(log, ["board"], failed, ok, 3, "ts", ["ts", "event_id"], "1 hour", seconds=300, slice_seconds=86400)
    return _streamed(spark, sf_dir, run, "board", "event", "at")


_LIVE = """SELECT event_id, user_id, outcome FROM (SELECT *, max(len) OVER (PARTITION BY user_id, life ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (
  SELECT *, sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS life FROM (
    SELECT *, (event_id * 7919) % 211 AS len, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL '12 hours' THEN 1 ELSE 0 END AS gap FROM fetch_log) a) b) c
WHERE before IS NULL OR len > before"""


def _of_some_length(log):
    """The log with a text whose length goes up and down, and the user as its key."""
    return log.withColumns({"text": F.expr("repeat('x', CAST((event_id * 7919) % 211 AS INT))"), "key": F.col("user_id").cast("string")})


@query("emit_if_longer_live", with_views(_LIVE, *LOG))
def emit_if_longer_live(spark, sf_dir):
    """A user without a row for twelve hours is forgotten and starts anew."""
    log = _of_some_length(view(spark, sf_dir, "fetch_log"))
    out = arrivals.emit_if_longer_live(log, "key", F.length("text"), "ts", [F.col("ts"), F.col("event_id")], "12 hours")
    return out.select("event_id", "user_id", "outcome")


@query("emit_longer_stream", with_views(_LIVE, *LOG))
def emit_longer_stream(spark, sf_dir):
    told = ["event_id", "user_id", "outcome"]
    run = lambda log: stateful.emit_longer_stream(_of_some_length(log), "key", "text", "ts", ["event_id"], "12 hours", "1 hour", columns=told)
    return _streamed(spark, sf_dir, run, *told).filter("event_id >= 0")


@query("page_after", with_views("SELECT job_id, job_title FROM stored_jobs WHERE job_id > '5' ORDER BY job_id LIMIT 100", *STORED))
def page_after(spark, sf_dir):
    return serve.page_after(stored_rows(spark, sf_dir), "5", 100).select("job_id", "job_title")


@query("enqueue_new", with_views("SELECT doc_id, job_id FROM postings WHERE job_id NOT IN (SELECT job_id FROM processed_jobs)", *POSTED, "processed_jobs"))
def enqueue_new(spark, sf_dir):
    return arrivals.enqueue_new(posting_rows(spark, sf_dir), seen_rows(spark, sf_dir)).select("doc_id", "job_id")


@query(
    "queue_stats",
    with_views("SELECT (SELECT count(*) FROM postings) AS queue_length, (SELECT count(DISTINCT job_id) FROM processed_jobs) AS processed_count", *POSTED, "processed_jobs"),
)
def queue_stats(spark, sf_dir):
    return report.queue_stats(posting_rows(spark, sf_dir), seen_rows(spark, sf_dir))


@query(
    "fetch_report",
    with_views("SELECT board, outcome, count(*) AS n, round(sum(elapsed_s), 4) AS elapsed_s, max(elapsed_s) AS slowest_s FROM fetch_log GROUP BY ALL", *LOG),
)
def fetch_report(spark, sf_dir):
    return report.fetch_report(view(spark, sf_dir, "fetch_log")).withColumn("elapsed_s", F.round("elapsed_s", 4))


@query(
    "failed_roles",
    with_views(
        """SELECT role, count(*) AS searches FROM (SELECT CAST(user_id AS VARCHAR) || ' ' || strftime(ts, '%Y-%m-%d') AS role, board, bool_and(outcome <> 'ok') AS failed FROM fetch_log GROUP BY ALL) s GROUP BY role HAVING bool_and(failed)""",
        *LOG,
    ),
)
def failed_roles(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log").withColumn("role", F.concat_ws(" ", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))
    return report.failed_roles(log, F.col("outcome") != "ok")
