r"""Fixed values.

Everything here must equal what existing data and callers expect: word lists,
url markers, regular expressions, thresholds and formats.  Regular expressions
are written for the JVM.  ``WS`` and ``WORD`` spell out the Unicode classes that
``\s`` and ``\w`` stand for, because the JVM's short forms are ASCII only.
"""

# --- character classes -----------------------------------------------------
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# --- boards ----------------------------------------------------------------
BOARDS = ["rozee", "mustakbil", "indeed", "linkedin"]
REMOTE_CAPABLE_BOARDS = ["linkedin", "indeed"]
DEFAULT_LOCATION = "Pakistan"
REMOTE_LOCATION = "Remote"

# --- empty values ----------------------------------------------------------
PLACEHOLDERS = ["", "unknown", "untitled", "n/a", "none", "null"]

# --- persist rules ---------------------------------------------------------
FULL_TEXT_MIN = 50
INDEED_TEXT_MIN = 20
LISTING_PLACEHOLDER = "Listing summary from Indeed search results"
LISTING_PLACEHOLDER_TAIL = (
    ". Listing summary from Indeed search results. "
    "Open the posting link for the full job description."
)
REQUIRED_FIELDS = ["title", "company", "location", "job_url", "description"]
BOARD_REQUIRED_FIELDS = ["title", "company", "location", "job_url"]

# --- pages and urls --------------------------------------------------------
AUTH_URL_MARKERS = [
    "secure.indeed.com/auth",
    "from=bot-detection",
    "account/login",
    "/authwall",
    "/checkpoint/challenge",
    "linkedin.com/login",
    "linkedin.com/uas/login",
    "linkedin.com/signup",
]
AUTH_HTML_MARKERS = ["bot-detection-anonymous", "from=bot-detection"]
BOT_URL_MARKERS = ["bot-detection", "secure.indeed.com/auth"]
JOB_URL_MARKERS = ["/viewjob", "/jobs/view/", "/jobs/job/", "jk="]
PAGE_FLAGS = [
    "cloudflare",
    "attention required",
    "captcha",
    "unusual traffic",
    "enable javascript",
    "sign in",
    "authwall",
    "challenge",
]
CONTINUE_PARAMS = ["continue2", "continue", "sessionRedirect"]
SEARCH_PATHS = ["/jobs/search", "/job/jsearch", "/jobs"]
SEARCH_PATH_PREFIXES = ["/jobs/search", "/job/jsearch"]
LINKEDIN_ID = r"/jobs/view/(?:[^/?#]*?-)?(\d{5,})(?:[/?#]|$)"
INDEED_KEY = r"^([a-f0-9]{8,})$"
INDEED_KEY_IN_URL = r"(?i)[?&]jk=([a-f0-9]+)"
META_REFRESH = r"""(?i)http-equiv=["']?refresh["'][^>]*content=["'][^"']*url=([^"'\s>]+)"""
JSONLD_SCRIPT = (
    r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
)
TAG = r"<[^>]+>"
SANITIZED_JSON_TEXT = r'"sanitizedJobDescription":"((?:\\.|[^"\\])*+)'
EMBEDDED_JSON_TEXT = (
    r'(?i)"(?:description|jobDescription|job_description)"\s*:\s*"((?:\\.|[^"\\])*+)"'
)
ARTICLE_BODY_TEXT = r'(?i)"articleBody"\s*:\s*"((?:\\.|[^"\\])*+)"'
MARKUP_BLOCK = (
    r'(?is)<div[^>]*class="[^"]*show-more-less-html__markup[^"]*"[^>]*>(.*?)</div>'
)

# --- page furniture --------------------------------------------------------
SHOW_MORE_LESS = r"(?i)\bshow more[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+show less\b"
CRITERIA_TAIL = (
    r"(?is)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*\bSeniority level\b.{0,200}?\bEmployment type\b.*$"
)
TRAILING_TOGGLE = (
    r"(?i)(?:[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*\b(?:show|see) (?:more|less)\b[.…]*)+"
    r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*$"
)
TRUNCATED_TAIL = (
    r"(?i)(?:\.{3}|…)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*(?:see|show)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+more\b"
    r"|\b(?:see|show)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+more[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*$"
)
ICON_WORDS = [
    "arrow_forward", "arrow_back", "business", "location_city", "payments",
    "access_time", "work_outline", "trending_up", "school", "event", "flag",
    "checklist", "description",
]

# --- enrichment ------------------------------------------------------------
SECTION_HEADERS = {
    "responsibilities": r"(?:responsibilities|duties|role|what you['’]ll do|key tasks)",
    "requirements": r"(?:requirements|qualifications|what we['’]re looking for|must have|required skills)",
    "preferred": r"(?:preferred|nice to have|bonus|plus|good to have)",
    "benefits": r"(?:benefits|perks|what we offer|why join|compensation)",
    "about_company": r"(?:about us|about the company|who we are|company overview)",
}
LEVELS = {
    "entry": r"(?:entry level|fresher|fresh graduate|0-1 years?|no experience)",
    "junior": r"(?:junior|1-2 years?|1-3 years?)",
    "mid": r"(?:mid[-\t-\r\x{1c}-\x{20}\x{85}\p{Z}]level|3-5 years?|4-6 years?|intermediate)",
    "senior": r"(?:senior|5\+ years?|6\+ years?|7\+ years?|experienced)",
    "lead": r"(?:lead|principal|architect|10\+ years?|expert)",
}
YEAR_RANGES = [
    r"([0-9]+)WS*-WS*([0-9]+)WS*years?",
    r"([0-9]+)WS+toWS+([0-9]+)WS*years?",
    r"([0-9]+)\+WS*years?",
    r"minimumWS+([0-9]+)WS*years?",
    r"at leastWS+([0-9]+)WS*years?",
]  # WS stands for the class above
EDUCATION = {
    "PhD": r"(?:ph\.?d\.?|doctorate|doctoral degree)",
    "Master's": r"(?:master'?s?|m\.?s\.?|msc|mba|graduate degree)",
    "Bachelor's": r"(?:bachelor'?s?|b\.?s\.?|b\.?sc\.?|b\.?eng\.?|undergraduate degree|4-year degree)",
    "Associate": r"(?:associate'?s? degree|2-year degree)",
    "High School": r"(?:high school|secondary school|diploma)",
}
JOB_TYPES = {
    "Internship": r"(?:intern|internship|intern position)",
    "Contract": r"(?:contract|contractor|contractual|temporary|temp)",
    "Part-time": r"(?:part-time|part time|parttime)",
    "Full-time": r"(?:full-time|full time|fulltime|permanent)",
}
DEFAULT_JOB_TYPE = "Full-time"
SOFT_SKILL_WORDS = [
    "communication", "leadership", "team", "problem", "collaboration",
    "analytical", "creative", "critical thinking", "management",
]
TOOL_SKILL_WORDS = ["git", "jira", "jenkins", "docker", "kubernetes", "hadoop"]
NO_SALARY = ["competitive", "negotiable", "not specified"]
SALARY_NUMBER = r"(?i)([0-9][0-9,]*(?:\.[0-9]+)?)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]*(k)?(?![a-z])"
PERIODS = {
    "year": ["annual", "yearly", "per year", "/year", "p.a."],
    "month": ["monthly", "per month", "/month"],
    "week": ["weekly", "per week", "/week"],
    "hour": ["hourly", "per hour", "/hour", "/hr"],
}
SCORE_POINTS = {
    "base": 50,
    "long_text": 10,
    "sections": 20,
    "three_skills": 10,
    "seven_skills": 10,
    "experience": 10,
    "salary": 10,
    "education": 5,
    "job_type": 5,
}

# --- posted dates ----------------------------------------------------------
POSTED_PREFIX = (
    r"(?i)^(?:employer[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+active|reposted|posted|active)[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]+"
)
NOW_WORDS = ["just now", "just posted", "today", "recently"]
RELATIVE_AGE = (
    r"^(?:(?:about|approx\.?|approximately)WS+)?([0-9]+)\+?WS*"
    r"(minutes?|mins?|hours?|hrs?|days?|weeks?|months?|years?)WS*ago$"
)  # WS stands for the class above
POSTED_FORMATS = ["MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy"]

# --- search requests -------------------------------------------------------
JOB_SIGNALS = [
    "job", "jobs", "hiring", "career", "careers", "vacancy", "vacancies",
    "position", "positions", "role", "roles", "opening", "openings",
    "developer", "engineer", "analyst", "manager", "designer", "intern",
    "accountant", "teacher", "nurse", "remote", "onsite", "full-time",
    "part-time", "contract", "internship",
]

# --- run log ---------------------------------------------------------------
ACTIVE_RUN_STATES = ["queued", "in_progress", "waiting", "pending", "requested"]

# --- selectors per board and field, in order of preference ----------------------
DETAIL_SELECTORS = {
    "indeed": {
        "title": [
            "h1.jobsearch-JobInfoHeader-title",
            ".jobsearch-JobInfoHeader-title-container h1",
            "h1[data-testid='jobsearch-JobInfoHeader-title']",
            "[data-testid='jobsearch-JobInfoHeader-title']",
            "h1",
        ],
        "meta_title": ["meta[property='og:title']", "meta[name='twitter:title']"],
        "company": [
            "div.jobsearch-InlineCompanyRating > div",
            "div[data-company-name='true']",
            ".jobsearch-CompanyInfoContainer a",
        ],
        "location": [
            "div.jobsearch-JobInfoHeader-subtitle > div:last-child",
            "div[data-testid='job-location']",
            ".jobsearch-JobInfoHeader-subtitle .jobsearch-JobInfoHeader-subtitle-link",
        ],
        "main_text": [
            "div#jobDescriptionText",
            "#jobDescriptionText",
            "div.jobsearch-JobComponent-description",
            "div[id='jobDescriptionText']",
            "div[data-testid='jobsearch-JobComponent-description']",
            "#vjs-desc",
        ],
        "other_text": [
            "div#jobDescriptionText",
            ".jobsearch-jobDescriptionText",
            "div[id='jobDescriptionText']",
            "#job-description",
            "div[data-testid='jobsearch-JobComponent-description']",
            "div.jobsearch-JobComponent-description",
            "#jobDescriptionText .jobsearch-JobComponent-description",
        ],
        "salary": [
            ".jobsearch-JobMetadataHeader-item",
            "div[data-testid='jobsearch-JobMetadataHeader-salary']",
            ".salary-snippet",
        ],
        "type": ["div[data-testid='job-type-text']", ".jobsearch-JobMetadataHeader-item"],
    },
    "linkedin": {
        "title": [
            "h1.top-card-layout__title",
            ".job-details-jobs-unified-top-card__job-title",
            "h1.jobs-unified-top-card__job-title",
        ],
        "company": [
            "a.topcard__org-name-link",
            ".job-details-jobs-unified-top-card__company-name a",
            ".jobs-unified-top-card__company-name a",
            ".job-details-jobs-unified-top-card__company-name",
            ".jobs-unified-top-card__company-name",
        ],
        "location": [
            "span.topcard__flavor--bullet",
            ".job-details-jobs-unified-top-card__bullet",
            ".jobs-unified-top-card__bullet",
        ],
        "markup_text": [
            "div.show-more-less-html__markup",
            "div[class*='show-more-less-html__markup']",
        ],
        "container_text": [
            "div.description__text",
            ".jobs-description-content__text",
            ".jobs-description__content",
            "section.description",
        ],
        "box_text": [
            "div.jobs-box__html-content",
            "div.jobs-description__content",
            "article.jobs-description__container",
        ],
        "type": [
            ".job-details-jobs-unified-top-card__job-insight span",
            "li.jobs-unified-top-card__job-insight span",
        ],
    },
    "mustakbil": {
        "title": ["h1.job-title", "h1", ".job-detail-header h1"],
        "company": [".company-name", ".employer", ".company-info a"],
        "location": [".job-location", ".location-info", "span.location"],
        "main_text": [
            "section[aria-labelledby='job-description-title']",
            ".job-description",
            "#description",
            ".description-content",
        ],
        "salary": [".salary-info", ".job-salary", "span.salary"],
        "posted": [".posted-date", ".date-posted", "time"],
        "type": [".job-type", ".employment-type"],
        "experience": [".experience-required", ".required-experience"],
    },
}
CARD_SELECTORS = {
    "indeed": {
        "card": ["div.job_seen_beacon", "div.result", "li.css-5lfssm"],
        "link": ["a.jcs-JobTitle", "a[data-testid='job-title']", "h2 a"],
        "company": ["[data-testid='company-name']", "span.companyName", ".companyName"],
        "location": ["[data-testid='text-location']", "div.companyLocation", ".companyLocation"],
        "text": [".job-snippet", "[data-testid='job-snippet']", "div.jobCardShelfContainer"],
        "posted": ["span.date", "[data-testid='myJobsStateDate']"],
        "fallback": [
            "a.jcs-JobTitle",
            "a[data-testid='job-title']",
            ".jobsearch-ResultsList a[id^='job_']",
        ],
    },
    "linkedin": {
        "card": ["div.base-card", "div.job-search-card", "li.jobs-search-results__list-item"],
        "title": [
            "h3.base-search-card__title",
            ".base-search-card__title",
            "h3.job-search-card__title",
        ],
        "link": [
            "a.base-card__full-link",
            "a.job-search-card__link-wrapper",
            "a[href*='/jobs/view/']",
        ],
        "company": [
            "h4.base-search-card__subtitle",
            ".base-search-card__subtitle",
            "a.hidden-nested-link",
        ],
        "location": ["span.job-search-card__location", ".job-search-card__location"],
        "posted": ["time.job-search-card__listdate", "time"],
        "fallback": [
            "a.base-card__full-link",
            ".job-search-card__link-wrapper",
            ".jobs-search-results__list-item a",
        ],
    },
    "rozee": {
        "card": ["div.job", "article.job", "div.job-box", "div.jhead"],
        "link": ["div.jhead h3 a", "h3.s-18 a", "h3 a"],
        "title": ["h3 a bdi"],
        "names": ["div.cname a"],
        "text": ["div.jbody"],
        "posted": ["span[data-original-title='Posted On']"],
        "experience": ["span.func-area-drn"],
        "type": ["div.jcnt.font16"],
    },
    "mustakbil": {
        "card": ["h3 a[href*='/jobs/job/']", "a[href*='/jobs/job/']"],
    },
}
