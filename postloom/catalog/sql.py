"""Building blocks of the checking SQL (DuckDB), written apart from the Spark code."""

from __future__ import annotations

SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
SPACES = r"chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"
L = r"(^|[^\p{L}\p{N}_])"
R = r"($|[^\p{L}\p{N}_])"

VOCABULARY = [
    "C++", "C#", ".NET", "Python", "Node.js", "Node", "Java", "JavaScript", "SQL", "Docker",
    "Git", "Kubernetes", "Communication", "Teamwork", "Data",
]
ROLES = ["Data Engineer", "Backend Developer", "Software  Engineer", "Graphic Designer", "data engineer"]

NOW = "TIMESTAMP '2026-10-02 12:00:00'"
CUTOFF = "TIMESTAMP '2026-09-24 00:00:00'"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def blank(x: str) -> str:
    return f"(lower({strip(f'coalesce({x}, {chr(39)}{chr(39)})')}) IN ('', 'unknown', 'untitled', 'n/a', 'none', 'null'))"


def text(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def unescape(x: str) -> str:
    """Decodes the references that occur in the tables."""
    out = f"replace(replace({x}, '&amp;', chr(1)), '&amp', chr(1))"
    for ref, char in (("&quot;", "'\"'"), ("&copy;", "'©'"), ("&middot;", "'·'"), ("&lt;", "'<'"), ("&gt;", "'>'")):
        out = f"replace({out}, '{ref}', {char})"
    return f"replace({out}, chr(1), '&')"


def any_of(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def hash16(x: str) -> str:
    return f"substring(sha256({x}), 1, 16)"


def word(x: str, body: str) -> str:
    return f"regexp_matches({x}, '{L}(?:{body}){R}')"


CLEAN = collapse(unescape("description"))

# --- sections ----------------------------------------------------------------

_HEADERS = {
    "about_company": "about us|about the company|who we are|company overview",
    "benefits": "benefits|perks|what we offer|why join|compensation",
    "preferred": "preferred|nice to have|bonus|plus|good to have",
    "requirements": "requirements|qualifications|what we[''’]re looking for|must have|required skills",
    "responsibilities": "responsibilities|duties|role|what you[''’]ll do|key tasks",
}
_ANY = "|".join(_HEADERS.values())
_NAME = "CASE " + " ".join(f"WHEN regexp_matches(p, '(?i)^(?:{h})') THEN '{n}'" for n, h in _HEADERS.items()) + " END"
_BODY = f"trim(regexp_replace(trim(regexp_replace(p, '(?i)^(?:{_ANY})', '')), '^(?:[:•-]|{SPACE})+', ''))"


def section(name: str) -> str:
    """Body of the last non-empty piece of a section of ``clean``; null without one."""
    return (
        f"list_filter(list_transform(list_filter(pieces, lambda p: regexp_matches(p, '(?i)^(?:{_HEADERS[name]})')), "
        f"lambda p: {_BODY}), lambda b: b <> '')[-1]"
    )


def pieces(clean: str) -> str:
    return f"string_split(regexp_replace({clean}, '(?i)({_ANY})', chr(1) || '\\1', 'g'), chr(1))[2:]"


SECTION_NAMES = sorted(_HEADERS)


# --- sentences -----------------------------------------------------------------

SENTENCES = r"""
SELECT *, CASE WHEN len(kept) > 0 THEN array_to_string(kept, '. ') || '.' ELSE clean END AS full_text FROM (
  SELECT *, list_filter(sents, lambda s, i: length(norms[i]) > 10 AND list_position(norms, norms[i]) = i) AS kept FROM (
    SELECT *, list_transform(sents, lambda s: trim(lower(s))) AS norms FROM (
      SELECT *, string_split_regex(clean, '[.!?]SPACE+') AS sents FROM cleaned)))
""".replace("SPACE", SPACE)


def words(x: str) -> str:
    return f"(CASE WHEN trim({x}) = '' THEN 0 ELSE length(trim({x})) - length(replace(trim({x}), ' ', '')) + 1 END)"


# --- fields --------------------------------------------------------------------

LEVEL_WORDS = [
    ("entry", r"entry level|fresher|fresh graduate|0-1 years?|no experience"),
    ("junior", r"junior|1-2 years?|1-3 years?"),
    ("mid", rf"mid[-\t ]level|3-5 years?|4-6 years?|intermediate"),
    ("senior", r"senior|5\+ years?|6\+ years?|7\+ years?|experienced"),
    ("lead", r"lead|principal|architect|10\+ years?|expert"),
]
EDUCATION_WORDS = [
    ("PhD", r"ph\.?d\.?|doctorate|doctoral degree"),
    ("Master''s", r"master''?s?|m\.?s\.?|msc|mba|graduate degree"),
    ("Bachelor''s", r"bachelor''?s?|b\.?s\.?|b\.?sc\.?|b\.?eng\.?|undergraduate degree|4-year degree"),
    ("Associate", r"associate''?s? degree|2-year degree"),
    ("High School", r"high school|secondary school|diploma"),
]
TYPE_WORDS = [
    ("Internship", r"intern|internship|intern position"),
    ("Contract", r"contract|contractor|contractual|temporary|temp"),
    ("Part-time", r"part-time|part time|parttime"),
    ("Full-time", r"full-time|full time|fulltime|permanent"),
]


def cases(x: str, words_: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {word(x, w)} THEN '{n}'" for n, w in words_) + " END"


YEAR_HITS = [
    r"[0-9]+\s*-\s*[0-9]+\s*years?",
    r"[0-9]+\s+to\s+[0-9]+\s*years?",
    r"[0-9]+\+\s*years?",
    r"minimum\s+[0-9]+\s*years?",
    r"at least\s+[0-9]+\s*years?",
]


def year_text(x: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({x}, '{p}'), '')" for p in YEAR_HITS) + ")"


def skill_test(x: str, skill: str) -> str:
    literal = "".join(c if c.isalnum() else f"\\{c}" for c in skill.lower())
    return rf"regexp_matches({x}, '(^|[^\p{{L}}\p{{N}}_+#.]){literal}($|[^\p{{L}}\p{{N}}_+#])')"


def skill_list(x: str, vocabulary: list[str] = VOCABULARY) -> str:
    tests = ", ".join(f"CASE WHEN {skill_test(x, s)} THEN '{s}' END" for s in vocabulary)
    return f"list_filter([{tests}], lambda s: s IS NOT NULL)"


# Expected salaries and dates of the planted values, worked out by hand.
SALARY_CASES = {
    "currency": "CASE doc_id % 8 WHEN 2 THEN 'USD' WHEN 5 THEN 'GBP' WHEN 6 THEN 'USD' WHEN 0 THEN 'PKR' WHEN 1 THEN 'PKR' WHEN 7 THEN 'PKR' END",
    "min": "CAST(CASE doc_id % 8 WHEN 0 THEN 65000 WHEN 1 THEN 70000 WHEN 2 THEN 1250 WHEN 5 THEN 38500 WHEN 6 THEN 240 WHEN 7 THEN 5 END AS BIGINT)",
    "max": "CAST(CASE doc_id % 8 WHEN 0 THEN 95000 WHEN 1 THEN 110000 WHEN 2 THEN 1750 END AS BIGINT)",
    "period": "CASE doc_id % 8 WHEN 0 THEN 'month' WHEN 1 THEN 'month' WHEN 2 THEN 'week' WHEN 5 THEN 'year' WHEN 6 THEN 'hour' WHEN 7 THEN 'month' END",
}
POSTED_CASES = """CASE doc_id % 11
  WHEN 0 THEN TIMESTAMP '2026-09-30 12:00:00' WHEN 1 THEN TIMESTAMP '2026-09-20 12:00:00'
  WHEN 2 THEN TIMESTAMP '2026-10-02 12:00:00' WHEN 3 THEN TIMESTAMP '2026-10-01 12:00:00'
  WHEN 4 THEN TIMESTAMP '2026-08-14 00:00:00' WHEN 5 THEN TIMESTAMP '2026-08-21 00:00:00'
  WHEN 6 THEN TIMESTAMP '2026-08-27 06:45:00' WHEN 7 THEN TIMESTAMP '2026-10-02 09:00:00'
  WHEN 10 THEN TIMESTAMP '2026-09-12 00:00:00' END"""
