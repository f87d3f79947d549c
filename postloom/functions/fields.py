"""Fields read out of a posting's text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.boards import BOARDS, Boards
from postloom.fixed_values import (
    DEFAULT_JOB_TYPE,
    EDUCATION,
    JOB_TYPES,
    LEVELS,
    NO_SALARY,
    PERIODS,
    PLACEHOLDERS,
    SALARY_NUMBER,
    SCORE_POINTS,
    WORD,
    WS,
    YEAR_RANGES,
)
from postloom.functions.text import contains_any, let, null_if_empty, strip

BEFORE_WORD = f"(?<!{WORD})"
AFTER_WORD = f"(?!{WORD})"

# Every text a pattern matches holds one of these substrings.  Looking for them is
# far cheaper than a regular expression, which then runs on few texts.
NEEDLES = {
    "entry": ["entry level", "fresher", "fresh graduate", "0-1 year", "no experience"],
    "junior": ["junior", "1-2 year", "1-3 year"],
    "mid": ["mid", "3-5 year", "4-6 year", "intermediate"],
    "senior": ["senior", "5+ year", "6+ year", "7+ year", "experienced"],
    "lead": ["lead", "principal", "architect", "10+ year", "expert"],
    "PhD": ["phd", "ph.d", "doctora"],
    "Master's": ["master", "ms", "m.s", "mba", "graduate degree"],
    "Bachelor's": ["bachelor", "bs", "b.s", "beng", "b.eng", "undergraduate degree", "4-year degree"],
    "Associate": ["associate", "2-year degree"],
    "High School": ["high school", "secondary school", "diploma"],
    "Internship": ["intern"],
    "Contract": ["contract", "temp"],
    "Part-time": ["part-time", "part time", "parttime"],
    "Full-time": ["full-time", "full time", "fulltime", "permanent"],
}


def is_blank(value: Column) -> Column:
    """Null, or a text that only stands for "nothing"."""
    return F.lower(strip(F.coalesce(value, F.lit("")))).isin(PLACEHOLDERS)


def is_blank_list(value: Column) -> Column:
    return F.coalesce(F.size(value), F.lit(0)) <= 0


def first_match(text: Column, patterns: dict[str, str]) -> Column:
    """Name of the first pattern that occurs as whole words.

    Optional dots end some patterns, so the end test is either no word character
    after the match or, after a dot, any character: both mean a word edge.
    """
    end = f"(?:(?<={WORD}){AFTER_WORD}|(?<!{WORD})(?={WORD}))"
    tests = []
    for name, pattern in patterns.items():
        firsts = "".join(sorted({n[0] for n in NEEDLES[name]}))
        regex = f"(?=[{firsts}]){BEFORE_WORD}{pattern}{end}"
        tests.append(F.when(contains_any(text, NEEDLES[name]) & text.rlike(regex), F.lit(name)))
    return F.coalesce(*tests)


def field_and_text(field: Column, text: Column) -> Column:
    """The board's own field in front of the text, lowered."""
    return F.lower(F.concat_ws(" ", F.coalesce(field, F.lit("")), F.coalesce(text, F.lit(""))))


# --- experience ------------------------------------------------------------

_RANGES = [
    p.replace("WS", WS).replace("([0-9]+)", "(?=[0-9])(?<![0-9])([0-9]++)", 1) for p in YEAR_RANGES
]


def experience_level(low_text: Column) -> Column:
    return F.coalesce(first_match(low_text, LEVELS), F.lit("unknown"))


def experience(low_text: Column) -> Column:
    """``struct<min_years, max_years, level, raw_text>``; the first pattern wins, not the first place.

    The text is worked out once: inside ``let`` each of its many uses would lower the whole of it again.
    """
    return let(low_text, _experience)


def _experience(low_text: Column) -> Column:
    raw = F.when(
        F.contains(low_text, F.lit("year")),
        F.coalesce(*[let(F.regexp_extract(low_text, p, 0), null_if_empty) for p in _RANGES]),
    )

    def parts(raw_text: Column) -> Column:
        first = F.regexp_extract(raw_text, "([0-9]+)", 1).try_cast("bigint")
        second = F.regexp_extract(raw_text, "^[0-9]+[^0-9]+([0-9]+)", 1).try_cast("bigint")
        return F.struct(
            F.coalesce(first, F.lit(0).cast("bigint")).alias("min_years"),
            second.alias("max_years"),
            experience_level(low_text).alias("level"),
            raw_text.alias("raw_text"),
        )

    return let(raw, parts)


def experience_years(parsed: Column, field: Column) -> Column:
    """One integer per posting; a true 0 differs from an unknown null."""
    known = (F.coalesce(parsed["raw_text"], F.lit("")) != "") | (
        F.coalesce(parsed["level"], F.lit("unknown")).isin("", "unknown") == F.lit(False)
    )
    years = parsed["min_years"]
    digits = F.regexp_extract(field, "([0-9]+)", 1).try_cast("bigint")
    return F.when(known, F.coalesce(years, F.lit(0))).when(years > 0, years).otherwise(digits).cast("int")


# --- salary ----------------------------------------------------------------


def salary(raw: Column) -> Column:
    """``struct<currency, min, max, period, raw>`` or null when no amount is given."""
    low = F.lower(raw)
    currency = (
        F.when(contains_any(low, ["$", "usd"]), "USD")
        .when(contains_any(low, ["£", "gbp"]), "GBP")
        .when(contains_any(low, ["€", "eur"]), "EUR")
        .otherwise("PKR")
    )
    period = F.coalesce(
        *[F.when(contains_any(low, words), F.lit(name)) for name, words in PERIODS.items()],
        F.lit("month"),
    )
    pattern = F.lit(SALARY_NUMBER)
    amounts = F.transform(
        F.arrays_zip(
            F.regexp_extract_all(raw, pattern, F.lit(1)).alias("digits"),
            F.regexp_extract_all(raw, pattern, F.lit(2)).alias("k"),
        ),
        lambda m: (
            F.replace(m["digits"], F.lit(","), F.lit("")).try_cast("double")
            * F.when(m["k"] != "", 1000.0).otherwise(1.0)
        ).try_cast("bigint"),
    )
    found = let(
        amounts,
        lambda a: F.when(
            F.size(a) > 0,
            F.struct(
                currency.alias("currency"),
                F.array_min(a).alias("min"),
                F.when(F.size(a) > 1, F.array_max(a)).alias("max"),
                period.alias("period"),
                raw.alias("raw"),
            ),
        ),
    )
    return F.when((raw != "") & ~low.isin(NO_SALARY), found)


# --- education, type -------------------------------------------------------


def education(low_text: Column) -> Column:
    return first_match(low_text, EDUCATION)


def job_type(field: Column, low_text: Column) -> Column:
    """The board's own field first, then the text, then full time."""
    return F.coalesce(
        first_match(F.lower(field), JOB_TYPES), first_match(low_text, JOB_TYPES), F.lit(DEFAULT_JOB_TYPE)
    )


def employment_type(fragment: Column, board: Column, boards: Boards = BOARDS) -> Column:
    """Type named in a page fragment; boards without types in full words accept the bare "full" and "part"."""
    low = F.lower(fragment)
    strict = (
        F.when(contains_any(low, ["full-time", "full time"]), "full-time")
        .when(F.contains(low, F.lit("part-time")), "part-time")
        .when(F.contains(low, F.lit("contract")), "contract")
        .when(F.contains(low, F.lit("internship")), "internship")
        .when(boards.has(board, "interns are internships") & F.contains(low, F.lit("intern")), "internship")
    )
    loose = (
        F.when(F.contains(low, F.lit("full")), "full-time")
        .when(F.contains(low, F.lit("part")), "part-time")
        .when(F.contains(low, F.lit("contract")), "contract")
        .when(F.contains(low, F.lit("intern")), "internship")
    )
    return F.when(boards.has(board, "types in full words"), strict).otherwise(loose)


# --- score -----------------------------------------------------------------


def confidence(words: Column, n_sections: Column, n_skills: Column, exp: Column, pay: Column, edu: Column) -> Column:
    """Score in hundredths, then divided once, so no rounding drifts in."""
    p = SCORE_POINTS
    points = (
        F.lit(p["base"] + p["job_type"])
        + F.when(words > 100, p["long_text"]).otherwise(0)
        + F.when(n_sections > 1, p["sections"]).otherwise(0)
        + F.when(n_skills >= 3, p["three_skills"]).otherwise(0)
        + F.when(n_skills >= 7, p["seven_skills"]).otherwise(0)
        + F.when((exp["min_years"] > 0) | (exp["level"] != "unknown"), p["experience"]).otherwise(0)
        + F.when(pay.isNotNull(), p["salary"]).otherwise(0)
        + F.when(edu.isNotNull(), p["education"]).otherwise(0)
    )
    return F.least(points, F.lit(100)) / F.lit(100.0)
