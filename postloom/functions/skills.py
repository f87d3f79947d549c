"""Skill matching against a vocabulary.

A vocabulary given as a table, of any size, is joined on word n-grams (``skill_pairs``).
A list written in code becomes literal expressions: no join, and a cheap substring
test in front of every regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.fixed_values import SOFT_SKILL_WORDS, TOOL_SKILL_WORDS, WORD
from postloom.functions.text import contains_any, let

_CHUNK = 100

def _literal(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def skill_regex(skill: str) -> str:
    """The skill as a whole token; '+', '#' and '.' belong to tokens ("C++", ".NET").

    The literal comes first and what precedes it is checked from its end, so the
    search skips through the text by the literal.
    """
    literal = _literal(skill.lower())
    return rf"{literal}(?<!{WORD}{literal})(?<![+#.]{literal})(?!{WORD})(?![+#])"


def matched_skills(low_text: Column, vocabulary: list[str]) -> Column:
    """Skills of the vocabulary that occur in a lowered text."""
    chunks = []
    for start in range(0, len(vocabulary), _CHUNK):
        tests = [
            F.when(
                F.contains(low_text, F.lit(s.lower())) & low_text.rlike(skill_regex(s)), F.lit(s)
            )
            for s in vocabulary[start : start + _CHUNK]
        ]
        chunks.append(F.array_compact(F.array(*tests)))
    if not chunks:
        return F.array().cast("array<string>")
    return chunks[0] if len(chunks) == 1 else F.concat(*chunks)


def skill_category(skill: Column) -> Column:
    """Soft words first, then tool words; everything else is technical."""
    low = F.lower(skill)
    return (
        F.when(contains_any(low, SOFT_SKILL_WORDS), "soft")
        .when(contains_any(low, TOOL_SKILL_WORDS), "tools")
        .otherwise("technical")
    )


def skill_groups(skills: Column) -> Column:
    """``struct<technical, soft, tools>`` of sorted lists."""
    def of(name: str) -> Column:
        return F.sort_array(F.filter(skills, lambda s: skill_category(s) == name)).alias(name)

    return F.struct(of("technical"), of("soft"), of("tools"))


_TOKEN = r"([\p{L}\p{N}_+#.]+|[^\p{L}\p{N}_+#.])"


def _tokens(low_text: Column) -> Column:
    """Runs of token characters and single other characters; their concatenation is the text."""
    return F.regexp_extract_all(low_text, F.lit(_TOKEN), F.lit(1))


def _indexed(at: Callable[[Column, int], Column], n: int) -> Callable[[Column, Column], Column]:
    return lambda _token, i: at(i, n)


def skill_pairs(texts: DataFrame, vocabulary: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, skill) pairs for a vocabulary table of any size, by equi-join on token n-grams.

    A match starts where a run of token characters starts and ends at a run's end
    or in front of a dot, so every candidate is a sequence of tokens, as many
    as a skill of the vocabulary has, that may be cut in front of one of its dots.
    Candidates are made distinct inside each text and must pass a Bloom filter of the vocabulary
    before they are shuffled: what travels follows the matches, not the texts.  The optimizer
    broadcasts the vocabulary only if it measures small.
    """
    words = vocabulary.select(F.col("skill"), F.lower("skill").alias("_gram"))
    return candidate_grams(texts, vocabulary, key=key, text=text).join(words, "_gram").select(key, "skill").distinct()


# Bits of the filter: this many per skill, within these bounds (at most 1 MB).
_FILTER_BITS, _LEAST_BITS, _MOST_BITS = 16, 1 << 15, 1 << 23


def _positions(gram: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(gram, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def vocabulary_filter(vocabulary: DataFrame) -> Callable[[Column], Column]:
    """May a text be a lower-cased skill of the vocabulary: never a wrong no, and few wrong yeses.

    The bits are built by aggregation and handed to the plan as one literal.  Beyond half a million
    skills the filter no longer grows and lets more through; the join decides in any case.
    """
    grams = vocabulary.select(F.lower("skill").alias("g"))
    bits = _LEAST_BITS
    while bits < min(_MOST_BITS, _FILTER_BITS * grams.count()):
        bits *= 2
    places = grams.select(F.explode(F.array(*_positions(F.col("g"), bits))).alias("p")).distinct()
    maps = places.groupBy(F.floor(F.col("p") / 32768).alias("map")).agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("bits")).collect()
    whole = bytearray(bits // 8)
    for row in maps:  # at most 256, of 4 KB each
        whole[row["map"] * 4096 : row["map"] * 4096 + 4096] = row["bits"]
    held = F.lit(bytes(whole))

    def is_set(position: Column) -> Column:
        byte = F.conv(F.hex(F.substr(held, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (position % 8).cast("int")) == 1

    def may_hold(gram: Column) -> Column:
        first, second = _positions(gram, bits)
        return is_set(first) & is_set(second)

    return may_hold


def candidate_grams(texts: DataFrame, vocabulary: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, _gram): the distinct n-grams of each text that the filter of the vocabulary lets through."""
    low = F.lower(F.col(text))
    skill = F.lower("skill")
    # How many tokens its skills have: a few numbers.
    lengths = [r.n for r in vocabulary.select(F.size(_tokens(skill)).alias("n")).distinct().collect()]
    sizes = sorted(lengths)  # a cut form has as many tokens as it had
    may_hold = vocabulary_filter(vocabulary)

    def cuts(token: Column) -> Column:
        """The token cut in front of each of its dots."""
        dots = F.filter(
            F.sequence(F.lit(2), F.greatest(F.length(token), F.lit(2))),
            lambda i: F.substr(token, i, F.lit(1)) == ".",
        )
        return F.transform(dots, lambda i: F.substr(token, F.lit(1), i - 1))

    def with_cuts(grams: Column) -> Column:
        """Distinct n-grams plus the cut forms of those that hold a dot."""
        return let(
            F.array_distinct(grams),
            lambda g: F.concat(
                g, F.flatten(F.transform(F.filter(g, lambda t: F.contains(t, F.lit("."))), cuts))
            ),
        )

    def grams(tokens: Column) -> Column:
        parts = []
        for n in sizes:
            def at(i: Column, n: int) -> Column:
                return F.concat(*[F.get(tokens, i + k) for k in range(n)])

            # Positions past the last whole n-gram give null and drop out.
            parts.append(F.array_compact(F.transform(tokens, _indexed(at, n))))
        return with_cuts(F.concat(*parts) if parts else F.array().cast("array<string>"))

    return (
        texts.select(F.col(key), low.alias("_low"))
        .withColumn("_tokens", _tokens(F.col("_low")))
        .select(key, F.explode(grams(F.col("_tokens"))).alias("_gram"))
        .filter(may_hold(F.col("_gram")))
    )
