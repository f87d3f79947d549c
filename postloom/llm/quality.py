"""Quality rules with risk-controlled cutoffs.

Each rule is a number of the text that is high in poor texts, divided by a fixed unit; the
score of a text is its greatest.  A document goes if its score lies above the cutoff of its
stratum: all rules are loosened and tightened together along one path fixed beforehand, so
the risk is spent once, on the documents that any rule rejects.

Cutoffs come from labelled documents.  For a cutoff, of the n good texts of the stratum X lie
above it.  It is safe if a false rejection rate above the risk would show so few with a chance
of at most delta: P(Bin(n, risk) <= X) <= delta, an exact binomial test.  Cutoffs are tested
from the loosest on, up to the last safe one (a fixed sequence, so the error does not add up and
the bound holds for each of them).  Of these the loosest is taken that rejects as many poor texts
as the last one does; without poor texts the last one.  Delta is divided by the number of tests, one a stratum.
So with probability 1 - delta, in no stratum are more than ``risk`` of the good documents that the base rules let
pass rejected.

Strata whose labels are too few for any safe cutoff are one stratum together, and with all the
others if those labels are still too few; there the bound holds for the pool.  Counts of labels
alone decide that.  Equal texts of a stratum are one label: copies are not independent.

Everything is built-in functions: no Python runs on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.shared import numbered, small, staged

RISK = 0.02
DELTA = 0.05
SPACES = r"[\x20\x09-\x0D]+"
# Cutoffs of the score that may be chosen, fixed beforehand.
GRID = [i / 50 for i in range(500)]
# Rules and their units: the value at which a rule says as much as the others do at theirs.
RULES = {"symbols": 0.1, "capitals": 0.3, "shouts": 0.1, "copied_lines": 0.3, "repeated_words": 0.2, "same_words": 0.5, "word_length": 10.0}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 5-word window occurring twice or more."""
    # Grams as strings: words hold no space, so joining by one keeps them apart.
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 5),
        lambda i: F.struct(F.concat_ws(" ", *[words[i + j] for j in range(5)]).alias("g"), i.alias("p")),
    )

    def twice(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1
        gram = lambda i: sorted_windows[i]["g"]
        return F.filter(
            F.sequence(F.lit(0), last),
            lambda i: F.when(i > 0, gram(i) == gram(F.greatest(i - 1, F.lit(0)))).otherwise(False)
            | F.when(i < last, gram(i) == gram(F.least(i + 1, last))).otherwise(False),
        )

    ordered = F.transform(F.array(F.array_sort(windows)), lambda s: F.array_sort(F.transform(twice(s), lambda i: s[i]["p"])))[0]
    return F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )


def with_measures(docs: DataFrame) -> DataFrame:
    """Adds ``q``: the counts, the rules and base_failed of each text.  Null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # Several projections: an array used more than once is made once.
    one = docs.select(
        "*",
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("_capitals"),
        F.regexp_count(text, F.lit(r"[!?]{2}")).alias("_shouts"),
    )
    hashes = F.transform("_words", lambda w: F.xxhash64(w))
    two = one.select("*", F.size("_words").alias("_n"), hashes.alias("_hashes"))
    windows = F.transform(F.sequence(F.lit(0), F.col("_n") - 5), lambda i: F.xxhash64(*[F.col("_hashes")[i + j] for j in range(5)]))
    three = two.select("*", F.when(F.col("_n") >= 5, windows).alias("_windows"))
    # Equal windows have equal hashes: without two of those nothing repeats.  Else the words decide.
    maybe = F.size("_windows") > F.size(F.array_distinct("_windows"))
    four = three.select("*", F.when(maybe, _repeated_words(F.col("_words"))).otherwise(0).alias("_repeated"))
    n, chars = F.col("_n"), F.length(F.array_join("_words", ""))
    five = four.select("*", chars.alias("_chars"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_copied"), F.size(F.array_distinct("_hashes")).alias("_kinds"))
    some = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    measures = F.struct(
        n.cast("bigint").alias("n_words"), F.col("_chars").cast("bigint").alias("word_chars"), F.col("_symbols").cast("bigint").alias("n_symbols"),
        F.col("_copied").cast("bigint").alias("n_dup_lines"), F.col("_repeated").cast("bigint").alias("n_repeat_words"),
        ((n < 10) | (100 * F.col("_repeated").cast("bigint") > 20 * n)).alias("base_failed"),
        F.struct(
            some(F.col("_symbols"), n).alias("symbols"), some(F.col("_capitals"), F.col("_chars")).alias("capitals"), some(F.col("_shouts"), n).alias("shouts"),
            some(F.col("_copied"), F.size("_lines")).alias("copied_lines"), some(F.col("_repeated"), n).alias("repeated_words"),
            # Different words grow about as the root of all words, in short and in long texts.
            some(F.sqrt(n), F.col("_kinds")).alias("same_words"), some(F.col("_chars"), n).alias("word_length"),
        ).alias("rules"),
    )
    return five.select(*docs.columns, measures.alias("q"))


def _most_allowed(n: Column, risk: float, log_delta: Column) -> Column:
    """The largest X with P(Bin(n, risk) <= X) <= delta; -1 if there is none.  It lies below n * risk."""
    odds = math.log(risk / (1 - risk))

    def step(a: Column, k: Column) -> Column:
        # a: the log of the k-th probability, of the sum up to it, and the answer so far.
        high, low = F.greatest(a["sum"], a["term"]), F.least(a["sum"], a["term"])
        total = F.when(k == 0, a["term"]).otherwise(high + F.log1p(F.exp(low - high)))
        after = a["term"] + F.log((n - k) / (k + 1)) + F.lit(odds)
        return F.struct(after.alias("term"), total.alias("sum"), F.when(total <= log_delta, k).otherwise(a["best"]).alias("best"))

    first = F.struct((n * math.log1p(-risk)).alias("term"), F.lit(float("-inf")).alias("sum"), F.lit(-1).cast("bigint").alias("best"))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.floor(n * risk)), first, step, lambda a: a["best"])


def score(rules: Column) -> Column:
    """The greatest of the rules in their units."""
    return F.greatest(*[rules[rule] / F.lit(unit) for rule, unit in RULES.items()])


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, grid: list[float] = GRID) -> DataFrame:
    """stratum, ``cutoff``, ``n_good`` and ``pooled``, of rows (doc_id, stratum, text_hash, base_failed, rules) and labels (doc_id, quality).

    One row per stratum of ``measured``; ``n_good`` good texts were tested, of the pool where
    ``pooled``.  A text is good if every label of its copies says 1; null labels and ids say
    nothing.  The cutoff is null where even all labels are too few or none is safe.
    """
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    step = F.lit(grid[1] - grid[0])
    # The number of grid values below the score: it lies above that many cutoffs.
    above = F.when(score(F.col("rules")) > grid[-1], len(grid)).otherwise(F.ceil(score(F.col("rules")) / step)).cast("int")
    texts = (
        measured.filter(~F.col("base_failed")).select("doc_id", "stratum", "text_hash", above.alias("above"))
        .join(marks, "doc_id").groupBy("stratum", "text_hash").agg(F.min("quality").alias("quality"), F.max("above").alias("above"))
    )
    good, poor = F.col("quality") == 1, F.col("quality") != 1
    counts = staged(texts.groupBy("stratum", "above").agg(F.count_if(good).alias("count"), F.count_if(poor).alias("poor")), "labels")
    # At most one row per stratum from here on, or per stratum and grid value.
    sizes = measured.select("stratum").distinct().join(counts.groupBy("stratum").agg(F.sum("count").alias("n")), "stratum", "left").fillna(0, ["n"])
    every = Window.partitionBy()
    # Without exceedances a cutoff is safe from so many labels on: (1 - risk) ** n <= delta / tests.
    enough = lambda tests: F.col("n") * F.lit(math.log1p(-risk)) <= F.log(F.lit(delta) / tests)
    own = sizes.withColumn("own", enough(F.count("*").over(every)))
    few = F.sum(F.when(~F.col("own"), F.col("n")).otherwise(0)).over(every)
    tests = (F.sum(F.col("own").cast("int")).over(every) + F.max((~F.col("own")).cast("int")).over(every)).alias("tests")
    # The pool: of the strata with few labels, or of all.
    wide = few * F.lit(math.log1p(-risk)) > F.log(F.lit(delta) / F.count("*").over(every))
    strata = staged(own.select("stratum", "own", tests, wide.alias("wide")), "strata")
    part = lambda pooled, name: F.struct(F.lit(pooled).alias("pooled"), name.alias("name"))
    itself, joint = part(False, F.col("stratum")), part(True, F.lit(""))
    member = F.when(F.col("own") & F.col("wide"), F.array(itself, joint)).when(F.col("own"), F.array(itself)).otherwise(F.array(joint))
    grouped = counts.join(strata, "stratum").select("tests", "above", "count", "poor", F.inline(member))
    grouped = grouped.groupBy("pooled", "name", "above").agg(F.sum("count").alias("count"), F.sum("poor").alias("poor"), F.max("tests").alias("tests"))
    per = Window.partitionBy("pooled", "name")
    sums = grouped.select(
        "pooled", "name", "tests", "above", F.sum("count").over(per).alias("n"),
        F.lead("above", 1, 0).over(per.orderBy(F.desc("above"))).alias("next"),
        F.sum("count").over(per.orderBy(F.desc("above"))).alias("seen"),
    )
    allowed = sums.select("pooled", "name", "n", "tests").distinct().select("pooled", "name", "n", _most_allowed(F.col("n"), risk, F.log(F.lit(delta) / F.col("tests"))).alias("allowed"))
    # ``seen`` good texts lie above the cutoffs numbered next to above - 1; none above those from the top on.
    tested = sums.drop("n").join(allowed, ["pooled", "name"]).groupBy("pooled", "name", "n").agg(
        F.max("above").alias("top"), F.max("allowed").alias("allowed"), F.min(F.when(F.col("seen") <= F.col("allowed"), F.col("next"))).alias("lowest"),
    )
    last = F.when(F.col("allowed") >= 0, F.coalesce("lowest", "top"))
    safe = tested.select("pooled", "name", "n", last.alias("last"))
    # The poor text nearest above the last safe cutoff bounds the loosest that rejects as many.
    nearest = F.min(F.when((F.col("poor") > 0) & (F.col("above") > F.col("last")), F.col("above")))
    poorest = grouped.join(safe, ["pooled", "name"]).groupBy("pooled", "name", "n", "last").agg(nearest.alias("nearest"))
    number = F.coalesce(F.col("nearest") - 1, "last")
    levels = F.array(*[F.lit(g) for g in grid])
    chosen = poorest.select("pooled", "name", F.col("n").alias("n_good"), F.when(number < len(grid), F.get(levels, number)).alias("cutoff"))
    named = strata.select("stratum", (~F.col("own")).alias("pooled"), F.when(F.col("own"), F.col("stratum")).otherwise("").alias("name"))
    return named.join(chosen, ["pooled", "name"], "left").select("stratum", "cutoff", F.coalesce("n_good", F.lit(0).cast("bigint")).alias("n_good"), "pooled")


def stratum_of(docs: DataFrame) -> Column:
    """The stratum: ``lang`` where there is one."""
    return F.coalesce(F.col("lang").cast("string"), F.lit("?")) if "lang" in docs.columns else F.lit("?")


def verdict(rules: Column, cutoff: Column) -> Column:
    """True unless the score lies above the cutoff; without a cutoff it never does."""
    return F.coalesce(score(rules) <= cutoff, F.lit(True))


def measured_rows(docs: DataFrame) -> DataFrame:
    """uid, doc_id, stratum, text_hash, the counts, base_failed and rules, staged: texts are read once."""
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), stratum_of(docs).alias("stratum"), F.xxhash64("text").alias("text_hash"), "text")
    return staged(with_measures(rows).select("uid", "doc_id", "stratum", "text_hash", "q.*"), "measures")


def quality(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Counts and verdict of each document.

    ``docs`` needs doc_id and text and may have lang; ``labels`` doc_id and quality; other
    columns are ignored.  Null, empty and blank texts have no words and fail.  Null or repeated
    doc_ids: each row is a document of its own.  Empty labels: only the base rule decides.
    Empty ``docs`` give no rows.  Columns: uid, doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score (of the rules) and the stratum's cutoff.
    """
    rows = measured_rows(docs)
    chosen = small(staged(cutoffs(rows, labels, risk, delta), "cutoffs"))
    judged = rows.join(chosen, "stratum", "left")
    kept = ~F.col("base_failed") & verdict(F.col("rules"), F.col("cutoff"))
    return judged.select("uid", "doc_id", *COUNTS, "base_failed", kept.alias("kept"), score(F.col("rules")).alias("score"), "cutoff")


def kept_documents(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Nulls, repeated rows and empty tables as in ``quality``.  Documents are written once beside
    their measures, so each text is measured once; cutoffs read the measures alone and no text
    is shuffled.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), stratum_of(docs).alias("stratum"), F.xxhash64("text").alias("text_hash"), "text")
    measured = staged(with_measures(rows).select("doc", "doc_id", "stratum", "text_hash", "q.base_failed", "q.rules"), "measured")
    chosen = small(staged(cutoffs(measured, labels, risk, delta), "cutoffs"))
    judged = measured.join(chosen, "stratum", "left")
    return judged.filter(~F.col("base_failed") & verdict(F.col("rules"), F.col("cutoff"))).select("doc.*")
