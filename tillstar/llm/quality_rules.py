"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Base figures of a text, by words between white space: ``word_chars`` (code points in words), ``n_symbols``
(characters of ``[#*$%&|<>]``), ``n_dup_lines`` (lines with a word that equal an earlier line), ``n_repeat_words``
(words inside windows of three words that occur at least twice in the text). A document fails the base with fewer than
50 words, or when over half of its words repeat.

Each rule rejects a document whose rate (in thousandths, whole numbers) lies above a cutoff. Cutoffs are chosen per
language from labelled documents: for every cutoff, k of n good documents are rejected, and the cutoff is certified
if P(Binomial(n, alpha / rules) <= k) <= delta / (strata * rules), the exact one-sided bound with the union
correction over strata and rules. Within a rule the cutoffs are tested from the most lenient on and testing stops at
the first that fails, which needs no further correction. So with probability 1 - delta no stratum loses more than the
share ``alpha`` of its good documents to all rules together. Among certified cutoffs the one counts that rejects most
bad documents, where a good one weighs as ten bad ones; the more lenient one in case of ties; none if none helps.

Results for special rows: a null text has no words and fails the base. A null language is a stratum of its own. A
document is good if all its labels say so; labels without quality or document don't count. Rows are judged each,
repeated ones too; without labels nothing but the base rejects. Windows are compared by 64-bit hash.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import stored

ALPHA, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COST_OF_GOOD = 10

# Candidate cutoffs of each rule in thousandths, from lenient to strict.
CUTOFFS = {
    "symbols": (400, 300, 200, 150, 100, 70, 50, 40, 30, 20, 15, 10),  # symbols per character in words
    "shouting": (700, 600, 500, 400, 300, 250, 200, 150, 120, 100),  # A-Z and ! per character in words
    "long_words": (20000, 15000, 12000, 10000, 9000, 8000, 7500, 7000),  # characters in words per word
    "dup_lines": (500, 400, 300, 200, 150, 100, 80, 60, 40),  # repeated lines per word
    "repeats": (450, 400, 350, 300, 250, 200, 150, 120, 100, 80, 60),  # repeated words per word
}


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the base figures of each row of ``docs`` (doc_id, lang, text)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    split = rows.select(
        "doc_id", "lang",
        F.expr(r"array_remove(split(text, '[\\x20\\x09-\\x0D]+'), '')").alias("words"),
        F.expr(r"filter(split(text, '\n'), line -> line rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
        F.expr(r"length(text) - length(regexp_replace(text, '[#*$%&|<>]+', ''))").cast("bigint").alias("n_symbols"),
        F.expr(r"length(text) - length(regexp_replace(text, '[A-Z!]+', ''))").cast("bigint").alias("n_shouts"),
    )
    windows = split.select(
        "doc_id", "lang", "n_symbols", "n_shouts",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(
            "if(size(words) < 3, cast(array() as array<struct<h: bigint, i: int>>), transform(sequence(0, size(words) - 3),"
            " i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) as h, i as i)))"
        ).alias("windows"),
    )
    ordered = windows.withColumn("windows", F.sort_array("windows"))
    twice = ordered.withColumn(
        "starts",
        F.expr(
            "array_sort(transform(filter(windows, (w, k) -> (k > 0 and windows[k - 1].h = w.h)"
            " or (k < size(windows) - 1 and windows[k + 1].h = w.h)), w -> w.i))"
        ),
    )
    covered = F.expr(
        "aggregate(starts, struct(0L as words, 0 as upto),"
        " (s, p) -> struct(s.words + (p + 3 - greatest(p, s.upto)) as words, p + 3 as upto), s -> s.words)"
    )
    return twice.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_shouts")


def _per_mille(part: str, whole: str):
    return F.when(F.col(whole) > 0, F.expr(f"({part} * 1000) div {whole}")).otherwise(F.lit(0))


def rates() -> dict:
    return {
        "symbols": _per_mille("n_symbols", "word_chars"),
        "shouting": _per_mille("n_shouts", "word_chars"),
        "long_words": _per_mille("word_chars", "n_words"),
        "dup_lines": _per_mille("n_dup_lines", "n_words"),
        "repeats": _per_mille("n_repeat_words", "n_words"),
    }


def binomial_cdf(k: str, n: str, p: float):
    """P(Binomial(n, p) <= k) as an expression over columns; terms in logarithms, each from the one before."""
    start, odds = math.log1p(-p), math.log(p) - math.log1p(-p)
    return F.expr(
        f"aggregate(if({k} < 1, cast(array() as array<bigint>), sequence(1L, {k})),"
        f" struct({n} * double('{start!r}') as term, exp({n} * double('{start!r}')) as total),"
        f" (s, i) -> struct(s.term + ln(({n} - i + 1) / i) + double('{odds!r}') as term,"
        f" s.total + exp(s.term + ln(({n} - i + 1) / i) + double('{odds!r}')) as total), s -> s.total)"
    )


def certified_cutoffs(found: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """lang, rule and cutoff of the rules that may reject, from ``figures`` and labels (doc_id, quality)."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    passing = found.where(~base_failed()).join(truth, "doc_id")
    share = alpha / len(CUTOFFS)
    judged = passing.select(
        "lang", "quality",
        F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), rate.cast("bigint").alias("rate")) for name, rate in rates().items()])).alias("r"),
    )
    counts = judged.groupBy("lang", "quality", "r.rule", "r.rate").agg(F.count(F.lit(1)).alias("docs"))
    rows = [(name, place, cutoff) for name, cuts in CUTOFFS.items() for place, cutoff in enumerate(cuts)]
    grid = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(p).alias("place"), F.lit(c).alias("cutoff")) for n, p, c in rows]))
    tested = (
        counts.withColumn("g", grid).where("g.rule = rule")
        .groupBy("lang", "rule", "g.place", "g.cutoff").agg(
            F.sum(F.when(F.col("quality") == 1, F.col("docs")).otherwise(0)).alias("n"),
            F.sum(F.when((F.col("quality") == 1) & (F.col("rate") > F.col("g.cutoff")), F.col("docs")).otherwise(0)).alias("k"),
            F.sum(F.when((F.col("quality") == 0) & (F.col("rate") > F.col("g.cutoff")), F.col("docs")).otherwise(0)).alias("bad"),
        )
    )
    strata = tested.select("lang").distinct().agg(F.count(F.lit(1)).alias("strata"))
    level = F.lit(delta) / (strata.scalar() * len(CUTOFFS))
    # k at or above the mean cannot be certified; the sum is only taken below it
    bounded = tested.withColumn("few", F.when(F.col("k") < F.col("n") * share, F.col("k")))
    passed = bounded.withColumn("passed", F.coalesce(binomial_cdf("few", "n", share) <= level, F.lit(False)))
    so_far = Window.partitionBy("lang", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    certified = passed.withColumn("certified", F.min("passed").over(so_far)).where("certified")
    gain = F.col("bad") - COST_OF_GOOD * F.col("k")
    best = certified.withColumn("gain", gain).where("gain > 0").groupBy("lang", "rule").agg(
        F.max_by("cutoff", F.struct("gain", -F.col("place"))).alias("cutoff")
    )
    return best


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base figures, base_failed and kept for each row of ``docs`` (doc_id, lang, text)."""
    found = stored(figures(docs), "figures")
    chosen = certified_cutoffs(found, labels)
    by_language = stored(
        chosen.groupBy("lang").agg(*[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in CUTOFFS]), "cutoffs"
    )
    joined = found.alias("f").join(by_language.alias("c"), F.col("f.lang").eqNullSafe(F.col("c.lang")), "left").select("f.*", *[f"cut_{n}" for n in CUTOFFS])
    rejected = F.lit(False)
    for name, rate in rates().items():
        rejected = rejected | F.coalesce(rate > F.col(f"cut_{name}"), F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"),
    )
