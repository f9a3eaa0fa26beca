"""Quality rules with a hashed n-gram likelihood ratio, in DataFrame functions throughout.

Every text is counted (words, symbols, repeated lines and passages) and scored by how much
likelier its words and pairs of neighbours are under a multinomial over trusted documents than under
one over the raw corpus. These n-grams are hashed into a fixed number of bins; the score is the
mean log ratio over all n-grams of the document, so length does not matter. A fixed
threshold, fitted once, decides for every document.

A null text is an empty one: no words, hence it fails the base rules. Ids are only used to
find the trusted documents; a null id is never trusted, a repeated one counts each time.
Equal texts get equal verdicts. Without any trusted document every log ratio is zero and
the threshold is minus infinity, so the base rules alone decide. Columns that are not named
pass through, and the columns added must not be among them; working columns start with
``__q_``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import WORD, evened, words_of

#: Bins of the hashed n-grams.
BINS = 16384
#: At most so many trusted documents are used, those with the smallest hashed ids.
TRUSTED_LIMIT = 20_000
#: The threshold lets this share of the trusted documents pass ...
TRUSTED_PASS = 0.999
#: ... and lies lower by this share of the distance between that quantile and the median.
MARGIN = 0.5
#: One in so many trusted documents is left out of the counts, for the threshold.
HELD_OUT = 5
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8


@dataclass(frozen=True)
class QualityModel:
    """Log ratio per bin, and the least mean log ratio of a document that is kept."""

    weights: tuple[float, ...]
    threshold: float


def _joined(hashed: Column, step: int) -> Column:
    """Hashes of neighbours ``step`` apart, as many as the array has room for."""
    n = F.greatest(F.size(hashed) - step, F.lit(0))
    return F.zip_with(
        F.slice(hashed, 1, n), F.slice(hashed, step + 1, n), lambda a, b: F.xxhash64(a, b)
    )


def _grams(docs: DataFrame) -> DataFrame:
    """Adds __q_t (the evened text), __q_h (hashed words) and __q_2 (hashed pairs of
    neighbours). Each is a column of its own, so that it is made once for all its uses."""
    return (
        docs.withColumn("__q_t", evened(F.col("text")))
        .withColumn("__q_h", F.transform(words_of(F.col("__q_t")), lambda w: F.xxhash64(w)))
        .withColumn("__q_2", _joined(F.col("__q_h"), 1))
    )


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_LIMIT) -> DataFrame:
    """(doc_id, held) of documents labelled good, as many as the limit allows.

    Held ones stay out of the counts: a document that is counted looks more like the trusted
    ones than others as good do, and a threshold from such scores would be too high.
    """
    return (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
        .withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD_OUT)) == 0)
    )


def fit(docs: DataFrame, labels: DataFrame, bins: int = BINS, limit: int = TRUSTED_LIMIT) -> QualityModel:
    """Counts every n-gram of every document; only the counts per bin reach the driver."""
    chosen = trusted_ids(labels, limit).select(F.col("doc_id").alias("__q_id"), "held")
    marked = docs.select("doc_id", "text").join(
        F.broadcast(chosen),
        F.col("doc_id") == F.col("__q_id"),
        "left",
    )
    counts = (
        _grams(marked)
        .select(
            F.when(~F.col("held"), 1).otherwise(0).alias("good"),
            # The outer form, since the plain one makes Spark evaluate the arrays again in a
            # filter for empty ones.
            F.explode_outer(F.concat("__q_h", "__q_2")).alias("gram"),
        )
        .filter("gram IS NOT NULL")
        .groupBy(F.pmod("gram", F.lit(bins)).alias("bin"))
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
        .collect()
    )
    raw, target = [1.0] * bins, [1.0] * bins  # add-one smoothing
    for r in counts:
        raw[r["bin"]] += r["raw"]
        target[r["bin"]] += r["target"]
    if sum(target) == bins:
        return QualityModel((0.0,) * bins, -math.inf)
    shift = math.log(sum(raw)) - math.log(sum(target))
    weights = tuple(math.log(t / r) + shift for t, r in zip(target, raw, strict=True))
    known = score(marked.filter("held").select("text"), weights)
    long_enough = F.when(F.col("n_words") >= MIN_WORDS, F.col("score"))
    places = F.array(F.lit(1 - TRUSTED_PASS), F.lit(0.5))
    found = known.agg(F.percentile(long_enough, places)).first()[0]
    if not found:
        return QualityModel(weights, -math.inf)
    low, middle = found
    return QualityModel(weights, low - MARGIN * (middle - low))


def _score(weights: tuple[float, ...]) -> Column:
    # One literal to parse and fold, instead of one for each bin.
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    bins = F.lit(len(weights))

    def total(grams: str) -> Column:
        return F.aggregate(
            grams, F.lit(0.0), lambda a, g: a + F.get(table, F.pmod(g, bins).cast("int"))
        )

    n = F.size("__q_h") + F.size("__q_2")
    return F.when(n > 0, (total("__q_h") + total("__q_2")) / n)


def score(docs: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Adds n_words and score, the mean log ratio; null without words."""
    return (
        _grams(docs)
        .withColumns({"n_words": F.size("__q_h").cast("long"), "score": _score(weights)})
        .drop("__q_t", "__q_h", "__q_2")
    )


def _seen(judged: DataFrame, name: str, n: Column) -> DataFrame:
    """Observes rows and how many have the mark.

    It also keeps Spark from pushing a filter on a result below the columns that it is made
    of, which would work them all out again, once for every use, inside the filter.
    """
    return judged.observe(name, F.count("*").alias("rows"), n.alias("marked"))


def counted(docs: DataFrame) -> DataFrame:
    """Adds the counts of the base rules, and base_failed.

    A passage is eight words in a row; the words of every passage found twice or more in the
    text are counted once each. Passages are compared by a 64-bit hash within one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    one = _grams(docs.withColumn("__q_l", lines)).withColumns(
        {
            "n_words": F.size("__q_h").cast("long"),
            "word_chars": F.length(F.replace("__q_t", F.lit(" "), F.lit(""))).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("__q_l") - F.size(F.array_distinct("__q_l"))).cast("long"),
            "__q_4": _joined(F.col("__q_2"), 2),
        }
    )
    # A text without a repeated run of four words has no repeated passage, and most have
    # none; only the others are hashed to the full length and sorted.
    repeats = F.size(F.array_distinct("__q_4")) < F.size("__q_4")
    two = one.withColumn("__q_p", F.when(repeats, _joined(F.col("__q_4"), 4)))
    placed = F.transform("__q_p", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    three = two.withColumn("__q_s", F.sort_array(placed))
    run = F.col("__q_s")
    starts = F.sort_array(
        F.transform(
            F.filter(
                run,
                lambda x, i: (F.get(run, i - 1)["h"].eqNullSafe(x["h"]))
                | (F.get(run, i + 1)["h"].eqNullSafe(x["h"])),
            ),
            lambda x: x["i"],
        )
    )
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )
    four = three.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    out = four.withColumn("base_failed", failed).drop("__q_t", "__q_l", "__q_4", "__q_p", "__q_s")
    return _seen(out, "quality_counted", F.count_if("base_failed"))


def judged(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Adds the counts, base_failed, score and kept to every document."""
    out = counted(docs).withColumn("score", _score(model.weights)).drop("__q_h", "__q_2")
    passes = F.col("score") >= F.lit(float(model.threshold))
    out = out.withColumn("kept", ~F.col("base_failed") & F.coalesce(passes, F.lit(False)))
    return _seen(out, "quality_judged", F.count_if("kept"))


def passed(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judged(docs, model).filter("kept").select(*docs.columns)
