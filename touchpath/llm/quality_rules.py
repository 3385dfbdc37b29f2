"""Quality rules with risk-controlled thresholds, on DataFrame functions only.

Each rule compares one measure of a document with a cutoff. Cutoffs are not set by hand:
labelled documents of good quality are the holdout. Rule sets (a cutoff for each rule)
are ordered from mild to strict, and per stratum the strictest set is taken whose joint
rate of falsely rejected good documents is proven to be small. The proof is an exact
binomial test: with ``n`` good documents of which ``k`` would be rejected by any rule, the
set passes if ``P(Binomial(n, alpha) <= k)`` is at most its share of ``delta``. ``delta`` is
divided over the strata and the pool (Bonferroni); the sets of one stratum are tested from
the mildest on and end at the first that fails (fixed sequence), which needs no further
correction. So a stratum loses at most ``alpha`` of its good documents, for all strata
together with probability ``1 - delta``.

A stratum too small for any proof (even without a false rejection) takes the set proven on
the good documents of all strata; ``proven_on`` of its cutoffs says 'all strata', and the
bound holds for the pool, not for the stratum alone. A stratum large enough whose mildest
set fails rejects nothing beyond the base rules.

NULL and empty texts have no words and fail the base rules. A NULL stratum counts as ''.
Labels with NULL quality are ignored; a document with several labels is good if one says
so; labels of unknown documents are ignored. Rows with equal ids are judged one by one.
Window identity is by 64-bit hash inside one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.llm.common import GAP, WHITE, WORD, bound, settled, spread_join, written

SYMBOL = r"[#*$%&|<>]"
ALPHA, DELTA = 0.02, 0.05
MIN_WORDS, REPEAT_PERCENT, SPAN = 50, 50, 3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (1.0, 0.5, 0.3, 0.2, 0.1)),
    "lines": ("n_dup_lines / n_lines", (0.8, 0.6, 0.4, 0.3, 0.2)),
    "repeats": ("n_repeat_words / n_words", (0.45, 0.4, 0.3, 0.2, 0.1)),
    "long_words": ("word_chars / n_words", (20.0, 15.0, 12.0, 10.0, 9.0)),
    "short_words": ("- word_chars / n_words", (-1.5, -2.0, -2.5, -3.0, -3.5)),
}

STEPS = 5


def _covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs at least twice."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        def same(j: Column, h: Column) -> Column:
            return F.coalesce(F.get(s, j)["h"] == h, F.lit(False))
        return F.filter(s, lambda x, j: same(j - 1, x["h"]) | same(j + 1, x["h"]))

    def covered(p: Column) -> Column:
        parts = F.transform(p, lambda x, j: F.least(
            F.lit(SPAN), F.coalesce(F.get(p, j + 1) - x, F.lit(SPAN))
        ))
        return F.aggregate(parts, F.lit(0), lambda a, x: a + x)

    positions = bound(ordered, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
    return bound(positions, covered)


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base columns, ``n_lines`` and ``base_failed`` under ``q``."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = settled(docs, "__part", F.struct(
        bound(F.btrim(body, F.lit(WHITE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, GAP))).alias("words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    ))
    words, lines = F.col("__part.words"), F.col("__part.lines")
    n = F.size(words)
    def rest(w: Column, k: int) -> Column:
        return F.slice(w, F.lit(k + 1), F.size(w))
    windows = F.when(n >= SPAN, bound(words, lambda w: F.slice(
        F.zip_with(F.zip_with(w, rest(w, 1), lambda a, b: F.xxhash64(a, b)), rest(w, 2), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.size(w) - SPAN + 1
    ))).otherwise(F.array().cast("array<bigint>"))
    repeated = bound(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)
    ).otherwise(_covered_words(h)))
    counted = settled(split, "__counted", F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    ))
    failed = (F.col("__counted.n_words") < MIN_WORDS) | (
        100 * F.col("__counted.n_repeat_words") > REPEAT_PERCENT * F.col("__counted.n_words")
    )
    return counted.withColumn("q", F.col("__counted").withField("base_failed", failed)).drop("__part", "__counted")


def narrow(featured: DataFrame, doc_id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    return featured.select(
        F.col(doc_id).alias("doc_id"), _stratum(stratum).alias("stratum"), "q.*"
    )


def _stratum(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _measure(rule: str) -> Column:
    return F.expr(RULES[rule][0])


def _log_gamma(x: Column) -> Column:
    """Stirling's series after a shift by eight, to about 1e-12."""
    y = x + 8
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """``P(Binomial(n, p) <= k)``; 1 where k is at least n * p, as no test passes there."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) \
        + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    state = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    down = F.when(k >= 1, F.sequence(k.cast("long"), F.lit(1).cast("long"))).otherwise(
        F.array().cast("array<bigint>"))
    total = F.aggregate(down, state, step)["sum"]
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * total)


def _tested(features: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    """One row per stratum with good labels and one for the pool (``pool``): ``enough`` labels for a proof, ``step`` proven."""
    good = (
        labels.where(F.col("quality").isNotNull()).groupBy("doc_id")
        .agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    )
    held = features.where("not base_failed").join(good, "doc_id", "left_semi")

    def rejected(step: int) -> Column:
        tests = [F.coalesce(_measure(rule) > cuts[step], F.lit(False)) for rule, (_, cuts) in RULES.items()]
        return F.exists(F.array(*tests), lambda x: x)
    steps = [F.count_if(rejected(i)).alias(f"k_{i}") for i in range(STEPS)]
    own = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *steps)
    own = own.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy()))
    pool = F.struct(F.lit(None).cast("string").alias("stratum"), F.lit(True).alias("pool"))
    each = own.select(F.explode(F.array(F.struct("stratum", F.lit(False).alias("pool")), pool)).alias("s"), *own.columns[1:])
    counts = each.groupBy("s.stratum", "s.pool").agg(
        F.max("strata").alias("strata"), F.sum("n").alias("n"), *[F.sum(f"k_{i}").alias(f"k_{i}") for i in range(STEPS)])
    share = F.lit(delta) / (F.col("strata") + 1)
    passed = F.array(*[binomial_tail(F.col("n"), F.col(f"k_{i}"), alpha) <= share for i in range(STEPS)])
    failed = F.array_position(passed, F.lit(False)).cast("int")
    return counts.select(
        "stratum", "pool", (F.pow(F.lit(1 - alpha), F.col("n")) <= share).alias("enough"),
        (F.when(failed == 0, STEPS).otherwise(failed - 1) - 1).alias("step"))


def _cuts(step: Column) -> list[Column]:
    """``cut_<rule>`` of a step, NULL where it is negative or NULL."""
    return [F.when(step >= 0, F.get(F.array(*map(F.lit, cuts)), step)).alias(f"cut_{rule}") for rule, (_, cuts) in RULES.items()]


def thresholds(
    features: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """One row with ``cut_<rule>`` per stratum that has a proven rule set of its own.

    ``features``: doc_id, stratum and the base columns; ``labels``: doc_id, quality.
    """
    proven = _tested(features, labels, alpha, delta).where("not pool and step >= 0")
    return proven.select("stratum", *_cuts(F.col("step")))


def cutoffs_for(
    features: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """One row per stratum of ``features``: ``cut_<rule>`` and ``proven_on`` ('stratum', 'all strata' or NULL)."""
    tested = written(_tested(features, labels, alpha, delta), "quality-tests")
    pool = tested.where("pool").select(F.col("step").alias("pool_step"))
    own = tested.where("not pool").drop("pool")
    joined = features.select("stratum").distinct().join(own, "stratum", "left").join(pool, how="left")
    alone = F.coalesce("enough", F.lit(False))
    step = F.when(alone, F.col("step")).otherwise(F.col("pool_step"))
    return joined.select("stratum", *_cuts(step), F.when(step >= 0, F.when(alone, "stratum").otherwise("all strata")).alias("proven_on"))


def with_verdict(features: DataFrame, cutoffs: DataFrame, by: Column) -> DataFrame:
    """Adds ``kept``; ``features`` has ``stratum`` and the base columns."""
    joined = spread_join(features, cutoffs, ["stratum"], by)
    rejected = F.col("base_failed")
    for rule in RULES:
        rejected |= F.coalesce(_measure(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return joined.withColumn("kept", ~rejected).drop("proven_on", *[f"cut_{r}" for r in RULES])


def quality_report(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, the base columns, base_failed and kept, one row per input row."""
    features = written(narrow(with_features(docs), stratum=stratum), "quality-features")
    cutoffs = written(cutoffs_for(features, labels), "quality-cutoffs")
    judged = with_verdict(features, cutoffs, F.col("doc_id"))
    return judged.select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged; texts are not shuffled twice."""
    kept = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)]
    named = docs.select(*kept, "doc_id", "text", F.col(stratum).alias("__stratum"))
    own = [f"__c{i}" for i in range(len(kept))]
    featured = written(with_features(named).select(
        *own, "doc_id", _stratum("__stratum").alias("stratum"), "q.*"), "quality-featured")  # measured once
    cutoffs = written(cutoffs_for(featured.drop(*own), labels), "quality-cutoffs")
    judged = with_verdict(featured, cutoffs, F.col("doc_id"))
    return judged.where("kept").select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
