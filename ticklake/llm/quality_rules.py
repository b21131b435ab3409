"""Quality rules: an ordered list of threshold conjunctions, learned by sequential covering.

Statistics of every whole text come from DataFrame functions alone.  Rules for
"low quality" are grown condition by condition (information gain on two
thirds of the labelled documents), pruned on the other third and accepted
while they stay precise there; what a rule covers is taken out before the
next is grown.  Each step is one aggregate over the labelled statistics whose
result is a bounded table (statistics x thresholds).  The list is emitted as
a chain of ``F.when``.

Cases: a null text has no words, so it fails the base rule; documents without
a label, with a null label or repeated labels (the mean decides) are fine; no
labels at all give an empty list, which keeps what passes the base rule; an
empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import staged

WORD_GAP = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
POSITION_BITS = 28
STATISTICS = ["words", "word_length", "symbols", "dup_lines", "repeats", "upper", "distinct", "line_words"]
#: Of the learner: quantiles of each class tried per statistic, conditions per rule, rules, and what a rule must reach on the pruning third.
N_THRESHOLDS, MAX_CONDITIONS, MAX_RULES, MIN_PRECISION, MIN_COVER = 32, 4, 12, 0.9, 3


def text_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of every whole text: the base statistics and n_lines, n_upper, n_distinct.

    Write the result before filtering on it: a filter pushed below would repeat the nested array expressions.
    """
    df = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", WORD_GAP), ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # three-word windows: 36 bits of a hash above the position, so that a sort of longs brings equal ones together
    df = df.withColumn("_sorted", F.expr(
        f"""CASE WHEN size(_words) >= 3 THEN sort_array(transform(sequence(0, size(_words) - 3), i ->
            shiftleft(xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2)), {POSITION_BITS}) | CAST(i AS BIGINT)))
            ELSE CAST(array() AS ARRAY<BIGINT>) END"""))
    df = df.withColumn("_near", F.expr(
        f"""filter(_sorted, (x, i) ->
            shiftrightunsigned(x, {POSITION_BITS}) <=> shiftrightunsigned(get(_sorted, i - 1), {POSITION_BITS})
            OR shiftrightunsigned(x, {POSITION_BITS}) <=> shiftrightunsigned(get(_sorted, i + 1), {POSITION_BITS}))"""))
    # whole words decide among those
    df = df.withColumn("_grams", F.expr(
        f"""sort_array(transform(transform(_near, x -> CAST(x & {2**POSITION_BITS - 1} AS INT)), p ->
            struct(concat_ws(' ', get(_words, p), get(_words, p + 1), get(_words, p + 2)) AS g, p AS p)))"""))
    df = df.withColumn("_found", F.expr(
        """array_sort(transform(filter(_grams, (x, i) -> x.g <=> get(_grams, i - 1).g OR x.g <=> get(_grams, i + 1).g), x -> x.p))"""))
    return df.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length("_text") - F.char_length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""aggregate(transform(_found, (p, i) -> CAST(least(3, coalesce(get(_found, i + 1), p + 3) - p) AS BIGINT)),
                  0L, (a, x) -> a + x)""").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.char_length("_text") - F.char_length(F.regexp_replace("_text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"))


def ratios() -> dict[str, Column]:
    """The statistics that rules may test, from the counts."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / chars, "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words, "upper": F.col("n_upper") / chars,
        "distinct": F.col("n_distinct") / words, "line_words": F.col("n_words") / lines,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(self.statistic)
        return x >= F.lit(self.threshold) if self.at_least else x < F.lit(self.threshold)


Rule = tuple[Condition, ...]


def conjunction(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def rejected(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: true where some rule rejects."""
    if not rules:
        return F.lit(False)
    out = F.when(conjunction(rules[0]), F.lit(True))
    for rule in rules[1:]:
        out = out.when(conjunction(rule), F.lit(True))
    return out.otherwise(F.lit(False))


def _entropy_gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def _best_condition(counts: dict[str, dict[int, tuple[int, int]]], thresholds: dict[str, list[float]],
                    p0: int, n0: int) -> tuple[float, Condition | None, int, int]:
    best: tuple[float, Condition | None, int, int] = (1e-9, None, p0, n0)
    for name in STATISTICS:
        p = n = 0
        for b, threshold in enumerate(thresholds[name]):  # bin b holds what lies below threshold b and not below b - 1
            dp, dn = counts.get(name, {}).get(b, (0, 0))
            p, n = p + dp, n + dn
            for at_least, p1, n1 in ((False, p, n), (True, p0 - p, n0 - n)):
                if p1 >= MIN_COVER and p1 + n1 < p0 + n0:
                    gain = _entropy_gain(p0, n0, p1, n1)
                    if gain > best[0]:
                        best = (gain, Condition(name, at_least, threshold), p1, n1)
    return best


def _bin(name: str, thresholds: list[float]) -> Column:
    """How many of the thresholds the statistic reaches."""
    return F.size(F.filter(F.array(*(F.lit(float(t)) for t in thresholds)), lambda t: t <= F.col(name)))


def learn(labelled: DataFrame) -> list[Rule]:
    """Rules for label 0 from a table (doc_id, quality, counts of ``text_statistics``); what the base rule rejects is left out."""
    train = staged(labelled.filter(F.col("quality").isNotNull() & ~base_failed()).select(
        (F.col("quality") < 0.5).alias("low"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0).alias("grow"),
        *(c.alias(k) for k, c in ratios().items())), "rule-training")
    steps = [i / N_THRESHOLDS for i in range(N_THRESHOLDS + 1)]
    cuts = train.agg(*(F.percentile_approx(F.when(F.col("low") == low, F.col(k)), steps, 2000).alias(f"{k}{low:d}")
                       for k in STATISTICS for low in (False, True))).first()
    thresholds = {}
    for k in STATISTICS:  # the classes' quantiles, ends included, and what lies midway between neighbours
        at = sorted({*(cuts[f"{k}0"] or []), *(cuts[f"{k}1"] or [])})
        thresholds[k] = sorted({*at, *((a + b) / 2 for a, b in zip(at, at[1:], strict=False))})
    binned = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), _bin(k, thresholds[k]).alias("b")) for k in STATISTICS if thresholds[k])))
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(thresholds.values()):
        left = train.filter(~rejected(rules))
        rule: Rule = ()
        p0 = n0 = -1
        while len(rule) < MAX_CONDITIONS and (n0 or not rule):
            rows = (left.filter(F.col("grow") & conjunction(rule)).select("low", binned.alias("x"))
                    .groupBy("x.k", "x.b").agg(F.count_if("low").alias("p"), F.count_if(~F.col("low")).alias("n")).collect())
            counts: dict[str, dict[int, tuple[int, int]]] = {}
            for r in rows:
                counts.setdefault(r["k"], {})[r["b"]] = (r["p"], r["n"])
            whole = next(iter(counts.values()), {})
            p0, n0 = sum(p for p, _ in whole.values()), sum(n for _, n in whole.values())
            if p0 < MIN_COVER or not n0:
                break
            _, found, p0, n0 = _best_condition(counts, thresholds, p0, n0)
            if found is None:
                break
            rule = (*rule, found)
        if not rule:
            break
        held = left.agg(*(
            F.count_if(conjunction(rule[:k]) & (F.col("low") == low) & ~(F.col("grow") & (part != "all"))).alias(f"{part}{'np'[low]}{k}")
            for k in range(1, len(rule) + 1) for low in (False, True) for part in ("", "all"))).first()
        size = max(range(1, len(rule) + 1), key=lambda k: (
            (held[f"p{k}"] - held[f"n{k}"]) / max(1, held[f"p{k}"] + held[f"n{k}"]), -k))
        p, n, p_all, n_all = (held[f"{part}{x}{size}"] for part in ("", "all") for x in "pn")
        if not p or p < MIN_PRECISION * (p + n) or p_all < MIN_COVER or p_all < MIN_PRECISION * (p_all + n_all):
            break
        rules.append(rule[:size])
    return rules


def labelled_statistics(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the labelled documents, with the mean of each document's labels."""
    mean = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").alias("_labelled")).agg(F.avg("quality").alias("quality")))
    return statistics.join(mean, F.col("doc_id") == F.col("_labelled")).drop("_labelled")


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the base rule or the learned list rejects.

    Statistics are joined back by id and by a hash of the text, so rows that
    share an id are judged each by its own text.
    """
    key = F.xxhash64(F.col("text").cast("string"))
    counts = staged(text_statistics(docs.select("doc_id", "text", key.alias("__llm_key")), keep=("doc_id", "__llm_key")), "statistics")
    rules = learn(labelled_statistics(counts, labels))
    good = (counts.withColumns(ratios()).filter(~base_failed() & ~rejected(rules))
            .select(F.col("doc_id").alias("__llm_id"), F.col("__llm_key")).distinct())
    return docs.join(good, F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (key == F.col("__llm_key")), "left_semi")


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every document."""
    counts = staged(text_statistics(docs), "statistics")
    rules = learn(labelled_statistics(counts, labels))
    counts = counts.withColumns(ratios())
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~rejected(rules)).alias("kept"))
