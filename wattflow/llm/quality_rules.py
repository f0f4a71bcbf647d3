"""Quality filter by weak supervision: voting rules, EM over their accuracies.

Everything is DataFrame expressions; there is no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattflow.llm.common import SPACE
from wattflow.session import stage

#: FIXED VALUES: the symbol characters, sentence ends and characters odd in prose, as regex classes.
SYMBOLS = "[#*$%&|<>]+"
STOPS = "[.!?]+"
ODD = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D.,;:!?\"'()¿¡«»“”‘’…–—-]+"

GOOD, BAD, ABSTAIN = 1, 0, -1

#: name -> (SQL value, votes bad when, votes good when); otherwise abstains.
#: Most rules only know a fault when they see one; that a text lacks one fault
#: is no sign of quality, so they abstain.
RULES = {
    "word_size": ("word_chars / n_words", "{v} < 2.5 or {v} > 15", "false"),
    "symbols": ("n_symbols / n_words", "{v} > 0.2", "{v} < 0.02"),
    "odd_characters": ("n_odd / word_chars", "{v} > 0.05", "{v} < 0.005"),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", "{v} > 0.3", "false"),
    "repeats": ("n_repeat_words / n_words", "{v} > 0.3", "false"),
    "shouting": ("n_upper / word_chars", "{v} > 0.4", "false"),
    "sentences": ("n_stops / n_words", "{v} = 0 or {v} > 0.6", "{v} between 0.01 and 0.3"),
}


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each whole text, inside the row: no explode, no shuffle.

    Repeated windows are found by sorting one long per window, its hash above
    its position, and looking at neighbours: n log n in the words of one
    text. The position takes the bits that the text's length needs, which
    leaves a long text short hashes; so the windows found are sorted again by
    their three words, and only those that are equal to a neighbour count.
    Null and blank texts have zero in every count.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = df.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    base = base.withColumn("w", F.array_remove(F.split("t", f"[{SPACE}]+"), ""))
    base = base.withColumn("n_words", F.size("w").cast("long")).withColumn("k", _position_bits())
    lines = F.filter(F.split("t", "\n"), lambda x: _without(x, f"[{SPACE}]+") != F.lit(""))
    chars = F.length("t")

    def left_out(pattern: str) -> Column:
        return (chars - F.length(_without(F.col("t"), pattern))).cast("long")

    windows = F.when(F.col("n_words") >= 4, F.sort_array(F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")),
        lambda i: _shift("shiftleft", F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
        + i)))
    out = base.select(
        "doc_id", "n_words",
        F.length(_without(F.col("t"), f"[{SPACE}]+")).cast("long").alias("word_chars"),
        left_out(SYMBOLS).alias("n_symbols"), left_out(r"\p{Lu}+").alias("n_upper"),
        left_out(STOPS).alias("n_stops"), left_out(ODD).alias("n_odd"), lines.alias("l"), "k", "w",
        windows.alias("g"))

    def twin(x: Column, at: Column) -> Column:
        h = _shift("shiftright", x)
        return (_shift("shiftright", F.get("g", at + 1)) == h) | (_shift("shiftright", F.get("g", at - 1)) == h)

    low = _shift("shiftleft", F.lit(1).cast("long")) - 1
    likely = F.transform(F.filter("g", lambda x, at: F.coalesce(twin(x, at), F.lit(False))), lambda x: x.bitwiseAND(low))
    out = out.withColumn("c", F.sort_array(F.transform(likely, lambda i: F.struct(
        *[F.get("w", (i + j).cast("int")).alias(f"w{j}") for j in range(3)], i.alias("at")))))

    def equal(x: Column, at: Column) -> Column:
        return F.when(at >= 0, F.struct(*[F.get("c", at)[f"w{j}"] for j in range(3)])
                      == F.struct(*[x[f"w{j}"] for j in range(3)]))

    out = out.withColumn("at", F.sort_array(F.transform(
        F.filter("c", lambda x, at: F.coalesce(equal(x, at + 1), F.lit(False)) | F.coalesce(equal(x, at - 1), F.lit(False))),
        lambda x: x["at"])))
    # a window covers three words; the next repeated window starts d words on: min(3, d) are new
    covered = F.aggregate(
        "at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda acc, i: F.struct(
            (acc.getField("n") + F.least(F.lit(3).cast("long"), i - acc.getField("last"))).alias("n"),
            i.alias("last")),
        lambda acc: acc.getField("n"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_stops", "n_odd",
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _position_bits() -> Column:
    """Bits that number the words of a text."""
    return F.length(F.bin("n_words"))


def _shift(how: str, x: Column) -> Column:
    return F.call_function(how, x, F.col("k"))


def _votes() -> list[Column]:
    out = []
    for name, (value, bad, good) in RULES.items():
        v = f"({value})"
        out.append(F.expr(f"case when n_words = 0 then {ABSTAIN} when {bad.format(v=v)} then {BAD} "
                          f"when {good.format(v=v)} then {GOOD} else {ABSTAIN} end")
                   .alias(f"v_{name}"))
    return out


def _log_odds(model: dict, names: list[str]) -> Column:
    """log P(good, votes) - log P(bad, votes) under independent rules."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for n in names:
        a, b = model[n]  # P(right | good, voted), P(right | bad, voted)
        odds = odds + (F.when(F.col(n) == GOOD, F.lit(math.log(a / (1 - b))))
                       .when(F.col(n) == BAD, F.lit(math.log((1 - a) / b))).otherwise(F.lit(0.0)))
    return odds


def fit(votes: DataFrame, rounds: int = 20) -> dict:
    """Expectation-maximisation over all documents that pass the base check.

    Documents with equal votes are one row with a count: at most
    3 ** len(RULES) rows whatever the input, staged once. Each round is one
    aggregation of that table. Accuracies start at 0.8 (rules are better than
    chance, which fixes which class is called good) and are smoothed by ten
    pseudo-votes of that value, so none reaches 0 or 1.
    """
    names = [f"v_{r}" for r in RULES]
    patterns = stage(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    model: dict = {"prior": 0.8, **{n: (0.8, 0.8) for n in names}}
    for _ in range(rounds):
        p = F.col("n") / (1 + F.exp(-_log_odds(model, names)))
        q = F.col("n") - p
        sums = [F.sum(p).alias("good"), F.sum("n").alias("all")]
        for n in names:
            sums += [F.sum(F.when(F.col(n) == GOOD, p).otherwise(0.0)).alias(f"{n}_gg"),
                     F.sum(F.when(F.col(n) != ABSTAIN, p).otherwise(0.0)).alias(f"{n}_g"),
                     F.sum(F.when(F.col(n) == BAD, q).otherwise(0.0)).alias(f"{n}_bb"),
                     F.sum(F.when(F.col(n) != ABSTAIN, q).otherwise(0.0)).alias(f"{n}_b")]
        s = patterns.agg(*sums).first()
        if not s["all"]:
            return model
        model = {"prior": min(0.999, max(0.001, s["good"] / s["all"])),
                 **{n: ((s[f"{n}_gg"] + 8) / (s[f"{n}_g"] + 10), (s[f"{n}_bb"] + 8) / (s[f"{n}_b"] + 10))
                    for n in names}}
    return model


def score_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_posterior: float = 0.5) -> DataFrame:
    """One row per input row: counts, base check, posterior and verdict.

    The base check (fewer than 50 words, or more than half of them in
    repeated windows) rejects outright; beyond it the posterior probability of
    good quality decides. The statistics are computed once and staged (a few
    numbers a document); texts are read once. Null or blank text: zero counts,
    rejected by the base check. Repeated ids and rows are judged row by row;
    other columns are ignored; an empty table gives an empty result.
    """
    stats = stage(text_statistics(df, id_col, text_col), "text-statistics")
    names = [f"v_{r}" for r in RULES]
    voted = stats.select("*", *_votes())
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    model = fit(voted.where(~base_failed))
    posterior = 1 / (1 + F.exp(-_log_odds(model, names)))
    return (voted.withColumn("base_failed", base_failed).withColumn("posterior", posterior)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= min_posterior)))


def quality_query(docs: DataFrame) -> DataFrame:
    return score_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior", *[f"v_{r}" for r in RULES])
