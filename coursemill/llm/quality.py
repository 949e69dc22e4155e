"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

DataFrame functions only. Features are computed once per document and kept; the estimation reads the counts of vote
patterns, at most 3 to the number of rules, whatever the number of documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import SPACE, let, saved, shield

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_symbol_lines", "n_upper",
            "n_letters")
BASE = ("base_failed", "posterior", "kept")


def _repeats(words: Column) -> Column:
    """Words in windows of three that stand twice or more in the text: sort the window hashes, merge the places."""
    def covered(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = lambda s: F.filter(s, lambda x, j: (
            F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
        places = let(pairs, lambda s: F.sort_array(F.transform(repeated(s), lambda x: x["i"])))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b))

    windows = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    return let(windows, lambda h: F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(covered(h)))


def quality_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Input rows without the text, with ``FEATURES`` (bigint) of the whole text; null text counts as empty.

    Equal windows are found by 64-bit hashes inside one document.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeats(w).alias("n_repeat_words")))
    by_line = let(lines, lambda s: F.struct(
        F.size(s).alias("n_lines"), (F.size(s) - F.size(F.array_distinct(s))).alias("n_dup_lines"),
        F.size(F.filter(s, lambda x: x.rlike(r"[.!?…。！？\"”»)][\x20\x09-\x0D]*$"))).alias("n_ended"),
        F.size(F.filter(s, lambda x: x.rlike(r"[#*$%&|<>]"))).alias("n_symbol_lines")))
    length = F.length(text)
    docs, back = shield(docs, [text_col], FEATURES + BASE)
    out = docs.select(
        *[c for c in docs.columns if c != text_col], by_word.alias("_w"), by_line.alias("_l"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (length - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        (length - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("n_upper"),
        (length - F.length(F.regexp_replace(text, r"\p{L}+", ""))).alias("n_letters"))
    found = {"n_words": "_w", "n_repeat_words": "_w", "n_lines": "_l", "n_dup_lines": "_l", "n_ended": "_l", "n_symbol_lines": "_l"}
    return back(out.select(*[c for c in out.columns if c not in ("_w", "_l")], *[F.col(f"{s}.{c}").alias(c) for c, s in found.items()])
                .withColumns({c: F.col(c).cast("bigint") for c in FEATURES}))


def votes() -> dict[str, Column]:
    """Each rule as 1 (good), 0 (bad) or null (abstains); a document without words gets no vote of a ratio."""
    words = F.expr("nullif(n_words, 0)")
    ratio = lambda c, of=words: F.col(c) / of

    def rule(value, bad, good):
        return F.when(bad(value), 0).when(good(value), 1)

    return {
        "symbols": rule(ratio("n_symbols"), lambda v: v > 0.1, lambda v: v < 0.02),
        "symbol_lines": rule(ratio("n_symbol_lines", F.expr("nullif(n_lines, 0)")), lambda v: v > 0.25, lambda v: v < 0.1),
        "letters": rule(F.col("n_letters") / F.expr("nullif(word_chars, 0)"), lambda v: v < 0.75, lambda v: v > 0.9),
        "dup_lines": rule(ratio("n_dup_lines", F.expr("nullif(n_lines, 0)")), lambda v: v > 0.35, lambda v: v < 0.15),
        "repeats": rule(ratio("n_repeat_words"), lambda v: v > 0.35, lambda v: v < 0.15),
        "word_length": rule(ratio("word_chars"), lambda v: (v < 2.5) | (v > 12), lambda v: (v >= 3.5) & (v <= 9)),
        "upper": rule(F.col("n_upper") / F.expr("nullif(word_chars, 0)"), lambda v: v > 0.3, lambda v: v < 0.12),
        "endings": rule(ratio("n_ended", F.expr("nullif(n_lines, 0)")), lambda v: v < 0.15, lambda v: v > 0.6),
        "length": F.when(F.col("n_words") >= 80, 1),
    }


#: What is taken to be known before any document is read, in documents: (right votes, of) on good ones, (caught, of) on bad
#: ones, and (good, of) all. They only start the estimate; a few hundred documents outweigh them.
RIGHT, CAUGHT, SHARE = (49.0, 50.0), (3.0, 10.0), (8.0, 10.0)


def fit_rules(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents and, per rule, the chance of a right vote on good and on bad ones.

    Abstentions say nothing. What decides are the votes that come together: rules that see the same documents as bad gain
    weight against good votes, a rule that votes bad here and there without any other loses its own.
    """
    good, rates = SHARE[0] / SHARE[1], [(RIGHT[0] / RIGHT[1], CAUGHT[0] / CAUGHT[1])] * (len(patterns[0][0]) if patterns else 0)
    for _ in range(rounds):
        sums = [[*RIGHT, *CAUGHT] for _ in rates]
        share, total = SHARE
        for pattern, n in patterns:
            p = posterior(pattern, good, rates)
            total, share = total + n, share + n * p
            for s, v in zip(sums, pattern, strict=True):
                if v is not None:
                    s[0], s[1] = s[0] + n * p * v, s[1] + n * p
                    s[2], s[3] = s[2] + n * (1 - p) * (1 - v), s[3] + n * (1 - p)
        good = share / total
        # The rates are shares of sums that begin above 0 and under 1, so that only rounding could reach either end.
        rates = [tuple(min(max(x, 1e-9), 1 - 1e-9) for x in (s[0] / s[1], s[2] / s[3])) for s in sums]
    return good, rates


def posterior(pattern, good: float, rates) -> float:
    odds = math.log(good / (1 - good))
    for v, (a, b) in zip(pattern, rates, strict=True):
        if v is not None:
            odds += math.log(a / (1 - b)) if v else math.log((1 - a) / b)
    return 1 / (1 + math.exp(-odds))


def judge_quality(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Input rows without the text, with ``FEATURES``, ``base_failed``, ``posterior`` (good, 0 to 1) and ``kept``.

    Base: under 50 words, or over half of the words in repeated windows. The rates are estimated on all documents with a
    word, and what passes the base is kept if its posterior reaches ``threshold``. Null and empty texts fail the base. Input columns named like added ones are replaced. Columns of
    all kinds and repeated rows pass through; an empty table stays empty.
    """
    features = saved(quality_features(docs, text_col))
    rules = votes()
    names = list(rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = features.where("n_words > 0").select(*[c.alias(n) for n, c in rules.items()]).groupBy(*names).count().collect()  # at most 2 * 3 ** 8 rows
    good, rates = fit_rules(sorted(((tuple(r[n] for n in names), r["count"]) for r in counted), key=str))
    odds = F.lit(math.log(good / (1 - good)))
    for (a, b), vote in zip(rates, rules.values()):
        odds = odds + F.when(vote == 1, math.log(a / (1 - b))).when(vote == 0, math.log((1 - a) / b)).otherwise(0.0)
    return (features.withColumn("base_failed", failed).withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
