"""Quality rules as weak supervision.

Each rule looks at the measures of one text and votes good, bad or abstains.  No rule is trusted by itself: a label
model with a latent class (good or bad) and rules independent given the class is fitted by expectation-maximisation,
which estimates how often each rule votes each way in either class.  A text is kept when its posterior probability of
being good reaches a threshold, so that one noisy rule no longer rejects it.

The corpus is read once.  Measures are expressions inside one row (no shuffle); the vote patterns are counted by a
partial aggregation, and at most 3 ** len(rules) counted patterns - a bound that does not depend on the corpus -
reach the driver, where the model is fitted on exact counts over all rows.

Defined results: a null text has no words; an empty table gives an empty result; rows that repeat are judged each by
itself and alike; ``keep`` names the columns to carry, and input columns that clash with the measures are replaced by
them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import blanks_to_spaces, occurrences, single_spaces, word_count, words_of
from siltstone.storage import materialize

ABSTAIN, GOOD, BAD = 0, 1, 2
#: The symbols counted by n_symbols and the limits of the base verdict.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts")


@dataclass(frozen=True)
class Rule:
    """Votes BAD where ``bad`` holds, else GOOD where ``good`` holds, else abstains; both are SQL over the measures."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 80", "n_words < 20"),
    Rule("symbol_words", "n_symbols * 100 <= n_words", "n_symbols * 5 > n_words"),
    Rule("symbol_chars", "n_symbols * 200 <= word_chars", "n_symbols * 25 > word_chars"),
    Rule("marks", "(n_symbols + n_shouts) * 50 <= n_words", "(n_symbols + n_shouts) * 4 > n_words"),
    Rule("repeated_lines", "n_dup_lines * 10 <= n_lines", "n_dup_lines >= 3 AND n_dup_lines * 2 > n_lines"),
    Rule("repeated_words", "n_repeat_words * 10 <= n_words", "n_repeat_words * 100 > n_words * 45"),
    Rule("capitals", "n_upper * 10 <= word_chars", "n_upper * 10 > word_chars * 4"),
    Rule("shouting", "n_shouts * 100 <= n_words", "n_shouts * 10 > n_words"),
    Rule("word_length", "word_chars BETWEEN n_words * 3 AND n_words * 9", "word_chars < n_words * 2 OR word_chars > n_words * 14"),
)


def repeat_steps() -> list[dict[str, Column]]:
    """Projections from ``_words`` to ``n_repeat_words``: words inside a 3-word window found twice or more.

    A window's hash is cut to leave room for its place, and one sort of these longs puts equal windows side by side
    (the last two, shorter "windows" equal no other).  What that finds is compared again as words, so the count is
    exact.  Work is n log n in the length of the text.  Each step is a projection of its own, so that arrays lie in
    flat memory between them and the sort runs on primitive values.
    """
    words, keys = F.col("_words"), F.col("_keys")

    def beside(j: Column) -> Column:
        return F.get(keys, j).bitwiseXOR(F.get(keys, j + 1)).bitwiseAND(F.col("_high")) == 0

    def place(j: Column) -> Column:
        return F.get(keys, j).bitwiseAND(F.bitwise_not(F.col("_high"))).cast("int")

    suspects = F.array_distinct(F.flatten(F.transform(F.filter(F.sequence(F.lit(0), F.size(keys) - 1), beside), lambda j: F.array(place(j), place(j + 1)))))
    windows = F.transform(F.col("_suspects"), lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, F.lit(3))).alias("w"), i.alias("i")))

    def same(x: Column, j: Column) -> Column:
        return F.coalesce(x["w"] == F.get("_windows", j)["w"], F.lit(False))

    starts = F.transform(F.filter("_windows", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])
    widths = F.transform(F.col("_starts"), lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_starts", j + 1) - p, F.lit(3))))
    return [
        {"_high": F.bitwise_not((F.pow(F.lit(2.0), F.ceil(F.log2(F.size(words) + 1.0))) - 1).cast("long"))},
        {"_keys": F.sort_array(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.col("_high")).bitwiseOR(i)))},
        {"_suspects": F.when(F.size(words) > 3, suspects).otherwise(F.array().cast("array<int>"))},
        {"_windows": F.sort_array(windows)},
        {"_starts": F.sort_array(starts)},
        {"n_repeat_words": F.aggregate(widths, F.lit(0), lambda total, x: total + x).cast("long")},
    ]


def with_measures(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and the measures of ``text_col``; the text is normalised and split once."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in MEASURES]
    whole, flat = F.col("_whole"), F.col("_flat")
    steps: list[dict[str, Column]] = [
        {"_whole": F.coalesce(whole, F.lit(""))},
        {"_flat": blanks_to_spaces(whole)},
        {"_flat": single_spaces(flat)},
        {
            "n_words": word_count(flat),
            "word_chars": F.length(F.replace(flat, F.lit(" "), F.lit(""))).cast("long"),
            "n_symbols": sum((occurrences(whole, c) for c in SYMBOLS), F.lit(0).cast("long")),
            "n_upper": F.regexp_count(whole, F.lit("[A-Z]")).cast("long"),
            "n_shouts": occurrences(whole, "!"),
            "_lines": F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "_words": words_of(flat),
        },
        {"n_lines": F.size("_lines").cast("long"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")},
    ]
    out = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").alias("_whole"))
    done: list[str] = [f"_k{i}" for i in range(len(kept))]
    plan = steps + repeat_steps()
    needs = [("_whole",), ("_whole", "_flat"), ("_whole", "_flat"), ("_words", "_lines"), ("_words",), ("_words", "_high"), ("_words", "_high", "_keys"), ("_words", "_suspects"), ("_windows",), ("_starts",), ()]
    for step, after in zip(plan, needs):
        made = [c for c in step if not c.startswith("_")]
        out = out.select(*done, *[v.alias(k) for k, v in step.items() if k in after or k in made], *[c for c in after if c not in step])
        done += made
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)], *MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def votes(rules: tuple[Rule, ...]) -> list[Column]:
    return [F.when(F.expr(r.bad), BAD).when(F.expr(r.good), GOOD).otherwise(ABSTAIN) for r in rules]


@dataclass(frozen=True)
class LabelModel:
    """``odds[r][v]``: what vote ``v`` of rule ``r`` adds to the log odds of good; ``accuracy[r]``: of its votes."""

    prior: float
    odds: tuple[tuple[float, float, float], ...]
    accuracy: tuple[float, ...]


def fit_label_model(patterns: dict[tuple[int, ...], int], n_rules: int, rounds: int = 200, smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation on counted vote patterns, begun at the share of good votes among those cast.

    Given the class, a rule that votes says good with a probability of its own; how often it votes at all does not
    depend on the class, so silence adds nothing.  Votes may count for nothing but never against what they say: where
    the likelihood would have a rule say good more often of bad texts, both probabilities are the pooled one, which is
    the maximum under that constraint.  The posterior is that of the fitted model.
    """
    if not patterns:
        return LabelModel(0.5, ((0.0, 0.0, 0.0),) * n_rules, (0.5,) * n_rules)
    items = sorted(patterns.items())

    def share(p: tuple[int, ...]) -> float:
        good, bad = p.count(GOOD), p.count(BAD)
        return (good + 1.0) / (good + 2.0 * bad + 2.0)

    post = [share(p) for p, _ in items]
    total = float(sum(n for _, n in items))
    prior, says = 0.5, [(0.5, 0.5)] * n_rules
    for _ in range(rounds):
        good = sum(n * q for (_, n), q in zip(items, post))
        prior = min(max((good + smooth) / (total + 2 * smooth), 1e-6), 1 - 1e-6)
        cast = [[[smooth, smooth], [smooth, smooth]] for _ in range(n_rules)]  # by class: votes for good and for bad
        for (p, n), q in zip(items, post):
            for r, v in enumerate(p):
                if v != ABSTAIN:
                    cast[r][0][v - GOOD] += n * q
                    cast[r][1][v - GOOD] += n * (1 - q)
        says = []
        for (good_yes, good_no), (bad_yes, bad_no) in cast:
            a, b = good_yes / (good_yes + good_no), bad_yes / (bad_yes + bad_no)
            if a < b:
                a = b = (good_yes + bad_yes) / (good_yes + good_no + bad_yes + bad_no)
            says.append((a, b))
        before, post = post, []
        for p, _ in items:
            z = math.log(prior / (1 - prior)) + sum(math.log(a / b) if v == GOOD else math.log((1 - a) / (1 - b)) for (a, b), v in zip(says, p) if v != ABSTAIN)
            post.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
        if max(abs(x - y) for x, y in zip(before, post)) < 1e-9:
            break
    odds = tuple((0.0, math.log(a / b), math.log((1 - a) / (1 - b))) for a, b in says)
    return LabelModel(prior, odds, tuple(prior * a + (1 - prior) * (1 - b) for a, b in says))


def posterior(model: LabelModel, rules: tuple[Rule, ...]) -> Column:
    z = F.lit(math.log(model.prior / (1 - model.prior)))
    for vote, (none, good, bad) in zip(votes(rules), model.odds):
        z = z + F.when(vote == GOOD, good).when(vote == BAD, bad).otherwise(none)
    return 1 / (1 + F.exp(-z))


def quality_rules(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``keep`` columns, the measures, ``base_failed``, the posterior ``p_good`` and ``kept``; no row goes."""
    measured = materialize(with_measures(docs, text_col, keep), "quality")
    counted = measured.groupBy(F.concat(*[v.cast("string") for v in votes(rules)]).alias("pattern")).count()
    patterns = {tuple(map(int, row["pattern"])): row["count"] for row in counted.collect()}  # at most 3 ** len(rules) rows
    model = fit_label_model(patterns, len(rules))
    judged = measured.withColumn("base_failed", base_failed()).withColumn("p_good", posterior(model, rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
