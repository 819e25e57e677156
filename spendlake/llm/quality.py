"""Quality rules by weak supervision.

Each rule votes keep, votes drop, or abstains. How often it is right is not set by hand:
expectation-maximisation over the observed vote patterns estimates every rule's accuracy on good
and on bad texts together with the share of good ones, and a text is kept by its posterior
probability of being good. Built-in functions only; there are at most ``3 ** rules`` patterns, so
an iteration reads a table of that bound whatever the corpus holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import let, materialize

# What counts as a word, a symbol, and a base failure.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # per cent

KEEP_POSTERIOR = 0.5
MAX_ITERATIONS = 50
TOLERANCE = 1e-5
#: Pseudo-counts that hold every vote's probability away from zero and one.
PRIOR_COUNT = 1.0


def words_of(text: Column) -> Column:
    """Words of a text; none if it is empty."""
    return F.filter(F.split(text, BLANKS, -1), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included.

    Windows are sorted by hash with their places, so equal ones are neighbours: no comparison of all
    pairs however long the text. Texts whose windows all differ skip the sort.
    """

    def windows_of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        window = lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])
        return let(F.transform(at, window), counted)

    def counted(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, covered))

    def covered(s: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return (b >= 0) & (b < F.size(s)) & (F.get(s, a)["h"] == F.get(s, b)["h"])

        kept = F.filter(s, lambda _, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        places = F.flatten(F.transform(kept, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(places))

    return F.when(F.size(words) >= 4, windows_of(words)).otherwise(F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and what the rules look at, one row per document; null text has no words."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD)))
    counts = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).alias("n_stop"),
        ),
    )
    line_counts = let(
        lines,
        lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")),
    )
    gathered = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        counts.alias("c"),
        line_counts.alias("l"),
        F.length(F.regexp_replace("text", BLANKS, "")).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("n_upper"),
        F.length(F.regexp_replace("text", r"[^\p{L}]+", "")).alias("n_letters"),
    )
    flat = gathered.select("doc_id", "c.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_letters")
    return flat.select("doc_id", *(F.col(c).cast("long").alias(c) for c in flat.columns if c != "doc_id"))


#: Function words of the corpus' languages; running text holds many of them.
STOP_WORDS = (
    "the of and to a in is that it was for on are as with be this from or by an at he have not but "
    "der die das und ist von den mit für ein eine nicht zu auf im dem sich des als auch "
    "le la les de des et est un une du en que qui pour dans sur pas au avec il "
    "el los las y del por con para una se su al lo como más o pero sus"
).split()


class Rule(NamedTuple):
    """A vote from the measures: true keeps, false drops, null abstains."""

    name: str
    vote: Callable[[], Column]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _between(value: Column, bad_below: float, good_from: float, good_to: float, bad_above: float) -> Column:
    """Keep inside the good range, drop outside the bad bounds, abstain between."""
    return F.when((value < bad_below) | (value > bad_above), F.lit(False)).when(
        (value >= good_from) & (value <= good_to), F.lit(True)
    )


RULES = (
    Rule("length", lambda: _between(F.col("n_words"), 50, 100, 50_000, 100_000)),
    Rule("word_length", lambda: _between(_share("word_chars", "n_words"), 2.5, 3.5, 8, 12)),
    Rule("symbols", lambda: _between(_share("n_symbols", "n_words"), 0, 0, 0.02, 0.1)),
    Rule("stop_words", lambda: _between(_share("n_stop", "n_words"), 0.05, 0.12, 1, 1)),
    Rule("letters", lambda: _between(_share("n_letters", "word_chars"), 0.6, 0.8, 1, 1)),
    Rule("repeated_windows", lambda: _between(_share("n_repeat_words", "n_words"), 0, 0, 0.15, 0.4)),
    Rule("repeated_lines", lambda: _between(_share("n_dup_lines", "n_lines"), 0, 0, 0.1, 0.3)),
    Rule("capitals", lambda: _between(_share("n_upper", "word_chars"), 0, 0, 0.15, 0.35)),
)


def base_failed() -> Column:
    """The plain limits that no vote overrules."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words")
    )


class Fit(NamedTuple):
    """Share of good texts, and each rule's chance to vote keep or drop on good and on bad texts."""

    good: float
    keep: dict[str, tuple[float, float]]
    drop: dict[str, tuple[float, float]]


def posterior(fit: Fit, rules: tuple[Rule, ...]) -> Column:
    """Probability of being good, from a row's votes (columns by rule name). Abstaining says nothing."""
    logit = F.lit(math.log(fit.good / (1 - fit.good)))
    for rule in rules:
        (kg, kb), (dg, db) = fit.keep[rule.name], fit.drop[rule.name]
        vote = F.col(rule.name)
        logit = logit + F.when(vote, math.log(kg / kb)).when(~vote, math.log(dg / db)).otherwise(0.0)
    return 1 / (1 + F.exp(-logit))


def estimate(votes: DataFrame, rules: tuple[Rule, ...] = RULES) -> Fit:
    """Expectation-maximisation over the vote patterns of ``votes`` (a boolean column per rule).

    It starts from rules that are right four times in five and from mostly good texts, which also
    fixes which class is the good one. Abstentions are taken as independent of quality.
    """
    names = [rule.name for rule in rules]
    patterns = materialize(votes.groupBy(*names).agg(F.count("*").alias("texts")).coalesce(1))
    fit = Fit(0.8, {n: (0.8, 0.2) for n in names}, {n: (0.2, 0.8) for n in names})
    for _ in range(MAX_ITERATIONS):
        judged = patterns.withColumn("g", posterior(fit, rules) * F.col("texts")).withColumn(
            "b", F.col("texts") - F.col("g")
        )
        sums = [F.sum(c).alias(c) for c in ("g", "b")]
        for n in names:
            for c in ("g", "b"):
                sums.append(F.sum(F.when(F.col(n), F.col(c))).alias(f"keep_{n}_{c}"))
                sums.append(F.sum(F.when(~F.col(n), F.col(c))).alias(f"drop_{n}_{c}"))
        row = {k: v or 0.0 for k, v in judged.agg(*sums).first().asDict().items()}
        total = row["g"] + row["b"]
        new_keep, new_drop = {}, {}
        for n in names:
            sides = []
            for c in ("g", "b"):
                k, d = row[f"keep_{n}_{c}"], row[f"drop_{n}_{c}"]
                sides.append((k + PRIOR_COUNT) / (k + d + 2 * PRIOR_COUNT))
            new_keep[n] = (sides[0], sides[1])
            new_drop[n] = (1 - sides[0], 1 - sides[1])
        good = (row["g"] + PRIOR_COUNT) / (total + 2 * PRIOR_COUNT)
        moved = max(
            [abs(good - fit.good)] + [abs(a - b) for n in names for a, b in zip(new_keep[n], fit.keep[n])]
        )
        fit = Fit(good, new_keep, new_drop)
        if moved < TOLERANCE:
            break
    return fit


def judge_quality(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep_posterior: float = KEEP_POSTERIOR
) -> DataFrame:
    """Measures, posterior, ``base_failed`` and ``kept`` of every row of ``docs`` (``doc_id, text``).

    Null and empty texts have no words, so they fail the base limits. Repeated rows vote and are
    judged each; further columns are ignored; an empty table gives no rows.
    """
    measured = materialize(measures(docs))
    voted = measured.select("*", *(rule.vote().alias(rule.name) for rule in rules))
    fit = estimate(voted.filter(~base_failed()), rules)
    judged = voted.withColumn("base_failed", base_failed()).withColumn("posterior", posterior(fit, rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_posterior)).drop(
        *(rule.name for rule in rules)
    )
