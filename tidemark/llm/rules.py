"""Quality rules as weak supervision, with DataFrame functions only.

Every rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation on the table of
distinct vote patterns (at most 3 ** rules rows, whatever the input) estimates how often each rule
casts each vote on good and on bad documents, and the posterior probability of good replaces an
all-must-pass filter: a single bad vote can be outvoted, and how much a vote weighs is learned.

Rules overlap on purpose (two or more look at symbols, repetition, punctuation), because only rules that
agree with each other on bad documents tell the classes apart.  Which class is the good one is settled
by two things: the first guess is the share of good votes, and no vote may count against its own
direction, so every rule is taken to be no worse than chance.  Rounds stop when the estimates stand
still.  Each round is one small aggregate whose rows (three per rule) go back to the next as
literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, shingle_hashes, words
from tidemark.session import stored

SYMBOLS = "#*$%&|<>"
MARKS = ".,;:?!"
BLANKS = " \t\n\x0b\x0c\r"
#: End of the last word of a text that ends with its sentence.
SENTENCE_END = "[.!?]['\")]*\\z"
TOLERANCE, MAX_ROUNDS = 1e-7, 100


def _repeat_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur at least twice, the first occurrence included.

    Texts without any repeated window stop after one hash pass; the others sort (hash, place) pairs
    and look at neighbours, so long texts cost n log n.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"]))
                | (F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
            )

        spans = F.transform(let(pairs, repeated), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            F.size(F.array_distinct(F.flatten(spans)))
        )

    return let(shingle_hashes(tokens, 3), covered)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc`` (struct of the input columns but the text) and the counts the rules look at.

    A null or empty text has no words and every count 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    counts = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
        let(lines, F.size).cast("long").alias("n_lines"),
        (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_shouts"),
        F.size(F.filter("w", lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.length(x) > 1)))
        .cast("long")
        .alias("n_upper"),
        (F.length(text) - F.length(F.translate(text, MARKS, ""))).cast("long").alias("n_marks"),
        (F.size("w") > 0).cast("long").alias("n_ends"),
        F.coalesce((~F.get("w", F.size("w") - 1).rlike(SENTENCE_END)).cast("long"), F.lit(0)).alias("n_open_ends"),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*kept).alias("doc"), text.alias("text"), words(F.col("text")).alias("w")).select(
        "doc", counts.alias("stats")
    ).select("doc", "stats.*")


@dataclass(frozen=True)
class Rule:
    """Votes on measure / per: bad from ``bad`` on, good up to ``good``, between them it abstains."""

    name: str
    measure: str
    per: str
    bad: float
    good: float


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.2, 0.01),
    Rule("some_symbols", "n_symbols", "n_words", 0.1, 0.02),
    Rule("symbol_chars", "n_symbols", "word_chars", 0.03, 0.005),
    Rule("symbols_for_marks", "n_symbols", "n_marks", 0.5, 0.1),
    Rule("shouts", "n_shouts", "n_words", 0.2, 0.02),
    Rule("capitals", "n_upper", "n_words", 0.3, 0.02),
    Rule("repeats", "n_repeat_words", "n_words", 0.5, 0.1),
    Rule("some_repeats", "n_repeat_words", "n_words", 0.3, 0.05),
    Rule("long_words", "word_chars", "n_words", 7.0, 6.0),
    Rule("marks", "n_marks", "n_words", 0.3, 0.2),
    Rule("open_end", "n_open_ends", "n_ends", 1.0, 0.0),
)


def vote(rule: Rule) -> Column:
    """A rule's vote; without anything to measure it abstains."""
    x, y = F.col(rule.measure), F.col(rule.per)
    return F.when(y == 0, 0).when(x >= rule.bad * y, -1).when(x <= rule.good * y, 1).otherwise(0)


def start_posterior() -> Column:
    """First guess of P(good): between 0.05 and 0.95 by the balance of the votes."""
    balance = F.aggregate("votes", F.lit(0), lambda total, v: total + v)
    return 0.5 + 0.45 * balance / F.size("votes")


def _tallies(patterns: DataFrame, q: Column) -> dict[tuple[int, int], tuple[float, float]]:
    """(rule, vote) to its weight on good and on bad documents: at most three rows per rule."""
    cast = patterns.select("n", q.alias("q"), F.posexplode("votes").alias("rule", "vote"))
    sums = cast.groupBy("rule", "vote").agg(
        F.sum(F.col("n") * F.col("q")).alias("good"), F.sum(F.col("n") * (1 - F.col("q"))).alias("bad")
    )
    return {(r["rule"], r["vote"]): (r["good"], r["bad"]) for r in sums.collect()}


def _posterior(tally: dict[tuple[int, int], tuple[float, float]], prior: float = 1.0) -> Column:
    """P(good | votes) from add-``prior`` smoothed tallies; abstaining is no evidence."""
    total = [sum(pair[side] for (rule, _), pair in tally.items() if rule == 0) for side in (0, 1)]

    def weights(v: int) -> Column:
        out = []
        for rule in range(1 + max(rule for rule, _ in tally)):
            pair = tally.get((rule, v), (0.0, 0.0))
            good, bad = ((pair[side] + prior) / (total[side] + 3 * prior) for side in (0, 1))
            out.append(v * max(0.0, v * math.log(good / bad)))
        return F.expr(f"array({', '.join(f'{x!r}D' for x in out)})")

    against, in_favour = weights(-1), weights(1)
    evidence = F.transform(
        "votes",
        lambda v, i: F.when(v == -1, F.get(against, i)).when(v == 1, F.get(in_favour, i)).otherwise(0.0),
    )
    first = F.lit(math.log((total[0] + prior) / (total[1] + prior)))
    return 1 / (1 + F.exp(-F.aggregate(evidence, first, lambda logit, x: logit + x)))


def fit(patterns: DataFrame, tolerance: float = TOLERANCE, rounds: int = MAX_ROUNDS) -> Column | None:
    """Posterior expression over ``votes`` by EM on (votes, n); None without rows.

    Stops when no tally moves by more than ``tolerance`` of all rows, at the latest after ``rounds``.
    """
    q, before = start_posterior(), None
    for _ in range(rounds):
        tally = _tallies(patterns, q)
        if not tally:
            return None
        q = _posterior(tally)
        total = sum(sum(pair) for (rule, _), pair in tally.items() if rule == 0)
        if before and all(abs(x - y) <= tolerance * total for k in tally for x, y in zip(tally[k], before[k])):
            break
        before = tally
    return q


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5, **options) -> DataFrame:
    """Counts, ``votes`` in the order of rules, ``base_failed``, ``posterior`` and ``kept`` per row of docs.

    ``base_failed``: under 50 words, or over half of the words in repeated windows.  ``kept``: not
    base_failed and posterior >= threshold.  Nulls, empty and repeated rows count like any row (without
    words every rule abstains); equal texts get equal verdicts, so there are no ties to break; an empty
    table gives an empty result; extra columns stay inside ``doc``, whatever their names.
    """
    votes = F.array(*[vote(r) for r in rules])
    rows = stored(statistics(docs).withColumn("votes", votes), "rule-votes")
    patterns = stored(rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "rule-patterns")
    posterior = fit(patterns, **options)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", base).withColumn(
        "posterior", F.lit(None).cast("double") if posterior is None else posterior
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def filter_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    copy = "__whole_text"
    while copy in docs.columns:
        copy += "_"
    kept = judge(docs.withColumn(copy, F.col("text")), **options).where("kept")
    return kept.select(*[
        F.col(f"doc.`{copy if c == 'text' else c}`").alias(c) for c in docs.columns
    ])
