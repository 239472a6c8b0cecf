"""Quality rules as weak supervision (DataFrame functions only).

Each rule votes for or against a document or abstains. Expectation-maximisation over the vote patterns estimates how often
each rule is right and how common good documents are; the posterior probability of being good replaces "all must pass".
There are at most 3^rules patterns, whatever the number of documents: their counts are what EM reads, and their posteriors
are joined back.

Repeated 3-word windows are found by sorting a document's 64-bit window hashes in its own row; no text is shuffled.

Defined results: null and empty texts have no words and fail; a document on which all rules abstain gets the estimated share
of good documents; repeated rows are judged alike; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import WORD, plain, written

SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """`body` over `value`, which is computed once, and only where the result is needed."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""

    def covered(places: Column) -> Column:
        each = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x)

    def repeated(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda x, i: F.when(
                (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]), x["i"]
            ),
        )
        return _let(F.sort_array(F.array_compact(marked)), covered)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(ordered, repeated))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts that the rules read, for every row."""
    words = docs.select(F.col(id_col).alias("doc_id"), plain(text_col).alias("text")).withColumns(
        {
            "words": F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
            "lines": F.filter(F.split("text", "\n", -1), lambda s: s.rlike(WORD)),
        }
    )
    n = F.size("words")
    window = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    hashed = words.withColumn("hashes", F.slice(window, F.lit(1), F.greatest(n - 2, F.lit(0))))
    return hashed.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("hashes")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda s: s.rlike("[.!?][\"')]*[\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_ended_lines"),
        F.length(F.regexp_replace("text", r"\P{L}+", "")).cast("long").alias("n_letters"),
    )


@dataclass(frozen=True)
class VoteRule:
    """Votes against where `bad` holds, for where `good` holds, else abstains; conditions over the columns of `features`."""

    name: str
    bad: str
    good: str


RULES = (
    VoteRule("length", "n_words < 50", "n_words >= 100"),
    VoteRule("repeats", "100 * n_repeat_words > 50 * n_words", "100 * n_repeat_words < 20 * n_words"),
    VoteRule("lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    VoteRule("symbols", "10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    VoteRule("word_length", "word_chars < 3 * n_words or word_chars > 12 * n_words", "word_chars between 3.5 * n_words and 10 * n_words"),
    VoteRule("letters", "10 * n_letters < 7 * word_chars", "100 * n_letters >= 85 * word_chars"),
    VoteRule("sentences", "10 * n_ended_lines < n_lines", "2 * n_ended_lines >= n_lines"),
)


def votes(rules: tuple[VoteRule, ...] = RULES) -> Column:
    """One character for each rule: + for, - against, 0 abstains."""
    return F.concat(*(F.expr(f"case when {r.bad} then '-' when {r.good} then '+' else '0' end") for r in rules))


def fit(patterns: dict[str, int], n_rules: int, rounds: int = 50) -> tuple[float, list[float]]:
    """Share of good documents and the rules' accuracies, by EM. An accuracy stays above chance, so sides can't swap."""
    prior, right = 0.8, [0.8] * n_rules
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        good, hits, cast = 1.0, [4.0] * n_rules, [5.0] * n_rules
        for pattern, count in sorted(patterns.items()):
            p = posterior(pattern, prior, right)
            good += count * p
            for j, v in enumerate(pattern):
                if v != "0":
                    cast[j] += count
                    hits[j] += count * (p if v == "+" else 1 - p)
        prior = min(max(good / (total + 1), 0.01), 0.99)
        right = [min(max(h / c, 0.55), 0.98) for h, c in zip(hits, cast)]
    return prior, right


def posterior(pattern: str, prior: float, right: list[float]) -> float:
    odds = math.log(prior / (1 - prior))
    for v, a in zip(pattern, right):
        if v != "0":
            odds += math.log(a / (1 - a)) * (1 if v == "+" else -1)
    return 1 / (1 + math.exp(-odds))


def judged(docs: DataFrame, rules: tuple[VoteRule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """The base counts, `base_failed`, `kept`, `quality` (posterior) and `votes` of every row."""
    rows = written(features(docs).withColumn("votes", votes(rules)), "quality")
    # at most 3^rules rows
    counts = {r["votes"]: r["count"] for r in rows.groupBy("votes").count().collect()}
    prior, right = fit(counts, len(rules))
    table = [(p, float(posterior(p, prior, right))) for p in sorted(counts)]
    scores = rows.sparkSession.createDataFrame(table, "votes string, quality double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        rows.join(F.broadcast(scores), "votes", "left")
        .withColumn("base_failed", failed)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.col("quality") >= least)).alias("kept"),
            "quality", "votes",
        )
    )
