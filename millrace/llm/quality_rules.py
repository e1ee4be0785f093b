"""Quality rules: a decision list learned by sequential covering.

Only DataFrame functions run over texts and statistics. A rule is a conjunction
of a few comparisons of a feature with a threshold, and rejects a document. On
one part of the labelled rows a rule grows: the comparison with the highest
information gain is added until no kept document is covered. On the other part
it is pruned to the prefix that serves best there. It joins the list if it is
precise enough, the rows it covers leave, and the next rule grows on the rest.
The list is one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, kept_in_files

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEAT_PERCENT = 50

#: What rules may compare, from the base statistics.
FEATURES = (
    "n_words",
    "word_length",
    "symbols_per_word",
    "duplicate_line_share",
    "repeat_word_share",
    "words_per_line",
)
#: Labelled documents that rules are learned from, and the partitions they fill.
SAMPLE = 40_000
SAMPLE_PARTITIONS = 8
#: Cut points of a feature: so many quantiles of the rejected and of all rows.
CUTS = 20
MOST_RULES = 8
MOST_TERMS = 3
#: Share of covered rows with a reject label that a rule needs in either part.
PRECISION = 0.95
#: Rejected rows that a rule must cover in the growing part.
LEAST_COVERED = 5


@dataclass(frozen=True)
class Term:
    """A comparison; ``above`` means at least the threshold, else below it."""

    feature: str
    threshold: float
    above: bool

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with counts of each whole text instead of the text.

    Null and empty texts have no words. A word is in ``n_repeat_words`` if one
    of its 3-word windows occurs twice or more in the text. Windows are compared
    by 64-bit hashes of their three words, so a long text needs an array of
    numbers and no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.filter(F.split(text, WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, WHITE, "")).cast("long").alias("word_chars"),
    )
    words, lines = F.col("words"), F.col("lines")
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(words) >= 3,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.struct(
                        F.xxhash64(
                            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)
                        ).alias("h"),
                        i.alias("at"),
                    ),
                )
            ),
        )
        .otherwise(F.array().cast("array<struct<h: bigint, at: int>>"))
        .alias("windows"),
    )
    windows = F.col("windows")
    repeated = F.filter(
        windows,
        lambda w, i: (w["h"] == F.get(windows, i - 1)["h"])
        | (w["h"] == F.get(windows, i + 1)["h"]),
    )
    covered = F.flatten(
        F.transform(repeated, lambda w: F.array(w["at"], w["at"] + 1, w["at"] + 2))
    )
    found = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )
    # One generated row: a filter on the counts above this is not moved below
    # it, where it would repeat the expressions that make them.
    return counted.select("doc_id", F.inline(F.array(found)))


def with_features(statistics: DataFrame) -> DataFrame:
    """Statistics with the base verdict and the features of rules."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return statistics.withColumns(
        {
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
            "word_length": F.col("word_chars") / words,
            "symbols_per_word": F.col("n_symbols") / words,
            "duplicate_line_share": F.col("n_dup_lines") / lines,
            "repeat_word_share": F.col("n_repeat_words") / words,
            "words_per_line": F.col("n_words") / lines,
        }
    )


def sampled_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, quality)`` of ``SAMPLE`` labelled documents on average.

    Null labels are left out; of several labels of one document the lowest counts.
    """
    marks = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, SAMPLE / max(1, labels.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit("rules")), F.lit(1_000_000))
    return marks.where(place < int(1_000_000 * share))


def learn_rules(features: DataFrame, labels: DataFrame) -> list[list[Term]]:
    """Ordered rejecting rules from ``labels(doc_id, quality)``, 0 or 1.

    Labels that are null, or of no document, are left out; of several labels of
    one document the lowest counts. ``SAMPLE`` labelled documents on average are
    used, drawn by a hash of their ids. Rows that fail the base rule are left
    out. No labels of either kind give no rules. Only counts by feature and cut
    point, and the cut points, come to the driver.
    """
    # The sample is bounded, so it can be sent to every task, and the rows that
    # it picks fit few partitions.
    marks = F.broadcast(sampled_labels(labels))
    rows = features.where(~F.col("base_failed")).join(marks, "doc_id")
    rows = rows.select(
        (F.col("quality") == 0).cast("int").alias("bad"),
        (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grows"),
        *FEATURES,
    )
    rows = kept_in_files(rows.repartition(SAMPLE_PARTITIONS), "labelled-features")
    ranks = [i / CUTS for i in range(1, CUTS)]
    cuts = rows.agg(
        *[F.percentile_approx(f, ranks, 10_000).alias(f"all_{f}") for f in FEATURES],
        *[
            F.percentile_approx(F.when(F.col("bad") == 1, F.col(f)), ranks, 10_000).alias(f"bad_{f}")
            for f in FEATURES
        ],
    ).first()
    places = {
        f: sorted({float(x) for kind in ("all", "bad") for x in cuts[f"{kind}_{f}"] or ()})
        for f in FEATURES
    }

    def bin_of(f: str) -> Column:
        at = F.array(*[F.lit(x) for x in places[f]]) if places[f] else F.array().cast("array<double>")
        return F.size(F.filter(at, lambda cut: F.col(f) >= cut))

    rows = kept_in_files(
        rows.select("bad", "grows", *FEATURES, F.array(*map(bin_of, FEATURES)).alias("bins")),
        "labelled-bins",
    )
    rules: list[list[Term]] = []
    left = F.lit(True)
    while len(rules) < MOST_RULES:
        rule = _grown(rows.where(left & F.col("grows")), places)
        rule = _pruned(rows.where(left & ~F.col("grows")), rule)
        if not rule:
            break
        rules.append(rule)
        left = left & ~_all(rule)
    return rules


def _all(rule: list[Term]) -> Column:
    column = F.lit(True)
    for term in rule:
        column = column & term.column()
    return column


def _grown(rows: DataFrame, places: dict[str, list[float]]) -> list[Term]:
    """Terms of the highest gain until nothing good is covered."""
    rule: list[Term] = []
    while len(rule) < MOST_TERMS:
        counts = (
            rows.where(_all(rule))
            .select("bad", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin")
            .agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
            .collect()
        )
        best, chosen, clean = 1e-9, None, False
        for number, f in enumerate(FEATURES):
            own = [r for r in counts if r["feature"] == number]
            bad, n = sum(r["bad"] for r in own), sum(r["n"] for r in own)
            if not bad or bad == n:
                return rule
            for k, cut in enumerate(places[f], 1):
                for above in (True, False):
                    part = [r for r in own if (r["bin"] >= k) == above]
                    p, m = sum(r["bad"] for r in part), sum(r["n"] for r in part)
                    if p < LEAST_COVERED or m == n:
                        continue
                    gain = p * (math.log2(p / m) - math.log2(bad / n))
                    if gain > best:
                        best, chosen, clean = gain, Term(f, cut, above), p == m
        if chosen is None:
            return rule
        rule.append(chosen)
        if clean:
            return rule
    return rule


def _pruned(rows: DataFrame, rule: list[Term]) -> list[Term]:
    """The prefix with the best precision on the pruning part, if it will do."""
    if not rule:
        return rule
    sums = []
    for k in range(1, len(rule) + 1):
        covered = _all(rule[:k])
        sums += [
            F.sum(F.when(covered, F.col("bad"))).alias(f"bad_{k}"),
            F.count(F.when(covered, 1)).alias(f"n_{k}"),
        ]
    found = rows.agg(*sums).first()
    best = max(
        range(1, len(rule) + 1),
        key=lambda k: ((found[f"bad_{k}"] or 0) / max(1, found[f"n_{k}"]), -k),
    )
    bad, n = found[f"bad_{best}"] or 0, found[f"n_{best}"]
    return rule[:best] if n and bad >= PRECISION * n else []


def verdict(rules: list[list[Term]]) -> Column:
    """The decision list as one conditional expression: false rejects."""
    column = F.when(F.col("base_failed"), F.lit(False))
    for rule in rules:
        column = column.when(_all(rule), F.lit(False))
    return column.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every row of ``docs(doc_id, text)``.

    Statistics are computed once and kept in files, which both learning and the
    verdict read. Equal and null ids are rows of their own. An empty table gives
    no rows. Other columns are not read.
    """
    found = kept_in_files(
        with_features(base_statistics(docs.select("doc_id", "text"))), "text-statistics"
    )
    return found.withColumn("kept", verdict(learn_rules(found, labels)))


def remove_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without rejected rows, with the columns of ``docs``.

    The texts are read twice, the sampled ones to learn and all to judge; no
    text is shuffled.
    """
    sampled = F.broadcast(sampled_labels(labels).select("doc_id"))
    chosen = docs.select("doc_id", "text").join(sampled, "doc_id", "left_semi")
    found = with_features(base_statistics(chosen))
    rules = learn_rules(kept_in_files(found, "text-statistics"), labels)
    whole = F.struct("*").alias("doc_id")  # the row in place of its id
    judged = docs.select(whole, "text")
    judged = with_features(base_statistics(judged)).where(verdict(rules))
    return judged.select("doc_id.*")
