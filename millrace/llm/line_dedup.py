"""Line dedup by a suffix array over sequences of line ids.

Every text is a sequence of its lines that hold a word. The suffixes that start
with a repeated line are sorted by distributed prefix doubling: the rank of a
suffix by its first ``2k`` lines comes from the ranks, by ``k`` lines, of itself
and of the suffix ``k`` lines on. It goes on until no rank repeats.

The suffixes of a rank that part before the next depth are then divided into
intervals of their longest common prefix, adding half the depth, a quarter and
so on by the ranks of those depths. In every interval the suffixes but the
earliest have an earlier copy of as many lines as the interval has in common,
which is the longest that they have. Runs that do not go on from the line before
are maximal; they are what is removed.

Equal texts are one sequence: the earliest stands for them, and the others are
whole copies of it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, kept_in_files, numbered

#: A repeated run is removed from so many lines on, or if it is one line of so
#: many words.
MIN_LINES = 2
MIN_WORDS = 5

_WORD = r"[^\x20\x09-\x0D]"

#: An interval: the step that formed it, its number there, the lines in common.
_INTERVAL = ["origin", "class", "depth"]


def _ordered(keys: DataFrame, *by: str) -> DataFrame:
    """``keys`` with a number ``place`` that rises in the order of ``by``.

    Range partitions are sorted by themselves, so no task gets all rows; numbers
    leave gaps between partitions.
    """
    ranked = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    return kept_in_files(
        ranked.withColumn("place", F.monotonically_increasing_id()), "suffix-ranks"
    )


def _repeated(rows: DataFrame, *by: str) -> DataFrame:
    return _ordered(rows.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").drop("n"), *by)


def sorted_suffixes(lines: DataFrame) -> list[DataFrame]:
    """Suffixes of ``lines(position, weight, id, check)`` that repeat at depth 1, 2, 4 ...

    Each table holds (position, weight, rank, child): equal ranks mean that so
    many lines are equal, and ``child`` is the rank at the next depth, null where
    the sequence ends or nothing repeats.
    """
    repeated = _repeated(lines, "id", "check").withColumnRenamed("place", "rank")
    suffixes = kept_in_files(
        lines.join(repeated, ["id", "check"]).select("position", "weight", "rank"),
        "repeated-suffixes",
    )
    levels: list[DataFrame] = []
    while True:
        depth = 2 ** len(levels)
        here = suffixes.select("*", "position.row_no", "position.seq")
        later = suffixes.select(
            "position.row_no",
            (F.col("position.seq") - depth).alias("seq"),
            F.col("rank").alias("second"),
        )
        paired = here.join(later, ["row_no", "seq"], "left")
        pairs = _repeated(paired.where("second is not null"), "rank", "second")
        level = kept_in_files(
            paired.join(pairs.withColumnRenamed("place", "child"), ["rank", "second"], "left").select(
                "position", "weight", "rank", "child"
            ),
            "suffix-array",
        )
        levels.append(level)
        suffixes = level.where("child is not null").select(
            "position", "weight", F.col("child").alias("rank")
        )
        if suffixes.isEmpty():
            return levels


def _parting(level: DataFrame, number: int) -> DataFrame:
    """Intervals of one depth with the suffixes that part before the next depth, and
    the earliest of those that stay together."""
    together = (
        level.where("child is not null")
        .groupBy("rank", "child")
        .agg(F.min("position").alias("position"), F.sum("weight").alias("weight"))
    )
    members = level.where("child is null").select("rank", "position", "weight").unionByName(
        together.drop("child")
    )
    return members.select(
        F.lit(number).alias("origin"),
        F.col("rank").alias("class"),
        F.lit(2**number).cast("long").alias("depth"),
        "position",
        "weight",
    )


def _divided(members: DataFrame, level: DataFrame, number: int) -> DataFrame:
    """``members`` of intervals, after those that go on alike for the lines of
    ``level`` went to an interval of their own and left their earliest behind."""
    later = level.select(
        "position.row_no", F.col("position.seq").alias("from"), F.col("rank").alias("next")
    )
    at = members.select(
        "*", "position.row_no", (F.col("position.seq") + F.col("depth")).alias("from")
    )
    looked = kept_in_files(
        at.join(later, ["row_no", "from"], "left").drop("row_no", "from"), "suffix-steps"
    )
    alike = (
        looked.where("next is not null")
        .groupBy(*_INTERVAL, "next")
        .agg(
            F.min("position").alias("position"),
            F.sum("weight").alias("weight"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
        .drop("n")
    )
    # Written, so that an interval with very many suffixes can be split in the join.
    alike = kept_in_files(alike.withColumn("new", F.monotonically_increasing_id()), "suffix-splits")
    tagged = looked.join(alike.select(*_INTERVAL, "next", "new"), [*_INTERVAL, "next"], "left")
    moved = F.col("new").isNotNull()
    went = tagged.select(
        F.when(moved, F.lit(-1 - number)).otherwise(F.col("origin")).alias("origin"),
        F.coalesce("new", "class").alias("class"),
        F.when(moved, F.col("depth") + 2**number).otherwise(F.col("depth")).alias("depth"),
        "position",
        "weight",
    )
    return kept_in_files(
        went.unionByName(alike.select(*_INTERVAL, "position", "weight")), "suffix-intervals"
    )


def earlier_copies(lines: DataFrame) -> DataFrame:
    """(position, lines, copies, first) for each suffix with an earlier copy: the most
    lines that it has in common with an earlier one, how often these lines occur,
    and where they occur first."""
    levels = sorted_suffixes(lines)
    members: DataFrame | None = None
    for number in range(len(levels) - 1, -1, -1):
        parting = _parting(levels[number], number)
        members = parting if members is None else members.unionByName(parting)
        if number:
            members = _divided(members, levels[number - 1], number - 1)
    intervals = kept_in_files(
        members.groupBy(*_INTERVAL)
        .agg(
            F.min("position").alias("first"),
            F.sum("weight").alias("copies"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
        .drop("n"),
        "common-prefixes",
    )
    return (
        members.join(intervals, _INTERVAL)
        .where("position.row_no <> first.row_no or position.seq <> first.seq")
        .select("position", F.col("depth").alias("lines"), "copies", "first")
    )


def _worded(text: Column | str) -> Column:
    """The lines of a text that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))


def _is_long(line: Column, min_words: int) -> Column:
    return F.size(F.filter(F.split(line, WHITE), lambda w: w != "")) >= min_words


def _firsts(base: DataFrame) -> DataFrame:
    """(h, check, first, weight): every different text, its earliest row and its rows."""
    return kept_in_files(
        base.where("text is not null")
        .groupBy("h", "check")
        .agg(F.min(F.struct("doc_id", "row_no")).alias("first"), F.count("*").alias("weight")),
        "different-texts",
    )


def _line_ids(base: DataFrame, firsts: DataFrame, min_words: int) -> DataFrame:
    lines = base.select("row_no", "doc_id", F.posexplode(_worded("text")).alias("seq", "line")).select(
        F.struct(
            "doc_id",
            "row_no",
            F.col("seq").cast("long").alias("seq"),
            _is_long(F.col("line"), min_words).alias("long"),
        ).alias("position"),
        "row_no",
        F.xxhash64("line").alias("id"),
        # The constant comes first: a hash is the seed of the next column's.
        F.xxhash64(F.lit(1), "line").alias("check"),
    )
    kept = firsts.select("first.row_no", "weight")
    return kept_in_files(lines.join(kept, "row_no").drop("row_no"), "document-lines")


def _rows(docs: DataFrame) -> DataFrame:
    """(row_no, doc_id, text, h, check) of ``docs(row_no, doc_id, text)``."""
    return docs.select(
        "row_no",
        "doc_id",
        "text",
        F.xxhash64("text").alias("h"),
        F.xxhash64(F.lit(1), "text").alias("check"),
    )


def _later_rows(base: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of ``base`` whose text has an earlier row."""
    rows = base.where("text is not null").select("row_no", "doc_id", "h", "check")
    return rows.join(firsts, ["h", "check"]).where("row_no <> first.row_no")


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """The maximal runs of lines of ``docs`` that have an earlier copy:
    ``(doc_id, start, lines, copies, first_doc_id, first_start)``.

    ``start`` counts the lines of the document that hold a word from 0, ``copies``
    all places where the run occurs, itself included. A run is listed at each
    place but the first, and not again from its second line on; runs of one
    document may overlap. Only the first of equal texts has its runs listed; the
    others are one run, the whole text, whose copies are the equal texts.
    """
    base = _rows(numbered(docs.select("doc_id", "text"), "line-runs-rows", "doc_id", "text"))
    firsts = _firsts(base)
    found = earlier_copies(_line_ids(base, firsts, MIN_WORDS))
    before = Window.partitionBy("position.row_no").orderBy("position.seq")
    last = F.max(F.col("position.seq") + F.col("lines")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        found.withColumn("reached", last)
        .where(F.col("reached").isNull() | (F.col("position.seq") + F.col("lines") > F.col("reached")))
        .where(F.col("lines") >= min_lines)
        .select(
            "position.doc_id",
            F.col("position.seq").alias("start"),
            "lines",
            "copies",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.seq").alias("first_start"),
        )
    )
    sizes = base.select("row_no", F.size(_worded("text")).cast("long").alias("lines"))
    whole = (
        _later_rows(base, firsts)
        .join(sizes.where(F.col("lines") >= min_lines), "row_no")
        .select(
            "doc_id",
            F.lit(0).cast("long").alias("start"),
            "lines",
            F.col("weight").alias("copies"),
            F.col("first.doc_id").alias("first_doc_id"),
            F.lit(0).cast("long").alias("first_start"),
        )
    )
    return runs.unionByName(whole)


def removed_spans(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """``(row_no, spans, whole)`` of the rows of ``docs(row_no, doc_id, text)`` that may
    lose lines: start and number of the lines with a word that go, or ``whole`` for
    a text that has an earlier row."""
    base = _rows(docs)
    firsts = _firsts(base)
    found = earlier_copies(_line_ids(base, firsts, min_words)).select(
        "position.row_no",
        "position.seq",
        F.when(F.col("lines") >= min_lines, F.col("lines"))
        .when(F.col("position.long"), 1)
        .alias("lines"),
    )
    before = (
        Window.partitionBy("row_no").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.greatest(F.col("seq"), F.max(F.col("seq") + F.col("lines")).over(before))
    spans = (
        found.where("lines is not null")
        .withColumn("start", start)
        .withColumn("n", F.col("seq") + F.col("lines") - F.col("start"))
        .where("n > 0")
        .groupBy("row_no")
        .agg(F.collect_list(F.struct("start", "n")).alias("spans"))
        .withColumn("whole", F.lit(False))
    )
    copies = _later_rows(base, firsts).select(
        "row_no", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.lit(True).alias("whole")
    )
    return spans.unionByName(copies)


def dedup_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with the later copies of repeated runs of lines removed from
    ``text``, and the columns n_lines and n_removed.

    Lines end at a newline and are equal if all their characters are. A run is
    removed if it has an earlier copy and ``min_lines`` lines that hold a word, or
    one such line of ``min_words`` words; the earliest copy, by doc_id (null
    first) and then by row and place, stays. Runs do not cross documents.
    Lines without a word stay. A null text stays null with no lines; repeated
    rows are copies of the first. A document all of whose lines are copies has
    an empty text. Other columns pass through.
    """
    has_word = re.compile(_WORD)

    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for own, gone in zip(text, spans):
            if gone is not None and len(gone):
                numbers = {s["start"] + k for s in gone for k in range(s["n"])}
                kept, seq = [], 0
                for line in own.split("\n"):
                    if has_word.search(line):
                        if seq not in numbers:
                            kept.append(line)
                        seq += 1
                    else:
                        kept.append(line)
                own = "\n".join(kept)
            out.append(own)
        return pd.Series(out, dtype=object)

    base = numbered(docs, "line-dedup-rows", F.struct("*").alias("doc"))
    removed = removed_spans(
        base.select("row_no", "doc.doc_id", "doc.text"), min_lines, min_words
    )
    # A whole copy loses all its lines if they are a run, else the long ones.
    worded = _worded("doc.text")
    each = F.filter(
        F.transform(
            worded,
            lambda line, k: F.struct(
                k.cast("long").alias("start"),
                F.when(_is_long(line, min_words), 1).otherwise(0).cast("long").alias("n"),
            ),
        ),
        lambda s: s["n"] > 0,
    )
    all_lines = F.array(
        F.struct(F.lit(0).cast("long").alias("start"), F.size(worded).cast("long").alias("n"))
    )
    spans = F.when(
        F.col("whole"), F.when(F.size(worded) >= min_lines, all_lines).otherwise(each)
    ).otherwise(F.col("spans"))
    joined = base.join(removed, "row_no", "left").withColumn("spans", spans)
    gone = F.coalesce(
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n"]), F.lit(0).cast("long")
    )
    text = F.when(gone == 0, F.col("doc.text")).otherwise(without(F.col("doc.text"), F.col("spans")))
    lines = F.when(F.col("doc.text").isNull(), 0).otherwise(F.size(F.split("doc.text", "\n")))
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns],
        lines.cast("long").alias("n_lines"),
        gone.alias("n_removed"),
    )


def remove_repeated_lines(docs: DataFrame, **options: int) -> DataFrame:
    """:func:`dedup_lines` with the columns of ``docs`` alone."""
    names = [f"column_{k}" if c in ("n_lines", "n_removed") else c for k, c in enumerate(docs.columns)]
    return dedup_lines(docs.toDF(*names), **options).select(*names).toDF(*docs.columns)
