"""Line dedup by an exact set-similarity join with prefix, positional and length filters."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import LAST, id_of, numbered, spans, with_marks, with_ties, written
from stationlake.llm.hashing import words
from stationlake.llm.setjoin import Sets, least_shared, similar, sorted_in_groups, units

#: Counters of the table that orders tokens by rarity; its size is fixed, 4 bytes each.
COUNTERS = 1 << 17
#: Counts beyond this are all the same to the order.
MOST = (1 << 20) - 1


def rarity(found: DataFrame) -> np.ndarray:
    """In how many lines the tokens of each counter stand. A token's counter is given by its hash.

    Any order of all tokens makes prefix filtering exact; the true counts make it sharp. Counters of
    fixed number keep the table small whatever the vocabulary.
    """
    counted = found.where("tie < 0").groupBy("ord").agg(F.sum("size").alias("n"))
    rows = counted.toPandas()  # at most COUNTERS rows
    table = np.zeros(COUNTERS, dtype=np.int64)
    table[rows["ord"].to_numpy()] = np.minimum(rows["n"].to_numpy(), MOST)
    return table


def prefix_keys(counts: np.ndarray, t: Fraction):
    """Keys of a set: its rarest tokens, as many as any similar set must share one of."""

    def keys(sets: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets.size)), sets.size)
        rank = counts[(sets.token % np.uint64(COUNTERS)).astype(np.int64)]
        order = sorted_in_groups(owner, rank, sets.token)
        # The smallest share with any similar set is that with the smallest one allowed.
        least = -(-t.numerator * sets.size // t.denominator)
        length = np.where(_has_partners(sets.size, t), sets.size - least + 1, 0)
        at = spans(sets.start, length)
        place = at - np.repeat(sets.start, length)
        owner = np.repeat(np.arange(len(sets.size)), length)
        return sets.token[order][at], owner, sets.size[owner] - 1 - place

    return keys


def _has_partners(size: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether a different set can be similar at all: the nearest one has one token more."""
    return least_shared(t, size, size + 1) <= size


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8
) -> DataFrame:
    """One row per line that has a token: doc_id, tie, line (from 0), size, links, removed.

    Tokens are the distinct words of a line (A-Z as a-z, split at blanks and 0x09 - 0x0D). A line is
    removed if an earlier one (smaller doc_id, or earlier in the document) has a Jaccard similarity
    of ``threshold`` or more with it, whether that one stays or not. ``links`` counts the similar lines
    with different tokens, equal ones among them once. ``tie`` is 0 unless a doc_id repeats: it
    then orders its rows, by the SHA-256 of the text. Null ids come last, with ties from 2^60 on. Blank lines and null or empty
    texts have no rows; an empty table gives none; other columns are not looked at.
    """
    body = numbered(docs, id_col, text_col)
    return _judged(body, threshold).select("doc_id", "tie", "line", "size", "links", "removed")


def _judged(body: DataFrame, threshold: float) -> DataFrame:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    t = Fraction(threshold).limit_denominator(1000)
    found = written(units(body, words, COUNTERS), "units")
    keys = prefix_keys(rarity(found), t)
    found = found.where("tie >= 0")
    first, checked = similar(found, body, words, keys, threshold, forest_only=False)
    judged = first.join(checked, "label", "left")
    place = F.struct("ord", "tie", "unit")
    judged = judged.select("label", F.col("first"), F.coalesce("links", F.lit(0)).alias("links"), F.least("first", "earliest").alias("least"))
    return found.join(judged, "label").select(
        id_of("ord", "tie").alias("doc_id"),
        "ord",
        "tie",
        F.col("unit").alias("line"),
        "size",
        "links",
        (F.col("least") < place).alias("removed"),
    )


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per input row: doc_id, tie, n_lines (with a token), n_links, n_removed, removed_lines.

    See ``dedup_lines``; a text without such a line has zeros and an empty list.
    """
    judged = _judged(numbered(docs, id_col, text_col), threshold)
    found = judged.groupBy("ord", "tie").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("links").alias("n_links"),
        F.count_if("removed").alias("n_removed"),
        F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("line")))).alias("removed_lines"),
    )
    rows = numbered(docs, id_col, text_col).select("ord", "doc_id", "tie")
    counts = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_links", "n_removed"))
    none = F.array().cast("array<bigint>")
    return rows.join(found, ["ord", "tie"], "left").select(
        "doc_id", "tie", *counts, F.coalesce("removed_lines", none).alias("removed_lines")
    )


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8
) -> DataFrame:
    """The rows of ``docs`` with the removed lines taken out of their texts; null texts stay null."""
    row = F.struct(*(n for n in docs.columns if n != text_col)).alias("row")
    ids, body = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    whole = docs.select(row, ids.alias("doc_id"), body.alias("text"))
    tied = with_ties(whole)
    body = tied.select("ord", "doc_id", F.coalesce("text", F.lit("")).alias("text"), "tie")
    gone = _judged(body, threshold).where("removed").groupBy("ord", "tie").agg(F.collect_list("line").alias("gone"))
    gone = written(gone, "lines")
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), "gone")
    kept = F.transform(left, lambda k: F.element_at(lines, k.cast("int") + 1))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))

    def columns(text):
        return (text.alias(n) if n == text_col else F.col(f"row.`{n}`").alias(n) for n in docs.columns)

    # Texts that lose no line stay where they are. All rows of an id go one way, so their ties hold.
    ids = whole.withColumn("ord", F.coalesce("doc_id", F.lit(LAST)))
    untouched = with_marks(ids, gone, "ord").where(~F.col("marked")).select(*columns(F.col("text")))
    # The lists grow with the corpus and are not for every task, however small they are in files.
    touched = with_marks(tied, gone, "ord").where("marked").join(gone.hint("merge"), ["ord", "tie"], "left")
    return untouched.unionByName(touched.select(*columns(text)))
