"""Substring dedup: runs of words that collide in a band of their MinHash, checked and clustered.

A repeated passage may stand inside a longer line, or cross line ends. So the units compared are not
lines but overlapping runs of words that begin at places set by the words themselves: a place is a
candidate if the hash of its first words is less than those of the two places on either side, and
begins a run if it has the least hash of some ``window`` of places. Equal passages thus have runs at
equal places wherever they stand, and one of ``least`` words holds at least one whole run.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stationlake.llm.common import id_of, numbered, spans, written
from stationlake.llm.components import components
from stationlake.llm.hashing import STEP, mixed, words
from stationlake.llm.setjoin import Sets, similar, units

#: Words whose hash decides where a run begins, and places on either side that it is compared with.
OPENING = 3
ASIDE = 2
#: A similar pair must share a band with at least this probability.
RECALL = 0.98
#: Most values of a MinHash.
VALUES = 128
#: Bytes of text whose runs are made at once: they hold many times the words of the text.
STRETCH = 1 << 19
_random = np.random.default_rng(31)
_FACTOR = _random.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_FAR = np.uint64((1 << 64) - 1)


def bands_for(threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): as many rows as leave half of the bands of a pair at the threshold equal or fewer, and
    then as many bands as reach the recall."""
    if threshold >= 1:
        return 1, 1
    rows = max(1, math.floor(math.log(0.5) / math.log(threshold)))
    bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))
    while rows > 1 and rows * bands > VALUES:
        rows -= 1
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))
    if rows * bands > VALUES:
        raise ValueError(f"a threshold of {threshold} cannot be reached with {VALUES} values")
    return bands, rows


def least_over(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of the ``width`` places from each place on."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:-step], out[step:])
        covered += step
    return out


def _hashes(word: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on."""
    n = max(0, len(word) - width + 1)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        code = code * STEP + word[k : k + n]
    return mixed(code)


def beginnings(
    word: np.ndarray, text: np.ndarray, run: int, window: int, every_window: bool = False
) -> np.ndarray:
    """Where runs of ``run`` words begin, among the words of some texts, one text after the other.

    A window without a candidate (words in a short rhythm have none) begins no run, or, with
    ``every_window``, has one at the least of all its places.
    """
    n = len(word)
    if n < run + 2 * ASIDE or n < window:
        return np.zeros(0, dtype=np.int64)
    code = _hashes(word, OPENING)
    count = len(code)
    lower = np.ones(count, dtype=bool)
    for k in range(1, ASIDE + 1):
        lower[k:] &= code[k:] < code[:-k]
        lower[:-k] &= code[:-k] <= code[k:]
    # The run, and the places it is compared with, must lie in one text.
    place = np.arange(count)
    whole = (place >= ASIDE) & (place + run <= n) & (place + ASIDE + OPENING <= n)
    lo, hi = np.maximum(place - ASIDE, 0), np.minimum(np.maximum(place + run, place + ASIDE + OPENING), n) - 1
    whole &= text[lo] == text[hi]
    at_bits = np.uint64(max(1, int(count).bit_length()))
    key = np.where(whole, code >> at_bits << at_bits | place.astype(np.uint64), _FAR)
    least = least_over(np.where(lower, key, _FAR), window)
    if every_window:
        least = np.where(least == _FAR, least_over(key, window), least)
    # A window counts if all its places are in one text, whether a run may begin there or not.
    end = np.minimum(np.arange(len(least)) + window - 1 + run - 1, n - 1)
    inside = text[np.arange(len(least))] == text[end]
    inside &= np.arange(len(least)) + window + run - 1 <= n
    chosen = least[inside & (least != _FAR)]
    return np.unique((chosen & ((np.uint64(1) << at_bits) - np.uint64(1))).astype(np.int64))


def runs(run: int, least: int, shingle: int, every_window: bool = False):
    """Hashes of the ``shingle``-word shingles of every run; the unit is the number of its first word."""
    window = least - run - ASIDE + 1

    def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, text, _ = words(texts)
        begin = beginnings(word, text, run, window, every_window)
        inner = run - shingle + 1
        at = spans(begin, np.full(len(begin), inner))
        first = np.searchsorted(text, np.arange(len(texts)))
        unit = begin - first[text[begin]] if len(begin) else begin
        return _hashes(word, shingle)[at], np.repeat(text[begin], inner), np.repeat(unit, inner)

    return tokens


def band_keys(bands: int, rows: int):
    """Keys of a set: a hash of each band of its smallest values under random permutations."""

    def keys(sets: Sets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(sets.size)
        owner = np.tile(np.arange(n), bands)
        found = np.zeros((bands, n), dtype=np.uint64)
        for band in range(bands if n else 0):
            key = np.full(n, band, dtype=np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                value = sets.token * _FACTOR[k] + _SHIFT[k]
                value ^= value >> np.uint64(32)
                key = mixed(key * STEP + np.minimum.reduceat(value * STEP, sets.start))
            found[band] = key
        return found.reshape(-1), owner, sets.size[owner]

    return keys


def _check(least: int, run: int, shingle: int, threshold: float) -> None:
    if not 0 < threshold <= 1 or not OPENING <= shingle <= run or least < run + ASIDE:
        raise ValueError("give a threshold above 0 and at most 1, and shingle <= run < least")


def dedup_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 50,
    run: int = 20,
    shingle: int = 5,
    threshold: float = 0.8,
    every_window: bool = False,
) -> DataFrame:
    """One row per run of words: ord, doc_id, tie, first_word (from 0), words, lowest, removed.

    Words are split at blanks and 0x09 - 0x0D, A-Z count as a-z, line ends as any other. A passage of
    ``least`` words that occurs twice is found wherever it stands; texts of fewer words have no rows.
    Two runs are linked if the Jaccard similarity of their sets of ``shingle``-word shingles is
    ``threshold`` or more. ``lowest`` (ord, tie, unit) is the first run that links reach, and a run
    is removed if that one lies in an earlier text, or in the same text ending before it begins.
    Texts follow each other by doc_id, null ids last; ``tie`` tells rows of one id apart, by the
    SHA-256 of their texts (0 if the ids do not repeat; null ids: from 2^60 on). Null and empty texts have no rows; an empty table
    gives none; other columns are not looked at. A passage without any place to cut (one or two
    words, repeated) is found with ``every_window`` only.
    """
    _check(least, run, shingle, threshold)
    found, shared = _shared(numbered(docs, id_col, text_col), least, run, shingle, threshold, every_window)
    shared = shared.select("ord", "tie", "unit", "lowest", "removed")
    return found.join(shared, ["ord", "tie", "unit"], "left").select(
        "ord",
        id_of("ord", "tie").alias("doc_id"),
        "tie",
        F.col("unit").alias("first_word"),
        F.lit(run).alias("words"),
        F.coalesce("lowest", F.struct("ord", "tie", "unit")).alias("lowest"),
        F.coalesce("removed", F.lit(False)).alias("removed"),
    )


def _shared(
    body: DataFrame, least: int, run: int, shingle: int, threshold: float, every_window: bool
) -> tuple[DataFrame, DataFrame]:
    """All runs (ord, tie, unit, size, label), and those with a like one: besides, lowest and removed."""
    tokens = runs(run, least, shingle, every_window)
    found = written(units(body, tokens, stretch=STRETCH), "units")
    first, links = similar(found, body, tokens, band_keys(*bands_for(threshold)), threshold, True, STRETCH)
    graph = components(links, "a", "b").withColumnRenamed("node", "label")
    # A class of one run without a link is of no more interest.
    named = first.join(graph, "label", "left").where("n > 1 OR component IS NOT NULL")
    named = written(named.select("label", "first", F.coalesce("component", "label").alias("component")), "classes")
    lowest = named.groupBy("component").agg(F.min("first").alias("lowest"))
    named = named.join(lowest, "component").select("label", "lowest")
    own, other = F.struct("ord", "tie"), F.struct("lowest.ord", "lowest.tie")
    earlier = (other < own) | ((other == own) & (F.col("lowest.unit") + run <= F.col("unit")))
    return found, found.join(named, "label").withColumn("removed", earlier)


def passage_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 50,
    run: int = 20,
    shingle: int = 5,
    threshold: float = 0.8,
    every_window: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, tie, n_units, n_removed (words), removed_spans, kept_in_doc_ids.

    ``removed_spans`` lists first and last word of every stretch that goes; runs that overlap or touch
    are one stretch. ``kept_in_doc_ids`` are the documents that hold the first copies (a null id is left
    out). With ``every_window`` no passage of ``least`` words that repeats is missed. See ``dedup_passages``; texts without a run have zeros and empty lists.
    """
    _check(least, run, shingle, threshold)
    body = numbered(docs, id_col, text_col)
    found, shared = _shared(body, least, run, shingle, threshold, every_window)
    counts = found.groupBy("ord", "tie").agg(F.count(F.lit(1)).alias("n_units"))
    gone = _stretches(shared.where("removed"), run)
    rows = body.select("ord", "doc_id", "tie")
    joined = rows.join(counts, ["ord", "tie"], "left").join(gone, ["ord", "tie"], "left")
    none, nowhere = (F.array().cast(kind) for kind in ("array<struct<first:bigint,last:bigint>>", "array<bigint>"))
    return joined.select(
        "doc_id",
        "tie",
        F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_spans", none).alias("removed_spans"),
        F.coalesce("kept_in_doc_ids", nowhere).alias("kept_in_doc_ids"),
    )


def _stretches(gone: DataFrame, run: int) -> DataFrame:
    """The removed runs of each text as stretches; a window and a group hold the runs of one text."""
    before = Window.partitionBy("ord", "tie").orderBy("unit")
    opens = F.coalesce(F.col("unit") > F.lag("unit").over(before) + run, F.lit(True))
    marked = gone.withColumn("opens", opens).withColumn("stretch", F.count_if("opens").over(before))
    found = marked.groupBy("ord", "tie", "stretch").agg(
        F.min("unit").alias("first"),
        (F.max("unit") + run - 1).alias("last"),
        F.collect_set(id_of("lowest.ord", "lowest.tie")).alias("kept"),
    )
    return found.groupBy("ord", "tie").agg(
        F.sum(F.col("last") - F.col("first") + 1).alias("n_removed"),
        F.array_sort(F.collect_list(F.struct("first", "last"))).alias("removed_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("kept")))).alias("kept_in_doc_ids"),
    )
