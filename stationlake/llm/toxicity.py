"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import crc_mod, slices, texts, written

FOLDS = 5  # fold 0 is held out; 1 and 2 give the lexicon, 3 the trees, 4 the calibration
#: Bounds of the fit: labelled documents a fold (those of the smallest hash), entries of the lexicon.
PER_FOLD = 10_000
ENTRIES = 3_000
#: An entry stands in so many toxic documents at least, and is so much commoner there (log ratio).
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 2.0
STEMS = (4, 5)
NEAR = 5
KEPT_WORDS = 400_000
#: Pronouns and possessives that address the reader, in English, German, French, Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself youre du dich dir dein deine deiner ihr euch euer eure tu te toi ton ta tes vous "
    "votre vos tú ti tuyo tuya usted ustedes vosotros vuestro vuestra".split()
)
#: Signs written in place of letters.
FOLDED = str.maketrans("013457@$!", "oieastasi")
WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"(?=[\w@$!*]*[^\W\d_])(?=[\w@$!*]*[\d@$!*])[^\W_][\w@$!*]*[\w@$*]")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
FEATURES = (
    "lexicon_density", "lexicon_weight", "lexicon_entries", "strongest", "stem_density", "stem_entries",
    "second_person", "near_second_person", "capitals", "shouted_words", "exclamations", "punctuation",
    "disguised", "disguised_hits", "stretched", "log_words",
)


def stems(word: str) -> list[str]:
    """The beginnings of a longer word, so that forms not seen before are met."""
    return [f"{word[:k]}-" for k in STEMS if len(word) > k + 1]


@dataclass
class Lexicon:
    """Weights of words and of word beginnings (those end with a dash)."""

    weights: dict[str, float]
    _codes: dict[str, int] = field(default_factory=dict, repr=False)

    def code(self, word: str) -> int:
        """0: plain, -1: second person, n: entry n, whole words before beginnings."""
        if word not in self._codes:
            if len(self._codes) > KEPT_WORDS:
                self._codes.clear()
            hit = next((w for w in (word, *stems(word)[::-1]) if w in self.weights), None)
            self._codes[word] = self.place[hit] if hit else -1 if word in SECOND_PERSON else 0
        return self._codes[word]

    def __post_init__(self):
        self.names = sorted(self.weights)
        self.place = {name: k + 1 for k, name in enumerate(self.names)}
        self.values = np.array([0.0, *(self.weights[n] for n in self.names)])
        self.is_stem = np.array([False, *(n.endswith("-") for n in self.names)])

    def features(self, text: str) -> list[float]:
        lower = text.lower()
        words = WORD.findall(lower)
        n = max(1, len(words))
        try:
            codes = np.fromiter(map(self._codes.__getitem__, words), dtype=np.int64, count=len(words))
        except KeyError:
            codes = np.fromiter(map(self.code, words), dtype=np.int64, count=len(words))
        at = np.flatnonzero(codes > 0)
        hits = codes[at]
        stem = self.is_stem[hits]
        you = np.flatnonzero(codes < 0)
        near = 0
        if len(at) and len(you):
            right = np.searchsorted(you, at)
            gap = np.minimum(
                np.abs(you[np.minimum(right, len(you) - 1)] - at), np.abs(you[np.maximum(right - 1, 0)] - at)
            )
            near = int((gap <= NEAR).sum())
        letters = sum(map(len, words)) or 1
        capitals = sum(map(len, _CAPITALS.findall(text)))
        disguised = DISGUISED.findall(lower) if _SIGN.search(lower) else []
        unmasked = sum(
            self.code(w) > 0 for d in disguised for w in (d.translate(FOLDED).replace("*", ""),) if w.isalpha()
        )
        marks = text.count("!")
        return [
            len(at) / n,
            float(self.values[hits].sum()) / n,
            float(np.log1p(len(np.unique(hits[~stem])))),
            float(self.values[hits].max()) if len(hits) else 0.0,
            int(stem.sum()) / n,
            float(np.log1p(len(np.unique(hits[stem])))),
            len(you) / n,
            near / n,
            capitals / letters,
            len(_SHOUTED.findall(text)) / n,
            (marks + text.count("?")) / n,
            len(_MARKS.findall(text)) / n,
            len(disguised) / n,
            unmasked / n,
            len(STRETCHED.findall(lower)) / n,
            float(np.log1p(len(words))),
        ]


_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
_MARKS = re.compile(r"[^\w\s]")
_SIGN = re.compile(r"[\d@$*]")


def learn_lexicon(sample: DataFrame, entries: int = ENTRIES) -> Lexicon:
    """Words and word beginnings of toxic documents, from ``text, toxic``, by document frequency."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(WORD.findall((text or "").lower()))
                found.update([s for w in found for s in stems(w)])
                counts[toxic].update(found)
            for toxic in (0, 1):
                terms = counts[toxic]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.keys(), pa.string()), pa.array([toxic] * len(terms), pa.int32()), pa.array(terms.values(), pa.int64())],
                    ["term", "toxic", "n"],
                )

    totals = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = sample.select("toxic", "text").mapInArrow(work, "term string, toxic int, n long")
    by_term = counted.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    weight = F.log((F.col("a") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("b") + 0.5) / (totals.get(0, 0) + 1))
    kept = (
        by_term.withColumn("weight", weight)
        .where((F.col("a") >= LEAST_DOCUMENTS) & (F.col("weight") >= LEAST_WEIGHT))
        .orderBy(F.desc(F.col("a") * F.col("weight")), "term")
        .limit(entries)
        .collect()
    )
    return Lexicon({row.term: float(row.weight) for row in kept})


def feature_table(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id and the dense features of ``doc_id, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([lexicon.features(text or "") for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column) for column in rows.T)], ["doc_id", *FEATURES]
            )

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def fold(doc_id: Column) -> Column:
    return crc_mod(doc_id, FOLDS)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_fold: int = PER_FOLD,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Labels are read for documents whose crc32 of the id as text leaves 1 to 4 on division by 5, at
    most ``per_fold`` of each remainder, those of the smallest hash; a document labelled twice is
    toxic if any label says so. Null labels and ids teach nothing. Null and empty texts are scored
    like any other. Where the labels of a fold have a single value, all learning folds are used, and
    if that does not help every score is 1 or 0 as that value, 0 without labels. Repeated rows stay.
    """
    body = texts(docs, id_col, text_col)
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("fold", fold(F.col("doc_id")))
    )
    chosen = None
    for k in range(1, FOLDS):
        part = marked.where(F.col("fold") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_fold)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = written(chosen, "labelled")  # at most per_fold * 4 rows of 16 bytes, so it may be broadcast
    sample = body.join(F.broadcast(chosen.where("fold in (1, 2)")), "doc_id").select("toxic", "text")
    table = written(feature_table(body, learn_lexicon(sample)), "features")
    learn = table.join(F.broadcast(chosen), "doc_id")
    sizes = {(r.fold, r.toxic): r.n for r in learn.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def of(k: int) -> DataFrame:
        both = (k, 0) in sizes and (k, 1) in sizes
        return learn.where(F.col("fold") == k) if both else learn

    values = {toxic for _, toxic in sizes}
    if len(values) < 2:
        scored = table.withColumn("score", F.lit(float(max(values, default=0))))
    else:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=7)
        model = trees.fit(assembler.transform(of(3)))

        def margin(rows: DataFrame) -> DataFrame:
            found = model.transform(assembler.transform(rows))
            return found.withColumn("margin", vector_to_array("probability")[1])

        steps = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="calibrated")
        calibration = margin(of(4)).select("margin", F.col("toxic").cast("double").alias("toxic"))
        steps = steps.fit(calibration)
        scored = steps.transform(margin(table).select("doc_id", "margin"))
        scored = scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
