"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import bucket, slices, texts, written

VOCABULARY = "word_bpe_49k.json"
#: Pieces that one task packs, on average, and words whose ids a worker keeps.
PIECES_PER_TASK = 100_000
KEPT_WORDS = 300_000
#: Characters of one text that are worked on at once.
STRETCH = 1 << 20
_GAP = re.compile(r"[ \n\t\r]")

#: Marks that may end a word and then form one token of their own.
MARKS = ".,!?;:&%$#*"
#: Letters below this are the same in every version of Unicode in use; words beyond it go the long way.
STABLE = "\u0530"

_tokenizer: dict[str, object] = {}
_words: dict[str, bytes] = {}
_parts: dict[str, bytes] = {}


def _byte_letters() -> str:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    shown = [b for r in ((33, 127), (161, 173), (174, 256)) for b in range(*r)]
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


_LETTERS = _byte_letters()


def _load(vocabulary: str):
    """The tokenizer of this worker; a bare file name is looked up in the installed vocabularies."""
    if vocabulary not in _tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        for kept in (_tokenizer, _words, _parts):
            kept.clear()
        _tokenizer[vocabulary] = Tokenizer.from_file(path)
    return _tokenizer[vocabulary]


def _part(tokenizer, part: str) -> bytes:
    """Ids of letters or marks that the tokenizer would not split before its merges."""
    if part not in _parts:
        if len(_parts) > KEPT_WORDS:
            _parts.clear()
        letters = part.encode().decode("latin-1").translate(_LETTERS)
        _parts[part] = np.array([token.id for token in tokenizer.model.tokenize(letters)], dtype="<u4").tobytes()
    return _parts[part]


def _word(tokenizer, word: str) -> bytes:
    """Ids of one word. Plain letters with marks behind go to the merges directly, all else the long way."""
    core = word.rstrip(MARKS)
    marks = word[len(core) :]
    lower = core.lower()
    if lower.isalpha() and (core.isascii() or max(core) < STABLE and "\u03a3" not in core and is_normalized("NFC", core)):
        return _part(tokenizer, lower) + (_part(tokenizer, marks) if marks else b"")
    return np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH:
        cut = _GAP.search(text, start + STRETCH)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def token_ids(batch: list[str], vocabulary: str) -> Iterator[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words,
    and words seen before need no second look.
    """
    tokenizer = _load(vocabulary)
    for text in batch:
        found = []
        for stretch in _stretches(text):
            words = stretch.replace("\n", " ").split(" ")
            try:
                found.append(b"".join(map(_words.__getitem__, words)))
            except KeyError:
                if len(_words) > KEPT_WORDS:
                    _words.clear()
                for word in set(words).difference(_words):
                    _words[word] = _word(tokenizer, word)
                found.append(b"".join(map(_words.__getitem__, words)))
        yield b"".join(found)


def pieces(docs: DataFrame, limit: int, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``limit`` tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(end_id).to_bytes(4, "little")
        for batch in slices(batches):
            cut = []
            plain = [text or "" for text in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), token_ids(plain, vocabulary)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    cut.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*cut))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def sum_of_squares(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, placed in the given order.

    An item goes to the open bin that makes the sum of the squared numbers of open bins per residual
    gap smallest, among equals to the one with the smallest gap. Full bins leave the sum. A new bin is
    opened only when no open one has room, as few bins are the aim.
    """
    count = np.zeros(limit + 1, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(limit + 1)]
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    made = 0
    never = np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        gaps = count[size:limit]
        if gaps.any():
            change = 2 * (count[: limit - size] - gaps) + 2
            change[0] = 1 - 2 * gaps[0]
            change[gaps == 0] = never
            gap = int(change.argmin()) + size
            chosen = open_[gap].pop()
            count[gap] -= 1
        else:
            gap, chosen = limit, made
            made += 1
        bins[k], offsets[k] = chosen, limit - gap
        if gap > size:
            open_[gap - size].append(chosen)
            count[gap - size] += 1
    return bins, offsets


def packed_order(lengths: np.ndarray) -> np.ndarray:
    """Longest first: the rule then fills the last gaps with the shortest pieces."""
    return np.argsort(-lengths, kind="stable")


def _packer(limit: int, keys: list[str]):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(keys, kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy()
        order = packed_order(lengths)
        bins, offsets = sum_of_squares(lengths[order], limit)
        frame = frame.iloc[order].reset_index(drop=True)
        frame["bin"] = bins
        frame["offset"] = offsets
        return frame

    return pack


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    vocabulary: str = VOCABULARY,
    end_id: int = 0,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and then ``end_id``; null and empty texts are the end id alone. Only
    documents longer than ``limit`` are cut. Pieces are spread over tasks, equal ones too; each packs its
    own longest first, and the bins that stay open are packed again, together, in far fewer tasks.
    Repeated rows are packed separately, a null doc_id is kept, an empty table gives no rows, other
    columns are not looked at.
    """
    cut = pieces(texts(docs, id_col, text_col), limit, vocabulary, end_id)
    # The number is settled once the table is written; it spreads rows that are equal in all else.
    cut = written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    first = _packed(cut, names, limit, pieces_per_task, ["row"])
    first = written(first.withColumnRenamed("offset", "inner"), "packed")

    # Bins of the first round, each as one item of its filled length, are packed once more.
    filled = first.groupBy("task", "bin").agg(F.sum("length").alias("length"))
    again = filled.where(F.col("length") < limit).select("task", "bin", "length")
    again = again.withColumnsRenamed({"task": "old_task", "bin": "old_bin"})
    moved = _packed(again, ["old_task", "old_bin", "length"], limit, 4 * pieces_per_task)
    moved = moved.withColumnsRenamed({"task": "new_task", "bin": "new_bin", "offset": "outer"})
    same = (F.col("task") == F.col("old_task")) & (F.col("bin") == F.col("old_bin"))
    whole = F.col("new_bin").isNull()
    number = F.when(whole, (F.col("task") * (1 << 32) + F.col("bin")) * 2).otherwise(
        (F.col("new_task") * (1 << 32) + F.col("new_bin")) * 2 + 1
    )
    return first.join(moved.drop("length"), same, "left").select(
        *names, number.alias("sequence_id"), (F.col("inner") + F.coalesce("outer", F.lit(0))).alias("offset")
    )


def _packed(items: DataFrame, keys: list[str], limit: int, per_task: int, spread: list[str] = []) -> DataFrame:
    """The items with task, bin (within the task) and offset; dealt to tasks by keys and ``spread``."""
    tasks = -(-items.count() // per_task) or 1
    schema = T.StructType(
        [T.StructField("task", T.LongType()), *items.select(*keys).schema.fields]
        + [T.StructField("bin", T.LongType()), T.StructField("offset", T.LongType())]
    )
    dealt = items.withColumn("task", bucket(tasks, *keys, *spread)).select("task", *keys)
    return dealt.groupBy("task").applyInPandas(_packer(limit, keys), schema)


