"""Fill-in-middle transformation by rotating blocks of one buffer in place.

A text lies in a bytearray with a sentinel in front of each of its three segments. Two neighbouring
blocks change places by three reversals: each block is reversed, then both together. The same
rotation, with the lengths exchanged, puts them back, so that a text is restored exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.llm.common import slices, text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_SENTINEL = re.compile(b"<[PSM]>")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: Bytes that a reversal holds besides the buffer.
_REVERSED_AT_ONCE = 1 << 16


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on the seed and the id; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def token_ends(data: np.ndarray) -> np.ndarray:
    """Where each token of a text ends: white space and the word after it; white space at the end is one too."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    space = _SPACE[data]
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(ends, len(data)) if space[-1] else ends


def _reverse(view: np.ndarray, lo: int, hi: int) -> None:
    """The bytes from ``lo`` up to ``hi`` in reverse; pairs of stretches change places from outside in."""
    while hi - lo > 1:
        k = min(_REVERSED_AT_ONCE, (hi - lo) // 2)
        left = view[lo : lo + k].copy()
        view[lo : lo + k] = view[hi - k : hi][::-1]
        view[hi - k : hi] = left[::-1]
        lo, hi = lo + k, hi - k


def rotate(buffer: bytearray, lo: int, cut: int, hi: int) -> None:
    """Exchange the blocks ``lo``..``cut`` and ``cut``..``hi`` within the buffer."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    _reverse(view, lo, cut)
    _reverse(view, cut, hi)
    _reverse(view, lo, hi)


def arrange(text: bytes, prefix: int, middle: int, form: str) -> bytearray:
    """The text in a form; prefix and middle end after so many bytes."""
    buffer = bytearray(text)
    if form == PLAIN:
        return buffer
    for place, sentinel in ((middle, SUFFIX), (prefix, MIDDLE), (0, PREFIX)):
        buffer[place:place] = sentinel
    first, second = prefix + len(PREFIX), middle + len(PREFIX) + len(MIDDLE)
    rotate(buffer, first if form == PSM else 0, second, len(buffer))
    return buffer


def restore(output: bytes, form: str) -> bytes:
    """The text that was arranged, from the output and its form alone."""
    buffer = bytearray(output)
    if form == PLAIN:
        return output
    prefix, middle, suffix = (buffer.find(x) for x in (PREFIX, MIDDLE, SUFFIX))
    end, cut = len(buffer), middle if form == PSM else prefix
    rotate(buffer, suffix, cut, end)
    # Prefix, middle and suffix now follow one another; the sentinels go from the last to the first.
    for place in (end - (cut - suffix), suffix if form == PSM else middle - prefix, 0):
        del buffer[place : place + len(PREFIX)]
    return bytes(buffer)


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform_one(doc_id: int | None, text: bytes, seed: int, rate: int, spm: int) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    ends = token_ends(data)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= rate or _SENTINEL.search(text):
        return n, PLAIN, None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle = (int(ends[k - 1]) if k else 0 for k in (first, second))
    form = SPM if h4 % 100 < spm else PSM
    output = bytes(arrange(text, prefix, middle, form))
    return n, form, _characters(data[:prefix]), _characters(data[prefix:middle]), output


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm: int = 80,
) -> DataFrame:
    """One row per input row: doc_id, n, form, prefix_chars, middle_chars, output.

    ``rate`` per cent of the documents are transformed, ``spm`` per cent of those with the suffix
    first; both are decided by the id. A text is cut at token ends, so neither words nor characters
    are split; ``output`` is a string. A null text counts as empty; an empty text, and one that holds
    a sentinel, stay plain. A null id is kept and draws like any other. Repeated rows give equal rows,
    an empty table gives none, other columns are not looked at. One map over the texts, no shuffle.
    """
    if not (0 <= rate <= 100 and 0 <= spm <= 100):
        raise ValueError("rate and spm are per cent")
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            made = zip(*(transform_one(i, t, seed, rate, spm) for i, t in zip(ids, texts)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(column, kind) for column, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    fields = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return body.mapInArrow(work, fields).withColumn("output", F.col("output").cast("string"))


def restored(transformed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` and ``text``, rebuilt from ``output`` and ``form`` alone.

    Other columns stay; a column ``text`` is replaced. A null output or form gives a null text.
    """
    rest = [n for n in transformed.columns if n not in ("text", "form", "output")]
    plain = transformed.select(
        *(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(rest)), "form", F.col("output").cast("binary")
    )
    schema = T.StructType([*plain.schema.fields, T.StructField("text", T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            forms, outputs = (batch.column(k).to_pylist() for k in (batch.num_columns - 2, batch.num_columns - 1))
            texts = [None if f is None or o is None else restore(o, f) for f, o in zip(forms, outputs)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], schema.names)

    found = plain.mapInArrow(work, schema)
    strings = (F.col(n).cast("string").alias(n) for n in ("output", "text"))
    return found.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(rest)), "form", *strings)
