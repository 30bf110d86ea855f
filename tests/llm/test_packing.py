import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from stationlake.llm import packing
from stationlake.llm.packing import _packed, VOCABULARY, pack_documents, sum_of_squares, token_ids


def ids_of(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(df, rows, limit=2048):
    found = df.collect()
    want = []
    for doc, text in rows:
        ids = ids_of(text)
        for piece, at in enumerate(range(0, len(ids), limit)):
            part = ids[at : at + limit]
            want.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((tuple(r[:5]) for r in found), key=str) == sorted(want, key=str)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), -(-sum(w[3] for w in want) // limit)


def test_given_documents(documents):
    table, rows = documents
    used, least = check(pack_documents(table), rows)
    assert used <= least + 2


def test_many_tasks_end_in_few_sequences(documents):
    table, rows = documents
    used, least = check(pack_documents(table, pieces_per_task=20), rows)
    assert used <= 1.05 * least + 2


def test_odd_rows_and_empty_table(odd, frame):
    table, rows = odd
    check(pack_documents(table, limit=64), rows, 64)
    assert pack_documents(frame([])).count() == 0


def test_ids_are_the_tokenizers():
    texts = [
        "Don't  STOP now \x1cx <|endoftext|> it's 12,5% été ΣΣ İz 한국 ok!!",
        "\x0b\x0cTab\tnew\nline\r\n ~~a~~ (b).c,d 'tis we'll",
        "",
        "Straße, Über... ЖЖ. 你好， x$$$ y*** z&&&",
    ]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for text, ids in zip(texts, token_ids(texts, VOCABULARY)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_by_the_plain_rule():
    random = np.random.default_rng(1)
    limit = 20
    sizes = random.integers(1, limit + 1, 300)
    bins, offsets = sum_of_squares(sizes, limit)
    gaps = []
    for size, b, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def squares(after):
            return sum(after.count(g) ** 2 for g in range(1, limit))

        options = {}
        for k, g in enumerate(gaps):
            if size <= g:
                options.setdefault(g, squares(gaps[:k] + [g - size] + gaps[k + 1 :]))
        if options:
            best = min(options, key=lambda g: (options[g], g))
            assert gaps[b] == best and offset == limit - best
            gaps[b] -= size
        else:
            assert b == len(gaps) and offset == 0
            gaps.append(limit - size)


def test_equal_rows_are_spread_over_tasks(spark, monkeypatch):
    made = []

    def noted(*args):
        made.append(_packed(*args))
        return made[-1]

    monkeypatch.setattr(packing, "_packed", noted)
    docs = spark.range(20_000).selectExpr("null as doc_id", "if(id % 2 = 0, '', null) as text")
    assert pack_documents(docs, pieces_per_task=1_000).count() == 20_000
    assert made[0].count() == 20_000
    assert max(r["count"] for r in made[0].groupBy("task").count().collect()) <= 2_000
