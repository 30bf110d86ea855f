import heapq
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stationlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WEIGHTS = (5, 2, 1)
SCHEMA = "doc_id long, text string, source string"


def size(text):
    return len(WORD.findall(text or ""))


def expected_targets(rows):
    """Shares by weight, capped at three times the source, shared again until none is above."""
    words = Counter()
    for _, text, source in rows:
        words[source] += size(text)
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(words.values())
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > 3 * words[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 3.0 * words[s] for s in over})
        rest -= sum(3 * words[s] for s in over)
        open_ -= over
    return words, target


def check(table, rows, **options):
    mixed = mixing.mix_documents(table, **options)
    found = mixed.collect()
    words, target = expected_targets(rows)
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1]), x[2])
    assert sorted(((r.doc_id, r.source, r.size) for r in found), key=key) == sorted(
        ((i, s, size(t)) for i, t, s in rows), key=key
    )
    taken, block = Counter(), {}
    for r in found:
        assert r.source_size == words[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        taken[r.source] += r.taken
        block[r.source] = r.block
    for source in words:
        assert abs(taken[source] - target[source]) < 4 * block[source]
    return mixed, found


@pytest.fixture(scope="module")
def given_rows(documents):
    table, _ = documents
    return [(r.doc_id, r.text, r.source) for r in table.select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("options", [{}, {"shard_blocks": 3, "block_words": 7, "seed": 5}, {"least_blocks": 1, "shard_blocks": 1}])
def test_given_documents(documents, given_rows, options):
    check(documents[0], given_rows, **options)


def test_reruns_agree_however_the_input_is_split(spark, documents, given_rows):
    first = sorted(map(tuple, mixing.mix_documents(documents[0]).collect()))
    again = spark.createDataFrame(list(reversed(given_rows)), SCHEMA).repartition(7)
    assert sorted(map(tuple, mixing.mix_documents(again).collect())) == first
    other = sorted(map(tuple, mixing.mix_documents(documents[0], seed=1).collect()))
    assert other != first


def test_seats_are_those_of_the_highest_quotients(spark, documents):
    groups = mixing.sizes(documents[0], "doc_id", "text", "source")
    table = mixing.source_table(groups, least_blocks=50)
    sources = table.collect()
    votes = {r.rank: r.target / r.block for r in sources}
    seats = {r.rank: 0 for r in sources}
    heap = [(-v, rank) for rank, v in votes.items()]
    heapq.heapify(heap)
    for _ in range(sum(r.seats for r in sources)):
        _, rank = heapq.heappop(heap)
        seats[rank] += 1
        heapq.heappush(heap, (-votes[rank] / (2 * seats[rank] + 1), rank))
    assert {r.rank: r.seats for r in sources} == seats
    shards = mixing.quotas(table, shard_blocks=4).collect()
    won, blocks = Counter(), Counter()
    for r in shards:
        won[r.source] += r.quota
        blocks[r.source] += r.blocks
        assert 0 <= r.quota <= 3 * r.blocks
    assert all(won[r.source] == r.seats and blocks[r.source] == -(-r.words // r.block) for r in sources)


def test_spans_are_what_was_taken_and_blocks_are_whole(documents):
    options = {"block_words": 9, "shard_blocks": 5, "seed": 3}
    mixed = mixing.mix_documents(documents[0], **options)
    rows = {(r.doc_id, r.source): r for r in mixed.collect()}
    spans = mixing.taken_spans(mixed, shard_blocks=5, seed=3).collect()
    taken, times = Counter(), defaultdict(set)
    for s in spans:
        row = rows[s.doc_id, s.source]
        assert 0 <= s.start < s.stop <= row.size and 1 <= s.times <= 3
        taken[s.doc_id, s.source] += (s.stop - s.start) * s.times
        times[s.source, (row.first_word + s.start) // row.block].add(s.times)
    assert all(taken[k] == r.taken for k, r in rows.items())
    assert all(len(t) == 1 for t in times.values())  # a block that two documents share counts the same in both
    per_shard = Counter()
    for (source, block), t in times.items():
        per_shard[source, block // 5] += t.pop()
    groups = mixing.sizes(documents[0], "doc_id", "text", "source")
    want = mixing.quotas(mixing.source_table(groups, block_words=9), shard_blocks=5).collect()
    assert per_shard == Counter({(r.source, r.shard): r.quota for r in want if r.quota})


def test_odd_rows(spark):
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, "one two three", None),
        (3, "one two three", None),
        (3, "four five six", None),
        (None, "x y", "b"),
        (None, "x y z", "b"),
        (None, "x y z", "b"),
        (4, "word " * 30_000, "\U0001f600"),
        (5, " \n\t", "￿"),
        (6, "ünï çødé 你好", ""),
    ]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as size", "2 as rank", "'q' as key", "3 as copies")
    check(table, rows)
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], SCHEMA)
    assert {(r.target, r.taken, r.source_size) for r in mixing.mix_documents(empty).collect()} == {(0.0, 0, 0)}
    with pytest.raises(ValueError):
        mixing.mix_documents(empty, weights=())


def test_a_third_of_the_rows_in_one_source_or_under_one_id(spark):
    rows = [(None if k % 3 == 0 else k, "same words here" if k % 2 else f"w{k} " * (k % 40), f"s{k % 17}" if k % 3 else "hot") for k in range(3000)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_many_sources_are_ranked_without_one_task(spark):
    rows = [(k, "w " * (1 + k % 5), f"source {k % 900}") for k in range(2700)]
    table = spark.createDataFrame(rows, SCHEMA)
    ranks = mixing.ranked(table.select("source").distinct(), "source", "rank")
    got = {r.source: r["rank"] for r in ranks.collect()}
    assert got == {s: k for k, s in enumerate(sorted({r[2] for r in rows}))}
    check(table, rows)


def test_the_best_share_is_a_systematic_one(spark):
    """Within a shard no block is taken more than once oftener than another."""
    rows = [(k, "w " * 10, "a" if k < 900 else "b") for k in range(1000)]
    mixed = mixing.mix_documents(spark.createDataFrame(rows, SCHEMA), block_words=10, least_blocks=1, shard_blocks=10)
    spread = mixed.groupBy("source").agg(F.max("taken").alias("most"), F.sum("taken").alias("all"), F.count("*").alias("n"))
    for r in spread.collect():
        assert r.most <= 10 * math.ceil(r.all / (10 * r.n) + 0.1)
