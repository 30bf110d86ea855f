import subprocess
import sys
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import brute_lines, split

from stationlake.llm import setjoin
from stationlake.llm.hashing import words
from stationlake.llm.linededup import dedup_lines, without_repeated_lines
from stationlake.llm.setjoin import sorted_in_groups

def lines_of(df):
    return sorted(((r.doc_id, r.line, r.links, r.removed) for r in df.collect()), key=str)


def near_copies(seed, n):
    random = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["the", "Of", "and"]
    base = [list(random.choice(vocabulary, random.integers(3, 25))) for _ in range(12)]
    rows = []
    for k in range(n):
        lines = []
        for _ in range(random.integers(1, 4)):
            line = list(base[random.integers(len(base))])
            for _ in range(random.integers(0, 4)):
                line[random.integers(len(line))] = random.choice(vocabulary)
            lines.append(" ".join(line))
        rows.append((k, "\n".join(lines)))
    return rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t\x0b\x00 ", max_size=20), max_size=4))
def test_words_and_lines(texts):
    code, text, line = words([t.encode() for t in texts])
    want = [(k, n, w) for k, t in enumerate(texts) for n, row in enumerate(t.split("\n")) for w in split(row) if w]
    assert list(zip(text.tolist(), line.tolist())) == [(k, n) for k, n, _ in want]
    assert len(set(code.tolist())) == len({w for _, _, w in want})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 2**64 - 1)), max_size=40), st.booleans())
def test_sorted_in_groups(rows, close):
    rows.sort(key=lambda r: r[0])
    number = {g: k for k, g in enumerate(dict.fromkeys(r[0] for r in rows))}
    group = np.array([number[r[0]] for r in rows], dtype=np.int64)
    rank = np.array([r[1] for r in rows], dtype=np.int64)
    token = np.array([r[2] % 7 if close else r[2] for r in rows], dtype=np.uint64)
    order = sorted_in_groups(group, rank, token)
    want = sorted(zip(group.tolist(), rank.tolist(), token.tolist()))
    assert list(zip(group[order].tolist(), rank[order].tolist(), token[order].tolist())) == want


def test_lines_against_brute_force(frame):
    rows = near_copies(1, 150)
    assert lines_of(dedup_lines(frame(rows))) == brute_lines(rows)


def test_given_documents(documents):
    table, rows = documents
    assert lines_of(dedup_lines(table)) == brute_lines(rows)


def test_odd_rows(odd, frame):
    table, rows = odd
    assert lines_of(dedup_lines(table)) == brute_lines(rows)
    assert dedup_lines(frame([])).count() == 0


def test_the_greatest_id_is_not_null(frame):
    rows = [(2**63 - 1, "a b c d e\nx y z"), (None, "a b c d e"), (None, "a b c d e"), (5, "x y z")]
    assert lines_of(dedup_lines(frame(rows))) == brute_lines(rows)
    got = sorted((str(r.doc_id), r.text) for r in without_repeated_lines(frame(rows)).collect())
    assert got == [("5", "x y z"), ("9223372036854775807", "a b c d e"), ("None", ""), ("None", "")]


def test_texts_without_repeated_lines(frame):
    rows = [(1, "a b c\nd e f\n\na b c"), (2, None), (3, "x y\nd e f"), (4, "a b c")]
    got = {r.doc_id: r.text for r in without_repeated_lines(frame(rows)).collect()}
    assert got == {1: "a b c\nd e f\n", 2: None, 3: "x y", 4: ""}


def test_a_crowd_of_near_copies(frame):
    base = [f"word{k}" for k in range(30)]
    rows = [(k, " ".join([*base[: k % 30], f"new{k}", *base[k % 30 + 1 :]])) for k in range(200)]
    assert lines_of(dedup_lines(frame(rows))) == brute_lines(rows)


class Alike(setjoin._Rows):
    """Rows whose similarity is a matter of a number each; counts the pairs looked at."""

    def __init__(self, size, mark):
        self.size, self.mark, self.t, self.met, self.most = size, mark, Fraction(4, 5), 0, 0

    def similar(self, a, b):
        assert (a < b).all()
        self.met += len(a)
        self.most = max(self.most, len(a))
        near = (self.mark[a] == self.mark[b]) & (5 * self.size[a] >= 4 * self.size[b])
        return a[near], b[near]


def joined(a, b, n):
    """The smallest row of each row's component."""
    of = list(range(n))
    for x, y in zip(a.tolist(), b.tolist()):
        lo, hi = sorted((of[x], of[y]))
        of = [lo if k == hi else k for k in of]
    return of


def test_rows_of_a_key_meet_only_those_of_a_near_size():
    random = np.random.default_rng(5)
    count = np.array([1, 300, 40, 700])
    start = np.cumsum(count) - count
    size = np.concatenate([np.sort(random.integers(5, 2000, c)) for c in count])
    mark = random.integers(0, 3, len(size))
    rows = Alike(size, mark)
    a, b = setjoin._meeting(start, count, rows)
    one, other = np.triu_indices(len(size), 1)
    group = np.repeat(np.arange(4), count)
    able = (group[one] == group[other]) & (5 * size[one] >= 4 * size[other])
    alike = able & (mark[one] == mark[other])
    assert joined(a, b, len(size)) == joined(one[alike], other[alike], len(size))
    assert rows.met <= able.sum() and rows.most <= setjoin.CROWD**2


def test_workers_give_back_what_they_freed():
    code = r"""
import re
import numpy as np
import pyarrow as pa
from stationlake.llm.common import slices
def own():
    return int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) >> 10
kept = []
first = own()
for _ in range(2_000):  # blocks below the size that is mapped apart, held down by small ones above
    kept.append((np.ones(8_000), np.ones(8)))
kept = [small for _, small in kept]
held = own()
list(slices([pa.RecordBatch.from_arrays([pa.array(["a"])], ["text"])]))
assert held - first > 100 and own() - first < 30, (first, held, own())
"""
    subprocess.run([sys.executable, "-c", code], check=True)
