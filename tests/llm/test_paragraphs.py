import numpy as np
import pytest
from llm_helpers import brute_runs

from stationlake.llm import paragraphs
from stationlake.llm.paragraphs import bands_for, beginnings, dedup_passages, passage_report


def runs_of(df):
    found = df.collect()
    return sorted(
        ((r.doc_id, r.first_word, None if r.lowest["tie"] >= 1 << 60 else r.lowest["ord"], r.lowest["unit"], r.removed) for r in found),
        key=str,
    )


def prose(random, n, vocabulary=4000):
    return [f"w{k}" for k in random.integers(0, vocabulary, n)]


def test_bands_follow_the_threshold():
    for threshold in (0.3, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0):
        bands, rows = bands_for(threshold)
        assert bands * rows <= paragraphs.VALUES and 1 - (1 - threshold**rows) ** bands >= paragraphs.RECALL
    assert bands_for(0.8) == (6, 3)
    with pytest.raises(ValueError):
        bands_for(0.01)


def test_equal_passages_begin_runs_at_equal_places():
    random = np.random.default_rng(3)
    passage = random.integers(0, 2**63, 50, dtype=np.uint64)
    for before, after in ((0, 0), (0, 40), (3, 1), (70, 0), (200, 300), (1, 19)):
        around = [random.integers(0, 2**63, n, dtype=np.uint64) for n in (before, after)]
        word = np.concatenate([around[0], passage, around[1]])
        found = beginnings(word, np.zeros(len(word), dtype=np.int64), 20, 29) - before
        whole = set(found[(found >= 0) & (found <= 30)].tolist())
        own = set(beginnings(passage, np.zeros(50, dtype=np.int64), 20, 29).tolist())
        assert own and own <= whole


def test_texts_do_not_touch_each_other():
    random = np.random.default_rng(4)
    parts = [random.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 10, 120, 49, 51)]
    text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    together = beginnings(np.concatenate(parts), text, 20, 29)
    at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    apart = [beginnings(p, np.zeros(len(p), dtype=np.int64), 20, 29) + at[k] for k, p in enumerate(parts)]
    assert together.tolist() == np.concatenate(apart).tolist()


def test_passages_inside_lines_and_across_line_ends(frame):
    """Later holders lose words of the passage and nothing else; first holders and other texts lose none."""
    random = np.random.default_rng(5)
    passages = [prose(random, int(n)) for n in random.integers(51, 140, 12)]
    rows, holds = [], {}
    for k in range(120):
        own = [prose(random, int(random.integers(5, 90))) for _ in range(2)]
        body = own[0]
        if k % 2:
            p = passages[k % 12]
            holds[k] = (k % 12, len(body))
            body = body + [w.upper() if random.random() < 0.3 else w for w in p] + own[1]
        glue = [" ", "\n", "  ", "\t", " \n "]
        rows.append((k, "".join(w + glue[random.integers(5)] for w in body)))
    found = {r.doc_id: r for r in passage_report(frame(rows)).collect()}
    first = {}
    for k, (p, at) in holds.items():
        if p not in first:
            first[p] = k
            assert found[k].n_removed == 0
            continue
        earlier = {j for j, (q, _) in holds.items() if q == p and j < k}
        assert found[k].n_removed >= 20 and set(found[k].kept_in_doc_ids) <= earlier
        assert all(at - 5 <= s["first"] and s["last"] < at + len(passages[p]) + 5 for s in found[k].removed_spans)
    assert all(r.n_removed == 0 for k, r in found.items() if k not in holds)


def test_short_lines_that_repeat_are_left_alone(frame):
    random = np.random.default_rng(6)
    rows = [(k, "And.\nAll rights reserved.\n" + " ".join(prose(random, 80)) + "\nThe end of this page.") for k in range(60)]
    assert {r.n_removed for r in passage_report(frame(rows)).collect()} == {0}


def near_copies(seed, n):
    random = np.random.default_rng(seed)
    base = [prose(random, 120, 300) for _ in range(6)]
    rows = []
    for k in range(n):
        words = list(base[random.integers(6)])
        for _ in range(random.integers(0, 3)):
            words[random.integers(len(words))] = f"x{random.integers(50)}"
        rows.append((k, " ".join(words)))
    return rows


def test_against_brute_force(frame):
    rows = near_copies(2, 90) + [(1000, " ".join(near_copies(9, 1)[0][1].split() * 3))]
    assert runs_of(dedup_passages(frame(rows), threshold=0.8)) == brute_runs(rows)


def test_given_documents(documents):
    table, rows = documents
    assert runs_of(dedup_passages(table)) == brute_runs(rows)


def test_odd_rows(odd, frame):
    table, rows = odd
    long = " ".join(f"v{k}" for k in range(300))
    rows = [*rows, (None, long), (None, long), (None, long + " end"), (2**63 - 1, long)]
    report = passage_report(frame(rows)).collect()
    assert sorted(str(r.doc_id) for r in report) == sorted(str(i) for i, _ in rows)
    # The greatest id comes before null ones; of those, each row is reported. Row 7 repeats itself.
    assert [r.n_removed for r in report if r.doc_id == 2**63 - 1] == [0]
    gone = [r for r in report if r.n_removed]
    assert sorted(str(r.doc_id) for r in gone) == ["7", "None", "None", "None"]
    assert all(r.kept_in_doc_ids == [2**63 - 1] for r in gone if r.doc_id is None)
    assert passage_report(frame([])).count() == 0 and dedup_passages(frame([])).count() == 0
    with pytest.raises(ValueError):
        dedup_passages(frame([]), run=60)


def test_no_window_is_passed_over_in_texts_of_few_words():
    """Rhythms of one or two words have no place that is less than those around it."""
    random = np.random.default_rng(14)
    at = np.zeros(400, dtype=np.int64)
    for size in (1, 2, 2, 3, 4):
        alphabet = random.integers(0, 2**63, size, dtype=np.uint64)
        for passage in (np.resize(alphabet, 50), random.choice(alphabet, 50)):
            own = set(beginnings(passage, at[:50], 20, 29, every_window=True).tolist())
            assert own
            for before, after in ((0, 0), (1, 30), (70, 0), (90, 111)):
                word = np.concatenate([random.choice(alphabet, before), passage, random.choice(alphabet, after)])
                assert own <= set((beginnings(word, at[: len(word)], 20, 29, every_window=True) - before).tolist())
    random_words = random.integers(0, 2**63, 400, dtype=np.uint64)
    assert beginnings(random_words, at, 20, 29, every_window=True).tolist() == beginnings(random_words, at, 20, 29).tolist()


def test_repeated_rhythms_are_removed_with_every_window(frame):
    random = np.random.default_rng(15)
    rows = [(k, " ".join(prose(random, 60) + ["yes", "no"] * 30 + prose(random, 60))) for k in range(3)]
    rows += [(5, "word " * 500), (6, "word " * 47), (7, " ".join(prose(random, 200)))]
    report = {r.doc_id: r for r in passage_report(frame(rows), every_window=True).collect()}
    assert report[1].kept_in_doc_ids == report[2].kept_in_doc_ids == [0]
    assert min(report[1].n_removed, report[2].n_removed) >= 40
    assert report[5].n_removed >= 450 and report[6].n_removed == report[7].n_removed == 0
