import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationlake.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc, text, rate=50, spm=80):
    """The contract in plain string operations."""
    text = text or ""
    digits = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < spm:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(table, rows, **options):
    found = infill.restored(infill.fill_in_middle(table, **options)).collect()
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.text) for r in found]
    want = [(*expected(i, t, **options), t or "") for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    return found


def test_given_documents(documents):
    table, rows = documents
    assert {r.form for r in check(table, rows)} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("options", [{"rate": 100, "spm": 0}, {"rate": 100, "spm": 100}, {"rate": 0}])
def test_odd_rows(odd, options):
    table, rows = odd
    check(table, rows, **options)


def test_texts_with_sentinels_or_parts_of_them(frame):
    texts = ["a <P> b c", "x<S>", "<M>", "a < P> <P <S b> M> <", "<<P", ">", "a<\nS>b", "\n \t", " lead and trail \n", "a"]
    rows = [(100 * k + i, t) for k, t in enumerate(texts) for i in range(8)]
    forms = {(r.text, r.form) for r in check(frame(rows), rows, rate=100, spm=50)}
    assert all(form == "plain" for text, form in forms if text in texts[:3])
    assert all(("a < P> <P <S b> M> <", form) in forms for form in ("psm", "spm"))


def test_empty_table_and_bad_parameters(frame):
    table = infill.fill_in_middle(frame([]))
    assert table.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert infill.restored(table).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(frame([]), rate=101)


def test_other_columns_travel_with_the_restored_text(spark):
    rows = [(1, "psm", "<P>a<S> c<M> b", "kept"), (2, None, "x", "y"), (3, "plain", None, "z")]
    table = spark.createDataFrame(rows, "`id.x` int, form string, output string, text string")
    found = infill.restored(table)
    assert found.columns == ["id.x", "form", "output", "text"]
    assert [tuple(r) for r in found.orderBy("`id.x`").collect()] == [
        (1, "psm", "<P>a<S> c<M> b", "a b c"),
        (2, None, "x", None),
        (3, "plain", None, None),
    ]


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60).filter(lambda t: not infill._SENTINEL.search(t)), st.data(), st.sampled_from(["psm", "spm"]))
def test_rotations_restore_exactly(text, data, form):
    a, b = sorted(data.draw(st.tuples(*[st.integers(0, len(text))] * 2)))
    output = bytes(infill.arrange(text, a, b, form))
    p, m, s = b"<P>" + text[:a], b"<M>" + text[a:b], b"<S>" + text[b:]
    assert output == (p + s + m if form == "psm" else s + p + m)
    assert infill.restore(output, form) == text


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400), st.data())
def test_reversal_in_small_steps(text, data):
    lo, cut, hi = sorted(data.draw(st.tuples(*[st.integers(0, len(text))] * 3)))
    kept, infill._REVERSED_AT_ONCE = infill._REVERSED_AT_ONCE, 3
    try:
        buffer = bytearray(text)
        infill.rotate(buffer, lo, cut, hi)
    finally:
        infill._REVERSED_AT_ONCE = kept
    assert bytes(buffer) == text[:lo] + text[cut:hi] + text[lo:cut] + text[hi:]
