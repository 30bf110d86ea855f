import pytest
from llm_helpers import brute_lines, brute_runs

from stationlake import llm

COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_suffix_array": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op12_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op13_infill": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def test_registered_names():
    names = list(llm.all_queries())
    assert [n for n in names if not n.startswith("op")] == ["pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert llm.all_sql().keys() == {"op12_mixing", "op13_infill"}


@pytest.mark.parametrize("name", ["op2_neighbours", "op6_sharding", "op10_packing", "op5_langid", "op11_whitening", "op12_mixing", "op13_infill"])
def test_columns_of_the_contract(spark, sf_dir, name):
    found = llm.all_queries()[name](spark, sf_dir)
    assert found.columns == COLUMNS[name] and found.count() > 0


def test_one_row_a_document(spark, sf_dir, documents):
    _, rows = documents
    lines, units = {}, {}
    for doc, line, links, removed in brute_lines(rows):
        lines.setdefault(doc, []).append((line, links, removed))
    for doc, place, kept_in, _, removed in brute_runs(rows, every_window=True):
        units.setdefault(doc, []).append((place, kept_in, removed))
    by_line = {r.doc_id: r for r in llm.all_queries()["op7_line_dedup"](spark, sf_dir).collect()}
    by_run = {r.doc_id: r for r in llm.all_queries()["op8_substring_dedup"](spark, sf_dir).collect()}
    assert set(by_line) == set(by_run) == {doc for doc, _ in rows}
    for doc, r in by_line.items():
        own = lines.get(doc, [])
        assert (r.n_lines, r.n_links) == (len(own), sum(x[1] for x in own))
        assert r.removed_lines == sorted(x[0] for x in own if x[2]) and r.n_removed == len(r.removed_lines)
    for doc, r in by_run.items():
        own = units.get(doc, [])
        gone = sorted({w for p, _, removed in own if removed for w in range(p, p + 20)})
        assert r.n_units == len(own) and r.n_removed == len(gone)
        assert [w for s in r.removed_spans for w in range(s["first"], s["last"] + 1)] == gone
        assert r.kept_in_doc_ids == sorted({x[1] for x in own if x[2]})
