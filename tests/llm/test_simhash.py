import numpy as np

from loanmart.llm import simhash
from loanmart.llm.queries import QUERIES
from loanmart.llm.shared import ready
from tests.llm.brute import fingerprint, smallest_reachable

ODD = [None, "", " \t\n ", "one", "One", "a b c", "a b c d", "a b c d", "a b c d e " * 3, "Ünïcode wörds ÉÀ x", "z " * 70000]


def expected(ids, texts):
    prints = [fingerprint(t) for t in texts]
    roots = smallest_reachable(ids, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    return sorted((i, f"{p:016x}", r) for i, p, r in zip(ids, prints, roots))


def test_query_equals_brute_force(spark, small):
    got = QUERIES["op8_simhash_near_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == expected([r["doc_id"] for r in small], [r["text"] for r in small])


def test_odd_texts(spark, table):
    got = QUERIES["op8_simhash_near_dedup"](spark, table(ODD)).collect()
    assert sorted(map(tuple, got)) == expected(range(len(ODD)), ODD)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, id string, fingerprint string, component_id int, node int, root int"
    ready(spark)
    assert simhash.groups(spark.createDataFrame([], schema), "doc_id", "text", 4, 4).count() == 0
    rows = [(5, "a b c d e", "x", "y", 1, 2, 3), (5, "a b c d e", "x", "y", 1, 2, 3), (None, "q", "x", "y", 1, 2, 3)]
    got = simhash.groups(spark.createDataFrame(rows, schema), "doc_id", "text", 4, 4).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(5, 5), (5, 5)] and len(got) == 3


def test_crowded_variants_are_dealt_in_parts_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MEMBERS", 8)
    ready(spark)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    values = set()
    for _ in range(240):
        flips = rng.choice(64, rng.integers(0, 6), replace=False)
        values.add(int(base[rng.integers(0, 3)]) ^ sum(1 << int(b) for b in flips))
    values = sorted(values)
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fingerprint long")
    roots = simhash.components(simhash.links(frame, 4)).collect()
    want = smallest_reachable(values, lambda i, j: (values[i] ^ values[j]).bit_count() <= 4)
    groups = {}
    for v, r in roots:
        groups.setdefault(r, set()).add(v % 2**64)
    expect = {}
    for v, r in zip(values, want):
        expect.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expect.values() if len(g) > 1)


def test_majority_over_more_hashes_than_a_counter_holds():
    hashes = np.random.default_rng(2).integers(0, 2**64, 200_000, dtype=np.uint64)
    bits = [2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes) for b in range(64)]
    assert int(simhash.majority(hashes, np.array([len(hashes)]))[0]) == sum(1 << b for b in range(64) if bits[b])
