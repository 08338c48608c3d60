"""Near-duplicate candidates: tables that follow the number of fingerprints, recall against brute force."""

import os

import numpy as np
import pytest

from tests.llm.helpers import documents, prose
from tonnage.llm import simhash
from tonnage.llm.components import components

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("entries", [10**k for k in range(5, 11)])
def test_a_bucket_holds_few_random_fingerprints_at_every_size(entries):
    segments = simhash.near_segments(3, entries, 0.8)
    for positions, radius in segments:
        assert entries / 2 ** len(positions) <= simhash.BUCKET and radius == 1
        assert len(set(positions)) == len(positions) and 0 <= min(positions) and max(positions) < 192
    assert len({p for p, _ in segments}) == len(segments)


def test_tables_find_what_they_promise():
    """Pairs whose bits differ at the rate of two sets with a similarity of 0.8."""
    rng = np.random.default_rng(3)
    segments = simhash.near_segments(3, 10**6, 0.8)
    a = rng.integers(0, 2, (2000, 192), dtype=np.int8)
    apart = rng.random((2000, 192)) < np.arccos(1.6 / 1.8) / np.pi
    met = np.zeros(2000, bool)
    for positions, _ in segments:
        met |= apart[:, positions].sum(1) <= 1
    assert a.shape == apart.shape and met.mean() >= 0.98


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_recall_on_a_corpus_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    by_shingle: dict = {}
    for d, found in sets.items():
        for x in found:
            by_shingle.setdefault(x, []).append(d)
    pairs = {(a, b) for some in by_shingle.values() for a in some for b in some if a < b}
    close = [(a, b) for a, b in pairs if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    label = {d: d for d in sets}
    for _ in range(50):
        for a, b in close:
            label[a] = label[b] = min(label[a], label[b])
    empty = [d for d, x in sets.items() if not x]
    expected = {d for d in sets if label[d] == d and (d not in empty or d == min(empty))}
    kept = {r.doc_id for r in simhash.one_of_each(docs).select("doc_id").collect()}
    gone, wanted = set(sets) - kept, set(sets) - expected
    assert len(wanted) > 50 and not gone - wanted and len(gone & wanted) >= 0.95 * len(wanted)


@pytest.mark.parametrize("block", [4, 512])
def test_a_large_group_of_near_copies_is_one_group(spark, block):
    """A third of the rows are near copies of one text: dealt in blocks, none lost."""
    base = prose(11, 400).split()
    rng = np.random.default_rng(1)
    copies = []
    for k in range(60):
        words = list(base)
        words[int(rng.integers(len(words)))] = f"new{k}"
        copies.append(" ".join(words))
    others = [prose(1000 + k, 60) for k in range(120)]
    data = [(k, t, "en", "s", len(t)) for k, t in enumerate([*others, *copies])]
    kept = sorted(r.doc_id for r in simhash.one_of_each(documents(spark, data), block=block).collect())
    assert kept == [*range(120), 120]


@pytest.mark.parametrize("block", [2, 1024])
def test_rounds_of_tables_miss_no_link(spark, block):
    """More tables than a round takes: fingerprints one bit apart are linked whatever the round."""
    rng = np.random.default_rng(9)
    values = {bytes(v) for v in rng.integers(0, 256, (20, 24), dtype=np.uint8)}
    for v in list(values):
        for bit in rng.choice(192, 5, replace=False).tolist():
            w = bytearray(v)
            w[bit // 8] ^= 1 << bit % 8
            values.add(bytes(w))
    segments = [(tuple(range(k, k + 10)), 1) for k in range(0, 180, 10)]
    edges = simhash.linked(spark.createDataFrame([(v,) for v in values], "fp binary"), segments, 3, 2, block=block)
    roots = {bytes(r.node): bytes(r.root) for r in components(edges).collect()}
    assert len(set(roots.values())) == 20 and len(roots) == len(values)


def test_a_dense_group_is_thinned_before_the_steps(spark, monkeypatch):
    """All pairs of 60 nodes in many small shares: no share leaves more edges than nodes, and the components stay."""
    from tonnage.llm import components as module

    pairs = [(a, b) for a in range(60) for b in range(a)] + [(1000 + k, 1001 + k) for k in range(0, 30, 2)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    monkeypatch.setattr(module, "_SHARE", 300)
    got = {r.node: r.root for r in module.components(edges).collect()}
    assert got == {k: 0 for k in range(60)} | {1000 + k: 1000 + k - k % 2 for k in range(30)}
    label = module.least_labels(np.array([5, 3, 7]), np.array([4, 5, 8]), 9)
    assert label.tolist() == [0, 1, 2, 3, 3, 3, 6, 7, 7]
