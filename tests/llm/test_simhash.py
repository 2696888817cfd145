"""SimHash groups against brute force."""

import re
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash

from funnelloom.llm import simhash
from funnelloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [words[i : i + size] for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    parent = {f: f for f in prints.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    first = {}
    for d in sorted(prints):
        first.setdefault(root(prints[d]), d)
    return {d: first[root(f)] for d, f in prints.items()}


def test_query(spark):
    docs = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    prints = {d: plain_fingerprint(t) for d, t in docs}
    want = plain_components(prints, 4)
    found = QUERIES["op3_simhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        d: (f"{f:016x}", want[d]) for d, f in prints.items()
    }


def test_masks_meet_every_pair():
    rng = np.random.default_rng(0)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_of_crowded_buckets(spark, bucket):
    """Chains and clusters, once linked inside tasks and once over visited points."""
    rng = np.random.default_rng(3)
    fps = {int(x) for x in rng.integers(0, 1 << 62, 12, dtype=np.int64)}
    for centre in list(fps)[:2]:
        for _ in range(8):
            one = centre
            for b in rng.choice(62, 5, replace=False):
                one ^= 1 << int(b)
            fps.add(one)
        chain = centre
        for k in range(5):
            chain ^= 0b1111 << 5 * k
            fps.add(chain)
    want = plain_components({f: f for f in fps}, 4)
    distinct = simhash.stored(spark.createDataFrame([(f,) for f in fps], "fp long"), "test")
    found = {r.node: r.label for r in simhash.labels(simhash.links(distinct, 4, bucket)).collect()}
    assert {f: found.get(f, f) for f in fps} == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "  "), (3, "One two"), (4, "one TWO"), (4, "one two"), (5, "x " * 30000), (6, "É")]
    docs = spark.createDataFrame([(d, t, "c", 0) for d, t in rows], "doc_id long, text string, fp string, label int")
    found = {(r.doc_id, r.component_id, r.fp == 0) for r in simhash.components(docs).collect()}
    zero = {(1, 1, True), (2, 1, True), (None, 1, True)}
    assert zero <= found and {(3, 3, False), (4, 3, False), (5, 5, False), (6, 6, False)} <= found
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 5, 6]
    assert simhash.deduplicated(docs.limit(0)).count() == 0
