"""Decontamination against brute force over all windows."""

import random
from collections import Counter

import duckdb
import pyarrow as pa

from funnelloom.llm import decontaminate as D
from funnelloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def norm(text):
    return [w for w in (x.strip(D.MARKS) for x in (text or "").lower().split()) if w]


def bag(words):
    s = min(5, len(words))
    return Counter(tuple(words[i : i + s]) for i in range(len(words) - s + 1))


def brute(docs, items):
    """Every window of every text against every item that shares a word run with it."""
    items = [(i, norm(t)) for i, t in items if norm(t)]
    found = {}
    for d, text in docs:
        words = norm(text)
        runs = {n: {tuple(words[i : i + n]) for i in range(len(words))} for n in range(1, 6)}
        for i, item in items:
            own = bag(item)
            if not any(k in runs[len(k)] for k in own):
                continue
            for at in range(len(words) - len(item) + 1):
                other = bag(words[at : at + len(item)])
                shared = (own & other).total()
                value = shared / (own.total() + other.total() - shared)
                if value >= 0.8:
                    found[d, i] = max(value, found.get((d, i), 0))
    return found


def test_query(spark):
    docs = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    found = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op2_decontamination"](spark, FOLDER).collect()}
    want = brute(docs, items)
    assert want and found == want


def test_changed_passages_and_odd_rows(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(rng.randint(30, 60)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "Only three words!"), (53, items[0][1])]
    docs = []
    for i in range(60):
        passage = items[i % 12][1].split()
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            passage[rng.randrange(len(passage))] = word()
        around = [[word() for _ in range(rng.randint(0, 80))] for _ in range(2)]
        docs.append((i, " ".join(around[0]) + ' "' + " ".join(passage).upper() + '" ' + " ".join(around[1])))
    docs += [(100, None), (101, ""), (102, "we saw only, three words here"), (103, "z " * 20000), (None, items[3][1])]
    frame = spark.createDataFrame([(d, t, 1.0) for d, t in docs], "doc_id long, text string, similarity double").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert 20 < len(want) < 90
    for size in (16 << 20, 1500):  # one pass and several
        monkeypatch.setattr(D, "ITEM_BYTES", size)
        found = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(frame, bench).collect()}
        assert found == want
        kept = D.clean(frame, bench)
        assert kept.columns == frame.columns
        assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert D.contaminated(frame.limit(0), bench).count() == 0
    assert D.contaminated(frame, bench.limit(0)).count() == 0
    assert D.clean(frame, bench.limit(0)).count() == len(docs)


def test_blocks_find_all_within_the_radius():
    items = D.Items([1, 2], ["a b c d e f g h", "i j k l m n o p q"])
    rng = random.Random(1)
    import numpy as np

    for _ in range(500):
        flipped = int(items.prints[0])
        for b in rng.sample(range(64), D.RADIUS):
            flipped ^= 1 << b
        assert 0 in items.candidates(np.array([flipped], np.uint64), len(items.words[0]))[1]
    assert list(items.search(pa.array([], pa.large_string()))) == []


def test_fingerprints_of_similar_windows_lie_within_the_radius():
    """The radius is a choice: of 3,000 changed passages that are still alike, all are found."""
    rng = random.Random(11)
    items, windows = [], []
    while len(items) < 3000:
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(25, 70))]
        other = list(words)
        for _ in range(rng.randint(1, 2)):
            other[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        if D.similarity(bag(words), bag(other)) >= D.SIMILARITY:
            items.append(" ".join(words))
            windows.append(" ".join(other))
    index = D.Items(list(range(len(items))), items)
    found = {t for t, ms in index.search(pa.array(windows, pa.large_string())) for m in ms if m[0] == t}
    assert len(found) >= 0.999 * len(items)


def test_many_items_of_one_length_stay_within_bounds(monkeypatch):
    monkeypatch.setattr(D, "CELLS", 64)
    rng = random.Random(2)
    items = [" ".join(f"w{rng.randrange(500)}" for _ in range(30)) for _ in range(200)]
    index = D.Items(list(range(200)), items)
    text = "x y " + " z ".join(items[:20])
    ((_, found),) = index.search(pa.array([text], pa.large_string()))
    assert {m[0] for m in found} == set(range(20))
