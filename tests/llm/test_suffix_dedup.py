"""Passage removal against brute force over all windows."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from funnelloom.llm import suffix_dedup as S
from funnelloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(docs):
    seen, out = set(), {}
    for d, text in sorted(docs):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            window = b[i : i + 100]
            if window in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(window)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for p, g in zip(b"\0" + gone, gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def as_dict(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_query(spark):
    docs = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    assert as_dict(QUERIES["op7_suffix_dedup"](spark, FOLDER)) == brute(docs)


@pytest.mark.parametrize("collection", [2000, 2])
def test_planted_repeats(spark, collection):
    rng = random.Random(5)
    text = lambda n, letters="abcdefgh ": "".join(rng.choice(letters) for _ in range(n))
    passage = text(400)
    docs = [(i, text(rng.randint(0, 300)) + passage[rng.randint(0, 200) :][: rng.randint(90, 260)] + text(rng.randint(0, 300))) for i in range(60)]
    docs += [(i + 60, docs[i][1]) for i in range(5)]
    docs += [(70, "ab" * 300), (71, "a" * 1000), (72, "é" * 170), (73, "\x00" * 150), (74, None), (75, ""), (76, "x" * 99)]
    docs += [(77, text(20000) + passage)]
    frame = spark.createDataFrame([(d, t, "c", 1) for d, t in docs], "doc_id long, text string, key string, bytes int").repartition(4)
    want = brute(docs)
    assert sum(w[1] > 0 for w in want.values()) > 40
    assert as_dict(S.removed(frame, collection)) == want
    assert S.removed(frame.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark):
    rng = random.Random(6)
    t = "".join(rng.choice("abcdef ") for _ in range(300))
    rows = [(1, t), (1, t), (2, t), (None, t)]
    found = S.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 0), (1, 300), (1, 300), (2, 300)]


def test_sorted_suffixes():
    rng = random.Random(7)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 9))) for _ in range(12)]
    string, size = S.sorted_suffixes(strings)
    found = [(strings[i][len(strings[i]) - k :], int(i)) for i, k in zip(string, size)]
    assert found == sorted((s[i:], k) for k, s in enumerate(strings) for i in range(len(s) + 1))


def test_suffixes_laid_on_places():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 9))) for _ in range(15)]
    places = np.array([rng.randint(0, len(s)) for s in strings])
    string, size = S.sorted_suffixes(strings, places)
    found = [(int(places[i]) - len(strings[i]) + int(k), strings[i][len(strings[i]) - k :], int(i)) for i, k in zip(string, size)]
    every = [(int(places[i]) - j, s[j:], i) for i, s in enumerate(strings) for j in range(len(s) + 1)]
    assert sorted(found) == sorted(every)
    assert [f[:2] for f in found] == sorted(f[:2] for f in every)
    assert [len(a) for a in S.sorted_suffixes([], np.zeros(0, np.int64))] == [0, 0]


@pytest.mark.parametrize("copies", [5000, 3])
def test_large_collections_are_split_and_not_dealt_by_window(spark, monkeypatch, copies):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    passage = text(130)
    docs = [(i, text(rng.randint(80, 120)) + passage + text(rng.randint(80, 120))) for i in range(80)]
    docs += [(i + 80, docs[i % 2][1]) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows, store = {}, S.stored

    def counted(df, purpose, *rest):
        out = store(df, purpose, *rest)
        rows[purpose] = max(rows.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(S, "stored", counted)
    assert as_dict(S.removed(frame, 4, copies)) == brute(docs)
    # The passage's edges make many different segments, of up to 69 windows, around one anchor.
    assert rows["segments"] > 200
    assert max(rows.values()) <= 2 * rows["segments"]
