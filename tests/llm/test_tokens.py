"""Packing, token counts and token files against the library on whole texts."""

import zlib
from itertools import product

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from funnelloom.llm import packing, token_counts, token_files
from funnelloom.llm.queries import QUERIES
from funnelloom.llm.tokens import public_tokenizer

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None,
    "",
    " ",
    "a  b\n\n c",
    "x <|endoftext|> y",
    "don't they'll\t\tgo",
    "\x01 a\x01",
    "é ́a",
    "A\r\nB",
    "it's　ok",
    "(x) y...z",
    "word " * 9000,
    "same text",
    "same text",
]


def documents():
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{FOLDER}/documents.parquet' order by doc_id").fetchall()


def ids_of(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizer(name))
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i // 2 if i else None, t, "x", i) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, row int").repartition(3)


def test_counts(spark):
    docs = documents()
    want = {d: len(i) for (d, _), i in zip(docs, ids_of("byte_bpe_50k.json", [t for _, t in docs]))}
    for row in QUERIES["op4_token_counts"](spark, FOLDER).collect():
        assert row.n_tokens == want.pop(row.doc_id) and row.over_limit == (row.n_tokens > 1024)
    assert not want


def test_counts_odd_texts_and_cache(spark, odd, tmp_path):
    cache, path = str(tmp_path / "cache"), public_tokenizer("byte_bpe_50k.json")
    want = sorted(
        (len((t or "").encode()), len(i)) for t, i in zip(ODD, ids_of("byte_bpe_50k.json", [t or "" for t in ODD]))
    )
    for _ in range(2):  # the second run finds everything in the cache
        found = token_counts.count_tokens(odd, path, cache)
        assert sorted((r.n_bytes, r.n_tokens) for r in found.collect()) == want
    assert spark.read.parquet(cache).count() == len({t or "" for t in ODD})
    assert token_counts.count_tokens(odd.limit(0), path, cache).count() == 0
    # A cache in which two runs have stored the same digests still gives one row per document.
    spark.read.parquet(cache).write.mode("append").parquet(f"{cache}-twice")
    spark.read.parquet(cache).write.mode("append").parquet(f"{cache}-twice")
    twice = token_counts.count_tokens(odd, path, f"{cache}-twice")
    assert sorted(map(str, twice.collect())) == sorted(map(str, token_counts.count_tokens(odd, path, cache).collect()))


def test_files(spark):
    docs = documents()
    start = 0
    want = {}
    for (d, _), ids in zip(docs, ids_of("byte_bpe_50k.json", [t for _, t in docs])):
        want[d] = (start, len(ids) + 1, crc([*ids, 2]))
        start += len(ids) + 1
    found = QUERIES["op5_token_files"](spark, FOLDER).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == want


def test_files_random_access(spark, odd, tmp_path):
    path = public_tokenizer("byte_bpe_50k.json")
    manifest = token_files.write_sequences(odd, path, f"file://{tmp_path}/s", end_id=2, size=64, pad_id=9)
    rows = sorted(manifest.collect())
    ids, masks = [], []
    for row in rows:
        file = token_files.SequenceFile(row.sequences)
        assert len(file) == row.n_sequences
        for i in range(len(file)):
            one, mask = file[i]
            assert len(one) == len(mask) == 64
            ids += one.to_pylist()
            masks += mask.to_pylist()
    assert all(i == 9 for i, m in zip(ids, masks) if not m)
    texts = sorted(((i // 2 if i else -1), t or "") for i, t in enumerate(ODD))
    want = [x for e in ids_of("byte_bpe_50k.json", [t for _, t in texts]) for x in [*e, 2]]
    assert [i for i, m in zip(ids, masks) if m] == want
    assert token_files.read_documents(manifest).count() == len(ODD)
    empty = token_files.write_sequences(odd.limit(0), path, f"file://{tmp_path}/e", end_id=2)
    assert token_files.read_documents(empty).count() == 0
    # Ids of another type, one of them on most rows, and rows without any.
    rows = [("same" if i % 4 else None if i % 8 else f"id{i}", f"text {i}") for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    named = token_files.write_sequences(spark.createDataFrame(rows, "doc_id string, text string").repartition(5), path, f"file://{tmp_path}/n", end_id=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = sorted(token_files.read_documents(named).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or ""))
    assert max(r.n_documents for r in named.collect()) < 300


def check_packing(pieces, want, size):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in (r for rows in by_sequence.values() for r in rows):
        assert r.sequence_length == sum(x.length for x in by_sequence[r.sequence_id]) <= size
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    assert by_doc.keys() == want.keys()
    for d, ids in want.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    lengths = [rows[0].sequence_length for rows in by_sequence.values()]
    return sum(size - n for n in lengths if n & (n - 1)), sum(lengths)


def test_packing(spark):
    docs = documents()
    want = {d: [*ids, 1] for (d, _), ids in zip(docs, ids_of("word_bpe_49k.json", [t for _, t in docs]))}
    padding, total = check_packing(QUERIES["op1_packing"](spark, FOLDER).collect(), want, 2048)
    assert padding < 0.01 * total


def test_packing_odd_texts(spark, odd):
    path = public_tokenizer("word_bpe_49k.json")
    unique = odd.selectExpr("cast(row as long) doc_id", "text", "'x' as start", "1 as length")
    want = {i: [*ids, 1] for i, ids in enumerate(ids_of("word_bpe_49k.json", [t or "" for t in ODD]))}
    check_packing(packing.pack(unique, path, size=256).collect(), want, 256)
    assert packing.pack(odd, path).selectExpr("sum(length)").first()[0] == sum(map(len, want.values()))
    assert packing.pack(odd.limit(0), path).count() == 0


def test_best_cuts_against_all_choices():
    rng = np.random.default_rng(1)
    for _ in range(60):
        places = np.cumsum(rng.integers(1, 6, 9))
        penalties = rng.integers(0, 8, 9).astype(float)
        size = int(rng.integers(6, 14))

        def cost(cuts):
            at = [0, *cuts]
            if any(b - a > size for a, b in zip(at, at[1:])):
                return float("inf")
            by = dict(zip(places.tolist(), penalties))
            return sum(size - (b - a) + by[b] for a, b in zip(at[:-1], at[1:-1]))

        choices = (
            [*[p for p, take in zip(places[:-1].tolist(), c) if take], int(places[-1])]
            for c in product((0, 1), repeat=8)
        )
        assert cost(packing.best_cuts(places, penalties, size)) == min(map(cost, choices))


def test_packer_carries_over_blocks(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 500)
    rng = np.random.default_rng(2)
    packer = packing.Packer(64, np.arange(50) % 7 == 0, 1, 0)
    docs = [rng.integers(0, 50, rng.integers(1, 700)).astype(np.uint32) for _ in range(40)]
    out = [packer.add(d, np.array([len(d)]), np.array([i])) for i, d in enumerate(docs)] + [packer.finish()]
    got = {}
    for o in (o for o in out if o):
        for row, start, length, c in zip(o["row"], o["start"], o["length"], o["ids_crc32"]):
            assert c == crc(docs[row][start : start + length])
            got[row] = got.get(row, 0) + length
    assert got == {i: len(d) for i, d in enumerate(docs)}
