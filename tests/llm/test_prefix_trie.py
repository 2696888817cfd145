"""The prefix trie against a plain one, over several partitions, and against its SQL."""

import hashlib
import random
import zlib

import pytest
from parity import compare, connect

from funnelloom.llm import prefix_trie as T
from funnelloom.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, digest string, node int"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(turns.get(c - c % 100, [])[:h] + own[h:])
    members = {}
    for c, s in made.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        m, below = members[node], kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = sum(saved[k] for k in below) + (len(m) - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    made = T.nodes(T.with_shared_heads(T.sequences(df)))
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.fixture
def many_partitions(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_plain_trie_over_many_partitions(spark, many_partitions, seed):
    rnd = random.Random(seed)
    convs = [None, *range(0, 12), *range(100, 130), *range(205, 215)]
    texts = ["x", "yy", None, "zé"] if seed % 2 else ["x"]
    rows = [
        (rnd.choice(convs), rnd.choice([None, 0, 1, 2, 3, 4, 5, 6]), rnd.choice(["u", None] if seed < 2 else ["u"]), rnd.choice(texts))
        for _ in range(300)
    ]
    assert found(spark, rows) == plain(rows)


def test_copies_prefixes_and_turnless_conversations(spark, many_partitions):
    whole = [("u", "a"), ("b", "c"), ("u", "a" * 5000), ("b", "😀")]
    rows = [(c, t, *whole[t]) for c in range(0, 90) for t in range(1 + c % 4)]
    rows += [(c, 0, "u", "alone") for c in range(301, 340)]  # without a base: turnless where h > 0
    got = found(spark, rows)
    assert got == plain(rows)
    assert (0, 0) in {(r[0], r[1]) for r in got}


def test_one_very_long_conversation(spark):
    rows = [(0, t, "u", str(t)) for t in range(3000)] + [(1, 0, "u", "0")]
    assert found(spark, rows) == plain(rows)


def test_nothing_in_nothing_out(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "x")]) == []


def test_ids_of_a_large_group_are_chunked(spark):
    rows = spark.range(0, 2000).selectExpr("'n' AS node", "id AS conv_id")
    want = hashlib.sha256(",".join(map(str, range(2000))).encode()).hexdigest()
    assert [tuple(r) for r in T.member_digests(rows, chunk=64).collect()] == [("n", want)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_matches_sql(spark, folder):
    _, _, problem = compare(spark, connect(folder), "op12", QUERIES["op12_prefix_trie"], ORACLES["op12_prefix_trie"], folder)
    assert problem is None, problem
