"""Phrase collocations against plain counting, and against their SQL."""

import random
import re
from collections import Counter

import pytest
from parity import compare, connect

from funnelloom.llm import phrase_graph as P
from funnelloom.llm.queries import ORACLES, QUERIES

SCHEMA = "lang string, text string, gram string, hash long"


def plain(rows, top, least):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    often = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    cover = Counter()
    for (lang, g), n in often.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                part = (lang, g[i : i + k])
                cover[part] = max(cover[part], n)
    found = {}
    for (lang, g), a in often.items():
        if 100 * cover[lang, g] < 80 * a:
            score, k = min((2_000_000 * a // (counts[lang, g[:k]] + counts[lang, g[k:]]), k) for k in range(1, len(g)))
            found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return sorted(
        (lang, rank, g.decode(), -a, left, right, totals[lang], -score)
        for lang, rows_ in found.items()
        for rank, (score, a, g, left, right) in enumerate(sorted(rows_)[:top], 1)
    )


def check(spark, rows, top, least):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in P.collocations(df, top, least).collect())
    assert got == plain(rows, top, least)
    return got


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counting(spark, seed):
    rnd = random.Random(seed)
    words = ["a", "B", "cé", "d", "E", "the quick brown fox jumps over", "b c d e a b c d", "x\ty z", "ñ\u00a0o", "k\x0bl"]
    ends = ["", "", "", ".", "\n", "; ", " ", "\r\n"]
    text = lambda: " ".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(1, 40)))
    rows = [(rnd.choice([None, "en", "de"]), rnd.choice([None, "", " \t ", *(text() for _ in range(9))])) for _ in range(70)]
    assert check(spark, rows, 40, 4)


def test_long_repeated_passage_is_one_path(spark):
    passage = " ".join(f"w{i}" for i in range(600))
    rows = [("en", passage)] * 7 + [("en", "w3 w4 w5 w6. w5 w6")] * 5 + [("en", passage.replace("w300", "w300 w300"))]
    check(spark, rows, 1000, 5)
    paths, inner = P.Graph(spark.createDataFrame(rows, "lang string, text string"), 5).compacted()
    longest = max(paths.collect(), key=lambda r: len(r.words))
    assert len(longest.words) > 250 and inner.count() > 500


def test_one_very_long_text_and_one_very_long_word(spark):
    rows = [("en", "a b c d " * 40_000), ("en", "z" * 3_000_000 + " y"), ("en", None)]
    check(spark, rows, 100, 30)


def test_a_full_bit_table_changes_nothing(spark, monkeypatch):
    rnd = random.Random(7)
    rows = [("en", " ".join(rnd.choice("abcdefghijklmnop") for _ in range(60))) for _ in range(60)]
    monkeypatch.setattr(P, "TABLE_BITS", 6)
    check(spark, rows, 500, 6)


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    _, _, problem = compare(spark, connect(folder), "op11", QUERIES["op11_phrase_graph"], ORACLES["op11_phrase_graph"], folder)
    assert problem is None, problem
