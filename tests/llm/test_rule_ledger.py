"""The rule ledger against a plain version, and its policies and ablations."""

import re

import pytest
from parity import compare, connect

from funnelloom.llm import rule_ledger as R
from funnelloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c d e f g h a b c d e f g h x",
    "one line\none line\n\none line ",
    "#*$ %&| <>",
    "LA!! SE!! QUE!! ok",
    "w " * 30000,
    "plain words that do not repeat at all in this short text of more than twenty words so that it may be kept here",
    "plain words that do not repeat at all in this short text of more than twenty words so that it may be kept here",
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 3 else i, t, "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, failed int").repartition(3)


def test_against_plain(docs):
    found = R.measurements(docs, ["failed"]).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        assert tuple(r[1:7]) == plain(TEXTS[r.row.failed])


def test_against_sql(spark):
    query = QUERIES["op10_rule_ledger"]
    _, _, problem = compare(spark, connect(FOLDER), "op10", query, ORACLES["op10_rule_ledger"], FOLDER)
    assert problem is None, problem


def test_policies_and_ablations(docs):
    book = R.ledger(docs)
    kept = {r.doc_id for r in book.where(R.passes(R.CURRENT)).collect()}
    assert kept == {8, 9}
    assert sorted(R.judged(docs).collect())[0].n_words == "clash" and R.judged(docs).columns == docs.columns
    rows = book.collect()
    for r in R.ablations(book).collect():
        rule = next(x for x in R.RULES if x.name == r.rule)
        assert r.fails == sum(bool(x.failed & rule.mask) for x in rows)
        assert r.fails_alone == sum(x.failed == rule.mask for x in rows)
        assert r.kept_without == sum(not x.failed & ~rule.mask for x in rows)
    assert R.ledger(docs.limit(0)).count() == 0


def test_symbols_are_the_fixed_ones():
    assert set(R.SYMBOLS[1:-1]) == set("#*$%&|<>")
