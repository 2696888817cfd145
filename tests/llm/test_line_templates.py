"""Line templates against SQL on the sample, and by hand."""

from parity import compare, connect

from funnelloom.llm import line_templates as L
from funnelloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_against_sql(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        query = QUERIES["op9_line_templates"]
        _, _, problem = compare(spark, connect(folder), "op9", query, ORACLES["op9_line_templates"], folder)
        assert problem is None, problem[:1000]


def test_by_hand(spark):
    own = lambda i: " ".join(f"{w}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for w in ("tree", "stone", "lake", "hill"))
    copied = "first of the copied lines\nsecond of the copied lines\nthird of the copied lines"
    texts = [f"{own(i)}\nPage {i} of our long report\n{own(i + 20)}" for i in range(20)]
    texts += [f"{own(i + 40)}\nSold by shop {own(i + 60).split()[0]} in our street today\n" for i in range(15)]
    texts += [copied] * 20 + [None, "", "Page 7 of our long report", "\n\n", "w " * 20000]
    rows = [(i if i % 9 else None, t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, positions int").repartition(3)
    kept = sorted((r.text or "") for r in L.deduplicated(docs).collect())
    want = [f"{own(i)}\n{own(i + 20)}" for i in range(20)] + [f"{own(i + 40)}\n" for i in range(15)]
    want += [copied] * 20 + ["", "", "", "\n\n", "w " * 20000]
    assert kept == sorted(want)
    assert L.deduplicated(docs).columns == docs.columns
    assert L.report(docs.limit(0)).count() == 0
    assert L.report(docs).agg({"n_dropped": "sum"}).first()[0] == 20 + 15 + 1


def test_native(spark):
    plan = QUERIES["op9_line_templates"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def _own(i, k):
    return " ".join(f"{w}{i}x{k}".translate(str.maketrans("0123456789", "abcdefghij")) for w in ("tree", "stone", "lake", "hill"))


def _cleaned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: r.text for r in L.deduplicated(docs).collect()}


def test_blocks_short_lines_and_names(spark):
    head = ["Home and garden news", "Read more", "All rights reserved by the evening page"]
    texts = ["\n".join([*head, _own(i, 1), _own(i, 2), f"Posted by {_own(i, 3).split()[0]} on the evening page"]) for i in range(60)]
    kept = _cleaned(spark, texts)
    assert kept == {i: f"{_own(i, 1)}\n{_own(i, 2)}" for i in range(60)}


def test_near_copies_keep_their_lines(spark):
    body = [_own(900, k) for k in range(12)]
    texts = ["\n".join([*body[: i % 12], _own(i, 50), *body[i % 12 + 1 :]]) for i in range(40)]
    assert _cleaned(spark, texts) == dict(enumerate(texts))


def test_repeated_rows_have_one_vote(spark):
    docs = spark.createDataFrame([(1, f"Shared line of text\n{_own(1, 1)}")] * 30, "doc_id long, text string")
    assert {r.n_dropped for r in L.report(docs).collect()} == {0}
