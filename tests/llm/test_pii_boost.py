"""Personal data: base spans against a plain version, added spans on planted and clean texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from funnelloom.llm import boosting
from funnelloom.llm import pii_boost as P
from funnelloom.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }
            if good[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@pytest.fixture(scope="module")
def model(spark):
    return P.fit(spark)


def found(spark, model, texts):
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "doc_id long, text string, runs string, base int")
    return {r.doc_id: r for r in P.found(df, model).collect()}


def check_base(rows, texts):
    for i, text in enumerate(texts):
        want = plain(text)
        assert rows[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), text
        assert [rows[i][f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in want) for k in P.KINDS], text
        assert set(joined(want).split(",")) <= set(rows[i].spans.split(",")) | {""}, text


EDGES = [
    None, "", " ", "no digits", "a@b.c", "a@b", "a@b@c.d", "x@y.z_q@r.s", "é@b.co", "a@b.co.", "😀 a@b.co 1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.2.3.4", "0001.02.3.4", "1.2.3.0256",
    "1.2.3", "01234567890123456789.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "4111 1111 1111 1111 1", "+1 (269) 555-3296", "+1 (269) 555-3296 4524132264652876",
    "+123456789", "+12345678", "+1234567890123456", "+1.2.3.4 555 666", "+ 1 234", "++49 30 1234567", "+1 +49 30 1234567", "(+49) 30 1234567.", "4028005252517056\n27.189.188.194",
    "4028005252517056 27.189.188.194", "27.189.188.194 4028005252517056", "1" * 40, "+1 " + "(" * 50 + "234567890",
]


def test_base_spans_equal_a_plain_version(spark, model):
    rnd = random.Random(5)
    parts = ["1", "12", "255", "300", ".", ".", " ", "-", "+", "(", ") ", "@", "ab", "é", "4111111111111111", "1.2.3.4", "a@b.co", "+49 30 1234567", "\n", ", ", "_", "%"]
    texts = EDGES + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(1500)]
    check_base(found(spark, model, texts), texts)


def test_very_long_texts(spark, model):
    # The plain version's patterns take quadratic time on single runs; those hold nothing.
    bare = ["7" * 200_000, "a" * 1_000_000, "a." * 100_000 + "@"]
    texts = ["+1 (269) 555-3296 4524132264652876. " * 500, "a@b.co " * 2_000, "1 " * 5_000, "1.2.3.4 " * 1_000]
    rows = found(spark, model, texts + bare)
    check_base(rows, texts)
    assert rows[0].n_added == 1000
    assert all(rows[i].spans == "" for i in range(len(texts), len(texts) + len(bare)))


def test_numbers_side_by_side_are_found_and_clean_texts_left_alone(spark, model):
    phone, card, ip = "+1 (269) 555-3296", "4524132264652876", "27.189.188.194"
    texts, wanted = [], []
    for values in ((phone, card), (card, card), (phone, ip), (ip, card), (card, ip), (ip, phone, card)):
        text, spans = "erntou ", set()
        for v in values:
            kind = {phone: "phone", card: "card", ip: "ip"}[v]
            spans.add(f"{kind}:{len(text)}:{len(text) + len(v)}")
            text += v + " "
        texts.append(text + "and onrend of.")
        wanted.append(spans)
    clean = [
        "order 4524132264652877 of 2024-05-06 10:11:12", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17", "isbn 978-3-16-148410-0 and 3.14159265358979", "token 1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae",
        "we met at noon in the cafe dot", "3 @ 4.50 each", "0.12 0.55 0.37 0.99 0.41",
    ]
    rows = found(spark, model, texts + clean)
    for i, spans in enumerate(wanted):
        assert set(rows[i].spans.split(",")) == spans, texts[i]
    for i in range(len(texts), len(texts) + len(clean)):
        assert rows[i].spans == "", clean[i - len(texts)]


def test_held_out_layouts(spark, model):
    texts = P.laid_out(seed=99, n=600)
    rows = found(spark, model, [t for _, t, _ in texts])
    hit = miss = wrong = 0
    for i, text, spans in texts:
        got = set(rows[i].spans.split(",")) - {""} - set(joined(plain(text)).split(","))
        true = {f"{P.KINDS[k]}:{a}:{b}" for k, a, b in spans} - set(joined(plain(text)).split(","))
        hit, miss, wrong = hit + len(got & true), miss + len(true - got), wrong + len(got - true)
    assert hit / (hit + miss) > 0.9 and wrong / (hit + wrong) < 0.05, (hit, miss, wrong)


def test_redaction_and_repeated_rows(spark, model):
    text = "ring +1 (269) 555-3296 4524132264652876 or a@b.co"
    df = spark.createDataFrame([(None, text), (None, text), (3, None), (4, "plain")], "doc_id long, text string")
    rows = [r.text for r in P.redacted(df, model).collect()]
    assert rows == ["ring <phone> <card> or <email>"] * 2 + [None, "plain"]
    assert P.found(df.limit(0), model).collect() == []


def test_no_python_on_the_main_path(spark, model):
    plan = P.found(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_trees_agree_with_their_column(spark):
    from pyspark.sql import functions as F

    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 9, (400, 3))
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 2)).astype(float)
    model = boosting.fit(x, y, rounds=10)
    assert ((model.predict(x) > 0) == y).mean() > 0.99
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, f array<int>")
    got = [r.s for r in df.select("i", model.column(F.col("f")).alias("s")).orderBy("i").collect()]
    assert np.allclose(got, model.predict(x))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_pii_boost"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(joined(plain(texts[r.doc_id])).encode()).hexdigest()
