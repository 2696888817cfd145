"""The pipeline against a plain version of its stages, and the entry's guard."""

import duckdb
import numpy as np
from parity import connect
from test_decontaminate import brute
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_packing, ids_of

import corpus_pipeline
from __spark_entry__ import queries
from funnelloom.llm.queries import ORACLES

FOLDER = "/root/testdata/sf0.001"


def test_run(spark):
    con = connect(FOLDER)
    kept = {r[0] for r in con.sql(f"select doc_id from ({ORACLES['op10_rule_ledger']}) where kept").fetchall()}
    con.execute("create table judged as select * from documents where doc_id in (select unnest(?))", [sorted(kept)])
    con.execute("drop view documents; alter table judged rename to documents")
    texts = dict(con.sql(f"select doc_id, text from ({ORACLES['op9_line_templates']})").fetchall())
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    first = plain_components(prints, 4)
    texts = {d: t for d, t in texts.items() if first[d] == d}
    items = duckdb.sql(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    leaked = {d for d, _ in brute(list(texts.items()), items)}
    texts = {d: t for d, t in texts.items() if d not in leaked}
    assert leaked and len(texts) < len(prints) < 200
    want = {d: [*ids, 1] for d, ids in zip(texts, ids_of("word_bpe_49k.json", list(texts.values())))}
    check_packing(queries()["pipeline"](spark, FOLDER).collect(), want, 2048)


def test_stages_keep_the_columns(spark):
    rows = [(i, f"{i} plain words that do not repeat at all " + " ".join(f"w{i}x{k}" for k in range(25)), "en", "s", 3) for i in range(4)]
    docs = spark.createDataFrame([*rows, rows[0], (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0), docs.withColumn("fp", docs.lang).withColumn("n_words", docs.lang)):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, FOLDER)
            assert now.columns == frame.columns
        n = now.count()
        assert n == (0 if frame.isEmpty() else 4)


def test_names():
    assert sorted(int(n.split("_")[0][2:]) for n in queries() if n.startswith("op")) == list(range(1, 14))
    assert np.all([callable(f) for _, f in corpus_pipeline.STAGES])
