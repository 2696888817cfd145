"""The registered queries of the training-data operators, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelloom.llm import (
    decontaminate,
    html_text,
    line_templates,
    packing,
    phrase_graph,
    pii_boost,
    prefix_trie,
    quality_nbsvm,
    rule_ledger,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
)
from funnelloom.llm.common import shared_path, table
from funnelloom.llm.tokens import public_tokenizer


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizer("word_bpe_49k.json"), size=2048, end_id=1)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.components(table(spark, folder, "documents"), size=4, radius=4)
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs, cache = table(spark, folder, "documents"), shared_path(spark, "token-counts")
    return token_counts.count_tokens(docs, public_tokenizer("byte_bpe_50k.json"), cache, limit=1024)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs, place = table(spark, folder, "documents"), shared_path(spark, "token-files")
    manifest = token_files.write_sequences(docs, public_tokenizer("byte_bpe_50k.json"), place, end_id=2)
    return token_files.read_documents(manifest)


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_nbsvm.score(docs, quality_nbsvm.fit(docs, table(spark, folder, "labels")), threshold=0.7)


def op9_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.report(table(spark, folder, "documents"))


def op10_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    book = rule_ledger.ledger(table(spark, folder, "documents"))
    contract = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return book.select(
        *contract,
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"),
        rule_ledger.passes(rule_ledger.CURRENT).alias("kept"),
        "failed",
    )


def op11_phrase_graph(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_graph.collocations(table(spark, folder, "documents"), top=2000, min_count=30)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    found = prefix_trie.sequences(table(spark, folder, "conversations"))
    return prefix_trie.nodes(prefix_trie.with_shared_heads(found))


def op13_pii_boost(spark: SparkSession, folder: str) -> DataFrame:
    return pii_boost.found(table(spark, folder, "documents"), pii_boost.fit(spark))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_html_text": op6_html_text,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality": op8_quality,
    "op9_line_templates": op9_line_templates,
    "op10_rule_ledger": op10_rule_ledger,
    "op11_phrase_graph": op11_phrase_graph,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_pii_boost": op13_pii_boost,
}

ORACLES: dict[str, str] = {}

_WS = "[\\x20\\x09-\\x0D]"
ORACLES["op10_rule_ledger"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{_WS}+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM s WHERE len(ws) >= 8)),
again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
cover AS (SELECT r, count(DISTINCT i + o) AS n FROM again, (SELECT unnest(range(0, 8)) AS o) GROUP BY r),
m AS (SELECT s.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(list_filter(ws, lambda x: regexp_matches(x, '\\pL'))) AS BIGINT) AS n_letter_words,
             CAST(len(list_filter(ws, lambda x: regexp_matches(x, '^\\PL*\\p{{Lu}}\\PL*\\p{{Lu}}[^\\p{{Ll}}]*$'))) AS BIGINT)
               AS n_shouted_words
      FROM s LEFT JOIN cover USING (r)),
f AS (SELECT *, CAST({" + ".join(f"(CASE WHEN {r.fails} THEN {r.mask} ELSE 0 END)" for r in rule_ledger.RULES)} AS BIGINT)
        AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & {rule_ledger.BASE.mask} <> 0 AS base_failed, failed & {rule_ledger.CURRENT.mask} = 0 AS kept, failed
FROM f
"""

_NORMAL = "regexp_replace(trim(regexp_replace({}, '[\\x20\\x09-\\x0D]+', ' ', 'g')), '[^ 0-9]*[0-9][^ ]*', '<*>', 'g')"
ORACLES["op9_line_templates"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY doc_id, text) AS c, doc_id, text,
             string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, c, p, {_NORMAL.format("ls[p]")} AS line FROM (SELECT r, c, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)),
t AS (SELECT *, string_split(line, ' ') AS ts FROM l WHERE line <> '' AND len(string_split(line, ' ')) >= {line_templates.MIN_TOKENS}),
f AS (SELECT *, concat_ws(' ', len(ts), array_to_string(ts[1:{line_templates.DEPTH}], ' ')) AS leaf FROM t
      QUALIFY count(*) OVER (PARTITION BY len(ts), ts[1:{line_templates.DEPTH}]) >= {line_templates.MIN_DOCUMENTS}),
x AS (SELECT r, c, p, leaf, a, ts[a] AS token,
             count(*) OVER (PARTITION BY leaf, a, ts[a]) >= {line_templates.MIN_DOCUMENTS} AND ts[a] <> '<*>' AS fixed
      FROM (SELECT *, unnest(range(1, len(ts) + 1)) AS a FROM f)),
m AS (SELECT r, c, p, leaf, string_agg(CASE WHEN fixed THEN token ELSE '<*>' END, ' ' ORDER BY a) AS template FROM x
      GROUP BY ALL HAVING sum(CAST(fixed AS INT)) >= {line_templates.FIXED_SHARE} * count(*)),
often AS (SELECT leaf, template FROM m GROUP BY ALL HAVING count(DISTINCT c) >= {line_templates.MIN_DOCUMENTS}),
share AS (SELECT c, count(DISTINCT p) AS hits FROM m JOIN often USING (leaf, template) GROUP BY c),
size AS (SELECT c, count(DISTINCT p) AS n FROM t GROUP BY c),
g AS (SELECT leaf, template FROM m JOIN often USING (leaf, template) JOIN share USING (c) JOIN size USING (c)
      WHERE {line_templates.MOST[1]} * hits <= {line_templates.MOST[0]} * n
      GROUP BY ALL HAVING count(DISTINCT c) >= {line_templates.MIN_DOCUMENTS}),
k AS (SELECT r, list(p) AS ps FROM m JOIN g USING (leaf, template) GROUP BY r)
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE CAST(len(ls) AS BIGINT) END AS n_lines,
       CAST(coalesce(len(ps), 0) AS BIGINT) AS n_dropped,
       CASE WHEN ps IS NULL THEN text
            ELSE array_to_string(list_filter(ls, lambda s, i: NOT list_contains(ps, i)), chr(10)) END AS text
FROM d LEFT JOIN k USING (r)
"""

ORACLES["op11_phrase_graph"] = """
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM piece),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, ws[i:i + k - 1] AS g, count(*) AS f
      FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (VALUES (1), (2), (3), (4)) t(k)
      WHERE i + k - 1 <= len(ws) GROUP BY ALL),
cand AS (SELECT * FROM g WHERE k >= 2 AND f >= 30),
inside AS (SELECT lang, ws[i:i + k - 1] AS g, max(f) AS most
           FROM (SELECT lang, g AS ws, f, k AS size, unnest(range(1, k)) AS i FROM cand WHERE k > 2), (VALUES (2), (3)) t(k)
           WHERE k < size AND i + k - 1 <= size GROUP BY ALL),
free AS (SELECT cand.* FROM cand LEFT JOIN inside USING (lang, g) WHERE most IS NULL OR 100 * most < 80 * f),
cut AS (SELECT lang, g, f, k, unnest(range(1, k)) AS c FROM free),
met AS (SELECT cut.lang, cut.g, cut.f AS a, c, x.f AS l, y.f AS r,
               CAST(CAST(2000000 AS HUGEINT) * cut.f // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
        FROM cut JOIN g x ON x.lang = cut.lang AND x.g = cut.g[1:c] JOIN g y ON y.lang = cut.lang AND y.g = cut.g[c + 1:cut.k]),
low AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM low),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

_CRC_STEPS = """flatten([[4294967295], flatten(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
  lambda i: [CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))])"""
ORACLES["op12_prefix_trie"] = f"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, length(text) AS chars, md5(concat(length(role), ':', role, text)) AS digest, turn FROM t),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS p FROM k),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base,
             xor(list_reduce({_CRC_STEPS}, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
               WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 6 AS h FROM t),
own AS (SELECT c.conv_id, 1 AS side, p, digest, chars FROM c JOIN n USING (conv_id) WHERE p > h
        UNION ALL SELECT c.conv_id, 0, p, digest, chars FROM c JOIN n ON n.conv_id = c.base WHERE p <= h),
s AS (SELECT c.conv_id, coalesce(list(digest ORDER BY side, p) FILTER (digest IS NOT NULL), []) AS ks,
             coalesce(list(chars ORDER BY side, p) FILTER (digest IS NOT NULL), []) AS cs
      FROM c LEFT JOIN own USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, ks, cs, unnest(range(0, len(ks) + 1)) AS d FROM s),
node AS (SELECT ks[1:d] AS pre, d, min(conv_id) AS conv_id, count(*) AS n, CASE WHEN d > 0 THEN any_value(cs[d]) ELSE 0 END AS chars,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ks) = d), '')) AS sha
         FROM m GROUP BY ks[1:d], d),
kids AS (SELECT pre[1:d - 1] AS pre, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
flat AS (SELECT node.*, coalesce(kids, 0) AS kids FROM node LEFT JOIN kids USING (pre)),
up AS (SELECT pre[1:a] AS pre, sum((n - 1) * chars) AS saved, sum(CAST(kids = 0 AS INT)) AS leaves
       FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM flat) GROUP BY 1)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, y.conv_id AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs,
       CAST(x.kids AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       x.sha AS ends_sha256
FROM flat x JOIN up USING (pre) LEFT JOIN flat y ON x.d > 0 AND y.d = x.d - 1 AND y.pre = x.pre[1:x.d - 1]
"""
