"""Line deduplication by a log-template tree, with DataFrame operations alone.

The tree has a fixed depth: a line's leaf is its number of tokens and its first tokens,
with every token that has a digit taken as a variable. Within a leaf, a token that stands
at its place in fewer than ``MIN_DOCUMENTS`` lines is a variable too; what remains is the
line's template. Templates of which enough tokens are fixed and that enough documents
have are recurring, and their lines are dropped, whole blocks of them as well as single ones.

Copies: a copied document repeats its lines, too, and dropping them would empty all copies.
What tells boilerplate from a copy is that documents with boilerplate say something else
besides. A document therefore votes for its templates only if at most ``MOST`` of its
lines are candidates, that is, templates of ``MIN_DOCUMENTS`` or more documents. Templates
that enough votes carry are dropped wherever they stand; copies of whole texts are left to
near-duplicate detection.

Work: a row of hashes per line, from one pass in which each line is normalised once;
token rows only for distinct lines of leaves that recur; one join back to the texts on a
digest of the row. A line that a third of the documents share is one row per map task in
the first step and sits on the side that AQE splits in the joins. All choices that tell
lines apart are parameters: ``min_tokens`` (shortest line considered, 1) and
``min_documents``. The depth is 2: variable third tokens (names in "Posted by <name> ...")
would part the lines of one template at depth 3.

Defined results: a null text stays null and has no lines; an empty text has none either,
and lines of white space are no templates; a text whose lines are all dropped becomes empty;
rows that repeat both id and text have one vote and are treated alike; very long texts and
lines are rows like others; an empty table stays empty; other columns are kept as they
came, whatever their names; a null ``doc_id`` does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.llm.common import stored

DEPTH = 2  # leading tokens that make the leaf
MIN_TOKENS = 1
MIN_DOCUMENTS = 10
FIXED_SHARE = 0.7
MOST = (2, 3)  # a document with more candidate lines than this share has no vote

_SPACE = r"[\x20\x09-\x0D]+"
_WILD = "<*>"


def _normalised(lines: DataFrame, min_tokens: int) -> DataFrame:
    """``raw`` to ``normal`` (single spaces, tokens with a digit as variables) and its ``leaf``.

    Every step is a column that the next one names more than once, so that none of them is
    worked out again for each use. Blank lines are told by the raw text: Spark would move a
    test of a made column below the steps and work them out for it once more.
    """
    lines = lines.where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
    raw, spaced, normal = F.col("raw"), F.col("spaced"), F.col("normal")
    uneven = F.startswith(raw, F.lit(" ")) | F.endswith(raw, F.lit(" "))
    for text in ("  ", "\t", "\r", "\x0b", "\x0c"):
        uneven |= F.contains(raw, F.lit(text))
    rows = lines.withColumn("spaced", F.when(uneven, F.btrim(F.regexp_replace(raw, _SPACE, " "))).otherwise(raw)).drop("raw")
    variable = F.regexp_replace(spaced, "[^ 0-9]*+[0-9][^ ]*+", _WILD)
    rows = rows.withColumn("normal", F.when(spaced.rlike("[0-9]"), variable).otherwise(spaced)).drop("spaced")
    size = F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit(""))) + 1
    rows = rows.withColumn("leaf", F.xxhash64(size, F.substring_index(normal, " ", DEPTH)))
    return rows.where(size >= min_tokens) if min_tokens > 1 else rows


def _keys() -> list[Column]:
    """A 128-bit digest of a row; rows with the same id and text are treated alike."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2")]


def _lines(docs: DataFrame, min_tokens: int) -> DataFrame:
    """A row of hashes per line that is long enough for a template."""
    split = docs.where("text IS NOT NULL").select(*_keys(), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    return _normalised(split, min_tokens).select("k1", "k2", "pos", F.xxhash64("normal").alias("line"), "leaf")


def _templates(docs: DataFrame, lines: DataFrame, min_documents: int, min_tokens: int) -> DataFrame:
    """``line, template`` of the distinct lines in recurring leaves whose template is fixed enough."""
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_documents).select("leaf")
    texts = _normalised(docs.select(F.explode(F.split("text", "\n")).alias("raw")), min_tokens)
    distinct = stored(
        texts.join(stored(leaves, "leaves"), "leaf", "left_semi")
        .groupBy("leaf", "normal")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("line", F.xxhash64("normal")),
        "lines-of-leaves",
    )
    tokens = distinct.select("leaf", "line", "n", F.posexplode(F.split("normal", " ")).alias("at", "token"))
    fixed = stored(
        tokens.groupBy("leaf", "at", "token")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_documents) & (F.col("token") != _WILD))
        .select("leaf", "at", "token", F.lit(True).alias("fixed")),
        "fixed-tokens",
    )
    marked = tokens.join(fixed, ["leaf", "at", "token"], "left")
    token = F.when(F.col("fixed"), F.col("token")).otherwise(_WILD)
    per_line = marked.groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.struct("at", token.alias("token")))).alias("tokens"),
        F.count("fixed").alias("n_fixed"),
        F.count(F.lit(1)).alias("size"),
    )
    return per_line.where(F.col("n_fixed") >= FIXED_SHARE * F.col("size")).select(
        "line", F.xxhash64(F.col("leaf"), F.concat_ws(" ", F.col("tokens.token"))).alias("template")
    )


def dropped_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``k1, k2, positions``: for each row with recurring lines, their places in the text."""
    lines = stored(_lines(docs, min_tokens), "line-hashes")
    template_of = stored(_templates(docs, lines, min_documents, min_tokens), "templates")
    found = stored(lines.join(template_of, "line").select("k1", "k2", "pos", "template").distinct(), "templated-lines")
    documents = found.groupBy("template", "k1", "k2").agg(F.count(F.lit(1)).alias("lines"))
    had = stored(documents, "documents-of-templates")
    often = had.groupBy("template").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_documents).select("template")
    candidates = stored(had.join(often, "template", "left_semi"), "candidates")
    part, of = MOST
    # Rows that repeat id and text share their keys; a line of theirs counts once.
    all_lines = lines.groupBy("k1", "k2", "pos").agg(F.lit(1).alias("one")).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("all"))
    shares = candidates.groupBy("k1", "k2").agg(F.sum("lines").alias("lines")).join(all_lines, ["k1", "k2"])
    voters = shares.where(of * F.col("lines") <= part * F.col("all")).select("k1", "k2")
    votes = candidates.join(voters, ["k1", "k2"], "left_semi").groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
    recurring = stored(votes.where(F.col("docs") >= min_documents).select("template"), "recurring")
    return found.join(recurring, "template", "left_semi").groupBy("k1", "k2").agg(F.collect_set("pos").alias("positions"))


def _with_drops(docs: DataFrame, min_documents: int) -> DataFrame:
    drops = stored(dropped_lines(docs, min_documents), "dropped-lines")
    names = {c: f"`{c}`" for c in docs.columns}
    rows = docs.select(*_keys(), F.struct(*[F.col(n) for n in names.values()]).alias("row"))
    met = rows.join(drops, ["k1", "k2"], "left")
    kept = F.filter(F.split("row.text", "\n"), lambda _, i: ~F.array_contains("positions", i))
    text = F.when(F.col("positions").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return met.select("row", text.alias("kept"), F.coalesce(F.size("positions"), F.lit(0)).alias("n_dropped"))


def report(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text``: one row per document."""
    n_lines = F.when(F.coalesce(F.col("row.text"), F.lit("")) == "", 0).otherwise(F.size(F.split("row.text", "\n")))
    return _with_drops(docs, min_documents).select(
        F.col("row.doc_id").alias("doc_id"),
        n_lines.cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.col("kept").alias("text"),
    )


def deduplicated(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with recurring lines taken out; all other columns as they came."""
    made = _with_drops(docs, min_documents)
    return made.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
