"""The target spreadsheet: how it is read, and a sample one derived from lead counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelloom.functions.dates import bucket_sql, start_of_day
from funnelloom.functions.text import label_source
from funnelloom.operators.channels import per_country
from funnelloom.operators.scans import official_source
from funnelloom.spec import COUNTRIES, LABELS_REVIEW, MONTH_NAMES, SHEET_BLOCK, SHEET_FIRST_OFFSET

PERFORMANCE = ("WEB", "lead_forms", "Estudio Inmueble")
# Section titles in sheet order, with the grain of their rows.
SECTIONS = (
    ("Metas Anuales", "Y"),
    ("Metas Trimestrales", "Q"),
    ("Metas Mensuales", "M"),
    ("Metas Semanales", "W"),
    ("Metas Ciclos", "C"),
    ("Metas Diarias", "D"),
)


def read_sheet_csv(spark: SparkSession, path: str, country: str) -> DataFrame:
    """One exported sheet as numbered rows of text cells.

    Rows of a sheet depend on their order. ``multiLine`` keeps the file in one piece, so
    the running id follows it, line breaks inside cells included; a sheet is a hand-kept
    file of some hundred rows. The number of columns is that of the sheet's form, not of its
    first line, which may be a short title.
    """
    width = SHEET_FIRST_OFFSET + SHEET_BLOCK * (max(len(spec.sheet_blocks) for spec in COUNTRIES) + 1)
    schema = ", ".join(f"c{i} string" for i in range(width))
    raw = spark.read.schema(schema).option("multiLine", "true").option("escape", '"').csv(path)
    return raw.select(
        F.lit(country).alias("country"),
        F.monotonically_increasing_id().alias("row_no"),
        F.array(*[F.coalesce(F.col(c), F.lit("")) for c in raw.columns]).alias("cells"),
    )


def write_sheet_csv(sheet: DataFrame, path: str) -> None:
    """One sheet's rows of cells as a CSV file in their order."""
    width = SHEET_FIRST_OFFSET + SHEET_BLOCK * (max(len(spec.sheet_blocks) for spec in COUNTRIES) + 1)
    cells = [F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(f"c{i}") for i in range(width)]
    sheet.orderBy("row_no").coalesce(1).select(*cells).write.option("escape", '"').option("emptyValue", "").csv(path)


def sample_sheet(leads: DataFrame, as_of: dt.date) -> DataFrame:
    """A sheet of the running year computed from the leads: per period and block the
    target, target to date, actual and previous values as sheet text."""
    year = as_of.year
    daily = (
        leads.where(
            official_source()
            & (F.col("created_at") >= start_of_day(dt.date(year - 1, 1, 1)))
            & (F.col("created_at") < start_of_day(as_of))
        )
        .groupBy("country", F.to_date("created_at").alias("d"), "source_id")
        .agg(F.count("*").alias("n"))
        .withColumn("label", label_source(F.col("source_id"), LABELS_REVIEW))
    )
    entries = []
    for _, g in SECTIONS:
        moved = "date_add(d, 364)" if g in "WCD" else "add_months(d, 12)"
        entries.append(f"named_struct('g', '{g}', 'start', {bucket_sql('d', g)}, 'now', n, 'prev', 0L)")
        entries.append(f"named_struct('g', '{g}', 'start', {bucket_sql(moved, g)}, 'now', 0L, 'prev', n)")
    blocks = F.array_compact(
        F.array(
            F.col("label"),
            F.lit("TOTAL"),
            F.when(F.col("label").isin(*PERFORMANCE), F.lit("Perfo")),
        )
    )
    counts = (
        daily.withColumn("block", F.explode(blocks))
        .selectExpr("country", "block", f"inline(array({', '.join(entries)}))")
        .where(
            (F.col("start") >= F.lit(dt.date(year, 1, 1))) & (F.col("start") < F.lit(as_of))
        )
        .groupBy("country", "g", "start", "block")
        .agg(F.sum("now").alias("now"), F.sum("prev").alias("prev"))
    )
    cells = counts.withColumns(
        {
            "meta": F.expr("1100 * now + 7"),
            "mtd": F.expr("950 * now + 3"),
            "actual": F.expr("1000 * now"),
            "before": F.expr("1000 * prev"),
        }
    )

    def text(c: str):
        dotted = F.translate(F.format_number(F.col(c), 0), ",", ".")
        return F.when(F.col(c) == 0, F.lit("-")).otherwise(dotted)

    percent = F.when(F.col("block") == "Comercial", F.lit("%")).otherwise(F.lit(""))
    broken = F.when(F.col("block") == "Broker", F.lit("#N/A")).otherwise(text("mtd"))
    four = F.array(F.concat(text("meta"), percent), broken, text("actual"), text("before"))
    per_period = (
        cells.withColumn("four", four)
        .groupBy("country", "g", "start")
        .agg(F.map_from_entries(F.collect_list(F.struct("block", "four"))).alias("by_block"))
    )

    def all_blocks(spec):
        parts = [
            f"coalesce(by_block['{name}'], array_repeat('', 4)), array_repeat('', {SHEET_BLOCK - 4})"
            for name in spec.sheet_blocks
        ]
        return F.expr(f"concat({', '.join(parts)})")

    start = F.col("start")
    lengths = {"D": "start", "W": "date_add(start, 6)", "C": "date_add(start, 6)"}
    lengths |= {"M": "last_day(start)", "Q": "last_day(add_months(start, 2))"}
    end = "CASE g " + " ".join(f"WHEN '{g}' THEN {e}" for g, e in lengths.items())
    end += " ELSE last_day(add_months(start, 11)) END"
    months = F.array(*[F.lit(m) for m in MONTH_NAMES])
    period = (
        F.when(F.col("g") == "Q", F.concat(F.lit("Q"), F.quarter(start).cast("string")))
        .when(F.col("g") == "M", F.element_at(months, F.month(start)))
        .otherwise(F.year(start).cast("string"))
    )
    section = F.array_position(F.array(*[F.lit(g) for _, g in SECTIONS]), F.col("g"))
    rank = F.row_number().over(Window.partitionBy("country", "g").orderBy("start"))
    lead_in = SHEET_FIRST_OFFSET - 5
    body = per_period.select(
        "country",
        (section * 1000 + rank).alias("row_no"),
        F.concat(
            F.array(
                rank.cast("string"),
                period,
                F.date_format(start, "dd/MM/yyyy"),
                F.lit(""),
                F.date_format(F.expr(end), "dd/MM/yyyy"),
            ),
            F.expr(f"array_repeat('', {lead_in})"),
            per_country(all_blocks),
        ).alias("cells"),
    )
    width = SHEET_FIRST_OFFSET + SHEET_BLOCK * 8
    titles = ", ".join(
        f"named_struct('row_no', {1000 * (i + 1)}L, 'cells', "
        f"concat(array('{title}'), array_repeat('', {width - 1})))"
        for i, (title, _) in enumerate(SECTIONS)
    )
    heads = per_period.select("country").distinct().selectExpr("country", f"inline(array({titles}))")
    return body.unionByName(heads)
