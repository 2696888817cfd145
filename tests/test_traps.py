"""Hand-computed cases, one per semantic trap."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from funnelloom.functions import dates, ratios, text
from funnelloom.operators import channels, compare, events, joins, masks, rollup, targets
from funnelloom.plans import hourly, okr, quality, sellers, webform
from funnelloom.spec import CO, FLAGS_13, LABELS_REVIEW

AS_OF = dt.date(2026, 5, 20)


def day(text_):
    return dt.date.fromisoformat(text_)


def ts(text_):
    return dt.datetime.fromisoformat(text_)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def scalar(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


LOG = "country string, track string, deal_id long, state_id int, ts timestamp_ntz, seq int"


def log_of(spark, *rows):
    return spark.createDataFrame(
        [("CO", "mm", deal, state, ts(at), i) for i, (deal, state, at) in enumerate(rows)], LOG
    )


# --- events -----------------------------------------------------------------------------
def test_first_event_in_window_needs_the_true_first(spark):
    log = log_of(spark, (1, 20, "2025-11-01"), (1, 20, "2026-05-10"), (2, 63, "2026-05-11"))
    lo, hi = day("2026-01-01"), AS_OF
    kept = events.first_event_in_window(log, (20, 63), lo, hi).collect()
    assert [r.deal_id for r in kept] == [2]
    again = events.first_windowed_event(log, (20, 63), dates.start_of_day(lo)).collect()
    assert sorted((r.deal_id, str(r.first_at.date())) for r in again) == [
        (1, "2026-05-10"),
        (2, "2026-05-11"),
    ]


def test_latest_state_orders_by_time_then_position(spark):
    log = log_of(spark, (1, 7, "2026-01-02"), (1, 3, "2026-01-01"), (2, 5, "2026-01-01"), (2, 9, "2026-01-01"))
    out = {r.deal_id: r.state_id for r in events.latest_state(log).collect()}
    assert out == {1: 7, 2: 9}


def test_latest_state_takes_any_position_state_and_time(spark):
    def at(text):
        return dt.datetime.fromisoformat(text)

    rows = [
        (1, 20, at("2026-01-01T00:00:00"), 5000), (1, 3, at("2026-01-01T00:00:00.001"), 1),
        (2, 7, at("2026-01-01T00:00:00.000001"), 9), (2, 20, at("2026-01-01T00:00:00.000002"), 1),
        (3, 1500, at("2026-01-01T00:00:00"), 1),
        (4, 7, at("2026-01-01T00:00:00"), 1), (4, 20, at("2026-01-02T00:00:00"), None),
        (5, 3, at("1950-01-01T00:00:00"), 1), (5, 7, at("1960-01-01T00:00:00"), 1),
    ]
    log = spark.createDataFrame(
        [("CO", "mm", *r) for r in rows],
        "country string, track string, deal_id long, state_id int, ts timestamp_ntz, seq int",
    )
    want = {1: 3, 2: 20, 3: 1500, 4: 20, 5: 7}
    assert {r.deal_id: r.state_id for r in events.latest_state(log).collect()} == want
    assert {r.deal_id: r.state_id for r in events.deal_summary(log).collect()} == want
    assert {r.deal_id: r.state_id for r in events.deal_transitions(log).collect()} == want
    current = spark.createDataFrame([("CO", 1, 9, 4)], "country string, deal_id long, state_id int, inmo_state_id int")
    assert [r.state_id for r in events.current_state(log, current).collect()] == [9]


def test_rescue_needs_a_later_qualification(spark):
    before = log_of(spark, (1, 20, "2026-01-01"), (1, 7, "2026-01-02"))
    after = before.union(log_of(spark, (1, 20, "2026-01-03")))
    for log, expected in ((before, False), (after, True)):
        s = events.transition_summary(log)
        flag = events.rescued_after(F.col("first_inc"), F.col("last_20")).alias("x")
        assert one(s.select(flag)).x is expected


def test_left_with_null_current_state_counts_as_left(spark):
    row = spark.createDataFrame(
        [(1, 0, None, None, None, None)],
        "ever_inc int, ever_rev int, state_id int, first_inc timestamp, first_rev timestamp, last_20 timestamp",
    )
    out = one(row.select(*[F.expr(f"count_if({c}) AS {n}") for n, c in sellers.TRANSITION_METRICS.items()]))
    assert (out.inc_pass, out.inc_left, out.inc_to_20, out.rev_pass) == (1, 1, 0, 0)


# --- channels ---------------------------------------------------------------------------
def test_null_channel_keeps_its_row_with_zero_metrics(spark):
    assert scalar(spark, text.resolve_channel(F.lit(None).cast("string"), F.lit(None), F.lit(None))) is None
    part = spark.createDataFrame([("CO", None, 5)], "country string, channel string, reg long")
    money = spark.createDataFrame([("CO", "WEB", 2.0)], "country string, channel string, spend double")
    out = joins.assemble_metrics([part, money], ["country", "channel"], ("reg",), ("spend",))
    rows = {r.channel: (r.reg, r.spend) for r in out.collect()}
    assert rows == {None: (0, None), "WEB": (0, 2.0)}


def test_assembly_holds_all_four_metrics_of_the_weekly_review(spark):
    from types import SimpleNamespace

    from funnelloom.catalog.channels import assemble_metrics_using

    when = ts("2001-07-18 10:00:00")
    leads = spark.createDataFrame([("CO", 1, 3, when), ("CO", 2, 3, when)], "country string, deal_id long, source_id int, created_at timestamp_ntz")
    log = spark.createDataFrame([("CO", 1, 20, when, "mm")], "country string, deal_id long, state_id int, ts timestamp_ntz, track string")
    mart = spark.createDataFrame([("colombia", 3, when.date())] * 3, "country string, source_id int, day date")
    spend = spark.createDataFrame([("CO", "Web", when, 2.6), ("CO", "Lead Form", when, 1.0)], "country string, acquisition_channel string, date timestamp_ntz, spend double")
    out = assemble_metrics_using(SimpleNamespace(leads=leads, state_log_mm=log, assigned_mart=mart, spend=spend))
    assert out.columns == ["country", "week_start", "source", "reg", "cal", "asg", "spend"]
    assert {tuple(r) for r in out.collect()} == {
        ("CO", "2001-07-16", "WEB", 2, 1, 3, 3.0),
        ("CO", "2001-07-16", LABELS_REVIEW[47], 0, 0, 0, 1.0),
    }


def test_dictionary_duplicates_resolve_to_the_earliest_row(spark):
    d = spark.createDataFrame(
        [(7, "a", "x", "late", "P"), (3, "a", "y", "early", "P"), (1, None, "z", "none", "P")],
        "row_no long, campaign_original string, campaign_name string, channel_medium string, platform string",
    )
    assert one(channels.dictionary_by(d, "campaign_original")).channel_medium == "early"


def test_repeated_asset_multiplies_assignments(spark):
    mart = spark.createDataFrame([("CO", 1, "w")], "country string, asset_id long, week string")
    leads = spark.createDataFrame([("CO", 1, "s"), ("CO", 1, "s")], "country string, asset_id long, source string")
    out = joins.fan_out_counts(mart, leads, ["country", "asset_id"], ["country", "week"], ["source"])
    assert one(out).n == 2


def test_fan_out_equals_a_plain_join_on_a_hot_key(spark):
    left = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "id % 4 AS a")
    right = spark.range(300).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id END AS k", "id % 5 AS b"
    )
    plain = left.join(right, "k").groupBy("a", "b").agg(F.count("*").alias("n"))
    fast = joins.fan_out_counts(left, right, ["k"], ["a"], ["b"])
    key = lambda r: (r.a, r.b, r.n)
    assert sorted(map(key, plain.collect())) == sorted(map(key, fast.collect()))


def test_spread_left_join_equals_a_plain_left_join(spark):
    left = spark.range(200).selectExpr("id AS v", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 50 END AS k")
    right = spark.range(40).selectExpr("id AS k", "id * 10 AS w").union(
        spark.createDataFrame([(None, -1)], "k long, w long")
    )
    plain = left.join(right, "k", "left").select("v", "k", "w")
    spread = joins.left_join_spread(left, right, on=["k"], nullable="k").select("v", "k", "w")
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    anti = joins.anti_join(left, right.select("k"), ["k"], "k")
    want = [r.v for r in plain.where("w IS NULL").collect()]
    assert sorted(r.v for r in anti.collect()) == sorted(want)


def test_prefix_rules_keep_unknown_channels_null(spark):
    rule = lambda c: text.channel_to_source(F.lit(c), CO.spend_prefixes, CO.lead_form_aliases)
    assert scalar(spark, rule("WEB Paid")) == "WEB"
    assert scalar(spark, rule("lead_forms Direct")) == "lead_forms"
    assert scalar(spark, rule("Propiedades Paid")) is None


def test_traffic_pattern_underscore_is_a_wildcard(spark):
    url = lambda u: text.classify_traffic(F.lit(u), F.lit(None).cast("string"))
    assert scalar(spark, url("x?utmXcontent=helpXto_sell")) == "help_to_sell"
    assert scalar(spark, url("x?utm=help")) == "web_puro"


# --- calendar and text --------------------------------------------------------------------
@pytest.mark.parametrize("d, start", [("2026-05-05", "2026-04-29"), ("2026-05-06", "2026-05-06")])
def test_commercial_week_opens_on_wednesday(spark, d, start):
    assert scalar(spark, dates.commercial_week_start(F.lit(day(d)))) == day(start)
    assert dates.bucket_of_day(day(d), "C") == day(start)


@pytest.mark.parametrize(
    "raw, strict, lenient",
    [("12.345", 12345, 12345), ("95%", 95, 95), ("#N/A", None, None), ("-", None, None), ("1,2", None, 12), (" ", None, None)],
)
def test_sheet_numbers(spark, raw, strict, lenient):
    assert scalar(spark, text.parse_latam_number(F.lit(raw))) == strict
    assert scalar(spark, text.parse_latam_number(F.lit(raw), strip_commas=True)) == lenient


@pytest.mark.parametrize("raw, want", [("05/03/2026", "2026-03-05"), ("31/02/2026", None), ("x", None)])
def test_sheet_dates(spark, raw, want):
    assert scalar(spark, text.parse_dmy_date(F.lit(raw))) == (want and day(want))


def test_leap_day_clamps_only_for_fixed_periods(spark):
    leap = F.lit(day("2024-02-29"))
    assert scalar(spark, dates.replace_year_clamped(leap, 2023)) == day("2023-02-28")
    assert scalar(spark, dates.replace_year(leap, 2023)) is None


def test_new_year_week_keeps_the_unshifted_previous_range(spark):
    first, last = F.lit(day("2025-12-29")), F.lit(day("2026-01-04"))
    now = dates.prior_year_range(first, last, 2026)
    assert scalar(spark, now[0]) == day("2026-12-29")
    assert scalar(spark, now[1]) == day("2026-01-04")
    capped = dates.cap_to_yesterday(*now, AS_OF)
    assert scalar(spark, capped[0]) is None
    before = dates.prior_year_range(first, last, 2025)
    assert (scalar(spark, before[0]), scalar(spark, before[1])) == (day("2025-12-29"), day("2026-01-04"))


def test_open_periods_on_the_driver_match_the_columns(spark):
    for offset in range(0, 400, 13):
        d = AS_OF + dt.timedelta(days=offset)
        for g in "DWCMQY":
            assert scalar(spark, dates.bucket_start(F.lit(d), g)) == dates.bucket_of_day(d, g)


# --- ratios ----------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "now, prev, want", [(0, 0, None), (5, 0, float("inf")), (None, 3, None), (12, 10, 0.2)]
)
def test_delta(spark, now, prev, want):
    lit = lambda v: F.lit(v).cast("long")
    assert scalar(spark, ratios.delta_pct(lit(now), lit(prev))) == want


def test_a_new_value_is_good_unless_undirected(spark):
    inf = F.lit(float("inf"))
    assert scalar(spark, ratios.significance_flag(inf, "down")) == "good"
    assert scalar(spark, ratios.significance_flag(inf, "none")) == "neutral"
    assert scalar(spark, ratios.significance_flag(F.lit(0.1), "up")) == "neutral"


def test_step_rates_reset_on_null(spark):
    df = spark.createDataFrame(
        [("s", 0, None), ("s", 1, 0), ("s", 2, 10), ("s", 3, 5)], "source string, stage_no int, n long"
    )
    out = compare.step_conversion(df, ["source"], "stage_no", "n").orderBy("stage_no")
    assert [r.step_rate for r in out.collect()] == [None, None, None, 0.5]


def test_trend_skips_gaps_but_keeps_positions(spark):
    df = spark.createDataFrame([("k", 1, 1.0), ("k", 2, None), ("k", 3, 4.0)], "k string, b int, y double")
    out = one(compare.linear_trend(df, ["k"], "b", "y"))
    assert (out.slope, out.intercept, out.first_idx, out.last_idx) == (1.5, 1.0, 0, 2)
    single = spark.createDataFrame([("k", 1, 1.0)], "k string, b int, y double")
    assert one(compare.linear_trend(single, ["k"], "b", "y")).slope is None


def test_best_period_is_the_first_maximum_above_zero(spark):
    df = spark.createDataFrame(
        [("a", day("2026-01-05"), 3), ("a", day("2026-01-12"), 3), ("b", day("2026-01-05"), 0)],
        "source string, bucket date, n long",
    )
    out = {r.source: (r.best_period, r.best_value) for r in compare.period_summary(df, ["source"], "bucket", "n").collect()}
    assert out == {"a": (day("2026-01-05"), 3), "b": (None, None)}


# --- masks ---------------------------------------------------------------------------------------
def test_missing_values_pass_or_fail_as_the_rules_say(spark):
    row = spark.createDataFrame(
        [(None, None, None, None)], "listing string, rating string, state_text string, priced int"
    )
    flags = one(row.select(*[c.alias(n) for n, c in masks.lead_flags().items()]))
    assert (flags.pf_listing, flags.pf_rating, flags.pf_state, flags.pf_priced) == (1, 1, 0, 0)
    assert scalar(spark, masks.owner_flag(F.lit(None).cast("string"))) == 0


def test_first_failure_wins(spark):
    bits = [F.lit(b) for b in (1, 0, 1, 0, 1)]
    assert scalar(spark, masks.attribute_first_failure(bits)) == "F12"
    assert scalar(spark, masks.pack_bitmask(bits)) == 0b10101
    assert scalar(spark, masks.attribute_first_failure([F.lit(1)] * 5)) == "Otro"


@pytest.fixture(scope="module")
def mask_table(spark):
    rows = [("w", m * 37 % 8192, m % 2, 1 + m % 5) for m in range(400)]
    return spark.createDataFrame(rows, "w string, m long, c int, n long").cache()


def universe(rows, req):
    other, state = req & 7951, req & 240
    return sum(n for _, m, _, n in rows if (m & other) == other and (m & state))


def test_marginal_effects_match_a_scan_per_filter(spark, mask_table):
    rows = [tuple(r) for r in mask_table.collect()]
    req = 8191 - 4 - 64 - 1024
    out = {r["filter"]: r for r in masks.mask_marginal_effect(mask_table, ["w"], req).collect()}
    for i, name in enumerate(FLAGS_13):
        assert out[name].base == universe(rows, req)
        assert out[name].flipped == universe(rows, req ^ (1 << i))


def test_empty_state_group_admits_nothing(spark, mask_table):
    assert one(masks.mask_universe_grouped_or(mask_table, ["w"], 8191 - 240)).n == 0


def test_relaxing_a_plain_filter_never_shrinks_the_universe(spark, mask_table):
    for req in (8191, 8191 - 2, 4096 + 16):
        effects = masks.mask_marginal_effect(mask_table, ["w"], req).collect()
        for i, e in enumerate(sorted(effects, key=lambda r: int(r["filter"][1:]))):
            if req & (1 << i) and not (240 & (1 << i)):
                assert e.delta >= 0


# --- rollup ----------------------------------------------------------------------------------------
def test_distinct_assets_by_first_day_equal_count_distinct(spark):
    df = spark.range(3000).selectExpr(
        "'CO' AS country", "CAST(id % 2 AS INT) AS source_id", "concat('s', id % 3) AS source_name",
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 1 ELSE id % 90 END AS asset_id",
        "date_add(DATE '2025-01-01', CAST((id * 17) % 500 AS INT)) AS created",
    )
    out = rollup.cohort_by_grain(df, {"x": "asset_id = 1"})
    got = {(r.g, r.start, r.source_id): (r.tr, r.t, r.x) for r in out.collect()}
    for g in "DWCMQY":
        start = dates.bucket_start(F.col("created"), g)
        plain = df.groupBy(start.alias("start"), "source_id").agg(
            F.count("*").alias("tr"), F.count_distinct("asset_id").alias("t"), F.expr("count_if(asset_id = 1) AS x")
        ).collect()
        kept = sorted({r.start for r in plain}, reverse=True)[: 25 if g != "Y" else None]
        want = {(g, r.start, r.source_id): (r.tr, r.t, r.x) for r in plain if r.start in kept}
        assert {k: v for k, v in got.items() if k[0] == g} == want


# --- hourly ---------------------------------------------------------------------------------------
def test_missing_weekday_counts_as_zero_and_future_hours_are_null(spark):
    now = dt.datetime(2026, 5, 20, 19, 30)  # 14:30 in CO
    today = day("2026-05-20")
    long = spark.createDataFrame(
        [("registros", "CO", today - dt.timedelta(days=d), 9, "WEB", 4) for d in (14, 21, 28)]
        + [("registros", "CO", today, 10, "WEB", 2)],
        "metric string, country string, local_date date, hour int, source string, n long",
    )
    matrix = hourly.hour_matrix(long, now)
    web = {r.hour: r for r in matrix.where("country = 'CO' AND source = 'WEB' AND metric = 'registros'").collect()}
    assert web[9].avg_4 == 3.0 and web[10].today == 2
    assert sum(r.today is None for r in web.values()) == 24 - 14 - 1
    hours = hourly.all_sources(matrix)
    last = {(r.country, r.metric): r.last_hour for r in hourly.last_hour_with_data(hours).collect()}
    assert last[("CO", "registros")] == 10 and last[("MX", "registros")] is None


# --- web form --------------------------------------------------------------------------------------
def test_one_visitor_can_be_matched_and_unmatched(spark):
    at = ts("2026-05-10T15:00:00")
    views = spark.createDataFrame(
        [("v", "/formulario-inmueble/felicitaciones", None, None, at)],
        "anonymous_id string, path string, url string, referrer string, ts timestamp_ntz",
    )
    views = webform.scan_pageviews(views, AS_OF)
    content = spark.createDataFrame(
        [("v", "u1", at), ("v", "u2", at)], "anonymous_id string, backbone_uuid string, ts timestamp_ntz"
    )
    bridge = spark.createDataFrame([("u1", "d1")], "uuid string, deal_uuid string")
    deals = spark.createDataFrame([("d1", 9)], "deal_uuid string, asset_id long")
    leads = spark.createDataFrame([(9, day("2026-05-10"))], "asset_id long, created_at date")
    out = {r.stage: r.n for r in webform.form_counts(webform.visitor_days(views), content, bridge, deals, leads).collect()}
    assert out == {"felicitaciones": 1, "lead_hubspot": 1, "completions_no_deal": 1}


def test_web_form_reads_each_table_once(spark, tmp_path):
    from funnelloom.catalog.today import _funnel
    from funnelloom.sources.testdata import Tables

    df = _funnel(Tables(spark, "/root/testdata/sf0.001"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan parquet") <= 6 and "BroadcastNestedLoop" not in plan


def test_untracked_source_has_null_stages_and_tracked_ones_zero(spark):
    long = spark.createDataFrame(
        [(AS_OF, "web_puro", "direccion", 3)], "d date, source string, stage string, n long"
    )
    rows = {r.source: r for r in webform.pivot_stages(long).collect()}
    assert rows["web_puro"].direccion == 3 and rows["web_puro"].zona == 0
    assert rows["ayuda_venta"].direccion is None and rows["ayuda_venta"].lead_hubspot == 0


# --- targets -----------------------------------------------------------------------------------------
def sheet(spark, *rows):
    cells = [(("CO", i, [*r, *[""] * (63 - len(r))])) for i, r in enumerate(rows)]
    return spark.createDataFrame(cells, "country string, row_no long, cells array<string>")


def block(*numbers):
    return ["1", "", "04/05/2026", "", "10/05/2026", "", "", *numbers]


def test_sheet_sections_stop_at_the_daily_one(spark):
    week = block("1.100", "950", "1.000", "-")
    df = sheet(
        spark, ["Metas Semanales"], week, ["x"], block("5", "", "", ""), ["Metas Diarias"], week, ["Metas Ciclos"], week
    )
    out = targets.targets_from_sheet(df).where("source = 'TOTAL'").collect()
    assert [(r.section, r.meta, r.mtd, r.actual, r.prev) for r in out] == [("weekly", 1100, 950, 1000, None)]


def test_null_total_stays_null_after_subtraction(spark):
    long = spark.createDataFrame(
        [("MX", 1, "TOTAL", 10, None, 5, 1), ("MX", 1, "Propiedades", 4, 2, None, 1)],
        "country string, row_no long, source string, meta long, mtd long, actual long, prev long",
    )
    out = one(targets.subtract_source_total(long, "MX", "Propiedades"))
    assert (out.meta, out.mtd, out.actual, out.prev) == (6, None, 5, 0)


def test_new_year_week_has_no_current_spend(spark):
    rows = spark.createDataFrame(
        [("CO", 1, "weekly", "2026", day("2025-12-29"), day("2026-01-04"), "TOTAL", 1, 1, 1, 1)],
        "country string, row_no long, section string, period string, from date, to date, source string, "
        "meta long, mtd long, actual long, prev long",
    )
    spend = spark.createDataFrame(
        [("CO", day("2025-12-30"), 5), ("CO", day("2026-01-02"), 7)], "country string, day date, spend long"
    )
    out = one(okr.okr_rows(rows, spend, AS_OF))
    assert (out.spend, out.spend_prev, out.label) == (0, 12, "29/12 - 04/01")


def test_okr_figures_of_a_known_year(spark):
    rows = spark.createDataFrame(
        [("CO", "annual", "2026", 66621, 26646, 28758, 28356, 497671, 0)],
        "country string, section string, label string, target long, to_date long, actual long, prev long, "
        "spend long, spend_prev long",
    )
    out = one(okr.okr_tracker(rows))
    assert (out.attainment, out.band, out.leads_yoy, out.cpla) == (108, "good", 1, 17)
    assert out.spend_yoy is None and out.cpla_prev == 0 and out.cpla_yoy is None


# --- price quality --------------------------------------------------------------------------------------
def test_lead_without_deal_is_one_row_without_price(spark):
    counts = spark.createDataFrame([("c", 1, 2), ("c", None, 3)], "campaign string, asset_id long, n long")
    deals = spark.createDataFrame([(1, 10.0), (1, None), (1, 5.0)], "asset_id long, ask_price double")
    out = one(quality.price_presence(counts, deals, ["campaign"]))
    assert (out.with_price, out.without_price) == (4, 5)


def test_absent_week_stays_null_in_the_lists(spark):
    weekly = spark.createDataFrame(
        [(day("2026-05-04"), "Colombia", 2, 1, 1, 0)], "week date, country string, n long, a long, b long, c long"
    )
    lists = {r.country: r.n for r in quality.series_lists(weekly).collect()}
    assert lists == {"Colombia": [2], "México": [None]}


# --- every request from one table -------------------------------------------------------------------
def test_lattice_answers_every_request_as_the_direct_sum(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), rnd.randrange(8192), rnd.randrange(2), rnd.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame([*rows, ("none", 0, 1, 5)], "k string, m long, c int, n long")
    got = {(r.k, r.required): (r.n, r.cal) for r in masks.all_requests(masks.lattice(df, ["k"]), ["k"]).collect()}
    assert len(got) == 3 * 8192
    for required in [0, 240, 16, 8191, 8191 - 240, *(rnd.randrange(8192) for _ in range(400))]:
        for k in "ab":
            rest, group = required & ~240, required & 240
            hit = [(c, n) for key, m, c, n in rows if key == k and m & rest == rest and m & group]
            assert got[k, required] == (sum(n for _, n in hit), sum(n for c, n in hit if c))
    assert all(got["none", r] == (0, 0) for r in (0, 16, 240, 8191))


def test_spend_ranges_by_running_sums(spark):
    spend = {day("2026-05-01"): 5, day("2026-05-03"): 7, day("2026-05-09"): 1}
    daily = spark.createDataFrame([("CO", d, n) for d, n in spend.items()] + [("CO", None, 99)], "country string, day date, spend long")
    spans = [
        ("2026-05-01", "2026-05-09", 13), ("2026-05-02", "2026-05-03", 7), ("2026-05-04", "2026-05-08", 0), ("2026-04-01", "2026-04-30", 0),
        ("2026-05-10", "2027-05-10", 0), ("0001-01-01", "9999-12-31", 13), ("2026-05-03", "2026-05-01", 0), (None, "2026-05-09", 0), ("2026-05-09", None, 0),
    ]
    ranges = [("CO", i, day(a) if a else None, day(b) if b else None) for i, (a, b, _) in enumerate(spans)] + [("MX", 0, day("2026-05-01"), day("2026-05-09"))]
    df = spark.createDataFrame(ranges, "country string, i int, `from` date, `to` date")
    out = {(r.country, r.i): r.spend for r in targets.range_sum_spend(df, daily, ["i"]).collect()}
    assert out == {("CO", i): n for i, (_, _, n) in enumerate(spans)} | {("MX", 0): 0}


def test_sheet_file_keeps_order_line_breaks_and_wide_rows(spark, tmp_path):
    from funnelloom.sources.target_sheet import read_sheet_csv, write_sheet_csv

    rows = [("CO", 1, ["Metas Semanales"]), ("CO", 2, ["1", 'two\nlines, "quoted"', "04/05/2026", "", "10/05/2026"] + ["x"] * 20), ("CO", 3, ["2"])]
    sheet = spark.createDataFrame(rows, "country string, row_no long, cells array<string>")
    write_sheet_csv(sheet, f"{tmp_path}/sheet")
    back = sorted(read_sheet_csv(spark, f"{tmp_path}/sheet", "CO").collect(), key=lambda r: r.row_no)
    for r, (_, _, cells) in zip(back, rows):
        assert r.cells[: len(cells)] == cells and not any(r.cells[len(cells) :])
