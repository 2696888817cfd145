"""Text clean-up, labels and number or date parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelloom.spec import (
    ELIGIBLE_STATES,
    FORM_REFERRER_PATTERN,
    FORM_URL_PATTERN,
    LEAD_FORM_CHANNEL,
    LEAD_FORM_NAMES,
    SHEET_ERRORS,
)


def case_map(key: Column, mapping: dict, default: Column | None = None) -> Column:
    """Constant lookup as one CASE expression; an unknown key gives ``default``."""
    by_value: dict = {}
    for k, v in mapping.items():
        by_value.setdefault(v, []).append(k)
    out = None
    for value, keys in by_value.items():
        test = key.isin(*keys)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(default) if default is not None else out


def label_source(source_id: Column, labels: dict[int, str], default: str | None = None) -> Column:
    return case_map(source_id, labels, F.lit(default) if default else None)


def normalise_text(c: Column, underscores: bool = True) -> Column:
    """Trimmed lower-case text, NULL as '', underscores as blanks."""
    out = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.translate(out, "_", " ") if underscores else out


def safe_cast_int(c: Column) -> Column:
    """Whole number, or NULL for any other text."""
    clean = F.trim(c)
    return F.when(clean.rlike(r"^[+-]?[0-9]+$"), clean.try_cast("bigint"))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def resolve_channel(source_name: Column, campaign: Column, medium: Column) -> Column:
    """Lead form, then "source Direct" without campaign, then the dictionary
    medium, and the raw campaign where the dictionary has none."""
    return (
        F.when(source_name.isin(*LEAD_FORM_NAMES), F.lit(LEAD_FORM_CHANNEL))
        .when(is_blank(campaign), F.concat(source_name, F.lit(" Direct")))
        .when(is_blank(medium), campaign)
        .otherwise(medium)
    )


def resolve_channel_tracked(source_name: Column, campaign: Column, medium: Column) -> Column:
    """The same for leads that are known to carry a campaign."""
    return (
        F.when(source_name.isin(*LEAD_FORM_NAMES), F.lit(LEAD_FORM_CHANNEL))
        .when(is_blank(medium), campaign)
        .otherwise(medium)
    )


def collapse_paid_direct(medium: Column, aliases: tuple[str, ...], into: str = LEAD_FORM_CHANNEL) -> Column:
    return F.when(medium.isin(*aliases), F.lit(into)).otherwise(medium)


def channel_to_source(
    medium: Column, prefixes: tuple[tuple[str, str], ...], aliases: tuple[str, ...] = ()
) -> Column:
    """Source label by channel prefix; NULL when no rule fits."""
    out = F.when(medium.isin(*aliases), F.lit(LEAD_FORM_CHANNEL)) if aliases else None
    for prefix, label in prefixes:
        test = medium.startswith(prefix)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


# Name rules used when channels of one week are merged.
RECOLLAPSE_PREFIXES = (
    ("WEB ", "WEB"),
    ("Estudio Inmueble", "Estudio Inmueble"),
    ("lead_forms", "lead_forms"),
    ("Lead Forms", "lead_forms"),
    ("Broker", "Broker"),
    ("CRM", "CRM"),
    ("Propiedades", "Propiedades"),
)


def source_from_channel_name(channel: Column) -> Column:
    out = F.when(channel == "WEB", F.lit("WEB"))
    for prefix, label in RECOLLAPSE_PREFIXES:
        out = out.when(channel.startswith(prefix), F.lit(label))
    return out.when(F.lower(channel).startswith("comercial"), F.lit("Comercial"))


def channel_group_rank(channel: Column) -> Column:
    """Display order: web, study, forms, direct, everything else."""
    return (
        F.when((channel == "WEB") | channel.startswith("WEB "), F.lit(0))
        .when(channel.startswith("Estudio Inmueble"), F.lit(1))
        .when(channel.rlike("(?i)^(lead_forms|Lead Forms)"), F.lit(2))
        .when(channel.rlike("(?i)^(Broker|CRM|comercial)"), F.lit(3))
        .otherwise(F.lit(4))
    )


def classify_traffic(url: Column, referrer: Column) -> Column:
    """Referral or direct traffic. The underscores of the pattern are LIKE wildcards."""
    referral = url.like(FORM_URL_PATTERN) | referrer.like(FORM_REFERRER_PATTERN)
    return F.when(referral, F.lit("help_to_sell")).otherwise(F.lit("web_puro"))


def state_name_fallback(
    name: Column, state_id: Column, missing: str | None = None
) -> tuple[Column, Column]:
    """Catalogue name, else ``state_<id>``, else a text for a missing state."""
    coded = F.concat(F.lit("state_"), state_id.cast("string"))
    if missing is None:
        return state_id, F.coalesce(name, coded)
    label = F.coalesce(name, F.when(state_id.isNull(), F.lit(missing)).otherwise(coded))
    return F.coalesce(state_id, F.lit(-1)), label


def eligible_state(c: Column) -> Column:
    return normalise_text(c).isin(*ELIGIBLE_STATES)


def parse_latam_number(c: Column, strip_commas: bool = False) -> Column:
    """Number with dotted thousands and an optional percent sign.

    Error marks and anything else that is not whole give NULL; a comma is either
    rejected or removed.
    """
    clean = F.trim(c)
    bare = F.regexp_replace(clean, r"%$", "")
    bare = F.translate(bare, ".,", "") if strip_commas else F.translate(bare, ".", "")
    return F.when(~clean.isin("", *SHEET_ERRORS), safe_cast_int(bare))


def parse_dmy_date(c: Column) -> Column:
    """``dd/mm/yyyy`` text, NULL when it is no such date."""
    clean = F.trim(c)
    return F.when(clean.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(clean, "d/M/yyyy"))
