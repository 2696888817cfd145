"""Eligibility flags, masks and what they say about groups of leads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelloom.functions.text import eligible_state, normalise_text, safe_cast_int
from funnelloom.operators.joins import left_join_spread
from funnelloom.spec import (
    ALL_ON,
    BLOCKED_OWNERS,
    CONDITIONAL_OWNERS,
    EXCLUDED_RATINGS,
    FLAGS_13,
    GAP_BUCKETS,
    GAP_OTHER,
    OTHER_MASK,
    OWNER_STEM,
    SHARED_MAILBOX_WORDS,
    STATE_MASK,
)


def _flag(test: Column) -> Column:
    """1 where the test holds, 0 where it fails or is unknown."""
    return F.when(test, 1).otherwise(0)


def ever_owner() -> Column:
    return F.col("first_assigned_at").isNotNull() | F.col("owner_id").isNotNull()


def owner_flag(owner_email: Column) -> Column:
    """An owner outside the company, or none, fails."""
    return _flag(F.lower(owner_email).like(f"%{OWNER_STEM}%"))


def lead_flags() -> dict[str, Column]:
    """The four flags that a lead row decides alone. A missing or unreadable listing
    and a missing rating pass."""
    listing = safe_cast_int(F.col("listing"))
    return {
        "pf_state": _flag(eligible_state(F.col("state_text"))),
        "pf_priced": _flag(F.col("priced") == 1),
        "pf_listing": _flag(listing.isNull() | (listing == 0)),
        "pf_rating": _flag(~normalise_text(F.col("rating"), underscores=False).isin(*EXCLUDED_RATINGS)),
    }


def pack_bitmask(flags: Sequence[Column]) -> Column:
    """Flag i with weight 2^i."""
    out = F.lit(0).cast("long")
    for i, flag in enumerate(flags):
        out = out + F.shiftleft(flag.cast("long"), i)
    return out


def attribute_first_failure(flags: Sequence[Column], labels: Sequence[str] = GAP_BUCKETS, other: str = GAP_OTHER) -> Column:
    """Label of the first rule that fails, in priority order."""
    out = None
    for flag, label in zip(flags, labels):
        out = F.when(flag == 0, F.lit(label)) if out is None else out.when(flag == 0, F.lit(label))
    return out.otherwise(F.lit(other))


def resolve_owner(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner e-mail by id, compared as text; the raw id where there is none."""
    names = owners.where(F.col("secondary_id").isNotNull()).select(
        F.col("secondary_id").cast("string").alias("owner_id"), "email"
    )
    joined = left_join_spread(rows, names, on=("owner_id",), nullable="owner_id")
    return joined.withColumn("owner_email", F.lower(F.coalesce("email", "owner_id"))).drop("email")


# --- thirteen rules ------------------------------------------------------------------
def eligibility_flags_13() -> dict[str, Column]:
    """Rules F3 to F15 over rows that carry the owner e-mail, the deal state and whether
    there is a contact, a passing rating, a price check, a lead date and a lead. F15 has
    no source and always passes."""
    owner = F.col("owner_email")
    shared = F.lit(False)
    for word in SHARED_MAILBOX_WORDS:
        shared = shared | owner.like(f"%{word}%")
    state = F.col("deal_state")
    flags = (
        owner.like(f"%{OWNER_STEM}%"),
        ~shared,
        ~owner.isin(*BLOCKED_OWNERS),
        ~owner.isin(*CONDITIONAL_OWNERS) | F.col("has_contact"),
        state == "sin pricing incial",
        state == "no gestionado",
        state == "cierre",
        state == "no hay suficientes datos para comparar",
        F.col("rating_ok"),
        F.col("price_ok"),
        F.col("dated"),
        F.col("has_lead"),
        F.lit(True),
    )
    return {name: _flag(test) for name, test in zip(FLAGS_13, flags)}


def passes_all(mask: Column, required: int) -> Column:
    return mask.bitwiseAND(F.lit(required)) == required


def passes_grouped(mask: Column, required: int, group: int = STATE_MASK, rest: int = OTHER_MASK) -> Column:
    """All required bits outside the group and at least one required bit inside; a
    request without any group bit admits nothing."""
    need_all, need_one = required & rest, required & group
    if need_one == 0:
        return F.lit(False)
    return (mask.bitwiseAND(F.lit(need_all)) == need_all) & (mask.bitwiseAND(F.lit(need_one)) != 0)


def mask_universe(masks: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    return masks.where(passes_all(F.col("m"), required)).groupBy(*keys).agg(F.sum("n").alias("n"))


def mask_universe_grouped_or(masks: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    kept = F.sum(F.when(passes_grouped(F.col("m"), required), F.col("n")).otherwise(0))
    return masks.groupBy(*keys).agg(kept.alias("n"))


def mask_marginal_effect(masks: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    """Change of the universe when one filter is flipped, for every filter, from a
    single pass over the mask table."""
    return marginal_rows(marginal_sums(masks, keys, required), keys, required)


def marginal_sums(masks: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    """The universe and the one after each flip, side by side."""

    def universe(req: int) -> Column:
        return F.sum(F.when(passes_grouped(F.col("m"), req), F.col("n")).otherwise(0))

    return masks.groupBy(*keys).agg(
        universe(required).alias("base"),
        *[universe(required ^ (1 << i)).alias(name) for i, name in enumerate(FLAGS_13)],
    )


def marginal_rows(wide: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    """One row per filter."""
    rows = [
        F.struct(
            F.lit(name).alias("filter"),
            F.lit(bool(required & (1 << i))).alias("active"),
            F.col("base").alias("base"),
            F.col(name).alias("flipped"),
        )
        for i, name in enumerate(FLAGS_13)
    ]
    return wide.select(*keys, F.inline(F.array(*rows))).withColumn(
        "delta", F.col("flipped") - F.col("base")
    )


def mask_qualified_rate(masks: DataFrame, keys: Sequence[str], required: int, reference: int = ALL_ON) -> DataFrame:
    """Qualified share in the chosen universe and in the reference one; an empty
    universe has share 0."""

    def total(req: int, qualified: bool) -> Column:
        test = passes_grouped(F.col("m"), req)
        if qualified:
            test = test & (F.col("c") == 1)
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    sums = masks.groupBy(*keys).agg(
        total(required, True).alias("cal"),
        total(required, False).alias("total"),
        total(reference, True).alias("cal_ref"),
        total(reference, False).alias("total_ref"),
    )

    def rate(a: str, b: str) -> Column:
        share = F.col(a).cast("double") / F.col(b).cast("double")
        return F.when(F.col(b) > 0, share).otherwise(F.lit(0.0))

    return sums.select(
        *keys, "cal", "total", "cal_ref", "total_ref",
        rate("cal", "total").alias("rate"), rate("cal_ref", "total_ref").alias("rate_ref"),
    )


# --- one table for every request -------------------------------------------------------
def lattice(masks: DataFrame, keys: Sequence[str], bits: int = len(FLAGS_13), group: int = STATE_MASK) -> DataFrame:
    """Per group of ``keys`` one array ``total`` and one ``cal`` (qualified rows) that answer
    all ``2 ** bits`` requests by two look-ups each.

    A bit outside the OR group asks for itself: entry m holds the sum over all masks that
    have at least m's bits there (superset sums). A bit inside the group is asked for in
    company: entry m holds the sum over masks with no group bits beyond m's (subset sums),
    so that the rows with none of the wanted ones can be taken off. Each bit is one pass
    over the array of a group; rows are shuffled once, to be counted by mask.
    """
    per_mask = masks.groupBy(*keys, "m").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("c") == 1, F.col("n")).otherwise(0)).alias("c"))
    # At most 2 ** bits masks are left per group, so the list is bounded.
    lists = per_mask.groupBy(*keys).agg(F.collect_list(F.struct("m", "n", "c")).alias("__rows"))
    out = lists
    for name, field in (("total", "n"), ("cal", "c")):
        by_mask = F.map_from_entries(F.transform("__rows", lambda r: F.struct(r["m"].cast("int"), r[field])))
        out = out.withColumn(f"__{name}", by_mask)
    places = F.sequence(F.lit(0), F.lit((1 << bits) - 1))
    for name in ("total", "cal"):
        out = out.withColumn(name, F.transform(places, lambda m: F.coalesce(F.col(f"__{name}")[m], F.lit(0).cast("long"))))
    out = out.select(*keys, "total", "cal")
    for i in range(bits):
        inside = bool(group >> i & 1)
        for name in ("total", "cal"):
            out = out.withColumn(name, _summed(name, 1 << i, inside))
    return out


def _summed(name: str, bit: int, inside: bool) -> Column:
    """One bit's pass: entries without it take those with it, or the other way round."""

    def entry(value: Column, m: Column) -> Column:
        has = m.bitwiseAND(F.lit(bit)) != 0
        other = F.get(F.col(name), m.bitwiseXOR(F.lit(bit)))
        return F.when(has if inside else ~has, value + other).otherwise(value)

    # The array is named twice, so every pass is a projection of its own.
    return F.when(F.size(name) > 0, F.transform(name, entry))


def answer(name: str, required: Column | int, group: int = STATE_MASK) -> Column:
    """Rows that pass a request, from the lattice column ``total`` or ``cal``."""
    need = F.lit(required) if isinstance(required, int) else required
    rest = need.bitwiseAND(F.lit(~group))
    barred = F.lit(group).bitwiseAND(F.bitwise_not(need))
    return F.get(F.col(name), rest.bitwiseOR(F.lit(group))) - F.get(F.col(name), rest.bitwiseOR(barred))


def all_requests(table: DataFrame, keys: Sequence[str], bits: int = len(FLAGS_13)) -> DataFrame:
    """Every request of every group: ``required, n, cal``."""
    wanted = table.withColumn("required", F.explode(F.sequence(F.lit(0), F.lit((1 << bits) - 1))))
    return wanted.select(*keys, "required", answer("total", F.col("required")).alias("n"), answer("cal", F.col("required")).alias("cal"))


def marginal_from_lattice(table: DataFrame, keys: Sequence[str], required: int) -> DataFrame:
    """Change of the universe by flipping each filter, by look-ups alone."""
    flips = {name: answer("total", required ^ (1 << i)).alias(name) for i, name in enumerate(FLAGS_13)}
    return marginal_rows(table.select(*keys, answer("total", required).alias("base"), *flips.values()), keys, required)
