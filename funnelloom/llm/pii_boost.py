"""Personal data by candidates, boosted trees over them, and calibrated thresholds.

Everything that a document goes through is a Spark expression on its own row: no shuffle,
no Python, and a long document holds up nobody but its own task.

1. *Base spans*: four patterns, leftmost and not overlapping per kind, with their tests
   (parts of an address, digits of a number, Luhn). They always stay.
2. *Candidates*, with high recall: digits and the marks between them form maximal runs; all
   stretches of up to ``GROUPS`` digit groups of a run are proposed, as phone number, card
   or address as far as their digits allow, overlapping as they please. A greedy pattern
   takes a run as a whole and drops it if two numbers stand side by side; the stretches
   still hold both. Mail addresses are proposed with spaced or spelled-out signs too.
3. *Features* of format (digits, groups, marks, Luhn, first digits) and context (marks and
   words around, what else the run holds, base spans of other kinds), all small integers.
4. *Boosted trees* are fitted on laid-out texts with known spans (``TEXTS`` of them, from
   one seed) that go through the same candidates and features; a third of the texts is left
   out of the fit and gives each kind the lowest threshold with the asked precision.
5. Candidates above their threshold that don't overlap a base span of their kind are taken
   best first, as long as they don't overlap each other.

Positions are code points, ends exclusive. Defined results: a null text is empty and has
no span; repeated rows are rows of their own; equal scores go to the earlier start, then
the longer stretch; a null ``doc_id`` and clashing column names do no harm; runs are never
cut, whatever the length of a text. The patterns are possessive, so they take one pass.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelloom.llm import boosting

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
GROUPS = 8  # digit groups in a proposed number
CONTEXT = 24  # code points before a span that are searched for words
TEXTS = 4_000  # laid-out training texts
PRECISION = 0.995
SEED = 13

# What a run may start at is said by looking back, so that no start is tried twice.
EMAIL_PATTERN = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP_PATTERN = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD_PATTERN = r"[0-9](?:[ -]?[0-9])++"
RUN_PATTERN = r"\+?[0-9](?:[ ().-]*+[0-9])*+"
LOOSE_EMAIL = (
    r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++ ?(?:@|\[at\]|\(at\)|(?<= )at(?= )) ?"
    r"[\p{L}0-9-]++(?: ?(?:\.(?! )|\[dot\]|\(dot\)|(?<= )dot(?= )) ?[\p{L}0-9-]++)++"
)
_WORDS = {  # words before a number that speak for a kind, or against all
    1: r"(?i)(?:phone|tel|call|mobile|fax|whatsapp)\b[^\p{L}]*$",
    2: r"(?i)(?:card|visa|mastercard|amex|payment)\b[^\p{L}]*$",
    3: r"(?i)(?:ip|host|server|address|from)\b[^\p{L}]*$",
    4: r"(?i)(?:order|isbn|version|ref|invoice|serial|sku|id|no|part|total|section|release)\b[^\p{L}]*$",
    5: r"(?i)(?:mail|email|e-mail|contact|write to)\b[^\p{L}]*$",
}


def _running(sizes: Column) -> Column:
    """Running sums of an array of ints, in blocks so that long arrays stay cheap.

    ``sizes`` must be a plain column or field: it is named more than once.
    """
    block = 256
    zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    within = lambda part: F.aggregate(
        part,
        zero,
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"] + x)).alias("out")),
        lambda a: a["out"],
    )
    last = F.floor(F.greatest(F.size(sizes) - 1, F.lit(0)) / block).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda b: within(F.slice(sizes, b * block + 1, F.lit(block))))
    return F.aggregate(
        parts,
        zero,
        lambda a, part: F.struct(
            (a["sum"] + F.coalesce(F.try_element_at(part, F.lit(-1)), F.lit(0))).alias("sum"),
            F.concat(a["out"], F.transform(part, lambda x: x + a["sum"])).alias("out"),
        ),
        lambda a: a["out"],
    )


def _found(df: DataFrame, name: str, text: str, pattern: str, wanted: Column) -> DataFrame:
    """Adds ``name``: all matches as ``at, end, hit, before, after``, empty where not ``wanted``."""
    none = F.array().cast("array<string>")
    hits, gaps, sizes = f"{name}_hits", f"{name}_gaps", f"{name}_sizes"
    df = df.withColumn(hits, F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, pattern)).otherwise(none))
    zipped = F.arrays_zip(F.col(hits).alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"))
    df = df.withColumn(sizes, F.transform(zipped, lambda z: F.length(z["hit"]) + F.length(z["gap"])))
    rows = F.arrays_zip(
        F.col(hits).alias("hit"),
        F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"),
        F.slice(gaps, F.lit(2), F.size(hits)).alias("rest"),
        _running(F.col(sizes)).alias("end"),
    )
    made = F.transform(
        rows,
        lambda z: F.struct(
            (z["end"] - F.length(z["hit"])).alias("at"), z["end"].alias("end"), z["hit"].alias("hit"),
            F.substring(z["gap"], -CONTEXT, CONTEXT).alias("before"), F.substring(z["rest"], 1, 2).alias("after"),
        ),
    )
    return df.withColumn(name, F.when(F.size(hits) > 0, made)).drop(hits, gaps, sizes)


def _inside(run: Column, pattern: str) -> Column:
    """Matches inside a run: ``at, end, hit`` from its start."""
    hits, gaps = F.regexp_extract_all(run, F.lit(pattern), F.lit(0)), F.split(run, pattern)
    zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<struct<at:int,end:int,hit:string>>").alias("out"))

    def step(a: Column, z: Column) -> Column:
        at = a["sum"] + F.length(z["gap"])
        end = at + F.length(z["hit"])
        return F.struct(end.alias("sum"), F.concat(a["out"], F.array(F.struct(at.alias("at"), end.alias("end"), z["hit"].alias("hit")))).alias("out"))

    zipped = F.arrays_zip(hits.alias("hit"), gaps.alias("gap"))
    return F.aggregate(F.filter(zipped, lambda z: z["hit"].isNotNull()), zero, step, lambda a: a["out"])


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(k: Column) -> Column:
        d = F.substring(digits, k, F.lit(1)).cast("int")
        return F.when((n - k) % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, k: a + worth(k)) % 10 == 0


def _octets(c: Column) -> Column:
    """Four parts of at most 255, whatever zeros lead them."""
    return F.forall(F.split(c, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        F.split(c, r"\."), lambda p: F.coalesce(F.expr("0") + F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int"), F.lit(0)) <= 255
    )


def _base(df: DataFrame) -> DataFrame:
    """Adds ``mails`` and ``runs`` with their base spans; everything is found inside the runs."""
    df = _found(df, "mails", "text", EMAIL_PATTERN, F.contains("text", F.lit("@")))
    df = _found(df, "spots", "text", RUN_PATTERN, F.col("text").rlike("[0-9]"))
    long_enough = F.filter("spots", lambda r: F.length(r["hit"]) >= 7)  # the shortest address has seven

    def based(r: Column) -> Column:
        n = F.length(_digits(r["hit"]))
        none = F.array().cast("array<struct<at:int,end:int,hit:string>>")
        ips = F.when(r["hit"].rlike(IP_PATTERN), F.filter(_inside(r["hit"], IP_PATTERN), lambda m: _octets(m["hit"]))).otherwise(none)
        cards = F.filter(_inside(r["hit"], CARD_PATTERN), lambda m: F.length(_digits(m["hit"])).between(13, 19))
        cards = F.when(n >= 13, F.filter(cards, lambda m: _luhn(_digits(m["hit"])))).otherwise(none)
        phone = F.startswith(r["hit"], F.lit("+")) & n.between(9, 15)
        return F.struct(
            r["at"].alias("at"), r["hit"].alias("run"), r["before"].alias("before"), r["after"].alias("after"), n.alias("n"),
            ips.alias("ips"), cards.alias("cards"), phone.alias("phone"),
        )

    return df.withColumn("runs", F.transform(long_enough, based)).drop("spots")


def _span(kind: int, at: Column, end: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"), end.cast("int").alias("end"))


def _base_spans() -> Column:
    """All base spans in order of kind and start."""
    none = F.array().cast("array<struct<kind:int,at:int,end:int>>")
    mails = F.transform("mails", lambda m: _span(EMAIL, m["at"], m["end"]))
    of = lambda kind, field: F.flatten(
        F.transform("runs", lambda r: F.transform(r[field], lambda m: _span(kind, r["at"] + m["at"], r["at"] + m["end"])))
    )
    phones = F.transform(F.filter("runs", lambda r: r["phone"]), lambda r: _span(PHONE, r["at"], r["at"] + F.length(r["run"])))
    return F.concat(*[F.coalesce(x, none) for x in (mails, of(IP, "ips"), of(CARD, "cards"), phones)])


def _mark(c: Column) -> Column:
    """Class of the character next to a stretch."""
    return (
        F.when(c.isNull() | (c == "") | c.rlike(r"^\s$"), 0).when(c.rlike(r"^\p{L}$"), 1).when(c.rlike("^[=:#]$"), 3)
        .when(c.rlike(r"^[,.;!?()\[\]\"']$"), 4).otherwise(5)
    )


def _word_class(before: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for number, pattern in _WORDS.items():
        out = out.when(before.rlike(pattern), number)
    return out.otherwise(0)


def _overlaps(spans: Column, at: Column, end: Column) -> Column:
    return F.exists(spans, lambda m: (m["at"] < end) & (m["end"] > at))


NUMBER_FEATURES = (
    "kind", "digits", "groups", "luhn", "lead", "first group", "last group", "longest group", "marks", "mark before",
    "mark after", "word", "other base span", "digits of the run before", "digits of the run after", "first digit", "shape",
)
MAIL_FEATURES = ("at sign", "dot", "last label", "labels", "local size", "other letters", "word", "digits", "last label of letters", "mark after")


def _number_candidates(r: Column) -> Column:
    """Stretches of a run's digit groups as ``kind, at, end, f``; places from the text's start."""
    digits, marks = F.regexp_extract_all(r["run"], F.lit("[0-9]+"), F.lit(0)), F.split(r["run"], "[0-9]+")
    group = "struct<d:string,mark:string,at:int,seen:int,ip:boolean,card:boolean>"
    zero = F.struct(*[F.lit(0).alias(c) for c in ("sum", "seen", "ip", "card")], F.array().cast(f"array<{group}>").alias("out"))

    def step(a: Column, z: Column) -> Column:
        """Base spans are made of whole groups and come in order, so two places in their lists do."""
        at, n = a["sum"] + F.length(z["mark"]), F.length(z["d"])
        past = {c: F.when(F.get(r[f"{c}s"], a[c])["end"] <= at, a[c] + 1).otherwise(a[c]) for c in ("ip", "card")}
        inside = {c: F.coalesce(F.get(r[f"{c}s"], k)["at"] <= at, F.lit(False)) for c, k in past.items()}
        one = F.struct(
            z["d"].alias("d"), z["mark"].alias("mark"), at.alias("at"), a["seen"].alias("seen"), inside["ip"].alias("ip"), inside["card"].alias("card")
        )
        return F.struct(
            (at + n).alias("sum"), (a["seen"] + n).alias("seen"), past["ip"].alias("ip"), past["card"].alias("card"),
            F.concat(a["out"], F.array(one)).alias("out"),
        )

    zipped = F.filter(F.arrays_zip(digits.alias("d"), marks.alias("mark")), lambda z: z["d"].isNotNull())
    groups = F.aggregate(zipped, zero, step, lambda a: a["out"])
    # The groups as a one-element array: computed once, then named as often as need be.
    return F.flatten(F.transform(F.array(groups), lambda g: _stretches(r, g)))


def _stretches(r: Column, groups: Column) -> Column:
    top = F.size(groups) - 1

    def of(i: Column, k: Column, few: Column) -> Column:
        """Groups i to i + k; ``few`` holds group i and those after it."""
        part, first, last = F.slice(few, F.lit(1), k + 1), F.get(few, F.lit(0)), F.get(few, k)
        between = F.array_join(F.transform(F.slice(few, F.lit(2), k), lambda x: x["mark"]), "|")
        end = last["at"] + F.length(last["d"])
        before = F.when(i == 0, F.substring(r["before"], -1, 1)).otherwise(F.lit(None))
        return F.struct(
            i.alias("i"), F.array_join(F.transform(part, lambda x: x["d"]), "").alias("d"), part.alias("part"),
            between.alias("between"), first["at"].alias("at"), end.alias("end"),
            F.when(F.endswith(first["mark"], F.lit("+")), 1)
            .when(F.endswith(first["mark"], F.lit("(")) | (before == "("), 2).otherwise(0).alias("lead"),
            F.when(i > 0, 2).otherwise(_mark(before)).alias("left"),
            F.when(i + k < top, 2).otherwise(_mark(F.substring(r["after"], 1, 1))).alias("right"),
        )

    def begun(i: Column) -> Column:
        # Single look-ups: a slice of the whole list would copy it for every stretch.
        few = F.array(*[F.get(groups, i + k) for k in range(GROUPS)])
        sizes = F.sequence(F.lit(0), F.least(top - i, F.lit(GROUPS - 1)))
        return F.flatten(F.transform(F.array(few), lambda e: F.transform(sizes, lambda k: of(i, k, e))))

    spans = F.flatten(F.transform(F.sequence(F.lit(0), top), begun))
    dotted = r"^\.\|\.\|\.$"
    likely = F.filter(spans, lambda s: F.length(s["d"]).between(7, 19) | s["between"].rlike(dotted))

    def kinds(s: Column) -> Column:
        n, size = F.length(s["d"]), F.size(s["part"])
        longest = F.array_max(F.transform(s["part"], lambda x: F.length(x["d"])))
        shape = F.array_join(F.transform(s["part"], lambda x: F.length(x["d"]).cast("string")), "")
        shape = (
            F.when(shape.rlike("^[0-9]?334$"), 1).when(shape.rlike("^(4444|465|16|15)$"), 2).when(shape.rlike("^[1-4]?(23|33|34|222|322|333|2222|3333|44|332|333?4)$"), 3)
            .when(shape.rlike("^1+$"), 4).otherwise(0)
        )
        rest_before = F.get(s["part"], F.lit(0))["seen"]
        in_ip, in_card = F.exists(s["part"], lambda x: x["ip"]), F.exists(s["part"], lambda x: x["card"])
        marks = F.when(s["between"] == "", 0).when(s["between"].rlike(r"^([ .-])(\|\1)*$"), 1).when(s["between"].rlike(r"^[ ().|-]*$"), 2).otherwise(3)
        marks = F.when((marks == 2) & s["between"].rlike(r"[ .-]{2}|\([^|]*\||\|\|"), 3).otherwise(marks)
        few = lambda c: F.when(c == 0, 0).when(c < 7, 1).otherwise(2)
        luhn = _luhn(s["d"])

        def one(kind: int, wanted: Column, own: Column, other: Column, takes_lead: bool) -> Column:
            at, end = s["at"] - (F.when(s["lead"] > 0, 1).otherwise(0) if takes_lead else F.lit(0)), s["end"]
            f = F.array(
                F.lit(kind), n, size, F.when(luhn, 1).otherwise(0), s["lead"], F.least(F.length(F.get(s["part"], F.lit(0))["d"]), F.lit(9)),
                F.least(F.length(F.element_at(s["part"], -1)["d"]), F.lit(9)), longest, marks, s["left"], s["right"],
                F.when(s["i"] == 0, _word_class(r["before"])).otherwise(0), F.when(other, 1).otherwise(0),
                few(rest_before), few(r["n"] - rest_before - n), F.substring(s["d"], 1, 1).cast("int"), shape,
            )
            return F.when(
                wanted & ~own,
                F.struct(F.lit(kind).alias("kind"), (r["at"] + at).alias("at"), (r["at"] + end).alias("end"), f.alias("f")),
            )

        fits = F.forall(s["part"], lambda x: F.when(F.length(x["d"]) <= 3, x["d"].cast("int") <= 255).otherwise(False))
        return F.array(
            one(PHONE, n.between(7, 15), r["phone"], in_ip | in_card, True),
            one(CARD, n.between(13, 19), in_card, in_ip | r["phone"], False),
            one(IP, s["between"].rlike(dotted) & fits, in_ip, in_card | r["phone"], False),
        )

    return F.filter(F.flatten(F.transform(likely, kinds)), lambda c: c.isNotNull())


def _mail_candidates(m: Column, mails: Column) -> Column:
    hit, low = m["hit"], F.lower(m["hit"])
    local, labels = F.regexp_extract(hit, r"^[\p{L}0-9._%+-]+", 0), F.split(low, r" ?(?:\[dot\]|\(dot\)| dot |\.) ?")
    f = F.array(
        F.when(low.rlike(r" @|@ "), 1).when(low.rlike(r"\[at\]|\(at\)"), 2).when(low.rlike(" at "), 3).otherwise(0),
        F.when(low.rlike(r"\[dot\]|\(dot\)"), 1).when(low.rlike(" dot "), 2).otherwise(0),
        F.least(F.length(F.element_at(labels, -1)), F.lit(9)),
        F.least(F.size(labels), F.lit(9)),
        F.least(F.length(local), F.lit(20)),
        F.when(hit.rlike(r"[^\x00-\x7f]"), 1).otherwise(0),
        _word_class(m["before"]),
        F.least(F.length(_digits(local)), F.lit(9)),
        F.when(F.element_at(labels, -1).rlike("^[a-z]{2,}$"), 1).otherwise(0),
        _mark(F.substring(m["after"], 1, 1)),
    )
    own = F.coalesce(_overlaps(mails, m["at"], m["end"]), F.lit(False))
    return F.when(~own, F.struct(F.lit(EMAIL).alias("kind"), m["at"].alias("at"), m["end"].alias("end"), f.alias("f")))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and ``base``, ``numbers`` (a list per run) and ``addresses``."""
    df = _base(docs)
    signs = F.lit(False)
    for sign in ("@", "[at]", "(at)", " dot ", "(dot)", "[dot]"):
        signs = signs | F.contains("text", F.lit(sign))
    df = _found(df, "loose", "text", LOOSE_EMAIL, signs)
    settled = lambda r: (  # noqa: E731  one base span takes the run as a whole
        r["phone"] & (r["n"] <= 15) & (F.size(r["cards"]) == 0)
        | (F.size(r["cards"]) == 1) & (F.length(F.get(r["cards"], F.lit(0))["hit"]) == F.length(r["run"]))
        | (F.size(r["ips"]) == 1) & (F.length(F.get(r["ips"], F.lit(0))["hit"]) == F.length(r["run"]))
    )
    open_runs = F.filter("runs", lambda r: (r["n"] >= 7) & ~settled(r))
    return df.withColumns(
        {
            "base": _base_spans(),
            "numbers": F.transform(open_runs, _number_candidates),
            "addresses": F.filter(F.transform("loose", lambda m: _mail_candidates(m, F.col("mails"))), lambda c: c.isNotNull()),
        }
    ).drop("runs", "mails", "loose")


@dataclass(frozen=True)
class Model:
    """Trees for numbers and mail addresses, and the log-odds that each kind must reach."""

    numbers: boosting.Boosted
    addresses: boosting.Boosted
    limits: tuple[float, ...]

    def score(self, c: Column, numbers: bool) -> Column:
        return (self.numbers if numbers else self.addresses).column(c["f"])

    def limit(self, kind: Column) -> Column:
        out = F.when(F.lit(False), 0.0)
        for number, value in enumerate(self.limits):
            out = out.when(kind == number, F.lit(min(value, 1e9)))
        return out


def laid_out(seed: int = SEED, n: int = TEXTS) -> list[tuple[int, str, list[tuple[int, int, int]]]]:
    """Training texts ``number, text, spans`` from one seed."""
    rnd = random.Random(seed)
    digits = lambda k, low="0": "".join(rnd.choice("0123456789") for _ in range(k)).replace("0", low, 1) if k else ""
    word = lambda: "".join(rnd.choice("abcdefghilmnoprstuvwéüñ") for _ in range(rnd.randint(2, 9)))

    def card(valid: bool = True) -> str:
        body = rnd.choice("3456") + digits(rnd.choice([15, 15, 15, 14, 12, 13, 18]) - 1)
        total = sum((2 * int(d) - 9 * (int(d) > 4)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(body)))
        made = body + str((-total + (0 if valid else rnd.randint(1, 9))) % 10)
        if len(made) == 16 and rnd.random() < 0.4:
            mark = rnd.choice(" -")
            return mark.join(made[i : i + 4] for i in range(0, 16, 4))
        return made

    def phone() -> str:
        a, b, c = digits(3, "2"), digits(3, "5"), digits(4)
        return rnd.choice([
            f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"+{digits(2, '4')} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1-{a}-{b}-{c}",
            f"+{digits(2, '3')} {digits(2)} {digits(4)} {digits(4)}", f"+{digits(2, '3')}.{a}.{b}.{b}",
        ])

    address = lambda: ".".join(str(rnd.randint(1, 255)) for _ in range(4))

    def mail() -> str:
        name, host, top = word(), word(), rnd.choice(["com", "org", "net", "de", "es", "example.com"])
        if rnd.random() < 0.5:
            name += rnd.choice(["." + word(), digits(2)])
        at, dot = rnd.choice([(" @ ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("[at]", ".")])
        return name + at + host + "".join(dot + x for x in top.split("."))

    def other() -> str:
        return rnd.choice([
            lambda: card(False), lambda: card(False), lambda: f"{digits(4, '2')}-{digits(2, '1')}-{digits(2, '2')} {digits(2, '1')}:{digits(2)}",
            lambda: f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", lambda: " ".join(str(i) for i in range(1, rnd.randint(8, 24))),
            lambda: f"{digits(1)}.{digits(10)}", lambda: " ".join(digits(rnd.randint(1, 5), "1") for _ in range(rnd.randint(4, 9))),
            lambda: f"0.{digits(2)} 0.{digits(2)} 0.{digits(2)} 0.{digits(2)}", lambda: digits(rnd.randint(7, 15), "1"),
            lambda: f"{digits(3, '1')} {digits(3)} {digits(3)}", lambda: f"{digits(4, '1')}-{digits(4, '1')}", lambda: f"{digits(3)}-{digits(4)}-{digits(2)}",
            lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40)), lambda: f"{digits(4, '1')} {digits(4, '1')} {digits(4, '2')}",
            lambda: f"{word()} at {word()}.{word()} dot {word()}", lambda: f"{word()} @ {digits(1)}.{digits(2)}", lambda: f"{word()} at the dot {word()}",
            lambda: f"{digits(2)} @ {digits(2)}.{digits(2)}", lambda: f"{word()} @{word()} {word()}.{word()}", lambda: f"{word()} [at] {word()}.{digits(2)}",
        ])()

    said = {EMAIL: ("mail", "write to", "contact"), IP: ("host", "server", "ip"), CARD: ("card", "visa"), PHONE: ("phone", "tel", "call")}
    against = ("order", "isbn", "version", "ref", "invoice", "serial", "id", "total")
    make: dict[int, Callable[[], str]] = {EMAIL: mail, IP: address, CARD: card, PHONE: phone}
    out = []
    for number in range(n):
        text, spans = "".join(word() + " " for _ in range(rnd.randint(0, 5))), []
        for k in range(rnd.choice([1, 2, 2, 3])):
            # Numbers side by side take a space or stand alone; all else has words between.
            kind = rnd.choice([None, None, EMAIL, IP, CARD, CARD, PHONE, PHONE])
            glued = k and rnd.random() < 0.6
            if not glued:
                text += word() + rnd.choice([" ", ", ", ". "]) + (rnd.choice(said.get(kind, against)) + rnd.choice([" ", ": "]) if rnd.random() < 0.25 else "")
            made = other() if kind is None else make[kind]()
            if kind is not None:
                spans.append((kind, len(text), len(text) + len(made)))
            text += made + (" " if rnd.random() < 0.85 else rnd.choice([", ", ". ", "\n", "; "]))
        out.append((number, text + word(), spans))
    return out


def fit(spark: SparkSession, precision: float = PRECISION) -> Model:
    """Trees and thresholds from the laid-out texts, the same on every call."""
    texts = laid_out()
    known = [set(spans) for _, _, spans in texts]
    df = spark.createDataFrame([(i, t) for i, t, _ in texts], "number int, text string").repartition(8)
    none = F.array().cast("array<struct<kind:int,at:int,end:int,f:array<int>>>")
    lists = F.concat(F.coalesce(F.flatten("numbers"), none), F.coalesce("addresses", none))
    rows = candidates(df).select("number", F.inline(lists)).collect()

    def trees(numbers: bool, limits: list[float]) -> boosting.Boosted:
        own = sorted((r for r in rows if (r.kind != EMAIL) == numbers), key=lambda r: (r.number, r.kind, r.at, r.end))
        x = np.array([r.f for r in own], np.int64)
        y = np.array([(r.kind, r.at, r.end) in known[r.number] for r in own], float)
        held = np.array([r.number % 3 == 0 for r in own])
        model, kind = boosting.fit(x[~held], y[~held]), np.array([r.kind for r in own])
        for k in {IP, CARD, PHONE} if numbers else {EMAIL}:
            of = held & (kind == k)
            limits[k] = boosting.threshold(model.predict(x[of]), y[of], precision)
        return model

    limits = [float("inf")] * len(KINDS)
    numbers, addresses = trees(True, limits), trees(False, limits)
    return Model(numbers, addresses, tuple(limits))


def _chosen(model: Model, scored: Column) -> Column:
    """Best first, none that overlaps one taken before."""
    none = F.array().cast("array<struct<kind:int,at:int,end:int>>")
    free = lambda taken, c: ~_overlaps(taken, c["at"], c["end"])
    return F.aggregate(
        F.array_sort(scored),
        none,
        lambda taken, c: F.when(free(taken, c), F.concat(taken, F.array(F.struct(c["kind"], c["at"], (-c["back"]).alias("end"))))).otherwise(taken),
    )


def _ranked(model: Model, list_: Column, numbers: bool) -> Column:
    scored = F.transform(
        list_,
        lambda c: F.struct((-model.score(c, numbers)).alias("loss"), c["at"].alias("at"), (-c["end"]).alias("back"), c["end"].alias("end"), c["kind"].alias("kind")),
    )
    return F.filter(scored, lambda s: -s["loss"] >= model.limit(s["kind"]))


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the document as it came), ``base`` and ``spans``: lists of ``kind, at, end`` in order."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    made = candidates(rows.withColumn("text", F.coalesce("row.text", F.lit(""))))
    numbers = F.flatten(F.transform("numbers", lambda c: _chosen(model, _ranked(model, c, True))))
    none = F.array().cast("array<struct<kind:int,at:int,end:int>>")
    addresses = F.coalesce(_chosen(model, _ranked(model, F.col("addresses"), False)), none)
    added = F.concat(F.coalesce(numbers, none), addresses)
    return made.select("row", "base", F.when(F.size(added) > 0, F.array_sort(F.concat("base", added))).otherwise(F.col("base")).alias("spans"))


def _named(list_: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(list_, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"].cast("string"), s["end"].cast("string"))), ",")


def found(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, base spans per kind, the digest of all base spans, and all spans."""
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return spans(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(_named("base"), 256).alias("base_sha256"), _named("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, overlapping ones by the first."""
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["at"].alias("at"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("row.text")

    def step(a: Column, s: Column) -> Column:
        end = F.greatest(a["at"], s["end"])
        new = F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, s["at"] - a["at"]), F.get(names, s["kind"])))
        return F.struct(end.alias("at"), F.when(s["at"] >= a["at"], new).otherwise(a["out"]).alias("out"))

    made = F.aggregate(ordered, zero, step, lambda a: F.array_join(F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, F.length(text)))), ""))
    clean = F.when(F.size("spans") > 0, made).otherwise(text)
    return spans(docs, model).select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
