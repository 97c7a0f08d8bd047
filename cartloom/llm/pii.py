"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust a score.

Everything is a column expression: one pass over the texts, no shuffle, no Python in the tasks.

Cases: a null text is an empty text, without spans. A text without a match gives empty lists and
strings. Repeated rows are treated one by one, and nothing depends on other columns, so a null id
or additional columns of any name change nothing. Very long texts are scanned in linear time: every
pattern is possessive or of bounded length, starts only where a run starts (or where the last match ended), and positions
are summed up in blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Test = Callable[[Column], Column]


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    pattern   what proposes a span
    test      what confirms it, from the matched text
    base      score of a confirmed span before its surroundings are looked at
    context   words that raise the score by `lift` if they stand in the text before the span
    always    True: a confirmed span is kept whatever its score
    """

    name: str
    pattern: str
    test: Test
    base: float
    context: str
    lift: float = 0.3
    always: bool = False


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number (country, check digits, account) has remainder 1 modulo 97."""
    turned = F.concat(F.substring(code, 5, 1000), F.substring(code, 1, 4))
    values = F.transform(
        F.filter(F.split(turned, ""), lambda c: c != ""),
        lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(
        values, F.lit(0), lambda acc, v: (F.when(v > 9, acc * 100).otherwise(acc * 10) + v) % 97
    )
    return rest == 1


def _email(match: Column) -> Column:
    return F.lit(True)


def _ip(match: Column) -> Column:
    return match.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|\z)){4}")


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(16, 19) & luhn(digits)


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


def _iban(match: Column) -> Column:
    code = F.replace(match, F.lit(" "), F.lit(""))
    return F.length(code).between(15, 34) & mod97(code)


def _national(match: Column) -> Column:
    return ~match.rlike(r"\A(?:000|666|9)|\A...-00|0000\z")


#: Lengths of account numbers by country: the registry, and countries that use the form without being in it.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(c for codes in IBAN_COUNTRIES.values() for c in codes.split())
#: A number ends where its country says, whatever follows a space; its single spaces may stand anywhere. Other
#: countries' numbers may have any length, but reach into no number of these countries.
_IBAN_PATTERN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"
    + "".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}|" for n, codes in IBAN_COUNTRIES.items())
    + rf"(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:(?:\x20(?!(?:{_KNOWN})[0-9]{{2}}))?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])"
)

#: The first four are kept whenever their test confirms them; the others also need their score.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         _email, 0.9, r"(?i)\b(?:e-?mail|contact|write|schreib|correo|courriel)", 0.1, True),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         _ip, 0.6, r"(?i)\b(?:ip|host|server|address|adresse)", 0.3, True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         _card, 0.7, r"(?i)\b(?:card|visa|credit|karte|carte|tarjeta)", 0.3, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         _phone, 0.6, r"(?i)\b(?:phone|call|tel|mobile|fax|anruf|appel)", 0.3, True),
    Kind("iban", _IBAN_PATTERN,
         _iban, 0.7, r"(?i)\b(?:iban|account|konto|compte|cuenta)"),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         _national, 0.3, r"(?i)\b(?:ssn|social security|national id)"),
)
BASE = tuple(k.name for k in KINDS if k.always)

#: A span of a kind that isn't always kept needs this score; its surroundings are so many code points before it.
LEAST_SCORE, NEARBY = 0.5, 40
_BLOCK = 256


def running_totals(numbers: Column, combine=lambda a, b: a + b) -> Column:
    """Sums of all earlier elements (0 first), or another such combination of numbers from 0 up. Made in blocks, so
    that copying stays small on long arrays."""

    def within(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("sums"))
        return F.aggregate(
            values, start,
            lambda acc, v: F.struct(combine(acc["total"], v).alias("total"), F.concat(acc["sums"], F.array(acc["total"])).alias("sums")),
        )

    count = F.size(numbers)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest((count - 1) / _BLOCK, F.lit(0)).cast("int")),
        lambda b: within(F.slice(numbers, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    starts = within(F.transform(blocks, lambda b: b["total"]))["sums"]
    return F.flatten(F.zip_with(blocks, starts, lambda b, s: F.transform(b["sums"], lambda v: combine(v, s))))


def _proposals(text: Column, kind: Kind) -> tuple[Column, Column]:
    return F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)


def _steps(found: Column, gaps: Column) -> Column:
    return F.zip_with(gaps, found, lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("long"))


def _spans(found: Column, gaps: Column, steps: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind from its matches, the text pieces between them and the lengths of both."""
    before = running_totals(steps)

    def nearby(gap: Column, i: Column) -> Column:
        """The text before match i: its gap after the earlier matches and gaps that can reach so far (a match has two code points at least)."""
        many = NEARBY // 2
        first, count = F.greatest(i - many, F.lit(0)) + 1, F.least(i, F.lit(many))
        earlier = F.zip_with(F.slice(gaps, first, count), F.slice(found, first, count), lambda g, m: F.concat(g, m))
        return F.right(F.concat(F.array_join(earlier, ""), gap), F.lit(NEARBY))

    parts = F.zip_with(
        F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("match"), g.alias("gap"))), before,
        lambda x, start: F.struct(x["match"].alias("match"), x["gap"].alias("gap"), (start + F.length(x["gap"])).alias("start")),
    )
    spans = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(kind.name).alias("kind"),
            x["start"].alias("start"),
            (x["start"] + F.length(x["match"])).alias("end"),
            F.when(x["match"].isNotNull() & kind.test(x["match"]),
                   kind.base + F.when(nearby(x["gap"], i).rlike(kind.context), kind.lift).otherwise(0.0)
                   ).cast("double").alias("score"),
        ),
    )
    least = 0.0 if kind.always else LEAST_SCORE
    return F.filter(spans, lambda s: s["score"] >= least)


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """`docs` with `out`: all personal data in `text` as structs (kind, start, end, score).

    Positions count code points from 0, ends are exclusive. Order: kind as in KINDS, then start. Spans of
    one kind never overlap; spans of different kinds may.
    """
    # A text without any of these signs has no proposal; one cheap scan spares it the others.
    signs = F.col(text).rlike(r"@|[0-9][\x20-]?[0-9]|[0-9]\.[0-9]|\+[0-9]")
    names = [f"__pii_{k.name}" for k in KINDS]
    found = docs.withColumns({
        f"{n}_{part}": F.when(signs, column)
        for n, k in zip(names, KINDS, strict=True)
        for part, column in zip(("found", "gaps"), _proposals(F.col(text), k), strict=True)
    })
    # A column of its own, as the sums look its elements up block by block.
    found = found.withColumns({f"{n}_steps": _steps(F.col(f"{n}_found"), F.col(f"{n}_gaps")) for n in names})
    empty = F.array().cast(SPAN_TYPE)
    lists = found.withColumns({
        n: F.when(F.size(f"{n}_found") > 0, _spans(F.col(f"{n}_found"), F.col(f"{n}_gaps"), F.col(f"{n}_steps"), k)).otherwise(empty)
        for n, k in zip(names, KINDS, strict=True)
    })
    return lists.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], F.concat(*names).alias(out))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(docs: DataFrame, text: str, spans: str) -> DataFrame:
    """`docs` with every span of `text` replaced by its kind in brackets; overlapping spans become one, named by the first.

    A text with n spans is cut into about sqrt(n) sections and these into pieces, so no piece is looked for from
    the text's start. Each step is a column of its own, as the next one looks its elements up one by one.
    """
    ordered = F.array_sort(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind"))
    ))
    steps = docs.withColumn("__pii_order", ordered)
    steps = steps.withColumn("__pii_ends", F.transform("__pii_order", lambda s: -s["less"]))
    steps = steps.withColumn("__pii_reached", running_totals(F.col("__pii_ends"), F.greatest))
    # A cut ends past all earlier spans; `last` is where the text before it starts.
    cuts = F.filter(
        F.zip_with("__pii_order", "__pii_reached", lambda s, last: F.struct(
            last.alias("last"), F.greatest(s["start"], last).alias("from"), (-s["less"]).alias("to"),
            F.when(s["start"] < last, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("label"),
        )),
        lambda c: c["to"] > c["last"],
    )
    steps = steps.withColumn("__pii_cuts", cuts)
    steps = steps.withColumn("__pii_each", F.greatest(F.ceil(F.sqrt(F.size("__pii_cuts").cast("double"))), F.lit(1)).cast("int"))
    each, count = F.col("__pii_each"), F.size("__pii_cuts")
    numbers = F.sequence(F.lit(0), F.greatest(F.floor((count - 1) / each), F.lit(0)).cast("int"))
    steps = steps.withColumn("__pii_blocks", F.transform(numbers, lambda b: F.slice("__pii_cuts", b * each + 1, each)))

    def between(whole: Column, first: Column, end: Column) -> Column:
        return whole.substr((first + 1).cast("int"), (end - first).cast("int"))

    steps = steps.withColumn("__pii_sections", F.transform("__pii_blocks", lambda c: F.struct(
        c.alias("cuts"), F.get(c, F.lit(0))["last"].alias("begin"),
        between(F.col(text), F.get(c, F.lit(0))["last"], F.get(c, F.size(c) - 1)["from"]).alias("text"),
    )))
    pieces = F.transform("__pii_sections", lambda x: F.array_join(F.transform(
        x["cuts"], lambda c: F.concat(between(x["text"], c["last"] - x["begin"], c["from"] - x["begin"]), c["label"])
    ), ""))
    tail = F.col(text).substr((F.get("__pii_cuts", count - 1)["to"] + 1).cast("int"), F.length(text))
    clean = steps.withColumn(text, F.when(count > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col(text)))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with personal data in `text` masked (a null text stays null)."""
    clean = mask(find_spans(docs, text, "__pii_spans"), text, "__pii_spans")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, digest of the base spans, all spans."""
    slim = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = find_spans(slim).select("doc_id", "spans")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda name: name == F.lit(k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *counts,
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
