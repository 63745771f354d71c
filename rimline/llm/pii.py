"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Everything is one projection of DataFrame functions, without a shuffle. For each kind the matches of a
pattern and the gaps between them give places in code points. Patterns are written so that a failed match never
looks at a run of characters twice and never recurses, whatever the length of the text.

Kinds: email; ip (parts at most 255); card (14 to 19 digits, Luhn); phone (10 to 15 digits); and, beyond
those, iban (as long as its country's, mod 97). A span's score is its kind's prior, raised if a word that goes with the kind stands
near and lowered if one that speaks against it does. Spans of the first four kinds are kept whatever their
score; an iban is kept if its check digits are right and no word speaks against it.

Defined cases: a null or empty text has no spans (an empty string, and the hash of one); rows with null
or repeated ids are scanned like any other; overlapping spans of different kinds are all kept; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import table


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A plain string without which the pattern can't match, or none.
    needs: str
    prior: float
    #: Patterns of words that go with the kind, or against it.
    friends: str
    foes: str
    base: bool = True


# Characters of an account number by the country that it begins with.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """As many letters and digits as the country's numbers have, whatever follows after a space."""
    whole = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{whole})(?![A-Za-z0-9])"


# Where a match may begin: at the start of a run of its characters, or right after the match before.
# In an email's last part, dots stand alone and between other characters.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])[A-Za-z0-9.-]+?(?=\.?(?:[^A-Za-z0-9.-]|\z)|\.\.)",
        "@",
        0.9,
        r"e-?mail|mail|contact|write|address",
        r"example",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        0.6,
        r"\bip\b|host|server|address|login|from",
        r"version|release|section|\bv\b",
    ),
    Kind(
        "card",
        r"[0-9](?=[0-9]|[\x20-][0-9])[0-9\x20-]+?(?![0-9]|[\x20-][0-9])",
        "",
        0.7,
        r"card|visa|master|credit|debit|payment|cvv",
        r"isbn|order|serial|invoice|tracking",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "+",
        0.7,
        r"phone|call|tel|mobile|fax|whatsapp",
        r"order|serial|sum|total",
    ),
    Kind(
        "iban",
        iban_pattern(),
        "",
        0.7,
        r"iban|bank|account|transfer|konto",
        r"serial|part no",
        base=False,
    ),
)

#: Code points before and after a span, up to the next match of its kind, in which words count.
REACH = 40
#: Matches whose places are summed up at a time.
BLOCK = 256
FRIEND = 0.2
FOE = -0.3
#: What a kind beyond the base needs.
LEAST_SCORE = 0.5


def _zeros_off(part: Column) -> Column:
    return F.regexp_replace(part, "^0+(?=.)", "")


def _mod97(text: Column) -> Column:
    """The remainder of an account number, its first four characters moved to the end and letters as numbers."""
    plain = F.replace(text, F.lit(" "))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code <= 57, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        # Four digits are too many, however long the part is.
        return F.forall(F.split(text, r"\."), lambda p: F.substring(_zeros_off(p), 1, 4).cast("int") <= 255)
    if kind == "card":
        digits = F.translate(text, " -", "")
        # Runs of other lengths never reach the checksum.
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(text, "[^0-9]", "")).between(10, 15)
    if kind == "iban":
        return _mod97(text) == 1
    return F.lit(True)


def _near(before: Column, after: Column) -> Column:
    """The ends of the gaps about a match that are next to it. Cut from gaps, as places in a long text take long to find."""
    return F.lower(F.concat(F.substring(before, -REACH, REACH), F.lit(" "), F.substring(after, 1, REACH)))


def _spans(kind: Kind, rank: int, matches: Column, gaps: Column) -> Column:
    """(start, rank, end, kind, score) of the valid matches."""

    def place(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"), pair["near"].alias("near"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    def shift(done: Column, block: Column) -> Column:
        moved = F.transform(block["spans"], lambda s: F.struct((s["start"] + done["at"]).alias("start"), (s["end"] + done["at"]).alias("end"), s["match"], s["near"]))
        return F.struct((done["at"] + block["at"]).alias("at"), F.concat(done["blocks"], F.array(moved)).alias("blocks"))

    size = F.size(matches)
    about = F.zip_with(F.slice(gaps, F.lit(1), size), F.slice(gaps, F.lit(2), size), lambda b, a: F.struct(b.alias("gap"), _near(b, a).alias("near")))
    pairs = F.zip_with(matches, about, lambda m, g: F.struct(g["gap"].alias("gap"), g["near"].alias("near"), m.alias("match")))
    # Every step copies what it has, so places are summed up block by block.
    blocks = F.transform(F.sequence(F.lit(1), F.size(matches), F.lit(BLOCK)), lambda i: F.slice(pairs, i, F.lit(BLOCK)))
    none = F.expr("cast(array() as array<struct<start:int,end:int,match:string,near:string>>)")
    within = F.transform(blocks, lambda block: F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("spans")), place))
    nothing = F.expr("cast(array() as array<array<struct<start:int,end:int,match:string,near:string>>>)")
    placed = F.flatten(F.aggregate(within, F.struct(F.lit(0).alias("at"), nothing.alias("blocks")), shift, lambda done: done["blocks"]))
    valid = F.filter(placed, lambda s: _valid(kind.name, s["match"]))

    def scored(s: Column) -> Column:
        near = s["near"]
        score = F.lit(kind.prior) + F.when(near.rlike(kind.friends), FRIEND).otherwise(0.0) + F.when(near.rlike(kind.foes), FOE).otherwise(0.0)
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind.name).alias("kind"), F.least(F.lit(1.0), score).alias("score"))

    found = F.transform(valid, scored)
    return found if kind.base else F.filter(found, lambda s: s["score"] >= LEAST_SCORE)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all spans of each text by start, then kind; start and end in code points, end exclusive."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    matches = []
    for kind in KINDS:
        every = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))
        matches.append((F.when(F.contains("text", F.lit(kind.needs)), every).otherwise(none) if kind.needs else every).alias(f"m_{kind.name}"))
    rows = rows.select("*", *matches)
    found = []
    for rank, kind in enumerate(KINDS):
        held = F.col(f"m_{kind.name}")
        spans = _spans(kind, rank, held, F.split("text", kind.pattern, -1))
        nothing = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,score:double>>)")
        found.append(F.when(F.size(held) > 0, spans).otherwise(nothing).alias(f"s_{kind.name}"))
    rows = rows.select("doc_id", *found)
    return rows.select("doc_id", F.array_sort(F.concat(*(f"s_{kind.name}" for kind in KINDS))).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = personal_data(table(spark, sf_dir, "documents"))
    base = [kind.name for kind in KINDS if kind.base]
    return rows.select(
        "doc_id",
        *(_count(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(_written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
