"""Personal data: regular expressions propose spans, validators confirm them, context adjusts scores.

DataFrame functions only. The pieces between the matches of an expression give the positions of
the matches: no text is looked at more than twice for each expression, and only texts that can
hold a kind are searched for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The expressions of the contract. Where a run of characters is looked for, the
# forms used below start at the run's beginning (or where the last match ended) and take it whole,
# which finds the same matches in time linear in the text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Kinds of the method: bank account numbers, social security numbers, phone numbers without country code,
# and secrets (keys and tokens: long runs of letters and digits).
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9.-])"
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])"

OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
THRESHOLD = 0.5
NEAR = 40  # code points before a match in which context words count


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    d = F.reverse(number)

    def add(total, i):
        x = F.substr(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN (blanks removed) has remainder 1."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest, i):
        ch = F.substr(turned, i, F.lit(1))
        return F.when(ch.between("0", "9"), (rest * 10 + F.try_to_number(ch, F.lit("9")).cast("int")) % 97) \
            .otherwise((rest * 100 + F.ascii(ch) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def entropy(match: Column) -> Column:
    """Bits a character that the frequencies of a string's characters need."""
    n = F.length(match)
    share = lambda c: (n - F.length(F.replace(match, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(match, "")), F.lit(0.0), lambda bits, c: bits - share(c) * F.log2(share(c)))


@dataclass(frozen=True)
class Kind:
    name: str
    may_hold: str      # texts without a match of this are not searched
    pattern: str
    valid: object      # Column of the match -> Column
    score: float       # of a confirmed match
    context: str       # words that raise it when they stand just before the match
    base: bool


KINDS = (
    Kind("email", "@", EMAIL, lambda m: F.lit(True), 0.9, "mail|contact|write|e-mail", True),
    Kind("ip", r"[0-9]\.[0-9]", IP, lambda m: m.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), 0.6, "ip|address|host|server", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11}", CARD,
         lambda m: F.length(digits(m)).between(12, 19) & luhn(digits(m)), 0.7, "card|visa|credit|payment|pay", True),
    Kind("phone", r"\+[0-9]", PHONE, lambda m: F.length(digits(m)).between(9, 15), 0.7, "phone|tel|call|mobile|fax", True),
    Kind("iban", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", IBAN, lambda m: mod97(F.regexp_replace(m, " ", "")), 0.8, "iban|account|bank", False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", SSN,
         lambda m: ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$"), 0.4, "ssn|social|security", False),
    Kind("local_phone", r"[0-9]{3}[-.][0-9]{4}", LOCAL_PHONE, lambda m: F.lit(True), 0.4, "phone|tel|call|mobile|fax", False),
    Kind("secret", r"[A-Za-z0-9+/_-]{20}", SECRET, lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (entropy(m) >= 3.0), 0.4,
         r"(\w+[_-])?(token|secret|key|apikey|password|passwd|credential|bearer)s?", False),
)

SPAN = "struct<start:int,rank:int,stop:int,kind:string,score:double>"


def spans(text: Column, kind: Kind, rank: int) -> Column:
    """Confirmed matches of one kind, leftmost and not overlapping, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    each = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("n"), m.alias("match"),
        F.lower(F.substr(p, F.greatest(F.length(p) - (NEAR - 1), F.lit(1)))).alias("before")))
    empty = F.array().cast(f"array<{SPAN}>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        score = F.lit(kind.score) + F.when(x["before"].rlike(rf"\b({kind.context})\b"), 0.1).otherwise(0.0)
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["n"]).alias("stop"),
                               F.lit(kind.name).alias("kind"), score.alias("score")).cast(SPAN))
        good = kind.valid(x["match"]) & (F.lit(kind.base) | (score >= THRESHOLD))
        return F.struct((start + x["n"]).alias("at"), F.when(good, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(kind.may_hold),
                  F.aggregate(each, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])).otherwise(empty)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, found (spans with kind and score), the counts of the base kinds,
    base_sha256, spans and scores (one per span, in the order of spans).

    Base kinds (email, ip, card, phone) stay whatever their score; a span of the method's kinds
    needs a score of THRESHOLD, so that a social security or local phone number or a digest without a context
    word is left alone. Null text counts as empty and has no spans. Repeated rows give equal rows, an empty table an
    empty one; other columns are not looked at. Very long texts are searched whole, in time linear in their length.
    """
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.select("doc_id", *[spans(F.col("text"), k, i).alias(k.name) for i, k in enumerate(KINDS)])
    order = lambda kinds: F.array_sort(F.concat(*[F.col(k.name) for k in kinds]))
    base = [k for k in KINDS if k.base]
    t = t.select("doc_id", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in base],
                 order(base).alias("base"), order(KINDS).alias("found"))
    return t.select("doc_id", *[f"n_{k.name}" for k in base],
                    F.sha2(F.encode(_joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
                    _joined(F.col("found")).alias("spans"),
                    F.array_join(F.transform("found", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"), "found")
