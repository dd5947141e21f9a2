"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by one pattern, validated by kind, and replaced by a
keyed permutation of their own format, so equal values of all documents get
the same pseudonym, different ones different pseudonyms, and a holder of the
key can turn them back.  The permutation is a Feistel network that changes
halves in turn:

* strings: each letter or digit of one half moves within its own class by a
  number derived from the key, the round and the other half; other characters
  stay.  Card numbers permute all digits but the last, which is their check
  digit and is made anew; e-mail addresses permute the local part, phone
  numbers all digits after the country code.
* addresses of four numbers: two halves of 16 bits.
* dates: the 146,097 days from 1800-01-01 on (400 Gregorian years) as 189 x 773.

Only DataFrame functions are used.

Defined results: a null text stays null and has no finds; what fails its
validation (check digit, calendar, number above 255) stays as it is; repeated
rows are treated alike; an empty table gives no rows; other columns are kept,
those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import shielded

ROUNDS = 8
#: Kinds in the order in which the pattern tries them.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![\w+])\+?\d{1,3}[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)",
    "date": r"(?<![\w.-])\d{4}-\d{2}-\d{2}(?![\w-])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w|-\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d)",
}
EPOCH, DAYS, OUTER, INNER = "1800-01-01", 146097, 189, 773


def digest(key: str, step: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), step.cast("string"), other.cast("string")), 256)


def shifted(half: Column, code: Column) -> Column:
    """Each letter and digit moved within its class by two hex digits of ``code``."""
    def one(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(code, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        at = F.ascii(c)

        def turn(first: int, size: int) -> Column:
            return F.char((F.lit(first) + (at - first + by) % size).cast("int"))
        return (F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26))
                .when(c.between("A", "Z"), turn(65, 26)).otherwise(c))
    letters = F.filter(F.split(half, ""), lambda c: c != "")
    return F.array_join(F.transform(letters, one), "")


def permuted_text(x: Column, key: str) -> Column:
    """A permutation of all strings with the same classes at the same places."""
    cut = F.floor(F.length(x) / 2).cast("int")
    start = F.struct(F.substring(x, F.lit(1), cut).alias("a"), F.substring(x, cut + 1, F.length(x)).alias("b"))

    def step(s: Column, i: Column) -> Column:
        odd = F.struct(shifted(s["a"], digest(key, i, s["b"])).alias("a"), s["b"].alias("b"))
        even = F.struct(s["a"].alias("a"), shifted(s["b"], digest(key, i, s["a"])).alias("b"))
        return F.when(i % 2 == 1, odd).otherwise(even)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"]))


def permuted_number(n: Column, outer: int, inner: int, key: str) -> Column:
    """A permutation of the numbers below outer * inner."""
    start = F.struct(F.floor(n / inner).cast("long").alias("a"), (n % inner).cast("long").alias("b"))

    def by(i: Column, other: Column, size: int) -> Column:
        return F.conv(F.substring(digest(key, i, other), 1, 12), 16, 10).cast("long") % size

    def step(s: Column, i: Column) -> Column:
        odd = F.struct(((s["a"] + by(i, s["b"], outer)) % outer).alias("a"), s["b"].alias("b"))
        even = F.struct(s["a"].alias("a"), ((s["b"] + by(i, s["a"], inner)) % inner).alias("b"))
        return F.when(i % 2 == 1, odd).otherwise(even)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["a"] * inner + s["b"])


def luhn(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    parts = F.transform(reverse, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b)


def kind_of(x: Column) -> Column:
    """Kind of a candidate that passes its validation, else null."""
    digits = F.regexp_replace(x, r"\D", "")
    octets = F.forall(F.split(x, r"\."), lambda o: o.cast("int") <= 255)
    day = F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date")
    in_range = F.datediff(day, F.lit(EPOCH).cast("date")).between(0, DAYS - 1)
    shape = {k: x.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    return (F.when(F.contains(x, F.lit("@")), "email")
            .when(shape["ip"], F.when(octets, F.lit("ip")))
            .when(shape["date"], F.when(in_range, F.lit("date")))
            .when(shape["ssn"], "ssn")
            .when(shape["card"], F.when(luhn(digits) % 10 == 0, F.lit("card")))
            .when(shape["phone"], "phone"))


def pseudonym(x: Column, key: str) -> Column:
    """The pseudonym of a candidate; the candidate itself where it is not valid."""
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    email = F.concat(permuted_text(local, f"{key}|email"), F.lit("@"), domain)
    prefix = F.regexp_extract(x, r"^(\+?\d{1,3}[ .-]?(?=\()|\+\d{1,3}[ .-])", 1)
    phone = F.concat(prefix, permuted_text(F.substring(x, F.length(prefix) + 1, F.length(x)), f"{key}|phone"))
    octets = F.split(x, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))
    moved = permuted_number(number, 65536, 65536, f"{key}|ip")
    ip = F.array_join(F.transform(F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: (F.floor(moved / F.pow(F.lit(2.0), s)) % 256).cast("long").cast("string")), ".")
    days = F.datediff(F.try_to_timestamp(x, F.lit("yyyy-MM-dd")).cast("date"), F.lit(EPOCH).cast("date"))
    date = F.date_add(F.lit(EPOCH).cast("date"), permuted_number(days, OUTER, INNER, f"{key}|date").cast("int")).cast("string")
    body = permuted_text(F.substring(x, F.lit(1), F.length(x) - 1), f"{key}|card")
    check = (10 - luhn(F.concat(F.regexp_replace(body, r"\D", ""), F.lit("0"))) % 10) % 10
    card = F.concat(body, check.cast("string"))
    kind = kind_of(x)
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ip", ip).when(kind == "date", date)
            .when(kind == "card", card).when(kind == "ssn", permuted_text(x, f"{key}|ssn")).otherwise(x))


def mask(docs: DataFrame, key: str) -> DataFrame:
    """The documents with pseudonyms in their texts, ``found`` (kind, value
    replaced) in order of appearance, and ``n_found``."""
    any_of = "(" + "|".join(PATTERNS.values()) + ")"
    own = [c for c in docs.columns if c not in ("found", "n_found")]
    text = F.col("text")
    candidates = F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(any_of), 1))
    mine, back = shielded(docs.select(*[F.col(f"`{c}`") for c in own]), ("text",))
    found = mine.withColumn("_c", F.coalesce(candidates, F.array().cast("array<string>")))
    # Each candidate is handled once per row that has it; texts without candidates pass untouched.
    made = found.withColumn("_m", F.transform("_c", lambda x: F.struct(kind_of(x).alias("kind"), x.alias("value"), pseudonym(x, key).alias("made"))))
    rest = F.split(text, any_of, -1)
    woven = F.array_join(F.concat(F.transform(F.arrays_zip(rest.alias("t"), F.col("_m.made").alias("p")),
                                              lambda z: F.concat(z["t"], F.coalesce(z["p"], F.lit(""))))), "")
    finds = F.filter("_m", lambda m: m["kind"].isNotNull())
    return made.select(*[F.when(F.size("_c") > 0, woven).otherwise(text).alias("text") if c == "text" else kept for c, kept in zip(own, back, strict=True)],
                       F.transform(finds, lambda m: F.struct(m["kind"].alias("kind"), m["value"].alias("value"))).alias("found"),
                       F.size(finds).cast("long").alias("n_found"))
