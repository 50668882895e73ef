"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds are e-mail addresses, IPv4 addresses, card numbers (Luhn) and international phone
numbers: leftmost matches that do not overlap, per kind; a match that its rule rejects is dropped and
not tried shorter. Added kinds are bank accounts (IBAN, mod 97); access keys and assigned credentials, which have a digit; and
two more without a checksum, national phone numbers and social security numbers, which count only where
a word nearby speaks for them.
Added spans do not overlap base spans, and base spans stay whatever their score.

Built-in functions throughout. Positions are in code points, from the lengths of the text between
matches. Where a pattern could be tried over and over inside one run of characters, a look back
ties it to the run's start, and repetitions do not give back, so spans are found in time
proportional to the text and its matches; ``masked`` takes time for each span and the text before it.

Nulls and odd inputs: a null text is an empty one and has no spans. Repeated rows each get their
row, a null doc_id stays null. An empty table gives an empty result. Columns besides doc_id and text
are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import texts

LOCAL = "[A-Za-z0-9._%+-]"
BEFORE, AFTER = 48, 24  # characters around a span in which words count
ACCEPTED = 0.5
BLOCK = 128  # sums that are grown at a time
FOR, AGAINST = 0.3, -0.3


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the checksum of card numbers."""
    n = F.length(number)

    def value(i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((n - i) % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number, letters counting from 10, leaves 1 when divided by 97."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _card(hit: Column) -> Column:
    number = digits(hit)
    return F.length(number).between(12, 19) & luhn(number)


def _ip(hit: Column) -> Column:
    def small(part: Column) -> Column:
        rest = F.regexp_replace(part, "^0+", "")
        return (F.length(rest) <= 3) & (F.coalesce(rest.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(hit, "[.]"), small)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needed: str  # texts without this have no match
    valid: Callable[[Column], Column]
    score: float
    context: str  # words that speak for the kind


BASE = (
    Kind(
        "email",
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
        lambda hit: F.lit(True),
        0.9,
        "mail|contact|write|reach",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", _ip, 0.6, "ip|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}", _card, 0.7, "card|visa|credit|payment|paid"),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"\+[0-9][\x20().0-9-]",
        lambda hit: F.length(digits(hit)).between(9, 15),
        0.7,
        "phone|call|tel|mobile|fax|text",
    ),
)
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11}",
        lambda hit: mod97(F.regexp_replace(hit, "\x20", "")),
        0.8,
        "iban|account|bank|transfer",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda hit: ~hit.rlike("^(000|666|9)|-00-|-0000$"),
        0.35,
        "ssn|social security",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        r"[0-9]{3}[\x20.-][0-9]{4}",
        lambda hit: F.lit(True),
        0.35,
        "phone|call|tel|mobile|fax",
    ),
    Kind(
        "access_key",
        r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
        r"A[KS]IA[0-9A-Z]{16}",
        lambda hit: hit.rlike("[0-9]") & hit.rlike("[A-Z]{4}.*[A-Z]"),
        0.8,
        "key|secret|access",
    ),
    Kind(
        "credential",
        r"(?i)(?<![a-z0-9])(?:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9/+_.-]{8,128}+(?![A-Za-z0-9])",
        r"(?i)(?:password|passwd|secret|token|key)\x20?[=:]\x20?[\"']?[A-Za-z0-9/+_.-]{8}",
        lambda hit: hit.rlike("[=:].*[0-9]"),
        0.6,
        "login|user|account|config",
    ),
)
WORDS_AGAINST = "example|sample|version|isbn|invoice no|order no"
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, levels: int = 2) -> Column:
    """The sums of an array's numbers up to each one.

    An array grows by copying, so only blocks of ``BLOCK`` sums are grown; the sums of whole blocks are
    summed in the same way. With two levels the work is proportional to the length up to a hundred
    million numbers.
    """
    none = F.array().cast("array<bigint>")

    def block(i: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("sums"))

        def step(done: Column, x: Column) -> Column:
            return F.struct((done["at"] + x).alias("at"), F.concat(done["sums"], F.array(done["at"] + x)).alias("sums"))

        return F.aggregate(F.slice(values, i * BLOCK + 1, F.lit(BLOCK)), first, step, lambda done: done["sums"])

    def whole(sums: Column) -> Column:
        ends = F.transform(sums, lambda s: F.get(s, F.size(s) - 1))

        def moved(before: Column) -> Column:
            return F.flatten(F.transform(sums, lambda s, i: F.transform(s, lambda x: x + F.coalesce(F.get(before, i - 1), F.lit(0)))))

        return _let(_running(ends, levels - 1), moved)

    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0)))
    if not levels:
        return F.aggregate(values, F.struct(F.lit(0).cast("long").alias("at"), none.alias("sums")), lambda done, x: F.struct((done["at"] + x).alias("at"), F.concat(done["sums"], F.array(done["at"] + x)).alias("sums")), lambda done: done["sums"])
    return F.when(F.size(values) == 0, none).otherwise(_let(F.transform(blocks, block), whole))


def _ends(kind: Kind) -> Column:
    """Where every match ends, from the columns with the hits and the gaps."""
    gaps, hits = F.col(f"gaps_{kind.name}"), F.col(f"hits_{kind.name}")
    steps = F.transform(hits, lambda hit, i: (F.char_length(F.get(gaps, i)) + F.char_length(hit)).cast("long"))
    return F.when(F.size(hits) > 0, _let(steps, lambda v: _running(v))).alias(f"ends_{kind.name}")


def _matches(kind: Kind) -> Column:
    """(start, end, hit, near) of every match, from the columns with the hits, the gaps and the ends."""
    gaps, hits, ends = (F.col(f"{part}_{kind.name}") for part in ("gaps", "hits", "ends"))

    def match(hit: Column, i: Column) -> Column:
        near = F.concat(F.substring(F.get(gaps, i), -BEFORE, BEFORE), hit, F.substring(F.get(gaps, i + 1), 1, AFTER))
        end = F.get(ends, i)
        return F.struct((end - F.char_length(hit)).alias("start"), end.alias("end"), hit.alias("hit"), F.lower(near).alias("near"))

    return F.transform(hits, match)


def _spans(kind: Kind, rank: int) -> Column:
    def scored(hit: Column) -> Column:
        score = F.lit(kind.score) + F.when(hit["near"].rlike(rf"\b(?:{kind.context})"), FOR).otherwise(0.0)
        score = score + F.when(hit["near"].rlike(rf"\b(?:{WORDS_AGAINST})\b"), AGAINST).otherwise(0.0)
        return F.struct(
            hit["start"].alias("start"), F.lit(rank).alias("rank"), hit["end"].alias("end"), F.lit(kind.name).alias("kind"), F.round(F.least(score, F.lit(1.0)), 2).alias("score")
        )

    found = F.transform(F.filter(_matches(kind), lambda m: kind.valid(m["hit"])), scored)
    return F.coalesce(found.cast(SPAN), F.array().cast(SPAN))


def _overlaps(sorted_spans: Column, span: Column) -> Column:
    """Whether one of a kind's spans, which lie in order and apart, overlaps: the first that ends behind
    the start of ``span`` is found by halving."""
    first = F.struct(F.lit(0).alias("low"), F.size(sorted_spans).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        before = F.get(sorted_spans, middle)["end"] <= span["start"]
        halved = F.struct(F.when(before, middle + 1).otherwise(at["low"]).alias("low"), F.when(before, at["high"]).otherwise(middle).alias("high"))
        return F.when(at["low"] >= at["high"], at).otherwise(halved)

    place = F.aggregate(F.sequence(F.lit(1), F.lit(31)), first, halve, lambda at: at["low"])
    return (F.size(sorted_spans) > 0) & F.coalesce(F.get(sorted_spans, place)["start"] < span["end"], F.lit(False))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base, added): arrays of (start, rank, end, kind, score), by start and kind."""
    docs = texts(docs)
    text, kinds = F.col("text"), BASE + ADDED
    found = docs.select("*", *(text.rlike(k.needed).alias(f"may_{k.name}") for k in kinds))
    gaps = [F.when(F.col(f"may_{k.name}"), F.split(text, k.pattern, -1)).alias(f"gaps_{k.name}") for k in kinds]
    hits = [F.when(F.col(f"may_{k.name}"), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).alias(f"hits_{k.name}") for k in kinds]
    found = found.select("doc_id", "text", *gaps, *hits)
    found = found.select("*", *map(_ends, kinds))
    found = found.select("doc_id", "text", *(_spans(k, i).alias(k.name) for i, k in enumerate(kinds)))

    def apart(span: Column) -> Column:
        return ~functools.reduce(Column.__or__, (_overlaps(F.col(k.name), span) for k in BASE))

    added = F.filter(F.concat(*(k.name for k in ADDED)), lambda s: (s["score"] >= ACCEPTED) & apart(s))
    base = F.sort_array(F.concat(*(k.name for k in BASE)))
    return found.select("doc_id", "text", base.alias("base"), F.sort_array(added).alias("added"))


def _of(kind: Kind) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind.name


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of every row."""
    found = spans(docs).drop("text").withColumn("all", F.sort_array(F.concat("base", "added")))
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{k.name}") for k in BASE]
    scores = F.array_join(F.transform("all", lambda s: F.format_number(s["score"], 2)), ",")
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"), scores.alias("scores")
    )


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; of overlapping spans the first."""
    found = spans(docs).withColumn("all", F.sort_array(F.concat("base", "added")))
    text = F.col("text")
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        hidden = F.struct(s["end"].alias("at"), F.concat(acc["done"], between, F.lit("["), s["kind"], F.lit("]")).alias("done"))
        return F.when(s["start"] < acc["at"], acc).otherwise(hidden)

    rest = lambda acc: F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    return found.select("doc_id", F.aggregate("all", first, step, rest).alias("text"))
