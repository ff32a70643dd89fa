"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for account numbers)
and words nearby adjust a score. The expressions start only where a run of characters starts and do not
backtrack into it, so a very long run costs its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import put, text_of

LOCAL = "[A-Za-z0-9._%+-]"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Proposals by kind, in the order of kinds. Each finds what its plain form does: emails
#: ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``, addresses ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``,
#: runs ``[0-9]([\x20-]?[0-9])+`` of 14 to 19 digits, numbers ``\+[0-9][\x20().0-9-]+[0-9]``, and account
#: numbers written together or in groups of four.
PROPOSALS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9_])",
}
#: What a text must hold for the proposal to be tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
BASE = ("email", "ip", "card", "phone")

#: Score without and with a word of the context nearby.
SCORES = {"email": (0.8, 1.0), "ip": (0.5, 0.9), "card": (0.8, 1.0), "phone": (0.6, 0.9), "iban": (0.9, 1.0)}
CONTEXT = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
}
BEFORE, AFTER = 40, 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits pass Luhn's check: from the right, every second one doubled."""
    figures = F.split(F.reverse(digits_of(hit)), "")

    def add(total: Column, i: Column) -> Column:
        d = F.try_element_at(figures, i + 1).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits_of(hit)) - 1), F.lit(0), add) % 10 == 0


def mod97(hit: Column) -> Column:
    """Whether an account number leaves 1: first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        value = F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
        return (rest * F.when(c >= "A", 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


CHECKS = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": luhn,
    "phone": lambda hit: F.length(digits_of(hit)).between(10, 15),
    "iban": mod97,
}


def confirmed(text: Column, kind: str) -> Column:
    """Spans of one kind as an array of (start, rank, end, score), code points from 0, end exclusive."""
    proposal, rank = F.lit(PROPOSALS[kind]), list(PROPOSALS).index(kind)
    words = "|".join(CONTEXT[kind])

    def score(start: Column, end: Column) -> Column:
        before = F.substr(text, F.greatest(start - BEFORE, F.lit(0)) + 1, F.least(start, F.lit(BEFORE)))
        near = F.translate(F.concat(before, F.lit(" "), F.substr(text, end + 1, F.lit(AFTER))), UPPER, LOWER)
        low, high = SCORES[kind]
        return F.when(near.rlike(f"(?:^|[^a-z])(?:{words})(?:$|[^a-z])"), high).otherwise(low)

    empty = F.expr("CAST(array() AS array<struct<start:int,rank:int,end:int,score:double>>)")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["0"])
        end = start + F.length(pair["1"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), score(start, end).alias("score"))
        spans = F.when(CHECKS[kind](pair["1"]), F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    hits = F.regexp_extract_all(text, proposal, F.lit(0))
    pieces = F.split(text, PROPOSALS[kind], -1)
    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda piece, hit: F.struct(piece.alias("0"), hit.alias("1")))
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda state: state["spans"])
    return F.when(text.contains(NEEDS[kind]), found).otherwise(empty) if kind in NEEDS else found


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in PROPOSALS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])))


def find_personal_data(df: DataFrame, text_column: str = "text", least_score: float = 0.0) -> DataFrame:
    """Adds ``pii_spans``: (start, rank, end, score) by start, then kind; ``rank`` is the kind's place in PROPOSALS.

    Proposals of a kind are leftmost and do not overlap; those that fail their check are dropped and not
    tried again shorter. Spans of the base kinds always stay; added ones need ``least_score``. A null or empty
    text has none. Very long texts are taken whole, rows are judged one by one, so repeated rows give
    repeated results and an empty table an empty one. An input column of that name is replaced.
    """
    text = text_of(text_column)
    spans = F.array_sort(F.concat(*[confirmed(text, kind) for kind in PROPOSALS]))
    if least_score > 0:
        spans = F.filter(spans, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= least_score))
    return put(df, {"pii_spans": spans})


def digest(found: DataFrame, id_column: str) -> DataFrame:
    """Counts and digests of found spans: one row per document."""
    spans = F.col("pii_spans")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("bigint")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(PROPOSALS)]
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    scores = F.concat_ws(",", F.transform(spans, lambda s: F.format_number(s["score"], 1)))
    return found.select(id_column, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(spans).alias("spans"), scores.alias("scores"))
