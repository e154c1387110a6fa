"""Secret scans, in DataFrame functions alone.

Three kinds are found by pattern. Java's patterns yield matches without places, so places are the running
lengths of what lies between the matches (``split``) and of the matches themselves, both in code points. On top
of these, long runs of key-like characters are candidates: a window slides over each, and its Shannon entropy is
kept up to date from the counts of the one character that leaves and the one that enters. A candidate whose best
window is as uneven as a random key of its character class is a secret, unless the allow list knows it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import set_aside

# Fixed values of the base scan: kind, pattern, the group whose length counts, and the least length.
KINDS = [
    ("assign", r"""((?i)password|passwd|secret|token|api_?key(?-i))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
# The hex pattern meets every short run of letters a to f; runs are cut whole, so asking for 32 at once finds the same.
QUICK = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Bits a character of the best window, by character class; a window of 20 random characters has about 3.4, 4.0 and 4.1.
CLASSES = [("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.6), ("^[A-Za-z0-9+/_=-]+$", 3.7)]
# A key has digits among letters. What has at most one and is written as words are is let pass: few capitals, or hardly any small letters.
FEW_DIGITS = r"^[^0-9]*([0-9][^0-9]*)?$"
LETTERS_PER_CAPITAL = 3
LETTERS_PER_SMALL = 8
# What these patterns match is let pass.
ALLOWED = [
    r"^[^A-Za-z]*$", r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
    r"(?i)0123456789|abcdefghij", r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^-+$|^=+$|^_+$", r"(?i)^(sha|md)[0-9]+[-=]",
]
# Arrays grow step by step inside pieces of so many entries, so a text with very many matches stays cheap.
PIECE = 256


def _pieces(array: Column, width: int, overlap: int = 0) -> Column:
    """An array in slices of ``width`` entries, each with the next ``overlap`` entries behind it."""
    last = F.greatest(F.lit(0), F.floor((F.size(array) - 1) / width)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(array, k * width + 1, width + overlap))


def _running(lengths: Column) -> Column:
    """Sums of the lengths before each entry."""
    none = F.array().cast("array<long>")

    def grown(state: Column, n: Column) -> Column:
        return F.struct((state.at + n).alias("at"), F.concat(state.done, F.array(state.at)).alias("done"))

    def inside(piece: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("done"))
        return F.aggregate(piece, start, grown, lambda s: s.done)

    def total(piece: Column) -> Column:
        return F.aggregate(piece, F.lit(0).cast("long"), lambda s, n: s + n)

    def placed(cut: Column) -> Column:
        before = inside(F.transform(cut, total))
        return F.flatten(F.zip_with(cut, before, lambda piece, base: F.transform(inside(piece), lambda x: x + base)))

    return F.transform(F.array(_pieces(lengths, PIECE)), placed)[0]


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end>> of the leftmost non-overlapping matches that are long enough."""
    matches, counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.slice(F.split(text, pattern, -1), 1, 2_000_000_000)
    rows = F.arrays_zip(
        F.transform(matches, lambda m: F.length(m).cast("long")).alias("long"),
        F.transform(counted, lambda m: F.length(m)).alias("counted"),
        F.transform(F.slice(between, F.lit(1), F.size(matches)), lambda p: F.length(p).cast("long")).alias("gap"))

    def placed(found: Column) -> Column:
        sums = _running(F.transform(found, lambda x: x["long"] + x["gap"]))
        spans = F.zip_with(found, sums, lambda x, s: F.struct(
            (s + x["gap"]).alias("start"), (s + x["gap"] + x["long"]).alias("end"), x["counted"].alias("counted")))
        return F.transform(F.filter(spans, lambda x: x["counted"] >= least), lambda x: F.struct(x["start"], x["end"]))

    return F.when(text.rlike(pattern), F.transform(F.array(rows), placed)[0]).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def window_entropy(string: Column, width: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits a character, of any ``width`` neighbouring characters of a longer string.

    With S the sum of c * log2(c) over the counts c in the window, the entropy is log2(width) - S / width. A step
    changes S by the counts of two characters only.
    """
    parts = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(width + 2)])

    def count(window: Column, char: Column) -> Column:
        return F.size(window) - F.size(F.array_remove(window, char))

    def first(window: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(window)), F.lit(0.0), lambda s, i: s + F.transform(
            F.array(count(F.slice(window, F.lit(1), i), F.element_at(window, i))), lambda c: F.get(parts, c) - F.get(parts, c - 1))[0])

    def moved(chars: Column, s: Column, i: Column) -> Column:
        old = F.slice(chars, i - width, width)
        kept = F.slice(chars, i - width + 1, width - 1)
        return F.transform(
            F.array(F.struct(count(old, F.element_at(chars, i - width)).alias("out"), count(kept, F.element_at(chars, i)).alias("into"))),
            lambda c: s - F.get(parts, c["out"]) + F.get(parts, c["out"] - 1) + F.get(parts, c["into"] + 1) - F.get(parts, c["into"]))[0]

    def step(chars: Column, state: Column, i: Column) -> Column:
        return F.transform(F.array(moved(chars, state["s"], i)),
                           lambda s: F.struct(s.alias("s"), F.least(state["least"], s).alias("least")))[0]

    def slid(chars: Column) -> Column:
        start = F.transform(F.array(first(F.slice(chars, 1, width))), lambda s: F.struct(s.alias("s"), s.alias("least")))[0]
        places = F.when(F.size(chars) > width, F.sequence(F.lit(width + 1), F.size(chars))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, start, lambda state, i: step(chars, state, i), lambda s: s["least"])

    def whole(chars: Column) -> Column:
        pieces = F.filter(_pieces(chars, PIECE, width - 1), lambda p: F.size(p) >= width)
        return F.lit(math.log2(width)) - F.array_min(F.transform(pieces, slid)) / width

    return F.transform(F.array(F.split(string, "")), lambda c: whole(F.filter(c, lambda x: x != "")))[0]


def _key_like(string: Column) -> Column:
    capitals, small = (F.length(F.regexp_replace(string, f"[^{c}]", "")) for c in ("A-Z", "a-z"))
    letters = capitals + small
    allowed = string.rlike(FEW_DIGITS) & ((capitals * LETTERS_PER_CAPITAL <= letters) | (small * LETTERS_PER_SMALL <= letters))
    for pattern in ALLOWED:
        allowed = allowed | string.rlike(pattern)
    least = F.when(string.rlike(CLASSES[0][0]), CLASSES[0][1])
    for pattern, bits in CLASSES[1:]:
        least = least.when(string.rlike(pattern), bits)
    return F.when(allowed, F.lit(False)).otherwise(window_entropy(string) >= least)


def _as_kind(spans: Column, number: int, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(number).alias("kind_no"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def secret_scan(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` and ``secrets``: array<struct<start, kind_no, end, kind>> by start, then kind.

    ``docs`` needs text; start and end are code points, the end exclusive. Kinds are assign, access, hex and entropy. Matches of a
    base kind are leftmost and do not overlap within the kind. Of an entropy candidate, what
    base matches cover is theirs; the parts between and beside them that are long enough are candidates of their own. Null and empty texts have an empty array. Texts are taken whole; repeated rows each come out. A column called
    ``secrets`` in ``docs`` is replaced.
    """
    docs, back = set_aside(docs.drop("secrets"), ["text"])
    kinds = [k for k, *_ in KINDS]
    text = F.col("_text")
    found = docs.select("*", F.coalesce("text", F.lit("")).alias("_text"))
    found = found.select("*", *[_spans(text, QUICK.get(k, p), g, n).alias(f"_{k}") for k, p, g, n in KINDS],
                         _spans(text, CANDIDATE, 0, WINDOW).alias("_long"))
    base = F.concat(*[_as_kind(F.col(f"_{k}"), i, k) for i, k in enumerate(kinds)])
    found = found.select("*", F.when(F.size("_long") + sum(F.size(f"_{k}") for k in kinds) > 0, base).alias("_base"))

    def uncovered(span: Column) -> Column:
        inside = F.filter("_base", lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
        # Behind the first i matches by their ends, up to the next one by its start.
        starts = F.array_sort(F.concat(F.array(span["start"]), F.transform(inside, lambda b: b["end"])))
        ends = F.array_sort(F.concat(F.transform(inside, lambda b: b["start"]), F.array(span["end"])))
        return F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda x: x["end"] - x["start"] >= WINDOW)

    candidates = F.flatten(F.transform("_long", uncovered))
    more = F.filter(candidates, lambda x: _key_like(F.substring(text, x["start"].cast("int") + 1, (x["end"] - x["start"]).cast("int"))))
    more = _as_kind(more, len(kinds), "entropy")
    spans = F.when(F.col("_base").isNull(), F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>")).when(
        F.size("_long") == 0, F.array_sort("_base")).otherwise(F.array_sort(F.concat("_base", more)))
    return back(found.select("*", spans.alias("secrets")), "secrets")


def digest_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
