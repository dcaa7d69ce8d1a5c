"""Personal data: regular expressions propose spans, validators confirm them, context words adjust the score.

Every kind has a pattern, a check of the matched text and a score; a word of the kind's context within
``CONTEXT_CHARS`` before the span or after it raises the score.  A span counts from ``MIN_SCORE`` on.  The base kinds
(email, ip, card, phone) count once they pass their check, with or without context.  ``iban`` needs mod 97;
``card13`` (13 digits passing Luhn, too short for the base kind) and ``national_id`` (three groups of digits) need
context words beside their check.

Matches of a kind are leftmost and do not overlap; those that fail are dropped and, for the base kinds, not tried again
from inside.  A failed ``iban`` is tried with the ends at its blanks, as a short word in capitals after it would belong
to the match, and then from its next character on.
Offsets are code points, the end exclusive.  Null and empty texts have no spans.  Whole texts are searched.
Repeated rows get equal results.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map

CONTEXT_CHARS = 60
MIN_SCORE = 0.5


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c in "0123456789"]
    doubled = [d if n % 2 == 0 else 2 * d - 9 * (d > 4) for n, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def digit_count(text: str) -> int:
    return sum(c in "0123456789" for c in text)


def mod97(text: str) -> bool:
    """The check of an IBAN: its first four characters go to the end, letters become 10 to 35."""
    bare = text.replace(" ", "")
    return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


# Lengths of the IBAN registry, by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def iban_end(text: str, start: int, end: int) -> int | None:
    """Where the IBAN in a match ends: at a blank or the match's end, first where its country's length is reached.

    A part that ends at a blank has to have its country's length, if that is known; the whole match only the check.
    """
    ends = [end, *[n for n in range(end - 1, start, -1) if text[n] == " "]]
    known = IBAN_LENGTHS.get(text[start : start + 2])
    sized = [n for n in ends if len(text[start:n].replace(" ", "")) == known]
    for n in sized or ([end] if known else ends):
        if mod97(text[start:n]):
            return n
    return end if mod97(text[start:end]) else None


def national_id(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: re.Pattern
    check: Callable[[str], bool]
    needs: str  # a text without any of these characters has no match; empty: always search
    score: float = 1.0
    context: re.Pattern | None = None
    raised: float = 0.0
    ends: Callable[[str, int, int], int | None] | None = None  # for kinds with retries: where the span in a match ends
    resumes: re.Pattern | None = None  # tried first right after a match, where ``pattern`` would not start


# The first four kinds, their patterns and limits are given.  A run of characters that can't lead to an email, or to an
# ip, from its start can't from any place inside it: so they start at the start of a run and don't give characters back, which
# finds the same matches in a time linear in the text.
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = rf"{_LOCAL}++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++"
KINDS = (
    Kind("email", re.compile(rf"(?<!{_LOCAL}){_EMAIL}"), lambda m: True, "@", resumes=re.compile(_EMAIL)),
    Kind("ip", re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}"), lambda m: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.split(".")), "."),
    Kind("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= digit_count(m) <= 19 and luhn(m), ""),
    Kind("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= digit_count(m) <= 15, "+"),
    # Further kinds of this method.
    Kind("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), mod97, "", 0.7, ends=iban_end),
    Kind(
        "card13", re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12}(?![0-9-])"), luhn, "", 0.3,
        re.compile(r"\b(?:card|visa|credit|debit|payment)\b", re.I), 0.4,
    ),
    Kind(
        "national_id", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), national_id, "-", 0.3,
        re.compile(r"\b(?:ssn|social security|national id|tax id)\b", re.I), 0.4,
    ),
)
BASE_KINDS = KINDS[:4]
HAS_DIGIT = re.compile("[0-9]")


def confirmed(kind: Kind, text: str):
    """``(start, end)`` of every match that passes its check."""
    at = 0
    if kind.ends is None:
        while match := (kind.resumes and at and kind.resumes.match(text, at)) or kind.pattern.search(text, at):
            at = match.end()
            if kind.check(match.group()):
                yield match.span()
        return
    while match := kind.pattern.search(text, at):
        start, end = match.start(), kind.ends(text, *match.span())
        if end is not None:
            yield start, end
        at = start + 1 if end is None else end


def spans_of(text: str, kinds=KINDS) -> list[tuple[int, int, int, float]]:
    """``(start, kind number, end, score)`` in order."""
    if not text:
        return []
    digits = HAS_DIGIT.search(text) is not None
    found = []
    for number, kind in enumerate(kinds):
        if kind.needs and kind.needs not in text or not digits and kind.name != "email":
            continue
        for start, end in confirmed(kind, text):
            score = kind.score
            if kind.context and kind.context.search(text[max(0, start - CONTEXT_CHARS) : start] + " \n " + text[end : end + CONTEXT_CHARS]):
                score += kind.raised
            if score >= MIN_SCORE:
                found.append((start, number, end, score))
    return sorted(found)


def written(spans, kinds=KINDS) -> str:
    return ",".join(f"{kinds[number].name}:{start}:{end}" for start, number, end, _ in spans)


def redacted(text: str | None, kinds=KINDS) -> str | None:
    """The text with every span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    if not text:
        return text
    out, done = [], 0
    for start, number, end, _ in spans_of(text, kinds):
        if start < done:
            done = max(done, end)
            continue
        out += [text[done:start], f"[{kinds[number].name.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each base kind, ``base_sha256`` and ``spans`` (all, as kind:start:end)."""

    def search(batch):
        out = {name: [] for name in ("doc_id", *(f"n_{k.name}" for k in BASE_KINDS), "base_sha256", "spans")}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            spans = spans_of(text.as_py())
            base = [s for s in spans if s[1] < len(BASE_KINDS)]
            out["doc_id"].append(doc_id)
            for number, kind in enumerate(BASE_KINDS):
                out[f"n_{kind.name}"].append(sum(s[1] == number for s in base))
            out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            out["spans"].append(written(spans))
        yield out

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{kind.name} long" for kind in BASE_KINDS)
    return arrow_map(bare, search, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with the spans of their texts replaced, and ``n_chars`` (where it is there) counted anew."""
    import pyarrow as pa

    text_at = docs.columns.index("text")
    length_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            texts = [redacted(t.as_py()) for t in batch.column(text_at)]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, type=columns[text_at].type)
            if length_at is not None:
                old = columns[length_at].to_pylist()
                new = [n if t is None else len(t) for n, t in zip(old, texts)]
                columns[length_at] = pa.array(new, type=columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
