"""Personal data: regular expressions propose, checksums confirm, context scores.

Each kind has a pattern, a validator (Luhn for card numbers, mod 97 for bank
account numbers, number ranges for addresses, digit counts for phones) and a
list of context words.  A confirmed span starts at its kind's score, which words
of that list close by raise.  Kinds that a pattern and a checksum cannot settle
alone are kept only if context lifts them over ``THRESHOLD``.
"""

from __future__ import annotations

import bisect
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters searched for context words on either side of a span.
WINDOW = 40
#: Spans below this score are dropped.
THRESHOLD = 0.5
#: What context adds to a score.
CONTEXT = 0.3

SCHEMA = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20/-])[0-9]{3,4}[\x20-]?[0-9]{3,4}(?![0-9-])")


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, digits summed: a multiple of ten."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """First four characters moved to the end, letters as 10 to 35: one modulo 97."""
    s = account.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and a dotted domain, in linear time:
    from each @ back over the local part, not from every character on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


@dataclass(frozen=True)
class Kind:
    """``find`` proposes spans, ``valid`` confirms the text of one; ``needs`` is
    a character without which there is no match (a quick way past clean texts)."""
    name: str
    find: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool]
    score: float
    words: tuple[str, ...]
    base: bool
    needs: str = ""


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


KINDS = (
    Kind("email", emails, lambda s: True, 0.7, ("mail", "contact", "kontakt", "correo", "courriel"), True, "@"),
    Kind("ip", _matches(IP), lambda s: all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in s.split(".")), 0.6,
         ("ip", "host", "server", "address", "adresse", "login"), True, "."),
    Kind("card", _matches(CARD), lambda s: 14 <= len(d := digits_of(s)) <= 19 and luhn(d), 0.6,
         ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"), True),
    Kind("phone", _matches(PHONE), lambda s: 10 <= len(digits_of(s)) <= 15, 0.6,
         ("phone", "tel", "call", "mobile", "fax", "handy", "appel"), True, "+"),
    Kind("iban", _matches(IBAN), mod97, 0.7, ("iban", "account", "konto", "compte", "cuenta", "bank"), False),
    Kind("ssn", _matches(SSN), lambda s: True, 0.3, ("ssn", "social security", "social-security"), False, "-"),
    Kind("local_phone", _matches(LOCAL_PHONE), lambda s: 7 <= len(digits_of(s)) <= 12, 0.3,
         ("phone", "tel:", "tel.", "telefon", "téléphone", "teléfono", "mobile", "fax"), False),
)
ORDER = {k.name: i for i, k in enumerate(KINDS)}
#: Context words stand for themselves: no letter goes on before or behind them ("automobile" is no "mobile").
NEARBY = {k.name: re.compile("(?<![^\\W\\d_])(?:" + "|".join(map(re.escape, k.words)) + ")(?![^\\W\\d_])", re.I) for k in KINDS}
ANY_DIGIT = re.compile("[0-9]")


def in_context(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a context word of ``kind`` stands whole within ``WINDOW`` characters of the span."""
    words = NEARBY[kind]
    if words.search(text, max(0, start - WINDOW), start):
        return True
    return any(m.end() <= end + WINDOW for m in words.finditer(text, end, end + WINDOW + 1))


def spans(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float, bool]]:
    """``(kind, start, end, score, base)`` of the whole text, by start, then kind.

    Offsets are code points, ends exclusive.  Base kinds keep every confirmed
    span.  Others must reach ``threshold`` and may not overlap a base span.
    Null and empty texts have none.
    """
    if not text:
        return []
    digit = ANY_DIGIT.search(text) is not None
    found, taken, lower = [], [], None
    for kind in KINDS:
        if kind.needs and kind.needs not in text or not digit and kind.name != "email":
            continue
        for start, end in kind.find(text):
            if not kind.valid(text[start:end]):
                continue
            score = min(1.0, kind.score + CONTEXT * in_context(kind.name, text, start, end))
            if kind.base:
                found.append((kind.name, start, end, score, True))
                taken.append((start, end))
            elif score >= threshold:
                found.append((kind.name, start, end, score, False))
    taken.sort()
    starts, reach = [s for s, _ in taken], []
    for _, e in taken:
        reach.append(max(e, reach[-1] if reach else 0))

    def clear(start: int, end: int) -> bool:
        i = bisect.bisect_left(starts, end)
        return not i or reach[i - 1] <= start
    found = [s for s in found if s[4] or clear(s[1], s[2])]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def spans_column(text: str = "text", threshold: float = THRESHOLD) -> Column:
    @F.pandas_udf(SCHEMA)
    def of(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "score", "base")
        return texts.map(lambda t: [dict(zip(names, s)) for s in spans(t, threshold)])
    return of(F.col(f"`{text}`"))


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``out``: the spans of each row's whole text, by start.

    Null and empty texts give an empty array; rows, repeated or not, stay as
    they are.
    """
    bounded_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], spans_column(text, threshold).alias(out))


def mask(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in square brackets."""
    bounded_batches(docs.sparkSession)

    def one(t: str | None) -> str | None:
        out, at = [], 0
        for kind, start, end, _, _ in spans(t, threshold):
            if end > at:
                out += [t[at:max(start, at)], f"[{kind}]" if start >= at else ""]
                at = end
        return t if t is None else "".join(out) + t[at:]

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(one)
    return docs.withColumn(text, masked(F.col(f"`{text}`")))
