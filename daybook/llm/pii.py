"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, schemes and identifier cues; digit runs
and plus signs are the anchors of numbers. Around each anchor a local parser
expands to both sides and validates what it has found. Parsers read every
character a bounded number of times, so very long texts take linear time.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("masked_email", "login", "secret", "iban", "ssn", "account")

# The cues, each also looked for in upper case and capitalised.
CUES = {
    "secret": "token secret password passwd api_key api-key apikey",
    "iban": "iban",
    "ssn": "ssn",
    "account": "account acct konto cuenta compte",
    "masked_email": "[at] (at)",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_PHONE_RUN = re.compile(r"[\x20().0-9-]*")
_MASKED = re.compile(r"\s?([A-Za-z0-9-]+(?:\s?[\[(]dot[\])]\s?[A-Za-z0-9-]+)+)", re.I)
_LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_SECRET = re.compile(r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_+/=.-]{8,})")
_IBAN = re.compile(r"[\s:#]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[\s:#]{0,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"(?:\s(?:number|no\.?|nr\.?))?[\s:=#]{1,3}([0-9](?:[\x20-]?[0-9]){5,17})(?![0-9])", re.I)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("login", 3))
    for kind, cues in CUES.items():
        for cue in cues.split():
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _left_of(text: str, end: int, floor: int) -> int:
    """Start of the run of local-part characters that ends before ``end``."""
    start = end
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    return start


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def _iban_ok(text: str) -> bool:
    compact = text.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _octet(part: str) -> bool:
    small = part.lstrip("0")
    return len(small) <= 3 and int(small or 0) <= 255


def _ips(text: str):
    for chain in _DOTTED.finditer(text):
        if chain.end() - chain.start() < 7:
            continue
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(_octet, four)):
                yield "ip", at, end
            at = end + 1


def _cards(text: str):
    for run in _CARD.finditer(text):
        if run.end() - run.start() < 12:
            continue
        digits = run.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield "card", run.start(), run.end()


def _phones(text: str):
    at = text.find("+")
    while at >= 0:
        end = at + 1
        if text[end : end + 1] in tuple("0123456789"):
            run = _PHONE_RUN.match(text, at + 2).group().rstrip(" ().-")
            if len(run) >= 2:
                end = at + 2 + len(run)
                if 9 <= 1 + sum(map(run.count, "0123456789")) <= 15:
                    yield "phone", at, end
        at = text.find("+", end)


def _anchored(text: str):
    """Spans around the automaton's finds."""
    email_end = 0
    for last, (kind, size) in _automaton().iter(text):
        first, after = last - size + 1, last + 1
        if kind == "email":
            start = _left_of(text, first, email_end)
            domain = _DOMAIN.match(text, after) if start < first else None
            if domain:
                email_end = domain.end()
                yield "email", start, email_end
        elif kind == "masked_email":
            end = first - 1 if text[first - 1 : first] == " " else first
            start = _left_of(text, end, 0)
            domain = _MASKED.match(text, after) if start < end else None
            if domain:
                yield kind, start, domain.end()
        elif kind == "login":
            login = _LOGIN.match(text, after)
            if login:
                yield kind, after, login.end()
        else:
            pattern = {"secret": _SECRET, "iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[kind]
            value = pattern.match(text, after)
            if value and (kind != "iban" or _iban_ok(value[1])):
                yield kind, value.start(1), value.end(1)


_ORDER = {kind: i for i, kind in enumerate(BASE_KINDS + EXTRA_KINDS)}


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind; code points, end exclusive. Null: none."""
    if not text:
        return []
    found = {*_anchored(text), *_ips(text), *_cards(text), *_phones(text)}
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _span_columns(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = find_spans(text)
        base = [s for s in spans if s[0] in BASE_KINDS]
        counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
        rows.append((*counts, _joined(base), _joined(spans)))
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns with n_email, n_ip, n_card, n_phone, base and spans.

    ``spans`` lists kind:start:end of all finds, ``base`` those of the four base kinds.
    A null or empty text has none. Columns of these names are replaced. One map
    stage; nothing is shuffled.
    """
    columns = F.pandas_udf(
        _span_columns, "n_email long, n_ip long, n_card long, n_phone long, base string, spans string"
    )
    names = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans")
    kept = [c for c in docs.columns if c not in names]
    with_found = docs.select(*kept, columns(F.col(text)).alias("_pii"))
    return with_found.select(*kept, *[F.col(f"_pii.{n}").alias(n) for n in names])
