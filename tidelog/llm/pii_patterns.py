"""The base patterns of personal data, matched in time linear in the text."""

from __future__ import annotations

import re
from bisect import bisect_left

# The kinds in the order in which spans are listed, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def _emails(text: str) -> list[Span]:
    # The local part is the run of its letters before the @, as far as no earlier match took them.
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append(("email", begin, domain.end()))
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return found


def _ips(text: str) -> list[Span]:
    # A chain of dotted numbers holds one match in each four of them.
    found = []
    for chain in _NUMBERS.finditer(text):
        if chain[0].count(".") < 3:
            continue
        parts, at = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[i : i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                found.append(("ip", at, end))
            at = end + 1
    return found


def base_spans(text: str) -> list[Span]:
    """Kind, start and end (exclusive) in code points of all base matches, by kind as listed and then by start."""
    found = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        found += _ips(text)
        for m in _CARD.finditer(text):
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def overlaps(spans: list[Span], begins: list[int], start: int, end: int) -> bool:
    """Whether [start, end) meets one of the spans, which are sorted by start and do not overlap."""
    i = bisect_left(begins, end)
    return i > 0 and spans[i - 1][2] > start
