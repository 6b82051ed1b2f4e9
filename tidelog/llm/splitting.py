"""Splitting text into words as the tokenizers' patterns do, with their Unicode classes."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex

# Letters and digits of Unicode 17, which the tokenizer files' library does not know as such.
NEWER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 "
    "10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 "
    "16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 "
    "1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 "
    "1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
#: Texts whose code points are all below this one are split by explicit classes, several times as fast.
_SIMPLE = 0x250


def _newer() -> str:
    spans = [r.split("-") for r in NEWER.split()]
    return "".join(f"\\U{int(r[0], 16):08x}-\\U{int(r[-1], 16):08x}" for r in spans)


@lru_cache(maxsize=8)
def splitter(template: str) -> Callable[[str], list[str]]:
    """The ``findall`` of a pattern; in the template, LETTER, DIGIT and BLANK stand inside character classes."""

    def filled(letter: str, digit: str, blank: str) -> str:
        return template.replace("LETTER", letter).replace("DIGIT", digit).replace("BLANK", blank)

    low = "".join(map(chr, range(_SIMPLE)))
    classes = ["".join(f"\\u{ord(c):04x}" for c in regex.findall(p, low) if c not in "՘") for p in (r"\p{L}", r"\p{N}", r"\s")]
    fast = re.compile(filled(*classes)).findall
    beyond = re.compile(f"[^\\x00-\\u{_SIMPLE - 1:04x}]").search
    newer = _newer()
    slow = regex.compile(filled(r"\p{L}", r"\p{N}", r"\s")).findall
    # Text that holds one of the newer letters is split by the pattern with those letters taken out of the classes.
    has_newer = regex.compile(f"[{newer}]").search
    careful = regex.compile(
        template.replace("[^BLANKLETTERDIGIT]", f"(?:[{newer}]|[^\\s\\p{{L}}\\p{{N}}])")
        .replace("[LETTER]", f"(?:(?![{newer}])\\p{{L}})")
        .replace("[DIGIT]", f"(?:(?![{newer}])\\p{{N}})")
        .replace("BLANK", r"\s")
    ).findall

    def words(text: str) -> list[str]:
        if not beyond(text):
            return fast(text)
        return careful(text) if has_newer(text) else slow(text)

    return words
