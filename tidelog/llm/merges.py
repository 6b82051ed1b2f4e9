"""Byte-pair vocabularies of public tokenizer files: tables, exact merging and the test of token pairs."""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np

_SHIFT = 20
_NEVER = 1 << 40
_STEP = 9


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary files.

    Printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one vocabulary file.

    ``ids`` maps a token's text to its id; ``suffix`` marks the last letter of a word (or is empty).
    ``rank[t]`` is the order of the merge that makes token t, -1 for letters; ``left[t]`` and
    ``right[t]`` are its two parts.

    ``child`` is a trie over the tokens' letters: ``node << 9 | byte`` gives the next node, 0 is the
    root. ``token_at[node]`` is the token that ends there, ``last_at[node]`` the one with the suffix
    that ends a word, -1 for none.
    """

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.specials.values()])
        self.tokens = [""] * size
        for text, i in [*self.ids.items(), *self.specials.items()]:
            self.tokens[i] = text
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left = np.zeros(size, dtype=np.int64)
        self.right = np.zeros(size, dtype=np.int64)
        self._order: dict[int, int] = {}
        self._made: list[int] = []
        for order, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = self.ids[a + b]
            self._made.append(made)
            self._order.setdefault(self.ids[a] << _SHIFT | self.ids[b], order)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = order, self.ids[a], self.ids[b]
        self._spelling = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        keys = np.fromiter(self._order, dtype=np.int64, count=len(self._order))
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.fromiter(self._order.values(), dtype=np.int64, count=len(self._order))[order]
        self._rank_list, self._left_list, self._right_list = self.rank.tolist(), self.left.tolist(), self.right.tolist()
        # Tokens that merging their own letters does not give back can never stand in an encoding.
        self.child: dict[int, int] = {}
        self.token_at, self.last_at = [-1], [-1]
        byte_of = {c: b for b, c in byte_letters().items()}
        for text, i in self.ids.items():
            if self.merge(self.symbols(text)) != [i]:
                continue
            ends_word = self.suffix and text.endswith(self.suffix) and text != self.suffix
            node = 0
            for c in text[: -len(self.suffix)] if ends_word else text:
                step = node << _STEP | byte_of[c]
                if step not in self.child:
                    self.child[step] = len(self.token_at)
                    self.token_at.append(-1)
                    self.last_at.append(-1)
                node = self.child[step]
            if ends_word or not self.suffix:
                self.last_at[node] = i
            if not ends_word:
                self.token_at[node] = i

    def spelled(self, word: str) -> str:
        """The word in the letters of the vocabulary, one for each byte."""
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._spelling)

    def symbols(self, spelled: str) -> list[int]:
        """Ids of the letters; a word's last letter carries the suffix."""
        body = spelled
        if self.suffix and spelled.endswith(self.suffix):
            body = spelled[: -len(self.suffix)]
            if body:
                return [*(self.ids[c] for c in body[:-1]), self.ids[body[-1] + self.suffix]]
            body = spelled
        return [self.ids[c] for c in body]

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging: the pair of the lowest rank first, the leftmost of equal ones."""
        if len(symbols) > 48:
            return self._merge_long(symbols)
        s, order_of, made = list(symbols), self._order.get, self._made
        orders = [order_of(a << _SHIFT | b, _NEVER) for a, b in zip(s, s[1:], strict=False)]
        while orders:
            lowest = min(orders)
            if lowest == _NEVER:
                break
            i = orders.index(lowest)
            s[i : i + 2] = [made[lowest]]
            del orders[i]
            if i < len(orders):
                orders[i] = order_of(s[i] << _SHIFT | s[i + 1], _NEVER)
            if i:
                orders[i - 1] = order_of(s[i - 1] << _SHIFT | s[i], _NEVER)
        return s

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap and links, so that a word of n letters takes n log n steps."""
        value, n = list(symbols), len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (order := self._order.get(value[i] << _SHIFT | value[j])) is not None:
                heapq.heappush(heap, (order, i, value[i], value[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            order, i, a, b = heapq.heappop(heap)
            j = after[i]
            if value[i] != a or j < 0 or value[j] != b:
                continue
            value[i], value[j] = self._made[order], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [v for v in value if v >= 0]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the letters of both tokens together gives the two tokens.

        Time runs backwards over the merges that made them. ``a`` and ``b`` are the pieces at the seam;
        the one made last is taken apart. If the pair at the seam merges before the younger piece gets
        consumed, the seam would have closed. Of equal merges the left one comes first, so a piece on
        the right is consumed half a step late.
        """
        rank, left, right, order_of = self._rank_list, self._left_list, self._right_list, self._order.get
        bound = 2 * _NEVER
        while True:
            if 2 * order_of(a << _SHIFT | b, _NEVER) < bound:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                bound, a = 2 * ra, right[a]
            else:
                bound, b = 2 * rb + 1, left[b]

    def all_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays of pairs, all walked backwards together."""
        good = np.ones(len(a), dtype=bool)
        a, b = a.astype(np.int64), b.astype(np.int64)
        bound = np.full(len(a), 1 << 40, dtype=np.int64)
        at = np.arange(len(a))
        while len(at):
            key = a << _SHIFT | b
            i = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            bad = (self._keys[i] == key) & (2 * self._ranks[i] < bound)
            good[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            a, b, at, ra, rb = a[go], b[go], at[go], ra[go], rb[go]
            first = ra > rb
            bound = np.where(first, 2 * ra, 2 * rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good


@lru_cache(maxsize=4)
def vocabulary(content: bytes) -> Vocabulary:
    """The tables of a file's content, made once in each worker."""
    return Vocabulary(content)
