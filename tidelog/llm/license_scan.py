"""Licence scans: templates with optional and replaceable regions, compiled into token automata.

A template is licence wording in which ``[[...]]`` marks words that may be left out (nested as one
likes) and ``{{a..b}}`` a place that a to b words of any text fill, such as a name. It is compiled into
an automaton over words: an arc for each word of the wording, arcs that read nothing around optional
regions, and arcs that read any word for replaceable ones. Text matches where the automaton gets from
its start to its end, so all mandatory wording must stand word for word. The automata of all templates
run together; their sets of states are named when first met, so that a step is one look-up. Of matches
with one start the longest counts, and the next match starts after it.

A text is scanned only if it has, for some template, that one's longest mandatory run; nothing else can match.
From each word that can begin a match the automaton reads on until no state is left, which the lengths
of the templates bound, so a text takes time in proportion to its length.

Beside the templates, plain phrases are found at all places, overlaps included, word for word.

Null and empty texts have no words and no matches, and score 0. The score of a text is the share of its words
that stand in a match or phrase. Case of A-Z and everything between words are ignored; templates also ignore
typographic marks around words and take spellings such as licence and license as one. Rows are
independent: ties and repeated rows give a row each, an empty table an empty one. Texts are read
whole. Columns other than the key and the text are ignored; keys of any type are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ship
from tidelog.llm.license_templates import EQUIVALENT, PHRASES, TEMPLATES

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"\[\[|\]\]|\{\{\s*(\d+)\.\.(\d+)\s*\}\}")
#: Marks that may stick to a word because they are not ASCII: quotes, dashes, dots and signs.
_MARKS = [c.encode() for c in "“”„‘’‚«»–—…©®™·• "]
_EQUAL = {a.encode(): b.encode() for a, b in EQUIVALENT.items()}
_VARIED = re.compile(b"|".join([rb"[\x80-\xff]", *(rb"\b%s\b" % w for w in _EQUAL)]))
#: Sets of states that a worker names before it starts again.
NAMES = 200_000


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters a-z, digits and all that is not ASCII, A-Z as a-z."""
    return _WORD.findall(text.lower())


def plain(word: bytes) -> bytes:
    """A word as templates see it; empty if it consists of marks."""
    if word.isascii():
        return _EQUAL.get(word, word)
    for mark in _MARKS:
        word = word.replace(mark, b"")
    return _EQUAL.get(word, word)


class Templates:
    """The automata of several labelled templates, run together."""

    def __init__(self, templates: Sequence[tuple[str, str]]) -> None:
        self.on_word: list[dict[bytes, int]] = []
        self.on_any: list[int] = []
        self.free: list[list[int]] = []
        self.label: dict[int, str] = {}
        self.starts: list[int] = []
        self.needed: list[bytes] = []
        for label, markup in templates:
            start = self._state()
            end, runs = self._compile(markup, start)
            if not runs:
                raise ValueError(f"template of {label} has no mandatory wording")
            if any(self.on_any[s] >= 0 for s in self._closed([start])):
                raise ValueError(f"template of {label} begins with a replaceable region")
            self.label[end] = label
            self.starts.append(start)
            self.needed.append(b" " + b" ".join(max(runs, key=len)) + b" ")
        self._reset()

    def _state(self) -> int:
        self.on_word.append({})
        self.on_any.append(-1)
        self.free.append([])
        return len(self.free) - 1

    def _compile(self, markup: str, at: int) -> tuple[int, list[list[bytes]]]:
        """Adds a template's states after ``at``; gives the last one and the runs of mandatory words."""
        opened: list[int] = []
        runs: list[list[bytes]] = [[]]
        begin = 0

        def wording(part: str) -> None:
            nonlocal at
            for word in map(plain, words_of(part.encode())):
                if word:
                    after = self._state()
                    self.on_word[at][word] = after
                    at = after
                    if not opened:
                        runs[-1].append(word)

        for m in _MARKUP.finditer(markup):
            wording(markup[begin : m.start()])
            begin = m.end()
            if m[0] == "[[":
                # A state of its own, so that arcs of the region do not meet those of the wording before it.
                inner = self._state()
                self.free[at].append(inner)
                opened.append(at)
                at = inner
            elif m[0] == "]]":
                if not opened:
                    raise ValueError(f"]] without [[ in {markup[:60]!r}")
                after = self._state()
                self.free[at].append(after)
                self.free[opened.pop()].append(after)
                at = after
            else:
                least, most = int(m[1]), int(m[2])
                end = self._state()
                for i in range(most):
                    if i >= least:
                        self.free[at].append(end)
                    after = self._state()
                    self.on_any[at] = after
                    at = after
                self.free[at].append(end)
                at = end
            if runs[-1] and not (m[0] in ("[[", "]]") and opened):
                runs.append([])
        wording(markup[begin:])
        if opened:
            raise ValueError(f"[[ without ]] in {markup[:60]!r}")
        return at, [r for r in runs if r]

    def _closed(self, states: Sequence[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _reset(self) -> None:
        self._names: dict[frozenset[int], int] = {}
        self._sets: list[frozenset[int]] = []
        self._steps: list[dict[bytes, int]] = []
        self._others: list[int] = []
        self._found: list[tuple[str, ...]] = []
        self._dead = self._name(frozenset())
        self._first = self._name(self._closed(self.starts))
        self.first_words = {w for s in self._sets[self._first] for w in self.on_word[s]}

    def _name(self, states: frozenset[int]) -> int:
        name = self._names.get(states)
        if name is None:
            name = self._names[states] = len(self._sets)
            self._sets.append(states)
            self._steps.append({})
            self._others.append(-1)
            self._found.append(tuple(sorted({self.label[s] for s in states if s in self.label})))
        return name

    def _step(self, name: int, word: bytes) -> int:
        states = self._sets[name]
        known = any(word in self.on_word[s] for s in states)
        if not known and self._others[name] >= 0:
            return self._others[name]
        after = [self.on_word[s][word] for s in states if word in self.on_word[s]]
        after += [self.on_any[s] for s in states if self.on_any[s] >= 0]
        target = self._name(self._closed(after))
        if known:
            self._steps[name][word] = target
        else:
            self._others[name] = target
        return target

    def possible(self, joined: bytes) -> bool:
        """Whether some template's longest mandatory run stands in text given as words between blanks."""
        return any(run in joined for run in self.needed)

    def matches(self, words: Sequence[bytes]) -> list[tuple[int, int, tuple[str, ...]]]:
        """(first word, end, labels) of the matches from the left; empty words are passed over."""
        if len(self._sets) > NAMES:
            self._reset()
        found, free_from, n = [], 0, len(words)
        first_words, steps, accepted = self.first_words, self._steps, self._found
        for start, word in enumerate(words):
            if start < free_from or word not in first_words:
                continue
            state, best, at = self._first, None, start
            while at < n:
                word = words[at]
                at += 1
                if not word:
                    continue
                after = steps[state].get(word)
                state = self._step(state, word) if after is None else after
                if state == self._dead:
                    break
                if accepted[state]:
                    best = (start, at, accepted[state])
            if best:
                found.append(best)
                free_from = best[1]
        return found


@lru_cache(maxsize=8)
def compiled(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(templates)


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Numbers of the words at which a phrase starts, overlaps included, in words between blanks."""
    wanted, at, number, counted = b" " + phrase + b" ", -1, 0, 0
    while (at := joined.find(wanted, at + 1)) >= 0:
        number += joined.count(b" ", counted, at)
        counted = at
        yield number


def _covered(spans: list[tuple[int, int]]) -> int:
    total = last = 0
    for first, end in sorted(spans):
        total += max(0, end - max(first, last))
        last = max(last, end)
    return total


def scan(
    df: DataFrame,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    phrases: Mapping[str, str] = PHRASES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, n_words, score, and matches: array of (label, first_word, end_word, phrase) in order of words.

    ``phrase`` tells plain phrases from templates. Words are counted from 0, the end is the word after.
    """
    ship(df.sparkSession)
    rules, wanted = tuple(templates), [(p.encode(), label, len(p.split())) for p, label in phrases.items()]

    def one(automata: Templates, data: bytes) -> tuple[int, float, list[dict]]:
        words = words_of(data)
        joined = b" ".join([b"", *words, b""])
        found = [(at, at + size, label, True) for phrase, label, size in wanted for at in places(joined, phrase)]
        if _VARIED.search(joined):
            words_seen = [plain(w) for w in words]
            joined = b" ".join([b"", *filter(None, words_seen), b""])
        else:
            words_seen = words
        if automata.possible(joined):
            found += [(first, end, label, False) for first, end, labels in automata.matches(words_seen) for label in labels]
        covered = _covered([f[:2] for f in found])
        spans = [dict(label=label, first_word=a, end_word=b, phrase=p) for a, b, label, p in sorted(found)]
        return len(words), covered / len(words) if words else 0.0, spans

    kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("phrase", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = compiled(rules)
        for batch in batches:
            rows = [one(automata, value.as_py() or b"") for value in batch.column(1)]
            sizes, scores, spans = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "score", "matches"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    schema = "n_words long, score double, matches array<struct<label: string, first_word: long, end_word: long, phrase: boolean>>"
    return rows.mapInArrow(run, f"key {dict(df.dtypes)[key]}, {schema}").withColumnRenamed("key", key)


def labels_of(matches: Column) -> Column:
    """Distinct labels of matches in ascending order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
