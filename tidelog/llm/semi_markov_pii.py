"""Personal data by base patterns and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments (digit counts and groups, check digit, separators, letters,
the words around), not letters or words one by one, and dynamic programming over the words of a stretch
chooses the boundaries and kinds of all its entities together. An entity has at most ``WORDS`` words. One word, and a
value with the name of a secret before it, may have any length; other entities have at most ``LETTERS`` code points. Matches of the base patterns always stay; the field decides the stretches
between them, where it finds numbers without a plus sign, e-mail and IP addresses with spelled signs, card numbers with other
separators, and secrets: runs of 12 and more letters and digits, also of letters alone behind a name such as password or token.

Training maximises the likelihood of labelled stretches, which come from the texts themselves: those
around base matches, the same with the match rewritten in another form, and the same with the match
broken (a wrong check digit, a missing part), where it must not be found. Stretches whose label is no candidate are left out. It reads at most ``SAMPLE``
texts with a mark, those with the smallest hash of their id, and keeps ``MATCHES`` matches and ``STRETCHES`` stretches of
each kind, in one task. Without any base match nothing is added.

Null and empty texts have no spans. Whole texts are read, of any length. Rows are independent: ties
and repeated rows give a row each, empty tables an empty result. Other columns are ignored, or kept by ``masked``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ship, texts
from tidelog.llm.pii_patterns import KINDS, Span, base_spans, digits_of, listed, luhn, overlaps

#: Bounds of training: texts with a mark that it reads, and matches and labelled stretches of each kind that it keeps.
SAMPLE, MATCHES, STRETCHES = 4_000, 150, 300
#: Bounds of an entity.
WORDS, LETTERS = 8, 120
#: All kinds: those of the base patterns, and secrets, which the field alone finds.
ALL = (*KINDS, "secret")

_TRIGGER = re.compile(r"[0-9]{2,}|@|[\[(](?:at|dot|\.)[\])]| dot ", re.I)
_WORD = re.compile(r"\S+")
_EDGE_LEFT, _EDGE_RIGHT = "\"'<[{,;:", "\"'>]},;:.!?"
_SPELLED_AT, _SPELLED_DOT = re.compile(r"[\[(]at[\])]| at ", re.I), re.compile(r"[\[(]dot[\])]| dot ", re.I)
_JOINT = re.compile(r"^[\[(]?(at|dot)[\])]?$", re.I)
_NAMED = re.compile(r"^(password|passwd|pwd|token|secret|api[_-]?key)\b", re.I)
_SECRET = re.compile(r"(?:password|passwd|pwd|token|secret|api[_-]?key)\s?[=:]\s?\"?([A-Za-z0-9_-]{12,})", re.I)
_NAME = r"(?:password|passwd|pwd|token|secret|api[_-]?key)"
#: What may follow a value in its word.
_TAIL = r"(?:[^\sA-Za-z0-9_-]\S*)?"
_NAME_ANYWHERE, _NAME_BEFORE = re.compile(_NAME, re.I), re.compile(rf"(?:\S*[^A-Za-z])?{_NAME}\"?[=:]?", re.I)
_NAMED_VALUE = re.compile(rf"(?:\S*[^A-Za-z\s])?{_NAME}\"?\s?[=:]\s?[\"']?[A-Za-z0-9_-]{{12,}}{_TAIL}", re.I)
#: Letters that a text with a name has, for a cheap test.
_NAME_PARTS = ("passw", "pwd", "token", "secret", "key")
_RUN, _VALUE = re.compile(r"[A-Za-z0-9_-]{12,}"), re.compile(rf"[A-Za-z0-9_-]{{12,}}{_TAIL}")
_IP_DOT = r"(?:\s?[\[(](?:\.|dot)[\])]\s?|\s+dot\s+)"
_SPELLED_IP = re.compile(rf"[0-9]{{1,3}}(?:{_IP_DOT}[0-9]{{1,3}}){{3}}", re.I)
_GROUP = re.compile(r"[0-9]+")
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_REACH, _EPOCHS, _RATE, _DECAY = 40, 14, 0.08, 1e-4


def _trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    while end > begin and text[end - 1] in _EDGE_RIGHT:
        end -= 1
    while begin < end and text[begin] in _EDGE_LEFT:
        begin += 1
    return begin, end


def _mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def _named(s: str, before: str) -> bool:
    """Whether a segment is a run behind a name, of letters alone only behind a sign or with capitals inside."""
    return bool(_VALUE.fullmatch(s) and _NAME_BEFORE.fullmatch(before) and (before[-1] in "=:" or _mixed(s) or any(c.isupper() for c in s[1:])))


def features(text: str, begin: int, end: int, words: int, before: str, after: str) -> np.ndarray:
    """Whole-span features of a candidate segment between the words ``before`` and ``after``."""
    s = text[begin:end]
    digits = digits_of(s)
    n = len(digits)
    groups = _GROUP.findall(s)
    sizes = [len(g) for g in groups]
    letters = sum(c.isalpha() for c in s)
    spaced, parts = f" {s} ", s.split()
    longest = max((len(w) for w in re.findall(r"[A-Za-z0-9_-]+", s) if _mixed(w)), default=0)
    bare = letters == 0
    return np.array(
        [
            1.0,
            bare and n < 7, bare and 7 <= n <= 9, bare and n == 10, bare and 11 <= n <= 12, bare and 13 <= n <= 15, bare and n == 16, bare and 17 <= n <= 19, bare and n > 19,
            bare and 13 <= n <= 19 and luhn(digits), bare and 13 <= n <= 19 and not luhn(digits),
            s.startswith("+"), bare and "(" in s and ")" in s, bare and sizes[-3:] == [3, 3, 4], bare and sizes[:4] == [4, 4, 4, 4],
            bare and len(groups) == 1, bare and len(set(re.sub(r"[0-9]", "", s))) > 2,
            bare and len(groups) == 4 and s.count(".") == 3 and all(int(g) <= 255 for g in groups), bare and len(groups) == 4 and s.count(".") == 3 and any(int(g) > 255 for g in groups),
            s.count("@") == 1 and not s.startswith("@") and "." in s.partition("@")[2].strip("."), "@" in s,
            bool(_SPELLED_AT.search(spaced) and (_SPELLED_DOT.search(spaced) or "." in s)) and words >= 2, bool(_SPELLED_DOT.search(spaced)),
            longest >= 12, longest >= 16, longest >= 12 and bool(_NAMED.match(s)), longest >= 12 and bool(_NAMED.match(before)),
            letters > 0 and longest == 0 and "@" not in s and not _NAMED_VALUE.fullmatch(s), words / WORDS, min(len(s) / LETTERS, 1.0), s[:1] in "-./" or s[-1:] in "-/(",
            bool(_JOINT.match(before)), bool(_JOINT.match(after)), bool(_JOINT.match(parts[0])), bool(_JOINT.match(parts[-1])),
            bool(_NAMED_VALUE.fullmatch(s)), _named(s, before), bool(_SPELLED_IP.fullmatch(s)) and all(int(g) <= 255 for g in groups),
        ],
        dtype=np.float64,
    )


def _possible(s: str, before: str) -> bool:
    """A cheap test that leaves out segments of which no kind can be."""
    n = sum(c.isdigit() and c.isascii() for c in s)
    if "@" in s or n >= 7:
        return True
    if _SPELLED_AT.search(f" {s} ") and (_SPELLED_DOT.search(f" {s} ") or "." in s):
        return True
    if n >= 4 and _SPELLED_IP.fullmatch(s):
        return True
    if len(s) < 12:
        return False
    return bool(n and any(map(_mixed, _RUN.findall(s))) or _NAMED_VALUE.fullmatch(s) or _named(s, before))


class Stretch:
    """Words of a piece of text with its candidate segments, for training and decoding."""

    def __init__(self, text: str, begin: int, end: int) -> None:
        self.words = [m.span() for m in _WORD.finditer(text, begin, end)]
        self.segments: list[tuple[int, int, int, int]] = []
        rows = []
        for i in range(len(self.words)):
            for j in range(i, min(i + WORDS, len(self.words))):
                b, e = _trimmed(text, self.words[i][0], self.words[j][1])
                if j > i and e - b > LETTERS and not _NAMED_VALUE.fullmatch(text, b, e):
                    continue
                before = text[slice(*self.words[i - 1])] if i else ""
                if e > b and _possible(text[b:e], before):
                    self.segments.append((i, j + 1, b, e))
                    after = text[slice(*self.words[j + 1])] if j + 1 < len(self.words) else ""
                    rows.append(features(text, b, e, j - i + 1, before, after))
        self.x = np.stack(rows) if rows else np.zeros((0, 0))
        self.by_end: dict[int, list[int]] = {}
        for k, (_, j, _, _) in enumerate(self.segments):
            self.by_end.setdefault(j, []).append(k)

    def best(self, w: np.ndarray) -> list[Span]:
        """The highest-scoring segmentation; a word outside entities scores 0."""
        if not self.segments:
            return []
        scores = self.x @ w
        kind, top = scores.argmax(axis=1), scores.max(axis=1)
        value, back = [0.0], [-1]
        for j in range(1, len(self.words) + 1):
            v, b = value[j - 1], -1
            for k in self.by_end.get(j, ()):
                i = self.segments[k][0]
                if value[i] + top[k] > v:
                    v, b = value[i] + top[k], k
            value.append(v)
            back.append(b)
        found, j = [], len(self.words)
        while j > 0:
            k = back[j]
            if k < 0:
                j -= 1
                continue
            i, _, b, e = self.segments[k]
            found.append((ALL[kind[k]], b, e))
            j = i
        return found[::-1]

    def gradient(self, w: np.ndarray, gold: list[Span]) -> np.ndarray:
        """Gradient of the log likelihood of the labelled segmentation: its features less the expected ones."""
        if not self.segments:
            return np.zeros_like(w)
        scores = self.x @ w
        n = len(self.words)
        forward, backward = np.zeros(n + 1), np.zeros(n + 1)
        per = np.logaddexp.reduce(scores, axis=1)
        by_begin: dict[int, list[int]] = {}
        for k, (i, _, _, _) in enumerate(self.segments):
            by_begin.setdefault(i, []).append(k)
        for j in range(1, n + 1):
            forward[j] = np.logaddexp.reduce([forward[j - 1], *(forward[self.segments[k][0]] + per[k] for k in self.by_end.get(j, ()))])
        for i in range(n - 1, -1, -1):
            backward[i] = np.logaddexp.reduce([backward[i + 1], *(backward[self.segments[k][1]] + per[k] for k in by_begin.get(i, ()))])
        begins, ends = np.array([s[0] for s in self.segments]), np.array([s[1] for s in self.segments])
        expected = np.exp(forward[begins][:, None] + scores + backward[ends][:, None] - forward[n])
        wanted = np.zeros_like(scores)
        places = {(b, e): k for k, (_, _, b, e) in enumerate(self.segments)}
        for kind, b, e in gold:
            if (b, e) in places:
                wanted[places[b, e], ALL.index(kind)] = 1.0
        return self.x.T @ (wanted - expected)


def _marks(text: str) -> list[tuple[int, int]]:
    """Where a text has numbers, address signs, names of secrets, and long runs of letters and digits."""
    marks = [m.span() for m in _TRIGGER.finditer(text)]
    marks += [m.span() for m in _RUN.finditer(text) if _mixed(m[0])]
    low = text.lower()
    if any(part in low for part in _NAME_PARTS):
        marks += [m.span() for m in _NAME_ANYWHERE.finditer(text)]
    return sorted(marks)


def stretches(text: str, taken: list[Span], marks: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
    """The pieces of text around its marks, without the spans already taken."""
    # Whole words, whatever their length: each letter is passed once, since a mark inside the last piece adds none.
    pieces: list[list[int]] = []
    for b, e in _marks(text) if marks is None else marks:
        last = pieces[-1][1] if pieces else 0
        if e + _REACH <= last:
            continue
        b, e = max(last, b - _REACH), min(len(text), e + _REACH)
        while b > last and not text[b - 1].isspace():
            b -= 1
        while e < len(text) and not text[e].isspace():
            e += 1
        if pieces and b == last:
            pieces[-1][1] = e
        else:
            pieces.append([b, e])
    free = []
    for b, e in pieces:
        at = max(b, free[-1][1] if free else 0)
        for _, s, t in taken:
            if t <= at or s >= e:
                continue
            if s > at:
                free.append((at, s))
            at = t
        if at < e:
            free.append((at, e))
    return free


def added_spans(text: str, base: list[Span], w: np.ndarray | None) -> list[Span]:
    """Spans that the field adds to the base ones; none of them meets a base span."""
    if w is None or not (marks := _marks(text)):
        return []
    taken = sorted(base, key=lambda s: (s[1], s[2]))
    merged: list[Span] = []
    for kind, s, t in taken:
        if merged and s < merged[-1][2]:
            merged[-1] = (merged[-1][0], merged[-1][1], max(t, merged[-1][2]))
        else:
            merged.append((kind, s, t))
    begins = [s for _, s, _ in merged]
    found = [x for b, e in stretches(text, merged, marks) for x in Stretch(text, b, e).best(w)]
    return [x for x in found if not overlaps(merged, begins, x[1], x[2])]


def _rewritten(kind: str, s: str, rng: random.Random) -> str:
    """The same datum in a form that the base patterns do not match."""
    digits = digits_of(s)
    if kind == "email":
        at, dot = rng.choice(((" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) ")))
        local, _, domain = s.partition("@")
        return local + at + dot.join(domain.split("."))
    if kind == "card":
        return rng.choice((".", "  ", " - ")).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == "phone":
        local = digits[-10:].rjust(10, "5")
        return rng.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}")).format(local[:3], local[3:6], local[6:])
    if kind == "ip":
        return rng.choice(("[.]", "(.)", "[dot]", " dot ")).join(s.split("."))
    if kind == "secret":
        # Another value with 0 to 6 digits, behind this or another name.
        size = rng.randint(12, 40)
        name = rng.choice((s[: s.rindex(_RUN.findall(s)[-1])], "password=", 'token = "', "api_key: ", "secret = "))
        value = rng.choices(_LETTERS if rng.random() < 0.7 else _LETTERS[:26], k=size)
        for at in rng.sample(range(size), rng.randint(0, 6)):
            value[at] = rng.choice("0123456789")
        return name + "".join(value)
    return s


def _broken(kind: str, s: str, rng: random.Random) -> str:
    """Something alike that is no such datum."""
    digits = digits_of(s)
    if kind == "email":
        return rng.choice((s.partition("@")[0] + "@", "@" + s.partition("@")[0], s.partition("@")[0] + " at the " + s.partition("@")[2].split(".")[0]))
    if kind == "ip":
        return rng.choice((s.replace(".", ", "), f"{rng.randint(256, 999)}." + s.partition(".")[2], "20{:02}-{:02}-{:02} {:02}:{:02}:{:02}".format(*(rng.randint(1, 28) for _ in range(6)))))
    if kind == "secret":
        return rng.choice(("part-{}-of-the-series", "chapter-{}-to-the-end", "{}th-anniversary", "version-{}-released")).format(rng.randint(2, 99))
    if kind == "card":
        return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
    return rng.choice((digits[:7], digits[:9], f"{digits[:4]} {digits[4:8]}", f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {digits[:4]}", f"{digits[:3]},{digits[3:6]},{digits[6:9]}"))


def labelled(text: str, rng: random.Random) -> list[tuple[str, str, list[Span]]]:
    """Labelled stretches of one text, each with the kind it comes from: a base match or secret as it is, rewritten, and broken."""
    found = base_spans(text) + [("secret", *m.span()) for m in _SECRET.finditer(text)]
    out = []
    for kind, s, t in found:
        left, right, core = text[max(0, s - _REACH) : s], text[t : t + _REACH], text[s:t]
        others = [x for x in found if x[1:] != (s, t) and x[2] > s - _REACH and x[1] < t + _REACH]
        if others or kind == "secret" and '"' in core:
            core = core.replace('"', "")
        if others:
            left, right = "", ""
        forms = [(core, kind), (_rewritten(kind, core, rng), kind), (_broken(kind, core, rng), None)]
        if kind == "secret":
            # Values are more diverse than other data.
            forms += [(_rewritten(kind, core, rng), kind), (_rewritten(kind, core, rng), kind)]
        for form, label in forms:
            new = f"{left.rstrip()} {form} {right.lstrip()}" if form != core else left + form + right
            b = new.find(form)
            out.append((kind, new, [(label, b, b + len(form))] if label else []))
    return out


def fit(sample: list[str]) -> np.ndarray | None:
    """Weights (features by kinds) from the labelled stretches of some texts; None if they have none."""
    rng = random.Random(7)
    examples = [x for text in sample for x in labelled(text, rng)]
    if not examples:
        return None
    rng.shuffle(examples)
    # Each kind has its share, so that one which fills the sample does not crowd out the others.
    left = dict.fromkeys(ALL, STRETCHES)
    data = []
    for kind, text, gold in examples:
        if left[kind] > 0:
            left[kind] -= 1
            data.append((Stretch(text, 0, len(text)), gold))
    data = [(s, gold) for s, gold in data if s.segments and {x[1:] for x in gold} <= {x[2:] for x in s.segments}]
    if not data:
        return None
    w = np.zeros((data[0][0].x.shape[1], len(ALL)))
    w[0] = -2.0
    squares = np.full_like(w, 1e-6)
    for _ in range(_EPOCHS):
        rng.shuffle(data)
        for i in range(0, len(data), 16):
            g = sum(s.gradient(w, gold) for s, gold in data[i : i + 16]) / 16 - _DECAY * w
            squares += g * g
            w += _RATE * 5 * g / np.sqrt(squares)
    return w


def _smallest_hashes(rows: DataFrame) -> int | None:
    """The bound on ``h`` below which ``SAMPLE`` different ones of texts with a mark lie, or all there are.

    Texts are searched by ascending hash, a share of all at a time that grows until it holds enough.
    """
    marked = F.col("text").rlike(f"[0-9]{{4}}|@|(?i:{_NAME})")
    share = min(1.0, 4 * SAMPLE / max(1, rows.count()))
    while True:
        limit = (1 << 63) - 1 if share >= 1 else -(1 << 63) + int(share * 2.0**64)
        near = rows.where(F.col("h") <= limit).where(marked).select("h").distinct().orderBy("h").limit(SAMPLE)
        bound, n = near.agg(F.max("h"), F.count("*")).first()
        if n >= SAMPLE or share >= 1:
            return bound
        share = min(1.0, 4 * share)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray | None:
    """Weights from a bounded sample of the texts that hold digits, an address sign or the name of a secret."""
    ship(docs.sparkSession)
    rows = docs.select(F.xxhash64(key).alias("h"), F.col(text).alias("text"))
    bound = _smallest_hashes(rows)
    if bound is None:
        return None

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(texts(batch.column(1))):
                rng = random.Random(batch.column(0)[i].as_py())
                spans = base_spans(t) + [("secret", *m.span()) for m in _SECRET.finditer(t)]
                # At most three stretches of a text, so that no text can fill the sample.
                picked = [(k, t[max(0, s - 2 * _REACH) : e + 2 * _REACH][: 4 * _REACH + 2 * LETTERS]) for k, s, e in sorted(rng.sample(spans, min(3, len(spans))))]
                if picked:
                    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in picked]), pa.array([p for _, p in picked])], ["kind", "piece"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = sorted({(k, p) for batch in batches for k, p in zip(*(c.to_pylist() for c in batch.columns), strict=True)})
        random.Random(11).shuffle(pieces)
        chosen = [p for kind in ALL for p in [p for k, p in pieces if k == kind][:MATCHES]]
        w = fit(list(dict.fromkeys(chosen)))
        if w is not None:
            yield pa.RecordBatch.from_arrays([pa.array([w.ravel().tolist()], pa.list_(pa.float64()))], ["w"])

    pieces = rows.where(F.col("h") <= bound).where(F.col("text").rlike(f"[0-9]{{4}}|@|(?i:{_NAME})")).mapInArrow(near, "kind string, piece string")
    # At most three short pieces of each of SAMPLE texts: one task can hold them.
    model = pieces.repartition(1).mapInArrow(learnt, "w array<double>").collect()
    return np.array(model[0]["w"]).reshape(-1, len(ALL)) if model else None


def _in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (ALL.index(s[0]), s[1], s[2]))


def spans(docs: DataFrame, w: np.ndarray | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the base counts, base_sha256 and spans (all spans as ``kind:start:end``, by kind and start) of each text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashed, every = [], [], []
            for t in texts(batch.column(1)):
                base = base_spans(t)
                counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
                hashed.append(hashlib.sha256(listed(base).encode()).hexdigest())
                every.append(listed(_in_order(base + added_spans(t, base, w))))
            by_kind = zip(*counts, strict=True) if counts else ([] for _ in KINDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in by_kind), pa.array(hashed, pa.string()), pa.array(every, pa.string())],
                ["key", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = dict(docs.dtypes)[key]
    schema = f"key {kind}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def mask(text: str, w: np.ndarray | None) -> str:
    """The text with every span replaced by its kind in angle brackets; spans that overlap become one."""
    base = base_spans(text)
    found = sorted(base + added_spans(text, base, w), key=lambda s: (s[1], -s[2]))
    parts, at = [], 0
    for kind, s, e in found:
        if s >= at:
            parts += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def masked(docs: DataFrame, w: np.ndarray | None, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in the text column; null texts stay null."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if v.as_py() is None else mask(v.as_py(), w) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(new, pa.string()), *batch.columns[at + 1 :]], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
