r"""Personal data by fixed rules and a semi-Markov conditional random field.

Base spans are leftmost non-overlapping matches of fixed patterns per kind; those that
fail a check are dropped. The field adds spans. Around digits, at-signs and the like a
text is cut into zones of tokens; a segment of up to ``LONGEST`` tokens is scored as a
whole for each kind (what it matches, how many digits, how it starts and ends, what
stands beside it, a cue word before it), and a dynamic program over segment ends picks
boundaries and kinds together. Base spans are fixed segments: nothing added overlaps
them.

Weights maximise the likelihood (forward and backward sums over all segmentations) of
at most ``max_zones`` different zones of all texts: for each labelled kind a tenth of that
number, those of the smallest text hash, and half of it without labels. Labels are the
base spans and quoted secrets after a cue; each zone is learned again with its surface
changed in several ways (numbers in national forms, at-sign and dots written out) under
the same labels, so that such writings are found too.

Defined results: null is empty and has no spans; rows that repeat a doc_id are
documents of their own; an empty table gives no rows and learns nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import only

#: The kinds in the order of the result; the first four have base patterns.
KINDS = ["email", "ip", "card", "phone", "secret"]
#: The base patterns. An e-mail's part before the sign is looked up backwards.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Runs of digits are entered at their start only, as no later start would fare better.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SECRET = re.compile(r"(?i)\b(?:token|password|passwd|secret|api[_-]?key)\s*[=:]\s*[\"']?([0-9A-Za-z+/_-]{16,})")
#: An at-sign or dot written out is one token, a space on either side included.
AT, DOT = re.compile(r"\s?[\[(]at[\])]\s?"), re.compile(r"\s?[\[(]dot[\])]\s?")
TOKEN = re.compile(r"\s?[\[(](?:at|dot)[\])]\s?|[^\W_]+|\s+|.", re.S)
TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]")
#: What follows where an address could be longer.
GOES_ON = re.compile(r"\s?[\[(]dot[\])]\s?[A-Za-z0-9]|\.?[A-Za-z0-9-]")
RUN = re.compile(r"[^\W_]*")
NATIONAL = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")
#: Words that announce a kind.
CUES = {
    **dict.fromkeys(["mail", "email"], 1),
    **dict.fromkeys(["ip", "host", "server"], 2),
    **dict.fromkeys(["card", "visa", "mastercard"], 3),
    **dict.fromkeys(["tel", "phone", "call", "mobile", "fax"], 4),
    **dict.fromkeys(["token", "password", "passwd", "secret", "key"], 5),
}
#: Tokens of the longest segment.
LONGEST = 24
#: Numbers of values of each feature, in the order of ``features``.
WIDTHS = [21, 3, 3, 4, 7, 18, 16, 8, 6, LONGEST + 1, 4]
OFFSETS = np.r_[0, np.cumsum(WIDTHS)[:-1]]
SIZE = int(np.sum(WIDTHS))

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, at-sign and domain, in time linear in the text."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        spans += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group())]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    spans.append(("phone", *m.span()))
    return spans


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text around triggers, wide enough for any segment with one."""
    start = end = None
    for m in TRIGGER.finditer(text):
        if end is not None and m.end() + 40 <= end:
            continue
        # A zone ends where a word does.
        after = RUN.match(text, min(len(text), m.end() + 40)).end()
        if end is not None and m.start() <= end:
            end = after
            continue
        if end is not None:
            yield max(0, start), end
        start, end = m.start() - 60 if end is None else max(end, m.start() - 60), after
    if end is not None:
        yield max(0, start), end


def features(s: str, tokens: int, left: str, right: str, cue: int) -> list[int]:
    """What a whole segment looks like, one value of each feature."""
    digits = sum(map(str.isdigit, s))
    plain = s.replace(" ", "").replace("-", "")
    mail = 0
    if "@" in s:
        local, _, domain = s.partition("@")
        mail = 2 if LOCAL.fullmatch(local) and DOMAIN.fullmatch(domain) else 1
    ip = (2 if octets(s) else 1) if IP.fullmatch(s) else 0
    card = 0
    if CARD.fullmatch(s):
        card = (3 if luhn(plain) else 2) if 13 <= digits <= 19 else 1
    phone = 0
    if not set(s) - set("+ ().0123456789-"):
        phone = 1 + 2 * (s[0] == "+") + (9 <= digits <= 15) + (digits == 10 and s[0] != "+") * 4
        phone = 6 if NATIONAL.fullmatch(s) else min(phone, 5)
    first = 0 if s[0].isdigit() else 1 if s[0].isalpha() else 2 if s[0] == "+" else 3 if s[0] == "(" else 4
    last = 0 if s[-1].isdigit() else 1 if s[-1].isalpha() else 2
    side = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isalnum() else 3
    code = 0
    if plain.isalnum() and plain.isascii() and tokens == 1:
        code = 1 + (len(s) >= 16) + (len(s) >= 32) + 3 * (0 < digits < len(s))
    spelled = 0
    if AT.search(s):
        local, _, domain = DOT.sub(".", AT.sub("@", s)).partition("@")
        spelled = 1
        if LOCAL.fullmatch(local) and DOMAIN.fullmatch(domain):
            spelled = 2 if left and LOCAL.match(left) or GOES_ON.match(right) else 3
    values = [min(digits, 20), mail, ip, card, phone, first * 3 + last, side(left) * 4 + side(right[:1]), code, cue, tokens, spelled]
    return (OFFSETS + values).tolist()


class Zone:
    """Tokens of a stretch of text and its candidate segments."""

    def __init__(self, text: str, start: int, end: int):
        found = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
        self.tokens = found
        hot = np.array([bool(TRIGGER.search(text, a, b)) or text[a:b] == "at" for a, b in found])
        space = [text[a].isspace() for a, _ in found]
        many = np.r_[0, np.cumsum(hot)]
        cue, cues, age = 0, [], 99
        for a, b in found:
            cues.append(cue if age <= 6 else 0)
            age += 1
            kind = CUES.get(text[a:b].lower())
            if kind:
                cue, age = kind, 0
        self.segments: list[tuple[int, int]] = []
        rows = []
        for i in range(len(found)):
            if space[i]:
                continue
            for j in range(i + 1, min(i + LONGEST, len(found)) + 1):
                if space[j - 1] and "\n" in text[slice(*found[j - 1])]:
                    break
                if space[j - 1] or many[j] == many[i]:
                    continue
                a, b = found[i][0], found[j - 1][1]
                rows.append(features(text[a:b], j - i, text[a - 1 : a], text[b : b + 8], cues[i]))
                self.segments.append((i, j))
        self.rows = np.array(rows, np.int64).reshape(-1, len(WIDTHS))
        self.by_end: list[list[int]] = [[] for _ in range(len(found) + 1)]
        for k, (_, j) in enumerate(self.segments):
            self.by_end[j].append(k)

    def best(self, weights: np.ndarray, fixed: list[tuple[int, int]], margin: float) -> list[tuple[int, int, int]]:
        """(kind, first character, end) of the segments of the best segmentation."""
        if not self.segments:
            return []
        scores = weights[self.rows].sum(axis=1) - margin
        kind = scores.argmax(axis=1)
        top = scores[np.arange(len(kind)), kind]
        total, back = [0.0], [None]
        for j in range(1, len(self.tokens) + 1):
            most, how = total[j - 1], None
            for k in self.by_end[j]:
                i = self.segments[k][0]
                if total[i] + top[k] > most:
                    a, b = self.tokens[i][0], self.tokens[j - 1][1]
                    if not any(a < y and x < b for x, y in fixed):
                        most, how = total[i] + top[k], k
            total.append(most)
            back.append(how)
        out, j = [], len(self.tokens)
        while j:
            if back[j] is None:
                j -= 1
                continue
            i, end = self.segments[back[j]]
            out.append((int(kind[back[j]]), self.tokens[i][0], self.tokens[end - 1][1]))
            j = i
        return out[::-1]

    def gradient(self, weights: np.ndarray, gold: dict[tuple[int, int], int]) -> np.ndarray:
        """Of the log likelihood of the labelled segments."""
        out = np.zeros_like(weights)
        if not self.segments:
            return out
        scores = weights[self.rows].sum(axis=1)
        peak = scores.max(axis=1)
        joint = peak + np.log(np.exp(scores - peak[:, None]).sum(axis=1))
        n = len(self.tokens)
        ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = behind[n] = 0.0
        by_start: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, _) in enumerate(self.segments):
            by_start[i].append(k)
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *[ahead[self.segments[k][0]] + joint[k] for k in self.by_end[j]]])
        for i in range(n - 1, -1, -1):
            behind[i] = np.logaddexp.reduce([behind[i + 1], *[behind[self.segments[k][1]] + joint[k] for k in by_start[i]]])
        ends = np.array(self.segments)
        chance = np.exp(ahead[ends[:, 0], None] + scores + behind[ends[:, 1], None] - ahead[n])
        change = -chance
        for k, (i, j) in enumerate(self.segments):
            kind = gold.get((self.tokens[i][0], self.tokens[j - 1][1]))
            if kind is not None:
                change[k, kind] += 1
        for column in self.rows.T:
            np.add.at(out, column, change)
        return out


def labelled(text: str) -> list[Span]:
    """Base spans, and secrets that a cue announces."""
    spans = base_spans(text)
    spans += [("secret", *m.span(1)) for m in SECRET.finditer(text)]
    return [s for s in spans if not (s[0] == "secret" and any(a < s[2] and s[1] < b for k, a, b in spans if k != "secret"))]


def rewritten(kind: str, s: str, way: int) -> str:
    """A span in another writing, of ``WAYS``."""
    if kind == "email":
        at, dot = [("[at]", "[dot]"), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) ")][way % 4]
        local, _, domain = s.partition("@")
        if way in (1, 2, 4):
            # Names of letters, and two labels of the domain.
            local = re.sub("[0-9]+", "", local).strip(".") or "name"
            domain = ".".join(domain.split(".")[-2:])
        return local + at + domain.replace(".", dot)
    digits = "".join(c for c in s if c.isdigit())
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [re.sub(r"^\+[0-9]{1,3}[ .-]?", "", s), f"{a}-{b}-{c}", f"{a} {b} {c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}"][way]
    return s


WAYS = 5


def changed(text: str, spans: list[Span], way: int) -> tuple[str, list[Span]]:
    """The same zone written otherwise."""
    out, at, moved = "", 0, []
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        s = rewritten(kind, text[a:b], way)
        out += text[at:a]
        moved.append((kind, len(out), len(out) + len(s)))
        # Some end their sentence.
        out, at = out + s + ("." if way % 3 == 1 and text[b : b + 1].isspace() else ""), b
    return out + text[at:], moved


def _places(max_zones: int) -> dict[str, int]:
    """How many zones of each labelled kind are learned from, and without labels ('')."""
    return {**dict.fromkeys(KINDS, max_zones // 10), "": max_zones // 2}


def _zone_texts(max_zones: int):
    """The different zones of smallest hash of a task, by labelled kind. The smallest of
    all tasks are among them."""
    places = _places(max_zones)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[str, int]] = {kind: {} for kind in places}

        def smallest(kind: str) -> dict[str, int]:
            return dict(heapq.nsmallest(places[kind], found[kind].items(), key=lambda z: (z[1], z[0])))

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for zone in {text[a:b] for a, b in zones(text)} if text else ():
                    if len(zone) > 400:
                        continue
                    for kind in {k for k, _, _ in labelled(zone)} or {""}:
                        found[kind][zone] = xxhash.xxh3_64_intdigest(zone.encode()) - 2**63
                        if len(found[kind]) > 8 * places[kind] + 8:
                            found[kind] = smallest(kind)
        rows = [(kind, h, zone) for kind in places for zone, h in smallest(kind).items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds = [pa.string(), pa.int64(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "hash", "zone"])

    return pick


def sample_zones(docs: DataFrame, max_zones: int = 240, text_col: str = "text") -> list[str]:
    """The zones to learn from, by hash."""
    found = only(docs, text=text_col).mapInArrow(_zone_texts(max_zones), "kind string, hash long, zone string")
    by_hash = Window.partitionBy("kind").orderBy("hash", "zone")
    most = F.element_at(F.create_map(*[F.lit(x) for p in _places(max_zones).items() for x in p]), F.col("kind"))
    rows = found.distinct().withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= most)
    return [z for _, z in sorted({(r["hash"], r["zone"]) for r in rows.collect()})]


def train(docs: DataFrame, max_zones: int = 240, rounds: int = 6, text_col: str = "text") -> np.ndarray:
    """Weights (feature values, kinds) from a bounded sample of zones of all texts."""
    sample = sample_zones(docs, max_zones, text_col)
    weights, squares = np.zeros((SIZE, len(KINDS))), np.full((SIZE, len(KINDS)), 1e-6)
    cases = []
    for zone in sample:
        spans = labelled(zone)
        ways = WAYS if {"email", "phone"} & {k for k, _, _ in spans} else min(1, len(spans))
        for text, own in [(zone, spans), *[changed(zone, spans, way) for way in range(ways)]]:
            gold = {(a, b): KINDS.index(k) for k, a, b in own}
            cases.append((Zone(text, 0, len(text)), gold))
        for kind, a, b in spans if ways > 1 else []:
            # A text may hold nothing else.
            alone = rewritten(kind, zone[a:b], WAYS - 1)
            cases.append((Zone(alone, 0, len(alone)), {(0, len(alone)): KINDS.index(kind)}))
    for _ in range(rounds):
        for zone, gold in cases:
            step = zone.gradient(weights, gold) - 0.002 * weights
            squares += step * step
            weights += 0.3 * step / np.sqrt(squares)
    return weights


def find(text: str | None, weights: np.ndarray, margin: float = 1.0) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a whole text."""
    text = text or ""
    base = base_spans(text)
    fixed = sorted((a, b) for _, a, b in base)
    added = []
    for a, b in zones(text):
        near = [s for s in fixed if s[0] < b and a < s[1]] if fixed else []
        added += [(KINDS[k], x, y) for k, x, y in Zone(text, a, b).best(weights, near, margin)]
    return base, added


def in_order(spans: list[Span]) -> str:
    spans = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(weights: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t, weights) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS[:4]]
            base = [hashlib.sha256(in_order(b).encode()).hexdigest() for b, _ in found]
            spans = [in_order(b + a) for b, a in found]
            added = pa.array([len(a) for _, a in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(base, pa.string()), pa.array(spans, pa.string()), added],
                ["doc_id", *[f"n_{k}" for k in KINDS[:4]], "base_sha256", "spans", "n_added"],
            )

    return scan


def scan(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    cols = only(docs, doc_id=id_col, text=text_col)
    kind = cols.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS[:4])
    schema = f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long"
    return cols.mapInArrow(_scan(weights), schema)
