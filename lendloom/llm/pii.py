"""Personal data in texts: exact base rules, and a semi-Markov conditional random field that adds what the rules miss.

The base rules find e-mail addresses, IP addresses, card numbers and phone numbers, leftmost and without overlap per kind; a match
that fails its check is dropped and not tried again. So a rule loses an entity that runs into a neighbour ("+1 (826) 555-4081
190.137.223.204" is one phone match with too many digits) or that is written another way ("joe (at) mail dot org").

The field. A text is searched for *regions*: maximal runs of digits and the marks that stand in numbers, and runs around an
at sign or its spelled forms. Entities lie inside a region, so the rest of the text is outside for certain and costs nothing. A region's
tokens are cut into segments: one token outside, or up to ``MOST_TOKENS`` tokens of one kind. A segment's score is the sum of
weights of features of the whole span (its shape, digits, marks, checks such as Luhn's, the words and characters next to it) and of the kind
before it. The best segmentation is found by dynamic programming, linear in the tokens as segments are bounded; boundaries
and kinds are chosen together. A found entity is added if its probability, by the forward-backward sums, is at least ``SURE`` and no base
span overlaps it.

Training (``fit``) maximises the likelihood of segmentations: regions of at most ``SAMPLE_DOCS`` documents, those with the smallest
hash, with the base spans as truth, left out where a failed match makes the truth unclear. From the clean ones variants are made: entities side by side, phone numbers without a
plus, spelled at signs. They show the field what the rules cannot see. The sample is bounded, whatever the corpus.

Null and empty texts have no spans. Texts are read whole; offsets are code points. Repeated rows and ids are rows of their own. Columns
other than id and text are not read, whatever their names.
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
from pyspark.sql import types as T

from lendloom.operators.skew import spread

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, REGIONS_PER_DOC, EPOCHS = 300, 4, 10
MOST_TOKENS, SURE = 24, 0.9

# ---------------------------------------------------------------- the base rules

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is tried from its first digit only: from a later one it would go on, or fail, alike.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def digits(text: str) -> str:
    return NOT_DIGITS.sub("", text)


def luhn(number: str) -> bool:
    """The check digit of a card number."""
    total = 0
    for place, c in enumerate(reversed(number)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign back over the local part and on over the domain: linear, where a plain search tries every start."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def raw_matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Every match of a base rule, and whether it passes the check of its kind."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end, True
    if "." in text:
        for m in IP.finditer(text):
            yield "ip", m.start(), m.end(), octets(m.group())
    for m in CARD.finditer(text):
        number = digits(m.group()) if m.end() - m.start() <= 64 else ""
        yield "card", m.start(), m.end(), 13 <= len(number) <= 19 and luhn(number)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 9 <= len(digits(m.group())) <= 15


def base_spans(text: str | None) -> list[Span]:
    return [(kind, start, end) for kind, start, end, fine in raw_matches(text or "") if fine]


def shown(spans: list[Span]) -> str:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


# ---------------------------------------------------------------- regions and segments

NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[\x20().+/-]{0,3}[0-9])*+")
AT = re.compile(r"@|[\x20]?[(\[]at[)\]][\x20]?|\x20at\x20", re.IGNORECASE)
SPELLED = re.compile(r"\x20dot\x20|[(\[](?:at|dot)[)\]]", re.IGNORECASE)
AFTER = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++", re.IGNORECASE)
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
LEFT_WORD, RIGHT_WORD = re.compile(r"([^\W\d_]+)\W*$"), re.compile(r"^\W*([^\W\d_]+)")
LEAST_DIGITS, MOST_DIGITS = 7, 19


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold entities, in order, without overlap."""
    found = []
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= LEAST_DIGITS and (len(digits(m.group())) >= LEAST_DIGITS or m.group().count(".") >= 3):
            found.append(m.span())
    if "@" in text or SPELLED.search(text):
        done = 0
        for m in AT.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start() and (rest := AFTER.match(text, m.end())) and (m.group() != " at " or SPELLED.search(rest.group())):
                found.append((start, done := rest.end()))
    found.sort()
    merged: list[list[int]] = []
    for start, end in found:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def _kind_of(c: str) -> str:
    return "9" if "0" <= c <= "9" else "a" if c.isalpha() else "_" if not c or c.isspace() else c


class Region:
    """Tokens of a region, its candidate segments (first token, token after the last) and their features."""

    def __init__(self, text: str, start: int, end: int):
        self.start = start
        self.tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
        left, right = LEFT_WORD.search(text[max(0, start - 40):start]), RIGHT_WORD.search(text[end:end + 40])
        around = (left.group(1).lower()[:12] if left else "", right.group(1).lower()[:12] if right else "")
        self.segments: list[tuple[int, int]] = []
        self.features: list[list[str]] = []
        classes = [_kind_of(text[a]) for a, _ in self.tokens]
        # Only an address around an at sign may hold more digits than the longest card number.
        most = MOST_DIGITS if AT.search(text, start, end) is None else end - start
        for i, (a, _) in enumerate(self.tokens):
            if classes[i] not in "9a+(":
                continue
            held = 0
            for j in range(i, min(len(self.tokens), i + MOST_TOKENS)):
                begin, b = self.tokens[j]
                held += (b - begin) if classes[j] == "9" else 0
                if held > most:
                    break
                if classes[j] not in "9a)":
                    continue
                span = text[a:b]
                number = digits(span) if b - a <= 160 else ""
                mailed = AT.search(span) is not None
                if len(number) < LEAST_DIGITS and span.count(".") < 3 and not mailed:
                    continue
                self.segments.append((i, j + 1))
                self.features.append(_features(span, number, mailed, text[a - 1:a], text[b:b + 1], text[max(0, a - 2):a], text[b:b + 2], around, i == 0, j + 1 == len(self.tokens)))


def _features(span: str, number: str, mailed: bool, before: str, after: str, before_two: str, after_two: str, around: tuple[str, str], first: bool, last: bool) -> list[str]:
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    marks = "".join(sorted(set(c for c in span if not c.isalnum())))
    out = ["bias", f"n{min(len(number), 22)}", f"marks{marks}", f"start{_kind_of(span[0])}", f"end{_kind_of(span[-1])}", f"before{_kind_of(before)}", f"after{_kind_of(after)}"]
    if not mailed:
        letters = any(c.isalpha() for c in span)
        out += [f"letters{letters}", f"groups{'-'.join(map(str, groups[:8]))}", f"count{min(len(groups), 9)}"]
        if span.count(".") == 3 and len(groups) == 4 and marks == ".":
            out.append(f"octets{octets(span)}")
        if 13 <= len(number) <= 19 and not letters and not set(marks) - set(" -"):
            out += [f"luhn{luhn(number)}", f"even{len(set(groups)) == 1 or groups[:-1] == [4] * (len(groups) - 1)}"]
        tail = groups[-3:]
        out += [f"tail{'-'.join(map(str, tail))}", f"plus{span[0] == '+'}", f"tail{'-'.join(map(str, tail))}plus{span[0] == '+'}"]
        if span.count("(") != span.count(")"):
            out.append("open bracket")
        if "  " in span or "/" in span:
            out.append("odd gap")
    else:
        parts = AT.split(span)
        domain = re.split(r"\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20", parts[-1], flags=re.IGNORECASE)
        out += [f"ats{min(len(parts) - 1, 3)}", f"local{bool(parts[0]) and all(c in LOCAL for c in parts[0])}", f"labels{min(len(domain), 4)}",
                f"top{domain[-1].isalpha() and 2 <= len(domain[-1]) <= 6}", f"clean{all(re.fullmatch('[A-Za-z0-9-]+', x) for x in domain)}",
                f"more{bool(after) and (after.isalnum() or after == '-' or (after == '.' and after_two[1:].isalnum()))}", f"sooner{before in LOCAL and bool(before)}"]
    if before_two[-1:].isspace() or not before:
        out.append("free left")
    if not after or after.isspace() or (after in ".,;:!?" and not after_two[1:].isalnum()):
        out.append("free right")
    if first:
        out.append(f"left {around[0]}")
    if last:
        out.append(f"right {around[1]}")
    return out


class Field:
    """Weights of a fitted field: features by kind, and kinds after each other (0 is outside)."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, outside: float):
        self.names, self.weights, self.moves, self.outside = names, weights, moves, outside

    def scores(self, region: Region) -> np.ndarray:
        get, w = self.names.get, self.weights
        return np.array([w[[k for f in own if (k := get(f)) is not None]].sum(0) for own in region.features]).reshape(-1, len(KINDS))

    def spans(self, text: str, sure: float = SURE) -> list[tuple[Span, float]]:
        """Entities of the best segmentation whose probability is at least ``sure``."""
        out = []
        for start, end in regions(text):
            region = Region(text, start, end)
            if not region.segments:
                continue
            scores = self.scores(region)
            chosen, chance = decode(region, scores, self.moves, self.outside)
            out += [((KINDS[k], region.tokens[i][0], region.tokens[j - 1][1]), chance[s, k]) for s, (i, j), k in chosen if chance[s, k] >= sure]
        return out


def _by_end(region: Region) -> list[list[int]]:
    ends: list[list[int]] = [[] for _ in range(len(region.tokens) + 1)]
    for s, (_, j) in enumerate(region.segments):
        ends[j].append(s)
    return ends


def _log_sum(values: np.ndarray, axis: int = 0) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis)) + np.squeeze(top, axis)


def sums(region: Region, scores: np.ndarray, moves: np.ndarray, outside: float) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log of the partition sum, and the chances of every (segment, kind), of every move, and of every outside token."""
    n, states = len(region.tokens), len(KINDS) + 1
    ends = _by_end(region)
    into = np.full((n + 1, states), -np.inf)  # entering position i in kind y, before the segment's own score
    upto = np.full((n + 1, states), -np.inf)
    upto[0, 0] = 0
    for at in range(n + 1):
        if at:
            upto[at, 0] = into[at - 1, 0] + outside
            if ends[at]:
                own = np.array(ends[at])
                begins = np.array([region.segments[s][0] for s in own])
                upto[at, 1:] = _log_sum(into[begins, 1:] + scores[own])
        into[at] = _log_sum(upto[at][:, None] + moves)
    total = float(_log_sum(upto[n]))
    after = np.full((n + 1, states), -np.inf)
    after[n] = 0
    starts: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (i, _) in enumerate(region.segments):
        starts[i].append(s)
    ahead = np.full((n + 1, states), -np.inf)  # from position i on, given that a segment of kind y begins there
    for at in range(n - 1, -1, -1):
        ahead[at, 0] = outside + after[at + 1, 0]
        if starts[at]:
            own = np.array(starts[at])
            stops = np.array([region.segments[s][1] for s in own])
            ahead[at, 1:] = _log_sum(scores[own] + after[stops, 1:])
        after[at] = _log_sum(moves + ahead[at][None], 1)
    if region.segments:
        begins, stops = np.array(region.segments).T
        chance = np.exp(into[begins, 1:] + scores + after[stops, 1:] - total)
    else:
        chance = np.zeros((0, len(KINDS)))
    moved = np.exp(upto[:n, :, None] + moves + ahead[:n, None, :] - total).sum(0)
    alone = np.exp(into[:n, 0] + outside + after[1:, 0] - total)
    return total, chance, moved, alone


def decode(region: Region, scores: np.ndarray, moves: np.ndarray, outside: float) -> tuple[list[tuple[int, tuple[int, int], int]], np.ndarray]:
    """The best segmentation's entities (segment, its tokens, kind), and the chance of every (segment, kind)."""
    n, states = len(region.tokens), len(KINDS) + 1
    ends = _by_end(region)
    best = np.full((n + 1, states), -np.inf)
    best[0, 0] = 0
    back: list[list] = [[None] * states for _ in range(n + 1)]
    enter, whence = np.full((n + 1, states), -np.inf), np.zeros((n + 1, states), int)
    for at in range(n + 1):
        if at:
            best[at, 0], back[at][0] = enter[at - 1, 0] + outside, (at - 1, -1)
            for s in ends[at]:
                i = region.segments[s][0]
                for y, value in enumerate(enter[i, 1:] + scores[s], 1):
                    if value > best[at, y]:
                        best[at, y], back[at][y] = value, (i, s)
        reach = best[at][:, None] + moves
        whence[at], enter[at] = reach.argmax(0), reach.max(0)
    chosen, at, y = [], n, int(best[n].argmax())
    while at > 0:
        begin, s = back[at][y]
        if s >= 0:
            chosen.append((s, region.segments[s], y - 1))
        at, y = begin, int(whence[begin, y])
    return chosen[::-1], sums(region, scores, moves, outside)[1]


# ---------------------------------------------------------------- training

def _clear(text: str, start: int, end: int) -> list[Span] | None:
    """The base spans of a region as truth; None if they overlap or if a rule's match failed for its length or its parts."""
    spans = []
    for kind, a, b, fine in raw_matches(text[start:end]):
        if fine:
            spans.append((kind, a + start, b + start))
        elif kind != "card" or len(digits(text[a + start:b + start])) > 19:
            return None
    spans.sort(key=lambda s: s[1])
    return None if any(x[2] > y[1] for x, y in zip(spans, spans[1:])) else spans


def examples(texts: list[str], seed: int = 7) -> list[tuple[Region, list[Span]]]:
    """Clean regions of the texts with their truth, and variants made of them."""
    draw = random.Random(seed)
    out, clean, plain = [], [], []
    for text in texts:
        found = regions(text)
        for start, end in found if len(found) <= REGIONS_PER_DOC else draw.sample(found, REGIONS_PER_DOC):
            if (spans := _clear(text, start, end)) is None:
                continue
            out.append((Region(text, start, end), spans))
            left, right = text[max(0, start - 40):start], text[end:end + 40]
            if len(spans) == 1 and spans[0][1:] == (start, end):
                clean.append((spans[0][0], text[start:end], left, right))
            elif not spans:
                plain.append((text[start:end], left, right))

    def add(left: str, pieces: list[tuple[str | None, str]], right: str, gap: str = " ") -> None:
        text, spans = left, []
        for kind, piece in pieces:
            text += gap if spans or text != left else ""
            if kind:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece
        text += right
        covered = [r for r in regions(text) if r[0] <= len(left) + sum(len(p) + len(gap) for _, p in pieces) and r[1] > len(left)]
        for start, end in covered:
            inside = [s for s in spans if start <= s[1] and s[2] <= end]
            out.append((Region(text, start, end), inside))

    for kind, piece, left, right in clean:
        other = draw.choice(clean)
        add(left, [(kind, piece), (other[0], other[1])], right)
        if plain and draw.random() < 0.5:
            some = draw.choice(plain)[0]
            add(left, [(kind, piece), (None, some)] if draw.random() < 0.5 else [(None, some), (kind, piece)], right)
        if kind == "phone":
            bare = digits(piece)[-10:]
            if len(bare) == 10:
                form = draw.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "1-{}-{}-{}"])
                add(left, [("phone", form.format(bare[:3], bare[3:6], bare[6:]))], right)
        elif kind == "email":
            at, dot = draw.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", ".")])
            name, _, domain = piece.partition("@")
            add(left, [("email", name + at + domain.replace(".", dot))], right)
        elif kind == "card" and len(piece) == 16:
            gap = draw.choice([" ", "-"])
            add(left, [("card", gap.join(piece[k:k + 4] for k in range(0, 16, 4))), (other[0], other[1])], right)
        # Numbers of other uses: dates, times, versions, amounts, long counters.
        a, b, c = (draw.randrange(10 ** k) for k in (2, 3, 9))
        odd = draw.choice([f"20{a:02d}-{1 + a % 12:02d}-{1 + b % 28:02d} {a % 24:02d} 15 00", f"{a}.{b}.{c % 1000}", f"{c}{b}", f"{c % 10**6} {c % 10**5} {b}", f"{c}", f"{b}.{300 + b}.{a}.{a}", f"{c}{c}{b}", f"{b} {b} {b} {a}"])
        add(left, [(None, odd)], right)
    return out


def train(data: list[tuple[Region, list[Span]]], epochs: int = EPOCHS, rate: float = 0.3, pull: float = 1e-4, least: int = 2) -> Field | None:
    """Weights by stochastic gradients (Adagrad) of the log likelihood; None without an entity to learn from."""
    prepared, seen = [], {}
    for region, spans in data:
        places = {(region.tokens[i][0], region.tokens[j - 1][1]): s for s, (i, j) in enumerate(region.segments)}
        gold = [(places.get((a, b)), KINDS.index(k)) for k, a, b in spans]
        if not region.segments or any(s is None for s, _ in gold):
            continue
        prepared.append((region, gold))
        for f in {f for own in region.features for f in own}:
            seen[f] = seen.get(f, 0) + 1
    if not any(gold for _, gold in prepared):
        return None
    names = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    width, states = len(KINDS), len(KINDS) + 1
    weights, grown = np.zeros((len(names), width)), np.full((len(names), width), 1e-6)
    weights[names["bias"]] = -4.0
    moves, moves_grown = np.zeros((states, states)), np.full((states, states), 1e-6)
    ready = []
    for region, gold in prepared:
        lists = [[names[f] for f in own if f in names] for own in region.features]
        flat = np.array([k for own in lists for k in own])
        segment = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
        target = np.zeros((len(lists), width))
        truth = np.zeros((states, states))
        by_start = {region.segments[s][0]: (s, k) for s, k in gold}
        at, last = 0, 0
        while at < len(region.tokens):
            s, k = by_start.get(at, (None, None))
            now = 0 if s is None else k + 1
            truth[last, now] += 1
            if s is not None:
                target[s, k] = 1
            at, last = (at + 1 if s is None else region.segments[s][1]), now
        ready.append((region, flat, segment, np.flatnonzero(np.diff(segment, prepend=-1)), target, truth))
    draw = random.Random(3)
    for _ in range(epochs):
        draw.shuffle(ready)
        for region, flat, segment, firsts, target, truth in ready:
            scores = np.add.reduceat(weights[flat], firsts, axis=0)
            _, chance, moved, _ = sums(region, scores, moves, 0.0)
            gap = target - chance
            if np.abs(gap).max() < 1e-3:
                continue
            used, place = np.unique(flat, return_inverse=True)
            step = np.zeros((len(used), width))
            np.add.at(step, place, gap[segment])
            step -= pull * weights[used]
            grown[used] += step * step
            weights[used] += rate * step / np.sqrt(grown[used])
            step = truth - moved - pull * moves
            moves_grown += step * step
            moves += rate * step / np.sqrt(moves_grown)
    return Field(names, weights, moves, 0.0)


def fit(docs: DataFrame, *, id_column: str = "doc_id", column: str = "text", sample_docs: int = SAMPLE_DOCS) -> Field | None:
    """A field from at most ``sample_docs`` documents with digits or at signs; of a long one, an excerpt of 20,000 characters."""
    some = docs.where(F.col(column).rlike("[0-9@]{2}|[0-9] [0-9]|@"))
    chance = F.xxhash64(F.col(id_column).cast("string"), F.lit("private"))
    rows = docs.count()
    if rows > 20 * sample_docs:
        some = some.where(chance <= int(-(2**63) + 2**64 * (10 * sample_docs / rows)))
    room = F.greatest(F.lit(1), F.length(column) - 20_000 + 1)
    excerpt = F.col(column).substr((F.pmod(chance, room) + 1).cast("int"), F.lit(20_000))
    chosen = some.select(chance.alias("h"), excerpt.alias("t")).orderBy("h", "t").limit(sample_docs)
    return train(examples([r["t"] for r in chosen.collect()]))


# ---------------------------------------------------------------- the operator

def all_spans(text: str | None, field: Field | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and those the field adds."""
    base = base_spans(text)
    added = []
    for span, _ in field.spans(text) if field and text else []:
        if not any(a < span[2] and span[1] < b for _, a, b in base):
            added.append(span)
    return base, added


def find_private(docs: DataFrame, field: Field | None, *, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """Per document: numbers of base spans by kind, their digest, all spans as text, and how many the field added."""
    held = docs.sparkSession.sparkContext.broadcast(field)
    names = [id_column, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def find(batches):
        model = held.value
        for batch in batches:
            rows = []
            for value in batch.column(column):
                base, added = all_spans(value.as_py(), model)
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(shown(base).encode()).hexdigest(), shown(base + added), len(added)))
            columns = [pa.array([r[k] for r in rows], pa.string() if k in (4, 5) else pa.int64()) for k in range(7)]
            yield pa.RecordBatch.from_arrays([batch.column(id_column), *columns], names=names)

    schema = T.StructType([docs.schema[id_column], *(T.StructField(n, T.StringType() if n in ("base_sha256", "spans") else T.LongType()) for n in names[1:])])
    return spread(docs.select(id_column, column)).mapInArrow(find, schema)


