"""Personal data by a semi-Markov conditional random field beside exact base patterns.

Base patterns (email, ip, card, phone) always count. The field then reads every region of a text that holds a digit or ``@``:
candidate segments are scored by features of the whole span and by the label of the segment before, and a dynamic program over the
region chooses boundaries and types together. Outside the regions every token is ordinary by definition, so the program falls apart
into the regions without loss. Segments that overlap no base span are added under the kind they were given: one of the base kinds, or
one of the field's own, ``account`` (bank account numbers that start with a country) and ``social`` (social security numbers).

A span that the field adds has at most ``MAX_TOKENS`` tokens and, unless it is one token, ``MAX_CHARS`` characters, and neither starts nor
ends with white space; base spans have no limit. The program rolls over the tokens and keeps only the starts that can still be
open, and a few bytes a token to walk back, so a region may be as long as the text.

The weights are trained here: regions labelled by the base patterns are gathered from all documents, one per shape (digits and
letters made alike), and ``TRAIN_REGIONS`` of them are fitted by gradient ascent on the likelihood. Every base kind, and the shapes
without one, has an equal share of these places for its smallest hashes, so that shapes without personal data, which grow with the
corpus, never crowd out a rare kind; a region of several kinds counts for each. Places left over go to the smallest hashes of the rest.
The own kinds have no base pattern: a number is labelled where a cue word ("IBAN", "SSN") stands before it, and the field, whose
features see the span and not the cue, finds others like it under any wording; each trains among several signs (``among_signs``). They have ``OWN_REGIONS`` places each, and a region
that holds the shape of a cued number without a cue is left out of training, as nothing says that it is none. Regions over
``TRAIN_REGION_CHARS`` characters do not train. These bounds are the only sample; scanning covers whole texts of all rows.

Null and empty texts have no spans. Repeated rows give equal rows, a null ``doc_id`` stays null; only ``doc_id`` and ``text`` are read.
With no region to learn from (an empty table) the field adds nothing. Patterns are written so that long runs cost linear time.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from weekloom.llm.common import map_slices

# fixed values: kinds and their order
KINDS = ("email", "ip", "card", "phone")
OWN = ("account", "social")
LABELS = ("other", *KINDS, *OWN)
MAX_TOKENS = 24
MAX_CHARS = 120
TRAIN_REGIONS = 400
OWN_REGIONS = 32
TRAIN_REGION_CHARS = 200
EPOCHS = 40
RATE = 0.3
DECAY = 1e-4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# possessive forms of the base patterns: inside a run of digits no later start can match where the first did not
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# numbers that a cue word stands before, by own kind; the number is group 1
CUED = (
    re.compile(r"\b(?:IBAN|(?i:account(?: number| no\.?)?))[\s:]{1,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"),
    re.compile(r"\b(?:SSN|(?i:social security(?: number| no\.?)?))[\s:]{1,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![A-Za-z0-9-])"),
)
GROUPS = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}")
HINT = re.compile(r"[0-9@]")
# a group of capitals between numbers belongs to their region
CAPITALS = re.compile(r"(?<=[0-9])\x20[A-Z]{4}(?=\x20[A-Z]*[0-9])")
TOKEN = re.compile(r"[A-Za-z0-9]+|\s|.", re.S)
SPACE = re.compile(r"\s")
NOT_DIGIT = re.compile(r"[^0-9]")

_LABEL_PLACES = np.arange(len(LABELS))

Span = tuple[int, int, int]  # start, kind's place, end


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def checks(account: str) -> bool:
    """Whether the check digits of an account number hold: letters count from 10, the first four signs go last, remainder 1 of 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            last = m.end()
        else:
            last = at + 1  # a later address cannot reach over this sign
        at = text.find("@", last)
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of the base patterns, by start and kind."""
    found = emails(text) if "@" in text else []
    if HINT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(found)


def regions(text: str) -> list[tuple[int, int]]:
    """Runs of words with a digit or ``@``, joined by single spaces; an opening sign before a number belongs to its word."""
    out: list[tuple[int, int]] = []
    end = 0
    for m in HINT.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, m.start())
        stop = space.start() if space else len(text)
        group = CAPITALS.match(text, stop)
        stop = group.end() if group else stop
        if out and out[-1][1] == end and start == end + 1 and text[end] == " ":
            out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
        end = stop
    return out


FEATURES = (
    "bias", "at", "many_at", "dot_after_at", "no_digit", "digits<7", "digits<10", "digits<14", "digits<20", "digits>=20", "no_letter",
    "letters", "mixed_word", "plus_first", "bracket_first", "plus_inside", "first_word", "last_word", "space", "edge_space", "dash", "dots=1",
    "dots=2", "dots=3", "dots>3", "four_parts", "luhn", "left_word", "right_word", "left_sign", "right_sign", "long", "one_token", "equals",
    "country_first", "account_checks", "small_letter", "groups_3_2_4",
)
_AT = {name: i for i, name in enumerate(FEATURES)}


@lru_cache(maxsize=20_000)
def features(span: str, left: str, right: str, one: bool) -> tuple[int, ...]:
    """Places of the features that hold for a whole span between its neighbouring characters."""
    digits = NOT_DIGIT.sub("", span)
    n, dots = len(digits), span.count(".")
    name, _, host = span.partition("@")
    letters = any(c.isalpha() for c in span)
    parts = span.split(".")
    account = ACCOUNT.fullmatch(span.replace(" ", "")) is not None
    held = {
        "bias": True, "at": "@" in span, "many_at": span.count("@") > 1, "dot_after_at": bool(name) and "." in host.strip("."),
        "no_digit": n == 0, "digits<7": 0 < n < 7, "digits<10": 7 <= n < 10, "digits<14": 10 <= n < 14, "digits<20": 14 <= n < 20,
        "digits>=20": n >= 20, "no_letter": not letters, "letters": letters and "@" not in span, "mixed_word": letters and n > 0 and "@" not in span,
        "plus_first": span[0] == "+", "bracket_first": span[0] == "(", "plus_inside": "+" in span[1:], "first_word": span[0].isalnum(),
        "last_word": span[-1].isalnum(), "space": " " in span, "edge_space": span[0].isspace() or span[-1].isspace(), "dash": "-" in span,
        "dots=1": dots == 1, "dots=2": dots == 2, "dots=3": dots == 3, "dots>3": dots > 3,
        "four_parts": len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        "luhn": 14 <= n <= 19 and not letters and luhn(digits), "left_word": left.isalnum(), "right_word": right.isalnum(),
        "left_sign": left in "@.+-%_/=:\"'(" and left != "", "right_sign": right in "@-%_/=" and right != "", "long": len(span) > 40,
        "one_token": one, "equals": "=" in span or ":" in span or "/" in span,
        "country_first": account, "account_checks": account and checks(span.replace(" ", "")), "small_letter": any(c.islower() for c in span),
        "groups_3_2_4": GROUPS.fullmatch(span) is not None,
    }
    return tuple(_AT[k] for k, v in held.items() if v)


def described(span: str, left: str, right: str, one: bool) -> tuple[int, ...]:
    """``features``, remembered for short spans only."""
    return (features if len(span) <= MAX_CHARS else features.__wrapped__)(span, left, right, one)


def lattice(region: str, left: str, right: str) -> tuple[list[int], list[tuple[int, int, tuple[int, ...]]]]:
    """Token bounds of a training region and all its candidate segments (first token, token after the last, features), by first token."""
    bounds = [m.start() for m in TOKEN.finditer(region)] + [len(region)]
    segments = []
    for i in range(len(bounds) - 1):
        for j in range(i + 1, min(i + MAX_TOKENS, len(bounds) - 1) + 1):
            a, b = bounds[i], bounds[j]
            if j > i + 1 and (b - a > MAX_CHARS or region[a].isspace()):
                break
            if j > i + 1 and region[b - 1].isspace():
                continue
            before = region[a - 1] if a else left
            after = region[b] if b < len(region) else right
            segments.append((i, j, described(region[a:b], before, after, j == i + 1)))
    return bounds, segments


class SemiCrf:
    """Weights of shape (features, labels) and of moves from one segment's label to the next one's; ``other`` is for single tokens only."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((len(FEATURES), len(LABELS))) if weights is None else weights
        self.moves = np.zeros((len(LABELS), len(LABELS))) if moves is None else moves
        self._rows: dict[tuple[int, ...], np.ndarray] = {}

    def row(self, held: tuple[int, ...], one: bool) -> np.ndarray:
        """Scores of a segment by label."""
        row = self._rows.get(held)
        if row is None:
            if len(self._rows) >= 20_000:
                self._rows.clear()
            row = self.weights[list(held)].sum(axis=0)
            if not one:
                row[0] = -np.inf
            self._rows[held] = row
        return row

    def decode(self, region: str, left: str, right: str) -> list[Span]:
        """The best tiling's segments of a kind, in positions of the region.

        Token by token, over the starts that are still open; of every token and label only the length and the label before are kept.
        """
        size, end = len(LABELS), len(region)
        bounds = array("q")
        lengths, before = bytearray(), bytearray()
        open_starts: deque[tuple[int, bool, np.ndarray]] = deque(maxlen=MAX_TOKENS)  # place, opens with white space, best score by next label
        best = None
        for m in TOKEN.finditer(region):
            a, b = m.start(), m.end()
            bounds.append(a)
            if best is None:
                ahead, came = np.zeros(size), bytes(size)
            else:
                routes = best[:, None] + self.moves
                ahead, came = routes.max(axis=0), routes.argmax(axis=0).astype(np.uint8).tobytes()
            before += came
            blank = region[a].isspace()
            open_starts.append((a, blank, ahead))
            after = region[b] if b < end else right
            rows, reach = [ahead + self.row(described(region[a:b], region[a - 1] if a else left, after, True), True)], [1]
            if not blank:
                for back in range(2, len(open_starts) + 1):
                    s, opens_blank, ahead = open_starts[-back]
                    if b - s > MAX_CHARS:
                        break
                    if not opens_blank:
                        rows.append(ahead + self.row(described(region[s:b], region[s - 1] if s else left, after, False), False))
                        reach.append(back)
            if len(rows) == 1:
                best = rows[0]
                lengths += b"\x01" * size
            else:
                stacked = np.stack(rows)
                top = stacked.argmax(axis=0)
                best = stacked[top, _LABEL_PLACES]
                lengths += bytes(reach[k] for k in top.tolist())
        found, j = [], len(bounds)
        bounds.append(end)
        label = int(best.argmax()) if best is not None else 0
        while j:
            i = j - lengths[(j - 1) * size + label]
            if label:
                found.append((bounds[i], label - 1, bounds[j]))
            j, label = i, before[i * size + label]
        return found[::-1]

    def fit(self, regions_: list[str], cued: Iterable[tuple[str, Span]] = ()) -> SemiCrf:
        """Gradient ascent on the log-likelihood of the base labels and of cued spans; regions whose labels cut a token are left out."""
        data = []
        for region, given in [(r, None) for r in regions_] + list(cued):
            bounds, segments = lattice(region, "", "")
            place = {b: k for k, b in enumerate(bounds)}
            gold, covered = {}, set()
            for start, kind, end in ([given] if given else []) + base_spans(region):
                if start in place and end in place and place[end] - place[start] <= MAX_TOKENS and not covered & set(range(place[start], place[end])):
                    gold[place[start], place[end]] = kind + 1
                    covered |= set(range(place[start], place[end]))
            gold |= {(k, k + 1): 0 for k in range(len(bounds) - 1) if k not in covered}
            if all(key in {(i, j) for i, j, _ in segments} for key in gold):
                matrix = np.zeros((len(segments), len(FEATURES)))
                for row, (_, _, f) in enumerate(segments):
                    matrix[row, list(f)] = 1
                target = np.zeros((len(segments), len(LABELS)))
                for row, (i, j, _) in enumerate(segments):
                    if (i, j) in gold:
                        target[row, gold[i, j]] = 1
                steps = np.zeros_like(self.moves)
                order = [gold[key] for key in sorted(gold)]
                for one, other in zip(order, order[1:]):
                    steps[one, other] += 1
                data.append((len(bounds) - 1, segments, matrix, target, steps))
        memory, move_memory = np.zeros_like(self.weights), np.zeros_like(self.moves)
        for _ in range(EPOCHS):
            for n, segments, matrix, target, steps in data:
                expected, moved = self.expectations(n, segments, matrix)
                gradient = matrix.T @ (target - expected) - DECAY * self.weights
                memory += gradient**2
                self.weights += RATE * gradient / np.sqrt(memory + 1e-8)
                gradient = steps - moved - DECAY * self.moves
                move_memory += gradient**2
                self.moves += RATE * gradient / np.sqrt(move_memory + 1e-8)
        self._rows.clear()
        return self

    def marginals(self, n: int, segments, matrix: np.ndarray) -> np.ndarray:
        """Probability of every (segment, label) under the present weights."""
        return self.expectations(n, segments, matrix)[0]

    def expectations(self, n: int, segments, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of (segment, label) and expected numbers of moves, by the forward and backward recursions in log space."""
        ends = np.array([j for _, j, _ in segments])
        cuts = np.searchsorted([i for i, _, _ in segments], np.arange(n + 1))
        scores = matrix @ self.weights
        scores[ends > np.array([i for i, _, _ in segments]) + 1, 0] = -np.inf
        size = len(LABELS)
        ahead, enter = np.full((n + 1, size), -np.inf), np.zeros((n, size))
        behind, leave = np.zeros((n + 1, size)), np.zeros((n, size))
        with np.errstate(invalid="ignore"):
            for i in range(n):
                if i:
                    enter[i] = np.logaddexp.reduce(ahead[i][:, None] + self.moves, axis=0)
                own = slice(cuts[i], cuts[i + 1])
                ahead[ends[own]] = np.logaddexp(ahead[ends[own]], enter[i] + scores[own])
            for i in reversed(range(n)):
                own = slice(cuts[i], cuts[i + 1])
                leave[i] = np.logaddexp.reduce(scores[own] + behind[ends[own]], axis=0)
                behind[i] = np.logaddexp.reduce(self.moves + leave[i], axis=1)
        total = np.logaddexp.reduce(ahead[n])
        starts = np.array([i for i, _, _ in segments])
        moved = sum((np.exp(ahead[i][:, None] + self.moves + leave[i] - total) for i in range(1, n)), np.zeros((size, size)))
        return np.exp(enter[starts] + scores + behind[ends] - total), moved


def shape_of(text: str) -> str:
    return re.sub("[a-zA-Z]+", "a", re.sub("[0-9]", "9", text))


def cued_spans(text: str) -> list[Span]:
    """Numbers with a cue word before them."""
    small = text.lower()  # plain searches first: most texts have no cue
    if not any(word in small for word in ("iban", "ssn", "account", "social security")):
        return []
    return sorted((m.start(1), len(KINDS) + k, m.end(1)) for k, pattern in enumerate(CUED) for m in pattern.finditer(text))


def training_rows(docs: DataFrame) -> DataFrame:
    """``kind``, ``shape``, ``region`` and, of a cued number, its ``begin`` and ``stop`` there: one row per shape (cued: region) and kind of all documents."""
    none = len(KINDS) + len(OWN)

    def work(texts):
        shapes = {}
        for text in texts:
            text = text or ""
            cued = cued_spans(text)
            at = 0
            for a, b in regions(text):
                if b - a <= TRAIN_REGION_CHARS:
                    region = text[a:b]
                    while at < len(cued) and cued[at][0] < a:
                        at += 1
                    if at < len(cued) and cued[at][2] <= b:
                        start, kind, end = cued[at]
                        rows = [(kind, region, (region, start - a, end - a))]  # own kinds have few shapes: every number counts
                    else:
                        shape = shape_of(region)
                        rows = [(k, shape, (region, None, None)) for k in {k for _, k, _ in base_spans(region)} or {none}]
                    for kind, shape, row in rows:
                        shapes[kind, shape] = min(shapes.get((kind, shape), row), row, key=lambda r: r[0])
        return [[k for k, _ in shapes], [s for _, s in shapes], *([r[c] for r in shapes.values()] for c in range(3))]

    found = map_slices(docs.select(F.col("text").cast("string")), "kind int, shape string, region string, begin int, stop int", work)
    found = found.groupBy("kind", "shape").agg(F.min(F.struct("region", "begin", "stop")).alias("r")).select("kind", "shape", "r.*")
    # each task passes on a bounded number of rows of a kind before the ranks are made
    found = found.withColumn("h", F.xxhash64("shape"))
    return found.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy("h", "shape")))


def first_places(rows: DataFrame, bound: int) -> list[Row]:
    """The rows of each kind's first ``bound`` places: all that training can take."""
    return rows.where(F.col("place") <= bound).collect()


def picked_regions(rows: list[Row], bound: int) -> list[str]:
    plain = sorted((r["place"] > bound // (len(KINDS) + 1), r["h"], r["shape"], r["kind"], r["region"]) for r in rows if r["begin"] is None)
    return list(dict.fromkeys(r[-1] for r in plain[:bound]))


def training_regions(docs: DataFrame, bound: int = TRAIN_REGIONS) -> list[str]:
    """At most ``bound`` regions, one per shape and base kind (or none), those with the smallest hash of each kind; drawn from all documents."""
    return picked_regions(first_places(training_rows(docs), bound), bound)


def cued_regions(rows: list[Row], bound: int = OWN_REGIONS) -> list[tuple[str, Span]]:
    """At most ``bound`` regions of each own kind, with the cued number in them."""
    picked = sorted((r["kind"], r["place"], r) for r in rows if r["begin"] is not None and r["place"] <= bound)
    return [(r["region"], (r["begin"], r["kind"], r["stop"])) for *_, r in picked]


def among_signs(cued: list[tuple[str, Span]]) -> list[tuple[str, Span]]:
    """The same numbers as they stand, in brackets or quotes, before a comma and a full stop: the field learns where they end."""
    return [(before + region + after, (start + len(before), kind, end + len(before)))
            for region, (start, kind, end) in cued for before, after in (("", ""), ("(", ")"), ('"', '"'), ("", "."), ("", ","))]


def all_spans(text: str, model: SemiCrf) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those the model adds."""
    base = base_spans(text)
    added: list[Span] = []
    taken = iter(sorted((s, e) for s, _, e in base))
    current = next(taken, None)
    for a, b in regions(text):
        for s, kind, e in model.decode(text[a:b], text[a - 1] if a else "", text[b] if b < len(text) else ""):
            s, e = s + a, e + a
            while current and current[1] <= s:
                current = next(taken, None)
            if not current or current[0] >= e:
                added.append((s, kind, e))
    return base, sorted(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{LABELS[k + 1]}:{s}:{e}" for s, k, e in spans)


def fitted(docs: DataFrame, bound: int = TRAIN_REGIONS) -> SemiCrf:
    rows = first_places(training_rows(docs), max(bound, OWN_REGIONS))
    cued = cued_regions(rows)
    # how a cued number looks: the same without a cue is neither example nor counterexample
    known = {(shape_of(region[a:b])) for region, (a, _, b) in cued}
    return SemiCrf().fit([r for r in picked_regions(rows, bound) if base_spans(r) or not any(s in shape_of(r) for s in known)], among_signs(cued))


def find_personal_data(docs: DataFrame, model: SemiCrf) -> DataFrame:
    """One row per document with base counts, the digest of base spans and all spans."""
    def work(ids, texts):
        out = [[] for _ in range(7)]
        for doc_id, text in zip(ids, texts):
            base, every = all_spans(text or "", model)
            row = (doc_id, *(sum(k == kind for _, k, _ in base) for kind in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))
            for column, value in zip(out, row):
                column.append(value)
        return out

    return map_slices(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"), work)


def masked(text: str, model: SemiCrf) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named after the first."""
    out, at = [], 0
    for start, kind, end in all_spans(text, model)[1]:
        if start >= at:
            out += [text[at:start], f"[{LABELS[kind + 1].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame, model: SemiCrf) -> DataFrame:
    """The same rows and columns with masked texts; ``n_chars``, where present, counts the new text. A null text stays null."""
    names = docs.columns
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names else None

    def work(*columns):
        texts = [None if t is None else masked(t, model) for t in columns[at]]
        out = list(columns)
        out[at] = texts
        if size is not None:
            out[size] = [n if t is None else len(t) for t, n in zip(texts, columns[size])]
        return out

    return map_slices(docs, docs.schema, work)
