"""Personal data: base patterns, and a semi-Markov conditional random field for what they miss.

The field scores whole candidate spans (shape, digits, separators, checks, neighbouring words) and
labels of neighbours; dynamic programming over spans of bounded length chooses boundaries and types of
a stretch of text jointly. It is trained by maximum likelihood on a bounded sample of texts labelled by
the base patterns, with respelled copies of their spans (numbers without prefix, other separators,
written-out signs) as further labelled spans, and dates, times, versions and other numbers that are none
mixed in. A span is added if the best segmentation beats the best one that leaves all of it outside by
MARGIN nats. It looks at stretches around digits and signs only; the
rest of a text is outside by construction. Its spans are added where no base span lies.

Null text counts as empty; equal texts have equal spans; an empty table gives an empty one; without
anything to learn from only the base patterns apply. Texts may be long: base patterns take time linear
in the text, and the field's work is bounded for each token.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 1000  # texts with digits or signs that the field is trained on
SAMPLE_BYTES = 1 << 15
LONGEST = 20  # tokens of a span of numbers
LONGEST_ADDRESS = 32  # tokens of a span with an at sign
CONTEXT = 6  # tokens around an anchor
MARGIN = 2.0  # nats by which an added span must beat the best segmentation that leaves it outside
TURNS = 12  # times that the sample is gone through at most, each with other spellings
ENOUGH_SPANS = 1000
EPOCHS, RATE, RIDGE, FIRST_SQUARE = 4, 0.5, 1e-4, 0.1

# The base patterns, as the contract states them; an address is found from its sign.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]|[^\S\n]+|\n+")
ANCHOR = re.compile(r"[0-9]{2,}|@|[(\[](?:at|dot)[)\]]")


def luhn(digits: str) -> bool:
    twice = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in twice)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start. Failing matches are dropped."""
    found = []
    sign, free = text.find("@"), 0
    while sign >= 0:
        start = sign
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, sign + 1) if start < sign else None
        if match:
            found.append((0, start, match.end()))
            free = match.end()
        else:
            free = max(free, sign + 1)
        sign = text.find("@", free)
    if text.count(".") >= 3:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


@dataclass
class Stretch:
    """Tokens of a part of a text, the few around them, and candidate spans with their features."""

    bounds: list[int]
    tokens: list[str]
    left: list[str] = field(default_factory=list)
    right: list[str] = field(default_factory=list)
    spans: list[tuple[int, int, tuple[str, ...]]] = field(default_factory=list)


def _kind_of(token: str) -> str:
    return "9" if token[0].isdigit() else "a" if token[0].isalpha() else "_" if token.isspace() else token[0]


def _features(tokens: list[str], i: int, j: int) -> tuple[str, ...]:
    text = "".join(tokens[i:j])
    digits = _digits(text)
    shape = re.sub(r"(.)\1+", r"\1", "".join(_kind_of(t) for t in tokens[i:j]))
    lengths = "-".join(str(min(len(t), 9)) for t in tokens[i:j] if t[0].isdigit())
    before = next((t.lower() for t in reversed(tokens[max(0, i - 2) : i]) if not t.isspace()), "")
    sign = _AT.search(text)
    host = text[sign.end() :] if sign else text[text.find("@") + 1 :] if "@" in text else ""
    return (
        f"shape={shape[:24]}",
        f"runs={lengths[:24]}",
        f"digits={min(len(digits), 20)}",
        f"tokens={min(j - i, 20)}",
        f"ends={_kind_of(tokens[i])}{_kind_of(tokens[j - 1])}",
        f"before={before if before in ('+', '.', '@', '-', '/', ':') or before.isalpha() and before in _HINTS else _kind_of(before) if before else '^'}",
        f"after={_kind_of(tokens[j]) if j < len(tokens) else '$'}",
        f"at={'@' in text or bool(sign)}",
        f"dot={bool(host) and bool(_DOT.search(host))}",
        f"gap={bool(_GAP.search(text))}",
        f"stop={bool(_STOP.search(text))}",
        f"cut={j < len(tokens) and tokens[j] in ')]'}",
        f"goes_on={_goes_on(tokens, j)}",
        f"comes_from={_goes_on(tokens[max(0, i - 6) : i][::-1], 0)}",
        f"luhn={16 <= len(digits) <= 19 and luhn(digits)}",
        f"octets={_octets(tokens[i:j])}",
        "bias",
    )


_AT = re.compile(r"[(\[]at[)\]]")
_GAP = re.compile(r"[^\W\d_]\s+[A-Za-z0-9]|[0-9]\s+[A-Za-z]")  # words side by side
_STOP = re.compile(r"[.,;:!?]\s")
_DOT = re.compile(r"\.|[(\[]dot[)\]]")


def _octets(tokens: list[str]) -> bool:
    """Four numbers of at most 255 with dots between."""
    parts = tokens[::2]
    return len(tokens) == 7 and tokens[1::2] == ["."] * 3 and all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)


def _goes_on(tokens: list[str], at: int) -> bool:
    """Whether a joining sign, written out or not, and a word or number come next, in either direction."""
    rest = [t for t in tokens[at : at + 6] if not t.isspace()]
    if len(rest) > 1 and rest[0] in ".-/:@_+%" and rest[1][0].isalnum() and not tokens[at].isspace():
        return True
    return len(rest) > 3 and rest[0] in "([])" and rest[1] in ("at", "dot") and rest[2] in "([])" and rest[3][0].isalnum()


_HINTS = frozenset(["mail", "email", "phone", "tel", "call", "mobile", "fax", "card", "visa", "ip", "host", "address", "contact"])


def stretches(text: str) -> Iterator[Stretch]:
    """The parts of a text worth a look: CONTEXT tokens around anchors, merged where they touch."""
    anchors = [m.start() for m in ANCHOR.finditer(text)]
    if not anchors:
        return
    # Tokens are only made near anchors, from the last line break or white space well before one.
    reach, at = 160, 0
    while at < len(anchors):
        begin = max(0, anchors[at] - reach)
        end = anchors[at] + reach
        while at + 1 < len(anchors) and anchors[at + 1] - reach <= end:
            at += 1
            end = anchors[at] + reach
        at += 1
        while 0 < begin and begin < len(text) and not text[begin - 1].isspace() and text[begin].isalnum():
            begin += 1
        found = list(TOKEN.finditer(text, begin, min(end, len(text))))
        hot = [k for k, m in enumerate(found) if ANCHOR.match(m[0]) or m[0] == "@" or m[0] in "([" and ANCHOR.match(text, m.start())]
        k = 0
        while k < len(hot):
            first, last = max(0, hot[k] - CONTEXT), hot[k] + _reach(found[hot[k]][0])
            while k + 1 < len(hot) and hot[k + 1] - CONTEXT <= last:
                k += 1
                last = max(last, hot[k] + _reach(found[hot[k]][0]))
            k += 1
            part = found[first : last + 1]
            around = [m[0] for m in found[max(0, first - CONTEXT) : first]], [m[0] for m in found[last + 1 : last + 1 + CONTEXT]]
            stretch = Stretch([m.start() for m in part] + [part[-1].end()], [m[0] for m in part], *around)
            _candidates(stretch)
            yield stretch


def _reach(anchor: str) -> int:
    """Tokens after an anchor: a host has more labels than a number has parts."""
    return CONTEXT if anchor.isdigit() else 2 * CONTEXT


def _candidates(s: Stretch) -> None:
    """Spans that begin and end with letters, digits or an opening sign and may be personal data."""
    tokens, shift = s.tokens, len(s.left)
    every = [*s.left, *tokens, *s.right]
    for i, first in enumerate(tokens):
        before = every[i + shift - 1] if i + shift else " "
        if not (first[0].isalnum() or first in "+(") or first[0].isalnum() and before[0].isalnum():
            continue
        digits, sign = 0, False
        for j in range(i + 1, min(len(tokens), i + LONGEST_ADDRESS) + 1):
            last = tokens[j - 1]
            if "\n" in last or last.isspace() and len(last) > 1 or len(last) > 40:
                break
            digits += len(last) if last.isdigit() else 0
            sign |= last == "@" or j - i > 3 and tokens[j - 2] == "at" and last in ")]" and tokens[j - 3] in "(["
            inner = j + shift < len(every) and every[j + shift][0].isalnum()
            if j - i > LONGEST and not sign:
                continue
            if last[0].isalnum() and not inner and (sign and j - i >= 3 or digits >= 7 or digits >= 4 and tokens[i:j].count(".") == 3):
                s.spans.append((i, j, _features(every, i + shift, j + shift)))


@dataclass(frozen=True)
class Model:
    weights: dict[tuple[int, str], float]
    follow: tuple[tuple[float, ...], ...]  # by label of one span and of the next; the last is outside

    def score(self, features: tuple[str, ...], kind: int) -> float:
        get = self.weights.get
        return sum(get((kind, f), 0.0) for f in features)


OUTSIDE = len(KINDS)


def decode(model: Model, s: Stretch) -> list[tuple[int, int, int, float]]:
    """(kind, i, j, margin) of the best segmentation's spans; all else is outside, token by token.

    The margin is how far the best segmentation is above the best that leaves the tokens i to j outside.
    """
    n, labels = len(s.tokens), OUTSIDE + 1
    best = np.full((n + 1, labels), -np.inf)
    back: dict[tuple[int, int], tuple[int, int, float]] = {}
    best[0, OUTSIDE] = 0.0
    follow = np.array(model.follow)
    ending: dict[int, list[tuple[int, int, float]]] = {}
    for i, j, features in s.spans:
        for kind in range(OUTSIDE):
            ending.setdefault(j, []).append((i, kind, model.score(features, kind)))
    for j in range(1, n + 1):
        for i, kind, score in [(j - 1, OUTSIDE, 0.0), *ending.get(j, ())]:
            reach = best[i] + follow[:, kind] + score
            before = int(np.argmax(reach))
            if reach[before] > best[j, kind]:
                best[j, kind] = reach[before]
                back[j, kind] = (i, before, score)
    chosen, j, kind = [], n, int(np.argmax(best[n]))
    while j > 0:
        i, before, _ = back[j, kind]
        if kind != OUTSIDE:
            chosen.append((kind, i, j))
        j, kind = i, before
    if not chosen:
        return []
    after = np.full((n + 1, labels), -np.inf)
    after[n] = 0.0
    starting: dict[int, list[tuple[int, int, float]]] = {}
    for j, arcs in ending.items():
        for i, kind, score in arcs:
            starting.setdefault(i, []).append((j, kind, score))
    for i in range(n - 1, -1, -1):
        for j, kind, score in [(i + 1, OUTSIDE, 0.0), *starting.get(i, ())]:
            after[i] = np.maximum(after[i], follow[:, kind] + score + after[j, kind])
    top, stay = float(best[n].max()), float(follow[OUTSIDE, OUTSIDE])
    outside = best + follow[:, OUTSIDE]
    return [
        (kind, i, j, top - float(outside[i].max() + (j - i - 1) * stay + after[j, OUTSIDE])) for kind, i, j in reversed(chosen)
    ]


def _gradient(model_w: dict, follow: np.ndarray, s: Stretch, gold: list[tuple[int, int, int]]) -> tuple[float, dict, np.ndarray]:
    """Log-likelihood of the ``gold`` (kind, i, j) spans and its gradient, by forward and backward sums."""
    n, labels = len(s.tokens), OUTSIDE + 1
    arcs = [(j - 1, j, OUTSIDE, 0.0, ()) for j in range(1, n + 1)]
    for i, j, features in s.spans:
        for kind in range(OUTSIDE):
            arcs.append((i, j, kind, sum(model_w.get((kind, f), 0.0) for f in features), features))
    arcs.sort(key=lambda a: a[1])
    forward = np.full((n + 1, labels), -np.inf)
    forward[0, OUTSIDE] = 0.0
    for i, j, kind, score, _ in arcs:
        forward[j, kind] = np.logaddexp(forward[j, kind], np.logaddexp.reduce(forward[i] + follow[:, kind]) + score)
    backward = np.full((n + 1, labels), -np.inf)
    backward[n] = 0.0
    for i, j, kind, score, _ in sorted(arcs, key=lambda a: -a[0]):
        backward[i] = np.logaddexp(backward[i], follow[:, kind] + score + backward[j, kind])
    total = backward[0, OUTSIDE]
    weights: dict[tuple[int, str], float] = {}
    moves = np.zeros_like(follow)
    chosen = {(i, j): kind for kind, i, j in gold}
    likelihood, label, at = -total, OUTSIDE, 0
    by_span = {(i, j, kind): score for i, j, kind, score, _ in arcs}
    for kind, i, j in sorted(gold, key=lambda g: g[1]):
        while at < i:
            likelihood += follow[label, OUTSIDE]
            moves[label, OUTSIDE] += 1
            label, at = OUTSIDE, at + 1
        likelihood += follow[label, kind] + by_span[i, j, kind]
        moves[label, kind] += 1
        label, at = kind, j
    while at < n:
        likelihood += follow[label, OUTSIDE]
        moves[label, OUTSIDE] += 1
        label, at = OUTSIDE, at + 1
    for i, j, kind, score, features in arcs:
        each = np.exp(forward[i] + follow[:, kind] + score + backward[j, kind] - total)
        moves[:, kind] -= each
        change = (kind != OUTSIDE and chosen.get((i, j)) == kind) - float(each.sum())
        if abs(change) > 1e-6:
            for f in features:
                weights[kind, f] = weights.get((kind, f), 0.0) + change
    return likelihood, weights, moves


def _address(text: str, nth: int) -> str:
    """An address with fewer or otherwise joined parts."""
    local, host = text.rsplit("@", 1)
    labels, words = host.split("."), re.findall(r"[A-Za-z]+", local)
    local = [local, words[0] if words else local, local.replace(".", "_"), ".".join(words[:1] * 2) or local][nth % 4]
    host = [host, ".".join(labels[-2:]), f"{labels[0].rstrip('0123456789') or labels[0]}.{labels[-1]}"][nth % 3]
    return f"{local}@{host}"


def _respelled(kind: int, text: str, nth: int) -> str:
    """A span in the spelling whose turn it is."""
    if kind == 0:
        text = _address(text, nth // 4)
        return [text, text.replace("@", " (at) ").replace(".", " (dot) "), text.replace("@", "[at]"), text.replace("@", " [at] ").replace(".", "[dot]")][nth % 4]
    digits = _digits(text)
    if kind == 2:
        return [text, "-".join(digits[k : k + 4] for k in range(0, len(digits), 4)), ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))][nth % 3]
    if kind == 3 and len(digits) >= 10:
        last = digits[-10:]
        return [text, f"({last[:3]}) {last[3:6]}-{last[6:]}", f"{last[:3]}-{last[3:6]}-{last[6:]}", f"{last[:3]}.{last[3:6]}.{last[6:]}"][nth % 4]
    return text


def _number(nth: int) -> str:
    """A number that is no personal data: a time, a date, a version, a range, an amount, a code."""
    a, b, c = nth * 7 % 12 + 1, nth * 11 % 28 + 1, nth * 13 % 60
    forms = [
        f"{1990 + nth % 50}-{a:02}-{b:02} {a:02}:{c:02}",
        f"{1990 + nth % 50}-{a:02}-{b:02}T{a:02}:{c:02}:{b:02}",
        f"{b}/{a}/{1990 + nth % 50} {a}:{c:02}",
        f"{b:02}.{a:02}.{1990 + nth % 50}",
        f"{a}.{c}.{b}.{256 + nth * 17 % 700}",
        f"{256 + nth * 17 % 700}.{a}.{b}.{c}",
        f"v{a}.{c}.{1000 + nth * 31 % 9000}",
        f"{1900 + nth % 99}-{2000 + nth % 99}",
        f"{a},{100 + c},{100 + b}.{c:02}",
        f"978-{a % 9}-{10 + c}-{100000 + nth * 7919 % 900000}-{b % 10}",
        "".join(str((nth * k * k + 3 * k + b) % 10) for k in range(1, 13)),
    ]
    return forms[nth % len(forms)]


def _examples(texts: list[str], turn: int = 0) -> list[tuple[Stretch, list[tuple[int, int, int]]]]:
    """Stretches with their gold spans, some spans respelled, by turns; stretches they do not fit are left out."""
    found, nth = [], turn
    for text in texts:
        spans = sorted(base_spans(text), key=lambda s: s[1])
        parts, gold, at, size = [], [], 0, 0
        number = _number(nth)
        odd = f"\n{text[:20].split(' ')[0]} {number} {text[-20:].split(' ')[-1]}" if not base_spans(number) else ""
        for kind, start, end in spans:
            if start < at:
                continue
            new = _respelled(kind, text[start:end], nth)
            nth += 1
            stop = ["", ".", ",", ""][nth // 3 % 4] if text[end : end + 1] == " " else ""
            parts += [text[at:start], new, stop]
            size += start - at
            gold.append((kind, size, size + len(new)))
            size += len(new) + len(stop)
            at = end
        for s in stretches("".join([*parts, text[at:], odd])):
            begins = {b: k for k, b in enumerate(s.bounds)}
            known = {(i, j) for i, j, _ in s.spans}
            own = [g for g in gold if g[2] > s.bounds[0] and g[1] < s.bounds[-1]]
            placed = [(k, begins.get(a), begins.get(b)) for k, a, b in own]
            if s.spans and all((i, j) in known for _, i, j in placed):
                found.append((s, placed))
    return found


def fit(texts: list[str]) -> Model:
    """Maximum likelihood by stochastic gradient ascent, each weight with a rate that falls with the squares
    of its own gradients, so that rare features learn as fast as frequent ones; the order is fixed.

    A sample of few spans is gone through several times, with other spellings each time.
    """
    examples = _examples(texts)
    for turn in range(1, TURNS):
        if sum(len(gold) for _, gold in examples) < ENOUGH_SPANS:
            examples += _examples(texts, turn)
    weights: dict[tuple[int, str], float] = {}
    squares: dict[tuple[int, str], float] = {}
    follow = np.zeros((OUTSIDE + 1, OUTSIDE + 1))
    follow_squares = np.full_like(follow, FIRST_SQUARE)
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(examples)):
            _, change, moves = _gradient(weights, follow, *examples[k])
            step = moves - RIDGE * follow
            follow_squares += step * step
            follow += RATE * step / np.sqrt(follow_squares)
            for key, value in change.items():
                old = weights.get(key, 0.0)
                step = value - RIDGE * old
                squares[key] = squares.get(key, FIRST_SQUARE) + step * step
                weights[key] = old + RATE * step / math.sqrt(squares[key])
    return Model(weights, tuple(map(tuple, follow.tolist())))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Model | None:
    """Fits the field to at most ``rows`` texts of at most SAMPLE_BYTES that hold digits or signs.

    They are the ones of lowest hash, so any layout of the table gives the same sample.
    """
    signs = F.col("t").rlike(r"@[A-Za-z0-9]|[0-9]{3}|[0-9]\.[0-9]+\.[0-9]")
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.octet_length("t") <= SAMPLE_BYTES).filter(signs)
    ids = own.select("k", F.xxhash64(F.lit(9), "k", "t").alias("h"))
    chosen = ids.orderBy("h", "k").limit(rows)
    texts = own.withColumn("h", F.xxhash64(F.lit(9), "k", "t")).join(F.broadcast(chosen.select("h").distinct()), "h", "left_semi")
    found = [r["t"] for r in texts.select("h", "t").distinct().orderBy("h").limit(rows).collect()]
    return fit(found) if found else None


def all_spans(text: str, model: Model | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans)."""
    base = base_spans(text)
    if model is None:
        return base, []
    order = sorted((start, end) for _, start, end in base)
    starts = [s for s, _ in order]
    furthest, reach = [], 0
    for _, end in order:
        reach = max(reach, end)
        furthest.append(reach)
    added = []
    for s in stretches(text):
        if not s.spans:
            continue
        for kind, i, j, score in decode(model, s):
            start, end = s.bounds[i], s.bounds[j]
            before = bisect_right(starts, end - 1)
            if score >= MARGIN and not (before and furthest[before - 1] > start):
                added.append((kind, start, end))
    return base, added


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def scan(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans): spans as ``kind:start:end``, comma-joined by kind, then start."""
    schema = T.StructType([docs.schema[key], T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                pairs = [all_spans(t or "", model) for t in batch.column(1).to_pylist()]
                base, every = [spell(b) for b, _ in pairs], [spell(b + a) for b, a in pairs]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.string()), pa.array(every, pa.string())], names=schema.names)

    return docs.select(key, F.col(text).alias("text")).mapInArrow(found, schema)
