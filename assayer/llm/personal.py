"""Personal data in texts: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find e-mail addresses, IP addresses, payment cards and phone
numbers.  The network, trained in numpy on windows whose spans the patterns
have labelled, and on other spellings of those spans, reads overlapping
windows of a text's characters and gives each character the probabilities of
its tags (begin, inside, outside, by kind).  Where windows overlap these are
averaged, the more weight the farther from a window's edge, and the stretch
that the windows cover is decoded once, by the best path; so where a span
begins in a window doesn't matter.  What the patterns found stays; the network
adds to it.

All four kinds hold a digit or an @, and so must each span.  Windows are read
around each of these, with one more window on either side; a text is read in
blocks of windows that overlap, so its length takes no memory.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
HIDDEN, STEPS, BATCH, RATE = 16, 1500, 32, 0.02
#: Texts that the network is trained on, at most, the longest of them in characters, and windows taken from them.
SAMPLE, SAMPLE_CHARS, SAMPLE_WINDOWS = 300, 20_000, 3000
#: A span that the network adds has at least this mean probability of its tags.
CONFIDENT = 0.9

#: Windows read at a time, and those that two blocks of one text share; no span is longer than what they cover.
BLOCK, OVERLAP = 4096, 16
#: A character outside with this probability ends a stretch; a longer stretch than this is cut.
SURELY_OUTSIDE, LONGEST = 0.95, 4096

Span = tuple[int, int, int]  # kind, start, end


# ---- patterns

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Where a run of digits fails from its first digit it fails from the others too, so runs are tried once.
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
# What a text with a span looks like, without the checks of its numbers; it chooses texts to learn from.
ALIKE = r"@[A-Za-z0-9-]+[.]|[0-9]+([.][0-9]+){3}|[0-9]([ -]?[0-9]){12}|[+][0-9][ ().0-9-]{7}"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_parts(text: str) -> bool:
    """Whether the numbers of an address are at most 255; they may have any number of leading zeros."""
    parts = [p.lstrip("0") for p in re.findall("[0-9]+", text)]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, each found from its @: the characters before it are a run without one."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str, checked: bool = True) -> list[Span]:
    """What the patterns find, by kind and start; unchecked, also numbers of the right form that are not valid."""
    if not TRIGGER.search(text):
        return []
    found = [(0, a, b) for a, b in emails(text)]
    found += [(1, *m.span()) for m in ADDRESS.finditer(text) if not checked or small_parts(m[0])]
    cards = ((m, digits_of(m[0])) for m in CARD.finditer(text))
    found += [(2, *m.span()) for m, d in cards if 13 <= len(d) <= 19 and (not checked or luhn(d))]
    if "+" in text:
        found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


# ---- characters, windows, tags

SYMBOLS = "@._%+-() :/=\"'#,;\n"
CLASSES = 8 + len(SYMBOLS)
TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2 k begins kind k, 2 + 2 k goes on with it
_TABLE = np.full(128, 7, np.int64)
_TABLE[[ord(c) for c in "0123456789"]] = 1
for _number, _letters in enumerate(("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ"), 2):
    _TABLE[[ord(c) for c in _letters]] = _number
_TABLE[[ord(c) for c in SYMBOLS]] = np.arange(8, CLASSES)

ALLOWED = np.ones((TAGS, TAGS), bool)
for _kind in range(len(KINDS)):
    ALLOWED[:, 2 + 2 * _kind] = False
    ALLOWED[[1 + 2 * _kind, 2 + 2 * _kind], 2 + 2 * _kind] = True
STARTS = np.array([tag == 0 or tag % 2 == 1 for tag in range(TAGS)])


def classes(text: str) -> np.ndarray:
    """A class for each character: 0 is padding, 6 beyond ASCII, 7 other symbols."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 6)


def window_starts(text: str, margin: int = 0) -> list[int]:
    """Where the windows begin that hold a digit or an @, and ``margin`` more on either side; they overlap by half."""
    starts: set[int] = set()
    for match in TRIGGER.finditer(text):
        step = match.start() // STRIDE
        starts.update(range(max(0, step - 1 - margin) * STRIDE, (step + margin) * STRIDE + 1, STRIDE))
    return sorted(s for s in starts if s < len(text))


def cut_windows(codes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.r_[codes, np.zeros(WINDOW, np.int64)]
    return padded[np.array(starts, np.int64)[:, None] + np.arange(WINDOW)]


def tags_of(spans: list[Span], size: int) -> np.ndarray:
    tags = np.zeros(size, np.int64)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    return tags


# ---- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def start_model(seed: int = 7) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    model = {
        "enter": draw.normal(0, 0.3, (2, CLASSES, 4 * HIDDEN)),
        "recur": draw.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)),
        "leave": draw.normal(0, 0.2, (2 * HIDDEN, TAGS)),
        "bias": np.zeros(TAGS),
        "moves": np.zeros((TAGS, TAGS)),
        "first": np.zeros(TAGS),
    }
    model["enter"][:, :, HIDDEN : 2 * HIDDEN] += 1  # remember at first
    return {name: value.astype(np.float32) for name, value in model.items()}


def forward(model: dict[str, np.ndarray], x: np.ndarray, keep: bool = False):
    """Tag scores of windows (n, length), and what the backward pass needs; both directions go side by side."""
    n, length = x.shape
    both = np.stack([x, x[:, ::-1]])
    h = np.zeros((2, n, HIDDEN), np.float32)
    c = np.zeros_like(h)
    states = np.empty((length, 2, n, HIDDEN), np.float32)
    kept = []
    sides = np.arange(2)[:, None]
    for t in range(length):
        gates = model["enter"][sides, both[:, :, t]] + h @ model["recur"]
        opened = _sigmoid(gates[..., : 3 * HIDDEN])
        i, f, o = (opened[..., k * HIDDEN : (k + 1) * HIDDEN] for k in (0, 1, 2))
        g = np.tanh(gates[..., 3 * HIDDEN :])
        before, c = c, f * c + i * g
        tanh_c = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, tanh_c))
        h = o * tanh_c
        states[t] = h
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=2).transpose(1, 0, 2)
    return joined @ model["leave"] + model["bias"], joined, kept, both


def chain(model: dict[str, np.ndarray], scores: np.ndarray):
    """(each tag's probability, expected moves): forward and backward sums of the CRF."""
    n, length, _ = scores.shape
    jump = np.exp(model["moves"].astype(np.float64)) * ALLOWED
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    ahead = np.empty_like(local)
    scale = np.empty((n, length, 1))
    here = local[:, 0] * np.exp(model["first"]) * STARTS
    for t in range(length):
        if t:
            here = (ahead[:, t - 1] @ jump) * local[:, t]
        scale[:, t] = here.sum(axis=1, keepdims=True)
        ahead[:, t] = here / scale[:, t]
    back = np.ones_like(local)
    pairs = np.zeros((TAGS, TAGS))
    for t in range(length - 1, 0, -1):
        tail = local[:, t] * back[:, t] / scale[:, t]
        pairs += ahead[:, t - 1].T @ tail
        back[:, t - 1] = tail @ jump.T
    return ahead * back, pairs * jump


def best_path(model: dict[str, np.ndarray], scores: np.ndarray) -> np.ndarray:
    n, length, _ = scores.shape
    moves = np.where(ALLOWED, model["moves"], -1e9)
    total = scores[:, 0] + np.where(STARTS, model["first"], -1e9)
    came = np.empty((length, n, TAGS), np.int64)
    for t in range(1, length):
        options = total[:, :, None] + moves
        came[t] = options.argmax(axis=1)
        total = options.max(axis=1) + scores[:, t]
    path = np.empty((n, length), np.int64)
    path[:, -1] = total.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = came[t][np.arange(n), path[:, t]]
    return path


def gradients(model: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log likelihood of tags ``y`` of windows ``x``."""
    n, length = x.shape
    scores, joined, kept, both = forward(model, x, keep=True)
    probable, pairs = chain(model, scores.astype(np.float64))
    told = np.zeros((TAGS, TAGS))
    np.add.at(told, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    down = ((probable - np.eye(TAGS)[y]) / n).astype(np.float32)
    grads = {
        "moves": (pairs - told) / n * ALLOWED,
        "first": down[:, 0].sum(axis=0) * STARTS,
        "leave": np.einsum("nlh,nlt->ht", joined, down),
        "bias": down.sum(axis=(0, 1)),
    }
    out = (down @ model["leave"].T).transpose(1, 0, 2)
    sides = np.stack([out[:, :, :HIDDEN], out[::-1, :, HIDDEN:]], axis=1)
    dh = np.zeros((2, n, HIDDEN), np.float32)
    dc = np.zeros_like(dh)
    steps = np.empty((length, 2, n, 4 * HIDDEN), np.float32)
    for t in range(length - 1, -1, -1):
        h, before, i, f, o, g, tanh_c = kept[t]
        dh = dh + sides[t]
        dc = dc + dh * o * (1 - tanh_c * tanh_c)
        gates = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g * g)], axis=2
        )
        steps[t] = gates
        dh = gates @ model["recur"].transpose(0, 2, 1)
        dc = dc * f
    flat = steps.transpose(1, 0, 2, 3).reshape(2, length * n, 4 * HIDDEN)
    seen = np.eye(CLASSES, dtype=np.float32)[both.transpose(0, 2, 1).reshape(2, length * n)]
    states = np.stack([k[0] for k in kept], axis=1).reshape(2, length * n, HIDDEN)
    grads["enter"] = seen.transpose(0, 2, 1) @ flat
    grads["recur"] = states.transpose(0, 2, 1) @ flat
    return grads


def train(x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network by Adam; the same windows give the same network."""
    model, draw = start_model(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(w) for k, w in model.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(BATCH, len(x)):
            order = draw.permutation(len(x))
        part, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - step / (steps + 1))
        for name, grade in gradients(model, x[part], y[part]).items():
            grade = np.clip(grade, -1, 1)
            m[name] += 0.1 * (grade - m[name])
            v[name] += 0.001 * (grade * grade - v[name])
            model[name] -= rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
    return model


# ---- training windows


def respelled(kind: int, span: str, draw: np.random.Generator) -> str:
    """The same data in a spelling that the patterns may not know."""
    numbers = re.findall("[0-9]+", span)
    if kind == 0:
        name, _, domain = span.partition("@")
        return [f"{name} @ {domain}", f"{name}@{domain.replace('.', ' . ')}", f"<{name}>@{domain}"][draw.integers(3)]
    if kind == 1:
        return [" . ", "-", ":"][draw.integers(3)].join(numbers)
    if kind == 2:
        digits = "".join(numbers)
        return [".", "/", "  "][draw.integers(3)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    digits = "".join(numbers)[-10:]
    shapes = [f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"]
    return [*shapes, f"{digits[:3]}.{digits[3:6]}.{digits[6:]}"][draw.integers(3)]


def training_windows(texts: list[str], limit: int = SAMPLE_WINDOWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(windows, tags) of texts as they are, and once more with their spans spelled otherwise.

    Labels go by form: no network learns check digits, so numbers that fail
    their check are labelled too, and what is decoded is checked (plausible).
    """
    draw = np.random.default_rng(seed)
    xs, ys = [], []
    for text in texts:
        spans = sorted(base_spans(text, checked=False), key=lambda s: s[1:])
        spans = [s for i, s in enumerate(spans) if i == 0 or s[1] >= spans[i - 1][2]]
        parts, moved, at, size = [], [], 0, 0
        for kind, start, end in spans:
            other = respelled(kind, text[start:end], draw)
            parts += [text[at:start], other]
            size += start - at
            moved.append((kind, size, size + len(other)))
            size, at = size + len(other), end
        for own, marks in ((text, spans), ("".join(parts) + text[at:], moved)):
            if starts := window_starts(own):
                tags = np.r_[tags_of(marks, len(own)), np.zeros(WINDOW, np.int64)]
                tags = tags[np.array(starts)[:, None] + np.arange(WINDOW)]
                # A span that began before the window begins anew in it.
                tags[:, 0] = np.where((tags[:, 0] > 0) & (tags[:, 0] % 2 == 0), tags[:, 0] - 1, tags[:, 0])
                xs.append(cut_windows(classes(own), starts))
                ys.append(tags)
    if not xs:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    x, y = np.concatenate(xs), np.concatenate(ys)
    # Half of the windows have a span, as far as there are as many.
    order = draw.permutation(len(x))
    has = (y[order] > 0).any(axis=1)
    some, none = order[has], order[~has]
    n_some = min(len(some), max(limit // 2, limit - len(none)))
    chosen = draw.permutation(np.r_[some[:n_some], none[: limit - n_some]])
    return x[chosen], y[chosen]


# ---- decoding


def plausible(kind: int, span: str) -> bool:
    """What a span of each kind must hold, in whatever spelling."""
    digits = digits_of(span)
    if kind == 0:
        return "@" in span.strip("@ ") and "." in span
    if kind == 1:
        return len(re.findall("[0-9]+", span)) == 4 and small_parts(span) and not re.search("[A-Za-z]", span)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", span)
    return 9 <= len(digits) <= 15 and not re.search("[A-Za-z]", span)


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[int]]]:
    """(text, window starts): BLOCK windows at most; blocks of one text share OVERLAP windows."""
    for number, text in enumerate(texts):
        starts = window_starts(text, margin=1)
        for at in range(0, max(1, len(starts) - OVERLAP), BLOCK - OVERLAP):
            if starts:
                yield number, starts[at : at + BLOCK]


def proposals(texts: list[str], model: dict[str, np.ndarray]) -> list[list[tuple[float, Span]]]:
    """For each text the spans that the network proposes, with their mean probability."""
    found: list[list[tuple[float, Span]]] = [[] for _ in texts]
    group: list[tuple[int, list[int]]] = []

    def work() -> None:
        for (number, _), spans in zip(group, _decoded([(texts[n], starts) for n, starts in group], model)):
            found[number] += [x for x in spans if x not in found[number][-2 * OVERLAP :]]
        group.clear()

    for block in _blocks(texts):
        group.append(block)
        if sum(len(starts) for _, starts in group) >= BLOCK:
            work()
    work()
    return found


def _decoded(blocks: list[tuple[str, list[int]]], model: dict[str, np.ndarray]) -> list[list[tuple[float, Span]]]:
    """The spans of each block: its windows' averaged probabilities, decoded along each stretch."""
    found: list[list[tuple[float, Span]]] = [[] for _ in blocks]
    if not blocks:
        return found
    x = np.concatenate([cut_windows(classes(text[starts[0] : starts[-1] + WINDOW]), [s - starts[0] for s in starts]) for text, starts in blocks])
    owner = np.repeat(np.arange(len(blocks)), [len(starts) for _, starts in blocks])
    first = np.concatenate([starts for _, starts in blocks])
    # A place for each character of a stretch: windows that overlap share places.
    step = np.minimum(np.diff(first, prepend=first[0]), WINDOW)
    step[np.r_[True, owner[1:] != owner[:-1]]] = WINDOW
    place = np.cumsum(step) - WINDOW
    total = np.zeros((place[-1] + WINDOW, TAGS))
    weights = np.zeros(len(total))
    inner = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)
    for at in range(0, len(x), 512):
        scores = forward(model, x[at : at + 512])[0].astype(np.float64)
        probable = chain(model, scores)[0] * inner[:, None]
        rows = place[at : at + 512, None] + np.arange(WINDOW)
        for half in (slice(0, None, 2), slice(1, None, 2)):  # of every second window no two overlap
            total[rows[half]] += probable[half]
            weights[rows[half]] += inner
    total /= weights[:, None]
    char = np.empty(len(total), np.int64)
    char[place[:, None] + np.arange(WINDOW)] = first[:, None] + np.arange(WINDOW)
    of = np.empty(len(total), np.int64)
    of[place[:, None] + np.arange(WINDOW)] = owner[:, None]
    # Where a character is surely outside the path is; each stretch between is decoded by itself.
    open_ = total[:, 0] < SURELY_OUTSIDE
    joins = np.r_[False, (char[1:] == char[:-1] + 1) & (of[1:] == of[:-1])]
    begins = np.flatnonzero(open_ & ~(joins & np.r_[False, open_[:-1]]))
    ends = np.flatnonzero(open_ & ~np.r_[(joins & open_)[1:], False]) + 1
    stretches = [(a, min(a + LONGEST, b)) for s, b in zip(begins, ends) for a in range(s, b, LONGEST)]
    for path, (a, b) in _paths(total, stretches):
        block = int(of[a])
        text, starts = blocks[block]
        t = 0
        while t < b - a:
            if path[t] == 0:
                t += 1
                continue
            end = t + 1
            while end < b - a and path[end] == path[t] + 1:
                end += 1
            span = ((int(path[t]) - 1) // 2, int(char[a + t]), min(int(char[a + end - 1]) + 1, len(text)))
            # What touches an end of the block's windows may go on beyond it; the next block has it whole.
            inside = (span[1] > starts[0] or starts[0] == 0) and (span[2] < starts[-1] + WINDOW or span[2] == len(text))
            sure = float(total[np.arange(a + t, a + end), path[t:end]].mean())
            if inside and sure >= CONFIDENT and plausible(span[0], text[span[1] : span[2]]):
                found[block].append((sure, span))
            t = end
    return found


def _paths(probable: np.ndarray, stretches: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, tuple[int, int]]]:
    """The best allowed path of each stretch, by its characters' probabilities; stretches of like length go together."""
    moves = np.where(ALLOWED, 0.0, -1e9)
    by_length = sorted(stretches, key=lambda s: s[1] - s[0])
    for at in range(0, len(by_length), 256):
        part = by_length[at : at + 256]
        length = max(b - a for a, b in part)
        scores = np.zeros((len(part), length, TAGS))
        scores[:, :, 1:] = -1e6  # beyond a stretch's end all is outside
        for row, (a, b) in enumerate(part):
            scores[row, : b - a] = np.log(probable[a:b] + 1e-12)
        model = {"moves": moves, "first": np.zeros(TAGS)}
        for path, own in zip(best_path(model, scores), part):
            yield path[: own[1] - own[0]], own


def reconciled(base: list[Span], proposed: list[tuple[float, Span]]) -> list[Span]:
    """The patterns' spans, and of the proposals those without overlap that are surest in sum."""
    taken = sorted((s[1], s[2]) for s in base)
    free = sorted(
        {
            (span[2], span[1], span[0]): sure
            for sure, span in sorted(proposed)
            if not any(a < span[2] and span[1] < b for a, b in taken)
        }.items()
    )
    ends = [key[0] for key, _ in free]
    best: list[tuple[float, list[Span]]] = [(0.0, [])]
    for i, ((end, start, kind), sure) in enumerate(free):
        before = best[bisect_right(ends, start, 0, i)]
        with_it = (before[0] + sure, [*before[1], (kind, start, end)])
        best.append(max(best[-1], with_it, key=lambda x: x[0]))
    return sorted({*base, *best[-1][1]})


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def fit(docs: DataFrame) -> dict[str, np.ndarray] | None:
    """A network from a bounded sample of texts, half with what looks like a span and half without; None if none has.

    Of each half the first texts in the order of a hash of the id are taken,
    of texts with one id one of the least.
    """
    given = docs.filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
    texts: set[str] = set()
    for alike in (F.col("text").rlike(ALIKE), ~F.col("text").rlike(ALIKE)):
        # The ids come first: each task sends that many of them, and the texts are fetched for the few that were chosen.
        own = given.filter(alike)
        ids = own.select(F.col("doc_id").alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE // 2).distinct()
        rows = own.join(F.broadcast(ids), F.col("doc_id").eqNullSafe(F.col("_id")))
        texts |= {r.text for r in rows.groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    x, y = training_windows(sorted(texts))
    return train(x, y) if y.any() else None


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document; a null text is empty.

    Counts and digest are those of the patterns, ``spans`` has the network's
    as well.  Offsets count characters.
    """
    ship(docs.sparkSession)
    given = docs.select("doc_id", "text")
    model = fit(given)
    names = ["n_email", "n_ip", "n_card", "n_phone"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            base = [base_spans(t) for t in texts]
            spans = list(base)
            held = [i for i, t in enumerate(texts) if TRIGGER.search(t)] if model else []
            for i, proposed in zip(held, proposals([texts[i] for i in held], model) if held else []):
                spans[i] = reconciled(base[i], proposed)
            counts = np.zeros((len(texts), 4), np.int64)
            for i, found in enumerate(base):
                for kind, _, _ in found:
                    counts[i, kind] += 1
            digests = [hashlib.sha256(listed(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(counts[:, k]) for k in range(4)),
                    pa.array(digests, pa.string()),
                    pa.array([listed(s) for s in spans], pa.string()),
                ],
                ["doc_id", *names, "base_sha256", "spans"],
            )

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(
        work, f"doc_id {kind}, {', '.join(f'{n} bigint' for n in names)}, base_sha256 string, spans string"
    )
