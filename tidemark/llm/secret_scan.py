"""Secret scan: three base rules, and a character convolutional network over every candidate.

A candidate is a run of six or more token characters, or as many that base spans leave of
one; the base rules call no shorter value a secret, either.
The network, in numpy, sees every character of a candidate and the text around it: a long
one by overlapping windows, of which the highest score counts. It is trained on labelled
findings: all distinct windows of all documents that meet the value of a base rule, and one
window of every other distinct run. They are dealt over shards of bounded size; a network of
the first one is refined by every shard, and the mean of the parameters goes on. In half of the training
windows the surroundings are blanked, so that the look of a secret counts without the
keyword in front of it, too. Values that the base rules find look alike, so each
also lends its surroundings and label to made ones: random runs of other alphabets and
lengths. Joined words, paths, names with numbers, dates and ids are made as their counterpart. A third of the windows, seen both ways, calibrates: logistic
scaling of the logit, then a threshold of ``highest``, or the highest below it that keeps
``min_recall`` of the findings, made ones included. Candidates that reach it are added as ``neural``.

Defined results: null and empty texts have no spans. Positions are code points, ends
exclusive. Without any finding in all documents, or without anything else, nothing is added.
Repeated rows are scanned each. Columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, shared_dir
from .common import schema_with, spread, with_arrays

KINDS = ("assign", "access", "hex", "neural")
#: Fixed rules.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
_SHORTEST = 6
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % _SHORTEST)
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules by start, then kind."""
    data = text.encode().lower()
    found = []
    if any(k in data for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _SHORTEST]
    if b"akia" in data:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


BEFORE, HEAD, TAIL, AFTER = 24, 32, 16, 8
WIDTH = BEFORE + HEAD + TAIL + AFTER


def window(text: str, start: int, end: int) -> str:
    """The candidate between its surroundings, each padded with NUL to a fixed place."""
    middle = text[start:end] if end - start <= HEAD + TAIL else text[start:start + HEAD] + text[end - TAIL:end]
    return (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + middle.ljust(HEAD + TAIL, "\0")
            + text[end:end + AFTER].ljust(AFTER, "\0"))


def _padded(text: str) -> str:
    return "\0" * BEFORE + text + "\0" * AFTER


def _short_window(padded: str, start: int, end: int) -> str:
    """``window`` of at most ``HEAD + TAIL`` characters of a text that is ``_padded``."""
    return padded[start:end + BEFORE].ljust(WIDTH - AFTER, "\0") + padded[end + BEFORE:end + BEFORE + AFTER]


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CANDIDATE.finditer(text)]


def slices(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping pieces that a window shows whole; any ``HEAD`` characters are together in one of them."""
    wide = HEAD + TAIL
    if end - start <= wide:
        return [(start, end)]
    return [(at, at + wide) for at in range(start, end - wide, TAIL)] + [(end - wide, end)]


def uncovered(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """The candidates of a text; of those that the spans, sorted, meet, the rests long enough."""
    first = 0
    for start, end in candidates(text):
        while first < len(spans) and spans[first][2] <= start:
            first += 1
        at = first
        while at < len(spans) and spans[at][0] < end:
            s, _, e = spans[at]
            if s - start >= _SHORTEST:
                yield start, s
            start = max(start, e)
            at += 1
        if end - start >= _SHORTEST:
            yield start, end


class Windows(Sequence):
    """Windows held by their codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes

    def __len__(self) -> int:
        return len(self.codes)

    def __getitem__(self, at: int) -> str:
        return bytes(self.codes[at]).decode()


def _codes(windows: Sequence[str]) -> np.ndarray:
    """ASCII as it is, NUL for padding, 1 for all else; the shape is (windows, WIDTH)."""
    if isinstance(windows, Windows):
        return windows.codes
    points = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), WIDTH)
    return np.where(points < 128, points, 1).astype(np.int64)


def _cut(texts: list[str], starts: list[int], ends: list[int]) -> Windows:
    """The windows between places of the joined texts, each behind its ``BEFORE``; none is over ``HEAD + TAIL``."""
    pad = "\0" * BEFORE
    points = np.frombuffer("".join([x for t in texts for x in (pad, t)] + ["\0" * WIDTH]).encode("utf-32-le"), np.uint32)
    points = np.where(points < 128, points, 1).astype(np.uint8)
    first, last = np.array(starts, np.intp), np.array(ends, np.intp)
    codes = np.empty((len(first), WIDTH), np.uint8)
    codes[:, :-AFTER] = points[first[:, None] + np.arange(-BEFORE, HEAD + TAIL)]
    codes[:, BEFORE:-AFTER] *= np.arange(HEAD + TAIL) < (last - first)[:, None]
    codes[:, -AFTER:] = points[last[:, None] + np.arange(AFTER)]
    return Windows(codes)


@dataclass
class CharNet:
    """Embedding, one convolution, maximum and mean over places, one logit."""

    embed: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = math.inf

    SPAN = 5

    @classmethod
    def fresh(cls, seed: int = 7, size: int = 10, filters: int = 24) -> CharNet:
        rng = np.random.default_rng(seed)
        inner = (size + 1) * cls.SPAN
        return cls(rng.normal(0, 0.5, (128, size)), rng.normal(0, inner**-0.5, (inner, filters)),
                   np.zeros(filters), rng.normal(0, filters**-0.5, 2 * filters), np.zeros(1))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.shift, self.out, self.bias]

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
        inside = np.zeros((1, WIDTH, 1))
        inside[:, BEFORE:BEFORE + HEAD + TAIL] = 1
        x = np.concatenate([self.embed[codes], np.broadcast_to(inside, (len(codes), WIDTH, 1))], axis=2)
        steps = WIDTH - self.SPAN + 1
        columns = np.concatenate([x[:, i:i + steps] for i in range(self.SPAN)], axis=2)
        hidden = np.maximum(columns @ self.kernel + self.shift, 0)
        peak = hidden.argmax(axis=1)
        pooled = np.concatenate([hidden.max(axis=1), hidden.mean(axis=1)], axis=1)
        return pooled @ self.out + self.bias[0], (codes, columns, hidden, peak, pooled)

    def gradients(self, state: tuple, slope: np.ndarray) -> list[np.ndarray]:
        codes, columns, hidden, peak, pooled = state
        n, steps, filters = hidden.shape
        d_pooled = slope[:, None] * self.out
        d_hidden = np.repeat(d_pooled[:, None, filters:] / steps, steps, axis=1)
        np.add.at(d_hidden, (np.arange(n)[:, None], peak, np.arange(filters)), d_pooled[:, :filters])
        d_hidden *= hidden > 0
        flat = d_hidden.reshape(-1, filters)
        d_kernel = columns.reshape(-1, columns.shape[2]).T @ flat
        d_columns = (flat @ self.kernel.T).reshape(n, steps, self.SPAN, -1)
        size = self.embed.shape[1]
        d_x = np.zeros((n, WIDTH, size))
        for i in range(self.SPAN):
            d_x[:, i:i + steps] += d_columns[:, :, i, :size]
        spot, d_embed = codes.reshape(-1), np.zeros_like(self.embed)
        d_flat = d_x.reshape(-1, size)
        for j in range(size):
            d_embed[:, j] = np.bincount(spot, d_flat[:, j], minlength=128)
        return [d_embed, d_kernel, flat.sum(0), pooled.T @ slope, np.array([slope.sum()])]

    @cached_property
    def _tables(self) -> tuple[np.ndarray, ...]:
        """The trained convolution, looked up: by the first two characters, the next two, and the last with the place."""
        by_place = self.kernel.reshape(self.SPAN, -1, self.kernel.shape[1])
        first, second, third, fourth, last = (self.embed @ k[:-1] for k in by_place)
        inside = np.zeros(WIDTH)
        inside[BEFORE:BEFORE + HEAD + TAIL] = 1
        steps = WIDTH - self.SPAN + 1
        place = sum(inside[i:i + steps, None] * k[-1] for i, k in enumerate(by_place)) + self.shift
        pairs = [(a[:, None] + b[None]).reshape(128 * 128, -1) for a, b in ((first, second), (third, fourth))]
        placed = (place[:, None] + last[None]).reshape(steps * 128, -1)
        return tuple(t.astype(np.float32) for t in (*pairs, placed))

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """As ``forward``, in single precision."""
        front, back, last = self._tables
        filters, steps, out = len(self.shift), WIDTH - self.SPAN + 1, np.empty(len(codes))
        # Columns of nothing but padding are alike; windows of like length share how many there are.
        middle = codes[:, BEFORE:BEFORE + HEAD + TAIL] != 0
        lengths = np.where(middle.any(axis=1), HEAD + TAIL - middle[:, ::-1].argmax(axis=1), 0)
        empty = HEAD + TAIL - self.SPAN + 1
        padding = np.maximum(front[0] + back[0] + last[BEFORE * 128], 0)
        order = np.argsort(lengths, kind="stable")
        memory = np.empty((2, steps * 128 * filters), np.float32)
        for at in range(0, len(codes), 128):  # fits a core's cache
            some = order[at:at + 128]
            seen = codes[some].T.astype(np.intp, order="C")
            pairs = seen[:-1] * 128 + seen[1:]
            alike = max(0, empty - int(lengths[some[-1]]))
            columns = np.r_[0:BEFORE + empty - alike, BEFORE + empty:steps]
            shape = (len(columns), len(some), filters)
            hidden, more = (m[:math.prod(shape)].reshape(shape) for m in memory)
            front.take(pairs[columns], axis=0, mode="clip", out=hidden)
            hidden += back.take(pairs[columns + 2], axis=0, mode="clip", out=more)
            hidden += last.take(seen[columns + self.SPAN - 1] + 128 * columns[:, None], axis=0, mode="clip", out=more)
            # The positive parts' maximum and sum.
            peak, total = np.maximum(hidden.max(axis=0), 0), hidden.sum(axis=0)
            total = (total + np.abs(hidden, out=hidden).sum(axis=0)) / 2
            if alike:
                peak, total = np.maximum(peak, padding), total + alike * padding
            out[some] = (peak * self.out[:filters]).sum(axis=1) + (total / steps * self.out[filters:]).sum(axis=1)
        return out + self.bias[0]

    def probabilities(self, windows: Sequence[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(_codes(windows)) + self.offset, -60, 60)))


def _scaled(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic scaling, by Newton steps on smoothed targets."""
    n_pos, n_neg = (counts * labels).sum(), (counts * (1 - labels)).sum()
    target = np.where(labels > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([logits, np.ones_like(logits)], axis=1)
    start = np.array([1.0, 0.0])

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((counts * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * ((theta - start) ** 2).sum())

    theta = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -60, 60)))
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (counts * (p - target)) + 1e-3 * (theta - start))
        while loss(theta - step) > loss(theta) and np.abs(step).max() > 1e-9:
            step = step / 2
        theta = theta - step
    return max(float(theta[0]), 1e-3), float(theta[1])


def _calibrate(
    net: CharNet, logits: np.ndarray, labels: np.ndarray, counts: np.ndarray, min_recall: float, highest: float,
) -> None:
    """Scaling and threshold from judged logits, each of which stands for so many windows."""
    net.slope, net.offset = _scaled(logits, labels, counts)
    order = np.argsort(logits, kind="stable")
    order = order[labels[order] > 0]
    upto = np.cumsum(counts[order])
    least = float(net.slope * logits[order][np.searchsorted(upto, math.floor((1 - min_recall) * upto[-1]), "right")] + net.offset)
    net.threshold = min(highest, 1 / (1 + math.exp(-max(-60.0, min(60.0, least)))))


def _parts(windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The places of the windows to learn from, and of those to judge by."""
    part = np.array([hashlib.md5(w.encode()).digest()[0] % 3 for w in windows])
    return np.flatnonzero(part > 0), np.flatnonzero(part == 0)


def _bare(codes: np.ndarray) -> np.ndarray:
    """The windows without their surroundings."""
    codes = codes.copy()
    codes[:, :BEFORE] = 0
    codes[:, -AFTER:] = 0
    return codes


class _Steps:
    """Adam on a network's parameters."""

    def __init__(self, net: CharNet, rate: float) -> None:
        self.net, self.rate, self.step = net, rate, 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]

    def move(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, (m, v) in zip(self.net.parameters(), gradients, self.moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g**2 - v)
            p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.99**self.step)) + 1e-8)


def _weights(labels: np.ndarray, learn: np.ndarray) -> np.ndarray:
    """Both labels weigh the same among those to learn from."""
    weight = np.where(labels > 0, 0.5 / max(1, labels[learn].sum()), 0.5 / max(1, (1 - labels[learn]).sum()))
    return weight * len(learn)


def _off(logits: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels


def fit(
    windows: list[str], labels: np.ndarray, min_recall: float = 0.99, epochs: int = 12, highest: float = 0.5,
) -> CharNet:
    """A network of distinct windows and their 0/1 labels; its threshold is ``highest``, or as low as ``min_recall`` asks."""
    net = CharNet.fresh()
    learn, judge = _parts(windows)
    if len(set(labels[learn])) < 2:
        return net
    if len(set(labels[judge])) < 2:
        judge = learn
    codes, rng = _codes(windows), np.random.default_rng(11)
    weight, steps = _weights(labels, learn), _Steps(net, 0.005)
    for _ in range(max(epochs, min(200, 4000 // max(1, len(learn) // 64))) // 4):
        order = rng.permutation(learn)
        for at in range(0, len(order), 64):
            some = order[at:at + 64]
            seen = codes[some].copy()
            blank = rng.random(len(some)) < 0.5
            seen[blank] = _bare(seen[blank])
            logits, state = net.forward(seen)
            steps.move(net.gradients(state, weight[some] * _off(logits, labels[some]) / len(some)))
    # Every judged window counts with its surroundings and without.
    both, truth = np.concatenate([codes[judge], _bare(codes[judge])]), np.tile(labels[judge], 2)
    logits = np.concatenate([net.forward(both[i:i + 256])[0] for i in range(0, len(both), 256)])
    _calibrate(net, logits, truth, np.ones(len(truth)), min_recall, highest)
    return net


#: Errors below this give no gradient when a network is refined: windows it is sure of cost a look only.
_SURE = 0.02


def refine(net: CharNet, windows: list[str], labels: np.ndarray) -> CharNet:
    """The network after one pass over further windows."""
    net = CharNet(*[p.copy() for p in net.parameters()])
    learn, _ = _parts(windows)
    codes, rng = _codes(windows), np.random.default_rng(13)
    weight, steps, order = _weights(labels, learn), _Steps(net, 0.002), rng.permutation(learn)
    for at in range(0, len(order), 1024):
        some = order[at:at + 1024]
        seen = codes[some].copy()
        blank = rng.random(len(some)) < 0.5
        seen[blank] = _bare(seen[blank])
        net.__dict__.pop("_tables", None)
        unsure = np.flatnonzero(np.abs(_off(net.logits(seen), labels[some])) > _SURE)
        if not len(unsure):
            continue
        total = None
        for i in range(0, len(unsure), 64):
            few = unsure[i:i + 64]
            logits, state = net.forward(seen[few])
            got = net.gradients(state, weight[some[few]] * _off(logits, labels[some[few]]) / len(some))
            total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
        steps.move(total)
    net.__dict__.pop("_tables", None)
    return net


#: Kinds of training windows: findings, other runs of 12 or more characters with a digit, all else.
FOUND, DIGITS, PLAIN = 0, 1, 2


def _overlaps(start: int, end: int, spans: list[Span]) -> bool:
    return any(s < end and start < e for s, _, e in spans)


def labelled(text: str) -> Iterator[tuple[str, int]]:
    """Windows and kinds of a text's runs; those that meet no more than a finding's keyword are left out."""
    base = base_spans(text)
    values = [(_ASSIGN.match(text, s).start(2) if k == 0 else s, k, e) for s, k, e in base]
    for start, end in candidates(text):
        digits = end - start >= 12 and _DIGIT.search(text, start, end)
        for s, e in slices(start, end):
            if base and _overlaps(s, e, values):
                yield window(text, s, e), FOUND
            elif not base or not _overlaps(s, e, base):
                yield window(text, s, e), DIGITS if digits else PLAIN


#: Letters of the forms that found values are redrawn in.
FORMS = {
    "hex": "0123456789abcdef",
    "upper_hex": "0123456789ABCDEF",
    "lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "mixed": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/",
    "url_safe": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_",
}


def redrawn(rng: random.Random, form: str) -> str:
    """A made secret of 16 to 48 characters; one in four has a short prefix, as ``abc_`` or ``ab-``."""
    n = rng.randint(16, HEAD + TAIL)
    head = ""
    if rng.random() < 0.25:
        head = "".join(rng.choice(FORMS["lower"][10:]) for _ in range(rng.randint(2, 4))) + rng.choice("_-")
    tail = "=" * rng.randint(0, 2) if form == "base64" else ""
    return head + "".join(rng.choice(FORMS[form]) for _ in range(n - len(head) - len(tail))) + tail


def harmless(rng: random.Random, words: list[str]) -> str:
    """A made run that is no secret: words, halves of words, joined ones, paths, names with numbers, dates, ids."""
    def digits(low: int, high: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(rng.randint(low, high)))

    some = [rng.choice(words) for _ in range(rng.randint(2, 5))]
    if rng.random() < 0.5:
        halves = some[0][:(len(some[0]) + 1) // 2] + some[1][len(some[1]) // 2:]
        return rng.choice([str.lower, str.upper, str.capitalize])(rng.choice([some[0], halves]))[:HEAD + TAIL]
    run = rng.choice([
        lambda: "".join(some[:3]), lambda: "-".join(some), lambda: "_".join(some), lambda: "/".join(some),
        lambda: "/" + "/".join(some) + "/" + digits(1, 6), lambda: "".join(w.capitalize() for w in some),
        lambda: some[0] + "".join(w.capitalize() for w in some[1:]), lambda: "_".join(some).upper(),
        lambda: some[0] + rng.choice("-_") + digits(3, 12), lambda: some[0] + digits(1, 6), lambda: digits(6, 20),
        lambda: f"20{digits(2, 2)}-{digits(2, 2)}-{digits(2, 2)}" + rng.choice(["", "T" + digits(4, 6)]),
        lambda: "-".join("".join(rng.choice(FORMS["hex"]) for _ in range(n)) for n in (8, 4, 4, 4, 12)),
        lambda: rng.choice("=-_") * rng.randint(6, 40), lambda: "=" + "+".join(some[:2]),
    ])()
    return run[:HEAD + TAIL]


def varied(
    windows: list[str], kinds: list[int], forms: Iterable[str] = tuple(FORMS), redraws: int = 300,
) -> tuple[list[str], np.ndarray]:
    """The windows with labels 0/1, and made ones: ``redraws`` of each form, and up to three times as many harmless runs.

    A made secret stands in the surroundings of a finding, whose label it keeps, or, in half of the
    cases, of any other run. Harmless runs are joined from the plain windows' words, or are numbers
    and the like, in surroundings of all but findings.
    """
    found = [w for w, k in zip(windows, kinds, strict=True) if k == FOUND]
    others = [w for w, k in zip(windows, kinds, strict=True) if k != FOUND]
    labels = [float(k == FOUND) for k in kinds]
    if not found or not others:
        return windows, np.array(labels)
    rng, made = random.Random(17), {}
    plain = (w[BEFORE:BEFORE + HEAD + TAIL].strip("\0") for w, k in zip(windows, kinds, strict=True) if k == PLAIN)
    words = [w for w in plain if w.isalpha()] or ["word"]

    def put(around: str, run: str, label: float) -> None:
        made[around[:BEFORE] + run.ljust(HEAD + TAIL, "\0") + around[-AFTER:]] = label

    for form in forms:
        for _ in range(redraws):
            put(rng.choice(found if rng.random() < 0.5 else others), redrawn(rng, form), 1.0)
            for run in (harmless(rng, words) for _ in range(3)):
                if len(run) >= _SHORTEST:
                    put(rng.choice(others), run, 0.0)
    known = set(windows)
    extra = [w for w in made if w not in known]
    return windows + extra, np.array(labels + [made[w] for w in extra])


#: Ranks are 63-bit hashes; their highest bits number the bins of the counts.
_BIN_BITS = 51


def examples(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_documents: int = 20_000, max_windows: int = 4_000,
) -> tuple[list[str], list[int]]:
    """Distinct windows and kinds of about ``max_documents`` documents, chosen by a hash of the id.

    For a look at what there is; ``train`` learns from all documents.
    At most ``max_windows`` findings, as many other long runs with digits, and as many plain ones,
    each those of least hash, reach the driver. Counts by hash bin find the least hashes, so no
    task sorts all windows.
    """
    spark = docs.sparkSession
    share = max_documents / max(1, docs.select(doc_id).count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: set[tuple[str, int]] = set()
            for value in filter(None, batch.column(0).to_pylist()):
                out.update(labelled(value))
            rows = sorted((k, xxhash.xxh64_intdigest(w.encode(), 42) >> 1, w) for w, k in out)
            # The plain ones are sorted last, by rank; no more than these can be chosen.
            rows = rows[:sum(k != PLAIN for k, _, _ in rows) + max_windows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for _, _, w in rows], pa.string()), pa.array([k for k, _, _ in rows], pa.int32()),
                 pa.array([r for _, r, _ in rows], pa.int64())],
                names=["window", "kind", "rank"],
            )

    sampled = docs.filter(F.coalesce(spread(doc_id, "secrets"), F.lit(0.0)) < share).select(text)
    path = shared_dir(spark, "secrets")
    sampled.mapInArrow(run, "window string, kind int, rank long").groupBy("window").agg(
        F.min("kind").alias("kind"), F.min("rank").alias("rank")).write.parquet(path)
    seen = spark.read.schema("window string, kind int, rank long").parquet(path)
    place = F.shiftright("rank", _BIN_BITS)
    bins = sorted(tuple(r) for r in seen.groupBy("kind", place.alias("bin")).count().collect())
    last, total = {FOUND: -1, DIGITS: -1, PLAIN: -1}, Counter()
    for kind, at, n in bins:
        if total[kind] < max_windows:
            last[kind] = at
        total[kind] += n
    wanted = F.lit(False)
    for kind, at in last.items():
        wanted |= (F.col("kind") == kind) & (place <= at)
    rows = sorted(map(tuple, seen.filter(wanted).select("kind", "rank", "window").toArrow().to_pandas().values))
    discard(spark, path)
    taken = Counter()
    picked = []
    for kind, _, seen_window in rows:
        taken[kind] += 1
        if taken[kind] <= max_windows:
            picked.append((seen_window, int(kind)))
    picked.sort()
    return [w for w, _ in picked], [k for _, k in picked]


_SEEN = "window string, kind int"


def distinct_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(window, kind)``: every distinct window of a finding, and one window of every other distinct run, of all documents.

    A run is taken in the first of its places in the text of least hash.
    """
    def made(rows: dict[str, tuple[int, int, int, str]]) -> pa.RecordBatch:
        columns = [list(rows), *zip(*rows.values(), strict=True)] if rows else [()] * 5
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "kind", "rank", "n", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, tuple[int, int, int, str]] = {}

        def add(key: str, kind: int, rank: int, n: int, w: str) -> None:
            if key not in rows or (kind, rank, n) < rows[key][:3]:
                rows[key] = kind, rank, n, w

        for batch in batches:
            for value in set(filter(None, batch.column(0).to_pylist())):
                rank = xxhash.xxh64_intdigest(value.encode(), 42) >> 1
                if base_spans(value):
                    for n, (w, kind) in enumerate(labelled(value)):
                        add(w if kind == FOUND else w[BEFORE:BEFORE + HEAD + TAIL].rstrip("\0"), kind, rank, n, w)
                    continue
                padded = _padded(value)
                for m in _CANDIDATE.finditer(value):
                    key = m[0]
                    old = rows.get(key)
                    # Of one run the kind is the same wherever it stands, so a lesser rank stays.
                    if old is not None and old[1] < rank:
                        continue
                    s, e = m.span()
                    kind = DIGITS if e - s >= 12 and _DIGIT.search(key) else PLAIN
                    if e - s > HEAD + TAIL:
                        for start, end in slices(s, e):
                            add(value[start:end], kind, rank, start, _short_window(padded, start, end))
                        continue
                    if old is None or (kind, rank, s) < old[:3]:
                        rows[key] = kind, rank, s, _short_window(padded, s, e)
            if len(rows) > 200_000:
                yield made(rows)
                rows.clear()
        yield made(rows)

    found = docs.select(text).mapInArrow(run, "key string, kind int, rank long, n int, window string")
    return found.groupBy("key").agg(F.min(F.struct("kind", "rank", "n", "window")).alias("v")).select("v.window", "v.kind")


def _examples(shard: pa.Table, forms: tuple[str, ...], redraws: int) -> tuple[list[str], np.ndarray]:
    """A shard's windows and made ones, in an order of their own."""
    rows = sorted(zip(shard.column("window").to_pylist(), shard.column("kind").to_pylist(), strict=True))
    return varied([w for w, _ in rows], [k for _, k in rows], forms, redraws)


#: Parameters are added up as whole numbers of this size, so that their sum has no order.
_UNIT = 2.0**-36


def train(
    docs: DataFrame, text: str = "text", min_recall: float = 0.95, forms: Iterable[str] = tuple(FORMS),
    highest: float = 0.95, per_shard: int = 16_000, least_found: int = 500,
) -> CharNet:
    """Fit on the ``distinct_windows`` of all documents and on findings redrawn in other ``forms``.

    No task holds more than a shard of about ``per_shard`` windows, and nothing but parameters
    and counts by logit reaches the driver. Where findings are rare, each is dealt to as many shards as give every one
    ``least_found`` of them, or to all. Secrets are far rarer in texts than among the
    examples, so the threshold is high.
    """
    spark, forms = docs.sparkSession, tuple(forms)
    path = shared_dir(spark, "secrets")
    distinct_windows(docs, text).write.parquet(path)
    seen = spark.read.schema(_SEEN).parquet(path)
    counts = {r["kind"]: r["count"] for r in seen.groupBy("kind").count().collect()}
    n_found, n_all = counts.get(FOUND, 0), sum(counts.values())
    try:
        if not n_found or n_found == n_all:
            return CharNet.fresh()
        shards = max(1, round(n_all / per_shard))
        copies = min(shards, math.ceil(shards * least_found / n_found))
        dealt = seen.select("window", "kind", F.explode(F.sequence(
            F.lit(0), F.when(F.col("kind") == FOUND, copies - 1).otherwise(0))).alias("copy")).withColumn(
            "shard", F.pmod(F.xxhash64("window") + F.col("copy"), F.lit(shards)).cast("int"))
        return _fitted(dealt, shards, min_recall, forms, highest)
    finally:
        discard(spark, path)


def _fitted(dealt: DataFrame, shards: int, min_recall: float, forms: tuple[str, ...], highest: float) -> CharNet:
    def first(shard: pa.Table) -> pa.Table:
        net = fit(*_examples(shard, forms, 300), min_recall, highest=highest)
        scale = [net.slope, net.offset, net.threshold]
        return pa.table({"v": pa.array([[*np.concatenate([p.ravel() for p in net.parameters()]), *scale]], pa.list_(pa.float64()))})

    def spelt(values: np.ndarray) -> CharNet:
        shapes = [p.shape for p in CharNet.fresh().parameters()]
        cuts = np.cumsum([math.prod(s) for s in shapes])
        return CharNet(*[v.reshape(s) for v, s in zip(np.split(values[:cuts[-1]], cuts[:-1]), shapes, strict=True)],
                       *map(float, values[cuts[-1]:]))

    least = dealt.select(F.col("window"), "kind", "shard").where("shard = 0").groupBy("shard")
    net = spelt(np.array(least.applyInArrow(first, "v array<double>").first()["v"]))
    if shards == 1:
        return net

    def further(shard: pa.Table) -> pa.Table:
        windows, labels = _examples(shard, forms, 100)
        values = np.concatenate([p.ravel() for p in refine(net, windows, labels).parameters()])
        return pa.table({"at": pa.array(range(len(values)), pa.int32()),
                         "v": pa.array(np.round(values / _UNIT).astype(np.int64)), "n": pa.array([1] * len(values), pa.int64())})

    summed = dealt.groupBy("shard").applyInArrow(further, "at int, v long, n long").groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).cast("double").alias("v"), F.sum("n").alias("n"))
    mean = {r["at"]: r["v"] * _UNIT / r["n"] for r in summed.collect()}
    net = spelt(np.array([mean[i] for i in range(len(mean))]))

    def judged(shard: pa.Table) -> pa.Table:
        windows, labels = _examples(shard, forms, 100)
        _, judge = _parts(windows)
        codes = _codes([windows[i] for i in judge])
        bins = np.floor(np.clip(net.logits(np.concatenate([codes, _bare(codes)])), -1000, 1000) * 64).astype(np.int64)
        found = Counter(zip(np.tile(labels[judge], 2).tolist(), bins.tolist(), strict=True))
        rows = list(zip(*[(label, at, n) for (label, at), n in sorted(found.items())], strict=True)) or [()] * 3
        return pa.table({name: pa.array(c, t) for name, c, t in zip(
            ("label", "at", "n"), rows, (pa.float64(), pa.int64(), pa.int64()), strict=True)})

    # A finding is judged once, however many shards have learnt from it.
    bins = np.array([tuple(r) for r in dealt.where("copy = 0").groupBy("shard").applyInArrow(
        judged, "label double, at long, n long").groupBy("label", "at").agg(F.sum("n")).collect()], float)
    bins = bins[np.lexsort((bins[:, 1], bins[:, 0]))]
    _calibrate(net, (bins[:, 1] + 0.5) / 64, bins[:, 0], bins[:, 2], min_recall, highest)
    return net


#: Windows that are judged together.
_AT_ONCE = 8192


def scan_texts(texts: list[str], net: CharNet) -> list[list[Span]]:
    """All spans of every text; the network judges the candidates of all texts together."""
    spans = [base_spans(t) for t in texts]
    if net.threshold == math.inf:
        return spans
    asked: list[tuple[int, int, int]] = []
    added: set[tuple[int, Span]] = set()
    held: list[str] = []
    starts: list[int] = []
    ends: list[int] = []

    def judge() -> None:
        for n in np.flatnonzero(net.probabilities(_cut(held, starts, ends)) >= net.threshold):
            i, s, e = asked[n]
            added.add((i, (s, 3, e)))
        for some in (asked, held, starts, ends):
            some.clear()

    at = 0
    for i, text in enumerate(texts):
        first, at = 0, at + BEFORE
        for s, e in uncovered(text, spans[i]) if spans[i] else candidates(text):
            if len(starts) >= _AT_ONCE:  # the rest of the text is held from here on
                held.append(text[first:s + AFTER])
                judge()
                first, at = max(0, s - BEFORE), BEFORE
            for start, end in slices(s, e) if e - s > HEAD + TAIL else ((s, e),):
                asked.append((i, s, e))
                starts.append(at + start - first)
                ends.append(at + end - first)
        held.append(text[first:])
        at += len(text) - first
    if starts:
        judge()
    for i, span in added:
        spans[i].append(span)
    return [sorted(s) for s in spans]


def scan(docs: DataFrame, net: CharNet, text: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    counts = [f"n_{k}" for k in KINDS[:3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            found = scan_texts(texts, shared.value)
            base = [[s for s in spans if s[1] < 3] for spans in found]
            yield with_arrays(batch, [
                *[(name, pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()))
                  for k, name in enumerate(counts)],
                ("base_sha256", pa.array([hashlib.sha256(listed(s).encode()).hexdigest() for s in base])),
                ("spans", pa.array([listed(s) for s in found])),
            ])

    return docs.mapInArrow(run, schema_with(
        docs, *[T.StructField(c, T.LongType(), False) for c in counts],
        T.StructField("base_sha256", T.StringType(), False), T.StructField("spans", T.StringType(), False),
    ))


def redact(docs: DataFrame, net: CharNet, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text, overlapping and touching ones as one, replaced by ``mark``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def clean(value: str, spans: list[Span]) -> str:
        out, done = [], 0
        for start, _, end in spans:
            if not out or start > done:
                out += [value[done:start], mark]
            done = max(done, end)
        return "".join([*out, value[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = scan_texts([t or "" for t in texts], shared.value)
            new = [t if not s else clean(t, s) for t, s in zip(texts, found, strict=True)]
            yield with_arrays(batch, [(text, pa.array(new, pa.string()))])

    return docs.mapInArrow(run, schema_with(docs, T.StructField(text, T.StringType()))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
