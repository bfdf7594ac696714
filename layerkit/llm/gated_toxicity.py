"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text's words (runs of letters, digits, ``@$*`` and of everything outside ASCII;
A-Z lower-cased) are read in overlapping windows of ``WINDOW`` words, one
every ``STRIDE`` words, to the end of the text. The input for a word is an
embedding of the word beside the mean embedding of its character n-grams
(3 to 5 bytes, with marks for the word's ends), both hashed. Two gated
recurrent units read the window in either direction, attention weighs their
states, and the weighted sum gives the window's logit. The text's logit is
that of its worst window.

The network is trained in numpy on a bounded sample of labelled documents
(``max_toxic`` and ``max_clean`` rows by the smallest hash of the id, each
with at most ``max_windows`` windows evenly spaced over it). A label says
that some window is toxic, not which one, so it learns from the window
that the network so far finds worst (chosen anew every other epoch), and
from another one of clean texts. A part of the sample is kept out to turn logits into probabilities,
for the share of toxic labels that all training labels have.

Scoring reads every window of every text. The input of a word is worked out
once for each word and task and then looked up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .term_scan import pieces, text_bytes

WINDOW = 64
STRIDE = 48
HIDDEN = 8
ATTENTION = 8
WIDTH = 8
WORD_BITS, GRAM_BITS = 16, 17
WORD_BYTES = bytes(c if c >= 0x80 or 97 <= c <= 122 or 48 <= c <= 57 or c in b"@$*" else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Windows that are run through the network at once, and words whose inputs a task keeps.
RUN_WINDOWS, HELD_WORDS = 2048, 200_000
#: Words whose inputs are worked out at once.
AT_ONCE = 4096
#: Bytes of windows of one document that come to the driver.
SAMPLE_BYTES = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The text's words, a piece of the text at a time."""
    for piece in pieces(text.translate(WORD_BYTES)):
        yield piece.split()


def window_starts(n: int) -> list[int]:
    """Where the windows of ``n`` words begin: every STRIDE words, the last one at the end of the text."""
    return [*range(0, max(n - WINDOW, 0), STRIDE), max(n - WINDOW, 0)] if n else []


def word_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each word, slots of all n-grams, where each word's n-grams begin)."""
    whole = np.fromiter(map(crc32, words), np.int64, len(words)) & ((1 << WORD_BITS) - 1)
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    left = np.repeat(end, size) - np.arange(len(data))  # bytes from here to the end of the word
    owner = np.repeat(np.arange(len(words)), size)
    gram = data.copy()
    grams, owners = [], []
    with np.errstate(over="ignore"):
        for n in range(2, 6):
            gram = (gram[:-1] << np.uint64(8)) | data[n - 1:]
            if n >= 3:
                ok = left[:len(gram)] >= n
                grams.append((((gram[ok] + np.uint64(n)) * _MIX) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
                owners.append(owner[:len(gram)][ok])
    owners, grams = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owners, kind="stable")
    return whole, grams[order], np.searchsorted(owners[order], np.arange(len(words)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class GatedModel:
    """``parts``: the arrays by name; ``scale`` and ``shift`` turn a logit into a probability."""

    parts: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None  # the probability of every text, if there was nothing to learn from
    _: dict = field(default_factory=dict, repr=False)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Embedded words (without the projection), and what training needs of them."""
        p = self.parts
        whole, grams, first = word_slots(words)
        used = p["gram_used"][grams]
        number = np.maximum(np.add.reduceat(used, first), 1)
        mean = np.add.reduceat(p["gram"][grams] * used[:, None], first) / number[:, None]
        return np.concatenate([p["word"][whole] * p["word_used"][whole][:, None], mean], axis=1).astype(np.float32), (whole, grams, first, used, number)

    def projected(self, words: list[bytes]) -> np.ndarray:
        """The words' inputs to the gates of either direction: 2 x words x 3 HIDDEN."""
        flat = [self.inputs(words[at:at + AT_ONCE])[0] @ self.parts["project"] + self.parts["bias"] for at in range(0, len(words), AT_ONCE)]
        return np.concatenate([np.empty((0, 6 * HIDDEN), np.float32), *flat]).reshape(-1, 2, 3 * HIDDEN).swapaxes(0, 1).copy()

    def logits(self, gates: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of windows of one length; ``ids`` picks the rows of ``gates`` (direction, word, gate), the projected inputs."""
        p, (n, steps) = self.parts, ids.shape
        by_step = np.ascontiguousarray(ids.T)
        # a row for each gate, so that every operation runs over contiguous windows
        states = np.empty((steps, 2 * HIDDEN, n), np.float32)
        for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            h = np.zeros((HIDDEN, n), np.float32)
            inner, back = np.ascontiguousarray(p["inner"][d].T), p["inner_bias"][d][:, None]
            for t in order:
                x, a = np.ascontiguousarray(gates[d].take(by_step[t], axis=0).T), inner @ h
                both, new = a[:2 * HIDDEN], a[2 * HIDDEN:]
                both += x[:2 * HIDDEN]
                both *= 0.5
                np.tanh(both, out=both)
                both *= 0.5
                both += 0.5
                new += back
                new *= both[:HIDDEN]
                new += x[2 * HIDDEN:]
                np.tanh(new, out=new)
                h -= new
                h *= both[HIDDEN:]
                h += new
                states[t, HIDDEN * d:HIDDEN * (d + 1)] = h
        look = np.tanh(p["look"].T @ states + p["look_bias"][:, None])
        e = (p["weigh"] @ look).reshape(steps, n)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        return p["out"] @ (states * e[:, None, :]).sum(axis=0) + p["out_bias"][0]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))


def new_model(rng: np.random.Generator) -> GatedModel:
    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])).astype(np.float32)

    return GatedModel({
        "word": (0.05 * rng.standard_normal((1 << WORD_BITS, WIDTH))).astype(np.float32), "word_used": np.zeros(1 << WORD_BITS, np.float32),
        "gram": (0.05 * rng.standard_normal((1 << GRAM_BITS, WIDTH))).astype(np.float32), "gram_used": np.zeros(1 << GRAM_BITS, np.float32),
        "project": normal(2 * WIDTH, 6 * HIDDEN), "bias": np.zeros(6 * HIDDEN, np.float32),
        "inner": np.stack([normal(HIDDEN, 3 * HIDDEN) for _ in range(2)]), "inner_bias": np.zeros((2, HIDDEN), np.float32),
        "look": normal(2 * HIDDEN, ATTENTION), "look_bias": np.zeros(ATTENTION, np.float32), "weigh": normal(ATTENTION),
        "out": normal(2 * HIDDEN), "out_bias": np.zeros(1, np.float32)})


def gradients(model: GatedModel, words: list[bytes], ids: np.ndarray, mask: np.ndarray, wanted: np.ndarray, weight: np.ndarray):
    """(mean weighted log-loss, gradients by part; those of the embeddings as (rows, values)).

    ``ids`` (windows x steps) number ``words``; ``mask`` is 0 where a window
    is shorter. Masked steps keep the state, so a padded window gives the
    logit of the window without padding.
    """
    p, (n, steps) = model.parts, ids.shape
    u, (whole, grams, first, used, number) = model.inputs(words)
    gates = u @ p["project"] + p["bias"]
    states = np.zeros((n, steps, 2 * HIDDEN), np.float32)
    kept: list[dict[int, tuple]] = [{}, {}]
    orders = (range(steps), range(steps - 1, -1, -1))
    x_all = gates[ids]
    for d, order in enumerate(orders):
        h = np.zeros((n, HIDDEN), np.float32)
        for t in order:
            m, x = mask[:, t:t + 1], x_all[:, t, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)]
            a = h @ p["inner"][d]
            r, z = _sigmoid(x[:, :HIDDEN] + a[:, :HIDDEN]), _sigmoid(x[:, HIDDEN:2 * HIDDEN] + a[:, HIDDEN:2 * HIDDEN])
            an = a[:, 2 * HIDDEN:] + p["inner_bias"][d]
            new = np.tanh(x[:, 2 * HIDDEN:] + r * an)
            kept[d][t] = h, r, z, an, new
            h = h + m * ((new + z * (h - new)) - h)
            states[:, t, HIDDEN * d:HIDDEN * (d + 1)] = h
    look = np.tanh(states @ p["look"] + p["look_bias"])
    e = look @ p["weigh"] + (mask - 1) * 1e9
    e = np.exp(e - e.max(axis=1, keepdims=True))
    e /= e.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,ntk->nk", e, states)
    logit = pooled @ p["out"] + p["out_bias"][0]
    chance = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    loss = float(-(weight * (wanted * np.log(chance + 1e-12) + (1 - wanted) * np.log(1 - chance + 1e-12))).sum() / weight.sum())
    g: dict = {k: np.zeros_like(p[k]) for k in ("inner", "inner_bias")}
    d_logit = (weight * (chance - wanted) / weight.sum()).astype(np.float32)
    g["out"], g["out_bias"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * p["out"]
    d_e = np.einsum("ntk,nk->nt", states, d_pooled)
    d_states = e[:, :, None] * d_pooled[:, None, :]
    d_score = e * (d_e - (e * d_e).sum(axis=1, keepdims=True))
    g["weigh"] = np.einsum("nt,ntk->k", d_score, look)
    d_look = d_score[:, :, None] * p["weigh"] * (1 - look * look)
    g["look"], g["look_bias"] = np.einsum("ntk,ntj->kj", states, d_look), d_look.sum(axis=(0, 1))
    d_states += d_look @ p["look"].T
    d_x = np.zeros_like(x_all)
    for d, order in enumerate(orders):
        d_h = np.zeros((n, HIDDEN), np.float32)
        for t in reversed(order):
            h, r, z, an, new = kept[d][t]
            m = mask[:, t:t + 1]
            d_out = d_states[:, t, HIDDEN * d:HIDDEN * (d + 1)] + d_h
            d_next = d_out * m
            d_new = d_next * (1 - z) * (1 - new * new)
            d_r, d_z = d_new * an * r * (1 - r), d_next * (h - new) * z * (1 - z)
            d_gate = np.concatenate([d_r, d_z, d_new * r], axis=1)
            g["inner"][d] += h.T @ d_gate
            g["inner_bias"][d] += (d_new * r).sum(axis=0)
            d_x[:, t, 3 * HIDDEN * d:3 * HIDDEN * (d + 1)] = np.concatenate([d_r, d_z, d_new], axis=1)
            d_h = d_out * (1 - m) + d_next * z + d_gate @ p["inner"][d].T
    flat, order = d_x.reshape(-1, 6 * HIDDEN), np.argsort(ids, axis=None, kind="stable")
    sorted_ids = ids.ravel()[order]
    cut = np.flatnonzero(np.diff(sorted_ids, prepend=-1))
    d_gates = np.zeros_like(gates)
    d_gates[sorted_ids[cut]] = np.add.reduceat(flat[order], cut)
    g["project"], g["bias"] = u.T @ d_gates, d_gates.sum(axis=0)
    d_u = d_gates @ p["project"].T

    def by_slot(slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(slots, kind="stable")
        cut = np.flatnonzero(np.diff(slots[order], prepend=-1))
        return slots[order][cut], np.add.reduceat(values[order], cut)

    g["word"] = by_slot(whole, d_u[:, :WIDTH] * p["word_used"][whole][:, None])
    of = np.repeat(np.arange(len(words)), np.diff(first, append=len(grams)))
    g["gram"] = by_slot(grams, (d_u[:, WIDTH:] / number[:, None])[of] * used[:, None])
    return loss, g


def _odds(slots: Iterable[np.ndarray], toxic: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each slot from the documents that have it, and whether at least ``least`` have."""
    seen = np.zeros((2, size))
    for y, s in zip(toxic, slots):
        seen[int(y), s] += 1
    rate = (seen + 0.5) / (np.array([[(~toxic).sum()], [toxic.sum()]]) + 1)
    used = seen.sum(axis=0) >= least
    return (np.clip(np.log(rate[1] / rate[0]), -3, 4) * used).astype(np.float32), used.astype(np.float32)


def fit(texts: Iterable[list[list[bytes]]], toxic: np.ndarray, prior: float, epochs: int = 6, batch: int | None = None, rate: float = 0.015,
        min_docs: int = 4, kept_out: int = 5, seed: int = 13) -> GatedModel:
    """From documents as lists of windows (lists of words) and whether each is toxic.

    Every ``kept_out``-th document is used for the probabilities only.
    ``prior`` is the share of toxic documents that these are to hold for.
    Words and n-grams of fewer than ``min_docs`` documents have no input.
    ``batch`` is a twentieth of the windows of an epoch, 24 to 192, unless given.
    """
    rng = np.random.default_rng(seed)
    model = new_model(rng)
    p = model.parts
    names: dict[bytes, int] = {}
    docs = [[np.array([names.setdefault(w, len(names)) for w in window], np.int32) for window in windows] for windows in texts]
    words = list(names)
    away = np.arange(len(docs)) % kept_out == 0
    whole, grams, first = [], [], []
    for at in range(0, len(words), AT_ONCE):
        a, b, c = word_slots(words[at:at + AT_ONCE])
        first.append(c + sum(map(len, grams)))
        whole.append(a.astype(np.int32))
        grams.append(b.astype(np.int32))
    whole, grams, first = (np.concatenate(x) for x in (whole, grams, first))
    last = np.append(first[1:], len(grams))
    seen = [np.unique(np.concatenate(d)) for d in docs]
    learn = np.flatnonzero(~away)
    odds, p["word_used"] = _odds((np.unique(whole[seen[i]]) for i in learn), toxic[learn], 1 << WORD_BITS, min_docs)
    p["word"][:, 0] = odds
    odds, p["gram_used"] = _odds((np.unique(np.concatenate([grams[first[w]:last[w]] for w in seen[i]])) for i in learn), toxic[learn],
                                 1 << GRAM_BITS, min_docs)
    p["gram"][:, 0] = odds
    del whole, grams, first, last, seen

    def worst(score_of) -> tuple[list[int], np.ndarray]:
        """The number of each document's worst window, and the scores of all."""
        flat = [w for d in docs for w in d]
        scores, at, out = score_of(flat), 0, []
        for d in docs:
            out.append(at + int(np.argmax(scores[at:at + len(d)])))
            at += len(d)
        return out, scores

    def by_odds(windows: list[np.ndarray]) -> np.ndarray:
        parts = (model.inputs(words[at:at + AT_ONCE])[0] for at in range(0, len(words), AT_ONCE))
        word = np.concatenate([u[:, 0] + u[:, WIDTH] for u in parts])
        return np.array([np.sort(word[w])[-3:].sum() for w in windows])

    def by_network(windows: list[np.ndarray]) -> np.ndarray:
        return window_logits(model, model.projected(words), windows)

    starts = np.cumsum([0] + [len(d) for d in docs])
    flat = [w for d in docs for w in d]
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items() if not k.endswith("_used")}
    step = 0
    chosen, _ = worst(by_odds)
    for epoch in range(epochs):
        if epoch % 2:
            chosen, _ = worst(by_network)
        rows = [(chosen[i], float(toxic[i]), 1.0) for i in learn]
        # another window of each clean document, so that the network knows more than the worst ones
        rows += [(int(rng.integers(starts[i], starts[i + 1])), 0.0, 0.5) for i in learn if not toxic[i]]
        order = rng.permutation(len(rows))
        some_rows = batch or min(192, max(24, len(rows) // 20))
        for at in range(0, len(rows), some_rows):
            some = [rows[i] for i in order[at:at + some_rows]]
            size = max(len(flat[w]) for w, _, _ in some)
            ids, mask = np.zeros((len(some), size), np.int64), np.zeros((len(some), size), np.float32)
            for i, (w, _, _) in enumerate(some):
                ids[i, :len(flat[w])], mask[i, :len(flat[w])] = flat[w], 1
            local, ids = np.unique(ids, return_inverse=True)
            _, g = gradients(model, [words[w] for w in local], ids.reshape(mask.shape), mask,
                             np.array([y for _, y, _ in some], np.float32), np.array([c for _, _, c in some], np.float32))
            step += 1
            now = rate * min(1.0, step / 50) * (1 - 0.9 * epoch / epochs)
            for k, d in g.items():
                at_rows, d = d if isinstance(d, tuple) else (slice(None), d)
                m, v = state[k]
                m[at_rows] += 0.1 * (d - m[at_rows])
                v[at_rows] += 0.01 * (d * d - v[at_rows])
                p[k][at_rows] -= now * (m[at_rows] / (1 - 0.9 ** step)) / (np.sqrt(v[at_rows] / (1 - 0.99 ** step)) + 1e-8)
    chosen, scores = worst(by_network)
    top = scores[np.array(chosen)]
    some = away if toxic[away].any() and not toxic[away].all() else np.ones(len(docs), bool)
    model.scale, model.shift = _calibrated(top[some], toxic[some], prior)
    return model


def _calibrated(logits: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Scale and shift of logits to probabilities by Newton steps, each class weighted to its share by ``prior``."""
    y = toxic.astype(float)
    weight = np.where(toxic, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    x = np.stack([logits.astype(float), np.ones(len(y))], axis=1)
    b = np.array([1.0, 0.0])

    def loss(b: np.ndarray) -> float:
        s = x @ b
        return float((weight * (np.logaddexp(0, s) - y * s)).sum() + 5e-3 * ((b - [1.0, 0.0]) ** 2).sum())

    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (chance - y)) + 1e-2 * (b - [1.0, 0.0])
        bend = (x * (weight * chance * (1 - chance))[:, None]).T @ x + 1e-2 * np.eye(2)
        move, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(b - size * move) > loss(b):
            size /= 2
        b = b - size * move
    return float(max(b[0], 1e-3)), float(b[1])


def window_logits(model: GatedModel, gates: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """One logit for each window (numbers of rows of ``gates``); windows of one length run together."""
    size = np.array([len(w) for w in windows])
    out = np.empty(len(windows), np.float32)
    for n in np.unique(size):
        mine = np.flatnonzero(size == n)
        for at in range(0, len(mine), RUN_WINDOWS):
            some = mine[at:at + RUN_WINDOWS]
            out[some] = model.logits(gates, np.stack([windows[i] for i in some]))
    return out


class _Numbers(dict):
    """Numbers words as they come; ``new`` has those without an input so far."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def text_logits(model: GatedModel, texts: Iterator[bytes]) -> Iterator[float]:
    """The logit of each text's worst window; of a text without words, that of a window with empty states."""
    numbers, gates, ended, runs, held = _Numbers(), np.empty((2, 0, 3 * HIDDEN), np.float32), [], [], 0

    def run() -> Iterator[float]:
        nonlocal gates
        if numbers.new:
            gates = np.concatenate([gates, model.projected(numbers.new)], axis=1)
            numbers.new.clear()
        scores = window_logits(model, gates, runs) if runs else np.empty(0)
        at = 0
        for n, best in ended:
            top = scores[at:at + n].max() if n else best
            yield float(max(top, best))
            at += n
        carried.append(scores[at:].max() if len(scores) > at else -np.inf)

    nothing = float(model.parts["out_bias"][0])
    carried: list[float] = []
    for text in texts:
        ids = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in words_of(text)] or [np.empty(0, np.int32)])
        best, mine = (-np.inf if len(ids) else nothing), 0
        for s in window_starts(len(ids)):
            runs.append(ids[s:s + WINDOW])
            mine += 1
            held += 1
            if held >= RUN_WINDOWS:  # the windows of a long text may need several runs
                yield from run()
                best, mine = max(best, carried.pop()), 0
                ended, runs, held = [], [], 0
        ended.append((mine, best))
        if len(numbers) > HELD_WORDS:
            yield from run()
            carried.clear()
            ended, runs, held = [], [], 0
            numbers, gates = _Numbers(), np.empty((2, 0, 3 * HIDDEN), np.float32)
    yield from run()


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            logits = np.array(list(text_logits(model.value, iter(text_bytes(b.column(1))))), float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.round(model.value.probabilities(logits), 6))], ["doc_id", "score"])
    return run


def _sampled_windows(max_windows: int):
    """Evenly spaced windows of each text, words joined by blanks and windows by line feeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in text_bytes(b.column(2)):
                words = [w for some in words_of(text) for w in some]
                starts = window_starts(len(words))
                picked = sorted({starts[len(starts) * i // max_windows] for i in range(max_windows)}) if len(starts) > max_windows else starts
                windows, held = [], 0
                for s in picked:
                    one = b" ".join(words[s:s + WINDOW])
                    if held + len(one) <= SAMPLE_BYTES:
                        windows.append(one)
                        held += len(one)
                out.append(b"\n".join(windows))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["doc_id", "toxic", "windows"])
    return run


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 1500, max_clean: int = 2500, max_windows: int = 12,
          **fitting) -> GatedModel:
    """Fit on labels (doc_id, toxic) that are not held out and have a document (doc_id, text).

    Null ids and labels are ignored; an id with several labels is toxic if
    any says so, one with several texts takes part with one of them (the
    least as bytes of its windows). Documents without words take no part.
    Without toxic or without clean documents, every text gets the share of
    toxic labels.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    there = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    n, positive = there.agg(F.count("*"), F.sum("toxic")).first()
    prior = (positive or 0) / n if n else 0.0
    picked = None
    for y, most in ((1, max_toxic), (0, max_clean)):
        part = there.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    # at most max_toxic + max_clean ids, each with at most SAMPLE_BYTES
    found = (rows.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")
             .mapInArrow(_sampled_windows(max_windows), "doc_id long, toxic int, windows binary")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("windows").alias("windows"))
             .filter(F.octet_length("windows") > 0).collect())
    found.sort(key=lambda r: (crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    toxic = np.array([r["toxic"] == 1 for r in found], bool)
    if not toxic.any() or toxic.all():
        return GatedModel({}, constant=prior)
    return fit(([w.split(b" ") for w in bytes(r["windows"]).split(b"\n")] for r in found), toxic, prior, **fitting)


def score_documents(docs: DataFrame, model: GatedModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for every row of ``docs`` (doc_id, text).

    Only the text is looked at. A null text counts as empty; empty texts and
    those without words get the score of empty states. Texts are read to
    the end, whatever their length; repeated rows are scored each time. No
    documents give an empty result. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    if model.constant is not None:
        scored = rows.select("doc_id", F.lit(float(model.constant)).alias("score"))
    else:
        # the model has a fixed size
        scored = rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
