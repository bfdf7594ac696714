"""Quality selection by ordinal cumulative-link regression.

Graded ratings 0, 1, ... are modelled as P(grade <= k | text) =
sigmoid(threshold_k - score): one weight vector over hashed text features
shared by all grades, and ordered thresholds. The expected grade and the
tail probability P(grade >= k) follow from one score.

Features are the distinct lower-cased words and the distinct byte trigrams
of the whole text, hashed into ``2**bits`` slots, weighted by inverse
document frequency and scaled to length 1.

The model is fitted on at most ``max_rows`` rated rows (those with the
smallest hash, so the choice does not depend on how rows are stored), which
bounds what comes to the driver. Scoring covers every document; the model
that travels with the tasks has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Bytes of text turned into features at once; a cut falls between words.
CHUNK = 1 << 20
#: Features taken at once when fitting.
RUN = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += np.uint64(32)
MIX = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(1 << 12, MIX | np.uint64(2), np.uint64))


def _slots(values: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.unique((values * MIX) >> np.uint64(64 - bits))


def _chunk_features(data: np.ndarray, bits: int) -> np.ndarray:
    wide = data.astype(np.uint64)
    grams = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
    blank = SPACE[data]
    inside = np.flatnonzero(~blank)
    if not len(inside):
        return _slots(grams, bits)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    place = np.arange(len(inside)) - np.repeat(first, np.diff(first, append=len(inside)))
    with np.errstate(over="ignore"):
        words = np.add.reduceat((LOWER[data[inside]] + np.uint64(1)) * POWERS[place % len(POWERS)], first)
    return np.union1d(_slots(grams, bits), _slots(words, bits))


def text_features(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct slots of a text's words and byte trigrams."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        if end < len(data):
            gap = np.flatnonzero(SPACE[data[at:end]])
            end = at + int(gap[-1]) + 1 if len(gap) else end
        parts.append(_chunk_features(data[at:end], bits))
        at = end
    return np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32)


@dataclass
class OrdinalModel:
    """``weights`` (with document-frequency weights ``idf`` apart) and increasing ``thresholds``."""

    bits: int
    idf: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, text: str | None) -> float:
        slots = text_features(text, self.bits)
        x = self.idf[slots]
        norm = float(np.sqrt((x * x).sum()))
        return float((x * self.weights[slots]).sum()) / norm if norm else 0.0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(slots: list[np.ndarray], grades: np.ndarray, bits: int, steps: int = 120, rate: float = 0.5,
                penalty: float = 1e-5, min_texts: int = 20) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model by full-batch Adam.

    Thresholds are kept in order by fitting the first one and the logarithms
    of the gaps. Features of fewer than ``min_texts`` texts are left out, so
    that no text is learnt by heart. Grades must be 0 to some K; with one grade only, every
    text gets that grade.
    """
    n, size, levels = len(slots), 1 << bits, int(grades.max()) + 1 if len(grades) else 1
    count = np.array([len(s) for s in slots], np.int64)
    seen = np.zeros(size, np.int64)
    for x in slots:
        seen[x] += 1
    idf = np.where(seen >= min_texts, np.log((1 + n) / (1 + seen)) + 1, 0).astype(np.float32)
    if levels < 2:
        return OrdinalModel(bits, idf, np.zeros(size, np.float32), np.empty(0))
    ends = np.cumsum(count)
    norm = np.array([np.sqrt(np.square(idf[x], dtype=float).sum()) for x in slots])
    scale = (1 / np.maximum(norm, 1e-12)).astype(np.float32)
    # rows are taken in runs of about RUN features, so that a step needs little memory beside the features
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(RUN, ends[-1] + 1, RUN)), [n]]))

    def scored(w: np.ndarray) -> np.ndarray:
        return np.concatenate([[(idf[x] * w[x]).sum() * scale[i] for i, x in enumerate(slots[lo:hi], lo)]
                               for lo, hi in zip(cuts, cuts[1:])])

    def gathered(d_score: np.ndarray) -> np.ndarray:
        total = np.zeros(size)
        for lo, hi in zip(cuts, cuts[1:]):
            part = np.concatenate(slots[lo:hi])
            total += np.bincount(part, np.repeat((d_score[lo:hi] * scale[lo:hi]).astype(np.float32), count[lo:hi]), minlength=size)
        return total * idf

    share = np.clip(np.array([(grades <= k).mean() for k in range(levels - 1)]), 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(levels - 1))
    w, cut = np.zeros(size), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    state = [np.zeros(size), np.zeros(size), np.zeros(levels - 1), np.zeros(levels - 1)]
    each = np.arange(n)
    for step in range(1, steps + 1):
        theta = cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))])
        score = scored(w)
        edges = np.concatenate([np.full((n, 1), -40.0), theta[None, :] - score[:, None], np.full((n, 1), 40.0)], axis=1)
        cdf = _sigmoid(edges)
        slope = cdf * (1 - cdf)
        slope[:, 0] = slope[:, -1] = 0
        p = np.maximum(cdf[each, grades + 1] - cdf[each, grades], 1e-9)
        up, down = slope[each, grades + 1] / p, slope[each, grades] / p
        d_score = (up - down) / n  # of minus the log-likelihood
        d_theta = np.bincount(grades, down / n, minlength=levels)[1:] - np.bincount(grades, up / n, minlength=levels)[:-1]
        later = np.cumsum(d_theta[::-1])[::-1]
        d_cut = np.concatenate([later[:1], later[1:] * np.exp(cut[1:])])
        d_w = gathered(d_score) + penalty * w
        for x, g, m, v, r in ((w, d_w, state[0], state[1], rate), (cut, d_cut, state[2], state[3], 0.05)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= r * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return OrdinalModel(bits, idf, w.astype(np.float32), cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))]))


def _rated_features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([text_features(t.as_py(), bits).tobytes() for t in b.column(1)], pa.binary())],
                ["grade", "slots"])
    return run


def train(docs: DataFrame, ratings: DataFrame, grade_col: str = "grade", id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = 8000, bits: int = 18, steps: int = 120) -> OrdinalModel:
    """Fit on at most ``max_rows`` of the ratings (id, integer grade from 0) that have a document.

    Ratings with a null id or grade are ignored; an id with several ratings
    takes part with its lowest grade, one with several texts with the least
    of them. Without rated documents every text gets grade 0.
    """
    rated = (ratings.filter(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
             .groupBy(F.col(id_col).alias("rated_id")).agg(F.min(F.col(grade_col).cast("int")).alias("grade")))
    # ids of documents only: a rating without a document takes no place in the sample
    known = docs.select(F.col(id_col).alias("rated_id")).distinct()
    sample = rated.join(known, "rated_id", "left_semi").orderBy(F.xxhash64("rated_id"), "rated_id").limit(max_rows)
    # max_rows rows are broadcast
    rows = (docs.select(F.col(id_col).alias("rated_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "rated_id")
            .groupBy("rated_id", "grade").agg(F.min("text").alias("text")).select("grade", "text").mapInArrow(_rated_features(bits), "grade int, slots binary").collect())
    rows.sort(key=lambda r: (r["slots"], r["grade"]))
    return fit_ordinal([np.frombuffer(r["slots"], np.int32) for r in rows], np.array([r["grade"] for r in rows], np.int64), bits, steps)


def _score(model: OrdinalModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.array([model.score(t.as_py()) for t in b.column(b.schema.get_field_index("quality_text"))], float)
            tails = model.tails(scores) if len(scores) else np.empty((0, len(model.thresholds)))
            kept = [b.column(i) for i, n in enumerate(b.schema.names) if n != "quality_text"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(tails.sum(axis=1)), pa.array(tails[:, -1] if tails.shape[1] else np.zeros(len(scores)))],
                [*(n for n in b.schema.names if n != "quality_text"), "expected_grade", "top_probability"])
    return run


def score_documents(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade and top_probability, P(grade = the highest).

    All columns are kept; ones with these two names are replaced, and
    quality_text is used inside. A null or empty text has no features: its
    grade is what the thresholds say. No documents give an empty result.
    """
    kept = [c for c in docs.columns if c not in ("expected_grade", "top_probability", "quality_text")]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text_col).alias("quality_text"))
    schema = StructType([*(f for f in rows.schema if f.name != "quality_text"), StructField("expected_grade", DoubleType()),
                         StructField("top_probability", DoubleType())])
    return rows.mapInArrow(_score(model), schema)
