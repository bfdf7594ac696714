"""Packing documents into sequences: a cutting-stock plan by column generation.

1. Documents are tokenised, closed with one end id and cut: whole pieces of
   ``capacity`` tokens, then a body of a multiple of ``grain`` tokens, then
   what is left. With few body lengths that add up to ``capacity`` and many
   short rests the plan leaves next to no padding, at any input size.
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever
   the input) goes to the driver. There a linear program covers it with
   patterns - multisets of lengths that fit one sequence - at least cost.
   Patterns are columns; new ones come from a knapsack dynamic program over
   the dual prices, until the bound that the prices give is within ``gap``.
3. The pattern counts are rounded down and the few pieces left over are
   packed first-fit, longest first.
4. Pieces are ranked within their length, and the rank alone tells the
   pattern, its copy, and the place in it: a join with the plan's ranges,
   whose number depends on ``capacity`` only.

Ranks are counted within (length, salt) and shifted by the counts of the
salts before, so a length that a third of all pieces share is spread over
``salts`` tasks.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long"
#: Bytes of ids after which a batch goes back to Spark.
BATCH_BYTES = 8 << 20


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


#: Runs of white space from this length on are encoded apart: the expression's lookahead backtracks over a run, in bounded memory.
LONG_RUN = 1 << 16
# The characters that the expression's \s stands for.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def encode_text(encoding, text: str, long_run: int = LONG_RUN) -> list[int]:
    """The ids of a text; strings of special tokens are ordinary text.

    A run of white space is one word of the expression, without its last
    character if a word follows, which begins with that one.
    """
    if len(text) < long_run:
        return encoding.encode_ordinary(text)
    ids, at = [], 0
    for run in re.finditer(f"[{SPACES}]{{{long_run},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at:run.start()])
        ids += encoding._encode_single_piece(text[run.start():end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def _piece_ends(n: int, capacity: int, grain: int) -> list[int]:
    whole = n // capacity * capacity
    return sorted({*range(capacity, whole + 1, capacity), n // grain * grain, n} - {0})


def _cut(ranks_path: str, pattern: str, capacity: int, end_id: int, grain: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoder(ranks_path, pattern)
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                ["doc_id", "start", "length", "ids", "doc_tokens"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode_text(encoding, text.as_py() or ""), end_id], "<u4")
                at = 0
                for end in _piece_ends(len(ids), capacity, grain):
                    rows.append((doc_id, at, end - at, ids[at:end].tobytes(), len(ids)))
                    at = end
                held += 4 * len(ids)
                if held >= BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()
    return run


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = 1024, end_id: int = 0,
                 grain: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, start, length, ids, doc_tokens.

    ``ids`` are little-endian unsigned 32-bit numbers. ``ranks_path`` names a
    rank file (lines of base64 token and rank), ``pattern`` the expression
    that splits text before the merges. ``grain`` must divide ``capacity``
    (equal to it, tails stay whole). Strings of special tokens are
    ordinary text. A null or empty text is the end id alone. Repeated rows
    give repeated pieces; an empty table gives none.
    """
    if capacity % grain:
        raise ValueError(f"grain {grain} does not divide capacity {capacity}")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _cut(ranks_path, pattern, capacity, end_id, grain), PIECE_SCHEMA)


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for every room up to ``capacity``, and the length added last (0: one token left empty)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fits[room]
        if n:
            value = best[room - lengths[:n]] + prices[:n]
            i = int(value.argmax())
            if value[i] > best[room] + 1e-12:
                best[room], last[room] = value[i], lengths[i]
    return best, last


def _filled(last: np.ndarray, room: int) -> Counter:
    used: Counter = Counter()
    while room > 0:
        if last[room]:
            used[int(last[room])] += 1
            room -= int(last[room])
        else:
            room -= 1
    return used


def _first_basis(lengths: np.ndarray, need: np.ndarray, capacity: int) -> tuple[list[Counter], np.ndarray, np.ndarray]:
    """Patterns, their counts and the inverse of the basis they form.

    Patterns are filled largest-first and used as often as their scarcest
    length allows. Each uses up one length for good, so they are as many as
    the lengths, and triangular in the order in which lengths run out: the
    inverse follows row by row.
    """
    rest, left = dict(zip(lengths.tolist(), need.tolist())), lengths.tolist()
    patterns: list[Counter] = [Counter()] * len(lengths)
    count = np.zeros(len(lengths))
    place = {n: i for i, n in enumerate(left)}
    inverse = np.eye(len(lengths))
    while left:
        used, room = Counter(), capacity
        while (i := bisect_right(left, room)):
            n = left[i - 1]
            used[n] += 1
            room -= n
            if used[n] >= rest[n]:
                break  # scarce: at most as many as are left go into one pattern
        scarce = min(used, key=lambda n: rest[n] / used[n])
        x = rest[scarce] / used[scarce]
        for n, c in used.items():
            rest[n] = max(0.0, rest[n] - c * x)
        patterns[place[scarce]], count[place[scarce]] = used, x
        inverse[place[scarce]] /= used[scarce]
        for n, c in used.items():
            if n != scarce:
                inverse[place[n]] -= c * inverse[place[scarce]]
        left.remove(scarce)
    return patterns, count, inverse


def relaxed_plan(demand: dict[int, int], capacity: int, gap: float = 0.002, pivots: int = 400) -> list[tuple[Counter, float]]:
    """Patterns and fractional counts that cover ``demand`` (length to number) exactly.

    Revised simplex method from a largest-first start; each knapsack table
    prices several columns. It ends when the number of sequences is within
    ``gap`` of the dual bound, or after ``pivots`` steps: every basis covers
    the demand, only padding differs.
    """
    lengths = np.array(sorted(demand), np.int64)
    if not len(lengths):
        return []
    row = {int(n): i for i, n in enumerate(lengths)}
    need = np.array([demand[int(n)] for n in lengths], float)
    patterns, count, inverse = _first_basis(lengths, need, capacity)
    steps = 0
    while steps < pivots:
        prices = inverse.sum(axis=0)
        best, last = _knapsack(prices, lengths, capacity)
        # Farley's bound: prices divided by the best column's value are feasible duals
        if best[capacity] <= 1 + 1e-9 or count.sum() <= (prices @ need) / best[capacity] * (1 + gap):
            break
        first = best[capacity - lengths] + prices
        moved = False
        for i in np.argsort(-first)[:48]:
            used = _filled(last, capacity - int(lengths[i]))
            used[int(lengths[i])] += 1
            at, c = [row[n] for n in used], np.array(list(used.values()), float)
            direction = (inverse[:, at] * c).sum(axis=1)
            if direction.sum() <= 1 + 1e-7:  # its worth at the present prices
                continue
            up = direction > 1e-9
            ratio = np.full(len(lengths), np.inf)
            ratio[up] = count[up] / direction[up]
            out = int(ratio.argmin())
            step = ratio[out]
            count -= step * direction
            count[out] = step
            np.maximum(count, 0, out=count)
            pivot = inverse[out] / direction[out]
            direction[out] = 0
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
            patterns[out] = used
            steps, moved = steps + 1, True
        if not moved:
            break
    return list(zip(patterns, count.tolist()))


def packing_plan(demand: dict[int, int], capacity: int, gap: float = 0.002) -> list[tuple[Counter, int]]:
    """Patterns with whole counts that use every piece of ``demand`` once."""
    rest, plan = Counter(demand), []
    for pattern, x in relaxed_plan(demand, capacity, gap):
        n = min([int(x + 1e-6), *(rest[k] // c for k, c in pattern.items())])
        if n > 0:
            plan.append((pattern, n))
            for k, c in pattern.items():
                rest[k] -= c * n
    by_room: dict[int, list[Counter]] = {}
    for length in sorted((k for k in rest if rest[k] > 0), reverse=True):
        for _ in range(rest[length]):
            room = min((r for r in by_room if r >= length and by_room[r]), default=capacity)
            used = by_room[room].pop() if by_room.get(room) else Counter()
            used[length] += 1
            by_room.setdefault(room - length, []).append(used)
    ends = Counter(tuple(sorted(used.items(), reverse=True)) for group in by_room.values() for used in group)
    return plan + [(Counter(dict(items)), n) for items, n in ends.items()]


def plan_ranges(plan: list[tuple[Counter, int]]) -> list[tuple]:
    """(length, first rank, end rank, copies in a pattern, first sequence, offset of the first copy)."""
    taken: Counter = Counter()
    out, sequence = [], 0
    for pattern, n in plan:
        offset = 0
        for length, c in sorted(pattern.items(), reverse=True):
            out.append((length, taken[length], taken[length] + c * n, c, sequence, offset))
            taken[length] += c * n
            offset += c * length
        sequence += n
    return out


def pack_pieces(pieces: DataFrame, capacity: int = 1024, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "start"),
                salts: int = 64, gap: float = 0.002) -> DataFrame:
    """``pieces`` with sequence_id and offset: which sequence holds the piece, and where.

    Sequences hold at most ``capacity`` tokens and their pieces lie one
    behind the other from offset 0. All columns of ``pieces`` are kept,
    except ones named sequence_id or offset, which are replaced; the names
    rank_, salt_ and plan_... are used inside and dropped. Pieces must have
    lengths from 1 to ``capacity``. No pieces give an empty result.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = stored(pieces.select(*kept), "token-pieces").withColumn(
        "salt_", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = rows.groupBy(F.col(length_col).alias("plan_length"), F.col("salt_").alias("plan_salt")).agg(F.count("*").alias("n"))
    counts = stored(counts, "length-histogram")  # at most capacity * salts rows
    demand = {int(r[0]): int(r[1]) for r in counts.groupBy("plan_length").agg(F.sum("n")).collect()}
    if demand and not 1 <= min(demand) <= max(demand) <= capacity:
        raise ValueError(f"piece lengths from {min(demand)} to {max(demand)}, capacity {capacity}")
    whole = demand.pop(capacity, 0)
    plan = packing_plan(demand, capacity, gap) + ([(Counter({capacity: 1}), whole)] if whole else [])
    ranges = spark.createDataFrame(plan_ranges(plan), "plan_len long, plan_from long, plan_to long, plan_c long, plan_seq long, plan_off long")
    before = Window.partitionBy("plan_length").orderBy("plan_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("plan_length", "plan_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("plan_shift"))
    in_salt = Window.partitionBy(length_col, "salt_").orderBy(*order, F.xxhash64(*kept))
    ranked = (rows.withColumn("rank_", F.row_number().over(in_salt) - 1)
              .join(F.broadcast(shifts), (F.col(length_col) == F.col("plan_length")) & (F.col("salt_") == F.col("plan_salt")))
              .withColumn("rank_", F.col("rank_") + F.col("plan_shift")))
    at = F.col("rank_") - F.col("plan_from")
    placed = ranked.join(F.broadcast(ranges), (F.col(length_col) == F.col("plan_len")) & (F.col("rank_") >= F.col("plan_from"))
                         & (F.col("rank_") < F.col("plan_to")))
    return placed.select(*kept, (F.col("plan_seq") + F.floor(at / F.col("plan_c"))).cast("long").alias("sequence_id"),
                         (F.col("plan_off") + at % F.col("plan_c") * F.col(length_col)).cast("long").alias("offset"))
