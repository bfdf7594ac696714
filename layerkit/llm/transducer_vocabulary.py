"""Source divergence audit over vocabularies held as minimal acyclic transducers.

Which terms set a source of a language apart, and how far apart are the
sources? Each language keeps the terms of at least ``min_docs`` of its
documents; every source is compared with the others and with its language
by smoothed shares of these terms.

1. A scan counts, per language and term, the documents that hold it;
   counts are combined in the task and again by Spark, and what occurs
   often enough is kept.
2. The kept terms are range-sorted. Each run of at most ``shard_terms``
   of them becomes a minimal acyclic transducer: built in one pass over the
   sorted terms, equal endings shared, and each edge with the number of
   terms that sort before those behind it, so that the sum along a term's
   path is its lexicographic ordinal.
3. A second scan streams every text through the transducers of its
   language, all terms of a chunk in step, and counts ordinals per source;
   no term travels any more.
4. Shares, differences and ranks are sums and windows over (language,
   source, ordinal, count). Ties go by the ordinal, and only the terms that
   the result names are read back from the transducers.

The transducers are broadcast in rounds of at most ``round_bytes``; each
round scans the texts once more. One round holds some ten million terms, so
more are needed only for very large vocabularies, and the result is the
same. Everything else is divided: counts by (language, source, ordinal),
distances by blocks of ordinals.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_count, stored, text_of
from .term_scan import TERM_BYTES, pieces, string_buffers, term_spans, text_bytes

SCALE = 1_000_000_000
#: Terms that a scan task holds at most before it passes its counts on.
HELD_TERMS = 400_000
HELD_COUNTS = 3 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    """A minimal acyclic automaton whose paths sum to the ordinals of its sorted terms.

    States are numbered so that an edge leads to a smaller one; the last is
    the root. ``first[s]`` to ``first[s + 1]`` are the edges of state ``s``
    by ascending ``labels``; ``outs`` is what an edge adds to the ordinal.
    """

    def __init__(self, first: np.ndarray, labels: np.ndarray, targets: np.ndarray, outs: np.ndarray, final: np.ndarray):
        self.first, self.labels, self.targets, self.outs, self.final = first, labels, targets, outs, final
        self._slots: tuple[np.ndarray, np.ndarray, np.uint64] | None = None

    @classmethod
    def build(cls, terms: Iterator[bytes] | list[bytes]) -> "Transducer":
        """From strictly ascending terms, in one pass: the path of the last term is open, all else is frozen."""
        known: dict[tuple, int] = {}
        first, labels, targets, outs, final, count = [0], [], [], [], [], []

        def freeze(node: list) -> int:
            key = (node[0], bytes(node[1]), tuple(node[2]))
            state = known.get(key)
            if state is None:
                state = known[key] = len(final)
                below = int(node[0])
                for label, target in zip(node[1], node[2]):
                    labels.append(label)
                    targets.append(target)
                    outs.append(below)
                    below += count[target]
                first.append(len(labels))
                final.append(node[0])
                count.append(below)
            return state

        path: list[list] = [[False, [], []]]  # is it final, labels, targets but for the open one
        last = b""
        for term in terms:
            same, most = 0, min(len(term), len(last))
            while same < most and term[same] == last[same]:
                same += 1
            while len(path) - 1 > same:
                state = freeze(path.pop())
                path[-1][2].append(state)
            for label in term[same:]:
                path[-1][1].append(label)
                path.append([False, [], []])
            path[-1][0] = True
            last = term
        while len(path) > 1:
            state = freeze(path.pop())
            path[-1][2].append(state)
        # the root is a state of its own even if another one equals it, so that it is the last
        known.clear()
        freeze(path[0])
        return cls(np.array(first, np.int32), np.array(labels, np.uint8), np.array(targets, np.int32),
                   np.array(outs, np.int32), np.array(final, bool))

    def to_bytes(self) -> bytes:
        head = np.array([len(self.final), len(self.labels)], "<i8").tobytes()
        return head + b"".join(x.tobytes() for x in (self.first, self.targets, self.outs, self.labels, self.final))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Transducer":
        states, edges = (int(x) for x in np.frombuffer(data, "<i8", 2))
        at, parts = 16, []
        for kind, n in ((np.int32, states + 1), (np.int32, edges), (np.int32, edges), (np.uint8, edges), (bool, states)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(parts[0], parts[3], parts[1], parts[2], parts[4])

    def terms(self) -> Iterator[bytes]:
        """All terms in ascending order: the term with ordinal k is the k-th."""
        root = len(self.final) - 1
        first, labels, targets, final = self.first.tolist(), self.labels.tolist(), self.targets.tolist(), self.final.tolist()
        if final[root]:
            yield b""
        path, stack = bytearray(), [(root, first[root])]
        while stack:
            state, edge = stack[-1]
            if edge == first[state + 1]:
                stack.pop()
                del path[-1:]
                continue
            stack[-1] = (state, edge + 1)
            path.append(labels[edge])
            below = targets[edge]
            if final[below]:
                yield bytes(path)
            stack.append((below, first[below]))

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """Open-addressing table: (state, label) to edge."""
        if self._slots is None:
            edges = len(self.labels)
            bits = max(4, int(2 * edges).bit_length())
            shift = np.uint64(64 - bits)
            keys = np.full(1 << bits, -1, np.int64)
            where = np.zeros(1 << bits, np.int32)
            want = (np.repeat(np.arange(len(self.final), dtype=np.int64), np.diff(self.first)) << 8) | self.labels
            todo = np.arange(edges)
            at = _place(want, shift)
            while len(todo):
                free = keys[at[todo]] == -1
                keys[at[todo[free]]] = want[todo[free]]  # of several for one slot the last one stays
                won = keys[at[todo]] == want[todo]
                where[at[todo[won]]] = todo[won]
                todo = todo[~won]
                at[todo] = (at[todo] + 1) & (len(keys) - 1)
            self._slots = keys, where, shift
        return self._slots

    def ordinals(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The ordinal of each term data[begin:begin + length], -1 if it is none of the transducer's.

        All terms take their next byte in the same step; those that ended or
        have no edge to go on drop out.
        """
        out = np.full(len(begin), -1, np.int64)
        keys, where, shift = self._table()
        wrap = len(keys) - 1
        who, at, left = np.arange(len(begin)), begin, length
        state, total = np.full(len(begin), len(self.final) - 1, np.int64), np.zeros(len(begin), np.int64)
        while len(who):
            ended = left == 0
            if ended.any():
                hit = ended & self.final[state]
                out[who[hit]] = total[hit]
                on = ~ended
                who, at, left, state, total = who[on], at[on], left[on], state[on], total[on]
                if not len(who):
                    break
            want = (state << 8) | data[at]
            slot = _place(want, shift)
            found = keys[slot]
            astray = np.flatnonzero((found != want) & (found != -1))
            while len(astray):
                slot[astray] = (slot[astray] + 1) & wrap
                found[astray] = keys[slot[astray]]
                astray = astray[(found[astray] != want[astray]) & (found[astray] != -1)]
            on = np.flatnonzero(found == want)
            edge = where[slot[on]]
            who, at, left = who[on], at[on] + 1, left[on] - 1
            state, total = self.targets[edge].astype(np.int64), total[on] + self.outs[edge]
        return out


def _place(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((keys.astype(np.uint64) * _MIX) >> shift).astype(np.int64)


def _utf8(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs): in how many of the task's documents a term occurs, in parts if there are many terms."""
    held: dict[str, Counter] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, count in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(count), pa.string()), _utf8(list(count)),
                                              pa.array(list(count.values()), pa.int64())], ["lang", "term", "docs"])
        held.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
            count = held.setdefault(lang, Counter())
            before = len(count)
            terms: set[bytes] = set()
            for piece in pieces(text.translate(TERM_BYTES)):
                terms.update(piece.split())
            count.update(terms)
            size += len(count) - before
            if size > HELD_TERMS:
                yield from flush()
                size = 0
    yield from flush()


SHARD_SCHEMA = "lang string, first binary, last binary, terms long, transducer binary"


def _shards(shard_terms: int):
    """One transducer for each run of at most ``shard_terms`` terms of one language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms = None, []

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([terms[0]], pa.binary()), pa.array([terms[-1]], pa.binary()),
                 pa.array([len(terms)], pa.int64()), pa.array([Transducer.build(terms).to_bytes()], pa.binary())],
                ["lang", "first", "last", "terms", "transducer"])

        for b in batches:
            for one, term in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                if terms and (one != lang or len(terms) >= shard_terms):
                    yield shard()
                    terms = []
                lang = one
                terms.append(term)
        if terms:
            yield shard()
    return run


def kept_terms(docs: DataFrame, min_docs: int = 30) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the language."""
    return (docs.mapInArrow(_document_counts, "lang string, term string, docs long").groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).select("lang", "term"))


def vocabulary(terms: DataFrame, shard_terms: int = 1 << 20) -> DataFrame:
    """``terms`` (lang, term; distinct) as transducers: SHARD_SCHEMA and base, the ordinal of the first term.

    One row for each run of at most ``shard_terms`` sorted terms.
    """
    spark = terms.sparkSession
    ranged = stored(terms, "kept-terms").repartitionByRange(shuffle_count(spark), "lang", "term").sortWithinPartitions("lang", "term")
    built = stored(ranged.mapInArrow(_shards(shard_terms), SHARD_SCHEMA), "transducers")
    # one row for each shard: vocabulary size over shard_terms, and one for each range
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = built.select("lang", "first", F.coalesce(F.sum("terms").over(before), F.lit(0).cast("long")).alias("base"))
    return stored(built.join(bases, ["lang", "first"]), "vocabulary")


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lang, base, data in zip(*(b.column(i).to_pylist() for i in range(3))):
            terms = list(Transducer.from_bytes(data).terms())
            for at in range(0, len(terms), 1 << 16):
                part = terms[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()),
                                                  pa.array(np.arange(base + at, base + at + len(part)), pa.int64()), _utf8(part)],
                                                 ["lang", "ordinal", "term"])


def term_ordinals(shards: DataFrame) -> DataFrame:
    """(lang, ordinal, term), read back from the transducers."""
    return shards.select("lang", "base", "transducer").mapInArrow(_unfold, "lang string, ordinal long, term string")


_loaded: dict[str, dict[str, list]] = {}


def _heads(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term as a number, shorter ones filled with zeros."""
    out = np.zeros(len(begin), np.uint64)
    for j in range(8):
        has = length > j
        byte = np.zeros(len(begin), np.uint64)
        byte[has] = data[begin[has] + j]
        out = (out << np.uint64(8)) | byte
    return out


def _head(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def _recount(label: str, shards):
    """(lang, source, ordinal, n) of a task's texts, in parts if there are many; ``shards``: broadcast {lang: [...]}."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if label not in _loaded:
            _loaded.clear()  # a worker keeps the transducers of one round
            _loaded[label] = {lang: [(_head(f), _head(z), base, Transducer.from_bytes(t)) for f, z, base, t in x]
                              for lang, x in shards.value.items()}
        machines = _loaded[label]
        names: dict[tuple[str, str], int] = {}
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            k, c = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(k, kind="stable")
            k, c = k[order], c[order]
            cut = np.flatnonzero(np.diff(k, prepend=-1))
            return k[cut], np.add.reduceat(c, cut)

        def flush() -> Iterator[pa.RecordBatch]:
            k, c = merged()
            lists = list(names)
            langs, sources = (pa.array([x[i] for x in lists], pa.string()) for i in (0, 1))
            for at in range(0, len(k), 1 << 18):
                group = pa.array(k[at:at + (1 << 18)] >> 40)
                yield pa.RecordBatch.from_arrays([langs.take(group), sources.take(group), pa.array(k[at:at + (1 << 18)] & ((1 << 40) - 1)),
                                                  pa.array(c[at:at + (1 << 18)])], ["lang", "source", "ordinal", "n"])

        for b in batches:
            if not b.num_rows:
                continue
            pairs = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            group = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
            langs = sorted({lang for lang, _ in pairs if lang in machines})
            of_row = np.array([langs.index(lang) if lang in machines else -1 for lang, _ in pairs])
            flat, offsets = string_buffers(b.column(2))
            for data, begin, length, row in term_spans(flat, offsets):
                for i, lang in enumerate(langs):
                    mine = np.flatnonzero(of_row[row] == i) if len(langs) > 1 or (of_row < 0).any() else np.arange(len(row))
                    heads = _heads(data, begin[mine], length[mine]) if len(machines[lang]) > 1 else None
                    for low, high, base, machine in machines[lang]:
                        part = mine if heads is None else mine[(heads >= np.uint64(low)) & (heads <= np.uint64(high))]
                        found = machine.ordinals(data, begin[part], length[part])
                        ok = found >= 0
                        k, c = np.unique((group[row[part[ok]]] << 40) | (found[ok] + base), return_counts=True)
                        keys.append(k)
                        counts.append(c.astype(np.int64))
                        held += len(k)
                if held > HELD_COUNTS:
                    k, c = merged()
                    keys, counts, held = [k], [c], len(k)
                    if held > HELD_COUNTS // 2:
                        yield from flush()
                        keys, counts, held = [], [], 0
        if held:
            yield from flush()
    return run


def recount(docs: DataFrame, shards: DataFrame, round_bytes: int = 64 << 20) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of each term of the language in each source; n above 0 only.

    ``docs``: lang, source, text without nulls. ``shards``: as of
    :func:`vocabulary`. The transducers are broadcast in rounds of at most
    ``round_bytes`` (a single larger one has a round of its own); each round
    reads the texts once.
    """
    spark = docs.sparkSession
    sizes = shards.select("lang", "base", F.octet_length("transducer").alias("bytes")).collect()  # a few numbers for each shard
    rounds: list[list] = [[]]
    held = 0
    for r in sorted(sizes, key=lambda r: (r["lang"], r["base"])):
        if rounds[-1] and held + r["bytes"] > round_bytes:
            rounds.append([])
            held = 0
        rounds[-1].append((r["lang"], r["base"]))
        held += r["bytes"]
    out = None
    for members in rounds if sizes else []:
        wanted = spark.createDataFrame(members, "lang string, base long")
        loaded: dict[str, list] = {}
        # at most round_bytes
        for r in shards.join(F.broadcast(wanted), ["lang", "base"]).collect():
            loaded.setdefault(r["lang"], []).append((bytes(r["first"]), bytes(r["last"]), r["base"], bytes(r["transducer"])))
        task = _recount(uuid.uuid4().hex, spark.sparkContext.broadcast(loaded))
        part = docs.select("lang", "source", "text").mapInArrow(task, "lang string, source string, ordinal long, n long")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    return out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 5) / whole), by long division in three digits of a thousand: exact in 64 bits."""
    x = count.astype(np.int64) + 5
    out, rest = x // whole, x % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def _block_distances(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences between all sources of a language over one block of ordinals."""
    groups = pdf[pdf["ordinal"] < 0].sort_values("source")
    names, whole = groups["source"].to_numpy(object), groups["n"].to_numpy(np.int64)
    cells = pdf[pdf["ordinal"] >= 0]
    place = {s: i for i, s in enumerate(names)}
    ordinal, column = np.unique(cells["ordinal"].to_numpy(np.int64), return_inverse=True)
    count = np.zeros((len(names), len(ordinal)), np.int64)
    count[[place[s] for s in cells["source"]], column] = cells["n"].to_numpy(np.int64)
    p = shares(count, whole[:, None])
    parts = []
    for i in range(len(names) - 1):
        parts.append(pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": names[i], "b": names[i + 1:], "value": np.abs(p[i + 1:] - p[i]).sum(axis=1)}))
    return pd.concat(parts) if parts else pd.DataFrame({"lang": [], "a": [], "b": [], "value": []})


def divergence_audit(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, shard_terms: int = 1 << 20,
                     round_bytes: int = 64 << 20, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how the sources of each language differ.

    Of a source of a language, ``pair`` rows give the distance to each
    other source of that language (largest first), ``term`` rows the
    ``top_terms`` terms that it uses more than the language does. A share is
    1 + floor(10^9 (count + 5) / (N + 5 V)) of V kept terms with N
    occurrences; all is exact in integers.

    * Null text, lang and source count as empty ones; a row with an empty
      text still makes its (lang, source) occur.
    * Texts are read whole, whatever their length; repeated rows count each
      time, null ids too (ids are not looked at).
    * A language without kept terms has ``pair`` rows with value 0, one
      with a single source none. Ties go by the item's UTF-8 bytes.
    * No documents give an empty result. Extra columns are ignored,
      whatever their names.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of(F.col(lang_col).cast("string")).alias("lang"), text_of(F.col(source_col).cast("string")).alias("source"),
                        text_of(text_col).alias("text"))
    shards = vocabulary(kept_terms(texts.select("lang", "text"), min_docs), shard_terms)
    counts = stored(recount(texts, shards, round_bytes), "ordinal-counts")
    sizes = shards.groupBy("lang").agg(F.sum("terms").alias("v"))
    used = counts.groupBy("lang", "source").agg(F.sum("n").alias("used"))
    zero = F.lit(0).cast("long")
    # one row for each source of each language
    groups = stored(texts.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(sizes, "lang", "left")
                    .select("lang", "source", F.coalesce("used", zero).alias("used"), F.coalesce("v", zero).alias("v"))
                    .withColumn("whole", F.col("used") + 5 * F.col("v")), "divergence-groups")

    # blocks of ordinals, smaller where a language has more sources, so that a block stays small
    per_lang = groups.groupBy("lang").agg(F.max("v").alias("v"), F.greatest(F.lit(1), F.lit(1 << 20) / F.count("*")).cast("long").alias("block_terms"))
    cells = counts.join(per_lang.select("lang", "block_terms"), "lang").select(
        "lang", "source", "ordinal", "n", F.floor(F.col("ordinal") / F.col("block_terms")).cast("long").alias("block"))
    last = F.floor((F.col("v") - 1) / F.col("block_terms")).cast("long")
    heads = groups.join(per_lang.filter("v > 0").select("lang", F.explode(F.sequence(zero, last)).alias("block")), "lang").select(
        "lang", "source", F.lit(-1).cast("long").alias("ordinal"), F.col("whole").alias("n"), "block")
    near = (cells.unionByName(heads).groupBy("lang", "block").applyInPandas(_block_distances, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = near.unionAll(near.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    # a row for each two sources is what the result has
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = (groups.select("lang", "source").join(other, "lang").filter("source != item")
             .join(both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value"), ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value")))
    order = [F.col("value").desc()]
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order, "item")))

    def share(n: str, whole: str):
        return F.expr(f"1 + (cast({SCALE} as decimal(20, 0)) * ({n} + 5)) div {whole}")

    overall = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    wholes = groups.groupBy("lang").agg((F.sum("used") + 5 * F.max("v")).alias("lang_whole"))
    used_more = (counts.join(overall, ["lang", "ordinal"]).join(groups.select("lang", "source", "whole"), ["lang", "source"]).join(wholes, "lang")
                 .select("lang", "source", "ordinal", (share("n", "whole") - share("lang_n", "lang_whole")).cast("long").alias("value"))
                 .filter("value > 0"))
    best = (used_more.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order, "ordinal")))
            .filter(F.col("rank") <= top_terms))
    # the unfolded terms are many times the size of the files that Spark would judge a broadcast by
    terms = best.join(term_ordinals(shards).hint("merge"), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
