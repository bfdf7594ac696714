"""Filter interaction audit: what each filter removes in every order, duplicates found by radix tries.

Five filters: A too few words, B too few distinct words, C too many
capitals, D listed symbols, E a text that a smaller id has too. What a
filter removes depends on those before it, so the audit counts all 120
orders at once.

1. A scan takes the texts in blocks of about ``block_bytes``. A block's
   texts go into a compressed trie with the least id at each terminal; A to
   D are decided once for each distinct text. The block passes on a small
   row for each document, each distinct text once, and, every ``split_bytes`` of its
   sorted texts, the shortest prefix that tells a text from the one before.
2. These prefixes are as long as the texts make them (adaptive); a sample
   of them gives the ranges that the distinct texts are dealt out by, so
   that texts behind a common passage are divided, too.
3. Each range inserts its full texts into a trie; a block whose least id
   of a text is not the least of all gets the answer.
4. E follows by one join on (block, text). Documents are then reduced to
   counts per source, set of failing filters (a mask) and label; the orders
   are worked out on these few counts.

A text with a third of all rows travels once for each block and is stored
once in its range; a repeated or null id is combined before the labels are
joined.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_count, stored, text_of
from .term_scan import pieces, text_bytes

FILTERS = "ABCDE"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of UTF-8 that do not begin a code point.
INNER = bytes(range(0x80, 0xC0))
#: Candidates for range ends that the driver chooses from, for each range.
CANDIDATES = 32
ROWS_SCHEMA = "kind int, block long, number long, doc_id long, source string, mask int, text binary, least long"


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by doubling and halving slices."""
    most = min(len(a), len(b))
    low, step = 0, 8
    while low < most and a[low:low + step] == b[low:low + step]:
        low, step = min(most, low + step), step * 2
    high = min(most, low + step)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Byte strings on compressed edges; ``least`` holds the least id at each terminal (None without an id)."""

    def __init__(self):
        self.label: list[bytes] = [b""]
        self.below: list[dict[int, int]] = [{}]
        self.least: list[int | None] = [None]
        self.terminal: list[bool] = [False]

    def _node(self, label: bytes) -> int:
        self.label.append(label)
        self.below.append({})
        self.least.append(None)
        self.terminal.append(False)
        return len(self.label) - 1

    def insert(self, text: bytes, ident: int | None) -> int:
        """The text's terminal, a number that stays valid when later texts split its edge."""
        node, at = 0, 0
        while at < len(text):
            child = self.below[node].get(text[at])
            if child is None:
                child = self._node(text[at:])
                self.below[node][text[at]] = child
                node = child
                break
            label = self.label[child]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_prefix(label, text[at:at + len(label)])
            middle = self._node(label[:same])
            self.below[node][text[at]] = middle
            self.label[child] = label[same:]
            self.below[middle][label[same]] = child
            node, at = middle, at + same
        self.terminal[node] = True
        if ident is not None and (self.least[node] is None or ident < self.least[node]):
            self.least[node] = ident
        return node

    def terminals(self) -> Iterator[int]:
        """All terminals by ascending text."""
        stack = [0]
        while stack:
            node = stack.pop()
            if self.terminal[node]:
                yield node
            stack.extend(child for _, child in sorted(self.below[node].items(), reverse=True))


def text_mask(text: bytes, min_words: int, distinct_pct: int, capitals_pct: int, symbols: bytes) -> int:
    """Bits 0 to 3: the text fails A, B, C, D."""
    words, distinct = 0, set()
    for piece in pieces(text):
        found = piece.split()  # at blanks and \\x09 to \\x0D
        words += len(found)
        distinct.update(found)
    capitals = len(text) - len(text.translate(None, UPPER))
    points = len(text.translate(None, INNER))
    return ((words < min_words) | (100 * len(distinct) < distinct_pct * words) << 1
            | (100 * capitals > capitals_pct * points) << 2 | (len(text.translate(None, symbols)) < len(text)) << 3)


def _rows(kind: int, block: int, **columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    types = {"number": pa.int64(), "doc_id": pa.int64(), "source": pa.string(), "mask": pa.int32(), "text": pa.binary(), "least": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.int32()), pa.array([block] * n, pa.int64()),
         *(pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items())], ["kind", "block", *types])


def _scan(block_bytes: int, block_rows: int, split_bytes: int, thresholds: tuple):
    """Rows of kind 0 for documents, 1 for distinct texts, 2 for candidates of range ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        trie, docs, texts, masks, size = RadixTrie(), [], {}, {}, 0

        def block() -> Iterator[pa.RecordBatch]:
            number = (part << 32) | seq
            ids, sources, nodes = zip(*docs)
            for at in range(0, len(docs), 1 << 14):
                some = nodes[at:at + (1 << 14)]
                yield _rows(0, number, number=list(some), doc_id=list(ids[at:at + (1 << 14)]), source=list(sources[at:at + (1 << 14)]),
                            mask=[masks[x] for x in some], least=[trie.least[x] for x in some])
            ends, before, passed, group, held = [], b"", 0, [], 0
            every = min(split_bytes, size // CANDIDATES + 64)
            for node in trie.terminals():
                text = texts[node]
                passed += len(text) + 64
                if passed >= every:
                    ends.append(text[:common_prefix(before, text) + 1])
                    passed = 0
                before = text
                group.append(node)
                held += len(text)
                if held >= 4 << 20:
                    yield _rows(1, number, number=group, text=[texts[x] for x in group], least=[trie.least[x] for x in group])
                    group, held = [], 0
            if group:
                yield _rows(1, number, number=group, text=[texts[x] for x in group], least=[trie.least[x] for x in group])
            if ends:
                yield _rows(2, number, text=ends)

        for b in batches:
            for ident, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                node = trie.insert(text, ident)
                if node not in texts:
                    texts[node] = text
                    masks[node] = text_mask(text, *thresholds)
                    size += len(text)
                docs.append((ident, source, node))
                if size >= block_bytes or len(docs) >= block_rows:
                    yield from block()
                    seq += 1
                    trie, docs, texts, masks, size = RadixTrie(), [], {}, {}, 0
        if docs:
            yield from block()
    return run


def _deal(ends: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = [bisect.bisect_right(ends, t) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *b.columns], ["part", *b.schema.names])
    return run


def _range_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least id of a text for each block whose own least id is larger or null."""
    trie, asked = RadixTrie(), []
    for b in batches:
        columns = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        for block, number, text, least in zip(columns["block"], columns["number"], columns["text"], columns["least"]):
            asked.append((block, number, least, trie.insert(text, least)))
    answers = [(block, number, trie.least[node]) for block, number, least, node in asked if trie.least[node] != least]
    for at in range(0, len(answers), 1 << 16):
        block, number, least = zip(*answers[at:at + (1 << 16)])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (block, number, least)], ["block", "number", "least_of_all"])


def range_ends(candidates: DataFrame, ranges: int) -> list[bytes]:
    """At most ``ranges`` - 1 of the candidates (column text) that part them into runs of equal length.

    They are chosen from some ``CANDIDATES`` for each range, by hash, which
    bounds what the driver holds. The choice has no part in the result.
    """
    total = candidates.count()
    one_in = max(1, -(-total // (CANDIDATES * ranges)))
    drawn = sorted({bytes(r["text"]) for r in candidates.filter(F.pmod(F.xxhash64("block", "text"), F.lit(one_in)) == 0)
                    .select("text").collect()})
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []


def failing_filters(docs: DataFrame, min_words: int = 50, distinct_pct: int = 65, capitals_pct: int = 5, symbols: bytes = b"#$%&*|",
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_bytes: int = 16 << 20,
                    block_rows: int = 1 << 16, split_bytes: int = 1 << 19) -> DataFrame:
    """doc_id, source and mask for every row of ``docs``; bit k of the mask: the text fails filter k of ABCDE.

    A null text counts as empty, a null source as the empty string. E holds
    of a row if another row with a smaller id has the same text; a row with
    a null id never fails E and makes none fail. Rows that repeat both id
    and text fail E alike. Texts are compared and counted whole.
    """
    spark = docs.sparkSession
    ranges = shuffle_count(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(source_col).cast("string")).alias("source"),
                       text_of(text_col).alias("text"))
    scanned = stored(rows.mapInArrow(_scan(block_bytes, block_rows, split_bytes, (min_words, distinct_pct, capitals_pct, symbols)),
                                     ROWS_SCHEMA), "text-blocks")
    ends = range_ends(scanned.filter("kind = 2").select("block", "text"), ranges)
    dealt = (scanned.filter("kind = 1").select("block", "number", "text", "least")
             .mapInArrow(_deal(ends), "part int, block long, number long, text binary, least long")
             .repartitionById(ranges, F.col("part")))
    answers = dealt.select("block", "number", "text", "least").mapInArrow(_range_tries, "block long, number long, least_of_all long")
    found = (scanned.filter("kind = 0").select("block", "number", "doc_id", "source", "mask", "least")
             .join(stored(answers, "least-ids"), ["block", "number"], "left"))
    again = F.coalesce(F.col("doc_id") > F.coalesce("least_of_all", "least"), F.lit(False))
    return found.select("doc_id", "source", F.col("mask").bitwiseOR(F.when(again, 16).otherwise(0)).alias("mask"))


def order_effects(spark) -> DataFrame:
    """For each mask, order and step (32 x 120 x 5 rows): what the step does to a document with that mask."""
    out = []
    for mask in range(1 << len(FILTERS)):
        fails = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
        for order in permutations(FILTERS):
            for step, f in enumerate(order, 1):
                gone, here = bool(fails & set(order[:step - 1])), f in fails
                out.append((mask, "".join(order), step, int(not gone and not here), int(here and not gone), int(here and gone),
                            int(fails == {f}), 120 // len(fails) if here else 0))
    return spark.createDataFrame(out, "mask int, filter_order string, step int, kept long, removed long, redundant long, "
                                      "unique_fails long, orders_first long")


def filter_audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """part, filter_order, step and counts of documents: 600 rows for each source that occurs, zeros included.

    At each step of each order of ABCDE: ``kept`` after it, ``removed`` by
    it, ``redundant`` (fails its filter, already removed), ``unique_fails``
    (fails its filter only), ``good_lost`` and ``toxic_lost`` (removed here
    with a label quality = 1 or toxic = 1) and ``shapley`` (removed by its
    filter, summed over the orders). ``options``: of :func:`failing_filters`.

    ``labels`` has doc_id, quality and toxic. A document without a label,
    or with a null id, is neither good nor toxic; of several labels for
    one id any that says so counts. No documents give an empty result.
    Extra columns are ignored, whatever their names.
    """
    marked = failing_filters(docs, **options).groupBy("doc_id", "source", "mask").agg(F.count("*").alias("n"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n = F.col("n")
    # one row for each source and mask: at most 32 for a source
    cells = stored(marked.join(known, "doc_id", "left").groupBy("source", "mask").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good") == 1, n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("toxic")), "mask-counts")
    steps = cells.join(F.broadcast(order_effects(docs.sparkSession)), "mask")  # 19,200 rows whatever the input

    def total(of: str, where: str):
        return F.sum(F.col(of) * F.col(where))

    return steps.groupBy(F.col("source").alias("part"), "filter_order", "step").agg(
        total("n", "kept").alias("kept"), total("n", "removed").alias("removed"), total("n", "redundant").alias("redundant"),
        total("n", "unique_fails").alias("unique_fails"), total("good", "removed").alias("good_lost"),
        total("toxic", "removed").alias("toxic_lost"), total("n", "orders_first").alias("shapley"))
