"""Best-fit packing of tokenised documents with Martello-Toth reduction.

Lengths are whole numbers from 1 to the capacity, so the bin-packing instance
is a histogram: at most ``capacity`` counts, however many documents there are.
Only this histogram reaches the driver. There the reduction walks the lengths
from the longest and fixes sets of at most three pieces that dominate every
other set holding that length (fixing them cannot cost a sequence), as many
copies at a time as the counts allow; best-fit decreasing packs what is left.
The resulting plan is a list of slot ranges per length. Each piece then finds
its slot from its rank among the pieces of its length, and the rank comes from
salted counts, so no length, not even one that a third of the pieces share,
meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens: whole
    documents up to the capacity, else full pieces behind a shorter first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, *, id_col="doc_id", text_col="text",
           capacity=2048, end_id=0) -> DataFrame:
    """Tokenise and cut; one row per piece, ids reduced to their crc32.

    A null text is empty: a document of the end id alone. A null id stays
    null. Repeated rows are documents of their own.
    """
    def run(batches):
        import zlib

        import pyarrow as pa
        enc, end = tokens.encoder(path), end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(text.as_py()) + end
                rows += [(doc, k, s, n, zlib.crc32(memoryview(ids)[4 * s:4 * (s + n)]))
                         for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                                                strict=True)], names=PIECES.names)

    common.python_ready(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), common.text_or_empty(text_col)).mapInArrow(run, PIECES)


# --- the plan, from the histogram of lengths ---------------------------------

@dataclass
class Pattern:
    """``count`` sequences which all hold the same (length, copies) parts."""
    parts: list[tuple[int, int]]
    count: int


class _Counts:
    """Counts by length with the next shorter or longer length still there."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = [0] * (capacity + 1)
        for length, k in counts.items():
            self.n[length] = k
        self.lengths = sorted(x for x in counts if counts[x])

    def take(self, lengths, k: int) -> None:
        from bisect import bisect_left
        for x in lengths:
            self.n[x] -= k
            if not self.n[x]:
                del self.lengths[bisect_left(self.lengths, x)]

    def smallest(self, k: int, without: int, above: int = 0) -> list[int]:
        """The k smallest items longer than ``above``, one item ``without`` aside."""
        from bisect import bisect_right
        out = []
        for x in self.lengths[bisect_right(self.lengths, above):]:
            out += [x] * min(k, self.n[x] - (x == without))
            if len(out) >= k:
                break
        return out[:k]

    def largest(self, limit: int, used: list[int]) -> int:
        """The longest item up to ``limit`` besides those in ``used``, or 0."""
        from bisect import bisect_right
        for i in range(bisect_right(self.lengths, limit) - 1, -1, -1):
            x = self.lengths[i]
            if self.n[x] > used.count(x):
                return x
        return 0


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth reduction: fixed patterns, and the counts that remain.

    For a length, with r the room left beside it and k the longest companion
    that fits, a set is fixed if it dominates every feasible set with it:
    nothing fits: the item alone; k = r, or no two companions fit: {item, k};
    no three companions fit, and no pair has both members longer than b, the
    longest that fits beside k: {item, k, b}.
    """
    c, fixed = _Counts(counts, capacity), []
    for length in sorted(counts, reverse=True):
        while c.n[length]:
            room = capacity - length
            k = c.largest(room, [length])
            if not k:
                found = [length]
            elif k == room or sum(low := c.smallest(2, length)) > room or len(low) < 2:
                found = [length, k]
            elif sum(low := c.smallest(3, length)) > room or len(low) < 3:
                b = c.largest(room - k, [length, k])
                above = c.smallest(2, length, b)
                if not b or (len(above) == 2 and sum(above) <= room):
                    break
                found = [length, k, b]
            else:
                break
            times = min(c.n[x] // found.count(x) for x in set(found))
            for x in set(found):
                c.take([x], times * found.count(x))
            fixed.append(Pattern([(x, found.count(x)) for x in sorted(set(found), reverse=True)], times))
    return fixed, {x: c.n[x] for x in c.lengths}


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: equal sequences are one pattern."""
    open_: dict[int, list[Pattern]] = {}

    def put(pattern: Pattern, left: int) -> None:
        open_.setdefault(left, []).append(pattern)

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        todo = counts[length]
        while todo:
            left = min((x for x in open_ if x >= length), default=None)
            if left is None:
                each = capacity // length
                whole, rest = divmod(todo, each)
                if whole:
                    put(Pattern([(length, each)], whole), capacity - each * length)
                if rest:
                    put(Pattern([(length, rest)], 1), capacity - rest * length)
                break
            pattern = open_[left].pop()
            if not open_[left]:
                del open_[left]
            each = left // length
            filled, rest = divmod(todo, each)
            filled = min(filled, pattern.count)
            if filled:
                put(Pattern([*pattern.parts, (length, each)], filled), left - each * length)
            todo -= filled * each
            kept = pattern.count - filled
            if kept and todo:
                put(Pattern([*pattern.parts, (length, rest)], 1), left - rest * length)
                todo, kept = 0, kept - 1
            if kept:
                put(Pattern(pattern.parts, kept), left)
    return [p for group in open_.values() for p in group]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, copies in a sequence, first sequence, offset)."""
    out, used, base = [], {}, 0
    for p in patterns:
        offset = 0
        for length, copies in p.parts:
            out.append((length, used.get(length, 0), copies, base, offset))
            used[length] = used.get(length, 0) + copies * p.count
            offset += copies * length
        base += p.count
    return sorted(out)


# --- placing every piece ------------------------------------------------------

def ranked(parts: DataFrame, rows_per_group: int) -> DataFrame:
    """Adds ``rank``: from 0 among the pieces of a length. Ranks are local to
    a (length, salt) group, moved by the counts of the salts before."""
    total = parts.count()
    salts = max(16, -(-total // rows_per_group))
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = (parts.groupBy("length", "salt").count()
              .withColumn("base", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .select("length", "salt", "base"))
    local = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    return (parts.withColumn("local", local).join(before, ["length", "salt"])
            .withColumn("rank", F.col("base") + F.col("local") - 1).drop("salt", "base", "local"))


def pack(parts: DataFrame, capacity: int = 2048, rows_per_group: int = 1_000_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to
    ``capacity``. ``parts`` must be a table or checkpoint, as it is read three
    times. An empty table gives an empty table."""
    histogram = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}  # capacity rows at most
    table = slots(plan(histogram, capacity))
    rows = ranked(parts.select(*PIECES.names), rows_per_group)
    out = T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])

    def place(batches):
        import numpy as np
        import pyarrow as pa
        length, first, copies, base, offset = np.array(table, dtype=np.int64).reshape(-1, 5).T
        key = (length << 48) + first
        for batch in batches:
            size, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            at = np.searchsorted(key, (size << 48) + rank, "right") - 1
            k = rank - first[at]
            columns = [batch.column(x) for x in PIECES.names]
            columns += [pa.array(base[at] + k // copies[at]), pa.array(offset[at] + k % copies[at] * size)]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return rows.select(*PIECES.names, "rank").mapInArrow(place, out)


def pack_documents(docs: DataFrame, path: str, *, id_col="doc_id", text_col="text", capacity=2048,
                   end_id=0, rows_per_group: int = 1_000_000) -> DataFrame:
    """Documents -> one row per piece with its sequence and place in it.

    Sequences hold at most ``capacity`` tokens, gapless from 0. Null texts are
    empty documents, null ids stay null, repeated rows are packed each,
    documents longer than the capacity are cut, an empty table gives no rows,
    and other columns of ``docs`` play no part.
    """
    parts = common.materialise(
        pieces(docs, path, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id), "pieces")
    return pack(parts, capacity, rows_per_group)
