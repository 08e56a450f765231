"""Removal of repeated byte strings, by bucket-pointer refinement.

A byte goes if some string of ``length`` bytes over it also starts earlier (in
a document of smaller id, or before in the same document). Suffixes are sorted
only as far as that question needs:

* Buckets. Every position's q-gram (q a quarter of the length, rounded up) has a bucket
  identifier, a 64-bit hash of its bytes, so identifiers agree everywhere
  without renumbering. Of each string only its least q-gram (by identifier)
  stands for it: equal strings have equal ones at equal places. Consecutive
  strings with the same least q-gram are a block. A bucket with one block is
  finished, and most are.
* Refinement. A position's bucket is refined by the identifiers at later
  offsets: (B[p], B[p+q]) gives buckets of 2q-grams, and these, reused at two
  offsets, the buckets of whole strings. A block's identifier is taken from
  its strings'. Blocks of one bucket with one identifier are equal throughout:
  all but the first go. Buckets whose blocks differ are refined again: a block
  is cut into parts by the place of the least q-gram in the string, and a
  part's bucket is what all its strings have in common, which is longer. Parts
  that are alone in their bucket or equal are finished; what is left is
  compared string by string.

Each task first settles what it can see itself: of equal blocks (or strings)
it hands on the first, and of a bucket that it knows to be mixed a mark. So a
passage that a third of all documents share sends each shuffle a row a task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Positions handled at once, and blocks or strings settled at once in a task.
CHUNK, FLUSH = 1 << 20, 1 << 20
#: A block's strings are counted in 10 bits, and it has up to three quarters of this.
LONGEST = 1360
#: Kinds of rows: to compare, mark of a mixed bucket, settled.
ROW, MIXED, REPEAT, OPEN = range(4)

BLOCKS = "bucket long, block long, key long, place long"
STRINGS = "string long, key long, place long"
SETTLED = "key long, start int, n int, open boolean"
RESULT = T.StructType([T.StructField("key", T.LongType()), T.StructField("n_bytes", T.LongType()),
                       T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                       T.StructField("kept_sha256", T.StringType())])


def _u64(x: int):
    import numpy as np
    return np.uint64(x)


def _mix(x):
    x = x ^ (x >> _u64(32))
    x = x * _u64(0xD6E8FEB86659FD93)
    x ^= x >> _u64(29)
    x = x * _u64(0xBF58476D1CE4E5B9)
    x ^= x >> _u64(32)
    return x


_TABLE = None


def gram_buckets(data, q: int):
    """Identifier of data[p:p+q] for each p: a polynomial over one random
    number per byte value, put together from powers of two."""
    import numpy as np
    global _TABLE
    if _TABLE is None:
        _TABLE = np.random.default_rng(9).integers(0, 1 << 64, 256, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    part, size, out, done = _TABLE[data], 1, None, 0
    while True:
        if q & size:
            if out is None:
                out = part
            else:
                n = len(data) - size - done + 1
                out = part[:n] * _u64(pow(base, done, 1 << 64)) + out[size:size + n]
            done += size
        if done == q:
            return _mix(out)
        n = len(data) - 2 * size + 1
        part = part[:n] * _u64(pow(base, size, 1 << 64)) + part[size:size + n]
        size *= 2


def refine(buckets, offset: int, n: int):
    """Buckets of positions 0..n-1 refined by the bucket ``offset`` later."""
    return _mix(buckets[:n] * _u64(0xC2B2AE3D27D4EB4F) + buckets[offset:offset + n])


def string_buckets(grams, q: int, length: int, n: int):
    """Identifiers of the n strings that start at 0..n-1."""
    twice = refine(grams, q, len(grams) - q)
    return refine(twice, length - 2 * q, n)


def _least(values, width: int):
    """Minimum of each run of ``width`` values."""
    import numpy as np
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def chunks(data, length: int):
    """(first string, their number, grams, q) by parts of bounded size."""
    q = -(-length // 4)
    n = len(data) - length + 1
    for first in range(0, n, CHUNK):
        here = min(CHUNK, n - first)
        yield first, here, gram_buckets(data[first:first + here + length - 1], q), q


def _anchors(grams, n: int, width: int):
    """Place of the least q-gram of each of n strings of ``width`` q-grams."""
    import numpy as np
    at = np.arange(len(grams), dtype=np.uint64)
    mask = _u64((1 << 21) - 1)
    return (_least((grams & ~mask) | at, width)[:n] & mask).astype(np.int64)


def parts_of(data, length: int, wanted):
    """The strings marked in ``wanted``, by parts of blocks: arrays (bucket,
    part identifier, first string, strings)."""
    import numpy as np
    out = []
    for first, n, grams, q in chunks(data, length):
        p = np.flatnonzero(wanted[first:first + n])
        if not len(p):
            continue
        anchor = _anchors(grams, n, length - q + 1)[p]
        back = anchor - p
        width = -(-(length - q + 1) // 4)
        part = back // width
        heads = _runs(anchor, part, p - np.arange(len(p)))
        common = refine(refine(grams, q, len(grams) - q), length - width + 1 - 2 * q,
                        len(grams) + q - (length - width + 1))
        bucket = _mix(common[anchor[heads] - width * part[heads]] + part[heads].astype(np.uint64))
        strings = _mix(string_buckets(grams, q, length, n)[p] + back.astype(np.uint64) * _u64(0x9E3779B97F4A7C15))
        out.append((bucket, np.add.reduceat(strings, heads), p[heads] + first, np.diff(np.append(heads, len(p)))))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def blocks_of(data, length: int):
    """Arrays (bucket, block identifier, first string, strings)."""
    import numpy as np
    out = []
    for first, n, grams, q in chunks(data, length):
        anchor = _anchors(grams, n, length - q + 1)
        starts = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        sizes = np.diff(np.append(starts, n))
        inside = np.arange(n) - np.repeat(starts, sizes)
        strings = _mix(string_buckets(grams, q, length, n) + inside.astype(np.uint64) * _u64(0x9E3779B97F4A7C15))
        out.append((grams[anchor[starts]], np.add.reduceat(strings, starts), starts + first, sizes))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _place(start, n, kind):
    return (start << 10 | n) << 2 | kind


def _batch(names, *columns):
    import numpy as np
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).view(np.int64)) for c in columns], names=names)


def _runs(*columns):
    """Starts of the runs of rows that agree in all (sorted) columns."""
    import numpy as np
    new = np.zeros(len(columns[0]), dtype=bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _scattered(key, place):
    """A bucket for rows that need no comparison: spreads them evenly."""
    import numpy as np
    return _mix(np.asarray(key).astype(np.uint64) * _u64(0x9E3779B97F4A7C15) + np.asarray(place).astype(np.uint64))


def settle_blocks(bucket, block, key, start, n):
    """What a task can settle by itself, as rows of BLOCKS."""
    import numpy as np
    order = np.lexsort((start, key, block, bucket))
    bucket, block, key, start, n = (x[order] for x in (bucket, block, key, start, n))
    firsts = _runs(bucket, block)
    kind = np.full(len(bucket), REPEAT)
    kind[firsts] = ROW
    heads = _runs(bucket[firsts])
    several = np.diff(np.append(heads, len(firsts))) > 1
    kind[firsts[np.repeat(several, np.diff(np.append(heads, len(firsts))))]] = OPEN
    place = _place(start, n, kind)
    spread = kind != ROW
    to = bucket.copy()
    to[spread] = _scattered(key[spread], place[spread])
    marks = bucket[firsts[heads[several]]]
    zero = np.zeros(len(marks), dtype=np.int64)
    return (np.concatenate([to, marks]), np.concatenate([block, zero.view(np.uint64)]),
            np.concatenate([key, zero]), np.concatenate([place, zero + MIXED]))


def _collected(batches, rows_of, settle, names):
    """Gather the rows of texts, settle them by parts of FLUSH rows."""
    import numpy as np
    held, n = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = rows_of(*row)
            if rows is not None:
                held.append(rows)
                n += len(rows[0])
            if n >= FLUSH:
                yield _batch(names, *settle(*(np.concatenate(x) for x in zip(*held, strict=True))))
                held, n = [], 0
    if held:
        yield _batch(names, *settle(*(np.concatenate(x) for x in zip(*held, strict=True))))


def _whole_runs(batches):
    """The rows of a sorted partition as int64 arrays, cut between keys."""
    import numpy as np
    carry = None
    for batch in batches:
        now = [c.to_numpy() for c in batch.columns]
        if carry is not None:
            now = [np.concatenate(x) for x in zip(carry, now, strict=True)]
        if not len(now[0]):
            continue
        last = np.flatnonzero(now[0] != now[0][-1])
        cut = last[-1] + 1 if len(last) else 0
        carry = [x[cut:] for x in now]
        if cut:
            yield [x[:cut] for x in now]
    if carry is not None and len(carry[0]):
        yield carry


def _settled(key, place, is_open):
    import numpy as np
    import pyarrow as pa
    start, n = place >> 12, place >> 2 & 1023
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(is_open)],
        names=["key", "start", "n", "open"])


def _wanted(data, length: int, ranges):
    """Marks the strings of (start, n) ranges."""
    import numpy as np
    out = np.zeros(len(data) - length + 1, dtype=bool)
    for r in ranges:
        out[r["start"]:r["start"] + r["n"]] = True
    return out


def _with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """key, text and the ranges of the documents that have any. The texts are
    dealt out by key here and for the result: one exchange, used again."""
    per_doc = ranges.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    return docs.select("key", "text").join(per_doc, "key").select("key", "text", "ranges")


def compared_blocks(docs: DataFrame, length: int, open_: DataFrame | None = None) -> DataFrame:
    """Rows of SETTLED: blocks that repeat an earlier one, and blocks whose
    strings must be compared further (open). Of all documents, or of the
    parts of the blocks in ``open_``."""
    def collect(batches):
        import numpy as np

        def rows_of(key, text, ranges=None):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            if len(data) < length:
                return None
            bucket, block, start, n = (blocks_of(data, length) if ranges is None
                                       else parts_of(data, length, _wanted(data, length, ranges)))
            return bucket, block, np.full(len(start), key), start, n

        yield from _collected(batches, rows_of, settle_blocks, ["bucket", "block", "key", "place"])

    def compare(batches):
        import numpy as np
        for bucket, block, key, place in _whole_runs(batches):
            kind = place & 3
            heads = _runs(bucket)
            sizes = np.diff(np.append(heads, len(bucket)))
            row = kind == ROW
            big = np.iinfo(np.int64)
            low = np.minimum.reduceat(np.where(row, block, big.max), heads)
            high = np.maximum.reduceat(np.where(row, block, big.min), heads)
            mixed = np.repeat((low < high) | np.logical_or.reduceat(kind == MIXED, heads), sizes)
            first = np.repeat(np.minimum.reduceat(np.where(row, np.arange(len(row)), len(row)), heads), sizes)
            later = row & ~mixed & (np.arange(len(row)) > first)
            is_open = (kind == OPEN) | row & mixed
            keep = later | is_open | (kind == REPEAT)
            yield _settled(key[keep], place[keep], is_open[keep])

    rows = (docs.select("key", "text") if open_ is None else _with_ranges(docs, open_)).mapInArrow(collect, BLOCKS)
    return rows.repartition("bucket").sortWithinPartitions("bucket", "key", "place").mapInArrow(compare, SETTLED)


def settle_strings(string, key, start):
    """Strings that a task sees again go; the first is handed on. Consecutive
    repeats are one row."""
    import numpy as np
    order = np.lexsort((start, key, string))
    string, key, start = string[order], key[order], start[order]
    firsts = np.zeros(len(string), dtype=bool)
    firsts[_runs(string)] = True
    k, s = key[~firsts], start[~firsts]
    order = np.lexsort((s, k))
    k, s = k[order], s[order]
    heads = _runs(k, s - np.arange(len(s)), (s - s[:1]) // 512)
    sizes = np.diff(np.append(heads, len(s)))
    place = _place(s[heads], sizes, REPEAT)
    return (np.concatenate([string[firsts], _scattered(k[heads], place)]), np.concatenate([key[firsts], k[heads]]),
            np.concatenate([_place(start[firsts], 1, ROW), place]))


def compared_strings(docs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """Rows of SETTLED for the strings of open ranges that start elsewhere too
    and earlier."""
    def collect(batches):
        import numpy as np

        def rows_of(key, text, ranges):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            wanted = _wanted(data, length, ranges)
            strings, starts = [], []
            for first, n, grams, q in chunks(data, length):
                at = np.flatnonzero(wanted[first:first + n])
                if len(at):
                    strings.append(string_buckets(grams, q, length, n)[at])
                    starts.append(at + first)
            starts = np.concatenate(starts)
            return np.concatenate(strings), np.full(len(starts), key), starts

        yield from _collected(batches, rows_of, settle_strings, ["string", "key", "place"])

    def compare(batches):
        import numpy as np
        for string, key, place in _whole_runs(batches):
            kind = place & 3
            rows = np.flatnonzero(kind == ROW)
            later = np.ones(len(rows), dtype=bool)
            later[_runs(string[rows])] = False
            keep = np.concatenate([rows[later], np.flatnonzero(kind == REPEAT)])
            yield _settled(key[keep], place[keep], np.zeros(len(keep), dtype=bool))

    rows = _with_ranges(docs, open_).mapInArrow(collect, STRINGS)
    return rows.repartition("string").sortWithinPartitions("string", "key", "place").mapInArrow(compare, SETTLED)


def spans_of(n_bytes: int, repeats, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end) from (first string, strings)."""
    out: list[list[int]] = []
    for start, n in sorted(repeats):
        end = min(n_bytes, start + n - 1 + length)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(key, text) with keys unique and in the order of ids: the ids
    themselves. Where ids are null or repeat, rows are numbered in the order of
    id (null first) and text hash and kept as a table; then also (key, doc_id)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    n, different = rows.select(F.count("*"), F.count_distinct("doc_id")).first()
    if n == different:
        return rows.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("key"), "text"), None
    order = [F.col("doc_id"), F.xxhash64("text")]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    table = common.materialise(sorted_.withColumn("key", F.monotonically_increasing_id()), "numbered")
    return table.select("key", "text"), table.select("key", "doc_id")


def removed(docs: DataFrame, length: int = 100, *, id_col="doc_id", text_col="text",
            with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and
    with ``with_text`` the spans, and the kept bytes as binary).

    Texts are UTF-8 bytes, a null text is empty, matches never run over a
    document's end, and strings are judged on the input. Null ids come before
    all others; rows that repeat an id are documents of their own, in the
    order of a hash of their text. An empty table gives no rows; other columns
    play no part. ``length`` is at least 4 and at most ``LONGEST``. Very long
    texts are read in chunks of a mebibyte that overlap by a string.
    """
    if not 4 <= length <= LONGEST:
        raise ValueError(f"length must be from 4 to {LONGEST}")
    common.python_ready(docs.sparkSession)
    rows, ids = keyed(docs, id_col, text_col)
    first = common.materialise(compared_blocks(rows, length), "blocks")
    # Not kept: within one plan the rounds share the exchange of the texts.
    second = compared_blocks(rows, length, first.filter("open"))
    third = compared_strings(rows, second.filter("open"), length)
    settled = first.filter("NOT open").unionByName(second.filter("NOT open")).unionByName(third)
    repeats = settled.groupBy("key").agg(
        F.collect_list(F.struct("start", "n")).alias("repeats"))
    fields = list(RESULT.fields)
    if with_text:
        fields += T.StructType.fromDDL("spans array<struct<start:int,end:int>>, kept binary").fields
    schema = T.StructType(fields)

    def cut(batches):
        import pyarrow as pa
        types = [pa.int64()] * 4 + [pa.string()]
        if with_text:
            types += [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary()]
        for batch in batches:
            out = []
            for key, text, repeats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                spans = spans_of(len(data), [(r["start"], r["n"]) for r in repeats or ()], length)
                at, kept = 0, []
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                row = (key, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                out.append(row + ((([{"start": s, "end": e} for s, e in spans]), kept) if with_text else ()))
            columns = list(zip(*out, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=schema.names)

    out = rows.join(repeats, "key", "left").select("key", "text", "repeats").mapInArrow(cut, schema)
    return (out.withColumnRenamed("key", "doc_id") if ids is None
            else out.join(ids, "key").select("doc_id", *schema.names[1:]))
