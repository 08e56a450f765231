"""Token ids in one concatenated array with Elias-Fano document borders.

The store is a folder of segments. A segment holds the ids of consecutive
documents (ascending doc_id) as little-endian unsigned integers of 2 or 4
bytes, the documents' ids, and the ends of the documents as an Elias-Fano
sequence: ``low`` has the lower bits of each end, ``high`` the upper bits in
unary, ``select`` the position in ``high`` of every 64th end. That takes about
2 + log2(tokens / documents) bits a document; no table of 64-bit offsets
exists. Segments are rows of Parquet files written by Spark's own committer,
so a lost executor leaves neither half files nor doubles, and the folder can
lie in any store that Spark writes. ``part`` and ``segment`` order them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.session import scratch_path

from . import common, tokens

STEP = 64
#: Ids in a segment; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 20
SEGMENTS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
    T.StructField("n_ids", T.LongType()), T.StructField("width", T.IntegerType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("low_bits", T.IntegerType()),
    T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType()),
    T.StructField("select", T.BinaryType()), T.StructField("ids", T.BinaryType()),
])


class EliasFano:
    """A non-decreasing sequence of n numbers up to u, with select(i)."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, select: bytes):
        import numpy as np
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.samples = np.frombuffer(select, dtype="<u4")

    @staticmethod
    def build(values, u: int) -> "EliasFano":
        import numpy as np
        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        bits = max(0, (u // n).bit_length() - 1) if n else 0
        low = np.packbits((v[:, None] >> np.arange(bits)) & 1, bitorder="little").tobytes() if bits else b""
        ones = (v >> bits) + np.arange(n)
        flags = np.zeros(n + (u >> bits) + 1, dtype=np.uint8)
        flags[ones] = 1
        return EliasFano(n, bits, low, np.packbits(flags, bitorder="little").tobytes(),
                         ones[::STEP].astype("<u4").tobytes())

    def _lower(self, i):
        import numpy as np
        if not self.low_bits:
            return np.zeros_like(i)
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = np.frombuffer(self.low, dtype=np.uint8)
        return (((low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th number: scan ``high`` from the sample before it."""
        import numpy as np
        at = int(self.samples[i // STEP])
        need, byte = i % STEP, at >> 3
        bits = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8, offset=byte, count=1), bitorder="little")
        bits[: at & 7] = 0
        while (ones := int(bits.sum())) <= need:
            need, byte = need - ones, byte + 1
            bits = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8, offset=byte, count=1), bitorder="little")
        one = byte * 8 + int(np.flatnonzero(bits)[need])
        return ((one - i) << self.low_bits) + int(self._lower(np.array([i]))[0])

    def select_all(self):
        """All numbers: the ones of ``high`` and the lower bits."""
        import numpy as np
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little"))
        i = np.arange(self.n)
        return ((ones - i) << self.low_bits) + self._lower(i)


def _segment(part: int, number: int, docs: list, texts: list[bytes], wide: bool):
    import numpy as np
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    ends = np.cumsum([len(x) // 4 for x in texts])
    ef = EliasFano.build(ends, len(ids))
    return (part, number, len(ids), 4 if wide else 2, docs, ef.low_bits, ef.low, ef.high, ef.samples.tobytes(),
            ids.astype("<u4" if wide else "<u2").tobytes())


def write(docs: DataFrame, out: str, path: str, *, id_col="doc_id", text_col="text", end_id=0,
          segment_ids: int = SEGMENT_IDS) -> None:
    """Encode ``docs`` in ascending id order (null ids first, equal ids by a
    hash of their text) and write the store to the folder ``out``. Null texts
    are empty; every document gets the end id; no documents, no segments."""
    common.python_ready(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        enc, end = tokens.encoder(path), end_id.to_bytes(4, "little")
        wide = max(enc.tok.get_vocab_size() - 1, end_id) >= 1 << 16
        part, number, held, ids, docs_held = TaskContext.get().partitionId(), 0, 0, [], []

        def flush():
            row = _segment(part, number, docs_held, ids, wide)
            return pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(row, kinds, strict=True)],
                                              names=SEGMENTS.names)

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(),
                 pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = enc.encode(text.as_py()) + end
                if ids and held + len(x) // 4 > segment_ids:
                    yield flush()
                    number, held, ids, docs_held = number + 1, 0, [], []
                ids.append(x)
                docs_held.append(doc)
                held += len(x) // 4
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)
     .write.option("compression", "zstd").option("parquet.block.size", str(8 << 20)).parquet(out))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Read a store back: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32 (of the ids as little-endian uint32)."""
    common.python_ready(spark)
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    out = T.StructType([T.StructField(x, T.LongType())
                        for x in ("part", "segment", "doc_id", "at", "n_tokens", "ids_crc32")])

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                n = len(r["doc_ids"])
                ends = EliasFano(n, r["low_bits"], r["low"], r["high"], r["select"]).select_all()
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(r["ids"], dtype=f"<u{r['width']}").astype("<u4").tobytes()
                crc = [zlib.crc32(memoryview(ids)[4 * s:4 * e]) for s, e in zip(starts, ends, strict=True)]
                columns = [[r["part"]] * n, [r["segment"]] * n, r["doc_ids"], starts, ends - starts, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=out.names)

    # Ids before a segment: sums by part (as many as shuffle partitions wrote), then inside a part.
    sizes = segments.select("part", "segment", "n_ids")
    by_part = sizes.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = by_part.withColumn("part_base", F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids"))
    base = sizes.join(parts, "part").withColumn(
        "base", F.col("part_base") - F.col("n_ids")
        + F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")))
    return (segments.mapInArrow(run, out).join(base.select("part", "segment", "base"), ["part", "segment"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def encode_documents(docs: DataFrame, path: str, out: str | None = None, **options) -> DataFrame:
    """Write the store (to ``out``, or a new folder in the shared one) and
    return what reading it back gives."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "llm/idstore")
    write(docs, out, path, **options)
    return documents(spark, out)
