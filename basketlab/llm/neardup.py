"""MinHash near-duplicates with sequential Bayesian verification.

1. Each document gets its number of distinct word shingles, a 128-bit key of
   the set, and a MinHash signature. Documents with the same set are one
   class, whose smallest id stands for it.
2. Signatures are cut into bands; classes which share a band are candidates.
   No bucket's pairs are written out: first every member meets the bucket's
   most central one (its buckets have the most members in all, which the least
   edited copy's have), then (in buckets that still hold several components) a
   pseudo-random member. Members already connected need no further link, so a
   group of copies costs its size, not its square. Of the members left, those
   outside a bucket's largest component meet the members of other components
   with which they share one of their rarest shingles: a link shares at least
   threshold * size shingles, so it shares one of the size - that + 1 rarest
   ones of either side. That is exact, and no link is capped.
3. A pair's signatures are compared batch by batch. After n values of which m
   agree, P(similarity >= threshold | m, n) under a uniform prior is the
   probability that Binomial(n + 1, threshold) is at most m; below the miss
   probability the pair is dropped.
4. Survivors are confirmed on the full shingle sets of the texts.
5. Connected components by alternating large-star and small-star rounds, as
   joins and aggregations.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
    T.StructField("signature", T.BinaryType()),
])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
#: Word hashes that a Python worker keeps.
KEEP_WORDS = 200_000


def words(text: str) -> list[bytes]:
    """Lower-cases A-Z and cuts at ASCII white space, nothing else."""
    return text.encode().lower().split()


def shingles(text: str, k: int) -> set:
    """The document's set: its k-word shingles, or all words if fewer."""
    w = words(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(k)), strict=False))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEEP_WORDS:
            self[word] = h
        return h


_HASHES = _Hashes()


def shingle_hashes(text: str, k: int):
    """Distinct 64-bit hashes of the shingles, ascending."""
    import numpy as np
    w = np.fromiter(map(_HASHES.__getitem__, words(text)), dtype=np.uint64)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - n + 1 + i]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def signature(hashes, multipliers, offsets):
    """Minimum of each multiply-shift permutation, as uint32."""
    import numpy as np
    out = np.full(len(multipliers), 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(hashes), 2048):
        x = multipliers[:, None] * hashes[None, i:i + 2048] + offsets[:, None]
        np.minimum(out, (x >> np.uint64(32)).min(axis=1), out=out)
    return out.astype("<u4")


def signed(docs: DataFrame, k: int, hashes: int, *, id_col="doc_id", text_col="text") -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash
        rng = np.random.default_rng(20240607)
        a = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
        for batch in batches:
            n, keys, sigs = [], [], []
            for text in batch.column(2).to_pylist():
                h = shingle_hashes(text, k)
                n.append(len(h))
                keys.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                sigs.append(signature(h, a, b).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sigs, pa.binary())], names=SIGNED.names)

    common.python_ready(docs.sparkSession)
    text = common.text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text")).mapInArrow(run, SIGNED)


def band_members(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, node) of the band buckets that hold two nodes or more."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda i: F.xxhash64(i, F.substring("signature", i * (4 * rows) + 1, F.lit(4 * rows))))
    members = reps.select(F.col("doc_id").alias("node"), F.explode(keys).alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    return members.join(shared.filter("low < high").select("key"), "key").select("key", "node")


def least_matches(threshold: float, batch: int, total: int, miss: float) -> list[tuple[int, int]]:
    """(n, least number of agreeing values among n to go on), batch by batch."""
    out = []
    for n in range(batch, total + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def bayes(pairs: DataFrame, table: DataFrame, percent: int, hashes: int, batch: int, miss: float) -> DataFrame:
    """Pairs whose signatures leave a posterior chance of at least ``miss``."""
    limits = least_matches(percent / 100, batch, hashes, miss)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for part in batches:
            sa, sb = (np.frombuffer(b"".join(part.column(i).to_pylist()), dtype="<u4").reshape(-1, hashes)
                      for i in (2, 3))
            live, agree, done = np.arange(len(sa)), np.zeros(len(sa), dtype=np.int64), 0
            for n, least in limits:
                agree[live] += (sa[live, done:n] == sb[live, done:n]).sum(axis=1)
                live, done = live[agree[live] >= least], n
            yield pa.RecordBatch.from_arrays([part.column(i).take(pa.array(live)) for i in (0, 1)], names=PAIR.names)

    side = {x: table.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"),
                            F.col("signature").alias(f"s{x}")) for x in "ab"}
    sized = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent  # more than that can't be shared
    return (pairs.join(side["a"], "a").join(side["b"], "b").filter(sized)
            .select("a", "b", "sa", "sb").mapInArrow(run, PAIR))


def confirmed(pairs: DataFrame, table: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs with 100 * |A and B| >= percent * |A or B| on the full sets."""
    def run(batches):
        import pyarrow as pa
        for part in batches:
            keep = []
            for i, (x, y) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                x, y = shingles(x, k), shingles(y, k)
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([part.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)],
                                             names=PAIR.names)

    side = {x: table.select(F.col("node").alias(x), F.col("text").alias(f"t{x}")) for x in "ab"}
    return (pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "ta", "tb")
            .mapInArrow(run, PAIR).distinct())


def rare_shingles(nodes: DataFrame, outer: DataFrame, table: DataFrame, percent: int, k: int) -> DataFrame:
    """(node, component, h, n, left): each node's rarest shingles, by the
    count among ``outer`` nodes, as far as a link's first common one can lie.
    What no outer node has comes first and needs no row."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            hashes = [shingle_hashes(t, k).view("int64") for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(hashes, pa.list_(pa.int64()))],
                                             names=["node", "component", "n", "hashes"])

    def exploded(some: DataFrame) -> DataFrame:
        rows = (some.join(table.select("node", F.col("n_shingles").alias("n"), "text"), "node")
                .select("node", "component", "n", "text")
                .mapInArrow(run, "node long, component long, n long, hashes array<long>"))
        return rows.select("node", "component", "n", F.explode("hashes").alias("h"))

    counts = exploded(nodes.join(outer, "node", "left_semi")).groupBy("h").agg(F.count("*").alias("df"))
    shared = exploded(nodes).join(counts, "h")
    # Shingles that no outer node has come first; they use up the place of others.
    by_node = Window.partitionBy("node")
    place = F.row_number().over(by_node.orderBy("df", "h")) + F.col("n") - F.count("*").over(by_node)
    rarest = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return (shared.withColumn("place", place).filter(F.col("place") <= rarest)
            .select("node", "component", "h", "n", (F.col("n") - F.col("place") + 1).alias("left")))


def sharing_rare(rare: DataFrame, outer: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of an ``outer`` node and a node of another component which
    share one of the rarest shingles of both."""
    x = rare.join(outer, "node", "left_semi").select(
        F.col("node").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("left").alias("lx"), "h")
    # If h is the first shingle in this order that both have, no more can be
    # common than are left from there on. (A later h may fail; the first won't.)
    most = F.least("left", "lx")
    able = most * 100 >= (F.col("n") + F.col("nx") - most) * percent
    return (x.join(rare, "h").filter((F.col("cx") != F.col("component")) & able)
            .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each connected component, for
    every node of an edge (a, b)."""
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # A round uses its edges four times: as a table they are planned once.
    edges = common.materialise(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        last, edges = edges, common.materialise(small.filter("a != b").distinct(), "components")
        common.release(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = common.materialise(
        stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "labels")
    common.release(edges)
    return found


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", shingle: int = 5, percent: int = 80,
                    bands: int = 32, rows: int = 4, batch: int = 16, miss: float = 1e-6) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id
    reachable over links, itself included), kept (doc_id = component_id).

    A pair at the threshold 0.8 shares none of 32 bands of 4 values with
    probability 5e-8. Null, empty and blank texts have no shingles and are
    linked with nothing. Rows with a null id are returned with a null
    component and kept. Rows that repeat an id are classed each by its own
    text. An empty table gives an empty table; other columns play no part.
    """
    hashes = bands * rows
    table = common.materialise(signed(docs, shingle, hashes, id_col=id_col, text_col=text_col), "signed")
    able = table.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = able.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    reps = able.join(classes.withColumnRenamed("node", "doc_id"), ["set_key", "doc_id"], "left_semi")
    members = common.materialise(band_members(reps, bands, rows), "members")
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    text = common.text_or_empty(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
    # One row per candidate class: what verification needs, and nothing of the other documents.
    chosen = reps.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id", "set_key"])
    table_of = common.materialise(
        chosen.join(texts, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "set_key"])
        .select(F.col("doc_id").alias("node"), "n_shingles", "signature", "text"), "candidates")

    # The signatures of all other documents aren't needed any more.
    slim = common.materialise(table.select("doc_id", "n_shingles", "set_key"), "sets")
    common.release(table)
    classes = (slim.filter("n_shingles > 0 AND doc_id IS NOT NULL")
               .groupBy("set_key").agg(F.min("doc_id").alias("node")))

    def grown(pairs: DataFrame, stars: DataFrame | None) -> DataFrame:
        """Components after the links among ``pairs``."""
        survivors = common.materialise(bayes(pairs.distinct(), table_of, percent, hashes, batch, miss), "survivors")
        links = common.materialise(confirmed(survivors, table_of, percent, shingle), "links")
        common.release(survivors)
        if stars is not None and links.isEmpty():
            common.release(links)
            return stars
        edges = links if stars is None else stars.select(
            F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)
        found = components(edges)
        common.release(links, *([] if stars is None else [stars]))
        return found

    crowd = members.join(members.groupBy("key").count(), "key").groupBy("node").agg(F.sum("count").alias("score"))
    pivot = members.join(crowd, "node").groupBy("key").agg(
        F.max(F.struct("score", (-F.col("node")).alias("minus"))).alias("p")).select("key", (-F.col("p.minus")).alias("a"))
    first = (members.join(pivot, "key").filter("a != node")
             .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")))
    comps = grown(first, None)

    def open_members() -> DataFrame:
        """Members of buckets which hold several components still."""
        labelled = members.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return labelled.join(mixed.filter("low < high").select("key"), "key")

    rest = open_members()
    pivot = rest.groupBy("key").agg(F.min_by(F.struct("node", "component"), F.xxhash64("key", "node")).alias("p"))
    second = (rest.join(pivot, "key").filter("component != p.component")
              .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")))
    comps = grown(second, comps)

    rest = common.materialise(open_members(), "open")
    common.release(members)
    sizes = rest.groupBy("key", "component").count()
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    outer = common.materialise(rest.join(main, "key").filter("component != main").select("node").distinct(), "outer")
    nodes = common.materialise(rest.select("node", "component").distinct(), "nodes")
    common.release(rest)
    rare = common.materialise(rare_shingles(nodes, outer, table_of, percent, shingle), "rare")
    comps = grown(sharing_rare(rare, outer, percent), comps)
    common.release(nodes, outer, rare, table_of)

    label = classes.join(comps, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    out = slim.join(label, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
