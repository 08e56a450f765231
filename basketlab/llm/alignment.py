"""Alignment of two tokenizers' tokens by merge-path partitioning.

Each text is encoded by a byte-level BPE (A) and a sentence-piece BPE (B). The
ends of a token sequence, in bytes, ascend, and so do those of many texts one
behind the other. Merging the two lists of ends yields everything: an end of A
or B closes one link (the A and the B token over the byte in front of it), and
an end that both have closes a group. The merge is cut on its diagonals: a
binary search on each gives the place in A and in B where an equal-work piece
starts, whatever the texts' lengths, so a long text is many pieces and many
short ones share one. Pieces are merged independently; each numbers its groups
from 0, and the sums of the pieces in front stitch the group that runs over a
border together.

How many documents hold an id pair is counted over blocks of documents. A
block's row holds its distinct pairs and, compressed, each document's pairs as
places in that list. Only (block, pair) rows are counted and joined back, so a
pair that is in every document is one row a block: no key is hot. The block
then meets its counts once.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

#: Ends of A and B in a piece of the merge.
PIECE = 1 << 14
#: Characters of text in a block; a longer document is a block of its own.
BLOCK_CHARS = 2_000_000
STATS = [("doc_id", T.LongType()), ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()),
         ("n_links", T.LongType()), ("groups_sha256", T.StringType())]
BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), *(T.StructField(n, T.ArrayType(t)) for n, t in STATS),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("n_docs", T.ArrayType(T.LongType())),
    T.StructField("links", T.BinaryType())])
OUT = T.StructType([T.StructField(n, t) for n, t in
                    (*STATS[:-1], ("n_best", T.LongType()), ("count_sum", T.LongType()), STATS[-1])])


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def merge_path(a, b, diagonals):
    """How many of ``a`` and of ``b`` (ascending) lie before each diagonal of
    their merge, where of equal numbers those of ``a`` come first."""
    import numpy as np
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(diagonals - 1 - mid, 0, len(b) - 1)])
        low, high = np.where(before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, diagonals - low


def merge_piece(a, b, i0: int, i1: int, j0: int, j1: int):
    """One piece of the merge of the ends ``a[i0:i1]`` and ``b[j0:j1]``: its
    links (place in a, place in b) in order, the group of each A and each B
    token that ends in it, numbered from the piece's first one, and how many
    groups it closes. Only the neighbours over the border are looked at."""
    import numpy as np
    mine, other = a[i0:i1], b[j0:j1]
    over_b = np.searchsorted(other, mine, "left")       # the B token in which each A token ends
    over_a = np.searchsorted(mine, other, "left")
    at_a, at_b = np.arange(i1 - i0) + over_b, np.arange(j1 - j0) + np.searchsorted(mine, other, "right")
    over_b, over_a = over_b + j0, over_a + i0
    both = b[np.minimum(over_b, len(b) - 1)] == mine    # an end of both closes a group
    # The same end of B comes behind it, perhaps as the first one of the next piece.
    again = np.zeros(j1 - j0, dtype=bool)
    inside = over_a < i1
    again[inside] = a[over_a[inside]] == other[inside]
    if i0 and len(other) and a[i0 - 1] == other[0]:
        again[0] = True
    n = i1 - i0 + j1 - j0
    closes, drop = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    closes[at_a], drop[at_b] = both, again
    link_a, link_b = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    link_a[at_a], link_b[at_a] = np.arange(i0, i1), over_b
    link_a[at_b], link_b[at_b] = over_a, np.arange(j0, j1)
    group = np.cumsum(closes) - closes
    return link_a[~drop], link_b[~drop], group[at_a], group[at_b] - again, int(closes.sum())


def merged(a, b, piece: int = PIECE):
    """Links and groups of the token sequences with the ends ``a`` and ``b``:
    (A's places, B's places) of all links in order, and the group of each A
    and B token, from 0. Both sequences cover the same bytes."""
    import numpy as np
    total = len(a) + len(b)
    i, j = merge_path(a, b, np.append(np.arange(0, total, piece), total)) if total else ([0], [0])
    parts, groups = [], 0
    for p in range(len(i) - 1):
        link_a, link_b, group_a, group_b, closed = merge_piece(a, b, i[p], i[p + 1], j[p], j[p + 1])
        parts.append((link_a, link_b, group_a + groups, group_b + groups))
        groups += closed
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and the digest's strings.

    No token of B runs over the border between a non-space and a space (the
    vocabulary is checked), and none of A does, so texts are cut there and
    both sides' ids of a piece are remembered together.
    """

    def __init__(self, path_a: str, path_b: str, keep: int = 100_000):
        import numpy as np
        import sentencepiece
        self.a = tokens.Encoder(path_a, keep // 2)  # whole pieces are remembered here
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = tokens.token_bytes(self.a.tok.get_vocab())
        self.bytes_b = []
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, name in enumerate(names):
            self.bytes_b.append(bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode())
        self.cuts = not any("▁" in name.lstrip("▁") for name in names)
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.known = tokens.Memory(self._piece, keep)
        # Per id: inside its group, and as the last one of its side.
        self.strings = [f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
        self.strings += [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"]

    def _piece(self, piece: str) -> tuple[bytes, bytes]:
        """Ids of a piece with a space in front, as uint32; nothing if the
        tokens' bytes are others."""
        data = (" " + piece).encode()
        a, b = self.a.after_space(piece), array("I", self.b.encode(piece))
        same = (b"".join(map(self.bytes_a.__getitem__, memoryview(a).cast("I"))) == data
                and b"".join(map(self.bytes_b.__getitem__, b)) == data)
        return (a, b.tobytes()) if same else _NOTHING

    def _whole(self, text: str) -> tuple[bytes, bytes]:
        """The same of a text, by the libraries' own calls."""
        data = (" " + text).encode()
        a, b = self.a.plain(" " + text), array("I", self.b.encode(text))
        same = (b"".join(map(self.bytes_a.__getitem__, memoryview(a).cast("I"))) == data
                and b"".join(map(self.bytes_b.__getitem__, b)) == data)
        return (a, b.tobytes()) if same else _NOTHING

    def encode(self, text: str):
        """Ids of A for a space and the text, and of B for the text, as
        arrays; both empty where the tokens' bytes aren't the bytes of a space
        and the text, or the text is empty."""
        import numpy as np
        found = _NOTHING
        if text:
            # In front of the text, too, stands a space.
            parts = None if text[0] == " " or not self.cuts else tokens.pieces(text)
            some = None if parts is None else list(map(self.known.__getitem__, parts))
            if some is None or _NOTHING in some:
                found = self._whole(text)
            else:
                found = tuple(b"".join([x[k] for x in some]) for k in (0, 1))
        return tuple(np.frombuffer(x, dtype="<u4").astype(np.int32) for x in found)


_NOTHING = (b"", b"")
_KNOWN: dict[tuple, Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair per Python worker and vocabulary files."""
    if (path_a, path_b) not in _KNOWN:
        _KNOWN[path_a, path_b] = Tokenizers(path_a, path_b)
    return _KNOWN[path_a, path_b]


@dataclass
class Aligned:
    """Texts' tokens one behind the other, merged."""
    ids_a: object
    ids_b: object
    n_a: object
    n_b: object
    link_a: object
    link_b: object
    group_a: object
    group_b: object


def align(tok: Tokenizers, texts: list[str], piece: int = PIECE) -> Aligned:
    import numpy as np
    pairs = list(map(tok.encode, texts))
    none = np.zeros(0, dtype=np.int64)
    ids_a, ids_b = (np.concatenate([none, *(p[k] for p in pairs)]) for k in (0, 1))
    n_a, n_b = (np.array([len(p[k]) for p in pairs], dtype=np.int64) for k in (0, 1))
    ends = np.cumsum(tok.sizes_a[ids_a]), np.cumsum(tok.sizes_b[ids_b])
    return Aligned(ids_a, ids_b, n_a, n_b, *merged(*ends, piece))


def group_strings(x: Aligned, tok: Tokenizers) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` per text."""
    import numpy as np
    groups = int(x.group_a[-1]) + 1 if len(x.group_a) else 0
    in_a, in_b = np.cumsum(np.bincount(x.group_a, minlength=groups)), np.cumsum(np.bincount(x.group_b, minlength=groups))
    before_b = np.append(0, in_b)
    codes = np.empty(len(x.ids_a) + len(x.ids_b), dtype=np.int64)
    last_a, last_b = np.zeros(len(x.ids_a), dtype=np.int64), np.zeros(len(x.ids_b), dtype=np.int64)
    last_a[in_a - 1], last_b[in_b - 1] = 1, 1
    codes[np.arange(len(x.ids_a)) + before_b[x.group_a]] = 2 * x.ids_a + last_a
    codes[np.arange(len(x.ids_b)) + in_a[x.group_b]] = 2 * (len(tok.bytes_a) + x.ids_b) + last_b
    strings = list(map(tok.strings.__getitem__, codes.tolist()))
    ends = np.cumsum(x.n_a + x.n_b)
    return ["".join(strings[s:e])[:-1] for s, e in zip((ends - x.n_a - x.n_b).tolist(), ends.tolist(), strict=True)]


def _block(number: int, docs: list, texts: list[str], tok: Tokenizers):
    """The row of a block of documents."""
    import hashlib

    import numpy as np
    import zstandard
    x = align(tok, texts)
    doc = np.repeat(np.arange(len(docs)), x.n_a)
    digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in group_strings(x, tok)]
    ends_a = np.cumsum(x.n_a)
    some = x.n_a > 0
    n_groups = np.zeros(len(docs), dtype=np.int64)
    n_groups[some] = x.group_a[ends_a[some] - 1] - x.group_a[(ends_a - x.n_a)[some]] + 1
    doc = doc[x.link_a]
    n_links = np.bincount(doc, minlength=len(docs))
    # Distinct (document, a, b) with the number of links, from one sort of packed numbers.
    bits = [(len(v) - 1).bit_length() for v in (tok.bytes_a, tok.bytes_b)]
    if len(docs).bit_length() + sum(bits) > 63:
        raise ValueError("too many documents in a block for the vocabularies")
    packed = np.sort((doc << sum(bits)) | (x.ids_a[x.link_a] << bits[1]) | x.ids_b[x.link_b])
    first = np.flatnonzero(np.append(True, packed[1:] != packed[:-1])) if len(packed) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.append(first, len(packed)))
    packed = packed[first]
    pairs, place, n_docs = np.unique(packed & ((1 << sum(bits)) - 1), return_inverse=True, return_counts=True)
    a, b = pairs >> bits[1], pairs & ((1 << bits[1]) - 1)
    held = np.bincount(packed >> sum(bits), minlength=len(docs))
    links = zstandard.ZstdCompressor(level=3).compress(
        b"".join(v.astype("<u4").tobytes() for v in (held, place, times)))
    return (number, docs, x.n_a, x.n_b, n_groups, n_links, digests, (a << 32) | b, n_docs, links)


def blocks(docs: DataFrame, path_a: str, path_b: str, *, id_col="doc_id", text_col="text",
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block of documents (``BLOCKS``)."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        tok = tokenizers(path_a, path_b)
        kinds = [pa.int64(), *(pa.list_(pa.int64()) for _ in STATS[:-1]), pa.list_(pa.string()),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        number, held, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []

        def flush():
            row = _block(number, ids, texts, tok)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                              names=BLOCKS.names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if texts and held + len(text) > block_chars:
                    yield flush()
                    number, held, ids, texts = number + 1, 0, [], []
                ids.append(doc)
                texts.append(text)
                held += len(text)
        if texts:
            yield flush()

    common.python_ready(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
            .mapInArrow(run, BLOCKS))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents an id pair is linked, and
    whether no pair of the same A id is in more."""
    counts = rows.groupBy("pair").agg(F.sum("n_docs").alias("count"))
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    return (counts.join(highest, a == F.col("a"))
            .select("pair", "count", (F.col("count") == F.col("highest")).alias("best")))


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, **options) -> DataFrame:
    """One row per document: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best, count_sum, groups_sha256.

    Null and empty texts, and texts which a tokenizer doesn't give back byte
    for byte, have no tokens: zeros and ''. Null ids stay null, repeated rows
    are documents of their own, an empty table gives no rows, other columns
    play no part. A very long text is one row of one block; its merge is cut
    into pieces like any other. Ties for an A id's highest count are all best.
    """
    standard = default_paths()
    path_a, path_b = path_a or standard[0], path_b or standard[1]
    found = common.materialise(blocks(docs, path_a, path_b, **options), "alignment")
    rows = (found.select("block", F.explode(F.arrays_zip("pairs", "n_docs")).alias("x"))
            .select("block", F.col("x.pairs").alias("pair"), F.col("x.n_docs").alias("n_docs")))
    known = rows.select(F.col("block").alias("of"), "pair").join(pair_counts(rows), "pair")

    def run(block, counts):
        import numpy as np
        import pyarrow as pa
        import zstandard
        n = len(block.column("doc_id")[0])
        held, links = np.zeros(n, dtype=np.int64), zstandard.ZstdDecompressor().decompress(block.column("links")[0].as_py())
        data = np.frombuffer(links, dtype="<u4")
        held, rest = data[:n].astype(np.int64), data[n:]
        place, times = rest[:len(rest) // 2], rest[len(rest) // 2:].astype(np.int64)
        by = np.argsort(counts.column("pair").to_numpy())  # the block's own list is in this order
        count = counts.column("count").to_numpy()[by][place]
        best = counts.column("best").to_numpy()[by][place]
        sums = [np.concatenate([[0], np.cumsum(v * times)]) for v in (best, count)]
        ends = np.cumsum(held)
        columns = {name: block.column(name).combine_chunks().flatten() for name, _ in STATS}
        columns |= {name: s[ends] - s[ends - held] for name, s in zip(("n_best", "count_sum"), sums, strict=True)}
        return pa.table([pa.array(columns[f.name], pa.string() if f.name == "groups_sha256" else pa.int64())
                         for f in OUT.fields], names=OUT.names)

    common.python_ready(docs.sparkSession)
    whole = found.select("block", *(n for n, _ in STATS), "links")
    return whole.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, OUT)
