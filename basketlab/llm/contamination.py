"""Benchmark decontamination: n-gram seeds and Smith-Waterman alignment.

One pass over the corpus that moves no text. All n-grams of an item are seeds:
a choice by document counts loses copies, because the counts come from all
copies together and say nothing of the n-grams that one edited copy has kept.
Hits of one item on neighbouring diagonals mark a passage, and the passage is
aligned with the item word by word. The score is the alignment's share of the
best the item could reach, so edited and paraphrased copies score too, as long
as n words in a row are kept. An item of fewer words has to stand there whole. What common n-grams hit costs little: documents
and passages with too few of the item's words for the least score aren't
aligned, which loses nothing.

The test items go to every task in blocks of at most ``block_words`` words,
one block after the other.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

_WORD = re.compile(r"[^\W_]+")
MATCH, MISMATCH, GAP = 2, -1, -1
MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("n_seeds", T.IntegerType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
]))


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass
class Block:
    """Test items with their words as numbers and their n-grams as keys."""
    n: int
    ids: list = field(default_factory=list)
    items: list = field(default_factory=list)
    vocabulary: dict = field(default_factory=dict)
    #: Sorted n-gram keys, and for each the (item, offset) places.
    keys: object = None
    places: list = field(default_factory=list)
    #: Items of fewer than n words: length -> key of the whole item -> items.
    short: dict = field(default_factory=dict)

    def add(self, item_id, item_words: list[str]) -> None:
        import numpy as np
        v = self.vocabulary
        self.ids.append(item_id)
        self.items.append(np.array([v.setdefault(w, len(v)) for w in item_words], dtype=np.int64))

    def index(self) -> "Block":
        import numpy as np
        places: dict = {}
        short: dict = {}
        for i, item in enumerate(self.items):
            if len(item) < self.n:
                whole = int(ngram_keys(item, len(item))[0])
                short.setdefault(len(item), {}).setdefault(whole, []).append(i)
                continue
            grams = ngram_keys(item, self.n)
            for offset in range(len(grams)):
                places.setdefault(int(grams[offset]), []).append((i, offset))
        order = sorted(places)
        return Block(self.n, self.ids, self.items, self.vocabulary, np.array(order, dtype=np.uint64),
                     [places[k] for k in order], short)

    def hits(self, text_words: list[str]):
        """The text as numbers (-1: in no item), positions of known n-grams,
        and their places in ``keys``."""
        import numpy as np
        get = self.vocabulary.get
        numbers = np.fromiter((get(w, -1) for w in text_words), dtype=np.int64, count=len(text_words))
        if len(numbers) < self.n or not len(self.keys):
            return numbers, (), ()
        known = np.convolve(numbers >= 0, np.ones(self.n, dtype=np.int64), "valid") == self.n
        at = np.flatnonzero(known)
        if not len(at):
            return numbers, (), ()
        grams = ngram_keys(numbers, self.n)[at]
        key = np.searchsorted(self.keys, grams)
        found = (key < len(self.keys)) & (self.keys[np.minimum(key, len(self.keys) - 1)] == grams)
        return numbers, at[found], key[found]


    def whole(self, numbers) -> dict[int, list[int]]:
        """Items of fewer than n words that stand in the text word by word,
        and the places where they start."""
        import numpy as np
        out: dict[int, list[int]] = {}
        for length, items in self.short.items():
            keys = ngram_keys(numbers, length)
            keys[np.convolve(numbers < 0, np.ones(length, dtype=np.int64), "valid") > 0 if len(keys) else []] = 0
            for at in np.flatnonzero(np.isin(keys, np.array(list(items), dtype=np.uint64))):
                for i in items[int(keys[at])]:
                    if (numbers[at:at + length] == self.items[i]).all():
                        out.setdefault(i, []).append(int(at))
        return out


def ngram_keys(numbers, n: int):
    import numpy as np
    x = numbers.astype(np.uint64)
    h = np.zeros(max(0, len(x) - n + 1), dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[i:len(x) - n + 1 + i] + np.uint64(1)
        h ^= h >> np.uint64(31)
    return h


def align(item, passage) -> tuple[int, int]:
    """Best local alignment (Smith-Waterman, gaps of equal cost) of two number
    arrays: its score and its end in ``passage``. The row's own gaps are a
    running maximum of the scores moved by their column."""
    import numpy as np
    slope = -GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + step, out=new[1:])
        row = np.maximum.accumulate(new + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def passages(diagonals: list[int], length: int) -> list[tuple[int, int]]:
    """(first, end) word places of the stretches to align. An alignment that
    reaches half of the item's best has at most ``length`` gaps, so one
    through a hit lies within that distance of it; stretches which touch are
    one, so runs of a copy with words inserted between them stay together."""
    out: list[list[int]] = []
    for d in sorted(diagonals):
        first, end = max(0, d - length), d + 2 * length
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(x) for x in out]


def _matches(text: str, block: Block, least: float) -> list[dict]:
    import numpy as np
    numbers, at, key = block.hits(words(text))
    found = block.whole(numbers) if block.short and len(numbers) else {}
    if not len(at) and not found:
        return []
    by_item: dict[int, list[int]] = {}
    for p, k in zip(at, key, strict=True):
        for item, offset in block.places[k]:
            by_item.setdefault(item, []).append(int(p) - offset)
    held = np.zeros(len(block.vocabulary), dtype=bool)
    held[numbers[numbers >= 0]] = True
    out = []
    spans = [m.span() for m in _WORD.finditer(text)] if found else None
    for i, starts in sorted(found.items()):
        out.append({"item_id": block.ids[i], "score": 1.0, "n_seeds": len(starts), "start": spans[starts[0]][0],
                    "end": spans[starts[0] + len(block.items[i]) - 1][1]})
    for i, diagonals in sorted(by_item.items()):
        item, best = block.items[i], None
        # Each word of the item and of the passage matches once at most.
        if np.count_nonzero(held[item]) < least * len(item):
            continue
        for first, end in passages(diagonals, len(item)):
            passage = numbers[first:end]
            if np.count_nonzero(np.isin(passage, item)) < least * len(item):
                continue
            score, end = align(item, passage)
            if best is None or score > best[0]:
                best = (score, first, end, passage)
        share = best[0] / (MATCH * len(item)) if best else 0
        if best and share >= least:
            score, first, end, passage = best
            _, back = align(item[::-1], passage[:end][::-1])
            spans = [m.span() for m in _WORD.finditer(text)]
            out.append({"item_id": block.ids[i], "score": share, "n_seeds": len(diagonals),
                        "start": spans[first + end - back][0], "end": spans[first + end - 1][1]})
    return out


def blocks(items: DataFrame, item_col: str, text_col: str, n: int, block_words: int):
    """The items with words, in blocks, one partition at a time."""
    block, held = Block(n), 0
    for item_id, text in items.select(F.col(item_col).cast("long"), common.text_or_empty(text_col)).toLocalIterator():
        w = words(text)
        if not w:
            continue
        if held and held + len(w) > block_words:
            yield block
            block, held = Block(n), 0
        block.add(item_id, w)
        held += len(w)
    if held:
        yield block


def annotate(docs: DataFrame, items: DataFrame, *, text_col="text", item_col="item_id", item_text_col="text",
             out: str = "matches", n: int = 4, least: float = 0.5, block_words: int = 2_000_000) -> DataFrame:
    """``docs`` with the column ``out``: the test items that a document holds,
    as (item_id, score, n_seeds, start, end), the passage in code points.

    Items of fewer than ``n`` words match where all of their words stand in a
    row; items without words, and null ones, match nothing. Null texts are empty and match nothing.
    An item repeated in a document is reported once, at its best passage.
    Repeated rows of either table are treated each on its own. A column named
    ``out`` is replaced; no items give empty lists. Blocks of items run one
    after the other, with the rows written in between, so a larger benchmark
    takes no more memory in a task. ``least`` must be 0.5 or more: passages
    are cut for that.
    """
    spark = docs.sparkSession
    common.python_ready(spark)
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, MATCHES)])
    result = docs.withColumn(out, F.array().cast(MATCHES))
    if least < 0.5:
        raise ValueError("least must be at least 0.5")
    for number, block in enumerate(blocks(items, item_col, item_text_col, n, block_words)):
        if number:
            last, result = result, common.materialise(result, "annotated")
            common.release(last)

        def run(batches, seeded=block.index()):
            import pyarrow as pa
            for batch in batches:
                at = batch.schema.names.index(out)
                texts, before = batch.column(text_col).to_pylist(), batch.column(out).to_pylist()
                found = [old + _matches(t or "", seeded, least) for t, old in zip(texts, before, strict=True)]
                yield batch.set_column(at, batch.schema.field(at), pa.array(found, batch.schema.field(at).type))

        result = result.mapInArrow(run, schema)
    return result


def contaminated(docs: DataFrame, items: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id,
    score, n_seeds, start, end."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = annotate(rows, items, **options)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
