import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_df, sf  # noqa: F401

from basketlab.llm import idstore, packing, queries, tokens

PATH = tokens.default_path()
ODD = ["", " ", "  a  b ", "\n\n x", "a　 b", "日本語 テスト’s 12½", "don't  stop\t\tnow \n\n\n",
       "<|endoftext|> hi<|endoftext|>", "ab\x1c cd\x85 x\xa0y", "é" * 300 + " " + "z" * 1000, "x" + " " * 50 + "y",
       "tail ", "tail\n", "a\n b", "½ ²³ ª\xad x"]


def ids(text):
    return np.frombuffer(tokens.encoder(PATH).plain(text), dtype="<u4").tolist()


@given(st.text(alphabet=st.sampled_from("ab 's1½é\n\t\x1c　,.\xa0Ż"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(text):
    e = tokens.encoder(PATH)
    assert e.encode(text) == e.plain(text)


def test_encoder_on_odd_texts():
    e = tokens.Encoder(PATH, keep=3)
    for text in ODD * 4:
        assert e.encode(text) == e.plain(text), repr(text)
    assert len(e.known) <= 3 and len(e.known.older) <= 3


@given(st.lists(st.sampled_from(["word", "Wörd", "don't", "a.\nB", "end.%%%", "x,\ny", "b\t\nc", "naïve.", "日本.", "_x", "3.14", "é\n\nz",
                                 "l'été,", "\nq", "r\n"]), max_size=30))
@settings(max_examples=200, deadline=None)
def test_pieces_with_marks_and_line_breaks(parts):
    e = tokens.Encoder(PATH, keep=4) if not parts else tokens.encoder(PATH)
    text = " ".join(parts)
    assert e.encode(text) == e.plain(text)


def test_words_are_kept_from_their_second_sight_on():
    made = []
    m = tokens.Memory(lambda p: made.append(p) or p.upper(), keep=2)
    for p in ("a", "a", "a", "b", "b", "c", "c", "a", "c", "z" * 99, "z" * 99):
        assert m[p] == p.upper()
    # "a" is found in the older generation; a very long piece is never kept.
    assert made.count("a") == 2 and made.count("b") == 2 and made.count("z" * 99) == 2
    assert len(m) <= 2 and len(m.older) <= 2


def optimum(items, capacity):
    """Fewest bins, by search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for left in set(bins):
            if left >= items[i]:
                rest = list(bins)
                rest[rest.index(left)] -= items[i]
                go(i + 1, rest)
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best


def bins_of(patterns):
    return sum(p.count for p in patterns)


def test_reduction_costs_no_bin():
    rng = random.Random(5)
    for _ in range(150):
        cap = rng.choice([10, 17, 30])
        items = [rng.randint(1, cap) for _ in range(rng.randint(1, 8))]
        fixed, rest = packing.reduce_instance(Counter(items), cap)
        left = list(Counter(rest).elements())
        taken = sum((Counter({x: c * p.count for x, c in p.parts}) for p in fixed), Counter())
        assert Counter(left) + taken == Counter(items)
        assert bins_of(fixed) + (optimum(left, cap) if left else 0) == optimum(items, cap), (cap, items)


def test_plan_holds_every_item_once_and_fits():
    rng = random.Random(7)
    for _ in range(60):
        counts = Counter(rng.randint(1, 64) for _ in range(rng.randint(0, 400)))
        patterns = packing.plan(counts, 64)
        assert all(sum(x * c for x, c in p.parts) <= 64 and p.count > 0 for p in patterns)
        held = Counter()
        for p in patterns:
            for x, c in p.parts:
                held[x] += c * p.count
        assert held == +counts
        total = sum(x * c for x, c in counts.items())
        assert bins_of(patterns) <= -(-total // 64) * 1.1 + 1


def check_packing(rows, out, cap=2048):
    want = Counter()
    for doc, text in rows:
        full = ids(text or "") + [0]
        for k, (s, n) in enumerate(packing.cut(len(full), cap)):
            want[doc, k, s, n, zlib.crc32(np.array(full[s:s + n], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    total = sum(r.length for r in out)
    return len(by), -(-total // cap)


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_pack_documents_edge_cases(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, None), (3, None), (7, "w " * 9000)] * 2
    rows += [(100 + i, "same text here") for i in range(400)]  # one length shared by most pieces
    out = packing.pack_documents(docs_df(spark, rows), PATH, rows_per_group=10).collect()
    check_packing(rows, out)
    assert packing.pack_documents(docs_df(spark, []), PATH).count() == 0


def test_op1_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, least = check_packing(rows, queries.op1_best_fit_packing(spark, sf).collect())
    assert used <= least + max(1, least // 100)


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, u in [(1, 1), (1, 10**6), (5, 5), (1000, 1000), (1000, 10**6), (200, 1 << 20)]:
        ends = np.sort(rng.integers(1, u + 1, n))
        ends[-1] = u
        ef = idstore.EliasFano.build(ends, u)
        ef = idstore.EliasFano(ef.n, ef.low_bits, ef.low, ef.high, ef.samples.tobytes())
        assert ef.select_all().tolist() == ends.tolist()
        assert [ef.select(i) for i in range(0, n, max(1, n // 97))] == ends[::max(1, n // 97)].tolist()
        assert 8 * (len(ef.low) + len(ef.high)) <= n * (2 + max(0, np.log2(u / n))) + n + 24


def check_store(rows, out):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(out, key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = Counter((d, len(ids(t or "")) + 1, zlib.crc32(np.array(ids(t or "") + [0], dtype="<u4").tobytes()))
                   for d, t in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == [d for d, _ in rows]


@pytest.mark.parametrize("segment_ids", [50, 1 << 20])
def test_id_store_edge_cases(spark, segment_ids):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, None), (3, None), (-7, "w " * 900)] * 2
    check_store(rows, idstore.encode_documents(docs_df(spark, rows), PATH, segment_ids=segment_ids).collect())
    assert idstore.encode_documents(docs_df(spark, []), PATH).count() == 0


def test_op8_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_store(rows, queries.op8_id_store(spark, sf).collect())
