import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import docs_df, sf  # noqa: F401

from basketlab.llm import alignment, queries


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(*alignment.default_paths())


def spans(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True)) if ends else []


def brute_links(sizes_a, sizes_b):
    """All pairs of tokens whose byte ranges overlap."""
    return [(i, j) for i, (s, e) in enumerate(spans(sizes_a)) for j, (t, f) in enumerate(spans(sizes_b))
            if max(s, t) < min(e, f)]


def brute_groups(sizes_a, sizes_b):
    """Group of each A and each B token, cut where both end."""
    cuts = sorted({e for _, e in spans(sizes_a)} & {e for _, e in spans(sizes_b)})
    return [[sum(c < e for c in cuts) for _, e in spans(x)] for x in (sizes_a, sizes_b)]


def partitions(total, draw):
    cuts = draw(st.sets(st.integers(1, total - 1), max_size=total - 1)) if total > 1 else set()
    at = [0, *sorted(cuts), total]
    return [b - a for a, b in zip(at, at[1:], strict=False)]


@given(st.data(), st.integers(1, 40), st.integers(1, 90))
@settings(max_examples=300, deadline=None)
def test_pieces_of_any_size_give_all_links_and_groups(data, total, piece):
    a, b = partitions(total, data.draw), partitions(total, data.draw)
    link_a, link_b, group_a, group_b = alignment.merged(np.cumsum(a), np.cumsum(b), piece)
    assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == brute_links(a, b)
    assert [group_a.tolist(), group_b.tolist()] == brute_groups(a, b)


@given(st.lists(st.integers(0, 30), max_size=40), st.lists(st.integers(0, 30), max_size=40))
@settings(max_examples=200, deadline=None)
def test_diagonals_cut_the_merge(a, b):
    a, b = np.array(sorted(set(a)), dtype=np.int64), np.array(sorted(set(b)), dtype=np.int64)
    order = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    d = np.arange(len(order) + 1)
    if not len(order):
        return
    i, j = alignment.merge_path(a, b, d)
    assert i.tolist() == [sum(s == 0 for _, s in order[:k]) for k in d]
    assert j.tolist() == [sum(s == 1 for _, s in order[:k]) for k in d]


TEXTS = [
    (1, "The cat sat on the mat."), (2, "The cat sat on the mat."), (3, "naïve coöperation — 東京 🙂🙂 été\n\n  two"),
    (4, ""), (5, None), (6, " leading and trailing "), (7, "a <s> b </s> <|endoftext|> <unk> <0x41>"),
    (8, "a▁b the mat"), (9, "word " * 3000 + "end"), (10, "\t\r\n  ​"), (None, "The cat"),
    (11, "x" * 5000), (12, "nul \x00 byte"), (12, "repeated id"), (13, " "), (14, "I've 3.14 don't\tstop")]


def brute(rows, tok):
    """Everything from the definitions, token by token."""
    per, counts = [], Counter()
    for doc, text in rows:
        a, b = [], []
        if text:
            a = tok.a.tok.encode(" " + text, add_special_tokens=False).ids
            b = tok.b.encode(text)
            data = (" " + text).encode()
            if b"".join(tok.bytes_a[i] for i in a) != data or b"".join(tok.bytes_b[i] for i in b) != data:
                a, b = [], []
        sizes = [[len(tok.bytes_a[i]) for i in a], [len(tok.bytes_b[i]) for i in b]]
        # Overlaps by a walk over the bytes, for long texts.
        owner = [[k for k, n in enumerate(x) for _ in range(n)] for x in sizes]
        links = sorted(set(zip(*owner, strict=True)))
        groups = brute_groups(*sizes) if len(a) < 400 else None
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(set(pairs))
        per.append((doc, a, b, groups, pairs, links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for doc, a, b, groups, pairs, links in per:
        if groups is None:
            groups = alignment_groups(a, b, links)
        n = max(groups[0], default=-1) + 1
        text = ";".join(",".join(str(x) for x, g in zip(a, groups[0], strict=True) if g == k) + "|"
                        + ",".join(str(x) for x, g in zip(b, groups[1], strict=True) if g == k) for k in range(n)) \
            if n < 400 else fast_text(a, b, groups)
        out.append((doc, len(a), len(b), n, len(pairs), sum(counts[p] == highest[p[0]] for p in pairs),
                    sum(counts[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest() if n else ""))
    return sorted(out, key=str)


def alignment_groups(a, b, links):
    """Groups as the connected runs of links (for long texts)."""
    of_a, of_b, group = {}, {}, -1
    for i, j in links:
        if i not in of_a and j not in of_b:
            group += 1
        of_a.setdefault(i, group)
        of_b.setdefault(j, group)
    return [[of_a[i] for i in range(len(a))], [of_b[j] for j in range(len(b))]]


def fast_text(a, b, groups):
    parts = {}
    for side, ids in ((0, a), (1, b)):
        for x, g in zip(ids, groups[side], strict=True):
            parts.setdefault(g, ([], []))[side].append(str(x))
    return ";".join(",".join(x) + "|" + ",".join(y) for _, (x, y) in sorted(parts.items()))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


@pytest.mark.parametrize("block_chars", [1, 60, 1_000_000])
def test_edges_against_brute_force(spark, tok, block_chars):
    want = brute(TEXTS, tok)
    assert got(alignment.aligned(docs_df(spark, TEXTS), block_chars=block_chars)) == want
    zero = {r[0] for r in want if not r[1]}
    assert {4, 5, 8} <= zero and 1 not in zero and 9 not in zero


@given(st.text(alphabet=st.sampled_from("ab 's1½é\n\t\x1c　,.\xa0Ż▁<0x4>ﬁ"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_whole_texts_ids(text):
    tok = alignment.tokenizers(*alignment.default_paths())
    want = tok._whole(text) if text else (b"", b"")
    assert tuple(x.astype("<u4").tobytes() for x in tok.encode(text)) == want


def test_strings_of_special_tokens_are_text(tok):
    a, b = tok.encode("a <|endoftext|> <s>")
    assert 50256 not in a and 1 not in b and len(a) and len(b)


def test_empty_table_and_clashing_columns(spark):
    assert alignment.aligned(docs_df(spark, [])).count() == 0
    df = docs_df(spark, [(1, "one text")]).selectExpr("*", "1 as block", "2 as pair", "3 as n_a", "4 as links")
    row = alignment.aligned(df).first()
    assert (row.doc_id, row.n_groups > 0, len(row.groups_sha256)) == (1, True, 64)


def test_op11_whole_table(spark, sf, tok):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.op11_token_alignment(spark, sf)) == brute(rows, tok)
