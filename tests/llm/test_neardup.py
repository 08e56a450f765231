import random

from llm_helpers import docs_df, sf  # noqa: F401

from basketlab.llm import neardup, queries


def brute(rows, k, percent):
    sets = [(d, neardup.shingles(t or "", k)) for d, t in rows]
    up = {d: d for d, _ in sets if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    live = [(d, s) for d, s in sets if s and d is not None]
    for i, (d, x) in enumerate(live):
        for e, y in live[i + 1:]:
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return sorted((d, len(s), root(d), root(d) == d) if d is not None else (-1, len(s), None, True) for d, s in sets)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_least_matches():
    limits = neardup.least_matches(0.8, 16, 128, 1e-6)
    assert limits[-1][0] == 128 and all(0 <= m <= 0.8 * n for n, m in limits)
    assert neardup.least_matches(0.8, 16, 16, 0.5)[0][1] >= 13


def test_words_cut_only_at_ascii_space():
    assert neardup.words("A b\x0bÉ\x1cC d E") == ["a".encode(), b"b", "É\x1cc d e".encode()]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for base in range(12):  # chains of edits: members link over others
        text = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(8):
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    hub = [rng.choice(vocab) for _ in range(60)]
    for _ in range(60):  # a large bucket whose members differ from each other
        t = list(hub)
        for i in rng.sample(range(60), 2):
            t[i] = rng.choice(vocab)
        rows.append((len(rows) * 7 % 1009, " ".join(t)))
    rows += [(2000 + i, "One two") for i in range(5)] + [(2010, "one two"), (2011, "One two three four"),
                                                         (2012, ""), (2013, None), (2014, " \n "), (None, "One two")]
    rows += [(1500 + i, t) for i, (_, t) in enumerate(rows[:10])]
    rng.shuffle(rows)
    assert got(neardup.near_duplicates(docs_df(spark, rows), shingle=4)) == brute(rows, 4, 80)


def test_no_documents(spark):
    assert neardup.near_duplicates(docs_df(spark, [])).count() == 0


def test_op6_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.op6_near_duplicates(spark, sf)) == brute(rows, 4, 80)


def test_very_long_documents(spark):
    """Hundreds of thousands of words: a near copy, and one that is too far."""
    rng = random.Random(9)
    text = [f"w{rng.randrange(50_000)}" for _ in range(200_000)]
    near, far = list(text), list(text)
    for p in rng.sample(range(len(text)), 8_000):  # four of five shingles hold each word: 0.72 of all stay
        far[p] = "x"
    for p in rng.sample(range(len(text)), 4_000):
        near[p] = "y"
    rows = [(5, " ".join(text)), (3, " ".join(near)), (9, " ".join(far)), (1, " ".join(text[:50]))]
    assert got(neardup.near_duplicates(docs_df(spark, rows), shingle=4)) == brute(rows, 4, 80)
    linked = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs_df(spark, rows), shingle=4).collect()}
    assert linked[5] == linked[3] == 3 and linked[1] == 1


def test_components_only_after_new_links(spark, monkeypatch):
    """A round that finds no link leaves the components as they are."""
    rng, calls, found = random.Random(11), [], neardup.components
    monkeypatch.setattr(neardup, "components", lambda edges: calls.append(1) or found(edges))
    words = [[f"w{rng.randrange(10 ** 6)}" for _ in range(60)] for _ in range(6)]
    rows = [(10 * i + j, " ".join(w[:60 - j])) for i, w in enumerate(words) for j in range(3)]
    df = neardup.near_duplicates(docs_df(spark, rows))
    assert got(df) == brute(rows, 5, 80)
    assert len(calls) == 1
