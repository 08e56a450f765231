import hashlib
import itertools
import re

import numpy as np
from llm_helpers import docs_df, sf  # noqa: F401
from pyspark.sql import functions as F

from basketlab.llm import queries, secrets

ASSIGN = re.compile(r'''(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''',
                    re.ASCII | re.IGNORECASE)


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(rows, out):
    assert sorted((d is not None, d or 0, *digest(t)) for d, t in rows) == sorted(
        (r.doc_id is not None, r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t or "")
    for r in out:
        spans = [x.split(":") for x in r.spans.split(",") if x]
        kept = ",".join(":".join(x) for x in spans if x[0] != "markov")
        assert hashlib.sha256(kept.encode()).hexdigest() == r.base_sha256
        for k, s, e in spans:
            if k == "markov":
                assert any(re.fullmatch(r"[A-Za-z0-9+/_=-]{20,}", t[int(s):int(e)]) for t in texts[r.doc_id])


def digest(text):
    spans = base(text or "")
    n = [sum(k == i for _, k, _ in spans) for i in range(3)]
    return (*n, hashlib.sha256(listed(spans).encode()).hexdigest())


HEXES = "0123456789abcdef" * 3
TEXTS = ["", "nothing here", f"token = \"{HEXES}\" tail", "AKIA" + "Q7" * 9, "xAKIAAKIA1" + "Z" * 20 + " AKIA12",
         "password: abc password: abcdef", "SECRET=token:abcdef", "secret=a,api_key='x.y=z-1'APIKEY:zzzzzzz",
         "é𝕏 token=éabcdef 𝕏𝕏 passwd=abcdef " + HEXES, HEXES + HEXES, "token=\ntoken= abcdef", "a" * 23, "a" * 24,
         'token" : "ABCDEFG"', "ſecret=abcdefg toKen=abcdefg", " ".join(f"token=abcdef{i}" for i in range(300))]


def test_base_spans_and_edge_cases(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[2]), (50, None), (51, TEXTS[2]), (51, TEXTS[2]),
                                                    (52, "wörd " * 50000 + TEXTS[2])]
    df = docs_df(spark, rows)
    model = secrets.train(secrets.samples_from(df.select("doc_id", "text")))
    check(rows, secrets.digest(secrets.scan(df, model)).collect())
    empty = docs_df(spark, [])
    assert secrets.digest(secrets.scan(empty, secrets.train(secrets.samples_from(empty)))).count() == 0


def test_markov_separates_random_strings(spark):
    words = ["configuration", "repository", "authentication_service", "get_user_by_name", "internationalisation"] * 40
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(100)]
    keys += [re.sub(r"[^A-Za-z0-9]", "", str(__import__("base64").b64encode(k.encode()))) for k in keys]
    samples = spark.createDataFrame([(w, 0) for w in words] + [(k, 1) for k in keys] + [(None, 1), ("x", None)],
                                    "text string, label int")
    model = secrets.train(samples)
    held = ["get_configuration_by_name_service", hashlib.sha256(b"held").hexdigest().upper().lower()]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(held)], "i int, t string").select(
        model.score(F.col("t")).alias("s")).collect()
    assert got[0].s < 0 < got[1].s
    df = docs_df(spark, [(1, f"see the {held[0]} and zz{held[1].upper()} here")])
    spans = secrets.scan(df, model, least_ratio=0.0).collect()[0].spans
    assert all(s.kind == 3 for s in spans)


def test_redaction(spark):
    model = secrets.train(spark.createDataFrame([], "text string, label int"))
    text = f"é x token = \"{HEXES}\" y {HEXES}z"
    r = secrets.scan(docs_df(spark, [(1, text), (2, "clean")]), model).select(
        "doc_id", secrets.redact(F.col("text"), F.col("spans")).alias("t")).collect()
    assert {x.doc_id: x.t for x in r} == {1: 'é x [SECRET]" y [SECRET]z', 2: "clean"}


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op10_secret_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_op10_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, queries.op10_secret_scan(spark, sf).collect())


def test_model_reads_every_document(spark):
    """3,000 documents: the model equals plain counts over all their tokens."""
    tokens = [f"name{i}of" for i in range(3000)]
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)]
    df = spark.createDataFrame([(i, f"the {t}, {keys[i % 50]}") for i, t in enumerate(tokens)], "doc_id long, text string")
    samples = secrets.samples_from(df)
    assert sorted(r.text for r in samples.filter("label = 0").collect()) == sorted(tokens)
    n, place = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    counts = np.full((2, n, n), 0.5)
    for label, texts in ((0, tokens), (1, [keys[i % 50] for i in range(3000)])):
        for t in texts:
            for a, b in itertools.pairwise(t):
                counts[label][place[a]][place[b]] += 1
    want = np.log(counts / counts.sum(axis=2, keepdims=True))
    assert np.allclose(secrets.train(samples).ratio, (want[1] - want[0]).ravel())


def test_long_key_around_a_base_match(spark):
    """A key that holds a run of hex or an access key is reported whole; one
    that is no more than its base span is not reported again."""
    keys = [hashlib.sha256(str(i).encode()).hexdigest().upper() for i in range(200)]
    samples = spark.createDataFrame([(k, 1) for k in keys + [k.lower() for k in keys]]
                                    + [("ordinary_identifier_name", 0)] * 200, "text string, label int")
    model = secrets.train(samples)
    long = [keys[0] + HEXES[:30] + keys[1], keys[2] + "_AKIA" + keys[3][:16]]
    texts = [f"é {t} end" for t in (*long, HEXES)]
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans]
             for r in secrets.scan(docs_df(spark, list(enumerate(texts))), model).collect()}
    for i, t in enumerate(long):
        assert (3, 2, 2 + len(t)) in spans[i] and len(spans[i]) == 2
    assert spans[2] == [(2, 2, 2 + len(HEXES))]
    clean = secrets.redacted(docs_df(spark, list(enumerate(texts))), model).collect()
    assert {r.text for r in clean} == {"é [SECRET] end"}


def test_markov_spans_against_a_plain_model(spark, sf):
    """Counts, ratios and spans from the definition."""
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(9000, f"zz {HEXES[:40].upper()}QX/{HEXES[:30]} and ordinary_identifier_name_here"), (9001, "Zq9" * 12),
             (9002, "é 0b96a8c8d79c4a50_85c919698889f59b+72ab7bb6 and 72ab7bb60b96a8c8d79/c4a5085c919698889 x")]
    df = docs_df(spark, rows).select("doc_id", "text")
    model = secrets.train(secrets.samples_from(df))
    n, place = len(secrets.ALPHABET), {c: i for i, c in enumerate(secrets.ALPHABET)}
    counts = np.full((2, n, n), 0.5)

    def learn(label, token):
        for a, b in itertools.pairwise(token):
            if a in place and b in place:
                counts[label][place[a]][place[b]] += 1

    word = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
    for _, t in rows:
        for m in ASSIGN.finditer(t):
            if len(m[2]) >= 6:
                learn(1, m[2])
        for s, k, e in base(t):
            if k:
                learn(1, t[s:e])
        rest = re.sub(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", " ", ASSIGN.sub(" ", t))
        for m in re.finditer(word % 4, rest):
            learn(0, m[0])
    share = np.log(counts / counts.sum(axis=2, keepdims=True))
    ratio = share[1] - share[0]
    assert np.allclose(model.ratio, ratio.ravel())

    def markov(t):
        spans = base(t)
        for m in re.finditer(word % 20, t):
            if any(s <= m.start() and m.end() <= e for s, _, e in spans):
                continue
            gains = [round(ratio[place[a]][place[b]], 5) for a, b in itertools.pairwise(m[0])]
            if sum(gains) / (len(m[0]) - 1) >= 0.5:
                yield m.start(), 3, m.end()

    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(df, model).collect()}
    found = 0
    for d, t in rows:
        want = sorted([*base(t), *markov(t)])
        found += sum(k == 3 for _, k, _ in want)
        assert got[d] == want
    assert found


def test_long_tokens_and_many_matches_are_linear(spark):
    """A million characters in one token; a hundred thousand matches and
    tokens in one text: seconds each."""
    import time
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    image = "".join(rng.choice(letters, 1_000_000))
    many = " ".join(f"é token=abcdef{i} {'Zq9xK2' * 4}{i}" for i in range(100_000))
    samples = [(hashlib.sha256(str(i).encode()).hexdigest(), 1) for i in range(50)] + [("plain_identifier_name", 0)] * 50
    samples += [("".join(rng.choice(letters, 40)), 1) for _ in range(200)]
    model = secrets.train(spark.createDataFrame(samples, "text string, label int"))
    for text, kinds in ((image, {3: 1}), (many, {0: 100_000, 3: 100_000})):
        df = docs_df(spark, [(1, text)])
        start = time.time()
        spans = secrets.scan(df, model, least_ratio=-9.0).select("spans").first().spans
        assert time.time() - start < 30
        found = {k: sum(s.kind == k for s in spans) for k in kinds}
        assert found == kinds
        start = time.time()
        clean = secrets.redacted(df, model, least_ratio=-9.0).select("text").first().text
        assert time.time() - start < 40
        assert clean == ("[SECRET]" if text is image else " ".join(["é [SECRET] [SECRET]"] * 100_000))


def test_running_results_in_blocks(spark):
    rng = np.random.default_rng(2)
    arrays = [[], [5], *([int(x) for x in rng.integers(0, 100, n)] for n in (2, 3, 9, 10, 50, 1000))]
    df = spark.createDataFrame([(a,) for a in arrays], "a array<int>")
    rows = df.select("a", secrets.running(F.col("a"), lambda x, y: x + y).alias("s"),
                     secrets.running(F.col("a"), lambda x, y: F.greatest(x, y)).alias("m")).collect()
    for r in rows:
        assert r.s == [sum(r.a[:i]) for i in range(len(r.a))]
        assert r.m == [max(r.a[:i], default=0) for i in range(len(r.a))]
