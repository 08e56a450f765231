from collections import Counter, defaultdict

import corpus_pipeline as p
import pytest

from basketlab.llm import contamination, neardup

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of each stage, as rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in p.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, before, docs.collect(), docs.columns))
    return {name: x for name, *x in out}


def test_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [s for s, _ in p.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for name in [s for s, _ in p.STAGES][:-1]:
        assert stages[name][2] == columns


def test_quality_keeps_good_and_drops_bad(spark, stages):
    before, after, _ = stages["quality"]
    kept = {r.doc_id for r in after}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)
    assert {r.doc_id: r for r in before if r.doc_id in kept} == {r.doc_id: r for r in after}


def test_one_of_each_group_stays(stages):
    before, after, _ = stages["near_duplicates"]
    kept = {r.doc_id for r in after}
    sets = {r.doc_id: neardup.shingles(r.text, 5) for r in before}
    link = defaultdict(set)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                link[a].add(b)
                link[b].add(a)
    left, want = set(ids), set()
    while left:
        todo, group = [min(left)], set()
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += link[x]
        want.add(min(group))
        left -= group
    assert kept == want


def test_benchmark_passages_go(spark, stages):
    before, after, _ = stages["decontamination"]
    items = [contamination.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    padded = {r.doc_id: f" {' '.join(contamination.words(r.text))} " for r in before}
    whole = {d for d, t in padded.items() if any(f" {' '.join(w)} " in t for w in items if len(w) >= 4)}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert whole <= gone and len(gone) < 0.05 * len(before)


def test_secrets_are_replaced(stages):
    before, after, _ = stages["secrets"]
    now = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    changed = [r for r in before if now[r.doc_id].text != r.text]
    assert changed and all("[SECRET]" in now[r.doc_id].text for r in changed) and len(changed) < 0.1 * len(before)
    assert all(r.n_chars == len(r.text) for r in after)
    assert not any("token = \"" in r.text for r in after)


def test_packing_holds_every_document(stages):
    before, after, _ = stages["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    used = Counter()
    for r in after:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "x", "en", "s", 1), (None, "x", "en", "s", 1), (2, "", "en", "s", 0),
            (3, "same words in this short text here", "en", "s", 34), (3, "same words in this short text here", "en", "s", 34)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for _, stage in p.STAGES[:-1]:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() <= len(table)
        assert p.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_clashing_column_names(spark):
    """Extra columns that are named like the operators' own come through."""
    extra = ["benchmark_matches", "kept_id", "kept", "component_id", "score", "difference", "density", "row", "spans", "base"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    docs = docs.selectExpr("*", *[f"concat('{c}', doc_id) AS {c}" for c in extra])
    before = {r.doc_id: r for r in docs.collect()}
    out = docs
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, out, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c}{r.doc_id}" == before[r.doc_id][c] for c in extra)
