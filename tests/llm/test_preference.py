import duckdb
import pandas as pd
import pytest
from llm_helpers import sf  # noqa: F401
from oracle_check import digest

from basketlab.llm import preference, queries

SCHEMA = "pair_id long, side string, turn long, role string, text string, n int, prompt string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA)


def one(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_pairs(spark):
    rows = []
    for side, answer in (("chosen", "yes 𝕏"), ("rejected", "no")):
        rows += [(1, side, 0, "system", "é"), (1, side, 1, "user", "a <|im_end|> b"), (1, side, 2, "assistant", "ok"),
                 (1, side, 3, "user", None), (1, side, 4, "assistant", answer)]
        rows += [(2, side, 0, "user", "same"), (2, side, 1, "assistant", "same")]
    rows += [(1, "chosen", 5, "user", "more"), (1, "chosen", 6, "assistant", "end"), (3, "chosen", 0, "assistant", "x"),
             (4, "rejected", None, None, "x"), (None, "chosen", 0, "user", "x"), (5, "other", 0, "user", "x"),
             (6, "chosen", 0, "user", "q"), (6, "chosen", 0, "user", "q"), (6, "rejected", 0, "user", "q")]
    out = {r.pair_id: r for r in preference.pairs(turns(spark, rows)).collect()}
    assert sorted(out) == [1, 2, 3, 4, 6]
    r = out[1]
    assert r.n_prompt_turns == 4
    assert r.prompt == one("system", "é") + one("user", "a < |im_end|> b") + one("assistant", "ok") + one("user", "")
    assert r.chosen == one("assistant", "yes 𝕏") + one("user", "more") + one("assistant", "end")
    assert [r.chosen[s.start:s.end] for s in r.chosen_mask] == ["yes 𝕏<|im_end|>", "end<|im_end|>"]
    assert [r.rejected[s.start:s.end] for s in r.rejected_mask] == ["no<|im_end|>"]
    assert (out[2].n_prompt_turns, out[2].chosen, out[2].rejected) == (2, "", "")
    assert (out[3].prompt, out[3].chosen, out[3].rejected) == ("", one("assistant", "x"), "")
    assert (out[4].chosen, out[4].rejected, out[4].rejected_mask) == ("", one("", "x"), [])
    assert (out[6].n_prompt_turns, out[6].chosen, out[6].rejected) == (1, one("user", "q"), "")
    assert preference.pairs(turns(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op2_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    df = queries.op2_preference_pairs(spark, d)
    got = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    assert digest(got) == digest(con.execute(queries.ORACLE["op2_preference_pairs"]).df())
    assert (got.n_prompt_turns > 0).any()


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op2_preference_pairs(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_conversations(spark):
    """Twenty thousand turns a side, and a turn of a million characters."""
    import time
    roles = ("user", "assistant")
    schema = "pair_id long, side string, turn long, role string, text string"
    df = spark.range(40_000).selectExpr(
        "1L AS pair_id", "IF(id % 2 = 0, 'chosen', 'rejected') AS side", "id div 2 AS turn",
        "IF(id div 2 % 2 = 0, 'user', 'assistant') AS role", "IF(id < 20000, 'same', concat('é', id)) AS text")
    big = spark.createDataFrame([(2, s, t, roles[t], ("x" * 1_000_000) + s if t else "q") for s in ("chosen", "rejected")
                                 for t in (0, 1)], schema)
    start = time.time()
    out = {r.pair_id: r for r in preference.pairs(df.unionByName(big)).collect()}
    assert time.time() - start < 60
    r = out[1]
    assert r.n_prompt_turns == 10_000 and r.prompt == "".join(one(roles[t % 2], "same") for t in range(10_000))
    assert len(r.chosen_mask) == len(r.rejected_mask) == 5_000
    assert all(r.chosen[m.start:m.end] == f"é{2 * (10_001 + 2 * i)}<|im_end|>" for i, m in enumerate(r.chosen_mask))
    assert out[2].n_prompt_turns == 1 and [out[2].chosen[m.start:m.end] for m in out[2].chosen_mask] == [
        "x" * 1_000_000 + "chosen<|im_end|>"]
