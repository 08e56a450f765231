from conftest import D, raw_df

from basketlab.session import scratch_path
from basketlab.sources.versioned import VersionedTable
from basketlab.streaming import start_refresh_stream


def line(inv, cust, qty, day):
    return (inv, "A1", "x", qty, day, 1.0, float(cust), "UK")


def test_stream_builds_then_refreshes(spark):
    root = scratch_path(spark, "t-stream")
    landing, cur, tab, ck = (f"{root}/landing", f"{root}/curated", f"{root}/table", f"{root}/ck")
    raw_df(spark, [line("a", 1, 1, D(2020, 1, 1)), line("b", 2, 2, D(2020, 1, 1))]) \
        .write.mode("append").parquet(landing)
    q = start_refresh_stream(spark, landing, cur, tab, ck, at="2024-01-01", key="hash")
    q.awaitTermination()
    vt = VersionedTable(spark, tab)
    assert vt.read().count() == 2
    raw_df(spark, [line("c", 2, 5, D(2020, 1, 2))]).write.mode("append").parquet(landing)
    q = start_refresh_stream(spark, landing, cur, tab, ck, at="2024-01-02", key="hash")
    q.awaitTermination()
    t = vt.read()
    assert t.count() == 3
    rows = t.where("CustomerID = 2").collect()
    assert len(rows) == 2 and {str(r["timestamp"]) for r in rows} == {"2024-01-02 00:00:00"}
    assert max(r["qty_products"] for r in rows) == 2


def test_replayed_batch_is_applied_once(spark):
    """A batch handed to the sink again (as after a failure before the stream
    checkpoint was written) changes neither the curated rows nor the table."""
    from basketlab.operators.clean import Rules
    from basketlab.schemas import RAW
    from basketlab.sources import tables
    from basketlab.streaming.refresh import _process, applied_batch

    root = scratch_path(spark, "t-replay")
    cur, tab = f"{root}/curated", f"{root}/table"
    fn = _process(spark, cur, tab, "2024-01-01", "hash", "append", Rules())
    b0 = raw_df(spark, [line("a", 1, 1, D(2020, 1, 1)), line("b", 2, 2, D(2020, 1, 1))])
    b1 = raw_df(spark, [line("c", 2, 5, D(2020, 1, 2))])
    fn(b0, 0)
    fn(b1, 1)
    vt = VersionedTable(spark, tab)
    v, n_cur, n_tab = vt.current_version(), tables.read_table(spark, cur, RAW).count(), vt.read().count()
    assert applied_batch(vt) == 1 and (n_cur, n_tab) == (3, 3)
    fn(b1, 1)                       # replay of the last batch
    fn(b0, 0)                       # replay of an older batch
    assert vt.current_version() == v
    assert tables.read_table(spark, cur, RAW).count() == n_cur
    assert vt.read().count() == n_tab


def test_uncommitted_version_is_never_read(spark):
    root = scratch_path(spark, "t-uncommitted")
    vt = VersionedTable(spark, root)
    df1 = raw_df(spark, [line("a", 1, 1, D(2020, 1, 1))])
    assert vt.write(df1, note="batch=0") == 1
    # a version folder whose job died before its commit marker
    raw_df(spark, [line("x", 9, 9, D(2020, 1, 9))] * 3).write.parquet(vt.path(2))
    assert vt.current_version() == 1 and vt.read().count() == 1
    assert vt.current_note() == "batch=0"
    assert vt.write(df1, mode="append") == 3      # skips the broken folder
    assert vt.read().count() == 2 and vt.current_note() is None


def test_table_exists_only_after_a_committed_version(spark):
    from basketlab.sources import tables
    root = scratch_path(spark, "t-exists")
    vt = VersionedTable(spark, root)
    assert not tables.table_exists(spark, root)
    raw_df(spark, [line("x", 9, 9, D(2020, 1, 9))]).write.parquet(vt.path(1))   # no marker
    assert not tables.table_exists(spark, root)
    vt.write(raw_df(spark, [line("a", 1, 1, D(2020, 1, 1))]))
    assert tables.table_exists(spark, root) and vt.current_version() == 2


def test_rows_of_tomorrow_are_used_tomorrow(spark):
    root = scratch_path(spark, "t-tomorrow")
    landing, cur, tab, ck = (f"{root}/landing", f"{root}/curated", f"{root}/table", f"{root}/ck")

    def day(rows, as_of):
        raw_df(spark, rows).write.mode("append").parquet(landing)
        start_refresh_stream(spark, landing, cur, tab, ck, at=as_of, key="hash", as_of=as_of).awaitTermination()
        return {r.CustomerID: r.qty_products for r in VersionedTable(spark, tab).read().orderBy("qty_products").collect()}

    assert day([line("a", 1, 1, D(2020, 1, 1)), line("b", 2, 1, D(2020, 1, 1)), line("c", 2, 1, D(2020, 1, 2))],
               "2020-01-01") == {1: 1, 2: 1}
    assert day([line("d", 1, 1, D(2020, 1, 2))], "2020-01-02") == {1: 2, 2: 2}
