"""Threads kept up to date batch by batch equal the batch jobs over all rows."""

import random

import pytest

from threadlens.operators.threads import assign_levels, thread_context
from threadlens.streaming.threads import ThreadTables, apply_batch, current, stream_threads

SCHEMA = "n long, comment_id string, parent_comment_id string, parent_comment string, comment string, platform string"


def forest(seed, n=70):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        up = None if k < 4 else f"c{r.randrange(k)}" if r.random() < .8 else "gone"
        if 50 <= k < 53:
            up = f"c{50 + (k - 49) % 3}"                     # a cycle, with replies below it
        if k == 60:
            up = "c60"                                       # its own parent
        text = r.choice(["One", "two.", "three!", "", "[deleted]", None])
        rows.append((k, f"c{k}", up, r.choice([None, "", "raw text", "[deleted]"]), text, "A"))
    rows += [(200 + k, f"c{k}", f"c{k - 1}" if k else None, "raw", f"of B {k}", "B") for k in range(9)]  # same ids elsewhere
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def batch_job(spark, rows):
    out = thread_context(assign_levels(frame(spark, rows)), order_col="n")
    return sorted((r.n, r.level, r.unreachable, r.level and r.parent_comment, r.comment_after_coref) for r in out.collect())


def held(spark, tables):
    return sorted((r.n, r.level, r.unreachable, r.level and r.parent_comment, r.comment_after_coref)
                  for r in current(spark, tables).collect())


def tables_at(spark, path, buckets=8):
    t = ThreadTables(str(path), frame(spark, []).schema, buckets)
    t.create(spark)
    return t


@pytest.mark.parametrize("arrival", ["shuffled", "replies first"])
def test_batches_equal_the_batch_job(spark, tmp_path, arrival):
    rows = forest(3)
    order = sorted(rows, key=lambda r: -r[0])
    if arrival == "shuffled":
        random.Random(1).shuffle(order)
    tables = tables_at(spark, tmp_path)
    for epoch in range(3):
        part = order[epoch::3] if arrival == "shuffled" else order[epoch * 27:epoch * 27 + 27]
        report = apply_batch(frame(spark, part), tables, epoch, ["n"])
        assert report.fresh == len(part) <= report.affected
        if epoch == 1:                                       # run again, as after a lost driver
            assert apply_batch(frame(spark, part), tables, epoch, ["n"]) == report
        if epoch == 0:
            assert held(spark, tables) == batch_job(spark, part)
    assert held(spark, tables) == batch_job(spark, rows)


def test_only_affected_threads_are_touched(spark, tmp_path):
    """Two hundred threads lie stored; one gets a reply, a late parent moves another."""
    rows = [(k, f"t{k}", None, None, "root", "A") for k in range(200)]
    rows += [(1000 + k, f"r{k}", f"t{k}", None, "reply", "A") for k in range(200)]
    rows += [(2000, "x1", "late", "raw", "under a late parent", "A"), (2001, "x2", "x1", None, "deeper", "A")]
    tables = tables_at(spark, tmp_path, buckets=64)
    apply_batch(frame(spark, rows), tables, 0, ["n"])
    one = apply_batch(frame(spark, [(3000, "r7a", "r7", None, "again", "A")]), tables, 1, ["n"])
    assert (one.fresh, one.affected) == (1, 1) and one.edge_buckets == 1 and one.row_buckets <= 2
    late = apply_batch(frame(spark, [(3001, "late", "t5", None, "the late one", "A")]), tables, 2, ["n"])
    assert (late.fresh, late.affected) == (1, 3) and late.edge_buckets == 1 and late.row_buckets <= 4
    levels = {r.comment_id: r.level for r in current(spark, tables).collect()}
    assert [levels[x] for x in ("r7a", "late", "x1", "x2", "t9", "r9")] == [3, 2, 3, 4, 1, 2]
    plan = tables.read(spark, "rows", 3, [5])._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "_bucket" in pruned and "epoch" in pruned         # folders of other buckets are not opened


def test_first_arrival_is_kept(spark, tmp_path):
    tables = tables_at(spark, tmp_path)
    apply_batch(frame(spark, [(2, "a", None, None, "second row", "A"), (1, "a", None, None, "first", "A"),
                              (3, None, "a", None, "no id", "A")]), tables, 0, ["n"])
    again = apply_batch(frame(spark, [(0, "a", "b", None, "later", "A")]), tables, 1, ["n"])
    assert again.fresh == again.affected == 0
    assert [(r.n, r.comment, r.level) for r in current(spark, tables).collect()] == [(1, "first", 1)]
    assert apply_batch(frame(spark, []), tables, 2, ["n"]).fresh == 0


def test_stream_of_files(spark, tmp_path):
    rows = forest(9, 40)
    tables = ThreadTables(str(tmp_path / "t"), frame(spark, []).schema, 8)
    reports = []
    for k in range(2):
        frame(spark, rows[1 - k::2]).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        stream_threads(spark, str(tmp_path / "landing"), tables, str(tmp_path / "ck"), ["n"], reports=reports).awaitTermination()
    assert [r.fresh for r in reports] == [len(rows[1::2]), len(rows[0::2])]
    assert held(spark, tables) == batch_job(spark, rows)
