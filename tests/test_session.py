import os

from weirflow import session


def test_scratch_files_go_at_the_end_unless_they_are_kept(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    place = lambda name: session.scratch_path(spark, name)
    gone = place("gone")
    spark.range(3).write.parquet(gone)
    spark.conf.set(session.KEEP_SCRATCH, "true")
    try:
        kept = place("kept")
    finally:
        spark.conf.unset(session.KEEP_SCRATCH)
    spark.range(3).write.parquet(kept)
    assert spark.read.parquet(gone).count() == spark.read.parquet(kept).count() == 3
    assert [p for _, p in session._scratch] == [gone]
    session.clear_scratch()
    local = lambda path: os.path.exists(path.removeprefix("file:"))
    assert not local(gone) and local(kept) and session._scratch == []


def test_stored_tables_can_be_read_again(spark):
    table = session.stored(spark.range(5), "numbers")
    assert table.count() == 5 and "numbers-" in table.inputFiles()[0]
