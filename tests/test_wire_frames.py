from weirflow.plans.queries import QUERIES


def test_ids_beyond_four_bytes_keep_their_low_bytes(spark, tmp_path):
    rows = [(3, 1499, "click"), (4, 65535, "view"), (8, 65536, "view"), (13, 65782, "click")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: (r.wire_kind, r.schema_id, r.body) for r in QUERIES["wire_header"](spark, str(tmp_path)).collect()}
    assert got == {i: ("framed", user * 65537 % 2**32, kind) for i, user, kind in rows}
