from tests.conftest import SF0001


def test_stream_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    cols = ["batch_id", "slot", "outcome", "is_valid"]
    s = q["stream_ingest"](spark, SF0001).select(*cols)
    b = q["join_verdict_align"](spark, SF0001).select(*cols)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0


def test_resume_append_adds_nothing_twice(spark):
    import __spark_entry__ as E
    rows = {r.run: r.added for r in E.queries()["sink_resume_append"](spark, SF0001).collect()}
    assert rows[1] > 0 and rows[2] == 0


def test_stream_dedup_keeps_one_per_request(spark):
    import __spark_entry__ as E
    d = E.queries()["stream_dedup_keys"](spark, SF0001)
    assert d.count() == d.select("request_id").distinct().count()


def test_stream_progress_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    key = lambda df: sorted((str(r.window_start), r.event_type, r.n) for r in df.collect())
    assert key(q["stream_progress"](spark, SF0001)) == key(q["stream_progress_batch"](spark, SF0001))
