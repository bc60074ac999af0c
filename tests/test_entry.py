from tests.conftest import SF0001


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"batch_id", "model", "prompt"} <= set(df.columns)


def test_registry_has_oracles(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    missing = sorted(set(q) - set(o))
    # rows-only queries are the JSON payload renderers and other non-SQL outputs
    assert all(m.startswith(("request_payload", "sink_", "stream_", "scan_templates", "dedup_generated",
                             "validity_agreement", "op", "pipeline")) for m in missing), missing


def test_queries_run_small(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["scan_seed_ids", "explode_concepts", "v_concepts", "dedup_exact", "fixed_batches"]:
        assert q[name](spark, SF0001).count() > 0, name
