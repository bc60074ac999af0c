import hashlib

from pyspark.sql import functions as F

from seedmill.functions.hashing import stable_hash
from seedmill.functions.jsonparse import parse_strict
from seedmill.functions.text import (drop_quality_flag, has_quality_flag, is_reject, or_default,
                                     py_strip, strip_code_fence, tag_or_default, word_count)
from seedmill.functions.vocab import LOW_QUALITY_PREFIX, REJECT_MARKER

DDL = "struct<domain:string,concepts:array<struct<name:string>>>"


def test_strict_json_kinds(spark):
    rows = [('{"domain":"x","concepts":[{"name":"a"}]}', True, None),
            ('{"domain":"x","concepts":[{"name":"a"', False, "invalid_json"),
            (None, False, "null_input"), ("  ", False, "empty"),
            ('{"domain":"x"} trailing prose', False, "invalid_json"),
            ("{'domain':'x'}", False, "invalid_json"),
            ('{"domain":"x"},{"domain":"y"}', False, "invalid_json"),
            ('{"domain": NaN}', False, "invalid_json"),
            ('{"concepts":"not a list"}', False, "invalid_json")]
    df = spark.createDataFrame([(r[0],) for r in rows], "j string")
    got = df.select(parse_strict("j", DDL).alias("p")).collect()
    for (text, ok, err), g in zip(rows, got):
        assert (g.p.ok, g.p.error) == (ok, err), text


def test_fence_and_strip(spark):
    df = spark.createDataFrame([("```json\n{\"a\":1}\n```",), ("```\n[1]",), ("  plain \t\n",),
                                ("```json\n{\"json\": \"json\"}\n```",)], "t string")
    got = [r[0] for r in df.select(strip_code_fence("t")).collect()]
    assert got == ['{"a":1}', "[1]", "plain", '{"json": "json"}']
    s = spark.createDataFrame([("  x y 　\n",)], "t string").select(py_strip("t")).first()[0]
    assert s == "  x y 　\n".strip()


def test_markers_defaults_words(spark):
    df = spark.createDataFrame([(f"  {REJECT_MARKER} ", None, []), (f"{LOW_QUALITY_PREFIX} body text", "", ["a"]),
                                ("one two  three", "v", ["a", "b"])], "t string, v string, tags array<string>")
    r = df.select(is_reject("t").alias("rej"), has_quality_flag("t").alias("lq"),
                  drop_quality_flag("t").alias("body"), or_default("v", "d").alias("v"),
                  tag_or_default("tags", 1, "none").alias("t1"), word_count("t").alias("w")).collect()
    assert [x.rej for x in r] == [True, False, False]
    assert [x.lq for x in r] == [False, True, False]
    assert r[1].body == "body text"
    assert [x.v for x in r] == ["d", "d", "v"]
    assert [x.t1 for x in r] == ["none", "none", "b"]
    assert r[2].w == 3


def test_stable_hash_matches_python(spark):
    df = spark.createDataFrame([("a", 1), ("é", 22), (None, 3)], "s string, n int")
    got = [r[0] for r in df.select(stable_hash("s", "n")).collect()]
    exp = [int(hashlib.md5(f"{s or ''}|{n}".encode()).hexdigest()[:15], 16) for s, n in [("a", 1), ("é", 22), (None, 3)]]
    assert got == exp


def test_concept_files_of_both_layouts_in_one_folder(spark, tmp_path):
    from seedmill.sources.files import read_concepts
    (tmp_path / "six.csv").write_text('run_id,seed_id,domain,concept_name,concept_type,concept_definition\nr1,s1,d,n1,Type,"a ""b"",\nc"\n')
    (tmp_path / "five.csv").write_text('run_id,seed_id,domain,concept_name,concept_definition\nr2,s2,d,n2,plain\n')
    got = {r.run_id: (r.concept_type, r.concept_definition) for r in read_concepts(spark, str(tmp_path)).collect()}
    assert got == {"r1": ("Type", 'a "b",\nc'), "r2": (None, "plain")}
