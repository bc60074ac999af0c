from pyspark.sql import functions as F

from seedmill.functions import vocab
from seedmill.operators import combos as cmb
from seedmill.operators import fanout as fo
from seedmill.operators import verdicts as vd

DIMS = vocab.DIMENSIONS


def _tables(spark):
    slots = [(i, 100 + i) for i in range(3)]
    req = spark.createDataFrame([(f"b{i}", f"c{i % 3}", slots) for i in range(8)] + [("one", "c9", [(0, 77)])],
                                "batch_id string, concept_id string, slots array<struct<slot:int,number:int>>")
    item = lambda i, ok, key="is_valid": f'{{"id": "{i}", "{key}": {ok}, "reason": "r"}}'
    texts = {"b0": f"[{item(0, 'true')}, {item(1, 'false')}, {item(2, 'true')}]", "b1": f"[{item(2, 'true')}, {item(0, 'true')}]", "b2": "[{\"id\":",
             "b3": f"```json\n[{item(0, 'true', 'valid')}, {item(9, 'true')}, {item(0, 'false')}, {item('x', 'true')}]\n```", "b4": '[{"id": "1"}]',
             "b5": f"[{item(1, 'false')}]", "b6": "[]", "one": '{"is_valid": true}'}
    return req, vd.parse_answers(spark.createDataFrame(list(texts.items()), "request_id string, content string"))


def test_valid_slots_are_those_of_the_listed_rows(spark):
    req, parsed = _tables(spark)
    exp = sorted((r["batch_id"], r["number"]) for r in vd.valid_only(vd.align(req, parsed)).collect())
    rows = vd.valid_slots(req, parsed, "number").collect()
    assert sorted((r["batch_id"], n) for r in rows for n in r["slots"]) == exp and len(exp) == 6
    assert len(rows) == len({r["batch_id"] for r in rows})


def test_numbers_list_the_values_of_the_slots(spark):
    rules = cmb.rules_table(spark)
    lists = cmb.combo_lists(rules)
    c = spark.createDataFrame([("c1", vocab.CONCEPT_TYPES[0]), ("c2", "other")], "concept_id string, concept_type string")
    b = cmb.drawn_batches(cmb.draw_combos(c, lists, 25, rules=rules))
    full = cmb.collect_batches(b, lists=lists).select("concept_id", F.explode("slots").alias("s")).select("concept_id", *[f"s.{d}" for d in DIMS])
    nums = cmb.collect_batches(b, slot_cols=("number",), lists=lists, values=False)
    assert nums.schema["slots"].dataType.elementType.fieldNames() == ["slot", "number"]
    nums = nums.select("concept_id", "concept_type", F.transform("slots", lambda s: s["number"]).alias("n"))
    got = cmb.listed_combos(nums, "n", lists, rules).select("concept_id", *DIMS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect())) and got.count() == 50


def test_descriptions_never_shuffle_the_combos(spark):
    values = vocab.BUNDLES["medicine"]
    combos = spark.createDataFrame([tuple(values[d][i] for d in DIMS) for i in (0, 1)], ", ".join(f"{d} string" for d in DIMS))
    table = spark.createDataFrame([(d, v, f"{d} {v}") for d in DIMS for v in values[d]], "dim string, value string, description string")
    joined = fo.join_descriptions(combos, table)
    assert {r["format_description"] for r in joined.collect()} == {f"format {values['format'][i]}" for i in (0, 1)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = fo.join_descriptions(combos, table)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == len(DIMS)
