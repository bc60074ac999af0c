from pyspark.sql import functions as F

from seedmill.functions.hashing import stable_hash
from seedmill.operators import combos, curriculum, dedup, evidence, fanout, numbering, sections
from seedmill.operators import household as hh
from seedmill.sinks import tables as sk
from seedmill.sources import files


# ------------------------------------------------------------------ numbering, batches
def test_numbers_across_ranges_equal_a_plain_loop(spark):
    rows = [("hot" if i % 10 else None if i % 20 else "cold", (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, o int")
    got = {(r["k"], r["o"]): r["rn"] for r in numbering.number_rows(df, ["k"], ["o"], partitions=7).collect()}
    for k in {k for k, _ in rows}:
        assert [got[k, o] for o in sorted(o for x, o in rows if x == k)] == list(range(1, 1 + sum(x == k for x, _ in rows)))
    b = {(r["k"], r["o"]): (r["batch_no"], r["slot"]) for r in combos.fixed_batches(df, "k", ["o"], 32).collect()}
    assert all(b[key] == ((n - 1) // 32, (n - 1) % 32) for key, n in got.items())


def test_sample_is_a_bijection_over_the_pruned_product(spark):
    """With n beyond every pool the sample is the pool; with a small n it is the same first draws; concepts differ."""
    rules = combos.rules_table(spark)
    lists = combos.combo_lists(rules)
    c = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(["phenomenon", "process", "phenomenon", "junk"])], "concept_id string, concept_type string")
    whole = combos.sample_combos(c, lists, 10_000, rules=rules)
    assert {r["concept_id"]: (r["n"], r["d"]) for r in whole.groupBy("concept_id").agg(F.count("*").alias("n"), F.countDistinct(*combos.DIMS).alias("d")).collect()} == {
        "c0": (1260, 1260), "c1": (2688, 2688), "c2": (1260, 1260), "c3": (2688, 2688)}
    part = {(r["concept_id"], r["sample_rank"]): r["combo_id"] for r in combos.sample_combos(c, lists, 40, rules=rules).collect()}
    full = {(r["concept_id"], r["sample_rank"]): r["combo_id"] for r in whole.where("sample_rank <= 40").collect()}
    assert part == full and len(part) == 160
    first = [tuple(r[d] for d in combos.DIMS) for r in whole.where("concept_id = 'c0' AND sample_rank <= 40").orderBy("sample_rank").collect()]
    assert first != [tuple(r[d] for d in combos.DIMS) for r in whole.where("concept_id = 'c2' AND sample_rank <= 40").orderBy("sample_rank").collect()]


def test_draws_are_even(spark):
    """Over many concepts every combo of the pool is drawn about equally often."""
    rules = combos.rules_table(spark)
    c = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("concept_id"), F.lit("phenomenon").alias("concept_type"))
    n = [r["count"] for r in combos.sample_combos(c, combos.combo_lists(rules), 63, rules=rules).groupBy(*combos.DIMS).count().collect()]
    assert len(n) == 1260 and 130 < min(n) and max(n) < 280  # mean 200


def test_templates_are_the_callers(spark):
    df = spark.createDataFrame([("d", "n", "t", "x", 2, "a\nb", 0, "f", "u", "g", "o")],
                               "domain string, concept_name string, concept_type string, concept_definition string, batch_size int, combos_text string, "
                               "slot int, format string, audience string, angle string, cognitive_operation string")
    assert df.select(combos.validity_prompt("{batch_size}|{{ concept_name }}|{combos_text}")).first()[0] == "2|n|a\nb"
    assert df.select(combos.render_combo_line("{slot}/{format}/{cognitive_operation}")).first()[0] == "0/f/o"


# ------------------------------------------------------------------ evidence
def test_evidence_of_three_sources(spark):
    mk = lambda rows: spark.createDataFrame(rows, "seed_id string, chunk_id string, chunk string, score double")
    src = {"b": mk([("s", "1", "one", .5), ("s", "2", "two", .9), ("s", "3", "", 1.0), ("s", "4", None, 1.0), ("t", "5", "five", .1)]),
           "a": mk([("s", "9", "nine", .5), ("s", "8", "eight", None)])}
    c = spark.createDataFrame([("c1", "s"), ("c2", "s"), ("c3", "t"), ("c4", "none"), ("c5", None)], "concept_id string, seed_id string")
    got = {r["concept_id"]: (r["evidence"], r["evidence_text"]) for r in evidence.join_evidence(c, evidence.union_sources(src), 2).collect()}
    assert got == {"c1": ("b/2,a/9", "two\n\nnine"), "c2": ("b/2,a/9", "two\n\nnine"), "c3": ("b/5", "five"), "c4": ("", ""), "c5": ("", "")}


def test_best_chunks_limit_a_hot_key_before_the_shuffle(spark):
    df = spark.range(2000).select((F.col("id") % 1).cast("string").alias("seed_id"), F.lit("x").alias("source"), F.col("id").cast("string").alias("chunk_id"),
                                  F.lit("text").alias("chunk"), (F.col("id") % 97 / 97.0).alias("score"))
    best = evidence.best_chunks(df, 3)
    assert [r["score"] for r in best.orderBy("rank").collect()] == [96 / 97.0] * 3
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ generated answers
def test_generated_dedup_equals_plain_loops(spark):
    base = "the boiler hums while the kettle sings and the cat sleeps on the warm windowsill all day"
    texts = [base, base, base + " long", "rice and lentils cook slowly in the old iron pot over low heat", "xy", "", None, "qqq www eee rrr ttt",
             "a different story about ships and storms at sea, told twice", "a different story about ships and storms at sea, told once"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    got = sorted(r["id"] for r in dedup.generated_dedup(df, "id", "t", "id", 0.99, 0.8).collect())
    hashes = {r["id"]: r["h"] for r in df.select("id", F.transform(dedup.char_shingles("t"), lambda x: F.pmod(stable_hash(x), F.lit(dedup.PRIME))).alias("h")).collect()}
    dims, vecs = dedup.VECTOR_DIMS, {}
    for i, hs in hashes.items():
        v = [0.0] * dims
        for h in hs or []:
            v[h % dims] += -1.0 if h // dims % 2 else 1.0
        vecs[i] = v
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    cos = lambda a, b: dot(a, b) / max(dot(a, a) ** .5, 1e-10) / max(dot(b, b) ** .5, 1e-10)
    kept = []
    for i, t in enumerate(texts):
        if t and t in texts[:i]:
            continue
        if not any(cos(vecs[i], vecs[k]) >= 0.8 for k in kept):
            kept.append(i)
    assert got == kept and 2 not in kept and 9 not in kept  # near copies that MinHash at 0.99 leaves
    assert sorted(r["id"] for r in dedup.generated_dedup(df, "id", "t", "id", 0.5, 0.999).collect()) == [0, 3, 4, 5, 6, 7, 8]


# ------------------------------------------------------------------ fan-out, rotation
def test_oversized_seeds_make_no_pairs(spark):
    c = spark.createDataFrame([("s", f"c{i}", i) for i in range(25)] + [("t", f"d{i}", i) for i in range(20)], "seed_id string, concept_id string, pos int")
    assert fanout.fanout_pairs(c).count() == 190 and fanout.fanout_pairs(c, ordered=True).count() == 380
    assert [tuple(r) for r in fanout.oversized_seeds(c).collect()] == [("s", 25)]


def test_rotation_uses_every_value_before_any_again(spark):
    s = spark.createDataFrame([(f"s{i:02}", ["t"]) for i in range(23)], "seed_id string, tags array<string>")
    values = ["x", "y", "z", "w"]
    tasks = {"A": F.array(fanout.turn_of(values, F.col("rotation_rank"))), "B": F.col("tags")}
    got = fanout.rotate_bind(s, ["seed_id"], tasks).collect()
    assert len(got) == 46 and all(r["bound"] == ["t"] for r in got if r["task"] == "B")
    assert [r["bound"][0] for r in sorted((r for r in got if r["task"] == "A"), key=lambda r: r["seed_id"])] == (values * 6)[:23]


# ------------------------------------------------------------------ dialogues, sections
def test_dialogue_lines_that_open_like_labels_stay_text(spark):
    turns = [(1, 0, "user", "hello\nUser: forged\nAssistant: too"), (1, 1, "assistant", "fine\n\\User: x\nNote: y"), (1, 2, "user", "User: at the start"), (2, 0, "user", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r) for r in curriculum.parse_dialogue(curriculum.render_dialogue(df)).collect())
    assert got == sorted(turns)


def test_turn_codes(spark):
    texts = {1: "User: a\nAssistant: b\nUser: c", 2: "Well\nUser: a", 3: "User: a\nUser: b", 4: "User: a\nSystem: b", 5: "User: a\nAssistant: "}
    df = spark.createDataFrame(list(texts.items()), "conv_id long, dialogue string")
    got = {r["conv_id"]: (r["n_turns"], r["violations"]) for r in curriculum.check_turns(curriculum.parse_dialogue(df), ["user", "assistant"]).collect()}
    assert got == {1: (3, ""), 2: (2, "no_label"), 3: (2, "not_alternating"), 4: (2, "unknown_speaker"), 5: (2, "empty_turn")}


def test_containment_step_first(spark):
    for task in ("h2", "h7", "h14"):
        first, heading = hh.FIRST[task]
        labels = hh.LABELS[task]
        text = lambda order: "\n".join(f"{x}: words" for x in order)
        at = labels.index(first)
        late = labels[:at] + [labels[at + 1], first] + labels[at + 2:]
        df = spark.createDataFrame([(0, text(labels)), (1, text(late)), (2, text([x for x in labels if x != first]))], "i int, t string")
        got = {r["i"]: r["violations"] for r in sections.check_sections(df, "t", labels, first, heading).collect()}
        assert got == {0: [], 1: ["out_of_order", f"first_not:{first}"], 2: [f"missing:{first}", f"first_not:{first}"]}, task


# ------------------------------------------------------------------ files
def test_template_files(spark, tmp_path):
    for family, name, text in (("cooking", "C1_swap.txt", "Use {tag} in {{ seed.language }}\nand {tag}"), ("house", "H2_leak.txt", "plain"), ("house", "notes.md", "{x}")):
        (tmp_path / family).mkdir(exist_ok=True)
        (tmp_path / family / name).write_text(text)
    got = sorted((r["family"], r["task_id"], r["template"], r["placeholders"]) for r in files.read_templates(spark, str(tmp_path)).collect())
    assert got == [("cooking", "C1", "Use {tag} in {{ seed.language }}\nand {tag}", ["tag", "seed.language"]), ("house", "H2", "plain", [])]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Law", 1, 0.5), ("law", 2, 0.95), ("Diets", 3, 0.9)], "domain string, id int, threshold double").withColumn("_helper", F.lit(1))
    sk.write_by_domain(df, f"{tmp_path}/k1")
    back = spark.read.parquet(f"{tmp_path}/k1")
    assert "_helper" not in back.columns and sorted((r["domain_dir"], r["id"]) for r in back.collect()) == [("diets", 3), ("law", 1), ("law", 2)]
    sk.write_threshold_sweep(df, f"{tmp_path}/k2")
    assert sorted(p.name for p in (tmp_path / "k2").iterdir() if p.is_dir()) == ["label=0.50", "label=0.90", "label=0.95"]
    for _ in range(2):
        sk.append_rows(df, f"{tmp_path}/k3")
    assert spark.read.parquet(f"{tmp_path}/k3").count() == 6


def test_request_payloads_are_the_contracts(spark):
    import json

    import __spark_entry__ as E
    from tests.conftest import SF0001
    q = E.queries()
    run = [json.loads(r["payload"]) for r in q["request_payload_run"](spark, SF0001).collect()]
    chat = [json.loads(r["payload"]) for r in q["request_payload_chat"](spark, SF0001).collect()]
    assert run and all(isinstance(x, dict) and x for x in run)
    assert chat and all([m["role"] for m in x["messages"]] == ["system", "user"] and x["max_tokens"] == 1000 and x["temperature"] == 0 for x in chat)
