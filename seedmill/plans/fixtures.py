"""Test inputs derived from the given tables by fixed key rules.

Every rule here is also written, independently, as DuckDB SQL in
``oracle/fixtures.py`` so both engines see the same rows. All builders are
plain DataFrame plans: they scale with ``documents`` / ``part`` and shuffle only
where a join or grouping needs it.

Let d = ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedmill.functions import vocab
from seedmill.functions.hashing import stable_hash
from seedmill.functions.text import py_strip
from seedmill.operators import combos as cmb

DIMS = vocab.DIMENSIONS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, idx: Column) -> Column:
    """``values[idx]`` for a 0-based integer column (fixed literal list)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _range_of(domain: Column) -> Column:
    m = F.create_map(*[x for d, r in vocab.DOMAIN_RANGES for x in (F.lit(d), F.lit(r))])
    return F.element_at(m, domain)


# ----------------------------------------------------------------- seeds / runs
def seeds(spark, sf_dir) -> DataFrame:
    """fx_seeds: one seed per document."""
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        d.cast("string").alias("seed_id"),
        _pick(vocab.DOMAINS, d % 10).alias("domain"),
        F.col("text"),
        F.col("lang").alias("language"),
        F.when(d % 4 == 0, F.array().cast("array<string>"))
         .when(d % 4 == 1, F.array(F.col("source")))
         .otherwise(F.array(F.col("source"), F.col("lang"))).alias("tags"),
        F.when(d % 3 == 0, F.lit(None).cast("string"))
         .when(d % 3 == 1, F.lit("")).otherwise(F.col("text")).alias("ground_truth"),
        d.alias("doc_id"),
    )


def seed_lines(spark, sf_dir) -> DataFrame:
    """fx_seed_lines: a seed-id text file as lines: padded ids and blank lines."""
    d = F.col("doc_id")
    ids = d.cast("string")
    line = (F.when(d % 3 == 0, F.concat(F.lit("  "), ids, F.lit("\t")))
            .when(d % 3 == 1, F.concat(ids, F.lit(" "))).otherwise(ids))
    lines = F.when(d % 5 == 0, F.array(line, F.lit("   "))).otherwise(F.array(line))
    return table(spark, sf_dir, "documents").select(F.explode(lines).alias("value"))


def run_calls(spark, sf_dir) -> DataFrame:
    """fx_run_calls: the answers of the run service (create, then start)."""
    s = seeds(spark, sf_dir)
    d = F.col("doc_id")
    return s.select(
        "seed_id", "domain", "doc_id",
        F.when(d % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.md5(F.concat(F.lit("run|"), d.cast("string")))).alias("created_run_id"),
        (d % 10 != 1).alias("start_ok"),
        F.format_string("2024-01-01T%02d:%02d:00", (d % 24).cast("int"), (d % 60).cast("int")).alias("timestamp"),
    )


def ledger(spark, sf_dir) -> DataFrame:
    """fx_ledger: the run ledger as its CSV holds it (all strings, padded statuses)."""
    d = F.col("doc_id")
    rc = run_calls(spark, sf_dir)
    status = (F.when(d % 10 == 0, F.lit(vocab.STATUS_FAILED_CREATE))
              .when(d % 10 == 1, F.lit(vocab.STATUS_FAILED_START))
              .when(d % 7 == 0, F.lit("  STARTED "))
              .otherwise(F.lit(vocab.STATUS_STARTED)))
    return rc.select(
        F.coalesce("created_run_id", F.lit(vocab.NO_RUN_ID)).alias("run_id"),
        "seed_id", "domain", _range_of(F.col("domain")).alias("target_concepts_range"),
        status.alias("status"), "timestamp", "doc_id")


def concepts(spark, sf_dir) -> DataFrame:
    """fx_concepts: d % 6 concepts per STARTED run (what a clean draft would hold).

    A seed's whole text is split evenly over its concepts' definitions; nothing of it is left out."""
    n_part = table(spark, sf_dir, "part").agg(F.count(F.lit(1))).first()[0]
    d = F.col("doc_id")
    s = seeds(spark, sf_dir).filter(~(d % 10).isin(0, 1))
    share = py_strip(F.expr("substring(text, int(length(text) * pos div (doc_id % 6)) + 1, "
                            "int(length(text) * (pos + 1) div (doc_id % 6)) - int(length(text) * pos div (doc_id % 6)))"))
    # the share is cut before the join: a concept travels with it alone, not with the whole text of its seed
    exploded = (s.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("pos"))
                .filter(F.col("pos") < d % 6)
                .select("seed_id", "domain", "doc_id", "pos", share.alias("concept_definition"),
                        ((d * 7 + F.col("pos")) % n_part).cast("bigint").alias("_pk")))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_pk"), "p_name")
    j = exploded.join(part, "_pk")
    return j.select(
        F.md5(F.concat(F.lit("run|"), d.cast("string"))).alias("run_id"),
        "seed_id", "domain",
        F.col("p_name").alias("concept_name"),
        _pick(vocab.CONCEPT_TYPES, (d + F.col("pos")) % 7).alias("concept_type"),
        "concept_definition",
        F.md5(F.concat_ws("|", "seed_id", F.col("pos").cast("string"))).alias("concept_id"),
        F.col("pos").cast("int").alias("pos"), "doc_id")


# ---------------------------------------------------------------------- drafts
DRAFT_DDL = ("struct<domain:string,summary:string,"
             "concepts:array<struct<name:string,definition:string,type:string>>>")


def drafts(spark, sf_dir) -> DataFrame:
    """fx_drafts: the stored draft of every STARTED run, with planted faults.

    First match wins: d%43 no row at all, d%17 truncated, d%19 empty, d%23 NULL,
    d%29 no drafts, d%31 prose after the JSON, d%37 single quotes, d%13 code
    fence (must parse), d%41 no ``domain`` key. Independently of those:
    d%29 has an empty drafts list, the answer's domain is upper-cased,
    d%47 gives the first concept the type 'Other', d%53 an empty summary.
    """
    d = F.col("doc_id")
    started = ledger(spark, sf_dir).filter(F.trim("status") == vocab.STATUS_STARTED)
    c = concepts(spark, sf_dir)
    per_run = (c.groupBy("run_id")
               .agg(F.array_sort(F.collect_list(F.struct(
                   "pos", F.col("concept_name").alias("name"),
                   F.col("concept_definition").alias("definition"),
                   F.col("concept_type").alias("type")))).alias("cs")))
    j = started.join(per_run, "run_id", "left")
    cs = F.transform(F.coalesce("cs", F.array_repeat(F.lit(None), 0).cast(
        "array<struct<pos:int,name:string,definition:string,type:string>>")),
        lambda x: F.struct(x["name"].alias("name"), x["definition"].alias("definition"),
                           F.when((d % 47 == 0) & (x["pos"] == 0), F.lit("Other"))
                            .otherwise(x["type"]).alias("type")))
    summary = F.when(d % 53 == 0, F.lit("")).otherwise(
        F.concat(F.lit("Concepts found in seed "), F.col("seed_id")))
    full = F.to_json(F.struct(F.upper("domain").alias("domain"), summary.alias("summary"), cs.alias("concepts")))
    nodom = F.to_json(F.struct(summary.alias("summary"), cs.alias("concepts")))
    resp = (F.when(d % 17 == 0, F.substring(full, 1, (F.length(full) / 2).cast("int")))
            .when(d % 19 == 0, F.lit(""))
            .when(d % 23 == 0, F.lit(None).cast("string"))
            .when(d % 31 == 0, F.concat(full, F.lit("\nHope this helps!")))
            .when(d % 37 == 0, F.translate(full, '"', "'"))
            .when(d % 13 == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
            .when(d % 41 == 0, nodom)
            .otherwise(full))
    one = F.array(F.struct(F.struct(resp.alias("candidate_response")).alias("teacher_output")))
    empty = F.array().cast("array<struct<teacher_output:struct<candidate_response:string>>>")
    return (j.filter(d % 43 != 0)
            .select("run_id", F.when(d % 29 == 0, empty).otherwise(one).alias("drafts")))


# ------------------------------------------------------------ validity answers
CONCEPT_COLUMNS = ("run_id", "seed_id", "domain", "concept_name", "concept_type", "concept_definition")


def drawn_combos(spark, sf_dir, n: int = vocab.SAMPLES_PER_CONCEPT, keep: tuple = ()) -> DataFrame:
    """The sample as one row per concept (combo numbers in rank order), with the concept's columns to ``keep``."""
    rules = cmb.rules_table(spark)
    return cmb.draw_combos(concepts(spark, sf_dir), cmb.combo_lists(rules), n, rules=rules, keep=keep)


def sampled_combos(spark, sf_dir, n: int = vocab.SAMPLES_PER_CONCEPT, narrow: bool = False) -> DataFrame:
    rules = cmb.rules_table(spark)
    return cmb.sample_combos(concepts(spark, sf_dir), cmb.combo_lists(rules), n, rules=rules, keep=() if narrow else CONCEPT_COLUMNS)


def descriptions(spark, sf_dir) -> DataFrame:
    """fx_descriptions: (dim, value, description); the description names the part whose key is the value's running number."""
    values = [(d, v, i) for i, (d, v) in enumerate((d, v) for d in DIMS for v in vocab.BUNDLES["medicine"][d])]
    t = spark.createDataFrame(values, "dim string, value string, p_partkey long")
    return t.join(table(spark, sf_dir, "part"), "p_partkey").select("dim", "value", F.concat_ws(", ", "p_name", F.lower("p_type")).alias("description"))


def validity_done(spark, sf_dir) -> DataFrame:
    """fx_validity_done: earlier output for resume, as its CSV holds it.

    Slots with h(combo_id) % 3 = 0 were answered; of those, h(combo_id) % 5 = 0
    left a blank ``is_valid`` (a partial write that must be redone).
    """
    s = sampled_combos(spark, sf_dir)
    hc = stable_hash("combo_id")
    valid = F.pmod(F.col("combo_id"), F.lit(100)) < 40  # the combo's id is that hash of concept and dims
    return (s.filter(F.pmod(hc, F.lit(3)) == 0)
            .select("run_id", "seed_id", "domain", "concept_name", "concept_type",
                    "concept_definition", *DIMS,
                    F.when(F.pmod(hc, F.lit(5)) == 0, F.lit(""))
                     .otherwise(F.when(valid, F.lit("True")).otherwise(F.lit("False"))).alias("is_valid"),
                    F.lit("earlier run").alias("reason"), "concept_id"))


def validity_batches(spark, sf_dir) -> DataFrame:
    """The micro-batches of a fresh run (no resume), one row per slot."""
    return cmb.batches_from_rank(sampled_combos(spark, sf_dir, narrow=True))


def stored_batches(spark, sf_dir) -> DataFrame:
    """The same micro-batches, one row each with its combo numbers, laid out by batch id like the request and answer tables of a run."""
    docs = table(spark, sf_dir, "documents").count()
    parts = cmb.batch_partitions(spark, docs * 2 * vocab.SAMPLES_PER_CONCEPT // vocab.BATCH_SIZE)
    return cmb.drawn_batches(drawn_combos(spark, sf_dir)).drop("rule_type").repartition(parts, "batch_id")


def verdict_answers(spark, sf_dir, batches: DataFrame | None = None) -> DataFrame:
    """fx_verdicts: the model's answer text per batch, with planted faults.

    is_valid = h(concept_id, dims) % 100 < 40. Fault = h(batch_id) % 50:
    0 last slot missing, 1 answers in reverse order, 2 key ``valid``,
    3 no ``reason``, 4 unparsable (truncated), 5 an extra id; d % 11 = 0 wraps
    the answer in a code fence. Given the ``stored_batches`` that the requests are read from, both share one exchange.
    """
    rules = cmb.rules_table(spark)
    b = cmb.with_lists(stored_batches(spark, sf_dir) if batches is None else batches, cmb.combo_lists(rules), rules)
    valid = lambda x: F.pmod(stable_hash("concept_id", *cmb.combo_values(x)), F.lit(100)) < 40
    f = F.pmod(stable_hash("batch_id"), F.lit(50))
    # an item is written as text at once, in the form that to_json gives it: nothing in it needs escaping
    item = lambda x, i: F.concat(F.lit('{"id":"'), i.cast("string"), F.when(F.col("_f") == 2, F.lit('","valid":')).otherwise(F.lit('","is_valid":')),
                                 valid(x).cast("string"), F.when(F.col("_f") == 3, F.lit("}")).otherwise(
                                     F.concat(F.lit(',"reason":"reason for '), i.cast("string"), F.lit('"}'))))
    g = b.withColumn("_f", f).select("batch_id", "_f", F.transform("combos", item).alias("xs"), (F.size("combos") - 1).alias("_last"))
    items = F.col("xs")
    f = F.col("_f")
    extra = F.concat(F.lit('{"id":"'), (F.col("_last") + 1).cast("string"), F.lit('","is_valid":true,"reason":"extra"}'))
    items = (F.when(f == 0, F.slice(items, 1, F.col("_last")))
             .when(f == 1, F.reverse(items))
             .when(f == 5, F.concat(items, F.array(extra)))
             .otherwise(items))
    text = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    text = F.when(f == 4, F.substring(text, 1, 25)).otherwise(text)
    fenced = F.pmod(stable_hash("batch_id", F.lit("fence")), F.lit(11)) == 0
    text = F.when(fenced, F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(text)
    return g.select(F.col("batch_id").alias("request_id"), text.alias("content"))


# ------------------------------------------------------------------ dedup inputs
def dedup_concepts(spark, sf_dir) -> DataFrame:
    """fx_dd: concepts with the P1 dedup text and the keep order key
    (seed_id, run_id, pos as one sortable string; keep-first is per domain)."""
    from seedmill.functions.text import dedup_text
    c = concepts(spark, sf_dir)
    return c.select("concept_id", "run_id", "seed_id", "domain", "concept_name", "concept_type",
                    "concept_definition", "pos",
                    dedup_text().alias("dedup_text"),
                    F.concat_ws("\u0001", "seed_id", "run_id", F.lpad(F.col("pos").cast("string"), 5, "0"))
                    .alias("order_key"))


def planted_vectors(spark, sf_dir) -> DataFrame:
    """fx_vec_planted: the embeddings plus, for vec_id % 5 = 0, a copy with id
    1000000 + vec_id whose element (vec_id % 64) gets + 0.2 * (1 + vec_id % 3)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bump = F.lit(0.2) * (1 + F.col("vec_id") % 3)
    # the bumped embedding is computed before the id changes (a lambda in the
    # same select would resolve ``vec_id`` to the new alias)
    copies = (e.filter(F.col("vec_id") % 5 == 0)
              .withColumn("embedding", F.transform("embedding", lambda x, i: F.when(
                  i == F.col("vec_id") % 64, x + bump).otherwise(x)))
              .withColumn("vec_id", F.lit(1000000) + F.col("vec_id")))
    return e.unionByName(copies)


# ------------------------------------------------------------------ gates, rotation
def stage_verdicts(spark, sf_dir) -> DataFrame:
    """fx_stage_verdicts: five stages per STARTED run; passed = h(run_id, stage) % 100 < 85;
    when h(run_id) % 40 = 0 the stage at index h(run_id) % 5 gave no verdict."""
    from seedmill.sources.files import started_runs
    r = started_runs(ledger(spark, sf_dir)).select("run_id")
    st = F.posexplode(F.array(*[F.lit(s) for s in vocab.GATE_STAGES]))
    e = r.select("run_id", st.alias("si", "stage"))
    hr = stable_hash("run_id")
    missing = (F.pmod(hr, F.lit(40)) == 0) & (F.col("si") == F.pmod(hr, F.lit(5)))
    return (e.filter(~missing)
            .withColumn("passed", F.pmod(stable_hash("run_id", "stage"), F.lit(100)) < 85)
            .select("run_id", "stage", "passed"))


def festivals_by_region(spark, sf_dir) -> DataFrame:
    """Region-keyed vocabulary: region = nation name; values = the distinct part
    brands of parts with p_partkey % 25 = n_nationkey."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 25).alias("n_nationkey"), "p_brand")
    return n.join(p, "n_nationkey").select("region", F.col("p_brand").alias("value")).distinct()


def rotation_document(spark, sf_dir) -> DataFrame:
    """A rotation document (one JSON text) built from nation/region/part by a
    single global aggregation over a union of tagged rows (no joins)."""
    f = festivals_by_region(spark, sf_dir).groupBy("region").agg(F.array_sort(F.collect_list("value")).alias("v"))
    none_arr = F.lit(None).cast("array<string>")
    u = (table(spark, sf_dir, "nation").select(F.lit("n").alias("kind"), F.col("n_nationkey").cast("long").alias("k"),
                                               F.col("n_name").alias("s"), none_arr.alias("arr"))
         .unionByName(table(spark, sf_dir, "region").select(F.lit("r").alias("kind"), F.col("r_regionkey").cast("long").alias("k"),
                                                            F.col("r_name").alias("s"), none_arr.alias("arr")))
         .unionByName(f.select(F.lit("f").alias("kind"), F.lit(0).cast("long").alias("k"),
                               F.col("region").alias("s"), F.col("v").alias("arr"))))

    def ordered(kind):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("k", "s")))),
                           lambda x: x["s"])
    doc = u.agg(ordered("n").alias("regions"), ordered("r").alias("audiences"),
                F.map_from_entries(F.collect_list(F.when(F.col("kind") == "f", F.struct("s", "arr"))))
                .alias("festivals_by_region"))
    return doc.select(F.to_json(F.struct(
        F.struct("regions", "audiences").alias("global_variables"),
        F.struct("festivals_by_region").alias("regional_variables"))).alias("value"))


# ------------------------------------------------------------------ curriculum
def chapters(spark, sf_dir) -> DataFrame:
    """fx_curriculum chapters: topic = customer, chapters = its orders by key, with planted faults: customers of key % 5 = 1
    repeat chapter 1's name as chapter 2, % 7 = 2 call the last chapter 'Introduction', % 9 = 3 number it n+1."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    k = F.col("o_custkey")
    own = F.concat(F.lit("Order "), F.col("o_orderkey"))
    c = table(spark, sf_dir, "orders").select("o_custkey", F.row_number().over(w).alias("c"), F.count(F.lit(1)).over(Window.partitionBy("o_custkey")).alias("n"),
                                              own.alias("own"), F.first(own).over(w).alias("first_name"))
    last = F.col("c") == F.col("n")
    name = (F.when((k % 5 == 1) & (F.col("c") == 2), F.col("first_name")).when((k % 7 == 2) & last, F.lit("Introduction")).otherwise(F.col("own")))
    cid = F.when((k % 9 == 3) & last, F.col("c") + 1).otherwise(F.col("c"))
    return c.select(F.concat(F.lit("book "), k).alias("topic"), cid.cast("int").alias("chapter"), name.alias("name"))


def chapters_json(spark, sf_dir) -> DataFrame:
    c = chapters(spark, sf_dir)
    return c.groupBy("topic").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.col("chapter").cast("string"), F.col("name"))))).alias("chapters_json"))


# ------------------------------------------------------------------ evidence, task answers
def evidence_chunks(spark, sf_dir, size: int = 200) -> DataFrame:
    """fx_evidence: every document cut into consecutive 200-character chunks (whole text);
    score = h(chunk_id) % 1000 / 1000."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.greatest(F.ceil(F.length("text") / size), F.lit(1)).cast("int")
    e = d.select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    cid = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("k").cast("string"))
    return e.select(F.col("doc_id").cast("string").alias("seed_id"), cid.alias("chunk_id"),
                    F.substring("text", F.col("k") * size + 1, size).alias("chunk"),
                    (F.pmod(stable_hash(cid), F.lit(1000)) / 1000.0).alias("score"))


def evidence_sources(spark, sf_dir) -> dict[str, DataFrame]:
    """fx_sources: a seed's ground truth (score 0.995), its text's chunks, and the page of the same key (its address; score by hash)."""
    truth = seeds(spark, sf_dir).select("seed_id", F.lit("truth").alias("chunk_id"), F.col("ground_truth").alias("chunk"), F.lit(0.995).alias("score"))
    pid = F.col("page_id").cast("string")
    web = table(spark, sf_dir, "pages").select(pid.alias("seed_id"), F.concat(F.lit("page "), pid).alias("chunk_id"), F.col("url").alias("chunk"),
                                               (F.pmod(stable_hash(F.concat(F.lit("page "), pid)), F.lit(1000)) / 1000.0).alias("score"))
    return {"seed": truth, "retrieved": evidence_chunks(spark, sf_dir).select("seed_id", "chunk_id", "chunk", "score"), "web": web}


def rotation_lists(spark, sf_dir) -> dict:
    """Rotation vocabularies from the given tables: sorted distinct values, a few dozen at most (part types, segments, nations, languages)."""
    def column(name, col, order=None):
        t = table(spark, sf_dir, name).select(col, *([order] if order else [])).where(F.col(col).isNotNull()).distinct().orderBy(order or col)
        return [r[0] for r in t.collect()]
    return {"dietary": column("part", "p_type"), "audiences": column("customer", "c_mktsegment"), "regions": column("nation", "n_name", "n_nationkey"),
            "languages": column("documents", "lang")}


def regional_values(spark, sf_dir) -> DataFrame:
    """(region, festivals, methods): arrays of the distinct brands and types of the parts whose key % 25 is the nation's, sorted."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") % 25).alias("n_nationkey"), "p_brand", "p_type")
    return n.join(p, "n_nationkey").groupBy("region").agg(F.array_sort(F.collect_set("p_brand")).alias("festivals"), F.array_sort(F.collect_set("p_type")).alias("methods"))


def task_answers(spark, sf_dir) -> DataFrame:
    """fx_task_responses: d%43 the reject marker, d%47 the low-quality prefix before a JSON body, d%5 prose
    around JSON, else a bare JSON object; the body's answer is the document's whole text."""
    d = F.col("doc_id")
    body = F.to_json(F.struct(d.cast("string").alias("seed"), F.col("text").alias("answer")))
    txt = (F.when(d % 43 == 0, F.lit(vocab.REJECT_MARKER))
           .when(d % 47 == 0, F.concat(F.lit(vocab.LOW_QUALITY_PREFIX + "\n"), body))
           .when(d % 5 == 0, F.concat(F.lit("Here you go: "), body))
           .otherwise(body))
    return table(spark, sf_dir, "documents").select(d.cast("string").alias("seed_id"), txt.alias("answer"))


SECTION_LABELS = ["Diagnosis", "Steps", "Safety"]


def section_answers(spark, sf_dir) -> DataFrame:
    """fx_sections: a three-section answer per conversation turn (body = its text);
    conv_id % 7 = 1 drops 'Steps', = 2 swaps Steps and Safety, = 3 repeats Safety."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("b"))
    k = F.col("conv_id") % 7
    nl = F.lit("\n")

    def sec(lab):
        return F.concat(F.lit(lab + ":"), nl, F.col("b"))
    d, s, f = sec("Diagnosis"), sec("Steps"), sec("Safety")
    txt = (F.when(k == 1, F.concat_ws("\n", d, f))
           .when(k == 2, F.concat_ws("\n", d, f, s))
           .when(k == 3, F.concat_ws("\n", d, s, f, f))
           .otherwise(F.concat_ws("\n", d, s, f)))
    return c.select("conv_id", "turn", txt.alias("answer"))


# ------------------------------------------------------------------ task answers (contracts)
#: planted code per task: key rule k = d % (n + 1), 0 = conforming, k = the k-th code
PLANTED = {
    "scenarios": ["too_few", "too_many", "repeated", "empty_item", "too_long"],
    "c1_substitution": ["no_substitutions", "empty_field", "original_not_in_seed"],
    "c2_diagnosis": ["empty_diagnosis", "empty_scientific_reason", "empty_rescue_fix", "empty_prevention_tip"],
    "c3_workflow": ["no_prep", "bad_prep", "bad_step_type", "bad_time", "bad_numbering", "empty_step"],
    "c4_pairing": ["no_notes", "missing_side_dish", "missing_grain_bread"],
    "c5_scaling": ["empty_calculation", "wrong_multiplier", "unflagged_identity", "bad_adjustment", "empty_list"],
    "c6_scraps": ["no_scraps", "empty_mini_recipe", "empty_transformation", "same_dish"],
    "c7_dialogue": ["empty_persona", "bad_speaker", "empty_text", "no_error", "no_correction", "bad_ending"],
    "c8_faq": ["too_few_items", "too_many_items", "missing_storage", "missing_equipment", "missing_scaling", "empty_item"],
    "c9_narrative": ["empty_context", "empty_narrative", "missing_sense", "numbered_list", "table"],
    "c10_translation": ["empty_source", "wrong_target", "empty_translation", "lost_term", "unflagged_same"],
    "c11_tradition": ["empty_tradition", "too_few_markers", "no_techniques", "empty_note"],
    "c12_festive": ["festival_mismatch", "empty_anchor", "dish_count", "empty_dish", "missing_note", "no_serving_order"],
    "c13_preservation": ["method_mismatch", "empty_science", "bad_adjustment", "missing_storage_field", "empty_warning"],
    "c14_nutrition": ["too_few_ingredients", "empty_field", "incomplete_ayurvedic", "empty_assessment"],
}


def contract_answers(spark, sf_dir, task: str) -> DataFrame:
    """fx_task_responses: per document one answer in the task's format, its long text field the
    document's whole text; every code of the task is planted on its share of the documents."""
    codes = PLANTED[task]
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("seed_id"), F.col("text").alias("seed_text"))
    d, k, text = F.col("doc_id"), F.col("doc_id") % (len(codes) + 1), F.col("seed_text")
    lit = F.lit

    def on(code, bad, good):
        return F.when(k == codes.index(code) + 1, bad).otherwise(good)

    def words(*xs):
        return F.array(*[lit(x) for x in xs])

    none = F.array().cast("array<string>")
    more = {}
    flag = lit(False)
    if task == "scenarios":
        n = on("too_few", lit(6), on("too_many", lit(14), lit(9)))
        ans = F.transform(F.sequence(lit(1), n), lambda i: F.when(
            i == 2, on("repeated", lit("Scenario 1 "), on("empty_item", lit(" "), on("too_long", lit("One. Two! Three?"), lit("A cook waits. The pot boils over.")))))
            .when(i == 3, F.concat(lit("scenario 3 "), F.translate(text, ".!?\u3002\uff01\uff1f\u0964", ",,,,,,,")))
            .otherwise(F.concat(lit("scenario "), i.cast("string"))))
    elif task == "c1_substitution":
        word = F.lower(F.regexp_extract("seed_text", r"(\p{L}{3,})", 1))
        word = F.when(word == "", F.lower(text)).otherwise(word)
        one = F.struct(on("original_not_in_seed", lit("zzqx"), word).alias("original_ingredient"), on("empty_field", lit(""), lit("other")).alias("substitute"),
                       text.alias("reasoning"), lit("bake longer").alias("technique_adjustment"))
        ans = F.struct(on("no_substitutions", F.filter(F.array(one), lambda x: lit(False)), F.array(one)).alias("substitutions"))
    elif task == "c2_diagnosis":
        ans = F.struct(*[on(f"empty_{f}", lit(" "), F.concat(lit(f + " "), text)).alias(f) for f in ["diagnosis", "scientific_reason", "rescue_fix", "prevention_tip"]])
    elif task == "c3_workflow":
        prep = F.array(F.struct(lit("chop").alias("task"), on("bad_prep", lit(0.0), lit(4.0)).alias("time_min")))
        steps = F.array(*[F.struct(
            (on("bad_numbering", lit(5), lit(i)) if i == 2 else lit(i)).alias("step"),
            (on("empty_step", lit(""), text) if i == 1 else lit(f"do step {i}")).alias("description"),
            (on("bad_time", lit(0.0), lit(15.0)) if i == 3 else lit(5.0 * i)).alias("time_min"),
            (on("bad_step_type", lit("waiting"), lit("active")) if i == 1 else lit("passive")).alias("type"), lit("none").alias("parallel_opportunity")) for i in (1, 2, 3)])
        ans = F.struct(on("no_prep", F.filter(prep, lambda x: lit(False)), prep).alias("mise_en_place"), steps.alias("action_timeline"))
    elif task == "c4_pairing":
        dish = lambda code, name: F.struct(lit(name).alias("name"), text.alias("reasoning_hop_1"), on(code, lit(""), lit("acid cuts fat")).alias("reasoning_hop_2"))
        ans = F.struct(F.struct(on("no_notes", none, words("smoky", "sour")).alias("dominant_notes")).alias("flavor_profile"),
                       F.struct(dish("missing_side_dish", "raita").alias("side_dish"), dish("missing_grain_bread", "naan").alias("grain_bread")).alias("recommendations"))
    elif task == "c5_scaling":
        frm = (d % 4 + 2).cast("double")
        to = on("unflagged_identity", frm, frm * (d % 3 + 1))
        flag = (to == frm) & (k != codes.index("unflagged_identity") + 1)
        adj = F.array(F.struct(lit("salt").alias("ingredient"), on("bad_adjustment", lit(""), lit("1 tsp")).alias("adjusted_amount"), text.alias("reasoning")))
        # a wrong value stays away from 1, which would be a second fault
        ans = F.struct(on("empty_calculation", lit(""), lit("target / current")).alias("multiplier_calculation"),
                       on("wrong_multiplier", to / frm + 0.5, to / frm).alias("multiplier_value"), adj.alias("non_linear_adjustments"),
                       on("empty_list", none, words("rice")).alias("adjusted_ingredient_list"))
        more = {"scale_from": frm, "scale_to": to}
    elif task == "c6_scraps":
        ans = F.struct(on("no_scraps", none, words("peel", "stem")).alias("scraps_identified"),
                       F.struct(lit("peel chips").alias("name"), on("empty_mini_recipe", lit(""), text).alias("method")).alias("scrap_mini_recipe"),
                       F.struct(on("same_dish", lit("Peel Chips "), lit("stock")).alias("name"), on("empty_transformation", lit(""), lit("simmer")).alias("method"))
                       .alias("leftover_transformation"))
    elif task == "c7_dialogue":
        turn = lambda who, said, error=None, fix=None, got=None: F.struct(
            who.alias("speaker"), said.alias("text"), *[(lit(x).cast("string") if x is None or isinstance(x, str) else x).alias(n)
                                                        for n, x in (("error_made", error), ("correction", fix), ("demonstrated_understanding", got))])
        turns = F.array(turn(lit("novice"), text), turn(on("bad_speaker", lit("teacher"), lit("expert")), on("empty_text", lit(""), lit("Low heat."))),
                        turn(lit("novice"), lit("So I boil it?"), error=on("no_error", lit(None).cast("string"), lit("boils it"))),
                        turn(lit("expert"), lit("No, simmer."), fix=on("no_correction", lit(""), lit("simmer instead"))),
                        turn(lit("novice"), lit("I simmer it."), got=on("bad_ending", lit(""), lit("says simmer"))))
        ans = F.struct(on("empty_persona", lit(""), lit("plain words")).alias("novice_persona_match"), turns.alias("conversation"))
    elif task == "c8_faq":
        six = ["storage", "equipment", "scaling", "timing", "serving", "taste"]
        cats = words(*six)
        for c in six[:3]:
            cats = on(f"missing_{c}", words(*[x for x in six if x != c]), cats)
        cats = on("too_few_items", words(*six[:4]), on("too_many_items", words(*six, "cost", "origin"), cats))
        ans = F.struct(F.transform(cats, lambda c: F.struct(c.alias("category"), F.concat(lit("How about "), c).alias("question"),
                                                            F.when(c == "timing", on("empty_item", lit(" "), text)).otherwise(c).alias("answer"))).alias("recipe_faq"))
    elif task == "c9_narrative":
        told = on("empty_narrative", lit(""), on("numbered_list", F.concat(text, lit("\n1. Heat oil\n2. Add seeds")),
                                                  on("table", F.concat(text, lit("\n| oil | seeds |")), text)))
        ans = F.struct(on("empty_context", lit(""), lit("coastal")).alias("cultural_context_applied"), told.alias("narrative_text"),
                       F.struct(*[(on("missing_sense", lit(""), lit(s)) if s == "texture" else lit(s)).alias(s) for s in ["smell", "texture", "color", "sound", "taste"]])
                       .alias("sensory_elements"))
    elif task == "c10_translation":
        req = F.element_at(words("fr", "de", "es", "hi"), (d % 4 + 1).cast("int"))
        docs = docs.withColumn("seed_text", F.concat("seed_text", lit(" Tadka on a tawa.")))
        kept = F.concat(text, lit(" Tadka, tawa."))
        ans = F.struct(on("empty_source", lit(""), on("unflagged_same", req, lit("en"))).alias("source_language"),
                       on("wrong_target", lit("it"), F.upper(req)).alias("target_language"),
                       on("empty_translation", lit(" "), on("lost_term", F.replace(kept, lit("Tadka"), lit("Seasoning")), kept)).alias("translated_recipe"))
        ans = F.struct(*[ans[c].alias(c) for c in ["source_language", "target_language", "translated_recipe"]])
        more = {"requested": req}
    elif task == "c11_tradition":
        ans = F.struct(on("empty_tradition", lit("  "), text).alias("identified_tradition"),
                       on("too_few_markers", words("Mustard seed", "mustard seed ", ""), words("mustard seed", "curry leaf")).alias("evidence_markers"),
                       on("no_techniques", none, words("tempering")).alias("signature_techniques"), on("empty_note", lit(""), lit("none")).alias("ambiguity_note"))
    elif task == "c12_festive":
        tag = F.concat(lit("festival-"), (d % 5).cast("string"))
        plan = F.transform(F.sequence(lit(1), on("dish_count", lit(6), lit(4))), lambda i: F.struct(
            F.when(i == 2, on("empty_dish", lit(""), lit("dal"))).otherwise(F.concat(lit("dish "), i.cast("string"))).alias("dish"),
            F.when(i == 1, on("missing_note", lit(""), text)).otherwise(lit("fits")).alias("cultural_note")))
        ans = F.struct(on("festival_mismatch", lit("another"), F.upper(tag)).alias("festival"), on("empty_anchor", lit(""), lit("rice")).alias("anchor_dish"),
                       plan.alias("thali_meal_plan"), on("no_serving_order", none, words("starter", "main")).alias("serving_order"))
        more = {"bound_tag": tag}
    elif task == "c13_preservation":
        tag = F.concat(lit("method-"), (d % 3).cast("string"))
        adj = F.array(F.struct(lit("salt").alias("original"), on("bad_adjustment", lit(""), lit("more salt")).alias("adjusted"), lit("osmosis").alias("reasoning")))
        ans = F.struct(on("method_mismatch", lit("other"), tag).alias("preservation_method"), on("empty_science", lit(""), text).alias("science_explanation"),
                       adj.alias("ingredient_adjustments"),
                       F.struct(on("missing_storage_field", lit(""), lit("cool")).alias("temperature"), lit("jar").alias("container_type"), lit("2 weeks").alias("max_duration"))
                       .alias("storage_details"), on("empty_warning", lit(" "), lit("keep sealed")).alias("safety_warning"))
        more = {"bound_tag": tag}
    elif task == "c14_nutrition":
        one = d % 7 == 3  # a flagged answer may have one ingredient
        flag = one & (k != codes.index("too_few_ingredients") + 1)
        n = F.when(flag, lit(1)).otherwise(on("too_few_ingredients", lit(1), lit(3)))
        items = F.transform(F.sequence(lit(1), n), lambda i: F.struct(
            F.concat(lit("ingredient "), i.cast("string")).alias("ingredient"), text.alias("macronutrient_role"),
            F.when(i == 1, on("empty_field", lit(""), lit("iron"))).otherwise(lit("zinc")).alias("micronutrient_highlight"),
            F.struct(lit("vata").alias("dosha"), F.when(i == 1, on("incomplete_ayurvedic", lit(None).cast("string"), lit("sweet"))).otherwise(lit("sour")).alias("rasa"),
                     lit("heavy").alias("guna")).alias("ayurvedic"), lit("fits").alias("dietary_suitability")))
        ans = F.struct(items.alias("ingredient_analysis"), on("empty_assessment", lit(""), lit("balanced")).alias("overall_assessment"))
    else:
        raise KeyError(task)
    js = F.to_json(ans)
    fenced = F.when(d % 2 == 0, F.concat(lit("```json\n"), js, lit("\n```"))).otherwise(js)
    js = F.when(flag, F.concat(lit(vocab.LOW_QUALITY_PREFIX + "\n"), fenced)).otherwise(js)
    return docs.select("seed_id", "seed_text", *[c.alias(n) for n, c in more.items()], js.alias("answer"))


def double_routed_verdicts(spark, sf_dir) -> DataFrame:
    """fx_double: batches with h(batch_id) % 10 = 0 were sent to both models.
    model_a says h(concept_id, dims) % 100 < 40; model_b flips that when
    h(concept_id, dims, 'b') % 7 = 0. Long form: one row per combo and model."""
    b = validity_batches(spark, sf_dir).filter(F.pmod(stable_hash("batch_id"), F.lit(10)) == 0)
    b = cmb.attach_concepts(b, concepts(spark, sf_dir), cols=("concept_type",))
    va = F.pmod(stable_hash("concept_id", *DIMS), F.lit(100)) < 40
    flip = F.pmod(stable_hash("concept_id", *DIMS, F.lit("b")), F.lit(7)) == 0
    m = F.explode(F.array(F.struct(F.lit("model_a").alias("model"), va.alias("is_valid")),
                          F.struct(F.lit("model_b").alias("model"), (va != flip).alias("is_valid"))))
    return b.select("concept_id", *DIMS, "concept_type", m.alias("x")).select(
        "concept_id", *DIMS, "concept_type", "x.model", "x.is_valid")


# ------------------------------------------------------------------ household answers
#: planted codes per task: key rule k = d % (n + 1), 0 = conforming, k = the k-th code
HOUSEHOLD_PLANTED = {
    "h5": ["no_task:Weekly", "missing_system:hvac", "untagged_item", "out_of_order"], "h6": ["empty:Discretionary", "reserve_percent"],
    "h7": ["missing_number:101", "prevention_count", "missing:Hazard", "late_containment"], "h12": ["uncosted_item", "missing:Mould / Pest Note"],
    "h13": ["missing_sign:sound", "not_numbered", "too_few_never", "missing_number:1906"], "h14": ["too_few_myths", "no_call", "late_containment"],
    "h16": ["item_count", "missing_inaction"], "h17": ["over_budget", "no_cost", "no_logic"], "h18": ["bad_level", "age_mismatch", "no_boundary"],
    "h20": ["no_hard_stop", "bad_final"], "h10": ["bad_opening", "bad_closing", "unknown_speaker"], "h19": ["bad_closing", "principles"],
    **{t: ["missing", "duplicate", "out_of_order"] for t in ("h1", "h2", "h3", "h4", "h8", "h9", "h11", "h15")},
}


def household_answers(spark, sf_dir, task: str) -> DataFrame:
    """fx_household: per document one answer in the task's labels, the document's whole text (on one line) as the body
    of a section; every code of HOUSEHOLD_PLANTED is planted on its share."""
    from seedmill.operators.household import LABELS
    codes = HOUSEHOLD_PLANTED[task]
    k = F.col("doc_id") % (len(codes) + 1)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("_line"))
    text = F.col("_line")

    def on(code, bad, good):
        return F.when(k == codes.index(code) + 1, bad).otherwise(good) if code in codes else good

    def lit(x):
        return F.lit(x) if isinstance(x, str) else x

    def listed(*xs, mark="- "):
        return F.concat_ws("\n", F.lit(""), *[F.concat(F.lit(mark if mark == "- " else f"{i}. "), lit(x)) for i, x in enumerate(xs, 1)])

    if task in ("h10", "h19"):
        a, b = ("Learner", "Expert") if task == "h10" else ("Home Owner", "Handyman")
        say = lambda who, x: F.concat(lit(who), F.lit(": "), lit(x))
        named = "Safety principle: isolate first."
        turns = [say(on("unknown_speaker", F.lit("Teacher"), F.lit(b)), text), say(a, "Then this?"), say(b, named), say(a, "And that?"),
                 say(b, on("principles", F.lit("Do it so."), F.lit(named)))]
        closing = F.when(k == codes.index("bad_closing") + 1, F.lit(None).cast("string")).otherwise(say(a, "Isolate first, then work."))
        body = F.concat_ws("\n", *turns, closing)
        opening = say(a, "It is safe to touch.")
        if "bad_opening" in codes:
            opening = F.when(k == codes.index("bad_opening") + 1, F.lit(None).cast("string")).otherwise(opening)
        return docs.select(F.col("doc_id").cast("string").alias("seed_id"), F.concat_ws("\n", opening, body).alias("answer"))

    labels = LABELS[task]
    own = {x: F.concat(F.lit(" "), F.lit("some words on it")) for x in labels}
    own[labels[0]] = F.concat(F.lit(" "), text)
    if task == "h5":
        own = {"Daily": listed(F.concat(F.lit("check electrical, plumbing and structural parts "), text)), "Weekly": on("no_task:Weekly", F.lit(" none"), listed("plumbing look")),
               "Monthly": listed(on("missing_system:hvac", F.lit("filters"), F.lit("HVAC filters"))), "Quarterly": listed("pest and damp round [Professional]"),
               "Annual": listed(on("untagged_item", F.lit("paint"), F.lit("paint [DIY]"))), "Indian Climate Notes": listed("monsoon")}
    elif task == "h6":
        own |= {"Fixed Costs": listed(F.concat(F.lit("rent "), text)), "Variable Costs": listed("help: 2000"),
                "Discretionary": on("empty:Discretionary", F.lit(" none"), listed("films")), "Maintenance Reserve": on("reserve_percent", F.lit(" 12%"), F.lit(" 1-2% of value"))}
    elif task == "h7":
        own |= {"Prevention Checklist": on("prevention_count", listed("a", "b"), listed("a", "b", "c")),
                "Phase 3 — Recovery": listed("Call: 101", "Do not re-enter until: clear"),
                "Emergency Numbers": on("missing_number:101", F.lit(" PESO: 1906 | Medical: 108"), F.lit(" PESO: 1906 | Fire: 101 | Medical: 108"))}
    elif task == "h12":
        own |= {"Pre-Monsoon Checklist": listed("clear drains — Free DIY", on("uncosted_item", F.lit("seal roof"), F.lit("seal roof — Professional")), mark="1")}
    elif task == "h13":
        own |= {"How to Detect a Leak": listed(F.concat(F.lit("smell of gas "), text), on("missing_sign:sound", F.lit("none"), F.lit("hissing sound"))),
                "Emergency Sequence (IN ORDER)": on("not_numbered", listed("close valve"), listed("close valve", "open windows", mark="1")),
                "NEVER do during a leak": on("too_few_never", listed("a", "b", mark="1"), listed("a", "b", "c", "d", "e", mark="1")),
                "Emergency Numbers": on("missing_number:1906", F.lit(" Fire: 101 | Medical: 108"), F.lit(" PESO: 1906 | Fire: 101 | Medical: 108"))}
        own["How to Detect a Leak"] = F.when(k == codes.index("missing_sign:sound") + 1, listed("smell of gas")).otherwise(own["How to Detect a Leak"])
    elif task == "h14":
        own |= {"DO NOT (Indian myths — dangerous)": on("too_few_myths", listed("oil", mark="1"), listed("oil", "venom", "ice", mark="1")), "Call 108 if": on("no_call", F.lit(""), F.lit(" it is deep"))}
    elif task == "h16":
        one = [f"check {i} — Cost of Inaction: loss" for i in range(3)]
        last = on("missing_inaction", F.lit("check 2"), F.lit(one[2]))
        own |= {"Maintenance Checklist": on("item_count", listed(*one[:2], mark="1"), listed(*one[:2], last, mark="1"))}
    elif task == "h17":
        own |= {"Materials Required": on("over_budget", F.lit(" wire Rs 150, tape Rs. 50"), on("no_cost", F.lit(" wire"), F.lit(" wire Rs 120, tape ₹30.5"))),
                "Engineering Logic": on("no_logic", F.lit(""), F.concat(F.lit(" tension "), text))}
    elif task == "h18":
        own |= {"Age Group": on("bad_level", F.lit(" Level 7 (5-12)"), on("age_mismatch", F.lit(" Level 2 (20-40)"), F.lit(" Level 3 (20–40)"))),
                "Safety Boundary": on("no_boundary", F.lit(""), F.concat(F.lit(" "), text))}
    elif task == "h20":
        own |= {"Hard Stops": on("no_hard_stop", F.lit(""), listed("wiring")), "Final Assessment": on("bad_final", F.lit(" Maybe"), F.lit(" Wait and save"))}
    parts = [F.concat(F.lit(x + ":"), own[x]) for x in labels]
    plain = F.concat_ws("\n", *parts)
    for code in codes:
        if code.startswith("missing:"):
            plain = on(code, F.concat_ws("\n", *[p for x, p in zip(labels, parts) if x != code.split(":", 1)[1]]), plain)
    plain = on("missing", F.concat_ws("\n", *parts[:-1]), on("duplicate", F.concat_ws("\n", *parts, parts[-1]), plain))
    plain = on("late_containment", F.concat_ws("\n", parts[0], parts[2], parts[1], *parts[3:]), plain)
    plain = on("out_of_order", F.concat_ws("\n", *parts[:-2], parts[-1], parts[-2]), plain)
    return docs.select(F.col("doc_id").cast("string").alias("seed_id"), plain.alias("answer"))


# ------------------------------------------------------------------ free-text answers
TEXT_PLANTED = {
    "qa": ["preamble", "pair_count", "bad_numbering", "empty_part", "repeated_question"], "cot": ["preamble", "set_count", "empty_set", "repeated_question"],
    "content": ["no_block", "many_blocks", "outside_text", "empty_block"], "question": ["not_a_question", "no_answer", "labelled"],
}


def text_answers(spark, sf_dir, kind: str) -> DataFrame:
    """fx_texts: per document one free-text answer that holds the document's whole text on one line; codes planted by key rule."""
    codes = TEXT_PLANTED[kind]
    k = F.col("doc_id") % (len(codes) + 1)
    text = F.regexp_replace("text", r"\s+", " ")
    lit, cat = F.lit, F.concat

    def on(code, bad, good):
        return F.when(k == codes.index(code) + 1, bad).otherwise(good)

    if kind == "qa":
        first = cat(lit("Q1:\nWhat links "), text, lit("?\n\nA1:\n"), on("empty_part", lit(" "), text))
        second = cat(lit("\n\nQ"), on("bad_numbering", lit("3"), lit("2")), lit(":\nWhat links "), on("repeated_question", text, lit("them")), lit("?\n\nA2:\nBoth."))
        ans = cat(on("preamble", lit("Here you go.\n"), lit("")), first, on("pair_count", lit(""), second))
    elif kind == "cot":
        one = cat(lit("Question 1: What follows?\nStep 1. "), text)
        two = cat(lit("\nQuestion 2: "), on("repeated_question", lit("what  follows?"), lit("Why?")), on("empty_set", lit(""), lit("\nStep 1. So it is.")))
        ans = cat(on("preamble", lit("Sure!\n"), lit("")), one, on("set_count", lit(""), two))
    elif kind == "content":
        ans = cat(on("outside_text", lit("Here it is. "), lit("")), on("no_block", lit(""), lit("<CONTENT>\n")), on("empty_block", lit(""), text),
                  on("no_block", lit(""), lit("\n</CONTENT>")), on("many_blocks", lit("\n<CONTENT>more</CONTENT>"), lit("")))
    else:
        ans = cat(on("labelled", lit("Q: "), lit("")), lit("What does it say"), on("not_a_question", lit("."), lit("?")), on("no_answer", lit(""), cat(lit("\n\n"), text)))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("seed_id"), ans.alias("answer"))
