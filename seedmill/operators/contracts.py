"""JSON task contracts (V4-V17 family): one runner, contracts as data.

A contract is a DDL for the answer plus ordered ``(code, check)`` pairs, each
check a Column over ``v`` (the parsed answer) and the request columns. The
runner parses strictly (low-quality prefix and fence removed, in either order)
and returns the codes that fire; ``passed`` means no code fired. A check that
comes out NULL fires: a missing field is a violation, so ``{}`` fails every
contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedmill.functions.jsonparse import with_parsed
from seedmill.functions.text import drop_quality_flag, py_strip, strip_code_fence


def _empty(c):
    return py_strip(F.coalesce(c, F.lit(""))) == ""


def v(path: str = ""):
    return F.col(f"_v.value.{path}" if path else "_v.value")


def _fold(c):
    return F.lower(py_strip(c))


def _any_empty(x, fields):
    out = F.lit(False)
    for f in fields:
        out = out | _empty(x[f])
    return out


def _none(path: str):
    """No element, or none that holds text."""
    return ~F.exists(v(path), lambda x: ~_empty(x))


def _items(path: str, *fields):
    """Some element of the list misses one of its texts."""
    return F.exists(v(path), lambda x: _any_empty(x, fields))


#: Culinary terms that a translation keeps as they are.
NATIVE_TERMS = ["tadka", "roux", "tawa", "mise en place", "tempering"]
SENSES = ["smell", "texture", "color", "sound", "taste"]


def _lost_term(terms):
    out = F.lit(False)
    for t in terms:
        word = rf"(?i)\b{t}\b"
        out = out | (F.col("seed_text").rlike(word) & ~v("translated_recipe").rlike(word))
    return out


def _sentences(x):
    return F.size(F.filter(F.split(py_strip(x), r"[.!?]+(?:\s+|$)"), lambda p: p != ""))


def _no_correction():
    """A novice error, and no expert turn with a correction after the first of them."""
    turns = v("conversation")
    error = F.transform(turns, lambda x, i: F.when((_fold(x["speaker"]) == "novice") & ~_empty(x["error_made"]), i))
    fixed = F.transform(turns, lambda x, i: F.when((_fold(x["speaker"]) == "expert") & ~_empty(x["correction"]), i))
    return F.array_min(error).isNotNull() & ~F.coalesce(F.array_max(fixed) > F.array_min(error), F.lit(False))


def _dish(path: str):
    return _empty(v(f"{path}.name")) | _empty(v(f"{path}.method"))


def _pairing(path: str):
    return _empty(v(f"{path}.name")) | _empty(v(f"{path}.reasoning_hop_1")) | _empty(v(f"{path}.reasoning_hop_2"))


def _texts(fields):
    return [(f"empty_{f}", lambda f=f: _empty(v(f))) for f in fields]


CONTRACTS = {
    # V3: a list of 8-12 distinct scenarios of one or two sentences
    "scenarios": {
        "ddl": "array<string>",
        "checks": [("too_few", lambda: F.size(v()) < 8), ("too_many", lambda: F.size(v()) > 12),
                   ("repeated", lambda: F.size(F.array_distinct(F.transform(v(), _fold))) < F.size(v())),
                   ("empty_item", lambda: F.exists(v(), _empty)),
                   ("too_long", lambda: F.exists(v(), lambda x: _sentences(x) > 2))],
    },
    # V4 (C1): substitutions unless flagged; every original ingredient stands in the seed text
    "c1_substitution": {
        "ddl": "struct<substitutions:array<struct<original_ingredient:string,substitute:string,reasoning:string,technique_adjustment:string>>>",
        "checks": [("no_substitutions", lambda: (F.size(v("substitutions")) == 0) & ~F.col("_lq")),
                   ("empty_field", lambda: _items("substitutions", "original_ingredient", "substitute", "reasoning", "technique_adjustment")),
                   ("original_not_in_seed", lambda: F.exists(v("substitutions"), lambda x: ~F.lower(F.col("seed_text"))
                                                             .contains(_fold(x["original_ingredient"]))))],
    },
    # V5 (C2): four texts
    "c2_diagnosis": {
        "ddl": "struct<diagnosis:string,scientific_reason:string,rescue_fix:string,prevention_tip:string>",
        "checks": _texts(["diagnosis", "scientific_reason", "rescue_fix", "prevention_tip"]),
    },
    # V6 (C3): preparation tasks with times; steps 1..n, active or passive, with times
    "c3_workflow": {
        "ddl": ("struct<mise_en_place:array<struct<task:string,time_min:double>>,action_timeline:array<struct<step:int,"
                "description:string,time_min:double,type:string,parallel_opportunity:string>>>"),
        "checks": [("no_prep", lambda: F.size(v("mise_en_place")) == 0),
                   ("bad_prep", lambda: F.exists(v("mise_en_place"), lambda x: _empty(x["task"]) | F.coalesce(x["time_min"] <= 0, F.lit(True)))),
                   ("bad_step_type", lambda: F.exists(v("action_timeline"), lambda x: ~F.coalesce(_fold(x["type"]).isin("active", "passive"), F.lit(False)))),
                   ("bad_time", lambda: F.exists(v("action_timeline"), lambda x: F.coalesce(x["time_min"] <= 0, F.lit(True)))),
                   ("bad_numbering", lambda: F.when(F.size(v("action_timeline")) == 0, F.lit(True)).otherwise(
                       F.transform(v("action_timeline"), lambda x: x["step"]) != F.sequence(F.lit(1), F.greatest(F.size(v("action_timeline")), F.lit(1))))),
                   ("empty_step", lambda: _items("action_timeline", "description", "parallel_opportunity"))],
    },
    # V7 (C4): flavour notes; both dishes with two reasoning hops each
    "c4_pairing": {
        "ddl": ("struct<flavor_profile:struct<dominant_notes:array<string>>,recommendations:struct<"
                "side_dish:struct<name:string,reasoning_hop_1:string,reasoning_hop_2:string>,"
                "grain_bread:struct<name:string,reasoning_hop_1:string,reasoning_hop_2:string>>>"),
        "checks": [("no_notes", lambda: _none("flavor_profile.dominant_notes")),
                   ("missing_side_dish", lambda: _pairing("recommendations.side_dish")),
                   ("missing_grain_bread", lambda: _pairing("recommendations.grain_bread"))],
    },
    # V8 (C5): multiplier = target / current (tolerance 0.01), 1 only with the flag; adjustments and list filled
    "c5_scaling": {
        "ddl": ("struct<multiplier_calculation:string,multiplier_value:double,non_linear_adjustments:array<struct<ingredient:string,"
                "adjusted_amount:string,reasoning:string>>,adjusted_ingredient_list:array<string>>"),
        "checks": [("empty_calculation", lambda: _empty(v("multiplier_calculation"))),
                   ("wrong_multiplier", lambda: F.abs(v("multiplier_value") - F.col("scale_to") / F.col("scale_from")) > 0.01),
                   ("unflagged_identity", lambda: (v("multiplier_value") == 1.0) & ~F.col("_lq")),
                   ("bad_adjustment", lambda: (F.size(v("non_linear_adjustments")) == 0)
                    | _items("non_linear_adjustments", "ingredient", "adjusted_amount", "reasoning")),
                   ("empty_list", lambda: _none("adjusted_ingredient_list"))],
    },
    # V9 (C6): scraps, and two distinct dishes with a method each
    "c6_scraps": {
        "ddl": ("struct<scraps_identified:array<string>,scrap_mini_recipe:struct<name:string,method:string>,"
                "leftover_transformation:struct<name:string,method:string>>"),
        "checks": [("no_scraps", lambda: _none("scraps_identified")), ("empty_mini_recipe", lambda: _dish("scrap_mini_recipe")),
                   ("empty_transformation", lambda: _dish("leftover_transformation")),
                   ("same_dish", lambda: _fold(v("scrap_mini_recipe.name")) == _fold(v("leftover_transformation.name")))],
    },
    # V10 (C7): novice and expert; an error, a later correction, a novice at the end who has understood
    "c7_dialogue": {
        "ddl": ("struct<novice_persona_match:string,conversation:array<struct<speaker:string,text:string,error_made:string,"
                "correction:string,demonstrated_understanding:string>>>"),
        "checks": [("empty_persona", lambda: _empty(v("novice_persona_match"))),
                   ("bad_speaker", lambda: F.exists(v("conversation"), lambda x: ~F.coalesce(_fold(x["speaker"]).isin("novice", "expert"), F.lit(False)))),
                   ("empty_text", lambda: _items("conversation", "text")),
                   ("no_error", lambda: ~F.exists(v("conversation"), lambda x: (_fold(x["speaker"]) == "novice") & ~_empty(x["error_made"]))),
                   ("no_correction", _no_correction),
                   ("bad_ending", lambda: ~((_fold(F.try_element_at(v("conversation"), F.lit(-1))["speaker"]) == "novice")
                                            & ~_empty(F.try_element_at(v("conversation"), F.lit(-1))["demonstrated_understanding"])))],
    },
    # V11 (C8): 5-7 complete items; storage, equipment and scaling among the categories
    "c8_faq": {
        "ddl": "struct<recipe_faq:array<struct<category:string,question:string,answer:string>>>",
        "checks": [("too_few_items", lambda: F.size(v("recipe_faq")) < 5), ("too_many_items", lambda: F.size(v("recipe_faq")) > 7)]
        + [(f"missing_{c}", lambda c=c: ~F.exists(v("recipe_faq"), lambda x: F.coalesce(_fold(x["category"]) == c, F.lit(False))))
           for c in ["storage", "equipment", "scaling"]]
        + [("empty_item", lambda: _items("recipe_faq", "category", "question", "answer"))],
    },
    # V12 (C9): five senses; a narrative without numbered list or table
    "c9_narrative": {
        "ddl": ("struct<cultural_context_applied:string,narrative_text:string,sensory_elements:struct<smell:string,texture:string,"
                "color:string,sound:string,taste:string>>"),
        "checks": [("empty_context", lambda: _empty(v("cultural_context_applied"))), ("empty_narrative", lambda: _empty(v("narrative_text"))),
                   ("missing_sense", lambda: _any_empty(v("sensory_elements"), SENSES)),
                   ("numbered_list", lambda: v("narrative_text").rlike(r"(?m)^\s*\d+[.)]\s")),
                   ("table", lambda: v("narrative_text").rlike(r"(?m)^\s*\|.*\|\s*$"))],
    },
    # V13 (C10): the requested language; native terms of the source survive; equal languages only with the flag
    "c10_translation": {
        "ddl": "struct<source_language:string,target_language:string,translated_recipe:string>",
        "checks": [("empty_source", lambda: _empty(v("source_language"))),
                   ("wrong_target", lambda: _fold(v("target_language")) != F.lower(F.col("requested"))),
                   ("empty_translation", lambda: _empty(v("translated_recipe"))),
                   ("lost_term", lambda: ~_empty(v("translated_recipe")) & _lost_term(NATIVE_TERMS)),
                   ("unflagged_same", lambda: (_fold(v("source_language")) == _fold(v("target_language"))) & ~F.col("_lq"))],
    },
    # V14 (C11): two distinct markers, techniques, a note (or 'none')
    "c11_tradition": {
        "ddl": "struct<identified_tradition:string,evidence_markers:array<string>,signature_techniques:array<string>,ambiguity_note:string>",
        "checks": [("empty_tradition", lambda: _empty(v("identified_tradition"))),
                   ("too_few_markers", lambda: F.size(F.array_distinct(F.filter(F.transform(v("evidence_markers"), _fold), lambda x: x != ""))) < 2),
                   ("no_techniques", lambda: _none("signature_techniques")), ("empty_note", lambda: _empty(v("ambiguity_note")))],
    },
    # V15 (C12): the bound festival; anchor, 3-5 dishes with a cultural note, a serving order
    "c12_festive": {
        "ddl": ("struct<festival:string,anchor_dish:string,thali_meal_plan:array<struct<dish:string,cultural_note:string>>,"
                "serving_order:array<string>>"),
        "checks": [("festival_mismatch", lambda: _fold(v("festival")) != F.lower(F.col("bound_tag"))), ("empty_anchor", lambda: _empty(v("anchor_dish"))),
                   ("dish_count", lambda: (F.size(v("thali_meal_plan")) < 3) | (F.size(v("thali_meal_plan")) > 5)),
                   ("empty_dish", lambda: _items("thali_meal_plan", "dish")), ("missing_note", lambda: _items("thali_meal_plan", "cultural_note")),
                   ("no_serving_order", lambda: _none("serving_order"))],
    },
    # V16 (C13): the bound method; science, complete adjustments, three storage fields, a warning
    "c13_preservation": {
        "ddl": ("struct<preservation_method:string,science_explanation:string,ingredient_adjustments:array<struct<original:string,"
                "adjusted:string,reasoning:string>>,storage_details:struct<temperature:string,container_type:string,max_duration:string>,"
                "safety_warning:string>"),
        "checks": [("method_mismatch", lambda: _fold(v("preservation_method")) != F.lower(F.col("bound_tag"))),
                   ("empty_science", lambda: _empty(v("science_explanation"))),
                   ("bad_adjustment", lambda: _items("ingredient_adjustments", "original", "adjusted", "reasoning")),
                   ("missing_storage_field", lambda: _any_empty(v("storage_details"), ["temperature", "container_type", "max_duration"])),
                   ("empty_warning", lambda: _empty(v("safety_warning")))],
    },
    # V17 (C14): two ingredients unless flagged, every text of each; an overall assessment
    "c14_nutrition": {
        "ddl": ("struct<ingredient_analysis:array<struct<ingredient:string,macronutrient_role:string,micronutrient_highlight:string,"
                "ayurvedic:struct<dosha:string,rasa:string,guna:string>,dietary_suitability:string>>,overall_assessment:string>"),
        "checks": [("too_few_ingredients", lambda: (F.size(v("ingredient_analysis")) < 2) & ~F.col("_lq")),
                   ("empty_field", lambda: _items("ingredient_analysis", "ingredient", "macronutrient_role", "micronutrient_highlight", "dietary_suitability")),
                   ("incomplete_ayurvedic", lambda: F.exists(v("ingredient_analysis"), lambda x: _any_empty(x["ayurvedic"], ["dosha", "rasa", "guna"]))),
                   ("empty_assessment", lambda: _empty(v("overall_assessment")))],
    },
}


def check_contract(df: DataFrame, text: str, contract: dict) -> DataFrame:
    """Adds ``parse_ok`` and ``violations`` (``unparsable`` when the answer is not valid JSON)."""
    from seedmill.functions.text import has_quality_flag
    df = df.withColumn("_lq", F.coalesce(has_quality_flag(F.col(text)), F.lit(False)))
    body = drop_quality_flag(strip_code_fence(drop_quality_flag(F.col(text))))
    p = with_parsed(df, body, contract["ddl"], "_v")
    ok = F.coalesce(F.col("_v.ok"), F.lit(False))
    codes = [F.when(ok & F.coalesce(chk(), F.lit(True)), F.lit(code)) for code, chk in contract["checks"]]
    viol = F.when(ok, F.filter(F.array(*codes), lambda x: x.isNotNull())).otherwise(F.array(F.lit("unparsable")))
    return p.withColumn("parse_ok", ok).withColumn("violations", viol).drop("_v", "_lq")
