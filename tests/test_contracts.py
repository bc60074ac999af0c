import json

import pytest

from seedmill.operators.contracts import CONTRACTS, check_contract
from seedmill.functions.vocab import LOW_QUALITY_PREFIX

DISH = {"name": "raita", "reasoning_hop_1": "cool", "reasoning_hop_2": "sour"}
GOOD = {
    "scenarios": [f"Cook {i} waits. The pot boils." for i in range(8)],
    "c1_substitution": {"substitutions": [{"original_ingredient": "Butter", "substitute": "oil", "reasoning": "fat", "technique_adjustment": "none"}]},
    "c2_diagnosis": {"diagnosis": "a", "scientific_reason": "b", "rescue_fix": "c", "prevention_tip": "d"},
    "c3_workflow": {"mise_en_place": [{"task": "chop", "time_min": 3}], "action_timeline": [
        {"step": 1, "description": "fry", "time_min": 5, "type": "active", "parallel_opportunity": "none"}]},
    "c4_pairing": {"flavor_profile": {"dominant_notes": ["sour"]}, "recommendations": {"side_dish": DISH, "grain_bread": DISH}},
    "c5_scaling": {"multiplier_calculation": "8/4", "multiplier_value": 2.0, "non_linear_adjustments": [
        {"ingredient": "salt", "adjusted_amount": "1", "reasoning": "taste"}], "adjusted_ingredient_list": ["rice"]},
    "c6_scraps": {"scraps_identified": ["peel"], "scrap_mini_recipe": {"name": "chips", "method": "fry"}, "leftover_transformation": {"name": "stock", "method": "boil"}},
    "c7_dialogue": {"novice_persona_match": "plain", "conversation": [
        {"speaker": "novice", "text": "How?"}, {"speaker": "expert", "text": "So."}, {"speaker": "novice", "text": "Boil?", "error_made": "boils"},
        {"speaker": "expert", "text": "No.", "correction": "simmer"}, {"speaker": "novice", "text": "Simmer.", "demonstrated_understanding": "yes"}]},
    "c8_faq": {"recipe_faq": [{"category": c, "question": "q?", "answer": "a"} for c in ["storage", "equipment", "scaling", "technique", "make-ahead"]]},
    "c9_narrative": {"cultural_context_applied": "x", "narrative_text": "She cooked.", "sensory_elements": dict.fromkeys(["smell", "texture", "color", "sound", "taste"], "s")},
    "c10_translation": {"source_language": "English", "target_language": "French", "translated_recipe": "Faire le tadka"},
    "c11_tradition": {"identified_tradition": "x", "evidence_markers": ["a", "b"], "signature_techniques": ["t"], "ambiguity_note": "none"},
    "c12_festive": {"festival": "Diwali", "anchor_dish": "rice", "thali_meal_plan": [{"dish": f"d{i}", "cultural_note": "n"} for i in range(3)], "serving_order": ["d1"]},
    "c13_preservation": {"preservation_method": "diwali", "science_explanation": "s", "ingredient_adjustments": [], "storage_details": {
        "temperature": "4 C", "container_type": "jar", "max_duration": "2 weeks"}, "safety_warning": "w"},
    "c14_nutrition": {"ingredient_analysis": [{"ingredient": i, "macronutrient_role": "m", "micronutrient_highlight": "h",
                                              "ayurvedic": {"dosha": "d", "rasa": "r", "guna": "g"}, "dietary_suitability": "s"} for i in "ab"], "overall_assessment": "o"},
}


@pytest.mark.parametrize("task", sorted(CONTRACTS))
def test_conforming_and_empty(spark, task):
    good = json.dumps(GOOD[task])
    empty = "[]" if task == "scenarios" else "{}"
    blank = json.dumps(GOOD[task]).replace('"a"', '""')
    rows = [("good", good), ("fence", f"```json\n{good}\n```"), ("flag", f"{LOW_QUALITY_PREFIX}\n```json\n{good}\n```"), ("empty", empty),
            ("flag_empty", f"{LOW_QUALITY_PREFIX}\n{empty}"), ("bad", good[:-2]), ("null", None)]
    df = spark.createDataFrame([(k, t, "Melt the butter, make a tadka.", "Diwali", "french", 4.0, 8.0) for k, t in rows],
                               "k string, answer string, seed_text string, bound_tag string, requested string, scale_from double, scale_to double")
    got = {r["k"]: list(r["violations"]) for r in check_contract(df, "answer", CONTRACTS[task]).collect()}
    assert got["good"] == got["fence"] == got["flag"] == [], got
    assert got["empty"] and got["flag_empty"] and "unparsable" not in got["empty"]
    assert got["bad"] == got["null"] == ["unparsable"]


CASES = [
    ("c1_substitution", lambda a: a["substitutions"][0].update(original_ingredient="caviar"), "original_not_in_seed"),
    ("c1_substitution", lambda a: a.update(substitutions=[]), "no_substitutions"),
    ("c3_workflow", lambda a: a["action_timeline"][0].update(type="waiting"), "bad_step_type"),
    ("c3_workflow", lambda a: a["action_timeline"][0].update(step=2), "bad_numbering"),
    ("c3_workflow", lambda a: a.update(mise_en_place=[]), "no_prep"),
    ("c4_pairing", lambda a: a["recommendations"].update(side_dish={"name": "x", "reasoning_hop_1": "y", "reasoning_hop_2": ""}), "missing_side_dish"),
    ("c5_scaling", lambda a: a.update(multiplier_value=3), "wrong_multiplier"),
    ("c6_scraps", lambda a: a["leftover_transformation"].update(name=" CHIPS"), "same_dish"),
    ("c7_dialogue", lambda a: a["conversation"][3].pop("correction"), "no_correction"),
    ("c7_dialogue", lambda a: a["conversation"].append({"speaker": "expert", "text": "Bye."}), "bad_ending"),
    ("c7_dialogue", lambda a: a["conversation"][2].pop("error_made"), "no_error"),
    ("c8_faq", lambda a: a["recipe_faq"][0].update(answer=" "), "empty_item"),
    ("c8_faq", lambda a: a["recipe_faq"][2].update(category="x"), "missing_scaling"),
    ("c9_narrative", lambda a: a.update(narrative_text="So:\n1. fry"), "numbered_list"),
    ("c9_narrative", lambda a: a.update(narrative_text="So:\n| a | b |"), "table"),
    ("c9_narrative", lambda a: a["sensory_elements"].pop("color"), "missing_sense"),
    ("c10_translation", lambda a: a.update(translated_recipe="Faire revenir"), "lost_term"),
    ("c10_translation", lambda a: a.update(target_language="Italian"), "wrong_target"),
    ("c11_tradition", lambda a: a.update(evidence_markers=["a", "A "]), "too_few_markers"),
    ("c12_festive", lambda a: a.update(festival="Holi"), "festival_mismatch"),
    ("c12_festive", lambda a: a["thali_meal_plan"][0].pop("cultural_note"), "missing_note"),
    ("c12_festive", lambda a: a.update(serving_order=[]), "no_serving_order"),
    ("c13_preservation", lambda a: a["storage_details"].pop("max_duration"), "missing_storage_field"),
    ("c13_preservation", lambda a: a.update(preservation_method="x"), "method_mismatch"),
    ("c14_nutrition", lambda a: a["ingredient_analysis"].pop(), "too_few_ingredients"),
    ("c14_nutrition", lambda a: a["ingredient_analysis"][0]["ayurvedic"].pop("rasa"), "incomplete_ayurvedic"),
    ("scenarios", lambda a: a.append("One. Two. Three."), "too_long"),
    ("scenarios", lambda a: a.append(a[0].upper()), "repeated"),
]


def test_one_text_per_code(spark):
    for task in sorted({t for t, _, _ in CASES}):
        rows = []
        for i, (t, change, _) in enumerate(CASES):
            if t == task:
                a = json.loads(json.dumps(GOOD[task]))
                change(a)
                rows.append((i, json.dumps(a), "Melt the butter, make a tadka.", "Diwali", "french", 4.0, 8.0))
        df = spark.createDataFrame(rows, "i int, answer string, seed_text string, bound_tag string, requested string, scale_from double, scale_to double")
        for r in check_contract(df, "answer", CONTRACTS[task]).collect():
            assert list(r["violations"]) == [CASES[r["i"]][2]], (task, r)
