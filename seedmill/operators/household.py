"""Labelled household answers (V18-V29, V31): label sets and rules as data, one runner.

A section runs from its label at the start of a line to the next label of the task. Labels must be
there once, in the task's order; a body line that opens with a label counts as that label again.
All rules are JVM string and array functions over one row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedmill.functions.text import py_strip
from seedmill.operators.sections import check_sections, found_codes

#: The labels of each task's answer, in order.
LABELS = {
    "h1": ["Appliance", "Reported Symptom", "Root Cause", "DIY Fix Steps", "Call a Technician if", "Prevention Tip", "Indian Home Note"],
    "h2": ["Step 0 — Immediate Action", "Likely Cause", "DIY Response", "Call a Plumber if", "Local Note"],
    "h3": ["Safety First", "Task Steps", "Do NOT attempt yourself", "Indian Home Note"],
    "h4": ["Stain Chemistry", "Cleaning Agent", "Removal Steps", "Do NOT mix", "Hard-water note"],
    "h5": ["Daily", "Weekly", "Monthly", "Quarterly", "Annual", "Indian Climate Notes"],
    "h6": ["Fixed Costs", "Variable Costs", "Discretionary", "Maintenance Reserve", "Savings Strategy", "Key Indian Household Note"],
    "h7": ["Hazard", "Phase 1 — Immediate (0-60 sec)", "Phase 2 — Containment (next 5 min)", "Phase 3 — Recovery", "Prevention Checklist", "Emergency Numbers"],
    "h8": ["Fibre Structure", "Washing", "Drying", "Ironing", "Storage", "Common Mistake to Avoid", "Indian Laundry Note"],
    "h9": ["Primary Challenge", "Zoning Plan", "Vertical Storage", "Product Suggestions", "Immediate Declutter Rule"],
    "h11": ["System Affected", "Diagnosis or Maintenance Need", "DIY Steps (at home)", "Service Centre Required for", "Indian Riding Note"],
    "h12": ["City Risk Profile", "Pre-Monsoon Checklist", "Active Monsoon Checklist", "Electrical Safety Note", "Mould / Pest Note"],
    "h13": ["How to Detect a Leak", "Emergency Sequence (IN ORDER)", "NEVER do during a leak", "Prevention Checklist", "Emergency Numbers"],
    "h14": ["Emergency", "Step 0 — First 30 seconds", "First Aid Steps", "DO NOT (Indian myths — dangerous)", "Call 108 if", "Transport / Recovery Note"],
    "h15": ["Material Analysis", "Why All-Purpose Products Fail Here", "Recommended Solution", "Repair / Cleaning Protocol", "Pro-Tip"],
    "h16": ["Climate Challenge", "Maintenance Checklist", "Reasoning", "Local Resources"],
    "h17": ["The Jugaad Solution", "Materials Required", "Engineering Logic", "Step-by-Step Build", "Safety Check"],
    "h18": ["Age Group", "Task", "Adapted Instructions", "Safety Boundary", "Next Step to Level Up"],
    "h20": ["Original Procedure Summary", "Budget Breakdown", "Missing Tool", "Adapted Steps", "Hard Stops", "Final Assessment"],
}
#: The containment step comes first, behind the line that names the case (if the task has one).
FIRST = {"h2": ("Step 0 — Immediate Action", None), "h7": ("Phase 1 — Immediate (0-60 sec)", "Hazard"), "h14": ("Step 0 — First 30 seconds", "Emergency")}
#: Speakers (opening, other) of the dialogue tasks; the opening speaker also closes.
SPEAKERS = {"h10": ("Learner", "Expert"), "h19": ("Home Owner", "Handyman")}
EMERGENCY_NUMBERS = ["1906", "101", "108"]
SYSTEMS = {"electrical": "electric", "plumbing": "plumb", "hvac": "hvac", "structural": "structur", "pest_damp": "pest|damp"}
AGE_RANGES = {"1": "5-12", "2": "13-19", "3": "20-40", "4": "40+"}


def body(text: Column, task: str, label: str) -> Column:
    """The section's text, stripped; empty when the label is missing."""
    others = "|".join(re.escape(x) for x in LABELS[task])
    # cut at the label, then at the next one: both look for a line break first, not behind every character
    rest = F.get(F.split(F.concat(F.lit("\n"), text), rf"\n{re.escape(label)}:", 2), F.lit(1))
    return py_strip(F.coalesce(F.get(F.split(rest, rf"\n(?:{others}):", 2), F.lit(0)), F.lit("")))


def items(section: Column, mark: str = r"(?:-|\d+[.)])") -> Column:
    """The texts of the section's listed lines."""
    lines = F.filter(F.split(section, "\n"), lambda x: x.rlike(rf"^\s*{mark}\s+\S"))
    return F.transform(lines, lambda x: py_strip(F.regexp_replace(x, rf"^\s*{mark}\s+", "")))


def _rules(task: str, t: Column) -> list[tuple[str, Column]]:
    """(code, check) of the task's own rules."""
    def sec(label):
        return body(t, task, label)

    def empty(label):
        return sec(label) == ""

    if task == "h5":
        tagged = F.concat(items(sec("Quarterly")), items(sec("Annual")))
        return ([(f"no_task:{x}", F.size(items(sec(x))) == 0) for x in LABELS["h5"][:5]]
                + [(f"missing_system:{k}", ~F.lower(t).rlike(p)) for k, p in SYSTEMS.items()]
                + [("untagged_item", F.exists(tagged, lambda x: ~x.rlike(r"(?i)\b(DIY|Professional)\b")))])
    if task == "h6":
        return ([(f"empty:{x}", F.size(items(sec(x))) == 0) for x in LABELS["h6"][:3]]
                + [("reserve_percent", ~sec("Maintenance Reserve").rlike(r"(?<![\d.])(?:1(?:\.\d+)?|2(?:\.0+)?)\s*(?:%|(?:-|–|to)\s*2\s*%)"))])
    if task in ("h7", "h13"):
        numbers = [(f"missing_number:{n}", ~sec("Emergency Numbers").rlike(rf"(?<!\d){n}(?!\d)")) for n in EMERGENCY_NUMBERS]
        if task == "h7":
            return [("empty_phase1", empty("Phase 1 — Immediate (0-60 sec)")), ("prevention_count", ~F.size(items(sec("Prevention Checklist"))).between(3, 5)), *numbers]
        signs, order = sec("How to Detect a Leak"), items(sec("Emergency Sequence (IN ORDER)"), r"\d+[.)]")
        return [("missing_sign:smell", ~F.lower(signs).rlike("smell|odou?r")), ("missing_sign:sound", ~F.lower(signs).rlike("sound|hiss")),
                ("not_numbered", F.size(order) == 0), ("too_few_never", F.size(items(sec("NEVER do during a leak"))) < 5), *numbers]
    if task == "h12":
        pre = items(sec("Pre-Monsoon Checklist"))
        return [("no_item", F.size(pre) == 0), ("uncosted_item", F.exists(pre, lambda x: ~x.rlike(r"(?i)(Free DIY|Low cost|Professional)[\])]?\.?$")))]
    if task == "h14":
        return [("empty_step0", empty("Step 0 — First 30 seconds")), ("too_few_myths", F.size(items(sec("DO NOT (Indian myths — dangerous)"))) < 3), ("no_call", empty("Call 108 if"))]
    if task == "h16":
        checks = items(sec("Maintenance Checklist"))
        return [("item_count", F.size(checks) != 3), ("missing_inaction", F.exists(checks, lambda x: ~x.rlike(r"(?i)cost of inaction:\s*\S")))]
    if task == "h17":
        costs = F.transform(F.regexp_extract_all(sec("Materials Required"), F.lit(r"(?i)(?:Rs\.?|₹)\s*(\d+(?:\.\d+)?)"), F.lit(1)), lambda x: x.cast("double"))
        return [("no_cost", F.size(costs) == 0), ("over_budget", F.aggregate(costs, F.lit(0.0), lambda a, x: a + x) >= 200), ("no_logic", empty("Engineering Logic"))]
    if task == "h18":
        group = sec("Age Group")
        level, ages = F.regexp_extract(group, r"(?i)level\s*([0-9]+)", 1), F.regexp_replace(F.regexp_extract(group, r"(\d+\s*[-–]\s*\d+|\d+\s*\+)", 1), r"\s|–", "-")
        ages = F.regexp_replace(ages, "-+", "-")
        agrees = F.lit(False)
        for k, r in AGE_RANGES.items():
            agrees = agrees | ((level == k) & (ages == r))
        known = level.isin(*AGE_RANGES)
        return [("bad_level", ~known), ("age_mismatch", known & ~agrees), ("no_boundary", empty("Safety Boundary"))]
    if task == "h20":
        return [("no_hard_stop", empty("Hard Stops")), ("bad_final", ~sec("Final Assessment").rlike(r"(?i)^(Yes|Partial|Wait and save)\b"))]
    return []


def check_household(df: DataFrame, text: str, task: str) -> DataFrame:
    """Adds ``violations``: missing:/duplicate:<label>, out_of_order, first_not:<label>, then the task's own codes."""
    answer = F.coalesce(F.col(text), F.lit(""))
    out = check_sections(df.withColumn("_t", answer), "_t", LABELS[task], *FIRST.get(task, (None, None)))
    own = [(code, F.coalesce(c, F.lit(True))) for code, c in _rules(task, F.col("_t"))]
    if own:
        out = out.withColumn("violations", F.concat("violations", found_codes(own)))
    return out.drop("_t")


def check_dialogue(df: DataFrame, text: str, task: str) -> DataFrame:
    """V31. Adds ``violations``: no_turns, unknown_speaker, bad_opening, bad_closing, not_alternating, and for h19 principles."""
    first, other = SPEAKERS[task]
    turns = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\n(?=[A-Z][A-Za-z ]{0,30}:)"), lambda x: py_strip(x) != "")
    d = df.withColumn("_turns", F.transform(turns, lambda x: py_strip(x)))
    who = F.transform("_turns", lambda x: F.substring_index(x, ":", 1))
    d = d.withColumn("_who", who)
    pairs = F.arrays_zip(F.slice("_who", 1, F.greatest(F.size("_who") - 1, F.lit(0))).alias("a"), F.slice("_who", 2, F.greatest(F.size("_who"), F.lit(1))).alias("b"))
    checks = [("no_turns", F.size("_who") == 0), ("unknown_speaker", F.exists("_who", lambda w: ~w.isin(first, other))),
              ("bad_opening", F.try_element_at("_who", F.lit(1)) != first), ("bad_closing", F.try_element_at("_who", F.lit(-1)) != first),
              ("not_alternating", F.exists(pairs, lambda p: p["a"] == p["b"]))]
    if task == "h19":
        named = F.filter("_turns", lambda x: x.startswith(other + ":") & F.lower(x).contains("safety principle"))
        checks.append(("principles", F.size(named) < 2))
    codes = [F.when(F.coalesce(c, F.lit(True)), F.lit(code)) for code, c in checks]
    return d.withColumn("violations", F.array_compact(F.array(*codes))).drop("_turns", "_who")
