"""A small sound course of our own, and mutations that each break one rule."""
import copy
import json


def brief(lesson_id, **changes):
    base = {
        "id": lesson_id, "title": f"About {lesson_id}", "objectives": [{"bloom": "apply", "statement": "write one test"}],
        "prerequisites": [], "hook": "h", "concept_spec": "c", "artifact_spec": "a", "exercise_spec": "e", "the_tradeoff": "t",
        "just_in_time": {"define": [], "footguns": []}, "assessment": "the test passes", "difficulty": 1, "fading": "worked",
        "dominant_job": "show-how", "verify": {"command": "echo 1", "expect": "1"}, "est_length": "3,000-4,000 words",
    }
    base.update(changes)
    return base


def research():
    return {"status": "verified", "claims": [{"id": "C1", "mcp": "web", "status": "verified"}], "frozen_facts": ["one fact"]}


def sound_course():
    return {
        "schema_version": 1,
        "course": {"id": "stars", "title": "Stars", "one_line_promise": "See far.", "terminal_outcomes": [{"id": "to-1", "bloom": "create", "statement": "s"}],
                   "length_target": {"hours": 2.5, "lessons": 3}, "routing": {"backbone_pattern": ["p"], "guest_patterns": [], "lesson_template": "t"}},
        "dag": {"nodes": ["light", "lens", "scope"], "edges": [["light", "lens"], ["lens", "scope"]]},
        "modules": [
            {"id": "m-one", "title": "One", "artifact_rung": 1, "difficulty_band": 1, "teaches_skills": ["light"], "requires_skills": [], "traces_to": ["to-1"]},
            {"id": "m-two", "title": "Two", "artifact_rung": 2, "difficulty_band": 2, "depends_on": ["m-one"], "teaches_skills": ["lens", "scope"], "requires_skills": ["light"], "traces_to": ["to-1"]}],
        "lessons": [
            {"id": "glass", "module": "m-two", "order": 1, "brief": brief("glass", prerequisites=["welcome", "light"], artifact={"id": "tube", "consumes": ["box"]}), "research": research()},
            {"id": "welcome", "module": "m-one", "order": 1, "brief": brief("welcome", dominant_job="motivate", artifact={"id": "box"}), "research": research()},
            {"id": "focus", "module": "m-two", "order": 2, "brief": brief("focus", prerequisites=["glass"]), "research": research()}],
        "assessment": {"proof_matrix": [{"outcome": "to-1", "proven_by": "cap"}], "capstone": {"id": "cap", "requires_skills": ["scope"]}},
        "cadence": {"release": {"schedule": [{"week": 1, "publish": ["glass", "welcome", "focus"]}]}},
    }


def mutated(change):
    m = copy.deepcopy(sound_course())
    change(m)
    return m


def lesson(m, lesson_id):
    return next(x for x in m["lessons"] if x["id"] == lesson_id)


def _quiz(questions):
    return [{"key": "check", "questions": questions}]


def question(qid="q", right=0, n=3, **changes):
    base = {"id": qid, "prompt": "why?", "multiSelect": False, "explanation": "so",
            "options": [{"id": f"o{i}", "label": "x" * (i + 1), "correct": i == right, "feedback": "no"} for i in range(n)]}
    base.update(changes)
    return base


def _set(path, value):
    def change(m):
        *head, last = path
        at = m
        for p in head:
            at = lesson(m, p[1:]) if isinstance(p, str) and p.startswith("@") else at[p]
        if value is KeyError:
            del at[last]
        else:
            at[last] = value
    return change


# name -> (mutation, rule that must appear and was absent before)
MUTATIONS = {
    "id": (_set(["modules", 0, "id"], "Not Kebab"), "bad_id"),
    "edge": (_set(["dag", "edges"], [["light", "ghost"]]), "dangling_edge"),
    "cycle": (_set(["dag", "edges"], [["light", "lens"], ["lens", "light"], ["lens", "scope"]]), "cycle"),
    "dup module": (_set(["modules", 1, "id"], "m-one"), "duplicate_module"),
    "dep": (_set(["modules", 1, "depends_on"], ["m-nine"]), "unknown_module_dep"),
    "skill": (_set(["modules", 1, "requires_skills"], ["ghost"]), "unknown_module_skill"),
    "forward": (_set(["@welcome", "brief", "prerequisites"], ["glass"]), "forward_lesson_dep"),
    "self": (_set(["@welcome", "brief", "prerequisites"], ["welcome"]), "forward_lesson_dep"),
    "late skill": (_set(["@welcome", "brief", "prerequisites"], ["lens"]), "late_skill"),
    "untaught": (_set(["modules", 1, "teaches_skills"], ["scope"]), None),
    "typo": (_set(["@focus", "brief", "prerequisites"], ["galss"]), "unresolved_prereq"),
    "dup lesson": (_set(["@focus", "id"], "glass"), "duplicate_lesson"),
    "opener": (_set(["@welcome", "brief", "dominant_job"], "show-how"), "bad_opener"),
    "kind": (_set(["@focus", "brief", "kind"], "video"), "bad_kind"),
    "key": (_set(["@focus", "brief", "hook"], KeyError), "missing_keys"),
    "objectives": (_set(["@focus", "brief", "objectives"], []), "no_objectives"),
    "job": (_set(["@focus", "brief", "dominant_job"], "explain"), "bad_job"),
    "no gate": (_set(["@focus", "brief", "assessment"], " "), "gate"),
    "passive": (_set(["@focus", "brief", "assessment"], {"gate": "Watch the recording"}), "gate"),
    "verify": (_set(["@focus", "brief", "verify"], {}), "no_verify"),
    "phrase": (_set(["@focus", "brief", "hook"], "like the Movie Review app"), "blocklist"),
    "difficulty": (_set(["@focus", "brief", "difficulty"], 4), "bad_difficulty"),
    "verb": (_set(["@focus", "brief", "objectives"], [{"statement": "be a Learner"}]), "weak_verb"),
    "target": (_set(["@focus", "brief", "est_length"], "900 to 1,200 words"), "short_target"),
    "rung": (_set(["modules", 0, "artifact_rung"], None), "no_rung"),
    "backward": (_set(["modules", 1, "artifact_rung"], 0), "ladder_backward"),
    "dip": (_set(["modules", 1, "difficulty_band"], 0), "band_dip"),
    "schedule": (_set(["cadence", "release", "schedule", 0, "publish"], ["glass"]), "unscheduled"),
    "capstone": (_set(["assessment", "capstone", "requires_skills"], ["ghost"]), "capstone_untaught"),
    "no capstone": (_set(["assessment", "capstone"], {}), "no_capstone"),
    "length": (_set(["course", "length_target", "lessons"], 9), "length_mismatch"),
    "proof": (_set(["assessment", "proof_matrix"], []), "unproven_outcome"),
    "strange proof": (_set(["assessment", "proof_matrix", 0, "outcome"], "to-9"), "unknown_proof"),
    "no trace": (_set(["modules", 0, "traces_to"], []), "no_trace"),
    "trace": (_set(["modules", 0, "traces_to"], ["to-9"]), "unknown_trace"),
    "no research": (_set(["@focus", "research"], KeyError), "no_research"),
    "surface": (_set(["@focus", "research", "claims"], [{"id": "C", "mcp": "hearsay", "status": "verified"}]), "off_list_claim"),
    "dup artifact": (_set(["@focus", "brief", "artifact"], {"id": "box"}), "duplicate_artifact"),
    "unknown artifact": (_set(["@glass", "brief", "artifact"], {"id": "tube", "consumes": ["ghost"]}), "unknown_consumes"),
    "later artifact": (_set(["@welcome", "brief", "artifact"], {"id": "box", "consumes": ["tube"]}), "backward_consumes"),
    "idle artifact": (_set(["@glass", "brief", "artifact"], {"id": "tube", "consumes": []}), "unconsumed"),
    "guests": (_set(["course", "routing", "guest_patterns"], ["a", "b", "c"]), "routing_budget"),
    "quiz type": (_set(["@focus", "brief", "quiz_blocks"], {"a": 1}), "not_a_list"),
    "empty quiz": (_set(["@focus", "brief", "quiz_blocks"], _quiz([])), "empty_quiz"),
    "question id": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(" ")])), "question_without_id"),
    "dup question": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(), question()])), "duplicate_question"),
    "prompt": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(prompt="")])), "no_prompt"),
    "two options": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(n=2)])), "few_options"),
    "no right": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(right=7)])), "bad_correctness"),
    "explanation": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(explanation="")])), "no_explanation"),
    "skew": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(f"q{i}", right=0) for i in range(6)])), "slot_skew"),
    "longest": (_set(["@focus", "brief", "quiz_blocks"], _quiz([question(f"q{i}", right=2) for i in range(6)])), "longest_tell"),
    "challenge id": (_set(["@focus", "brief", "coding_challenges"], [{"id": "Bad Id", "language": "rust"}]), "bad_challenge_id"),
    "challenge lang": (_set(["@focus", "brief", "coding_challenges"], [{"id": "a", "language": "go"}]), "bad_language"),
    "challenge files": (_set(["@focus", "brief", "coding_challenges"], [{"id": "a", "language": "rust"}]), "missing_reference"),
}


def texts():
    """(path, value): the sound course and one course per mutation, each under its own id."""
    rows = []
    for name, change in {"sound": lambda m: None, **{k: v[0] for k, v in MUTATIONS.items()}}.items():
        m = mutated(change)
        m["course"]["id"] = "case-" + name.replace(" ", "-")
        rows.append((f"{name}/manifest.json", json.dumps(m)))
    return rows
