"""Schemas of the manifest document, as DDL. Field names are fixed values of the manifest format.

Lessons stay raw JSON text at the top level: a lesson is parsed after it has its own row, and a field of
the wrong type can still be seen in its text.
"""

QUIZ_BLOCKS = ("ARRAY<STRUCT<key: STRING, questions: ARRAY<STRUCT<id: STRING, prompt: STRING, multiSelect: BOOLEAN, "
               "options: ARRAY<STRUCT<id: STRING, label: STRING, correct: BOOLEAN, feedback: STRING>>, "
               "explanation: STRING>>>>")

CHALLENGES = ("ARRAY<STRUCT<id: STRING, language: STRING, buildType: STRING, title: STRING, prompt: STRING, "
              "starter: STRING, solution: STRING, tests: STRING, deployable: BOOLEAN, hints: ARRAY<STRING>, "
              "acceptance_criteria: ARRAY<STRING>, difficulty: BIGINT, bloom: STRING>>")

BRIEF = (
    "STRUCT<id: STRING, title: STRING, kind: STRING, hook: STRING, concept_spec: STRING, artifact_spec: STRING, "
    "exercise_spec: STRING, the_tradeoff: STRING, fading: STRING, dominant_job: STRING, voice_notes: STRING, "
    "est_length: STRING, color: STRING, assessment: STRING, difficulty: STRING, "
    "objectives: ARRAY<STRUCT<bloom: STRING, statement: STRING>>, prerequisites: ARRAY<STRING>, "
    "just_in_time: STRUCT<define: ARRAY<STRING>, footguns: ARRAY<STRING>>, "
    "verify: STRUCT<command: STRING, expect: STRING>, "
    "artifact: STRUCT<id: STRING, consumes: ARRAY<STRING>, terminal: STRING>, "
    f"quiz_blocks: {QUIZ_BLOCKS}, coding_challenges: {CHALLENGES}>")

RESEARCH = (
    "STRUCT<lesson_id: STRING, status: STRING, source_priority: ARRAY<STRING>, "
    "claims: ARRAY<STRUCT<id: STRING, claim: STRING, kind: STRING, mcp: STRING, query: STRING, verify: STRING, "
    "status: STRING, evidence: STRING, value: STRING>>, open_questions: ARRAY<STRING>, frozen_facts: ARRAY<STRING>>")

LESSON = f"id STRING, module STRING, `order` BIGINT, brief {BRIEF}, research {RESEARCH}"
LESSON_PLACE = "id STRING, module STRING, `order` BIGINT"

MANIFEST = (
    "schema_version BIGINT, "
    "course STRUCT<id: STRING, title: STRING, one_line_promise: STRING, overview: STRING, version: STRING, status: STRING, "
    "created: STRING, audience: STRUCT<who: STRING, prior_model: STRING, prerequisites: ARRAY<STRING>>, "
    "terminal_outcomes: ARRAY<STRUCT<id: STRING, bloom: STRING, statement: STRING>>, format: STRING, "
    "length_target: STRUCT<hours: DOUBLE, lessons: BIGINT, weeks: DOUBLE>, credential: STRING, "
    "toolchain: ARRAY<STRING>, routing: STRUCT<backbone_pattern: ARRAY<STRING>, lesson_template: STRING, "
    "guest_patterns: ARRAY<STRING>, security: STRING, notes: STRING>, artifact_ladder: ARRAY<STRING>>, "
    "dag STRUCT<nodes: ARRAY<STRING>, edges: ARRAY<ARRAY<STRING>>>, "
    "glossary ARRAY<STRUCT<term: STRING, def: STRING, first_taught: STRING>>, "
    "concept_ledger ARRAY<STRUCT<concept: STRING, introduced_in: STRING>>, "
    "modules ARRAY<STRUCT<id: STRING, title: STRING, description: STRING, driving_question: STRING, "
    "artifact: STRING, outcome: STRUCT<bloom: STRING, statement: STRING>, traces_to: ARRAY<STRING>, "
    "artifact_rung: BIGINT, depends_on: ARRAY<STRING>, requires_skills: ARRAY<STRING>, "
    "teaches_skills: ARRAY<STRING>, patterns: ARRAY<STRING>, lessons: ARRAY<STRING>, difficulty_band: BIGINT, "
    "retrieval_checkpoint: STRING>>, "
    "lessons ARRAY<STRING>, "
    "cadence STRUCT<pedagogy: STRING, release: STRUCT<mode: STRING, start_date: STRING, timezone: STRING, "
    "schedule: ARRAY<STRUCT<week: BIGINT, publish: ARRAY<STRING>, est_effort_hours: DOUBLE>>, "
    "freshness_policy: STRUCT<onchain_numbers_restale_after_days: BIGINT, applies_to: ARRAY<STRING>>>>, "
    "assessment STRUCT<model: STRING, proof_matrix: ARRAY<STRUCT<outcome: STRING, proven_by: STRING, "
    "evidence: STRING>>, checkpoints: ARRAY<STRUCT<id: STRING, after_module: STRING, type: STRING, spec: STRING>>, "
    "capstone: STRUCT<id: STRING, statement: STRING, requires_skills: ARRAY<STRING>, rubric: ARRAY<STRING>, "
    "traces_to: ARRAY<STRING>, credential: STRING>>, "
    "academy STRUCT<slug: STRING, course_id: STRING, prefix: STRING, title: STRING, description: STRING, "
    "difficulty: STRING, creator: STRING, duration: DOUBLE, xpPerLesson: BIGINT, xpReward: BIGINT, "
    "skills_map: MAP<STRING, STRING>, default_skills: ARRAY<STRING>, extra_course_keys: MAP<STRING, STRING>>")

TEST_CASES = "ARRAY<STRUCT<id: STRING, input: STRING, expectedOutput: STRING>>"
