"""Running the checks: tables in, one flags table out."""
from collections.abc import Callable

from pyspark.sql import DataFrame

from lectern.operators import briefs, challenges, corpus, course, drafts, graph, quiz
from lectern.operators.flags import union

Check = Callable[[dict, DataFrame], DataFrame]

CHECKS: dict[str, Check] = {
    "manifest": lambda t, phrases: t["repeated_courses"],
    "dag": lambda t, phrases: graph.dag_flags(t),
    "briefs": lambda t, phrases: union(briefs.brief_flags(t, phrases), quiz.quiz_flags(t), challenges.challenge_flags(t)),
    "ladder": lambda t, phrases: course.ladder_flags(t),
    "capstone": lambda t, phrases: course.capstone_untaught(t["courses"], t["capstone_skills"], t["teaches"]),
    "outcomes": lambda t, phrases: course.outcome_flags(t),
    "research": lambda t, phrases: course.research_flags(t),
    "artifacts": lambda t, phrases: course.artifact_flags(t),
    "length": lambda t, phrases: course.length_mismatch(t["courses"]),
    "routing": lambda t, phrases: course.routing_budget(t["courses"]),
    # Files stand beside the manifests: tables["challenge_files"] and tables["test_files"] come from `read_challenge_files`.
    "challenges": lambda t, phrases: union(challenges.missing_files(t["challenges"], t["challenge_files"]),
                                           challenges.bad_tests(t["challenges"], t["test_files"])),
}


def run_checks(tables: dict, phrases: DataFrame, names=None) -> DataFrame:
    """All checks over all courses, or those named; "challenges" runs where its files are among the tables. Adding a check is
    adding a function to CHECKS."""
    needs = {"challenges": "challenge_files", "manifest": "repeated_courses"}
    names = names or [n for n in CHECKS if n not in needs or needs[n] in tables]
    return union(*[CHECKS[n](tables, phrases) for n in names])


def draft_flags(texts: DataFrame, phrases: DataFrame, stems: DataFrame | None = None) -> DataFrame:
    """All draft rules. stems (course_id, stem, kind, opener) adds the rule that needs the manifest."""
    flags = union(drafts.all_findings(texts), corpus.draft_blocklist(texts, phrases))
    return flags if stems is None else union(flags, drafts.late_first_do(drafts.draft_metrics(texts), stems))
