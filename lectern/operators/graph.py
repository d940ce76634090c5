"""Rules on the prerequisite graph.

Tables: modules(course_id, module_id, mod_idx), module_deps(…, module_id, dep),
module_skills(…, module_id, skill, role), nodes(course_id, node), edges(course_id, src, dst),
lessons(course_id, lesson_id, module_id, mod_idx, ord, array_pos),
prereqs(course_id, lesson_id, mod_idx, ord, array_pos, pre, kind), first_taught(course_id, skill, at).
"""
import sys
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.text import KEBAB
from lectern.operators.flags import HARD, flag, union
from lectern.operators.order import position_key
from lectern.session import cut_lineage

# Task functions travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bad_ids(ids: DataFrame) -> DataFrame:
    """ids(course_id, kind, id)"""
    return flag(ids.filter(F.col("id").isNotNull() & ~F.col("id").rlike(KEBAB)), "dag", "bad_id", HARD,
                F.col("id"), F.col("kind"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("course_id", column).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_modules(modules: DataFrame) -> DataFrame:
    return flag(duplicates(modules, "module_id"), "dag", "duplicate_module", HARD, F.col("module_id"))


def dangling_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    known = nodes.select("course_id", "node").distinct()
    ends = edges.select("course_id", "src", "dst", F.explode(F.array("src", "dst")).alias("node"))
    lost = ends.join(known, ["course_id", "node"], "left_anti").select("course_id", "src", "dst").distinct()
    return flag(lost, "dag", "dangling_edge", HARD, F.concat_ws("->", "src", "dst"))


def _known_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    known = nodes.select("course_id", "node").distinct()
    return (edges.select("course_id", "src", "dst").distinct()
            .join(known.withColumnRenamed("node", "src"), ["course_id", "src"], "left_semi")
            .join(known.withColumnRenamed("node", "dst"), ["course_id", "dst"], "left_semi"))


PLACES = "course_id {}, node string, place int, depth bigint"
ROW_SIZE = 1 << 16  # nodes and edges of a graph that may be worked out in one row


def settled(nodes: list, edges: list) -> list[tuple]:
    """(node, place, depth) of one graph in time linear in its size. Nodes become free first in, first out: unfed ones in their own order, then each
    when the last edge into it has been followed. Place and depth (longest path into it) are null for nodes that never become free."""
    depth, waits, after = dict.fromkeys(n for n in nodes if n is not None), {}, {}
    for a, b in edges:
        if a in depth and b in depth:
            waits[b] = waits.get(b, 0) + 1
            after.setdefault(a, []).append(b)
    free = [n for n in depth if n not in waits]
    depth.update(dict.fromkeys(free, 0))
    for n in free:  # grows as it is read; depths never fall along it, so the last edge into a node comes from the deepest one
        for m in after.get(n, ()):
            waits[m] -= 1
            if not waits[m]:
                depth[m] = depth[n] + 1
                free.append(m)
    place = {n: i for i, n in enumerate(free)}
    return [(n, place.get(n), d) for n, d in depth.items()]


def _settle(batches):
    kinds = [pa.string(), pa.int32(), pa.int64()]
    for b in batches:
        courses, out = [], []
        for i, (nodes, edges) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
            found = settled(nodes or [], [(e[0], e[1]) for e in edges or [] if e and len(e) > 1])
            out += found
            courses += [i] * len(found)
        if out:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(courses)), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], names=["course_id", "node", "place", "depth"])


def places(graphs: DataFrame) -> DataFrame:
    """graphs(course_id, nodes, edges), a graph in a row -> (course_id, node, place, depth), without a shuffle."""
    kind = graphs.schema["course_id"].dataType.simpleString()
    return graphs.select("course_id", "nodes", "edges").mapInArrow(_settle, PLACES.format(kind))


def cycle_flags_in_rows(graphs: DataFrame) -> DataFrame:
    return flag(places(graphs).filter("place IS NULL"), "dag", "cycle", HARD, F.col("node"))


def _split(nodes: DataFrame, edges: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Graphs of at most `limit` nodes and edges as rows, and the nodes and edges of the others."""
    sizes = nodes.select("course_id").union(edges.select("course_id")).groupBy("course_id").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    big = cut_lineage(sizes.select("course_id"))
    key = "course_id"
    fits = lambda df: df.join(big, key, "left_anti")
    rows = (fits(nodes).groupBy(key).agg(F.collect_list("node").alias("nodes"))
            .join(fits(edges).groupBy(key).agg(F.collect_list(F.array("src", "dst")).alias("edges")), key, "left"))
    return rows, nodes.join(big, key, "left_semi"), edges.join(big, key, "left_semi")


PEELS = 8  # rounds between two checkpoints


def _peeled(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large graphs, all together: (course_id, node, depth) of nodes that become free, and the edges that never do.

    An edge survives a round while its source still has an incoming edge. PEELS rounds run as one job whose result is checkpointed in the
    shared folder; an edge carries the number of rounds it has survived. The longest path decides how many jobs there are.
    """
    live = cut_lineage(_known_edges(nodes, edges).withColumn("age", F.lit(0).cast("bigint")))
    gone, left = [], live.count()
    while left:
        for _ in range(PEELS):
            fed = live.filter("NOT done" if "done" in live.columns else "true").select("course_id", F.col("dst").alias("src")).distinct().withColumn("fed", F.lit(True))
            was = F.col("done") if "done" in live.columns else F.lit(False)
            live = (live.withColumn("_was", was).join(fed, ["course_id", "src"], "left")
                    .select("course_id", "src", "dst", F.when(F.col("_was") | F.col("fed").isNull(), F.col("age")).otherwise(F.col("age") + 1).alias("age"),
                            (F.col("_was") | F.col("fed").isNull()).alias("done")))
        live = cut_lineage(live)
        gone.append(live.filter("done").drop("done"))
        live = live.filter("NOT done").drop("done")
        now = live.count()
        if now == left:
            break
        left = now
    reached = reduce(DataFrame.unionByName, gone).groupBy("course_id", F.col("dst").alias("node")).agg(F.max(F.col("age") + 1).alias("depth")) if gone else None
    free = nodes.select("course_id", "node").distinct().join(_targets(live), ["course_id", "node"], "left_anti")
    deep = F.lit(0).cast("bigint")
    return (free.withColumn("depth", deep) if reached is None else free.join(reached, ["course_id", "node"], "left").withColumn("depth", F.coalesce("depth", deep))), live


def _targets(live: DataFrame) -> DataFrame:
    return live.select("course_id", F.col("dst").alias("node")).distinct()


def cycle_leftovers(nodes: DataFrame, edges: DataFrame, limit: int = ROW_SIZE) -> DataFrame:
    """Nodes that repeated removal of unfed nodes never reaches: cycles and what lies downstream."""
    rows, more_nodes, more_edges = _split(nodes, edges, limit)
    small = places(rows).filter("place IS NULL").select("course_id", "node")
    return small if more_edges.isEmpty() else small.union(_targets(_peeled(more_nodes, more_edges)[1]))


def cycle_flags(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return flag(cycle_leftovers(nodes, edges), "dag", "cycle", HARD, F.col("node"))


def topo_depth(nodes: DataFrame, edges: DataFrame, limit: int = ROW_SIZE) -> DataFrame:
    """depth = length of the longest path into a node; cycles and what follows them are left out."""
    rows, more_nodes, more_edges = _split(nodes, edges, limit)
    small = places(rows).filter("place IS NOT NULL").select("course_id", "node", "depth")
    return small if more_nodes.isEmpty() else small.union(_peeled(more_nodes, more_edges)[0])


def unknown_module_deps(module_deps: DataFrame, modules: DataFrame) -> DataFrame:
    known = modules.select("course_id", F.col("module_id").alias("dep")).distinct()
    return flag(module_deps.join(known, ["course_id", "dep"], "left_anti"), "dag", "unknown_module_dep", HARD,
                F.col("module_id"), F.col("dep"))


def unknown_module_skills(module_skills: DataFrame, nodes: DataFrame) -> DataFrame:
    known = nodes.select("course_id", F.col("node").alias("skill")).distinct()
    return flag(module_skills.join(known, ["course_id", "skill"], "left_anti"), "dag", "unknown_module_skill", HARD,
                F.col("module_id"), F.col("skill"))


def forward_lesson_deps(prereqs: DataFrame, lessons: DataFrame) -> DataFrame:
    """A lesson needs one at the same or a later place. With duplicate ids the last place counts."""
    places = (lessons.groupBy("course_id", F.col("lesson_id").alias("pre"))
              .agg(F.max(position_key()).alias("pre_key")))
    late = (prereqs.filter("kind = 'lesson'").join(places, ["course_id", "pre"])
            .filter(F.col("pre_key") >= position_key()))
    return flag(late, "dag", "forward_lesson_dep", HARD, F.col("lesson_id"), F.col("pre"))


def _skill_needs(prereqs: DataFrame, first_taught: DataFrame) -> DataFrame:
    return (prereqs.filter("kind = 'skill'")
            .join(first_taught.withColumnRenamed("skill", "pre"), ["course_id", "pre"], "left"))


def untaught_skills(prereqs: DataFrame, first_taught: DataFrame) -> DataFrame:
    return flag(_skill_needs(prereqs, first_taught).filter("at is null"), "dag", "untaught_skill", HARD,
                F.col("lesson_id"), F.col("pre"))


def late_skills(prereqs: DataFrame, first_taught: DataFrame) -> DataFrame:
    return flag(_skill_needs(prereqs, first_taught).filter("at > mod_idx"), "dag", "late_skill", HARD,
                F.col("lesson_id"), F.col("pre"))


def unresolved_prereqs(prereqs: DataFrame) -> DataFrame:
    return flag(prereqs.filter("kind = 'unknown'"), "dag", "unresolved_prereq", HARD, F.col("lesson_id"), F.col("pre"))


def prereq_flags(lessons: DataFrame, nodes: DataFrame, teaches: DataFrame) -> DataFrame:
    """forward_lesson_deps, untaught_skills, late_skills and unresolved_prereqs in one join of what lessons ask for with what a course names."""
    def named(df: DataFrame, name: str, **known: Column) -> DataFrame:
        kinds = {"kind": "string", "place": "struct<m:bigint,o:bigint,p:bigint>", "at": "int"}
        return df.select("course_id", F.col(name).alias("pre"), *[known.get(k, F.lit(None)).cast(v).alias(k) for k, v in kinds.items()])

    names = (union(named(lessons, "lesson_id", kind=F.lit("lesson"), place=position_key()), named(nodes, "node", kind=F.lit("skill")),
                   named(teaches, "skill", at=F.col("mod_idx")))
             .groupBy("course_id", "pre").agg(F.min("kind").alias("kind"), F.max("place").alias("place"), F.min("at").alias("at")))
    asked = lessons.select("course_id", "lesson_id", "mod_idx", position_key().alias("key"), F.explode("brief.prerequisites").alias("pre"))
    rule = (F.when((F.col("kind") == "lesson") & (F.col("place") >= F.col("key")), "forward_lesson_dep")
            .when((F.col("kind") == "skill") & F.col("at").isNull(), "untaught_skill").when((F.col("kind") == "skill") & (F.col("at") > F.col("mod_idx")), "late_skill")
            .when(F.col("kind").isNull(), "unresolved_prereq"))
    found = asked.join(names, ["course_id", "pre"], "left").withColumn("rule", rule).filter("rule IS NOT NULL")
    return flag(found, "dag", F.col("rule"), HARD, F.col("lesson_id"), F.col("pre"))


def dag_flags(t) -> DataFrame:
    return union(
        bad_ids(t["ids"]), dangling_edges(t["nodes"], t["edges"]), cycle_flags_in_rows(t["graphs"]),
        duplicate_modules(t["modules"]), unknown_module_deps(t["module_deps"], t["modules"]),
        unknown_module_skills(t["module_skills"], t["nodes"]), prereq_flags(t["lessons"], t["nodes"], t["teaches"]))
