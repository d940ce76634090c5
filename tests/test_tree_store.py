"""Plans and hand edits applied to a stored tree, with repeated and failed runs."""
import hashlib

import pytest

from lectern.operators.state import drift
from lectern.sources import tree_store


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(spark, files):
    return spark.createDataFrame([(c, p, t) for (c, p), t in files.items()], "course_id string, path string, content string")


def seen(spark, root):
    files, lock = tree_store.read_tree(spark, root)
    return {(r.course_id, r.path): r.content for r in files.collect()}, {(r.course_id, r.path): (r.sha256, r.edited_by_human) for r in lock.collect()}


def test_write_edit_rerun_and_force(spark, tmp_path):
    root = str(tmp_path)
    assert seen(spark, root) == ({}, {})
    one = {(f"c{i}", p): f"{p} of {i}" for i in range(6) for p in ("a", "b")}
    tree_store.apply_plan(rows(spark, one), root, "r1", buckets=4)
    assert seen(spark, root) == (one, {k: (sha(t), False) for k, t in one.items()})
    mine = {("c1", "a"): "mine", ("c2", "extra"): "note"}
    tree_store.apply_edits(rows(spark, mine), root, "hand")
    two = {k: t + " v2" for k, t in one.items() if k[0] != "c5"} | {("c9", "new"): "n"}
    before = tree_store.read_tree(spark, root)
    want = {tuple(r) for r in drift(rows(spark, two), before[0], before[1]).collect()}
    assert {tuple(r) for r in tree_store.apply_plan(rows(spark, two), root, "r2").collect()} == want
    files, lock = seen(spark, root)
    assert files == {**one, **two, **mine}  # what is planned no more stays, an edited file stays as it is
    assert lock == {k: (sha("mine"), True) if k == ("c1", "a") else (sha(t), False) for k, t in two.items()}
    tree_store.apply_plan(rows(spark, two), root, "r3")  # the lock names the edited text now, so it is written over: as in the state it was left in
    tree_store.apply_plan(rows(spark, two), root, "r4", force=True)
    files, lock = seen(spark, root)
    assert files == {**one, **two, ("c2", "extra"): "note"} and lock == {k: (sha(t), False) for k, t in two.items()}


def test_a_repeated_run_and_a_failed_one_change_nothing_twice(spark, tmp_path):
    root, one = str(tmp_path), {(f"c{i}", "a"): str(i) for i in range(9)}
    first = tree_store.apply_plan(rows(spark, one), root, "r1", buckets=4).collect()
    assert tree_store.apply_plan(rows(spark, {("c1", "a"): "other"}), root, "r1").collect() == first and seen(spark, root)[0] == one
    # A run that dies before its pointer has written its folder only.
    two, create = {**one, ("c1", "a"): "1!"}, spark.createDataFrame

    def dies(data, schema=None, *more):
        if schema == tree_store.POINTER and data:
            raise RuntimeError("lost")
        return create(data, schema, *more)
    spark.createDataFrame = dies
    with pytest.raises(RuntimeError):
        tree_store.apply_plan(create([(*k, t) for k, t in two.items()], "course_id string, path string, content string"), root, "r2")
    del spark.createDataFrame
    assert seen(spark, root)[0] == one
    for _ in range(2):
        tree_store.apply_plan(rows(spark, two), root, "r2")
    assert seen(spark, root) == (two, {k: (sha(t), False) for k, t in two.items()})
    pointers = tree_store._pointers(spark, root).filter("seq = 2 AND folder IS NOT NULL").collect()
    assert len(pointers) > 1 and sum("/r2/" in r.folder for r in pointers) == 1  # only the changed bucket was rewritten
