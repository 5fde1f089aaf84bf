"""Several batches against one digest index."""

import hashlib
import uuid

from glycotide.llm.exact_dedup import DigestIndex, exact_dedup, without_copies

FIRST = [(1, "a"), (2, "a"), (3, "b"), (4, None), (None, "n"), (None, "m")]
SECOND = [(9, "a"), (8, "c"), (7, "c"), (6, ""), (5, "n"), (3, "b")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def sha(text) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()


def entries(spark, name) -> dict:
    rows = [(bytes(r.digest).hex(), r.keep_id, r.batch) for r in spark.table(name).collect()]
    assert len({d for d, *_ in rows}) == len(rows)
    return {d: (keep, batch) for d, keep, batch in rows}


def test_second_batch_through_another_object(spark):
    name = f"t_{uuid.uuid4().hex}"
    DigestIndex(spark, name, buckets=5).add(frame(spark, FIRST), batch=1)
    assert entries(spark, name) == {sha("a"): (2, 1), sha("b"): (3, 1), sha(""): (4, 1)}
    again = DigestIndex(spark, name)
    groups = again.add(frame(spark, SECOND), batch=2)
    assert again.buckets == 5 and entries(spark, name) == {sha("a"): (2, 1), sha("b"): (3, 1), sha(""): (4, 1), sha("c"): (8, 2), sha("n"): (5, 2)}
    got = {(r.doc_id, bytes(r.digest).hex()): (r.keep_id, r.group_size) for r in again.resolve(frame(spark, SECOND), groups).collect()}
    assert got == {(9, sha("a")): (2, 1), (8, sha("c")): (8, 2), (7, sha("c")): (8, 2), (6, sha("")): (4, 1), (5, sha("n")): (5, 1), (3, sha("b")): (3, 1)}
    plan = spark.table(name).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # still one bucketed table
    DigestIndex(spark, name).add(frame(spark, SECOND), batch=3)
    assert {batch for _, batch in entries(spark, name).values()} == {1, 2}


def test_reports_and_filters_of_two_batches(spark):
    name, other = (f"t_{uuid.uuid4().hex}" for _ in range(2))
    one = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup(frame(spark, FIRST), name).collect()}
    assert one == {(1, sha("a")): (2, 2, False), (2, sha("a")): (2, 2, True), (3, sha("b")): (3, 1, True), (4, sha("")): (4, 1, True), (None, sha("n")): (None, 1, False), (None, sha("m")): (None, 1, False)}
    two = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup(frame(spark, SECOND), name).collect()}
    assert two == {9: (2, False), 8: (8, True), 7: (8, False), 6: (4, False), 5: (5, True), 3: (3, True)}
    assert {r.doc_id for r in without_copies(frame(spark, FIRST), other).collect()} == {2, 3, 4}
    assert {r.doc_id for r in without_copies(frame(spark, SECOND), other).collect()} == {8, 5, 3}
