"""Documents are parsed once and each rule is asked once, however the plan is optimized; names of fields may have line breaks."""

import json

from pyspark.sql import functions as F

from glycotide.operators.schema_rules import breaking, violations
from glycotide.plans import catalogue


def test_plan_repeats_nothing(spark):
    plan = catalogue.QUERIES["q_schema_violations"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1
    assert plan.count("as map<string,variant>") == 2  # the document, and its props


def test_breaking_keeps_rows_that_break_rules(spark):
    schema = {"type": "object", "additionalProperties": False, "properties": {"n": {"type": "integer", "minimum": 1}}}
    rows = spark.createDataFrame([(1, json.dumps({"n": 1})), (2, json.dumps({"n": 0})), (3, json.dumps({"a\nb": 1})), (4, None), (5, "[]")], "n int, j string").select("n", F.parse_json("j").alias("v"))
    got = {r.n: r.violations for r in breaking(rows, violations(F.col("v"), schema)).collect()}
    assert got == {2: ["$.n: minimum"], 3: ["$: additional a\nb"], 5: ["$: type"]}
