"""What stands for a key where rules are measured."""

from starloom.operators import rules


def test_whole_numbers_are_marked_as_they_are(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    checks = [
        rules.Rules("p", primary={"pk": "k"}),
        rules.Rules("c", unique={"u": ("k",)}, references={"ref": ("k", "p", "k")}),
    ]
    found = rules.measured({"p": parent, "c": child}, checks)
    assert {r.rule: r.measured for r in found.collect()} == {"pk": 2, "u": 1, "ref": 2}
    # A hash a rule is made of texts alone.
    assert "xxhash64" not in found._jdf.queryExecution().executedPlan().toString()
