import random
from collections import Counter

from pyspark.sql import functions as F

from starloom.operators.rules import Rules, measured


def test_same_counts_as_plain_loops(spark):
    rng = random.Random(3)
    pick = lambda values: rng.choice([None, *values])
    parents = [(pick(range(12)), pick("ab")) for _ in range(40)]
    children = [(pick(range(6)), pick("abc"), pick("abc"), pick(range(15))) for _ in range(400)]
    frames = {
        "parent": spark.createDataFrame(parents, "id long, name string"),
        # Another type than the column it refers to.
        "child": spark.createDataFrame(children, "a int, b string, c string, ref int"),
    }
    rules = [
        Rules("parent", row={"all": F.lit(True)}, primary={"pk": "id"}),
        Rules(
            "child",
            row={"b": F.col("b").isNull(), "a": F.col("a") > 3, "all": F.lit(True)},
            unique={"bc": ("b", "c"), "abc": ("a", "b", "c")},
            references={"ref": ("ref", "parent", "id")},
        ),
    ]
    found = {(r.table_name, r.rule): r.measured for r in measured(frames, rules).collect()}
    ids = Counter(p[0] for p in parents)
    held = set(ids)
    assert found == {
        ("parent", "all"): 40,
        ("parent", "pk"): sum(n > 1 or k is None for k, n in ids.items()),
        ("child", "b"): sum(c[1] is None for c in children),
        ("child", "a"): sum(c[0] is not None and c[0] > 3 for c in children),
        ("child", "all"): 400,
        ("child", "bc"): sum(n > 1 for n in Counter(c[1:3] for c in children).values()),
        ("child", "abc"): sum(n > 1 for n in Counter(c[:3] for c in children).values()),
        ("child", "ref"): sum(c[3] is not None and c[3] not in held for c in children),
    }


def test_nulls_in_other_places_make_other_keys(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), (None, None)], "x string, y string")
    (found,) = measured({"t": rows}, [Rules("t", unique={"xy": ("x", "y")})]).collect()
    assert found.measured == 0


def test_no_rows(spark):
    none = spark.createDataFrame([], "x string")
    rules = [Rules("t", row={"all": F.lit(True)}, unique={"u": ("x",)}, primary={"p": "x"}, references={"r": ("x", "t", "x")})]
    found = measured({"t": none}, rules).collect()
    assert sorted((r.number, r.rule, r.measured) for r in found) == [(0, "all", 0), (1, "u", 0), (2, "p", 0), (3, "r", 0)]
