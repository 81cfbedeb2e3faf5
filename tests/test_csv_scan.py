"""The scan that finds the headers of CSV files."""

from starloom.sources import csv_files


def test_lines_are_not_sorted_to_find_headers(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("\n \nx,y\n1,2\n")
    found = csv_files._per_file(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert [row["first"]["value"] for row in found.collect()] == ["x,y"] * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortShuffle", "") and "ObjectHashAggregate" in plan
