"""The registered corpus queries and the pipeline."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from compare import difference  # noqa: E402
from starloom.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), SMALL, ORACLE_SQL[name]) == ""


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
            assert docs.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "jaccard_join", "mixing", "packing"]
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1]
    last = spark.read.parquet(f"{tmp_path}/packing")
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(last.columns)


def test_run_applies_the_stages(spark):
    # Copies of documents are told apart by nothing but their count.
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.where("start = 0").count() > 0
    again = corpus_pipeline.run(spark, SMALL)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert rows.select(*key).exceptAll(again.select(*key)).isEmpty()


def test_stages_keep_the_callers_columns_and_their_values(spark, tmp_path):
    """Columns named like those a stage makes for itself come back as they were."""
    import datetime

    own = ["lang_pred", "score", "_id", "_n", "_size", "_source", "_low", "_copy", "_spare", "_rows", "a`b", "held.out"]
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [
        (*row, *[f"{name} {row['doc_id']}" for name in own], datetime.date(2020, 1, 1 + (row["doc_id"] or 0) % 28))
        for row in documents.collect()
    ]
    fields = ", ".join("`" + f.name + "` " + f.dataType.simpleString() for f in documents.schema)
    made = ", ".join("`" + name.replace("`", "``") + "` string" for name in own)
    docs = spark.createDataFrame(rows, f"{fields}, {made}, day date")
    columns = docs.columns
    expected = {row[0]: tuple(row) for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        found = docs.collect()
        assert found and all(tuple(row) == expected[row[0]] for row in found)


def _jaccard_folders(spark):
    from starloom import workspace

    return set(Path(workspace._own(spark)).glob("jaccard-*"))


def test_deduplication_drops_what_is_read_no_more(spark):
    from starloom.llm import jaccard

    texts = [f"{k // 4} " + " ".join(f"w{k // 4 * 40 + i}" for i in range(40)) + f" end{k % 4}" for k in range(120)]
    rows = [*enumerate(texts), (500, texts[0]), (None, texts[0]), (501, None), (502, " ")]
    before = _jaccard_folders(spark)
    found = jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    left = {path.name.rsplit("-", 1)[0] for path in _jaccard_folders(spark) - before}
    # The prefixes and posting lists, nearly all of the space.
    assert left and not left & {"jaccard-signatures", "jaccard-classes", "jaccard-coming"}
    component = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert component == {**{k: k // 4 * 4 for k in range(120)}, 500: 0, None: 0, 501: 501, 502: 502}


def test_mixing_leaves_the_texts_where_they_are(spark):
    from collections import Counter

    from pyspark.sql import functions as F
    from starloom import session
    from starloom.llm import mixing

    words = F.expr("concat_ws(' ', transform(sequence(0, id % 7), x -> concat('w', x)))")
    rows = spark.range(40_000).select(
        # Shared ids, rows alike, null ids and sources, texts without words.
        F.when(F.col("id") % 11 > 0, F.col("id") % 30_000).alias("doc_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
        F.when(F.col("id") % 13 > 1, words).when(F.col("id") % 13 > 0, F.lit(" ")).alias("text"),
    )
    with session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "16k"):
        out = mixing.repeated(rows)
        out.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in out.collect())
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    expected = Counter()
    for r in mixing._taken(rows, mixing.BLOCK_WORDS).collect():
        if r["size"]:
            expected[r["doc_id"], r["source"], r["size"]] += int(r["taken"] / r["size"] + 0.5)
    assert found == +expected


def _shuffles_of_each_query(spark, monkeypatch, stage, rows):
    """Shuffles in the plan of every table that a stage writes, and in that of its result."""
    from pyspark.sql.readwriter import DataFrameWriter
    from starloom import session

    found, write = [], DataFrameWriter.parquet

    def planned(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    def recorded(self, path, *args, **more):
        found.append(planned(self._df))
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    with session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = stage(rows)
        found.append(planned(out))
        out.count()
    return found


def test_no_query_of_a_stage_has_many_shuffles(spark, monkeypatch):
    """The driver holds the plan, the tasks and a thread or more for each of them."""
    from starloom.llm import jaccard, mixing

    texts = [f"{k // 4} " + " ".join(f"w{k // 4 * 40 + i}" for i in range(40)) + f" end{k % 4}" for k in range(40)]
    rows = spark.createDataFrame([(k, text, f"s{k % 3}") for k, text in enumerate(texts)], "doc_id long, text string, source string")
    for stage in (jaccard.one_of_each, mixing.repeated):
        found = _shuffles_of_each_query(spark, monkeypatch, stage, rows)
        assert 0 < max(found) <= 16


def test_driver_broadcasts_compressed_arrays():
    import pickle

    import numpy as np
    from starloom.llm.jaccard import Packed

    values = np.zeros(1 << 22, dtype="<u2")
    values[::1000] = 7
    sent = pickle.dumps(Packed(values))
    assert len(sent) < values.nbytes // 20
    assert pickle.loads(sent).values.dtype == values.dtype and (pickle.loads(sent).values == values).all()
