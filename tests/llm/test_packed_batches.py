"""Rows that are handed to Python at once."""

import pyarrow as pa

from wattline.llm import chosen_path, common, language

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def sizes(df):
    """The rows of each batch that ``df.mapInArrow`` gets."""
    return [r[0] for r in df.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in bs), "n bigint").collect()]


def test_texts_are_packed_in_bounded_batches(spark):
    rows = spark.range(5000, numPartitions=1).selectExpr("id AS doc_id", "concat('some text ', id) AS text", "'en' AS lang")
    before = spark.conf.get(KEY)
    steps = [
        lambda: common.annotated(rows, "text", ["doc_id"], common.schema("n int"), lambda: lambda texts: [[len(t) for t in texts]]),
        lambda: language.frequencies(rows.select("lang", "text")),
        lambda: chosen_path.confirmed(rows.selectExpr("doc_id AS a", "doc_id + 1 AS b"), rows.selectExpr("doc_id AS cid", "text AS t"), 3, 80),
    ]
    try:
        for step in steps:
            spark.conf.set(KEY, 10_000)
            step()
            assert max(sizes(rows)) <= common.PACKED and sum(sizes(rows)) == 5000
        spark.conf.set(KEY, 100)
        steps[0]()
        assert max(sizes(rows)) == 100  # a smaller setting stays
    finally:
        spark.conf.set(KEY, before)
