import pytest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows_of(spark):
    """Documents from (id, text[, source]) tuples, with columns that operators must ignore."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
        frame = spark.createDataFrame(full, FIELDS)
        return frame.repartition(partitions).selectExpr("*", "'x' AS id", "1 AS key", "2 AS size", "3 AS block")

    return make
