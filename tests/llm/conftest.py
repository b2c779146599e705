import pytest


@pytest.fixture(scope="session")
def sf_tiny():
    return "/root/testdata/sf0.001"


#: Names that operators use for columns of their own.
CLASHES = {"row_hash": "x", "fp": "y", "range": "z", "start": "s", "first": "f", "key": "k", "component": "c", "label": "l", "ids": "i"}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, lang, source]) with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(r[0], r[1], (r[2:] + ("en", "src0"))[0], (r[2:] + ("en", "src0"))[1] if len(r) > 3 else "src0") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return df.withColumn("n_chars", F.char_length("text").cast("long")).withColumns({k: F.lit(v) for k, v in CLASHES.items()})

    return make
