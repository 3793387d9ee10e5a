"""Small tables with awkward rows."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table of texts, with further columns of clashing names."""

    def build(texts, extra: bool = True):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCUMENTS)
        if extra:
            for name in ("spans", "key", "bucket", "metric", "n", "start", "number", "shard", "_hash", "lang_n"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return build


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Writes tables given as DataFrames to a folder, as the given tables lie."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
