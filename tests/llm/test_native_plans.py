"""Native operators run no Python; the others run it in Arrow batches only."""

import pytest

from tessera.llm import decontam, quality

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module", [decontam, quality])
def test_native(module):
    with open(module.__file__) as f:
        text = f.read()
    for word in ("InPandas", "InArrow", "udf", "rdd", "numpy", "pandas", "pyarrow"):
        assert word not in text


def test_scans_generate_in_one_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = quality.metrics(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text
