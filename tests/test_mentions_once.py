"""The extraction is cleaned once, however many arrivals read it."""

from pyspark.sql import functions as F

from ledgerloom.plans import entities as plan
from ledgerloom.plans.catalog import Tables


def test_arrivals_read_a_stored_extraction(spark, tmp_path, monkeypatch):
    spark.range(4).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    seen = spark.sparkContext.accumulator(0)

    def label(k):
        seen.add(1)
        return "Tradeplace" if k % 2 else "Building"

    made = F.udf(label).asNondeterministic()
    rows = spark.range(4).select(F.col("id").alias("documentId"), made("id").alias("label"), F.lit("x").alias("entityId"))
    monkeypatch.setattr(plan, "extractions", lambda t: None)
    monkeypatch.setattr(plan.entities, "extracted_nodes", lambda frame, doc: rows)
    assert plan.incremental_mentions(Tables(spark, str(tmp_path))).count() == 4
    assert seen.value == 4
