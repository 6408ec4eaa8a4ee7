import glob

from pyspark.sql import functions as F

from clickflow.operators.numbering import number_by


def test_ranges_grow_in_number_not_in_size(spark, tmp_path):
    rows = spark.range(5000).select(F.lit("log").alias("logFile"), (F.col("id") * 7919 % 5000).alias("position"))
    found = number_by(rows, ["logFile", "position"], "place", f"{tmp_path}/rows", range_rows=250).collect()
    assert {(r.position, r.place) for r in found} == {(n, n + 1) for n in range(5000)}
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{tmp_path}/rows/part-*")]
    assert len(sizes) == 20 and sum(sizes) == 5000 and max(sizes) < 1000


def test_nothing_is_numbered_too(spark, tmp_path):
    assert number_by(spark.range(0), ["id"], "place", f"{tmp_path}/rows").count() == 0
