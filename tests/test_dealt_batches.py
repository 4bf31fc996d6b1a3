"""How a micro-batch of reports is dealt over the cores."""

import glob

from pyspark.sql import functions as F

from medlake.streaming import jobs


def test_a_batch_of_one_file_is_dealt_over_the_cores(spark, tmp_path):
    rows = spark.range(200).select(F.format_string("r/%s_report.txt", "id").alias("path"), F.lit("Patient ID: P-1. " * 9).alias("raw_text"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    jobs.structure_stream(arriving, f"{tmp_path}/silver", f"{tmp_path}/offsets").awaitTermination()
    assert len(glob.glob(f"{tmp_path}/silver/batch=0/part-*")) > 1
    assert spark.read.parquet(f"{tmp_path}/silver").count() == 200
