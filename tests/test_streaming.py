import waybill as w
from pyspark.sql import types as T
from waybill.streaming import materialize_stream


def test_arriving_files_are_checked_like_a_batch(spark, tmp_path):
    landing, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    landing.mkdir()
    schema = T.StructType([
        T.StructField("_ix", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("code", "city", "state")],
    ])
    mapping = {"code": "code", "city": "city", "state": "state"}

    def run():
        stream = spark.readStream.schema(schema).csv(str(landing))
        materialize_stream(stream, mapping, w.FACILITY, str(out), str(check)).awaitTermination()
        kept = spark.read.parquet(f"{out}/accepted=true")
        return sorted((r._ix, r.code, r.city, r.state) for r in kept.collect())

    (landing / "1.csv").write_text("1,A,DAYTON,oh\n2,B,,mn\n")
    assert run() == [(1, "A", "Dayton", "OH")]
    (landing / "2.csv").write_text("3,C,st. paul,mn\n")
    assert run() == [(1, "A", "Dayton", "OH"), (3, "C", "St. Paul", "MN")]
    assert spark.read.parquet(f"{out}/accepted=false").first().reject_reason == "missing_city"
