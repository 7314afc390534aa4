"""What keeps the queries in proportion to their tables."""

from pyspark.sql import functions as F

from checks import extracts
from checks.extracts import SHIPMENT_HEADERS, shipment_extract, shipment_texts
from waybill import SHIPMENT, columns_table, profile
from waybill.functions import name_key, name_tokens, parse_date, wide_trim
from waybill.operators import profiling
from waybill.operators.mapping import name_similarity, score_columns
from waybill.operators.materializing import flag_rows, report_of
from waybill.sources.sinks import write_flagged
from waybill.sources.staging import stage


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small_tables(spark, path):
    spark.range(8).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "1L AS l_suppkey", "1 AS l_linenumber",
        "2.0D AS l_quantity", "10.5D AS l_extendedprice", "0D AS l_discount", "0D AS l_tax",
        "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp'2026-01-02' AS l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(8).selectExpr(
        "id AS o_orderkey", "1L AS o_custkey", "timestamp'2026-01-01' AS o_orderdate", "'x' AS o_rest"
    ).write.parquet(f"{path}/orders.parquet")
    spark.sql("SELECT 1L c_custkey, 2 c_nationkey").write.parquet(f"{path}/customer.parquet")
    spark.sql("SELECT 1L s_suppkey, 3 s_nationkey, 'S' s_name").write.parquet(f"{path}/supplier.parquet")
    return str(path)


def test_both_extracts_come_from_the_same_files(spark, tmp_path):
    at = small_tables(spark, tmp_path)
    plain, planted = shipment_extract(spark, at), shipment_extract(spark, at, planted=True)
    assert plain.columns == planted.columns == [*SHIPMENT_HEADERS.values(), "_ix"]
    assert sorted(plain.inputFiles()) == sorted(planted.inputFiles())
    differ = [r._ix >> 23 for r in planted.exceptAll(plain).collect()]
    assert differ == [0]  # of the orders 0 to 7 only 0 is divided by 97, 83 or 89


def test_extract_moves_only_what_it_shows(spark, tmp_path):
    plan = shipment_texts(spark, small_tables(spark, tmp_path))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "l_shipdate" not in text and "o_rest" not in text
    assert "RoundRobin" not in text


def test_checked_rows_are_written_side_by_side(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)

    @F.udf("string")
    def reason(i):
        return None if i % 2 else "odd"

    rows = spark.range(100, numPartitions=2).select("id", reason("id").alias("reject_reason"))
    written = write_flagged(rows, str(tmp_path / "out"))
    seen = written.groupBy("accepted").count().collect()
    assert sorted((r.accepted, r["count"]) for r in seen) == [(False, 50), (True, 50)]
    assert spark.conf.get(name, None) == before
    assert len(written.inputFiles()) == 4


def test_dates_and_trims_by_their_parts(spark):
    texts = {
        "7-MAR-2024": "2024-03-07", "02/29/2023": None, "2/9/0999": "0999-02-09",
        "sept 1 2020": None, "September\t30 　 2020": "2020-09-30", "31-Apr-2020": None,
        "  Dec 1 1999\n": "1999-12-01", "00/10/2020": None, "0-Jan-2020": None, "": None,
    }
    df = spark.createDataFrame(list(texts.items()), "t string, d string")
    assert df.where(~parse_date(F.col("t")).cast("string").eqNullSafe(F.col("d"))).count() == 0
    trims = [("　a b\x0b", "a b"), ("a\x7f", "a\x7f"), ("é ", "é"), (" ", ""), ("x", "x")]
    df = spark.createDataFrame(trims, "t string, d string")
    assert df.where(wide_trim(F.col("t")) != F.col("d")).count() == 0


def test_wide_tables_are_dealt_out_by_rows(spark, monkeypatch):
    names = [f"c{i}" for i in range(profiling.WIDE)]
    rows = spark.range(0, 40, numPartitions=1).select(
        F.when(F.col("id") < 30, F.col("id")).alias("_ix"),
        *[F.when(F.col("id") % (i + 2) > 0, F.col("id") % 7 + i).alias(n) for i, n in enumerate(names)],
    )
    twice = rows.union(rows.filter("_ix > 25")).coalesce(1)
    whole = profile(twice, names).collect()
    assert "REPARTITION_BY_NUM" not in physical(profiling.column_values(twice, names))
    monkeypatch.setattr(profiling, "TASK_CELLS", 4 * len(names))
    dealt = profiling.column_values(twice, names)
    assert "REPARTITION_BY_NUM" in physical(dealt)
    assert profiling._dealt(twice, names, "_ix").rdd.getNumPartitions() == 22
    assert profile(twice, names).collect() == whole
    narrow = profiling.column_values(twice.drop(names[0]))
    assert "REPARTITION_BY_NUM" not in physical(narrow)


def test_a_staged_write_may_say_how_much_a_task_merges(spark):
    name, seen = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []

    class Table:
        sparkSession, schema = spark, "id bigint"
        write = property(lambda self: self)

        def parquet(self, path):
            seen.append(spark.conf.get(name, None))
            spark.range(1).write.parquet(path)

    before = spark.conf.get(name, None)
    for given in (None, "3m"):
        if given:
            spark.conf.set(name, given)
        try:
            assert stage(Table(), "small", 1 << 20).count() == 1
            assert spark.conf.get(name, None) == (given or before)
        finally:
            spark.conf.unset(name)
    assert seen == [str(1 << 20), "3m"]


def test_headings_are_scored_in_all_tasks(spark):
    headings = ["shipment_id", "To", "Distance Miles", "pickup date of it", "", None, "***", "Cost", "ID"]
    columns = columns_table(spark, {"d": (headings, "Shipment"), "e": (["x"], "nothing")}).coalesce(1)
    scored = score_columns(columns)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert scored.rdd.getNumPartitions() == tasks and "Join" not in physical(scored)
    by_field = None
    for f in SHIPMENT.fields:
        one = columns.filter("entity = 'Shipment'").select(
            F.lit(f.name).alias("target_field"), "col_pos",
            name_similarity(f, name_key(F.col("column")), name_tokens(F.col("column"))).alias("score"),
        )
        by_field = one if by_field is None else by_field.union(one)
    got = scored.select("target_field", "col_pos", "score").collect()
    assert sorted(got) == sorted(by_field.collect()) and len(got) == len(headings) * 11
    assert {r.score for r in got} >= {0.0, 0.85, 0.95, 1.0}


def test_report_leaves_the_rows_of_named_extracts_where_they_are(spark):
    rows = spark.range(20).selectExpr(
        "id AS _ix", "concat('S', id) AS id", "'2026-01-02' AS day", "if(id = 17, 'odd', 'booked') AS status"
    )
    given = {"id": "id", "pickup_date": "day", "promised_date": "day", "status": "status", "delivery_date": "status"}
    flagged = flag_rows(rows, given, SHIPMENT, "a")
    report = report_of(flagged, SHIPMENT, ["a", "b"])
    assert report._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 1
    many = report_of(flagged, SHIPMENT, spark.sql("SELECT 'a' dataset_id UNION ALL SELECT 'b'"))
    assert "strategy=broadcast" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(report.collect()) == sorted(many.collect())
    a = report.filter("dataset_id = 'a'").first()
    assert (a.records, a.dropped, len(a.warnings)) == (19, 1, 8) and a.warnings[7].startswith("Row 8 ")


def test_a_task_gets_a_bounded_number_of_lines(spark, tmp_path, monkeypatch):
    at = small_tables(spark, tmp_path)
    few = shipment_texts(spark, at)
    assert "REPARTITION_BY_NUM" not in physical(few)
    rows = few.collect()
    monkeypatch.setattr(extracts, "TASK_LINES", 1)
    many = shipment_texts(spark, at)
    assert physical(many).count("REPARTITION_BY_NUM") == 2
    assert many.rdd.getNumPartitions() == 8 > spark.sparkContext.defaultParallelism
    assert sorted(many.collect()) == sorted(rows)
