"""Runs that are visible as a whole, and extracts with headings of their own."""

import pytest
import waybill as w
from pyspark.sql import functions as F
from waybill.plans import pipeline


def frame(spark, columns, rows):
    schema = ", ".join(["_ix bigint", *[f"`{c}` string" for c in columns]])
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


@pytest.fixture
def datasets(spark):
    sites = frame(spark, ["code", "city"], [("A", "tulsa"), ("B", ""), ("C", "omaha")])
    carriers = frame(spark, ["CarrierID", "carrier name"], [("1", "x"), ("", "y")])
    return {"sites": (sites, "Facility"), "carriers": (carriers, "Carrier")}


def counts(found):
    return {e: t.count() for e, t in found.tables.items()}


def test_a_run_that_dies_half_way_is_not_seen(spark, datasets, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    assert w.read_modelled(spark, out).tables == {}
    write = pipeline.write_flagged

    def run(mode, dies):
        written = []

        def dying(*args):
            if dies and written:
                raise RuntimeError("lost")
            written.append(1)
            return write(*args)

        monkeypatch.setattr(pipeline, "write_flagged", dying)
        if dies:
            with pytest.raises(RuntimeError):
                w.run_pipeline(datasets, output=out, mode=mode)
            assert written
        else:
            w.run_pipeline(datasets, output=out, mode=mode)

    run("append", True)
    assert w.read_modelled(spark, out).tables == {}
    run("append", False)
    assert counts(w.read_modelled(spark, out)) == {"Facility": 2, "Carrier": 1}
    run("overwrite", True)
    assert counts(w.read_modelled(spark, out)) == {"Facility": 2, "Carrier": 1}
    run("append", False)
    both = w.read_modelled(spark, out)
    assert counts(both) == {"Facility": 4, "Carrier": 2}
    assert both.rejects.count() == 4 and both.report.count() == 4 and both.warnings.count() == 0
    assert both.report.select("run").distinct().count() == 2
    run("overwrite", False)
    assert counts(w.read_modelled(spark, out)) == {"Facility": 2, "Carrier": 1}


def test_first_run_and_one_appended(spark, datasets, tmp_path):
    """The first run is not in a folder of its own; what is appended lies below it."""
    out = str(tmp_path / "out")
    w.run_pipeline(datasets, output=out)
    w.run_pipeline({"sites": datasets["sites"]}, output=out, mode="append")
    assert counts(w.read_modelled(spark, out)) == {"Facility": 4, "Carrier": 1}


def test_no_rejected_rows_and_no_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    clean = frame(spark, ["code", "city"], [("A", "tulsa")])
    w.run_pipeline({"clean": (clean, "Facility"), "none": (clean.limit(0), "Carrier")}, output=out)
    found = w.read_modelled(spark, out)
    assert counts(found) == {"Facility": 1, "Carrier": 0} and found.rejects.count() == 0


def test_files_with_headings_of_their_own(spark, tmp_path):
    texts = {
        "a.csv": "Facility Code,city\nA1,tulsa\nA2,\n",
        "b c.csv": '"City","remark",code\nomaha,"x\ny",B1\n',
        "d+e%20.csv": "code,CITY,code\nold,boise,D1\nshort\n",
        "same.csv": "Facility Code,city\nS1,dayton,surplus\n",
        "headings only.csv": "code,city\n",
        "unknown.csv": "p,q\n1,2\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows, headings = w.read_cells(spark, str(tmp_path))
    found, mappings = w.materialize_cells(rows, headings, w.FACILITY)
    name = F.element_at(F.split("dataset_id", "/"), -1).alias("name")
    kept = {tuple(r) for r in found.records.select(name, "code", "city").collect()}
    assert kept == {
        ("a.csv", "A1", "Tulsa"), ("b c.csv", "B1", "Omaha"), ("d+e%20.csv", "D1", "Boise"), ("same.csv", "S1", "Dayton")
    }
    report = {r.name: (r.records, r.dropped) for r in found.report.select(name, "records", "dropped").collect()}
    assert report == {
        "a.csv": (1, 1), "b c.csv": (1, 0), "d+e%20.csv": (1, 1), "same.csv": (1, 0),
        "headings only.csv": (0, 0), "unknown.csv": (0, 1),
    }
    assert mappings.count() == 6 * 5


def test_overrides_of_one_extract(spark):
    parts = [w.cells_of(frame(spark, ["code", "town", "city"], [("X", "boise", "tulsa")]), f"e{i}") for i in range(3)]
    rows, headings = parts[0]
    for r, h in parts[1:]:
        rows, headings = rows.union(r), headings.union(h)
    overrides = spark.createDataFrame([("e1", "city", "town")], "dataset_id string, target_field string, source_column string")
    found, _ = w.materialize_cells(rows, headings, w.FACILITY, overrides)
    assert {(r.dataset_id, r.city) for r in found.records.collect()} == {("e0", "Tulsa"), ("e1", "Boise"), ("e2", "Tulsa")}


def test_plan_does_not_grow_with_extracts(spark):
    def plan(n):
        rows = spark.range(n * 3).selectExpr("concat('e', id % %d) AS dataset_id" % n, "id AS _ix", "array('k', 'omaha') AS cells")
        headings = spark.range(n).selectExpr(
            "concat('e', id) AS dataset_id", "posexplode(array(if(id % 50 < 25, 'code', 'Code'), concat('city', repeat(' ', int(id % 25))))) AS (col_pos, column)"
        )
        found, _ = w.materialize_cells(rows, headings, w.FACILITY)
        assert found.report.agg(F.sum("records")).first()[0] == 3 * n
        return len(found.report._jdf.queryExecution().optimizedPlan().toString())

    assert plan(2000) < plan(3) * 1.05
