"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import waybill as w
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from waybill.operators import questions as q
from waybill.operators.mapping import score_columns
from waybill.operators.materializing import flag_rows, split_flagged
from waybill.plans.entities import SHIPMENT_STATUS
from waybill.sources.sinks import write_flagged
from waybill.sources.staging import new_staging_path

from .extracts import (
    CARRIER_HEADERS,
    FACILITY_HEADERS,
    SHIPMENT_HEADERS,
    carrier_extract,
    column_catalogue,
    conversation_questions,
    facility_extract,
    mapping_overrides,
    question_table,
    shipment_extract,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
FIELDS = w.SHIPMENT.field_names


_MODELLED: dict[tuple, tuple[str, w.Materialized]] = {}


def _modelled(spark: SparkSession, sf_dir: str, planted: bool, dataset_id: str) -> w.Materialized:
    """The messy extract, materialized once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, planted)
    if key in _MODELLED:
        path, found = _MODELLED[key]
        try:
            spark.read.parquet(path)
            return found
        except AnalysisException:  # the staging folder was emptied
            pass
    path = new_staging_path(spark, "modelled")
    extract = shipment_extract(spark, sf_dir, planted)
    flagged = write_flagged(flag_rows(extract, SHIPMENT_HEADERS, w.SHIPMENT, dataset_id), path)
    found = split_flagged(flagged, w.SHIPMENT, dataset_id)
    _MODELLED[key] = (path, found)
    return found


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelled shipments of the messy extract."""
    return _modelled(spark, sf_dir, False, "extract").records


def planted(spark: SparkSession, sf_dir: str) -> w.Materialized:
    return _modelled(spark, sf_dir, True, "shipments")


# ------------------------------------------------------------------- sources


def _write_csv(df: DataFrame, label: str) -> str:
    path = new_staging_path(df.sparkSession, label)
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        emptyValue="",
    )
    return path


def read_csv_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    path = _write_csv(
        c.select(
            F.col("c_custkey").alias(" key "),
            F.format_string('%s, "%s"', "c_name", "c_mktsegment").alias("quoted"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
            F.format_string("%s\nnation %d", "c_name", "c_nationkey").alias("lines"),
            F.format_string(" \t%s  ", "c_mktsegment").alias("padded"),
        ),
        "customers-csv",
    )
    return w.read_extract(spark, path).drop("_ix")


def read_csv_documents(
    spark: SparkSession, sf_dir: str, multi_line: bool | str = True
) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    path = _write_csv(d.select("doc_id", "text", "lang", "source"), "documents-csv")
    return w.read_extract(spark, path, multi_line).select(
        "doc_id", F.md5("text").alias("text_md5"), "lang", "source"
    )


def read_csv_split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    path = _write_csv(e.select("event_id", "user_id", "event_type", "value", "props"), "events-csv")
    return w.read_extract(spark, path, multi_line=False).drop("_ix")


def read_csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files whose headers differ in order, number and names."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.format_string("%s, of\n%d", "s_name", "s_nationkey").alias("name"),
        F.col("s_suppkey").alias("key"),
        F.lit("x").alias("more"),
    )
    paths = [_write_csv(customers, "mixed-csv"), _write_csv(suppliers, "mixed-csv")]
    return w.read_extract(spark, paths).drop("_ix")


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("_ix", F.col("o_orderkey"))
    return w.preview(w.as_text(orders))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dataset_summary(
        {
            "shipments": (shipment_extract(spark, sf_dir), "Shipment"),
            "carriers": (carrier_extract(spark, sf_dir), "Carrier"),
            "documents": (table(spark, sf_dir, "documents"), None),
        }
    )


# ----------------------------------------------------------------- profiling


def _shown(profile: DataFrame, *more: str) -> DataFrame:
    return profile.select(
        *more,
        "pos",
        "name",
        "inferred_type",
        "null_count",
        "null_rate",
        "distinct_count",
        F.array_join("samples", "|").alias("samples"),
        F.array_join("date_formats", ", ").alias("date_formats"),
        F.array_join("issues", "; ").alias("issues"),
    )


def _profile_table(name: str, key: str) -> Query:
    return lambda spark, sf_dir: _shown(
        w.profile(
            table(spark, sf_dir, name).withColumn("_ix", F.col(key)),
            columns=table(spark, sf_dir, name).columns,
        )
    )


def _messy_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.profile(shipment_extract(spark, sf_dir))


def _profile_shown_of(df: DataFrame, key: str) -> DataFrame:
    return _shown(w.profile(df.withColumn("_ix", F.col(key)), columns=df.columns))


def profile_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table with its columns side by side fifteen times."""
    customers = table(spark, sf_dir, "customer")
    wide = customers.select(
        *[F.col(c).alias(f"{c}_{i}") for i in range(15) for c in customers.columns]
    )
    return _profile_shown_of(wide, "c_custkey_0")


def approximate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of orders by sketches, with whether they are within 3 % of the exact ones."""
    orders = table(spark, sf_dir, "orders")
    found = w.profile(_with_ix(orders, "o_orderkey"), columns=orders.columns, approx=True)
    exact = orders.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("pos"), F.col(c).cast("string").alias("value"))
                    for i, c in enumerate(orders.columns)
                ]
            )
        )
    )
    counted = exact.groupBy("pos").agg(F.count_distinct("value").alias("exact_count"))
    close = F.abs(F.col("distinct_count") - F.col("exact_count")) <= 0.03 * F.col("exact_count")
    return found.join(counted, "pos").select("name", "exact_count", close.alias("within"))


def profile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles of two datasets in one table."""
    found = w.profile_all(
        {
            "orders": (_with_ix(table(spark, sf_dir, "orders"), "o_orderkey"), None),
            "customers": (_with_ix(table(spark, sf_dir, "customer"), "c_custkey"), None),
        }
    )
    return _shown(found, "dataset_id")


def _with_ix(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_ix", F.col(key))


def _finding(prefix: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        issue = F.explode("issues").alias("issue")
        return (
            _messy_profile(spark, sf_dir)
            .select("name", issue)
            .filter(F.col("issue").startswith(prefix))
            .select("name", F.replace("issue", F.lit(prefix), F.lit("")).alias(name))
        )

    return query


# ------------------------------------------------------------------- mapping


def _suggested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.suggest_mappings(column_catalogue(spark, sf_dir))


def _overridden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.apply_overrides(_suggested(spark, sf_dir), mapping_overrides(spark, sf_dir))


def field_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target fields, with how many of the customers' headings name each exactly."""
    fields = w.fields_table(spark)
    exact = (
        score_columns(column_catalogue(spark, sf_dir))
        .filter(F.col("score") == 1.0)
        .groupBy("entity", "target_field")
        .agg(F.count(F.lit(1)).alias("named"))
    )
    return fields.join(exact, ["entity", "target_field"], "left").select(
        "entity", "field_pos", "target_field", "label", "type", "required", "description",
        F.array_join("enum_values", "|").alias("enum_values"),
        F.array_join("synonyms", "|").alias("synonyms"),
        F.coalesce("named", F.lit(0)).cast("bigint").alias("named"),
    )


def column_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        score_columns(column_catalogue(spark, sf_dir))
        .filter(F.col("score") > 0)
        .select("dataset_id", "target_field", "column", "score")
    )


# ----------------------------------------------------------- standardisation


def standardize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"PickupDate": "pickup", "promised_date": "promised", "Delivery Date": "delivery"}
    raw = shipment_extract(spark, sf_dir).select(
        "_ix", *[F.col(f"`{c}`").alias(n) for c, n in columns.items()]
    )
    return w.standardize_dates(raw, list(columns.values())).select(
        "_ix", "pickup_value", "pickup_format", "promised_value", "delivery_value",
        "delivery_format",
    )


def date_format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        w.standardize_dates(shipment_extract(spark, sf_dir), ["PickupDate"])
        .groupBy(F.col("PickupDate_format").alias("format"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def standardize_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"Weight (lbs)": "weight", "Cost USD": "cost", "Distance Miles": "miles",
               "Shipment Status": "status"}
    raw = shipment_extract(spark, sf_dir).select(
        "_ix", *[F.col(f"`{c}`").alias(n) for c, n in columns.items()]
    )
    return w.standardize_numbers(raw, list(columns.values())).select(
        "_ix", *[f"{n}_value" for n in columns.values()]
    )


def canonical_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shipment_extract(spark, sf_dir)
    return w.canonicalize_enum(raw, "Shipment Status", SHIPMENT_STATUS).select(
        "_ix", F.col("`Shipment Status_value`").alias("status")
    )


def canonical_status_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses misspelt at a place that depends on the row."""
    words = ("booked", "in transit", "delivered", "delayed", "cancelled", "canceled",
             "returned", "lost")
    word = F.element_at(
        F.array(*[F.lit(x) for x in words]), (F.col("l_partkey") % len(words) + 1).cast("int")
    )
    p = (F.col("l_orderkey") % F.length("word") + 1).cast("int")
    head, tail = F.left(F.col("word"), p), F.substr(F.col("word"), p + 1)
    how = F.col("l_linenumber") % 4
    spelling = (
        F.when(how == 0, F.col("word"))
        .when(how == 1, F.concat(F.left(F.col("word"), p - 1), tail))
        .when(how == 2, F.concat(head, F.lit("x"), tail))
        .otherwise(F.concat(F.upper(head), F.lit("-_ "), tail))
    )
    spelled = table(spark, sf_dir, "lineitem").withColumn("word", word).select(
        "l_orderkey", "l_linenumber", spelling.alias("spelling")
    )
    return w.canonicalize_enum(spelled, "spelling", SHIPMENT_STATUS).withColumnRenamed(
        "spelling_value", "value"
    )


def city_casing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shipment_extract(spark, sf_dir)
    return w.normalize_places(raw, ["Origin City", "destCity"]).select(
        "_ix", F.col("Origin City").alias("origin"), F.col("destCity").alias("destination")
    )


def upper_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey", F.format_string(" %s\t", F.lower("c_mktsegment")).alias("segment")
    )
    return w.upper_codes(raw, ["segment"])


def trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shipment_extract(spark, sf_dir).select("_ix", F.col("shipment_id").alias("id"))
    return w.trim_text(raw, ["id"])


# ------------------------------------------------------------- materializing


def _report_shown(report: DataFrame) -> DataFrame:
    return report.withColumn("warnings", F.array_join("warnings", " / "))


def materialize_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = w.materialize(carrier_extract(spark, sf_dir), CARRIER_HEADERS, w.CARRIER)
    return m.records.drop("dataset_id")


def materialize_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = w.materialize(facility_extract(spark, sf_dir), FACILITY_HEADERS, w.FACILITY)
    return m.records.drop("dataset_id")


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = [F.concat(F.lit(f"{f}="), F.col("raw")[f]) for f in FIELDS]
    return planted(spark, sf_dir).rejects.select(
        "_ix", "entity", "record_key", "reject_reason", F.concat_ws("|", *raw).alias("raw")
    )


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        planted(spark, sf_dir)
        .rejects.groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _run(spark: SparkSession, sf_dir: str) -> w.PipelineResult:
    """All extracts through the pipeline, two of them feeding the same entity."""
    return w.run_pipeline(
        {
            "planted": (shipment_extract(spark, sf_dir, planted=True), "Shipment"),
            "plain": (shipment_extract(spark, sf_dir), "Shipment"),
            "carriers": (carrier_extract(spark, sf_dir), "Carrier"),
            "sites": (facility_extract(spark, sf_dir), "Facility"),
            "unassigned": (w.as_text(table(spark, sf_dir, "region")), None),
        }
    )


def many_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract per customer, all of one entity, checked in one pass."""
    sites = facility_extract(spark, sf_dir).withColumn(
        "extract", F.format_string("extract-%d", "_ix")
    )
    return w.materialize_many(sites, "extract", w.FACILITY).report.select(
        "dataset_id", "records", "dropped"
    )


def unlike_extracts(spark: SparkSession, sf_dir: str) -> w.Materialized:
    """2,000 extracts of sites in 50 kinds of headings: columns turned round, others between."""
    key = F.col("c_custkey")
    site = facility_extract(spark, sf_dir)
    headers = list(FACILITY_HEADERS.values())
    extract = F.col("_ix") % 2000
    kind = extract % 50
    turned = F.array(*[F.coalesce(F.col(f"`{h}`").cast("string"), F.lit("")) for h in headers])
    names = F.array(*[F.lit(h) for h in headers])

    def arranged(values, filler):
        turn = (kind % 5).cast("int")
        moved = F.concat(F.slice(values, turn + 1, 5), F.slice(values, F.lit(1), turn))
        return F.concat(F.array_repeat(filler, F.floor(kind / 5).cast("int")), moved)

    rows = site.select(
        F.format_string("extract-%d", extract).alias("dataset_id"),
        "_ix",
        arranged(turned, F.lit("x")).alias("cells"),
    )
    headings = (
        table(spark, sf_dir, "customer")
        .select(key.alias("_ix"))
        .groupBy(extract.alias("_ix"))
        .agg(F.lit(1).alias("one"))
        .select(
            F.format_string("extract-%d", "_ix").alias("dataset_id"),
            F.posexplode(arranged(names, F.lit("remark"))).alias("col_pos", "column"),
        )
    )
    return w.materialize_cells(rows, headings, w.FACILITY)[0]


def all_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).warnings.select("dataset_id", "entity", "_ix", "warning")


def write_modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to one folder; what the folder holds of both."""
    output = new_staging_path(spark, "modelled")
    for planted_rows in (True, False):
        w.run_pipeline(
            {"shipments": (shipment_extract(spark, sf_dir, planted_rows), "Shipment")},
            output=output,
            mode="append",
        )
    n = F.count(F.lit(1)).alias("n")
    rows = spark.read.parquet(f"{output}/shipment")
    report = spark.read.parquet(f"{output}/report")
    mappings = spark.read.parquet(f"{output}/mappings")
    parts = [
        rows.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("part")).agg(n),
        report.select(F.lit("reported records").alias("part"), F.col("records").alias("n")),
        mappings.where("source_column is not null").groupBy(F.lit("mapped").alias("part")).agg(n),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def written_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three runs, the second replaces the first: what is read back."""
    output = new_staging_path(spark, "runs")
    shipments_ = {"shipments": (shipment_extract(spark, sf_dir), "Shipment")}
    sites = {"sites": (facility_extract(spark, sf_dir), "Facility")}
    carriers = {"carriers": (carrier_extract(spark, sf_dir), "Carrier")}
    w.run_pipeline(shipments_ | carriers, output=output, mode="append")
    w.run_pipeline(carriers | sites, output=output, mode="overwrite")
    w.run_pipeline(sites, output=output, mode="append")
    found = w.read_modelled(spark, output)
    n = F.count(F.lit(1)).alias("n")
    parts = [t.agg(n).select(F.lit(e).alias("part"), "n") for e, t in found.tables.items()]
    rejects = found.rejects.groupBy(F.concat(F.lit("rejected "), "entity").alias("part")).agg(n)
    out = rejects
    for part in parts:
        out = out.unionByName(part)
    return out


def absurd_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of which some cost 1 with 40 zeros, or as much less than nothing."""
    order = F.col("l_orderkey")
    huge = F.lit("1" + "0" * 40)
    cost = (
        F.when(order % 50 == 3, huge)
        .when(order % 50 == 4, F.concat(F.lit("-"), huge))
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    values = {
        "id": F.concat_ws("-", F.lit("SHP"), order, "l_linenumber"),
        "carrier": F.concat(F.lit("C"), F.col("l_suppkey")),
        "pickup_date": F.lit("2026-01-01"),
        "promised_date": F.lit("2026-01-09"),
        "status": F.lit("booked"),
        "cost_usd": cost,
        "miles": F.lit("100"),
    }
    lines = table(spark, sf_dir, "lineitem").select(
        *[v.alias(f) for f, v in values.items()], order.alias("_ix")
    )
    return w.materialize(lines, {f: f for f in values}, w.SHIPMENT).records


def end_to_end_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the messy extract to the key figures, with a suggested mapping."""
    result = w.run_pipeline({"shipments": (shipment_extract(spark, sf_dir), "Shipment")})
    return w.kpis(result.tables["Shipment"])


# ----------------------------------------------------------------- questions


def _ask(question: str) -> Query:
    return lambda spark, sf_dir: w.ask(question, shipments(spark, sf_dir)).table


def ask_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence of every intent."""
    records = shipments(spark, sf_dir)
    parameters = {
        "delayed_shipments": {},
        "lane_filter": {"to_city": "Omaha"},
        "count": {},
        "cost_by_carrier": {},
        "total_cost": {},
        "avg_transit": {},
        "on_time": {},
        "carrier_rank": {"cheapest": True},
        "cost_threshold": {"threshold": 50000.5},
        "carrier_list": {},
        "status_summary": {},
    }
    out = None
    for intent, given in parameters.items():
        one = q.answer_for(records, intent, **given).sentence.select(
            F.lit(intent).alias("intent"), "answer"
        )
        out = one if out is None else out.unionByName(one)
    return out


def queries() -> dict[str, Query]:
    return {
        "read_csv_extract": read_csv_extract,
        "read_csv_documents": read_csv_documents,
        "read_csv_split_files": read_csv_split_files,
        "read_csv_split_records": lambda s, d: read_csv_documents(s, d, "split"),
        "read_csv_mixed_headers": read_csv_mixed_headers,
        "preview_rows": preview_rows,
        "dataset_summary": dataset_summary,
        "profile_orders": _profile_table("orders", "o_orderkey"),
        "profile_events": _profile_table("events", "event_id"),
        "profile_customers": _profile_table("customer", "c_custkey"),
        "profile_documents": _profile_table("documents", "doc_id"),
        "profile_wide": profile_wide,
        "profile_all": profile_all,
        "profile_dirty_shipments": lambda s, d: _shown(_messy_profile(s, d)),
        "profile_samples": lambda s, d: _messy_profile(s, d).select(
            "name", F.array_join("samples", "|").alias("samples")
        ),
        "profile_casing": _finding("Inconsistent casing: ", "casing"),
        "profile_typos": _finding("Possible typos: ", "typos"),
        "profile_issue_total": lambda s, d: w.issue_total(_messy_profile(s, d)),
        "field_catalogue": field_catalogue,
        "column_scores": column_scores,
        "suggest_mappings": _suggested,
        "mapping_overrides": _overridden,
        "mapping_status": lambda s, d: w.mapping_status(_overridden(s, d)).select(
            "dataset_id", "target_field", "status"
        ),
        "standardize_dates": standardize_dates,
        "date_format_counts": date_format_counts,
        "standardize_numbers": standardize_numbers,
        "canonical_status": canonical_status,
        "canonical_status_edits": canonical_status_edits,
        "city_casing": city_casing,
        "upper_codes": upper_codes,
        "trim_text": trim_text,
        "materialize_shipments": lambda s, d: planted(s, d).records.drop("dataset_id"),
        "materialize_carriers": materialize_carriers,
        "materialize_facilities": materialize_facilities,
        "rejects": rejects,
        "reject_counts": reject_counts,
        "materialize_report": lambda s, d: _report_shown(planted(s, d).report),
        "materialize_union": lambda s, d: _run(s, d).tables["Shipment"],
        "modelled_report": lambda s, d: _report_shown(_run(s, d).report),
        "many_extracts": many_extracts,
        "all_warnings": all_warnings,
        "unlike_extracts": lambda s, d: unlike_extracts(s, d).records,
        "unlike_extracts_report": lambda s, d: unlike_extracts(s, d).report.select(
            "dataset_id", "records", "dropped"
        ),
        "approximate_counts": approximate_counts,
        "written_runs": written_runs,
        "write_modelled": write_modelled,
        "record_totals": lambda s, d: _run(s, d).totals,
        "reference_date": lambda s, d: w.reference_date(shipments(s, d)),
        "delayed_flag": lambda s, d: w.with_delivery_flags(shipments(s, d)).select(
            "_ix", "id", "is_delayed", "is_on_time"
        ),
        "kpis": lambda s, d: w.kpis(shipments(s, d)),
        "kpis_by_carrier": lambda s, d: w.kpis(shipments(s, d), by=["carrier"]),
        "status_breakdown": lambda s, d: w.status_breakdown(shipments(s, d)),
        "status_breakdown_own": lambda s, d: w.status_breakdown(shipments(s, d), fold="own"),
        "status_counts": lambda s, d: w.status_counts(shipments(s, d)),
        "exceptions_queue": lambda s, d: w.exceptions_queue(shipments(s, d)),
        "cost_by_carrier": lambda s, d: w.cost_by(shipments(s, d)),
        "known_cities": lambda s, d: w.known_places(shipments(s, d)),
        "classify_questions": lambda s, d: w.classify_questions(
            question_table(s, d), w.known_places(shipments(s, d), ordered=False)
        ),
        "classify_conversations": lambda s, d: w.classify_questions(
            conversation_questions(s, d), w.known_places(shipments(s, d), ordered=False)
        ),
        "ask_delayed": _ask("What is running late today, what is delayed?"),
        "ask_delayed_lane": _ask("Which shipments to St. Paul are late?"),
        "ask_lane": _ask("Show shipments from El Paso to Boise"),
        "ask_counts": _ask("How many shipments are there?"),
        "ask_spend_by_carrier": _ask("Add up the total cost by carrier"),
        "ask_total_spend": _ask("What is our total cost?"),
        "ask_avg_transit": _ask("How long is transit on average?"),
        "ask_on_time": _ask("How is our on-time performance?"),
        "ask_carrier_rank": _ask("Name the cheapest carrier for a mile"),
        "ask_carrier_pick": lambda s, d: q.carrier_pick(shipments(s, d), cheapest=False),
        "ask_cost_threshold": _ask("Show shipments over $50,000"),
        "ask_carrier_list": _ask("List all carriers"),
        "ask_status_summary": _ask("Give me a status summary"),
        "ask_answers": ask_answers,
        "end_to_end_kpis": end_to_end_kpis,
        "kpis_absurd_costs": lambda s, d: w.kpis(absurd_costs(s, d)),
        "cost_by_absurd_costs": lambda s, d: w.cost_by(absurd_costs(s, d)).drop("first_ix"),
    }
