"""Documents, tables, landing and normalisation."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from procrisk.fixed import PATHS
from procrisk.functions import types
from procrisk.operators import ingest, joins, normalise, profile, quality, reports
from procrisk.plans import workflow
from procrisk.schemas import flat_schema, raw_schema
from procrisk.sources import documents, tables
from procrisk import session
from procrisk.streaming import landing
from procrisk.streaming.landing import land_new_objects

CONTRACT = {
    "externalId": "007", "providerbin": "p1", "customerbin": "c1", "sum": 100, "paidSum": "80.5",
    "acceptdate": "2024-02-01T10:00:00", "methodTrade": {"id": "6.0", "nameRu": "один"},
    "customer": {"nameru": "К"}, "unmapped": [1, 2],
}


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2, ensure_ascii=False)
    (folder / name).write_text(text, encoding="utf-8")


def test_broken_file_is_reported_not_fatal(spark, tmp_path):
    put(tmp_path, "1.json", CONTRACT)
    put(tmp_path, "2.json", '{"externalId": "8", ')
    put(tmp_path, "3.json", {**CONTRACT, "externalId": "9"})
    good, bad = documents.read_objects(spark, str(tmp_path), raw_schema("OrderDetail"))
    assert sorted(r["externalId"] for r in good.collect()) == ["007", "9"]
    assert [r["source_file"].rsplit("/")[-1] for r in bad.collect()] == ["2.json"]
    assert bad.count() == 1


def test_absent_folder_is_empty(spark, tmp_path):
    good, bad = documents.read_objects(spark, str(tmp_path / "no"), raw_schema("Plan"))
    assert good.isEmpty() and bad.isEmpty()


def test_pages_are_numbered(spark, tmp_path):
    for n in (10, 2, 1):
        put(tmp_path, f"{n}.json", {"content": [{"id": n}, {"id": 0}, {"id": None}, {"id": ""}], "totalPages": 3})
    put(tmp_path, "3.json", "oops")
    put(tmp_path, "4.json", {"totalPages": 3})
    pages = documents.read_pages(spark, str(tmp_path))
    assert [(r["page"], r["records"]) for r in pages.orderBy("page").collect()] == [(1, 4), (2, 4), (4, 0), (10, 4)]
    assert [(r["page"], r["id"]) for r in ingest.page_ids(pages).orderBy("page").collect()] == [(1, "1"), (2, "2"), (10, "10")]


def test_types(spark):
    df = spark.createDataFrame(
        [("007", "junk", "x", "6.0", "012"), ("8", "2024-01-02T03:04:05", "1.5", "6", None)],
        "lot_id string, lot_start_date string, lot_amount string, lot_method_id string, customer_bin string",
    )
    a, b = normalise.coerce_types(df).collect()
    assert tuple(a) == ("007", None, None, 6, "012")
    assert tuple(b) == ("8", dt.datetime(2024, 1, 2, 3, 4, 5), 1.5, 6, None)


def test_dates_in_other_forms(spark):
    want = {
        "2024/01/05": dt.datetime(2024, 1, 5),
        "20240105": dt.datetime(2024, 1, 5),
        "01.05.2024": dt.datetime(2024, 1, 5),
        "25.01.2024": dt.datetime(2024, 1, 25),
        "25.01.2024 10:30:00": dt.datetime(2024, 1, 25, 10, 30),
        "2024-01-05T10:00:00+06:00": dt.datetime(2024, 1, 5, 4),
        "2024-01-05 01:00:00-0230": dt.datetime(2024, 1, 5, 3, 30),
        "2024-01-05T04:00:00Z": dt.datetime(2024, 1, 5, 4),
        "2024-01-05T04:00:00.25Z": dt.datetime(2024, 1, 5, 4, 0, 0, 250_000),
        "2024-01-05": dt.datetime(2024, 1, 5),
        "05": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", types.to_moment(F.col("t")).alias("m")).collect()}
    got.pop("05"), want.pop("05")  # a year of two digits is not a date, or is one of antiquity
    assert got == want


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([("NaN",), ("nan",), ("1.5",), (None,)], "t string")
    assert [r[0] for r in df.select(types.to_number(F.col("t"))).collect()] == [None, None, 1.5, None]


def test_money_neither_raises_nor_drops(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(1e17,), (1e30,), (float("nan"),), (None,)], "x double")
    total, mean = df.agg(quality.total_money("x"), quality.mean_money("x")).first()
    assert total == pytest.approx(1e30) and mean == pytest.approx(1e30 / 1002)
    small = df.where("x < 1e20").agg(quality.total_money("x")).first()[0]
    assert small == pytest.approx(1e17 + 4, abs=16)


def test_flatten_and_map(spark):
    df = spark.createDataFrame([((1, ("x",)), [1, 2])], "a struct<b:int,c:struct<d:string>>, e array<int>")
    flat = normalise.flatten(df)
    assert flat.columns == ["a.b", "a.c.d", "e"]
    mapped = normalise.map_columns(df, {"a.c.d": "d", "z.y": "missing"})
    assert [tuple(r) for r in mapped.collect()] == [("x", None)]
    assert normalise.map_columns(df, {"z": "q"}).isEmpty()


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_normalise_all(spark, tmp_path, kind):
    put(tmp_path / "raw" / "OrderDetail", "1.json", CONTRACT)
    put(tmp_path / "raw" / "Plan", "1.json", "broken")
    report = {r["entity"]: r for r in normalise.normalise_all(spark, f"{tmp_path}/raw", f"{tmp_path}/out", kind=kind).collect()}
    assert report["OrderDetail"]["records"] == 1 and report["OrderDetail"]["columns"] == list(PATHS["OrderDetail"].values())
    assert report["Plan"]["file"] is None and report["_Lot"]["records"] == 0
    assert report["Plan"]["rejects"] == 1 and report["OrderDetail"]["rejects"] == 0
    kept = tables.read_parquet(spark, f"{tmp_path}/out/Plan.rejects").first()
    assert kept["source_file"].endswith("Plan/1.json")
    path = report["OrderDetail"]["file"]
    table = tables.read_parquet(spark, path) if kind == "parquet" else tables.read_csv(spark, path, flat_schema("OrderDetail"))
    row = table.first()
    assert (row["lot_id"], row["order_method_id"], row["paid_sum"], row["customer_name_ru"]) == ("007", 6, 80.5, "К")
    assert row["accept_date"] == dt.datetime(2024, 2, 1, 10)


def test_failure_of_one_entity_is_reported(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw" / "OrderDetail", "1.json", CONTRACT)
    whole = normalise.normalise

    def broken(records, entity):
        if entity == "Plan":
            raise RuntimeError("no luck")
        return whole(records, entity)

    monkeypatch.setattr(normalise, "normalise", broken)
    report = {r["entity"]: r for r in normalise.normalise_all(spark, f"{tmp_path}/raw", f"{tmp_path}/out").collect()}
    assert report["Plan"]["error"] == "no luck" and report["OrderDetail"]["records"] == 1


def test_csv_keeps_text(spark, tmp_path):
    rows = [("007", ' two\nlines, "quoted" '), ("8", "x,y"), ("9", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    path = tables.write_csv(df, f"{tmp_path}/t.csv")
    assert sorted(tuple(r) for r in tables.read_csv(spark, path, df.schema).collect()) == sorted(rows)
    guessed = tables.read_csv(spark, tables.write_csv(spark.range(3), f"{tmp_path}/n.csv"))
    assert dict(guessed.dtypes) == {"id": "int"}


def test_parquet_is_zstd(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = tables.write_parquet(spark.range(5), f"{tmp_path}/t.parquet")
    meta = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_stored_size(spark, tmp_path):
    path = tables.write_csv(spark.range(10).coalesce(1), f"{tmp_path}/t.csv")
    row = quality.stored_size(spark, path).first()
    assert row["files"] == 1 and row["bytes"] == len("id\n" + "\n".join(map(str, range(10))) + "\n")


def test_absent_inputs_are_all_named(spark, tmp_path):
    tables.write_parquet(spark.range(1), f"{tmp_path}/Plan.parquet")
    with pytest.raises(FileNotFoundError) as error:
        workflow.build_procurements(spark, str(tmp_path), str(tmp_path))
    assert "OrderDetail" in str(error.value) and "_Lot" in str(error.value) and "Plan.parquet" not in str(error.value)
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, f"{tmp_path}/none")


def test_best_available(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.best_available(spark, str(tmp_path))
    tables.write_parquet(spark.range(1), f"{tmp_path}/procurements.parquet")
    tables.write_parquet(spark.range(2), f"{tmp_path}/procurements_featured.parquet")
    (tmp_path / "procurements_final.parquet").mkdir()  # nothing to read in it
    df, name = tables.best_available(spark, str(tmp_path))
    assert name == "procurements_featured" and df.count() == 2


def test_landing_takes_each_file_once(spark, tmp_path):
    schema = raw_schema("OrderDetail")
    where = [str(tmp_path / p) for p in ("in", "out", "progress")]
    change = lambda df: normalise.normalise(df, "OrderDetail")
    put(tmp_path / "in", "1.json", CONTRACT)
    assert land_new_objects(spark, where[0], schema, *where[1:], transform=change).count() == 1
    assert land_new_objects(spark, where[0], schema, *where[1:], transform=change).count() == 1
    put(tmp_path / "in", "2.json", {**CONTRACT, "externalId": "8"})
    put(tmp_path / "in", "3.json", "broken")
    landed = land_new_objects(spark, where[0], schema, *where[1:], transform=change)
    assert sorted(r["lot_id"] for r in landed.collect()) == ["007", "8"]
    assert landed.schema == flat_schema("OrderDetail")
    lost = spark.read.parquet(f"{where[1]}_rejects").collect()
    assert [r["source_file"].rsplit("/", 1)[1] for r in lost] == ["3.json"]


def test_landing_again_after_a_failure_between_both_writes(spark, tmp_path, monkeypatch):
    schema = raw_schema("OrderDetail")
    where = [str(tmp_path / p) for p in ("in", "out", "progress")]
    put(tmp_path / "in", "1.json", CONTRACT)
    put(tmp_path / "in", "2.json", "broken")
    real, written = landing._write, []

    def failing(rows, path):
        if len(written) == 1:
            written.append(None)
            raise OSError("the store is gone")
        written.append(path)
        real(rows, path)

    monkeypatch.setattr(landing, "_write", failing)
    with pytest.raises(Exception, match="the store is gone"):
        land_new_objects(spark, where[0], schema, *where[1:])
    assert spark.read.parquet(where[1]).count() == 1  # the records are there, the rejects are not
    put(tmp_path / "in", "3.json", {**CONTRACT, "externalId": "9"})
    landed = land_new_objects(spark, where[0], schema, *where[1:])
    assert sorted(r["externalId"] for r in landed.collect()) == ["007", "9"]
    assert spark.read.parquet(f"{where[1]}_rejects").count() == 1


def test_landing_reads_each_file_once(spark, tmp_path):
    schema, seen = raw_schema("OrderDetail"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(text):
        seen.add(1)
        return text

    real = landing.parse
    where = [str(tmp_path / p) for p in ("in", "out", "progress")]
    for k in range(3):
        put(tmp_path / "in", f"{k}.json", "broken" if k else CONTRACT)
    landing.parse = lambda texts, schema: real(texts.withColumn("raw_text", watched("raw_text")), schema)
    try:
        land_new_objects(spark, where[0], schema, *where[1:])
    finally:
        landing.parse = real
    assert seen.value == 3


def test_dates_of_a_column_have_one_layout(spark):
    rows = [("15.01.2024", "01/15/2024", "2024-01-15"), ("05.01.2024", "05/01/2024", "junk"),
            ("06.07.2024", "06/07/2024", None), ("01.15.2024", "15/01/2024", "1.2.2024"),
            ("16-2-2024 10:00:00", "12/31/2024", "3.4.2024")]
    df = spark.createDataFrame(rows, "accept_date string, lot_start_date string, plan_date string")
    told = {r["column"]: tuple(r)[1:] for r in normalise.date_layouts(df).collect()}
    assert told == {
        "accept_date": (5, 4, 3, "day_first", 1),
        "lot_start_date": (5, 3, 4, "month_first", 1),
        "plan_date": (2, 2, 2, "month_first", 0),
    }
    got = [tuple(r) for r in normalise.coerce_types(df).collect()]
    day = lambda *d: dt.datetime(2024, *d)
    assert got == [
        (day(1, 15), day(1, 15), day(1, 15)), (day(1, 5), day(5, 1), None), (day(7, 6), day(6, 7), None),
        (None, None, day(1, 2)), (day(2, 16, 10), day(12, 31), day(3, 4)),
    ]
    assert normalise.date_layouts(df.select(F.lit("x").alias("lot_id"))).count() == 0


def test_stored_entity_is_written_again_when_days_come_first(spark, tmp_path):
    for k, date in enumerate(("15.01.2024", "05.01.2024", "01.16.2024", "20.01.2024")):
        put(tmp_path / "raw" / "OrderDetail", f"{k}.json", {**CONTRACT, "externalId": str(k), "acceptdate": date})
    done = normalise.normalise_entity(spark, f"{tmp_path}/raw/OrderDetail", "OrderDetail", f"{tmp_path}/out")
    assert done["records"] == 4 and done["lost_dates"] == 1 and done["layouts"]["accept_date"] == "day_first"
    got = {r["lot_id"]: r["accept_date"] for r in tables.read_parquet(spark, done["file"]).collect()}
    assert got == {"0": dt.datetime(2024, 1, 15), "1": dt.datetime(2024, 1, 5), "2": None, "3": dt.datetime(2024, 1, 20)}


def test_jobs_at_once():
    done = session.at_once({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: "x"})
    assert done["a"] == 1 and done["c"] == "x" and isinstance(done["b"], ZeroDivisionError)
    assert session.at_once({}) == {}


def test_bookkeeping(spark):
    listed = spark.createDataFrame([("a", str(i)) for i in (1, 2, 2, 5, 9)] + [("b", "x")], "entity string, id string")
    stored = spark.createDataFrame([("a", "5"), ("c", "7")], "entity string, id string")
    gone = ingest.missing_ids(listed, stored, min_id=2)
    assert sorted(r["id"] for r in gone.collect()) == ["2", "2", "9"]
    hot = ingest.missing_ids(listed, stored, min_id=2, hot_rows=1)
    assert sorted(r["id"] for r in hot.collect()) == ["2", "2", "9"]
    status = {r["entity"]: tuple(r)[1:] for r in ingest.entity_status(listed, stored).collect()}
    assert status == {"a": (5, 1, 4, 20.0), "b": (1, 0, 1, 0.0), "c": (0, 1, -1, 0.0)}
    tally = ingest.outcome_tally(spark.createDataFrame([("a", "success"), ("a", "error"), ("a", "success"), ("a", "timeout"), ("a", None)], "entity string, status string"))
    assert tuple(tally.first()) == ("a", 2, 0, 0, 1, 2, 5)
    counts = ingest.missing_counts(listed, stored, min_id=2)
    assert {tuple(r) for r in counts.collect()} == {("a", 3), ("b", 0)}
    assert tuple(ingest.success_rate(stored, listed).first()) == (2, 6, 33.333333)
    assert ingest.success_rate(stored.limit(0), listed).first()["success_rate"] is None
    named = ingest.with_object_name(spark.createDataFrame([("_Lot",), ("Other",)], "entity string"))
    assert [r["object_entity"] for r in named.collect()] == ["Lot", "Other"]


def test_profile_follows_first_item_and_stops(spark):
    texts = spark.createDataFrame(
        [("1", '{"a": {"b": {"c": {"d": {"e": 1}}}}, "l": [{"x": 1}, 2], "n": null, "t": true, "f": 1.5, "e": []}'), ("2", "broken")],
        "source_file string, raw_text string",
    )
    found = {r["path"]: r for r in profile.path_profile(texts).collect()}
    assert {p: r["type"] for p, r in found.items()} == {
        "$": "dict", "$.a": "dict", "$.a.b": "dict", "$.a.b.c": "dict", "$.a.b.c.d": "dict", "$.l": "list",
        "$.l[0]": "dict", "$.l[0].x": "int", "$.n": "NoneType", "$.t": "bool", "$.f": "float", "$.e": "list",
    }
    assert found["$.l"]["max_length"] == 2 and found["$.e"]["min_length"] == 0
    assert found["$.a.b.c.d"]["truncated"] and not found["$.a.b.c"]["truncated"]
    assert found["$.f"]["sample"] == "1.5"


ODD_DOCUMENTS = [
    ['{"a": 1, "b": "x", "l": [3, 4], "o": {"p": null, "q": []}}', '{"a": 2.5, "l": ["z"], "o": 7}',
     '{"a": "t", "l": [], "m": [[1, 2], [3]]}', '[{"k": 1}, {"k": 2, "n": [true]}]', '5', 'null', '"s"', "{}",
     '{"l": [{"x": {"y": {"z": {"u": 1}}}, "w": [[{"v": 1}]]}, {"e": 1}]}', "broken", None],
    ['{"a.b": 1, "a": {"b": 2}}', '{"x[0]": 3, "q\\"": 4}'],
    ['{"l": [1, "x", {"y": 2}]}', '{"l": [null, 1]}'],
    [f'{{"key{k}": {k}}}' for k in range(30)],
    [],
]


@pytest.mark.parametrize("documents", ODD_DOCUMENTS)
@pytest.mark.parametrize(("depth", "first"), [(0, 1_000), (1, 1_000), (3, 1_000), (3, 2)])
def test_profile_by_schema_equals_that_by_nodes(spark, documents, depth, first, monkeypatch):
    monkeypatch.setattr(profile, "FIRST_DOCUMENTS", first)
    texts = spark.createDataFrame([(d,) for d in documents], "raw_text string").repartition(2)
    want = sorted(map(str, profile.profile_by_nodes(texts, max_depth=depth).collect()))
    got = profile.path_profile(texts, max_depth=depth, max_schemas=20)
    assert sorted(map(str, got.collect())) == want


def test_paths_of_a_schema():
    schema = "OBJECT<a: DECIMAL(2,1), `b c`: ARRAY<OBJECT<d: STRING>>, e: ARRAY<VOID>, f: OBJECT<>>"
    assert profile.paths_of(schema, 9) == [
        ("$", 0, "OBJECT"), ("$.a", 1, "DECIMAL"), ("$.b c", 1, "ARRAY"), ("$.b c[0]", 2, "OBJECT"),
        ("$.b c[0].d", 3, "STRING"), ("$.e", 1, "ARRAY"), ("$.e[0]", 2, "VOID"), ("$.f", 1, "OBJECT"),
    ]
    assert profile.paths_of(schema, 0) == [p for p in profile.paths_of(schema, 9) if p[1] <= 1]


def test_join_keeps_rows_under_skew(spark):
    contracts = spark.createDataFrame([("hot", 10.0 + i) for i in range(40)] + [("x", 1.0), ("y", 2.0), (None, 3.0)], "lot_id string, contract_sum double")
    lots = spark.createDataFrame([("hot", "p"), ("x", None), ("z", "q"), (None, "p")], "lot_id string, plan_id string")
    plans = spark.createDataFrame([("p", 5.0)] * 3 + [("q", 6.0)], "plan_id string, plan_price double")
    for how, rows in (("left", 40 * 3 + 2), ("inner", 40 * 3)):
        plain = joins.procurements(contracts, lots, plans, how=how)
        salted = joins.procurements(contracts, lots, plans, how=how, hot_rows=2)
        assert plain.count() == salted.count() == rows
        assert len(plain.columns) == 20
        assert plain.exceptAll(salted).isEmpty()


def test_quality_rules(spark):
    df = spark.createDataFrame([("1", 5.0, None, "c")] * 3 + [(None, None, "p", "c")], "lot_id string, contract_sum double, provider_bin string, customer_bin string")
    rules = {r["rule"]: r["passed"] for r in quality.quality_rules(quality.data_quality(df)).collect()}
    assert rules == {"has_records": True, "null_lot_ids": False, "null_provider_bins": False, "unique_customers": False}
    assert workflow.check_procurements(df)[0] and not workflow.check_procurements(df.limit(0))[0]
    assert quality.data_quality(df, approximate=True).first()["unique_customers"] == 1


def test_filters_and_tables(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 31), 5.0, 0, 0.5), ("b", dt.datetime(2024, 1, 31, 1), 1_234_567.5, 1, 3.5), (None, None, None, 1, 2.0)],
        "customer_bin string, lot_start_date timestamp_ntz, contract_sum double, x_y_flag int, risk_score double",
    )
    df = reports.with_category(df)
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert reports.in_date_range(df, *days).count() == 1
    assert reports.apply_filters(df, reports.Filters()).count() == 3
    assert reports.apply_filters(df, reports.Filters(value_range=(0, 10), customers=["a"])).count() == 1
    assert reports.of_customers(df, [str(i) for i in range(2_000)] + ["b"]).count() == 1
    assert reports.with_any_flag(df, ["x_y_flag", "no_flag"]).count() == 2
    assert reports.with_any_flag(df, ["no_flag"]).count() == 3
    shown = reports.with_formatted_sums(reports.risk_table(df)).orderBy("risk_score").collect()
    assert [r["contract_sum"] for r in shown] == ["", "1,234,568"]
    assert [r["title"] for r in reports.facet_flags(df).collect()] == ["X Y"]
    assert reports.risk_table(df.drop("risk_category")).count() == 3
    plain = reports.with_category(df.select("customer_bin"))
    assert {r["risk_category"] for r in plain.collect()} == {"Low"}


def test_date_filter_reaches_the_scan(spark, tmp_path):
    tables.write_parquet(spark.sql("select timestamp_ntz'2024-01-01' lot_start_date, 1 a, 2 b"), f"{tmp_path}/t")
    kept = reports.in_date_range(spark.read.parquet(f"{tmp_path}/t"), dt.date(2024, 1, 1), dt.date(2024, 2, 1)).select("a")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lot_start_date" in plan and "b#" not in plan.split("ReadSchema")[1]
