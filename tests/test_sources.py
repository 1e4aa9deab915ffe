import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.sources import documents, files, large_documents, tables, versions
from ecometrics.sources.schemas import COMPANIES, CRYPTO_FOOTPRINT, NETWORK_RECORD, SOURCES

# The header is a fixed value; the coins are invented.
FOOTPRINT = '''"Coin","Symbol","Type","Marketcap","Electrical_Power_GW","Electricity_Consumption_ GW_annualised","CO2_Emissions_Mt_annualised"
"Anvil","anv","PoW","$4,000,000,000","1200.5","1300.5","8.0"
<<<<<<< mine
"Second Anvil","anv2","Token","$25,000,000","","",""
=======
"Second Anvil","anv2","Token","$25,000,000","N/A","N/A",""
>>>>>>> theirs
"Öre ""coin""","ore","PoS","","0.0","6.25","0.0"
'''


def test_marker_lines_are_quarantined(spark, tmp_path):
    path = tmp_path / "footprint.csv"
    path.write_text(FOOTPRINT, encoding="utf-8")
    rows, rejected = files.read_source(spark, str(path), CRYPTO_FOOTPRINT, key="symbol")
    assert rows.count() == 4 and rejected.count() == 3
    assert sorted(r.symbol for r in rows.collect()) == ["anv", "anv2", "anv2", "ore"]
    assert rows.filter("symbol = 'ore'").first().coin == 'Öre "coin"'
    assert sorted(r._rejected_line[:7] for r in rejected.collect()) == ["<<<<<<<", "=======", ">>>>>>>"]
    assert rows.columns == list(CRYPTO_FOOTPRINT.columns)


def test_fixed_and_inferred_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,name,x\n1,a,1.5\n2,,2.5\n")
    inferred = files.read_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string", "double"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "name", "x")])
    assert tuple(files.read_csv(spark, str(path), schema).orderBy("id").first()) == ("1", "a", "1.5")


@pytest.mark.parametrize("variant", range(3))
def test_drifting_headers_meet(spark, variant):
    names = [headers[min(variant, len(headers) - 1)] for headers in COMPANIES.columns.values()]
    df = spark.createDataFrame([tuple("x" for _ in names)], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    assert COMPANIES.unify(df).columns == list(COMPANIES.columns)


def test_all_sources_are_declared():
    assert len(SOURCES) == 6 and all(source.schema.fieldNames() == list(source.columns) for source in SOURCES.values())


def test_latest_snapshot_per_key(spark, tmp_path):
    schema = T.StructType([T.StructField("coin", T.StringType()), T.StructField("price_usd", T.DoubleType())])
    for name, price, day in (("btc", 9.0, "2025-01-01"), ("btc", 1.0, "2025-02-01"), ("eth", 5.0, "2025-01-01")):
        (tmp_path / f"{name}_price_{day}.json").write_text(json.dumps({"coin": name, "price_usd": price}))
    glob = str(tmp_path / "*_price_*.json")
    assert files.read_json_glob(spark, glob, schema).count() == 3
    latest = files.read_json_glob(spark, glob, schema, key="coin", snapshot="latest")
    assert sorted(map(tuple, latest.collect())) == [("btc", 1.0), ("eth", 5.0)]
    with pytest.raises(ValueError):
        files.read_json_glob(spark, glob, schema, snapshot="latest")


def test_symbols(spark, tmp_path):
    path = tmp_path / "symbols.txt"
    path.write_text("AAPL\n  MSFT \n\n \t\nGOOGL")
    assert sorted(r.symbol for r in files.read_symbols(spark, str(path)).collect()) == ["AAPL", "GOOGL", "MSFT"]


def test_quoted_records(spark, tmp_path):
    path = tmp_path / "records.txt"
    records = [
        {"ticker": "sol", "power": {"detail": "none"}, "electricity": None, "emissions": {"detail": "it's None, or"}},
        {"ticker": "pol", "power": None, "electricity": {"detail": "x"}, "emissions": None},
    ]
    path.write_text("\n".join(str(r) for r in records) + "\n")
    rows = files.read_quoted_records(spark, str(path), NETWORK_RECORD).orderBy("ticker").collect()
    assert [r.asDict(recursive=True) for r in rows] == [records[1], records[0]]


def test_nested_documents_from_an_indented_file(spark, tmp_path):
    news = [{"headline": "up"}, {"headline": "down"}]
    content = {
        "stocks": {"AAPL": {"quote": {"c": 1.5}, "news": news}, "MSFT": {"quote": None, "news": []}, "X": {}},
        "ipo_calendar": {"ipoCalendar": []},
    }
    (tmp_path / "doc.json").write_text(json.dumps(content, indent=4))
    section = T.StructType.fromDDL("quote STRUCT<c: DOUBLE>, news ARRAY<STRUCT<headline: STRING>>")
    rows = documents.explode_documents(documents.read_documents(spark, str(tmp_path / "doc.json")), section)
    assert sorted((r.symbol, r.quote.c if r.quote else None) for r in rows.collect()) == [("AAPL", 1.5), ("MSFT", None), ("X", None)]
    items = documents.explode_items(rows.select("symbol", "news"), "news").collect()
    assert sorted((r.symbol, str(r.headline)) for r in items) == [
        ("AAPL", "down"), ("AAPL", "up"), ("MSFT", "None"), ("X", "None"),
    ]


def test_error_payloads_are_rejected_and_not_counted_as_fetched(spark, tmp_path):
    content = {"AAPL": {"Information": "limit"}, "MSFT": {"price": "3"}, "GOOGL": None}
    (tmp_path / "doc.json").write_text(json.dumps(content, indent=4))
    good, rejected = documents.split_payloads(documents.read_documents(spark, str(tmp_path / "doc.json")))
    assert [(r.symbol, r.payload["price"]) for r in good.collect()] == [("MSFT", "3")]
    assert sorted(r.symbol for r in rejected.collect()) == ["AAPL", "GOOGL"]


def test_only_documents_of_the_shape_stay(spark):
    texts = ['{"k": 1}', '{"k": "x"}', "[1", "", None, '{"other": 2}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, document string")
    rows = documents.of_shape(df, T.StructType([T.StructField("k", T.LongType())])).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(0, 1), (5, None)]


def test_json_fields(spark):
    df = spark.createDataFrame([('{"data": {"priceUsd": "2.5"}}',), ("no json",)], "d string")
    assert [r[0] for r in df.select(documents.field("d", "$.data.priceUsd", "double")).collect()] == [2.5, None]


def test_publishing_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(10)
    tables.publish(df, path)
    tables.publish(df, path)
    assert tables.count_loaded({"t": tables.read_table(spark, path)}) == {"t": 10}


def test_a_failed_publish_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish(spark.range(10), path)
    with pytest.raises(Exception):
        tables.publish(spark.range(10).selectExpr("CASE WHEN id = 9 THEN raise_error('stop') ELSE id END AS id"), path)
    assert tables.read_table(spark, path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


@pytest.mark.parametrize("last", ["written", "described", "committed", "cleaned"])
def test_a_writer_killed_after_any_step_leaves_a_readable_table(spark, tmp_path, last):
    path = str(tmp_path / "table")
    tables.publish(spark.range(10), path)
    for step in tables.publishing(spark.range(20, 23), path):
        if step == last:
            break
    done = last in ("committed", "cleaned")
    assert tables.read_table(spark, path).count() == (3 if done else 10)
    tables.publish(spark.range(5), path)  # the next writer goes on, and cleans up
    assert tables.read_table(spark, path).count() == 5
    folders = [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith(versions.VERSION)]
    assert len(folders) == 2 and len(list((tmp_path / "table" / "_versions").glob("*.json"))) == 2


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish(spark.range(6).selectExpr("id", "id % 2 AS p"), path, ["p"])
    for _ in range(3):
        tables.publish(tables.read_table(spark, path).selectExpr("id + 1 AS id", "p"), path, ["p"])
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [(i + 3, i % 2) for i in range(6)]
    tables.publish(spark.range(6).selectExpr("id", "id % 2 AS p").filter("false"), path, ["p"])
    assert tables.read_table(spark, path).columns == ["id", "p"] and tables.read_table(spark, path).count() == 0


def test_accumulating_writes_the_batch_and_not_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.range(20_000).selectExpr("id AS k", "uuid() AS v")
    tables.publish(first, path)
    schema = first.schema
    tables.accumulate(first.limit(1), path, "k", schema, buckets=8)
    files, before = versions.Files(spark, path), versions.current(spark, path)
    batch = spark.range(20_000, 20_003).selectExpr("id AS k", "uuid() AS v").unionByName(spark.range(5).selectExpr("id AS k", "'other' AS v"))
    grown = tables.accumulate(batch, path, "k", schema)
    after = versions.current(spark, path)
    assert after.folders[:-1] == before.folders and after.buckets == 8
    assert files.size(after.folders[-1]) < files.size(before.folders[0]) / 20
    assert grown.count() == 20_003 and grown.filter("v = 'other'").count() == 0
    for _ in range(2):
        assert tables.accumulate(batch, path, "k", schema).count() == 20_003
    assert versions.current(spark, path) == after
    assert not [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith(versions.VERSION) and p.name not in {*before.folders, *after.folders}]


def test_a_batch_reads_only_the_buckets_it_falls_in(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish(spark.range(1000).selectExpr("id AS k"), path)
    tables.accumulate(spark.range(1000, 1001).selectExpr("id AS k"), path, "k", spark.range(1).selectExpr("id AS k").schema, buckets=16)
    found = versions.read(spark, path, versions.current(spark, path)).filter(F.col(versions.BUCKET).isin([3]))
    assert 0 < len(found.inputFiles()) and found.count() < 200
    assert all(f"{versions.BUCKET}=3/" in x for x in {r[0] for r in found.select(F.input_file_name()).collect()})


def test_many_batches_are_made_one_folder(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = spark.range(1).selectExpr("id AS k").schema
    tables.publish(spark.range(3).selectExpr("id AS k"), path)
    for i in range(4):
        grown = tables.accumulate(spark.range(10 * i, 10 * i + 2).selectExpr("id AS k"), path, "k", schema, buckets=2, most_folders=3)
    assert sorted(r.k for r in grown.collect()) == [0, 1, 2, 10, 11, 20, 21, 30, 31]
    assert len(versions.current(spark, path).folders) <= 3


def test_rows_are_counted_by_the_write(spark, tmp_path):
    assert tables.publish_counted(spark.range(7), str(tmp_path / "t")) == 7


def test_accumulate_adds_a_key_once_and_no_row_without_key(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1), (None, 0)], "symbol string, v int")
    tables.publish(first, path)
    fresh = spark.createDataFrame([("b", 3), ("b", 2), (None, 5)], "symbol string, v int")
    for _ in range(2):
        grown = tables.accumulate(fresh, path, "symbol", first.schema)
        assert sorted(map(tuple, grown.collect()), key=str) == [("a", 1), ("b", 2), (None, 0)]


def test_calendar_section_beside_the_stocks(spark):
    texts = ['{"stocks": {}, "ipo_calendar": {"ipoCalendar": [{"symbol": "A"}, {"symbol": "B"}]}}', '{"stocks": {}}', "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "document string")
    rows = documents.explode_calendar(df, T.StructType([T.StructField("symbol", T.StringType())]))
    assert sorted(r.symbol for r in rows.collect()) == ["A", "B"]


def test_one_parse_per_document(spark):
    df = spark.createDataFrame([(1, '{"k": 1}')], "i int, document string")
    shaped = documents.of_shape(df, T.StructType([T.StructField("k", T.LongType())]))
    assert shaped._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_accumulate_keeps_known_rows_and_survives_a_failure(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1)], "symbol string, v int")
    tables.publish(first, path)
    fresh = spark.createDataFrame([("a", 9), ("b", 2)], "symbol string, v int")
    grown = tables.accumulate(fresh, path, "symbol", first.schema)
    assert sorted(map(tuple, grown.collect())) == [("a", 1), ("b", 2)]
    broken = spark.createDataFrame([("c", "x")], "symbol string, t string").selectExpr("symbol", "CAST(t AS int) AS v")
    with pytest.raises(Exception):
        tables.accumulate(broken, path, "symbol", first.schema)
    assert tables.read_table(spark, path).count() == 2


def test_json_sink_by_entity_and_date(spark, tmp_path):
    path = str(tmp_path / "quotes")
    rows = [("AAPL", "2025-01-01", 1.0), ("AAPL", "2025-01-02", 2.0), ("MSFT", "2025-01-01", 3.0)]
    tables.write_json(spark.createDataFrame(rows, "ticker string, date string, price double"), path, ["ticker", "date"])
    back = spark.read.schema("price double, ticker string, date string").json(path)
    assert sorted((r.ticker, r.date, r.price) for r in back.collect()) == rows


def test_literal_table_is_small_enough_to_broadcast(spark):
    table = tables.literal_table(spark, [(0, "low"), (1, "high")], ["step", "tier"])
    joined = spark.range(1000).withColumnRenamed("id", "step").join(table, "step")
    assert joined.count() == 2
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().explainString(mode)


HARD = {
    "stocks": {
        "A": {"profile": {"name": 'quote " and } brace { and [ ] \\\\'}, "news": [{"day": "1", "headline": "}"}, {"day": "2", "headline": '{"'}]},
        'B "}': {"profile": {"name": "\\\\"}, "news": []},
        "C": {},
        "D": {"profile": None, "news": [[{"x": {}}]]},
        "E": 5,
        "F": {"profile": {"name": "é漢 \\n\\u00e9"}},
    },
    "ipo_calendar": {"A": {"profile": {"name": "not a stock"}}},
    "empty": {},
}
SHAPE = T.StructType([
    T.StructField("profile", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("news", T.ArrayType(T.StructType([T.StructField("headline", T.StringType())]))),
])


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("plain", [{}, {"version": 3, "name": "a, } b", "none": None}])
def test_large_documents_are_read_as_small_ones(spark, tmp_path, indent, plain):
    (tmp_path / "doc.json").write_text(json.dumps({**plain, **HARD}, indent=indent, ensure_ascii=False), encoding="utf-8")
    for root in ("stocks", "ipo_calendar", "empty", "absent"):
        found = large_documents.explode_large_document(spark, str(tmp_path / "doc.json"), SHAPE, root).collect()
        assert sorted(r.symbol for r in found) == sorted(HARD.get(root, {}))
        for r in found:
            truth = HARD[root][r.symbol]
            truth = truth if isinstance(truth, dict) else {}
            assert (r.profile and r.profile.name) == (truth.get("profile") or {}).get("name")
            if r.symbol != "D":
                assert r.news is None if "news" not in truth else [x.headline for x in r.news] == [x["headline"] for x in truth["news"]]


def test_one_large_document_is_read_by_many_tasks(spark, tmp_path):
    section = {"profile": {"name": 'a "quoted" } name'}, "news": [{"headline": "{" * 20}] * 3}
    symbols = {f"S{i}": section for i in range(3000)}
    (tmp_path / "doc.json").write_text(json.dumps({"stocks": symbols, "other": {"X": {}}}))
    (tmp_path / "second.json").write_text(json.dumps({"stocks": {"second": section}}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parts = large_documents.pieces(spark, str(tmp_path / "doc.json")).select("__block", F.spark_partition_id()).distinct().count()
        rows = large_documents.explode_large_document(spark, str(tmp_path), SHAPE).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert parts > 10 and sorted(r.symbol for r in rows) == sorted([*symbols, "second"])
    assert {(r.profile.name, tuple(x.headline for x in r.news)) for r in rows} == {('a "quoted" } name', ("{" * 20,) * 3)}
