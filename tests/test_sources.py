import json

import pytest
from pyspark.sql import functions as F

from tidecart.plans.etl import run_etl, run_product_search
from tidecart.sources import csv_files, search_results, tables
from tidecart.streaming import landing


def put(folder, name, data):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder / name)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_encodings(spark, tmp_path):
    put(tmp_path, "utf8.csv", "name,n\nMüller,1\n")
    put(tmp_path, "bom.csv", b"\xef\xbb\xbfname,n\nMeier,2\n")
    put(tmp_path, "cp1252.csv", b"name,n\n\x80 20 \xe9,3\n")
    put(tmp_path, "latin1.csv", b"name,n\n\x81 \xe9,4\n")
    paths = csv_files.csv_files(spark, str(tmp_path))
    found = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in csv_files.detect_encodings(spark, paths).collect()}
    assert found == {"utf8.csv": "utf-8", "bom.csv": "utf-8", "cp1252.csv": "cp1252", "latin1.csv": "latin-1"}
    whole = csv_files.read_csv_files(spark, paths)
    assert values(whole) == [("Meier", "2"), ("Müller", "1"), ("\x81 é", "4"), ("€ 20 é", "3")]
    with pytest.raises(ValueError):
        csv_files.read_csv(spark, paths)


def test_a_late_bad_byte_decides(spark, tmp_path):
    path = put(tmp_path, "late.csv", b"name\n" + b"plain text\n" * 200_000 + b"caf\xe9\n")
    df = csv_files.read_csv(spark, path)
    assert df.where("name = 'café'").count() == 1 and df.count() == 200_001


def test_cp1252_header_and_mojibake(spark, tmp_path):
    path = put(tmp_path, "a.csv", b"prix \x80\n1\n\xe9\n")
    assert csv_files.read_csv(spark, path).columns == ["prix €"]
    broken = put(tmp_path, "b.csv", "name\n" + "Müller".encode().decode("latin-1") + "\n")
    assert values(csv_files.read_csv(spark, broken, repair_text=True)) == [("Müller",)]


def test_ragged_rows(spark, tmp_path):
    path = put(tmp_path, "r.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",2,NA\n"p, ""q""",1,2,3,4\n')
    assert values(csv_files.read_csv(spark, path).fillna("-")) == [
        ("1", "2", "3"), ("4", "5", "-"), ("6", "7", "8"), ('p, "q"', "1", "2"), ("x,y", "2", "-")]
    dropped = csv_files.read_csv(spark, path, long_rows="drop")
    assert values(dropped.fillna("-")) == [("1", "2", "3"), ("4", "5", "-"), ("x,y", "2", "-")]
    assert dropped.count() == 3 and values(dropped.select("b")) == [("2",), ("2",), ("5",)]
    assert tuple(csv_files.ragged_row_counts(spark, path).first()) == (5, 1, 2)
    with pytest.raises(ValueError):
        csv_files.read_csv(spark, path, long_rows="guess")


def test_quoted_newlines(spark, tmp_path):
    path = put(tmp_path, "n.csv", 'a,b\n1,"two\nlines"\n')
    assert values(csv_files.read_csv(spark, path, multi_line=True)) == [("1", "two\nlines")]


def test_empty_folder(spark, tmp_path):
    tmp_path.joinpath("x").mkdir()
    with pytest.raises(ValueError):
        csv_files.csv_files(spark, str(tmp_path / "x"))


def test_table_names():
    assert [tables.table_name_for(p) for p in ("/d/2024 sales.csv", "a-b.c.csv", "plain.csv", "é.csv")] == [
        "t_2024_sales", "a_b", "plain", "_"]


def test_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS previews")
    spark.catalog.setCurrentDatabase("previews")
    try:
        assert tables.preview_tables(spark) == {}
        one, two = spark.range(7), spark.range(2)
        tables.load_table(one, "kept")
        tables.load_table(two, "kept")
        assert tables.scan_table(spark, "kept").count() == 7
        tables.load_table(two, "kept", overwrite=True)
        assert tables.scan_table(spark, "kept").count() == 2
        tables.load_table(one, "more")
        assert tables.list_tables(spark) == ["kept", "more"]
        assert {n: d.count() for n, d in tables.preview_tables(spark).items()} == {"kept": 2, "more": 5}
    finally:
        spark.catalog.setCurrentDatabase("default")


RESPONSES = [
    {"query": "coffee", "fetch_time": "2024-01-01T00:00:00", "organic_results": [
        {"us_item_id": "1", "title": "A", "rating": 4.5, "reviews": 10, "seller_name": "s",
         "primary_offer": {"offer_price": 0.0, "min_price": 3.0}},
        {"us_item_id": "2", "title": "B", "rating": 3.5, "reviews": 99, "seller_name": "t",
         "primary_offer": {"offer_price": 8.0}}]},
    {"query": "toys", "error": "no credit"},
    {"query": "toys", "fetch_time": "2024-01-02T00:00:00", "organic_results": [
        {"us_item_id": "1", "title": "A again", "rating": None, "reviews": None, "seller_name": "s",
         "primary_offer": {"offer_price": 5.0, "min_price": 1.0}}]},
    {"query": "shoes"},
]


def test_search_responses(spark, tmp_path):
    path = put(tmp_path, "r.json", json.dumps(RESPONSES, ensure_ascii=False))
    items = search_results.explode_responses(search_results.read_records(spark, path))
    assert values(items.select("query", "title", "fetch_time")) == [
        ("coffee", "A", "2024-01-01T00:00:00"), ("coffee", "B", "2024-01-01T00:00:00"), ("toys", "A again", "2024-01-02T00:00:00")]
    no_time = put(tmp_path, "t.json", json.dumps([{"query": "q", "organic_results": [{"title": "x", "query": "old"}]}]))
    row = search_results.explode_responses(search_results.read_records(spark, no_time)).first()
    assert row["query"] == "q" and len(row["fetch_time"]) == 26
    both = search_results.concatenate([items.select("title"), items.select("title", "query")])
    assert both.count() == 6 and both.where("query is null").count() == 3


def test_product_run(spark, tmp_path):
    path = put(tmp_path, "r.json", json.dumps(RESPONSES))
    run = run_product_search(spark, search_results.read_records(spark, path), str(tmp_path / "out"))
    assert values(run.products.select("us_item_id", "title")) == [("1", "A again"), ("2", "B")]
    assert [tuple(r) for r in run.reports["mean_price_by_query"].collect()] == [("coffee", 8.0), ("toys", 5.0)]
    assert [r["title"] for r in run.reports["top_reviews"].collect()] == ["B", "A again"]
    assert run.profile["size"].first()["n_rows"] == 3
    report = spark.read.option("header", True).csv(str(tmp_path / "out/reports/top_sellers"))
    assert values(report) == [("s", "1"), ("t", "1")]
    csv = csv_files.read_csv(spark, str(tmp_path / "out/clean_data/cleaned_products_csv"))
    assert csv.where("primary_offer like '%offer_price%'").count() == 2
    assert spark.read.json(str(tmp_path / "out/save_data/products_json")).count() == 3


def test_etl_folder(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "shop_customers_purchases.csv", "Purchase_Date,who\n01-05-69,é\n01-05-69,é\nbad,b\n")
    put(raw, "cleaned_products_API.csv", "product_id,fetch_time\n1,2024-01-01\n1,2024-01-02\n2,\n")
    put(raw, "2024 products.csv", "product_id,extra,discount,initial_price,root_category_name,rating\n"
        "1,x,$2,10,a,4\n1,y,$2,10,a,4\n2,x,NA,10,a,4\n3,x,$4,NA,a,\n")
    results = run_etl(spark, str(raw), str(tmp_path / "clean"))
    assert {r.table: r.rows for r in results} == {
        "shop_customers_purchases": 2, "cleaned_products_API": 2, "t_2024_products": 4}
    bought = spark.table("shop_customers_purchases")
    assert {(r["Year"], r["Month"], r["DayOfWeek"]) for r in bought.collect()} == {(1969, 1, "Sunday"), (None, None, None)}
    products = spark.table("t_2024_products").orderBy("product_id").collect()
    assert [r["discount"] for r in products] == [2.0, 2.0, pytest.approx(8 / 3), 4.0]
    assert "extra" not in products[0]
    assert csv_files.read_csv(spark, str(tmp_path / "clean/cleaned_cleaned_products_API.csv")).count() == 2

    put(raw, "surprise.csv", "a\n1\n")
    put(raw, "zz_products.csv", "discount,initial_price,root_category_name\n\"1,200\",1,a\n")
    put(raw, "shop_customers_purchases.csv", "Purchase_Date,who\n01-05-70,a\n")
    with pytest.raises(RuntimeError) as failure:
        run_etl(spark, str(raw), str(tmp_path / "clean"))
    assert "surprise: KeyError" in str(failure.value) and "zz_products" in str(failure.value)
    assert spark.table("shop_customers_purchases").count() == 2  # loaded before, left untouched
    (raw / "surprise.csv").unlink()
    (raw / "zz_products.csv").unlink()
    run_etl(spark, str(raw), str(tmp_path / "clean"), overwrite=True)
    assert spark.table("shop_customers_purchases").count() == 1


def test_streamed_landing(spark, tmp_path):
    from tidecart.functions import dates

    def clean(df):
        return df.withColumn("day", dates.parse_short_date(F.col("d")))

    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for i, text in enumerate(["d,n\n01-05-69,NA\n", "d,n\nx,2\n02-01-24,3\n"]):
        put(folder, f"{i}.csv", text)
        landing.append_clean(landing.read_landing(spark, str(folder), ["d", "n"]), clean, out, state).awaitTermination(60)
        assert spark.read.parquet(out).count() == (1, 3)[i]
    assert spark.read.parquet(out).where("n is null and year(day) = 1969").count() == 1
