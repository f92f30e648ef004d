import json
import os
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from signalwatch.operators.quality import conform, load_counts, quarantine
from signalwatch.schemas import CATEGORY, STAGING
from signalwatch.sources import files, staging


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_plain_csv_by_name_with_missing_values(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('b,a,c\n1,"x, ""y""",2\nNA,,3\nNaN,ok,4\n', encoding="utf-8")
    got = files.scan_csv(spark, str(path), ["a", "b"])
    assert set(rows(got)) == {(None, None), ("ok", None), ('x, "y"', "1")}
    assert files.csv_columns(spark, str(path)) == ["b", "a", "c"]


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n"x\ny",1\n', encoding="utf-8")
    assert rows(files.scan_csv(spark, str(path), ["a", "b"], multiline=True)) == [("x\ny", "1")]


def test_zip_is_preferred_and_decoded(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n9,z\n")
    with zipfile.ZipFile(f"{path}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("t.csv", "a,b\n1,x\n2,y\n,NA\n")
    scanned = files.scan_csv(spark, str(path), ["b", "a"])
    assert set(rows(scanned)) == {("x", "1"), ("y", "2"), (None, None)}


def test_many_archives(spark, tmp_path):
    folder = tmp_path / "t.csv.zip"
    folder.mkdir()
    for part in range(3):
        with zipfile.ZipFile(folder / f"{part}.zip", "w") as archive:
            archive.writestr("t.csv", "a\n" + "".join(f"{part}-{i}\n" for i in range(50)))
    got = files.scan_csv(spark, str(tmp_path / "t.csv"), ["a"])
    assert rows(got) == sorted(((f"{p}-{i}",) for p in range(3) for i in range(50)), key=str)


def test_archive_member_by_name(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.csv.zip", "w") as archive:
        archive.writestr("old_copy.csv", "a\nold\n")
        archive.writestr("LEIAME.txt", "read me")
        archive.writestr("folder/z.csv", "a\nnew\n")
    assert rows(files.scan_csv(spark, str(tmp_path / "z.csv"), ["a"])) == [("new",)]
    with zipfile.ZipFile(tmp_path / "y.csv.zip", "w") as archive:
        archive.writestr("one.csv", "a\n1\n")
        archive.writestr("two.csv", "a\n2\n")
    with pytest.raises(Exception, match="which of"):
        files.scan_csv(spark, str(tmp_path / "y.csv"), ["a"])


SELLERS = "seller_id,seller_city,seller_state\n"


def test_files_with_columns_in_another_order_fail(spark, tmp_path):
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text(SELLERS + "s1,Rome,IT\n")
    (folder / "b.csv").write_text("seller_city,seller_id,seller_state\nParis,s2,FR\n")
    for strict in (True, False):
        with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
            files.scan_csv(spark, str(folder), ["seller_id", "seller_city"], strict=strict).collect()


@pytest.mark.parametrize("bad", ["s2,Paris,IDF,EXTRA", "s3", 's4,"New\nYork",NY'])
def test_records_that_do_not_fit_the_header(spark, tmp_path, bad):
    (tmp_path / "sellers.csv").write_text(SELLERS + f"s1,Rome,IT\n{bad}\ns9,Oslo,NO\n")
    names = ["seller_id", "seller_city"]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        files.scan_csv(spark, str(tmp_path / "sellers.csv"), names).collect()
    raw_rows = staging.raw_table(spark, str(tmp_path), "sellers", strict=False)
    good, rejects = quarantine(raw_rows, STAGING["sellers"])
    assert rows(good) == [("s1", "Rome", "IT"), ("s9", "Oslo", "NO")]
    kept = {r["_corrupt_record"] for r in rejects.collect()}
    assert kept == set(bad.split("\n"))
    assert all(r.problems == ["_corrupt_record"] for r in rejects.collect())


def test_line_break_in_a_field_through_staging(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text(SELLERS + 's4,"New\nYork",NY\n')
    found = staging.raw_table(spark, str(tmp_path), "sellers", multiline=True)
    assert rows(found) == [("s4", "New\nYork", "NY")]


def test_zipped_search_file_and_its_bad_rows(spark, tmp_path):
    from signalwatch.plans.retail_run import search_file

    with zipfile.ZipFile(tmp_path / "trends.csv.zip", "w") as archive:
        archive.writestr("trends.csv", f"full_date,time_sk,{CATEGORY},search_volume\n"
                         "2024-01-01,1,a,5.5\n2024-01-02,2,a\n2024-01-03,3,a,much\n")
    path = str(tmp_path / "trends.csv")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|CAST_INVALID"):
        search_file(spark, path).collect()
    good = search_file(spark, path, rejected=str(tmp_path / "bad"))
    assert [(str(r.full_date), r.time_sk, r.search_volume) for r in good.collect()] == [
        ("2024-01-01", 1, Decimal("5.50"))]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_broken_json_can_be_set_aside(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"a": 1}\n{"a": \n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    good, bad = quarantine(files.scan_json(spark, str(path), schema, array=False, strict=False),
                           schema)
    assert rows(good) == [(1,)] and [r["_corrupt_record"] for r in bad.collect()] == ['{"a": ']


def test_missing_file_and_missing_column_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_csv(spark, str(tmp_path / "none.csv"), ["a"])
    path = tmp_path / "t.csv"
    path.write_text("a\n1\n")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        files.scan_csv(spark, str(path), ["nope"])


REVIEWS = [
    {CATEGORY: "informática", "full_date": "2024-01-01", "time_sk": 1, "average_score": 4.35,
     "total_comments": 12, "sentiment_score": 83.75, "review_momentum": 1e-05, "perfil": "x"},
    {CATEGORY: "b", "full_date": "2024-01-02", "time_sk": 2, "average_score": 5,
     "total_comments": 7, "sentiment_score": 100.0, "review_momentum": -0.25, "perfil": "y"},
]


def test_json_array(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps(REVIEWS, indent=2, ensure_ascii=False), encoding="utf-8")
    text = T.StructType([T.StructField(n, T.StringType()) for n in STAGING["reviews"].names])
    got = conform(files.scan_json(spark, str(path), text), STAGING["reviews"]).collect()
    assert {r[CATEGORY]: (str(r.full_date), r.average_score, r.review_momentum) for r in got} == {
        "informática": ("2024-01-01", Decimal("4.35"), Decimal("0.0000")),
        "b": ("2024-01-02", Decimal("5.00"), Decimal("-0.2500")),
    }


def test_broken_json_fails(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"a": 1}\n{"a": \n')
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(Exception, match="MALFORMED"):
        files.scan_json(spark, str(path), schema, array=False).collect()


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é, \"q\"", 1, None), ("b", None, "z")],
                               "a string, b int, c string")
    files.write_csv(df, str(tmp_path / "csv"), ["a", "b"])
    back = files.scan_csv(spark, str(tmp_path / "csv"), ["a", "b"])
    assert rows(back) == rows(df.selectExpr("a", "cast(b as string) b"))
    files.write_json(df, str(tmp_path / "json"))
    assert rows(files.scan_json(spark, str(tmp_path / "json"), df.schema, array=False)) == rows(df)
    written = "".join(p.read_text("utf-8") for p in (tmp_path / "json").glob("*.json"))
    assert "é" in written


TYPED = T.StructType([
    T.StructField("name", T.StringType(), True, {"max_length": 3}),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("share", T.DecimalType(6, 2)),
    T.StructField("at", T.TimestampNTZType()),
    T.StructField("n", T.IntegerType()),
])


def raw(spark, *values):
    return spark.createDataFrame(values, "name string, price string, share string, at string, "
                                         "n string, extra string")


def test_conform_rounds_half_away_and_trims_blanks(spark):
    got = conform(raw(spark, ("abc  ", "2.345", "-2.345", "2024-01-01 10:00:00", "3.0", "x"),
                      (None, None, None, None, None, None)), TYPED)
    first, empty = sorted(got.collect(), key=lambda r: r.name is None)
    assert (first.name, first.price, first.share, str(first["at"]), first.n) == (
        "abc", Decimal("2.35"), Decimal("-2.35"), "2024-01-01 10:00:00", 3)
    assert all(v is None for v in empty)
    assert got.schema == TYPED


@pytest.mark.parametrize("bad", [
    ("abcd", "1", "1", "2024-01-01", "1", ""),
    ("a", "x", "1", "2024-01-01", "1", ""),
    ("a", "1", "12345.6", "2024-01-01", "1", ""),
    ("a", "1", "1", "bad", "1", ""),
    ("a", "1", "1", "2024-01-01", "one", ""),
])
def test_bad_values_fail_or_are_set_aside(spark, bad):
    good = ("a", "1", "1", "2024-01-01", "1", "")
    with pytest.raises(Exception):
        conform(raw(spark, good, bad), TYPED).collect()
    kept, out = quarantine(raw(spark, good, bad), TYPED)
    assert kept.count() == 1
    only = out.collect()
    assert len(only) == 1 and len(only[0].problems) == 1
    assert tuple(only[0])[:5] == bad[:5]


def test_load_counts(spark):
    got = load_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got) == [("a", 3), ("b", 0)]


def source_folder(folder):
    """A tiny shop as source files: plain CSV, zipped CSV and a JSON array."""
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 5) for d in range(1, 29)]
    cats = {"p1": "toys", "p2": "la_cuisine", "p3": ""}
    orders, items = [], []
    for i, day in enumerate(days):
        status = "canceled" if i % 9 == 8 else "delivered"
        orders.append(f"o{i},c{i % 3},{status},{day} 12:00:00,{day} 13:00:00,,ignored")
        for j, p in enumerate(cats):
            for k in range(1 + (i * (j + 1)) % 4):
                items.append(f"o{i},{len(items) % 20},{p},s{k % 2},{10 + i}.5,1.255")
    header = "order_id,customer_id,order_status,order_purchase_timestamp," \
             "order_delivered_customer_date,order_estimated_delivery_date,extra"
    (folder / "orders.csv").write_text("\n".join([header, *orders]) + "\n")
    with zipfile.ZipFile(folder / "order_items.csv.zip", "w") as archive:
        head = "order_id,order_item_id,product_id,seller_id,price,freight_value"
        archive.writestr("order_items.csv", "\n".join([head, *items]) + "\n")
    products = [f"{p},{c}" for p, c in cats.items()]
    (folder / "products.csv").write_text(
        "\n".join(["product_id,product_category_name", *products]) + "\n")
    (folder / "customers.csv").write_text(
        "customer_id,customer_unique_id,customer_city,customer_state\n"
        + "".join(f"c{i},u{i},São Paulo,SP\n" for i in range(3)))
    (folder / "sellers.csv").write_text(
        "seller_id,seller_city,seller_state\ns0,Rio,RJ\ns1,Niterói,RJ\n")
    trends = [f"{d},{i + 1},{c},{5 + (i * 7 + len(c)) % 90}.125"
              for i, d in enumerate(days) for c in ("toys", "la_cuisine", "desconhecido")]
    (folder / "trends.csv").write_text(
        "\n".join(["full_date,time_sk,product_category_name,search_volume", *trends]) + "\n")
    reviews = [
        {CATEGORY: c, "full_date": d, "time_sk": i, "average_score": 3 + (i % 20) / 10,
         "total_comments": i, "sentiment_score": 50.0 + i % 50, "review_momentum": i % 3 / 10,
         "perfil": "padrao"}
        for i, d in enumerate(days) for c in ("toys", "la_cuisine")
    ]
    (folder / "reviews.json").write_text(json.dumps(reviews, indent=2, ensure_ascii=False))
    delivered = {f"o{i}" for i in range(len(days)) if i % 9 != 8}
    return len(days), sum(line.split(",")[0] in delivered for line in items)


def test_whole_run_from_files(spark, tmp_path):
    from signalwatch.plans import models, retail_run

    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    n_days, n_items = source_folder(folder)
    warehouse = retail_run.load(spark, str(folder), target)
    warehouse.check_primary_keys()
    assert {r.table_name: r.n_rows for r in retail_run.loaded(warehouse).collect()} == {
        "fact_sales": n_items, "dim_trend": 3 * n_days, "dim_review": 2 * n_days,
    }
    assert warehouse["fact_sales"].first().freight_value == Decimal("1.26")
    small = {"random_forest": lambda: models.random_forest(trees=3, depth=3),
             "boosted_trees": lambda: models.boosted_trees(rounds=2, depth=2)}
    outcome = retail_run.analyse(warehouse, f"{target}/full", small)
    summary = outcome.reports["run_summary"].first()
    assert (summary.rows_analysed, summary.categories) == (n_items, 3)
    assert outcome.reports["top_alerts"].count() == 3
    assert outcome.reports["category_series"].count() > 0

    trends = retail_run.search_file(spark, str(folder / "trends.csv"))
    assert "time_sk" in trends.columns
    del small["boosted_trees"]
    alone = retail_run.analyse_standalone(warehouse, trends, f"{target}/alone", small)
    assert alone.reports["model_comparison"].count() == 1
    assert "sentiment_score" not in alone.features.columns


def test_inserts_reach_the_fact_and_its_log(spark, tmp_path):
    from signalwatch.plans import retail_run
    from signalwatch.storage import drop

    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    _, n_items = source_folder(folder)
    warehouse = retail_run.load(spark, str(folder), target)
    more = spark.createDataFrame(warehouse["fact_sales"].drop("sales_sk").limit(7).collect())
    more = more.select(*[more[c].cast(warehouse["fact_sales"].schema[c].dataType).alias(c)
                         for c in more.columns])
    for times in (1, 2):
        warehouse = retail_run.insert(warehouse, more, target)
        warehouse.check_primary_keys()
        assert warehouse["fact_sales"].count() == n_items + 7 * times
        assert retail_run.audit(spark, target).first().total_operations == 7 * times
    assert retail_run.reload(spark, target)["fact_sales"].count() == n_items + 14
    # a new load starts without them
    assert retail_run.load(spark, str(folder), target)["fact_sales"].count() == n_items
    assert retail_run.audit(spark, target).count() == 0
    drop(spark, f"{target}/star/built")
    with pytest.raises(FileNotFoundError):
        retail_run.reload(spark, target)


def test_a_build_with_repeated_keys_fails(spark, tmp_path, monkeypatch):
    from signalwatch.plans import retail_run, warehouse

    folder = tmp_path / "in"
    folder.mkdir()
    source_folder(folder)
    read = warehouse.read_keyed
    monkeypatch.setattr(warehouse, "read_keyed", lambda spark, path, key, *a: (
        lambda df: df.union(df) if key == "seller_sk" else df)(read(spark, path, key, *a)))
    with pytest.raises(ValueError, match="seller_sk is no primary key"):
        retail_run.load(spark, str(folder), str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        retail_run.reload(spark, str(tmp_path / "out"))


def test_shuffle_parts_follow_the_input():
    from signalwatch.session import shuffle_parts

    assert shuffle_parts(0) == shuffle_parts(200 << 27) == 200
    assert shuffle_parts((200 << 27) + 1) == 201
    assert shuffle_parts(100 << 40) == 819_200


def test_stage_sets_bad_rows_aside(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    source_folder(folder)
    with open(folder / "sellers.csv", "a") as more:
        more.write("s2,City,far too long a state\n")
    with pytest.raises(Exception, match="too long"):
        staging.stage(spark, str(folder), target)
    tables = staging.stage(spark, str(folder), target, strict=False)
    assert tables["sellers"].count() == 2
    out = spark.read.parquet(f"{target}/rejected/sellers").collect()
    assert [(r.seller_id, r.problems) for r in out] == [("s2", ["seller_state"])]
    staging.append(tables["sellers"].limit(1), f"{target}/sellers", "sellers")
    assert spark.read.parquet(f"{target}/sellers").count() == 3


def test_command_line(spark, tmp_path, capsys, setting):
    from signalwatch.__main__ import main
    from signalwatch.storage import shared_dir

    folder, target = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    source_folder(folder)
    (folder / "orders.csv").rename(folder / "my_orders.csv")
    shared = f"{shared_dir(spark)}/signalwatch".removeprefix("file:")
    os.makedirs(shared, exist_ok=True)
    before = set(os.listdir(shared))
    setting(spark__sql__shuffle__partitions="4")  # set from the source's size, and back afterwards
    main([str(folder), str(target), "--file", "orders=my_orders.csv", "--quarantine",
          "--standalone", "--audit", "--trees", "2", "--depth", "2", "--rounds", "1"])
    # nothing but what is documented stays
    assert set(os.listdir(shared)) == before
    printed = capsys.readouterr().out
    assert "top_alerts" in printed and "la_cuisine" in printed
    assert spark.read.parquet(str(target / "reports" / "run_summary")).count() == 1
    main([str(folder), str(target), "--reuse", "--trees", "1", "--depth", "1", "--rounds", "1"])
    assert "sentiment_score" in spark.read.parquet(str(target / "daily_features")).columns
