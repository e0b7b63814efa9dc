import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan
from larder.operators import cleaning, quality
from larder.sources import csv_records, pages, readers, schemas, staging, writers


def scores(spark):
    rows = [(i, c, m, float(i)) for i in range(4) for c in ("france", "spain") for m in (1, 2)]
    return spark.createDataFrame(rows, "recipeid long, score_country string, score_month int, sustainability_score double")


def test_latest_snapshot(spark, tmp_path):
    df = spark.range(3)
    writers.write_dated(df, str(tmp_path), "silver_x", "20240101")
    writers.write_dated(df.where("id = 1"), str(tmp_path), "silver_x", "20231231")
    writers.write_dated(df.where("id = 2"), str(tmp_path), "silver_y", "20250101")
    assert readers.read_latest(spark, str(tmp_path), "silver_x_*.parquet").count() == 3
    assert readers.latest_snapshot_path(spark, str(tmp_path), "silver_x_*.parquet").endswith("silver_x_20240101.parquet")
    with pytest.raises(FileNotFoundError):
        readers.read_latest(spark, str(tmp_path), "silver_z_*.parquet")


def test_latest_extraction_folder(spark, tmp_path):
    for day in ("2024-01-02", "2024-01-10"):
        writers.write_csv(spark.range(1), f"{tmp_path}/raw data/extraction_date={day}/recipes.csv")
    path = readers.latest_snapshot_path(spark, f"{tmp_path}/raw data", "extraction_date=*")
    assert path.endswith("raw data/extraction_date=2024-01-10")
    assert readers.read_csv(spark, f"{path}/recipes.csv", spark.range(1).schema).count() == 1


def small_ranges(spark, size):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for key in keys:
        spark.conf.set(key, size)
    return lambda: [spark.conf.unset(key) for key in keys]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_one_file_in_many_ranges_equals_the_read_by_one_task(spark, tmp_path, newline):
    rng = random.Random(3)
    parts = ["a", '""', ",", newline, newline * 3, " ", "é", "x" * 90, "''", "1"]
    lines = ["id,text,n,share,flag,empty,mixed"]
    for i in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        lines.append(f'{i},"{text}",{rng.choice(["", i * 3])},{i / 8},{rng.choice(["true", "False"])},,{rng.choice(["1", "b"])}')
        if i % 50 == 0:
            lines.append(f'{1000 + i},"{(newline + "long") * 300}",7,1e3,true,,c')  # across ranges
    path = tmp_path / "one.csv"
    path.write_bytes(newline.join(lines).encode())
    schema = "id long, text string, n long, share double, flag boolean, empty string, mixed string"
    whole = readers.read_csv(spark, str(path), T._parse_datatype_string(schema), multi_line=True).collect()
    undo = small_ranges(spark, 700)
    try:
        assert csv_records.record_lines(spark, str(path)).select("range").distinct().count() > 30
        given = csv_records.read_csv_parallel(spark, str(path), T._parse_datatype_string(schema)).collect()
        inferred = csv_records.read_csv_parallel(spark, str(path))
        got = inferred.collect()
    finally:
        undo()
    assert sorted(map(tuple, given), key=repr) == sorted(map(tuple, whole), key=repr) and len(whole) == 408
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, whole), key=repr)
    theirs = duckdb.sql(f"select * from read_csv('{path}', header=true, quote='\"', escape='\"', sample_size=-1)")
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}
    assert [(n, kinds[t]) for n, t in inferred.dtypes] == list(zip(theirs.columns, map(str, theirs.types)))


def test_first_in_file_order_is_kept(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.randrange(40), i, rng.choice("zyxa")) for i in range(900)]
    lines = ["reviewid,recipeid,rating,review"] + [f'{k},{i},3,"{t}\n{i}"' for k, i, t in rows]
    path = tmp_path / "reviews.csv"
    path.write_text("\n".join(lines))
    first = {}
    for k, i, _ in rows:
        first.setdefault(k, i)
    undo = small_ranges(spark, 500)
    try:
        bronze = csv_records.read_csv_parallel(spark, str(path), in_order=True)
        kept = {r.reviewid: r.recipeid for r in cleaning.clean_reviews(bronze).collect()}
    finally:
        undo()
    assert kept == first and set(cleaning.clean_reviews(bronze).columns) == {"reviewid", "recipeid", "rating", "review", "processed_at"}
    parquet = tmp_path / "reviews.parquet"
    spark.createDataFrame(rows, "reviewid long, recipeid long, review string").withColumn("rating", F.lit(1.0)).coalesce(1).write.parquet(str(parquet))
    ordered = readers.read_parquet_in_order(spark, str(parquet))
    assert {r.reviewid: r.recipeid for r in cleaning.clean_reviews(ordered).collect()} == first


def test_files_without_rows_and_odd_names(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text('"na.me","na,me"\n1,2\n\n')
    (tmp_path / "d" / "b.csv").write_text('"na.me","na,me"\n')
    (tmp_path / "d" / "c.csv").write_text("")
    got = csv_records.read_csv_parallel(spark, str(tmp_path / "d"))
    assert got.dtypes == [("na.me", "bigint"), ("na,me", "bigint")] and [tuple(r) for r in got.collect()] == [(1, 2)]
    (tmp_path / "e.csv").write_text("")
    assert csv_records.read_csv_parallel(spark, str(tmp_path / "e.csv")).count() == 0


def test_csv_keeps_quotes_newlines_and_blanks(spark, tmp_path):
    rows = [(1, 'say "hi",\nthen  go '), (2, " lead"), (3, "plain")]
    df = spark.createDataFrame(rows, "id long, t string")
    path = writers.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, readers.read_csv(spark, path, df.schema, multi_line=True).collect())) == rows


def test_partitioned_sink_and_sources(spark, tmp_path):
    path = str(tmp_path / "g")
    df = scores(spark)
    writers.write_by_country(writers.spread(df, "score_country", ("recipeid",)), path)
    writers.write_by_country(df.where("score_country = 'spain' and recipeid = 0"), path, only_present=True)
    back = spark.read.parquet(path)
    assert back.where("score_country = 'france'").count() == 8
    assert back.where("score_country = 'spain'").count() == 2
    one = readers.read_country_month(spark, path, "France ", 2)
    assert one.count() == 4 and re.search(r"PartitionFilters: \[[^\]]*score_country", plan(one))
    with pytest.raises(LookupError):
        readers.read_country_month(spark, path, "peru", 1)
    with pytest.raises(LookupError):
        readers.read_country_month(spark, path, "france", 12)
    named = readers.read_recursive(spark, path, "score_country").groupBy("score_country").count()
    assert {tuple(r) for r in named.collect()} == {("france", 8), ("spain", 2)}


def test_country_scores_fall_back_to_the_flat_table(spark, tmp_path):
    parts, flat = str(tmp_path / "p"), str(tmp_path / "f")
    writers.write_by_country(scores(spark).where("score_country = 'france'"), parts)
    writers.write_parquet(scores(spark), flat)
    assert readers.read_country_scores(spark, parts, "France").count() == 8
    assert readers.read_country_scores(spark, parts, "Spain", flat).count() == 8
    assert readers.read_country_scores(spark, parts, "Peru", flat).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_country_scores(spark, str(tmp_path / "none"), "Peru")


def test_parquet_reader_prunes_columns(spark, tmp_path):
    path = writers.write_parquet(scores(spark), f"file://{tmp_path}/q")
    assert "ReadSchema: struct<recipeid:bigint>" in plan(readers.read_parquet(spark, path, ["recipeid"]))


def test_sql_model_and_sample(spark, tmp_path):
    spark.range(500).createOrReplaceTempView("numbers")
    path = writers.write_sql_model(spark, "SELECT id, id * 2 AS d FROM numbers", str(tmp_path / "m"))
    assert spark.read.parquet(path).agg(F.sum("d")).first()[0] == 249500
    sample = writers.write_sample(spark.range(500), str(tmp_path / "s"), "id")
    back = readers.read_csv(spark, sample, spark.range(1).schema)
    assert back.agg(F.count("*"), F.max("id")).first() == (100, 99)


def test_season_rows_from_pages(spark):
    html = (
        '<div class="fvgrid"><div class="item june-france may-spain-x odd"><img><strong> Tomato </strong></div>'
        '<div class="item july-italy"><strong>Fig</strong></div><div class="item june-france">no name</div></div>'
    )
    got = pages.season_rows(spark.createDataFrame([(html,)], "html string"), "html", "vegetable", "EUFIC")
    rows = {(r.product_name, r.month, r.country, r.product_type, r.source) for r in got.collect()}
    assert rows == {
        ("Tomato", "june", "france", "vegetable", "EUFIC"), ("Tomato", "may", "spain", "vegetable", "EUFIC"),
        ("Fig", "july", "italy", "vegetable", "EUFIC"),
    }


def test_taxonomy(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"categories": {" Apple": "Fruit ", "": "x", "beef": "meat"}}))
    assert readers.read_taxonomy(spark, str(path)) == [("apple", "fruit"), ("beef", "meat")]
    path2 = tmp_path / "u.json"
    path2.write_text(json.dumps({"b": "1", "a": "2"}))
    assert readers.read_taxonomy(spark, str(path2)) == [("b", "1"), ("a", "2")]
    table = readers.taxonomy_table(spark.createDataFrame([(path.read_text(),)], "value string"))
    assert [(r.term, r.category) for r in table.orderBy("pos").collect()] == [("apple", "fruit"), ("beef", "meat")]
    assert readers.read_taxonomy(spark, str(tmp_path / "none.json")) == []
    path2.write_text("[1]")
    with pytest.raises(ValueError):
        readers.read_taxonomy(spark, str(path2))


def test_contract_and_names(spark):
    df = spark.createDataFrame([(1, 2)], "RecipeId int, Name int")
    assert schemas.lower_names(df).columns == ["recipeid", "name"]
    with pytest.raises(ValueError, match="missing"):
        schemas.require_columns(df, ["other"])


def test_staged_tables_use_the_shared_folder(spark):
    df = staging.stage(spark.range(10), "numbers")
    assert df.count() == 10
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert folder.rstrip("/") in df.inputFiles()[0]


def test_checks(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 500.0), (None, -1.0), (2, None)], "k int, v double")
    got = {(r.check, r.column): r.violations for r in quality.column_checks(
        df, not_null=["k", "v"], unique=["k"], ranges={"v": (0, 100)}).collect()}
    assert got == {("not_null", "k"): 1, ("not_null", "v"): 1, ("accepted_range", "v"): 2, ("unique", "k"): 1}
    nulls = {r.column: (r.rows, r.nulls) for r in quality.profile(df).collect()}
    assert nulls == {"k": (4, 1), "v": (4, 1)}


def test_tolerance(spark):
    df = spark.createDataFrame([(45809, 82.47)], "recipeid long, appeal_score double")
    assert quality.score_within(df, "recipeid", 45809, "appeal_score", 82.45, 0.02).count() == 1
    assert quality.score_within(df, "recipeid", 45809, "appeal_score", 82.40, 0.02).count() == 0


def test_distribution(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 19.99, 20.0, 80.0, 100.0)], "sustainability_score double")
    got = {r.score_range: (r.rows, r.percentage) for r in quality.score_distribution(df).collect()}
    assert got == {"0-20": (2, 40.0), "20-40": (1, 20.0), "80-100": (2, 40.0)}


def test_plain_csv_is_split_and_only_snapshots_are_listed(spark, tmp_path):
    for day in ("20240101", "20240309", "20231231"):
        for i in range(3):
            part = tmp_path / f"raw_{day}" / f"part={i}"
            part.mkdir(parents=True)
            (part / "x.csv").write_text("id,t\n" + "".join(f'{j},"a ""b"""\n' for j in range(20_000)))
    path = readers.latest_snapshot_path(spark, str(tmp_path), "raw_*")
    assert path.rstrip("/").endswith("raw_20240309")
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot_path(spark, str(tmp_path), "none_*")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        schema = spark.createDataFrame([], "id long, t string").schema
        rows = readers.read_csv(spark, f"{path}/part=0/x.csv", schema)
        assert rows.count() == 20_000 and rows.rdd.getNumPartitions() > 1
        assert rows.first()["t"] == 'a "b"'
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_two_taxonomy_files_are_refused(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text("{}")
    with pytest.raises(ValueError):
        readers.read_taxonomy(spark, str(tmp_path))


def test_lexicon_reader_keeps_the_last_entry(spark, tmp_path):
    (tmp_path / "l.txt").write_text("good\t1.9\t0.5\t[1, 2]\nbad\t-2.5\n\nodd\nworse\tx\ngood\t2.1\n:)\t2.0\n")
    rows = readers.read_lexicon(spark, str(tmp_path / "l.txt")).collect()
    assert sorted(map(tuple, rows)) == [(":)", 2.0), ("bad", -2.5), ("good", 2.1)]
