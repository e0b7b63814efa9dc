"""Work that is spread by the size of the tables and not by their bytes or by one task."""

import datetime
import re
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import plan
from larder.functions import numeric, text
from larder.operators import cleaning, quality, sentiment, sustainability
from larder.plans import catalog, settings as S
from larder.plans.warehouse import Warehouse
from larder.sources import writers

SCORES = "recipeid long, score_country string, score_month int, sustainability_score double, seasonality_score double, " \
    "availability_score double, coverage_score double"
ROWS = [
    (1, "a", 1, 10.0, 1.0, 2.0, 3.0), (1, "a", 2, 20.0, None, 2.0, 3.01), (2, "a", 1, 31.0, 2.0, 2.0, 3.0),
    (1, None, 2, 0.0, 3.0, None, 3.0), (None, "b", None, None, None, None, None),
]


def test_global_stats_sorts_no_rows(spark):
    df = spark.createDataFrame(ROWS, SCORES)
    got = quality.global_stats(df)
    assert tuple(got.first()) == (5, 2, 2, 0.0, 31.0, 15.25, 2.0, 2.0, 3.0)
    assert "ObjectHashAggregate" not in plan(got) and "SortAggregate" not in plan(got)
    assert tuple(quality.global_stats(df.limit(0)).first()) == (0, 0, 0, None, None, None, None, None, None)


def test_stats_by_country_count_recipes_without_the_sums(spark):
    got = quality.stats_by_country(spark.createDataFrame(ROWS, SCORES))
    assert {tuple(r) for r in got.collect()} == {
        ("a", 3, 2, 20.33, 1.5, 2.0, 3.0), (None, 1, 1, 0.0, 3.0, None, 3.0), ("b", 1, 0, None, None, None, None),
    }
    by_recipe = [line for line in plan(got).splitlines() if "keys=[" in line and "recipeid" in line.split("]")[0]]
    assert by_recipe and all("functions=[]" in line for line in by_recipe)


def test_totals_of_longs_do_not_overflow(spark):
    most = 2**63 - 1
    df = spark.createDataFrame([(most,), (most,), (-most - 1,), (-7,), (-1,), (None,)], "v long")
    assert df.agg(numeric.exact_total(F.col("v"))).first()[0] == Decimal(most - 9)
    assert df.where("v is null").agg(numeric.exact_total(F.col("v"))).first()[0] is None
    assert "decimal" not in plan(df.agg(numeric.exact_total(F.col("v")))).lower().split("exchange")[-1]


def test_keys_have_tasks_of_their_own(spark):
    df = spark.range(400).select("id", F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("k"))
    got = writers.spread_keys(df, "k", ["a", "b", "c"], ("id",), 5).groupBy(F.spark_partition_id().alias("p")).agg(
        F.collect_set("k").alias("k"), F.count("*").alias("n")
    ).collect()
    assert len(got) == 15 and all(len(r.k) == 1 for r in got) and sum(r.n for r in got) == 400


def test_seasonality_hashes_the_line_items(spark, tmp_path):
    day = datetime.date
    tables = {
        "part": ("p_partkey long, p_name string, p_type string", [(1, "red ring", "B"), (2, "hot ring", "A"), (3, "red bolt", "C")]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 7)]),
        "nation": ("n_nationkey int, n_name string", [(7, "x")]),
        "orders": ("o_orderkey long, o_orderdate date", [(1, day(2020, 1, 5)), (2, day(2021, 1, 9)), (3, day(2020, 2, 1)), (4, None)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate date",
            [(o, p, 1, q, day(2020, 3, 1)) for o, p, q in [(1, 1, 9.0), (2, 2, 8.0), (3, 1, 1.0), (3, 3, 5.0), (4, 1, 3.0)]],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = Warehouse(spark, str(tmp_path), fresh=True).bronze_seasonality()
    assert {(r.product_name, r.product_type, r.month, r.country) for r in got.collect()} == {
        ("ring", "A", "January", "x"), ("bolt", "C", "February", "x"), ("ring", "B", None, "x"),
    }
    sorted_by = [line for line in plan(got).splitlines() if "SortAggregate" in line and "partial_min" in line]
    assert sorted_by and all("l_quantity" not in line for line in sorted_by)


def test_many_tasks_write_the_csv(spark, tmp_path, monkeypatch):
    rows = [(i, f'text "{i}",\nmore', "en", 12) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    written, real = [], writers.write_csv
    monkeypatch.setattr(catalog.writers, "write_csv", lambda d, p: written.append(d.rdd.getNumPartitions()) or real(d, p))
    assert catalog.QUERIES["A2_csv_parallel"](spark, str(tmp_path)).count() == 9
    assert written == [3]


def longest_method(df, capsys):
    """Bytes of the longest generated method; above 8,000 the JVM interprets it."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)))


def test_recipes_and_sentiment_are_compiled(spark, tmp_path, capsys):
    part = "p_partkey long, p_name string, p_type string, p_size int"
    spark.createDataFrame([(1, "red ring", "B", 20)], part).write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, 3.0)], "l_partkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    texts = "reviewid long, recipeid long, review string"
    spark.createDataFrame([(1, 1, "no red thing")], texts).write.parquet(str(tmp_path / "reviews"))
    w = Warehouse(spark, str(tmp_path), fresh=True)
    assert longest_method(cleaning.clean_recipes(w.bronze_recipes()), capsys) <= 8000
    scored = sentiment.score_reviews(spark.read.parquet(str(tmp_path / "reviews")), w.lexicon(), S.RULES)
    assert longest_method(scored, capsys) <= 8000


def test_a_missing_part_of_a_duration_is_not_cast(spark):
    df = spark.createDataFrame([("PT5M",), ("PT2H",), ("PT",), ("x",), (None,), ("PT99999999999999999999H1M",)], "v string")
    got = df.select(text.duration_minutes(F.col("v")).alias("m"))
    assert [r.m for r in got.collect()] == [5, 120, 0, 0, 0, 1]
    assert "nullif" in plan(got) or "THEN null" in plan(got) or "if (" in plan(got)


def test_clean_text_as_step_by_step(spark):
    ends = ["", ")", " )", ") ", "))", ") ", "  ", " ) \u0085", ") \n", "\n", " \n"]
    starts = ["", "c(", " C (", "\tc\n(", "cc(", "c(c(", "c", " c("]
    inner = ["", "a", "a  b", "a,b", 'x-"y"\t\x0bz', "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "éß   q\r\nw", "’d   e", "c(d) e"]
    rows = [(s + i + e,) for s in starts for i in inner for e in ends] + [(None,)]
    value = text.strip_blanks(F.lower(F.coalesce("v", F.lit(""))))
    for pattern, by in ((r"^c\s*\(", ""), (r"\)$", ""), (r"\p{Punct}", " ")):
        value = F.regexp_replace(value, pattern, by)
    value = F.trim(text.collapse_blanks(value))
    df = spark.createDataFrame(rows, "v string").select("v", value.alias("want"), text.clean_text(F.col("v")).alias("got"))
    assert [r for r in df.collect() if r.want != r.got] == []
    assert str(text.clean_text(F.col("v"))).count("regexp_replace") <= 3


def test_two_months_share_a_sum(spark):
    recipes = spark.createDataFrame([(1, 4, 3, 75.0, ["a", "b", "c"]), (2, 1, 0, 0.0, [])],
        "recipeid long, total_ingredient_tokens long, matched_ingredient_tokens long, coverage_score double, terms array<string>")
    contexts = spark.createDataFrame([("a", "x", 0b100000000011, 0.5), ("b", "x", 0b10, 0.0), ("c", "x", 0, 0.25), ("a", "y", 0, 0.0)],
        "matched_term string, country string, months int, availability_score double")
    got = sustainability.recipe_countries(recipes, contexts)
    assert len([c for c in got.columns if c[0] in "sp"]) == 12
    counts = {
        r.country: ([r[f"s{m}"] for m in range(1, 13)], [r[f"p{m}"] for m in range(1, 13)]) for r in got.select(
            "country", *[sustainability.unpaired(k, m).alias(f"{k}{m}") for k in "sp" for m in range(1, 13)]
        ).collect()
    }
    assert counts == {"x": ([1, 2] + [0] * 9 + [1], [2, 3] + [2] * 10), "y": ([0] * 12, [0] * 12)}
    low = spark.range(1).select(F.lit((5 << 32) + 2**31 - 1).alias("s1_2"))
    assert tuple(low.select(sustainability.unpaired("s", 1), sustainability.unpaired("s", 2)).first()) == (2**31 - 1, 5)


def test_names_are_split_once_a_part(spark, tmp_path):
    day = datetime.date(2020, 1, 5)
    tables = {
        "part": ("p_partkey long, p_name string, p_type string", [(1, "red ring", "B"), (2, None, "A")]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 7)]),
        "nation": ("n_nationkey int, n_name string", [(7, "x")]),
        "orders": ("o_orderkey long, o_orderdate date", [(1, day)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate date",
                     [(1, 1, 1, 9.0, day), (1, 2, 1, 9.0, day)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    w = Warehouse(spark, str(tmp_path), fresh=True)
    assert {(r.product_name, r.product_type) for r in w.bronze_seasonality().collect()} == {("ring", "B"), (None, "A")}
    got = w.bronze_production()
    assert {r.Item for r in got.collect()} == {"red", "ring", "goods, total"}
    exploded = [line for line in plan(got).splitlines() if "Generate explode(concat(" in line]
    assert exploded and all("split" not in line for line in exploded)
