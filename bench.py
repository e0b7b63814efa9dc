"""Headline timings: prints one JSON line.

Every step starts from the driver tables or from the written output of the step before it, as in
a daily build; serving queries read the written Gold tables. ``$BENCH_SF_DIR`` and
``$BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.operators import segments, sentiment, serving, sustainability  # noqa: E402
from larder.plans import settings as S  # noqa: E402
from larder.plans.catalog import BASKET, CONTEXT, ingredients, view  # noqa: E402
from larder.plans.warehouse import Warehouse  # noqa: E402


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("larder-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def drain(df: DataFrame) -> None:
    """Compute every row without collecting any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    w = Warehouse(spark, sf_dir, fresh=True)
    # Start-up cost of the session is not part of any step.
    drain(w.driver("nation").groupBy("n_regionkey").count().join(w.driver("region"), F.expr("n_regionkey = r_regionkey")))
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.time()
        action()
        times[name] = round(time.time() - start, 3)

    timed("clean_recipes", w.recipes)
    timed("clean_reviews", w.reviews)
    timed("clean_seasonality", w.season)
    timed("clean_production", w.production)

    def match():
        w.matches()
        w.recipe_map()
        w.recipe_matches()

    timed("ingredient_matching", match)
    timed("sentiment_full", w.sentiment)
    timed(
        "sentiment_percentile_only",
        lambda: drain(sentiment.add_percentile_rank(w.sentiment().drop("sentiment_percentile"))),
    )
    timed("recommendation_score", w.recommendations)
    timed("segment_features", w.features)

    def segment():
        drain(segments.elbow(w.features(), segments.FEATURES))
        drain(segments.cluster(w.features(), segments.FEATURES))

    timed("clustering_elbow_and_final", segment)
    timed("segment_labels", lambda: (w.profiles(), w.clusters()))
    timed(
        "sustainability_one_context",
        lambda: drain(
            sustainability.sustainability_scores(
                w.recipe_matches(), w.season(), w.production(), S.COUNTRY, S.MONTH
            )
        ),
    )
    timed("sustainability_all_contexts", lambda: (w.sustainability_path(), w.sustainability()))
    timed("serving_view", lambda: drain(view(w)))
    timed("basket_recommendations", lambda: drain(serving.basket_recommendations(w.gold(), *CONTEXT, S.BASKET)))
    timed("basket_tiers", lambda: drain(serving.filter_by_basket(view(w), BASKET, S.FALLBACK_BASKET, ingredients(w))))
    timed("top_recommendations", lambda: drain(serving.recommendations(w.gold(), *CONTEXT)))
    timed("ingredient_buckets", lambda: drain(serving.ingredient_buckets(w.recipe_map(), S.TAXONOMY)))
    result = {
        "metric": "total wall time of the headline steps",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
