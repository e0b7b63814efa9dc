"""

Recipes and reviews are repeated under new ids, so vocabulary and texts stay those of the driver
tables while the row counts grow. Prints one line per step.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, functions as F

from bench import drain, session
from larder.operators import matching, scoring, segments, sentiment, sustainability
from larder.plans import settings as S
from larder.plans.warehouse import Warehouse
from larder.sources.staging import stage


def repeated(df: DataFrame, times: int, steps: dict[str, int]) -> DataFrame:
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    for name, step in steps.items():
        copies = copies.withColumn(name, F.col(name) + F.col("copy") * step)
    return stage(copies.drop("copy").repartition(32), "repeated")


def main() -> None:
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    w = Warehouse(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), fresh=True)
    recipe_step = w.recipes().agg(F.max("recipeid")).first()[0] + 1
    review_step = w.reviews().agg(F.max("reviewid")).first()[0] + 1
    recipes = repeated(w.recipes(), 26, {"recipeid": recipe_step})
    reviews = repeated(w.reviews(), 18, {"reviewid": review_step, "recipeid": recipe_step})
    season, production = w.season(), w.production()

    def timed(name: str, action):
        start = time.time()
        result = action()
        print(f"{name}: {time.time() - start:.1f} s", flush=True)
        return result

    def match():
        found = stage(matching.match_ingredients(recipes, season, production, S.TAXONOMY), "m")
        return (
            stage(matching.recipe_ingredient_matches(recipes, found), "long"),
            stage(matching.recipe_map(recipes, found), "map"),
        )

    def feel():
        scored = sentiment.score_reviews(reviews, w.lexicon(), S.RULES)
        return stage(
            sentiment.add_percentile_rank(sentiment.aggregate_by_recipe(scored)), "sentiment"
        )

    def segment():
        features = stage(
            segments.build_features(segments.feature_join(scores, mood, recipe_map)), "features"
        )
        drain(segments.elbow(features, segments.FEATURES))
        drain(segments.cluster(features, segments.FEATURES))

    long, recipe_map = timed("ingredient matching", match)
    mood = timed("sentiment", feel)
    scores = timed("recommendation score", lambda: stage(scoring.score_recipes(recipes, mood), "scores"))
    timed("features and clustering", segment)
    timed(
        "sustainability, all contexts",
        lambda: drain(sustainability.sustainability_scores(long, season, production)),
    )
    spark.stop()


if __name__ == "__main__":
    main()
