"""Domain tables derived from the driver tables: Bronze, Silver and Gold.

Each table is written once per application to the shared folder and read back by every query
that needs it, so serving queries start from Gold parquet with column and partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from larder.operators import cleaning, matching, scoring, segments, sentiment, sustainability
from larder.operators.serving import GoldTables
from larder.plans import settings as S
from larder.sources.staging import literal_table, new_path, stage
from larder.sources.writers import write_by_country

_tables: dict[tuple[str, str, str], DataFrame] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, fresh: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.fresh = {} if fresh else None

    def driver(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _kept(self, name: str, build) -> DataFrame:
        store = _tables if self.fresh is None else self.fresh
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in store:
            store[key] = build()
        return store[key]

    def _table(self, name: str, build) -> DataFrame:
        return self._kept(name, lambda: stage(build(), name))

    # --- Bronze ---------------------------------------------------------------------

    def ratings(self) -> DataFrame:
        stars = F.lit(1) + F.col("l_quantity").cast("long") % 5
        return (
            self.driver("lineitem")
            .groupBy(F.col("l_partkey").cast("long").alias("RecipeId"))
            .agg(
                (F.sum(stars).cast("double") / F.count("*").cast("double")).alias(
                    "AggregatedRating"
                ),
                F.count("*").cast("double").alias("ReviewCount"),
            )
        )

    def bronze_recipes(self) -> DataFrame:
        noun = F.split("p_name", " ")[1]
        part = self.driver("part").select(
            F.col("p_partkey").cast("long").alias("RecipeId"),
            F.concat(F.upper("p_name"), F.lit("!")).alias("Name"),
            F.concat(F.lit("PT"), "p_size", F.lit("M")).alias("CookTime"),
            F.when(
                F.col("p_size") % 5 != 0,
                F.concat(F.lit("PT"), F.col("p_size") * 2, F.lit("M")),
            ).alias("PrepTime"),
            F.concat(
                F.lit("PT"),
                F.floor(F.col("p_size") * 3 / 60).cast("string"),
                F.lit("H"),
                (F.col("p_size") * 3 % 60).cast("string"),
                F.lit("M"),
            ).alias("TotalTime"),
            F.col("p_type").alias("RecipeCategory"),
            F.concat(
                F.lit('c("'), "p_name", F.lit('", "'), noun,
                F.when(F.col("p_size") % 2 == 1, "s").otherwise(""), F.lit('", "'), "p_type",
                F.lit('", "with the 12")'),
            ).alias("RecipeIngredientParts"),
            F.concat(
                F.lit("Take the "), "p_name", F.lit(". Mix until smooth! 2. Serve with a "),
                F.lower("p_type"), F.lit(" garnish."),
            ).alias("RecipeInstructions"),
        )
        return part.join(self.ratings(), "RecipeId", "left")

    def bronze_reviews(self) -> DataFrame:
        return self.driver("documents").select(
            F.col("doc_id").alias("ReviewId"),
            F.floor(F.col("doc_id") / 2).alias("RecipeId"),
            (F.col("n_chars") % 5 + 1).cast("double").alias("Rating"),
            F.col("text").alias("Review"),
        )

    def shipped(self) -> DataFrame:
        """Line items with the words of the part and the country of the supplier.

        Names are split once for each part; ``unsplit`` keeps the name that has no second word.
        """
        words = F.split("p_name", " ")
        noun = F.get(words, 1)
        return (
            self.driver("lineitem")
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
            .join(
                self.driver("supplier").select("s_suppkey", "s_nationkey"),
                F.col("l_suppkey") == F.col("s_suppkey"),
            )
            .join(
                self.driver("nation").select("n_nationkey", "n_name"),
                F.col("s_nationkey") == F.col("n_nationkey"),
            )
            .join(
                self.driver("part").select(
                    "p_partkey", "p_type", words.alias("words"), noun.alias("noun"),
                    F.when(noun.isNull(), F.col("p_name")).alias("unsplit"),
                ),
                F.col("l_partkey") == F.col("p_partkey"),
            )
        )

    def bronze_seasonality(self) -> DataFrame:
        """A product is in season in the months whose quantity is above the year's mean."""
        orders = self.driver("orders").select("o_orderkey", F.month("o_orderdate").alias("number"))
        monthly = (
            self.shipped()
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            # Sums of numbers are hashed; a least text beside them would have all rows sorted.
            .groupBy(
                F.coalesce("noun", F.split("unsplit", " ")[1]).alias("product_name"),
                "number",
                F.col("n_name").alias("country"),
                "p_type",
            )
            .agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
            .groupBy("product_name", "number", "country")
            .agg(F.sum("q").alias("q"), F.min("p_type").alias("product_type"))
            .withColumn("month", F.date_format(F.make_date(F.lit(2000), "number", F.lit(1)), "MMMM"))
        )
        year = F.sum("q").over(W.partitionBy("product_name", "country"))
        return (
            monthly.withColumn("year", year)
            .where("q * 12 > year")
            .select(
                "product_name", "product_type", "month", "country",
                F.lit("EUFIC").alias("source"),
                F.lit("2024-01-01T00:00:00").alias("extracted_at"),
            )
        )

    def bronze_production(self) -> DataFrame:
        words = F.concat("words", F.array(F.lit("goods, total")))
        summed = (
            self.shipped()
            .select(
                "n_nationkey", "n_name", F.explode(words).alias("word"),
                F.year("l_shipdate").alias("y"), F.col("l_quantity").cast("long").alias("q"),
            )
            .groupBy("n_nationkey", "n_name", "word", "y")
            .agg(F.sum("q").alias("amount"), F.count("*").alias("lots"))
        )
        element = F.explode(
            F.array(
                F.struct(F.lit("Production").alias("Element"), F.col("amount").alias("v")),
                F.struct(F.lit("Area harvested").alias("Element"), F.col("lots").alias("v")),
            )
        )
        return summed.withColumn("e", element).select(
            F.col("n_nationkey").cast("long").alias("Area Code"),
            F.col("n_name").alias("Area"),
            (F.ascii("word") * 1000 + F.ascii(F.substring("word", 2, 1)))
            .cast("long")
            .alias("Item Code"),
            F.col("word").alias("Item"),
            F.col("e.Element").alias("Element"),
            F.col("y").cast("string").alias("Year"),
            F.lit("t").alias("Unit"),
            F.col("e.v").cast("string").alias("Value"),
        )

    # --- Silver ---------------------------------------------------------------------

    def recipes(self) -> DataFrame:
        return self._table("silver_recipes", lambda: cleaning.clean_recipes(self.bronze_recipes()))

    def reviews(self) -> DataFrame:
        order = [F.length("review"), F.col("review")]
        return self._table(
            "silver_reviews", lambda: cleaning.clean_reviews(self.bronze_reviews(), order)
        )

    def season(self) -> DataFrame:
        return self._table(
            "silver_season", lambda: cleaning.clean_seasonality(self.bronze_seasonality())
        )

    def production(self) -> DataFrame:
        return self._table(
            "silver_production", lambda: cleaning.clean_production(self.bronze_production())
        )

    # --- Gold -----------------------------------------------------------------------

    def lexicon(self) -> DataFrame:
        return literal_table(self.spark, "word string, valence double", S.LEXICON)

    def scored_reviews(self) -> DataFrame:
        return self._table(
            "scored_reviews",
            lambda: sentiment.score_reviews(self.reviews(), self.lexicon(), S.RULES),
        )

    def sentiment(self) -> DataFrame:
        return self._table(
            "gold_sentiment",
            lambda: sentiment.add_percentile_rank(
                sentiment.aggregate_by_recipe(self.scored_reviews())
            ),
        )

    def vocabulary(self) -> DataFrame:
        return self._table(
            "vocabulary", lambda: matching.build_vocabulary(self.season(), self.production())
        )

    def index(self) -> DataFrame:
        return self._table("ngram_index", lambda: matching.ngram_index(self.vocabulary()))

    def best_terms(self) -> DataFrame:
        return self._table(
            "best_terms",
            lambda: matching.match_tokens(
                stage(matching.distinct_tokens(self.recipes()), "distinct-tokens"),
                self.vocabulary(), self.index(),
            ),
        )

    def matches(self) -> DataFrame:
        return self._table(
            "gold_matches", lambda: matching.decide_matches(self.best_terms(), S.TAXONOMY)
        )

    def recipe_matches(self) -> DataFrame:
        return self._table(
            "gold_recipe_matches",
            lambda: matching.recipe_ingredient_matches(self.recipes(), self.matches()),
        )

    def recipe_map(self) -> DataFrame:
        return self._table(
            "gold_recipe_map", lambda: matching.recipe_map(self.recipes(), self.matches())
        )

    def recommendations(self) -> DataFrame:
        return self._table(
            "gold_recommendations",
            lambda: scoring.score_recipes(self.recipes(), self.sentiment()),
        )

    def features(self) -> DataFrame:
        return self._table(
            "features",
            lambda: segments.build_features(
                segments.feature_join(self.recommendations(), self.sentiment(), self.recipe_map())
            ),
        )

    def assigned(self) -> DataFrame:
        """Features with a cluster id given by the data, so that SQL can repeat it."""
        number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
        given = self.driver("part").select(
            F.col("p_partkey").cast("long").alias("recipeid"), (number % 5).alias("cluster_id")
        )
        return self._table("assigned", lambda: self.features().join(given, "recipeid"))

    def profiles(self) -> DataFrame:
        return self._table(
            "gold_profiles",
            lambda: segments.label_profiles(segments.build_profiles(self.assigned())),
        )

    def clusters(self) -> DataFrame:
        return self._table(
            "gold_clusters",
            lambda: segments.attach_labels(self.assigned(), self.profiles()).select(
                "recipeid", "cluster_id", "cluster_label"
            ),
        )

    def sustainability_path(self) -> str:
        """All contexts as rows, by country and month, for readers of files."""
        def build():
            path = new_path(self.spark, "gold_sustainability")
            scores = sustainability.sustainability_scores(
                self.recipe_matches(), self.season(), self.production(), spread_countries=True
            )
            return write_by_country(scores.withColumn("processed_at", F.current_timestamp()), path)

        return self._kept("gold_sustainability_path", build)

    def folded_path(self) -> str:
        """All contexts by country, the twelve months of a recipe side by side in one row."""
        def build():
            path = new_path(self.spark, "gold_sustainability_folded")
            sums = sustainability.folded_scores(
                self.recipe_matches(), self.season(), self.production(), spread_countries=True
            )
            return write_by_country(
                sums.withColumn("processed_at", F.current_timestamp()), path, "country", ("recipeid",)
            )

        return self._kept("gold_sustainability_folded_path", build)

    def sustainability(self) -> DataFrame:
        """All contexts as rows; the months are unfolded behind the scan."""
        folded = self.spark.read.parquet(self.folded_path())
        return sustainability.score_contexts(folded, keep=("processed_at",))

    def gold(self) -> GoldTables:
        return GoldTables(
            self.recommendations(), self.sustainability(), self.clusters(), self.recipe_map(),
            self.sentiment(),
        )


