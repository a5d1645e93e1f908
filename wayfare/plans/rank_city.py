"""From reviews to the ranked list of a held-out city."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators.ranking import rank_scores
from wayfare.operators.scores import observed_scores
from wayfare.plans.model import (
    CountedReviews,
    RatingModel,
    accuracy,
    count_reviews,
    fit,
    fit_every_city,
    predicted_scores,
    scores_of_predictions,
    training_parts,
)
from wayfare.sources import lines
from wayfare.sources.ranked import write_ranked
from wayfare.sources.tables import land_reviews, landed_reviews, of_city


def rank_observed(reviews: DataFrame, held_out: str) -> DataFrame:
    """``(city, attraction, n, score, rank)`` by the stars given."""
    return rank_scores(observed_scores(of_city(reviews, held_out)))


@dataclass
class CityRanking:
    """Both ranked lists of a city, the model and its accuracy; each is computed when asked for."""

    reviews: DataFrame
    held_out: str
    skip_empty: bool = False

    @cached_property
    def observed(self) -> DataFrame:
        return rank_observed(self.reviews, self.held_out)

    @cached_property
    def _parts(self) -> tuple[DataFrame, DataFrame]:
        return training_parts(self.reviews, self.held_out, skip_empty=self.skip_empty)

    @cached_property
    def model(self) -> RatingModel:
        return fit(self._parts[0])

    @cached_property
    def predicted(self) -> DataFrame:
        return rank_scores(predicted_scores(self.model, of_city(self.reviews, self.held_out)))

    @cached_property
    def accuracy(self) -> DataFrame:
        return accuracy(self.model, self._parts[1])


def rank_city(reviews: DataFrame, held_out: str, skip_empty: bool = False) -> CityRanking:
    """Train on the other cities, then score and rank the held-out one."""
    return CityRanking(reviews, held_out, skip_empty)


@dataclass
class EveryCityRanking:
    """Each city held out in turn; texts are read once for all of them."""

    reviews: DataFrame
    cities: list[str]
    skip_empty: bool = False

    @cached_property
    def _counted(self) -> CountedReviews:
        return count_reviews(self.reviews)

    @cached_property
    def models(self) -> dict[str, RatingModel]:
        return fit_every_city(self._counted, self.cities, skip_empty=self.skip_empty)

    @cached_property
    def predicted(self) -> DataFrame:
        """The lists that ``rank_city(reviews, city).predicted`` gives, city by city."""
        rated = [
            self.models[city].predict_counted(of_city(self._counted.rows, city)).select("city", "attraction", "predicted_rating")
            for city in self.cities
        ]
        return rank_scores(scores_of_predictions(reduce(DataFrame.unionByName, rated)))


def rank_every_city(reviews: DataFrame, cities: list[str], skip_empty: bool = False) -> EveryCityRanking:
    """For each city train on the others, then score and rank it."""
    return EveryCityRanking(reviews, cities, skip_empty)


def publish(spark: SparkSession, files: str, target: str, cities: list[str], bars: bool = False) -> DataFrame:
    """The whole job, from collected files to ranked lists.

    Scans ``<city>/<attraction>.txt`` with stable ids, keeps broken lines under
    ``target/quarantine``, lands the reviews, ranks each city by its stars and writes
    the lists under ``target/ranked``. Returns ``(city, attraction, n, score, rank)``.
    ``rank_city`` on the landed reviews adds the predicted list of a held-out city.
    """
    scanned = lines.scan_city_folders(spark, f"{files}/*/*.txt", stable=True)
    parsed = lines.parse_lines(scanned, bars=bars)
    lines.quarantined(parsed).select("line_id", "city", "attraction", "line").write.parquet(f"{target}/quarantine")
    land_reviews(lines.reviews_of(scanned, bars), f"{target}/reviews")
    reviews = landed_reviews(spark, f"{target}/reviews")
    ranked = rank_scores(observed_scores(reviews.filter(reviews["city"].isin(cities))))
    write_ranked(ranked, f"{target}/ranked")
    return ranked
