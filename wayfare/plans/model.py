"""The rating classifier: hashed TF-IDF and multinomial logistic regression."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    IDF,
    ElementwiseProduct,
    HashingTF,
    IndexToString,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.cluster import scratch_path
from wayfare.functions.fixed import HASH_BUCKETS, MAX_ITER, MIN_DOC_FREQ, STOP_WORDS
from wayfare.operators.balance import balanced, class_cutoffs, up_to
from wayfare.operators.labels import ATTRACTION
from wayfare.operators.scores import star_points
from wayfare.operators.split import random_parts, with_split
from wayfare.sources.tables import except_city

#: training rows that make a task worth its overhead in each iteration
ROWS_PER_TASK = 20_000
#: layout of a saved model; a reader refuses others
SAVED_VERSION = 1


def _word_sql(keep_empty: bool, words: Sequence[str]) -> str:
    """Clean, tokenise and drop stop words as one SQL statement.

    A statement is saved with the model, and stays in the generated code where
    the tokeniser and remover stages convert each array to objects and back.
    The words are theirs all the same: with ``keep_empty`` two blanks enclose
    an empty word, blanks at the end none, and an empty text is one empty word.
    """
    escaped = [word.replace("\\", "\\\\").replace("'", "\\'") for word in words]
    literals = ", ".join(f"'{word}'" for word in escaped)
    pieces = "CASE WHEN trim(_clean) = '' AND _clean <> '' THEN array() ELSE split(rtrim(_clean), ' ') END"
    empty = "" if keep_empty else " AND (word <> '' OR trim(_clean) = '')"
    return (
        f"SELECT * EXCEPT (_clean), filter({pieces}, word -> word NOT IN ({literals}){empty}) AS review_words "
        "FROM (SELECT *, regexp_replace(lower(coalesce(review, '')), '[^a-z ]++', '') AS _clean FROM __THIS__)"
    )


def counting_stages(keep_empty: bool = True, stop_words: Sequence[str] = STOP_WORDS) -> PipelineModel:
    """Clean, tokenise, drop stop words, count hashed terms; nothing to fit.

    The tokeniser yields an empty word between two blanks, which is counted
    like any other; ``keep_empty=False`` drops them where a text has words.
    """
    return PipelineModel(
        [
            SQLTransformer(statement=_word_sql(keep_empty, stop_words)),
            HashingTF(numFeatures=HASH_BUCKETS, inputCol="review_words", outputCol="tf_review"),
        ]
    )


def idf_stage(min_doc_freq: int = MIN_DOC_FREQ) -> IDF:
    return IDF(inputCol="tf_review", outputCol="features", minDocFreq=min_doc_freq)


@dataclass(frozen=True)
class RatingModel:
    """Fitted text stages, classifier and the ratings its labels stand for."""

    text: PipelineModel
    classifier: LogisticRegressionModel
    labels: list[str]

    def predict(self, reviews: DataFrame) -> DataFrame:
        """Add ``probability``, ``prediction`` and ``predicted_rating``.

        The weights and labels are those of training. No label is needed, so
        a rating unseen in training does no harm.
        """
        return self._decoded(self.text.transform(reviews).drop("review_words", "tf_review"))

    def predict_counted(self, counted: DataFrame) -> DataFrame:
        """The same for rows that have their term counts in ``tf_review`` already."""
        return self._decoded(self.text.stages[-1].transform(counted).drop("tf_review"))

    def _decoded(self, features: DataFrame) -> DataFrame:
        decode = IndexToString(
            inputCol="prediction", outputCol="predicted_rating", labels=self.labels
        )
        predicted = decode.transform(self.classifier.transform(features))
        return predicted.drop("features", "rawPrediction")

    def save(self, spark: SparkSession, path: str) -> None:
        """Keep the model under ``path``, which must not hold one.

        Text stages and classifier in Spark ML's own form, the labels by place as
        Parquet; the version is written last, so a half-written model has none.
        """
        self.text.save(f"{path}/text")
        self.classifier.save(f"{path}/classifier")
        places = [(place, rating) for place, rating in enumerate(self.labels)]
        spark.createDataFrame(places, "label int, rating string").coalesce(1).write.parquet(f"{path}/labels")
        spark.createDataFrame([(SAVED_VERSION,)], "version int").coalesce(1).write.parquet(f"{path}/version")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RatingModel:
        """The model that ``save`` kept; another session's does as well."""
        version = spark.read.schema("version int").parquet(f"{path}/version").first()[0]
        if version != SAVED_VERSION:
            raise ValueError(f"{path} holds a model of version {version}, not {SAVED_VERSION}")
        labels = spark.read.schema("label int, rating string").parquet(f"{path}/labels").orderBy("label").collect()
        return RatingModel(
            PipelineModel.load(f"{path}/text"),
            LogisticRegressionModel.load(f"{path}/classifier"),
            [row["rating"] for row in labels],
        )


def fit(
    train: DataFrame,
    max_iter: int = MAX_ITER,
    min_doc_freq: int = MIN_DOC_FREQ,
    counting: PipelineModel | None = None,
) -> RatingModel:
    """Fit on ``(rating, review)``; only model parameters reach the driver.

    ``counting`` replaces the default ``counting_stages()``.
    """
    counting = counting or counting_stages()
    # every iteration waits for its largest task and is a job over all partitions: rows are
    # dealt out evenly, over as many tasks as their number is worth
    tasks = -(-train.count() // ROWS_PER_TASK)
    dealt = train.select("rating", "review").repartition(max(1, tasks), F.xxhash64("rating", "review"))
    # tokenised once; three fits read the counts
    counts = counting.transform(dealt).select("rating", "tf_review")
    counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = idf_stage(min_doc_freq).fit(counts)
        indexer = StringIndexer(inputCol="rating", outputCol="label").fit(counts)
        examples = indexer.transform(weights.transform(counts)).select("label", "features")
        classifier = LogisticRegression(
            maxIter=max_iter, labelCol="label", featuresCol="features"
        ).fit(examples)
    finally:
        counts.unpersist()
    text = PipelineModel([*counting.stages, weights])
    return RatingModel(text, classifier, list(indexer.labels))


@dataclass(frozen=True)
class CountedReviews:
    """Term counts of reviews as a written table, in the two forms that steps read."""

    #: ``(key, rating, city, attraction, tf_review)``
    rows: DataFrame
    #: ``(key, rating, city, terms)``, the buckets that occur
    terms: DataFrame
    counting: PipelineModel
    key: str


def count_reviews(reviews: DataFrame, counting: PipelineModel | None = None, key: str = "review_id") -> CountedReviews:
    """Read and tokenise each text once; ``counting`` replaces the default ``counting_stages()``."""
    counting, spark = counting or counting_stages(), reviews.sparkSession
    path = scratch_path(spark, "counted")
    counted = counting.transform(reviews.select(key, "rating", "city", "attraction", "review"))
    rows = counted.select(key, "rating", "city", "attraction", "tf_review")
    rows.write.parquet(path)
    # a stored sparse vector is a plain struct: its buckets need neither Python nor a dense array
    plain = f"{key} long, rating string, city string, tf_review struct<indices: array<int>>"
    terms = spark.read.schema(plain).parquet(path).select(key, "rating", "city", F.col("tf_review.indices").alias("terms"))
    return CountedReviews(spark.read.schema(rows.schema).parquet(path), terms, counting, key)


def fit_every_city(
    counted: CountedReviews,
    cities: Sequence[str],
    max_iter: int = MAX_ITER,
    min_doc_freq: int = MIN_DOC_FREQ,
    skip_empty: bool = False,
) -> dict[str, RatingModel]:
    """One model per city, each fitted on the training part of the other cities.

    Texts are not read again: document frequencies and class sizes of all training
    parts are counted side by side in one job, and every fit reads the counts.
    (The parts are samples whose bounds move with the city left out, so
    one cannot be had from another by subtraction.) The models equal those of
    ``fit`` on ``training_parts``.
    """
    key, in_train = counted.key, {}
    for city in cities:
        cutoffs = class_cutoffs(except_city(counted.terms, city), key, skip_empty)
        kept = reduce(or_, [up_to(code, key, last) for code, last in sorted(cutoffs.items())])
        in_train[city] = F.coalesce((F.col("city") != city) & kept & (F.col("split") == "train"), F.lit(False))
    numbered = {city: f"part_{i}" for i, city in enumerate(cities)}
    flagged = with_split(counted.terms, key).select(
        "rating", "terms", *(in_train[city].alias(name) for city, name in numbered.items())
    ).where(reduce(or_, [F.col(name) for name in numbered.values()]))
    # a class is counted as one more bucket: both counts come from one pass
    counts = (
        flagged.select(
            F.explode(F.concat(F.col("terms").cast("array<string>"), F.array(F.concat(F.lit("="), "rating")))).alias("term"),
            *numbered.values(),
        )
        .groupBy("term")
        .agg(*(F.count_if(name).alias(name) for name in numbered.values()))
        .collect()
    )
    models = {}
    for city, name in numbered.items():
        classes = {row["term"][1:]: row[name] for row in counts if row["term"].startswith("=") and row[name]}
        rows = sum(classes.values())
        weights = [0.0] * HASH_BUCKETS
        for row in counts:
            if not row["term"].startswith("=") and row[name] >= min_doc_freq:
                weights[int(row["term"])] = math.log((rows + 1) / (row[name] + 1))
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="tf_review", outputCol="features")
        labels = sorted(classes, key=lambda code: (-classes[code], code))
        indexer = StringIndexerModel.from_labels(labels, inputCol="rating", outputCol="label")
        tasks = max(1, -(-rows // ROWS_PER_TASK))
        train = with_split(counted.rows, key).where(in_train[city]).repartition(tasks, F.xxhash64(key))
        examples = indexer.transform(weigh.transform(train)).select("label", "features")
        classifier = LogisticRegression(maxIter=max_iter, labelCol="label", featuresCol="features").fit(examples)
        models[city] = RatingModel(PipelineModel([*counted.counting.stages, weigh]), classifier, labels)
    return models


def _entries(vector: str) -> Column:
    """The filled places of a vector column, one row each: ``(bucket, value)``."""
    placed = F.transform(vector_to_array(vector), lambda x, i: F.struct(i.alias("bucket"), x.alias("value")))
    return F.inline(F.filter(placed, lambda e: e["value"] != 0))


def moment_gaps(model: RatingModel, train: DataFrame) -> DataFrame:
    """``(label, bucket, observed, expected)``: the optimality condition of the fit, term by term.

    Where the likelihood of a softmax model without penalty is greatest, every
    class has as much of every feature as the model expects: the sum of the
    feature over the rows of the class equals its sum over all rows weighted by the
    class's probability. The difference is the gradient. One row per class and bucket that occurs.
    """
    predicted = model.classifier.transform(model.text.transform(train))
    codes = F.array(*(F.lit(code) for code in model.labels))
    entries = predicted.select(
        (F.array_position(codes, F.col("rating")) - 1).alias("own"), vector_to_array("probability").alias("p"), _entries("features")
    )
    # the classes of an entry are summed side by side, so an entry stays one row
    sums = entries.groupBy("bucket").agg(
        *(
            F.struct(
                F.lit(k).alias("label"),
                F.sum(F.when(F.col("own") == k, F.col("value")).otherwise(0.0)).alias("observed"),
                F.sum(F.col("value") * F.get("p", F.lit(k))).alias("expected"),
            ).alias(f"class_{k}")
            for k in range(len(model.labels))
        )
    )
    pairs = F.array(*(F.col(f"class_{k}") for k in range(len(model.labels))))
    return sums.select("bucket", F.inline(pairs)).select("label", "bucket", "observed", "expected")


def coefficient_table(model: RatingModel, spark: SparkSession) -> DataFrame:
    """``(label, bucket, weight)`` as published, the intercepts under the null bucket."""
    weights, added = model.classifier.coefficientMatrix.toArray(), model.classifier.interceptVector.toArray()
    rows = [(k, int(b), float(row[b])) for k, row in enumerate(weights) for b in row.nonzero()[0]]
    rows += [(k, None, float(x)) for k, x in enumerate(added)]
    return spark.createDataFrame(rows, "label int, bucket int, weight double")


def class_margins(model: RatingModel, featured: DataFrame, key: str) -> DataFrame:
    """``(key, label, margin)``: features times published coefficients, as joins and sums.

    The coefficients are at most one row per class and bucket, so they are broadcast.
    """
    table = coefficient_table(model, featured.sparkSession)
    intercepts = F.broadcast(table.where("bucket is null").select("label", F.col("weight").alias("margin")))
    products = featured.select(key, _entries("features")).join(F.broadcast(table), "bucket").select(
        key, "label", (F.col("value") * F.col("weight")).alias("margin")
    )
    bases = featured.select(key, F.explode(F.array(*(F.lit(k) for k in range(len(model.labels))))).alias("label"))
    return bases.join(intercepts, "label").select(key, "label", "margin").unionByName(products).groupBy(key, "label").agg(F.sum("margin").alias("margin"))


def training_parts(
    reviews: DataFrame,
    held_out: str,
    key: str = "review_id",
    skip_empty: bool = False,
    random: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Balanced reviews of the other cities, as a training and a test part.

    ``random`` takes Spark's own seeded split instead of the one by key.
    """
    sample = balanced(except_city(reviews, held_out), key, skip_empty)
    if random:
        train, test = random_parts(sample)
        return train, test
    marked = with_split(sample, key)
    train = marked.filter(F.col("split") == "train").drop("split")
    test = marked.filter(F.col("split") == "test").drop("split")
    return train, test


def accuracy(model: RatingModel, test: DataFrame) -> DataFrame:
    """``(n_test, n_correct, accuracy)`` over the test part, one row."""
    correct = F.count_if(F.col("predicted_rating") == F.col("rating"))
    return model.predict(test).agg(
        F.count("*").alias("n_test"),
        correct.alias("n_correct"),
        F.try_divide(correct, F.count("*")).alias("accuracy"),
    )


def predicted_scores(
    model: RatingModel, reviews: DataFrame, group: Sequence[str] = ATTRACTION
) -> DataFrame:
    """Average star of the predicted ratings; one row per attraction.

    All attractions are predicted in one pass, without a fit per attraction.
    """
    return scores_of_predictions(model.predict(reviews), group)


def scores_of_predictions(predicted: DataFrame, group: Sequence[str] = ATTRACTION) -> DataFrame:
    """Average star of ``predicted_rating``, one row per group."""
    return predicted.groupBy(*group).agg(
        F.count("*").alias("n"),
        F.avg(star_points(F.col("predicted_rating"))).alias("score"),
    )
