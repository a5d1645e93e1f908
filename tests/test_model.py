"""Hashed features, the classifier and the ranked city."""

from __future__ import annotations

import collections
import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

import compare
from wayfare.cluster import scratch_path
from wayfare.functions.fixed import HASH_BUCKETS, RATING_CODES
from wayfare.plans import model as M
from wayfare.plans.rank_city import rank_city, rank_every_city
from wayfare.registry import queries as Q
from wayfare.registry import views as V
from wayfare.sources.tables import of_city

WORDS = {"10": "awful", "20": "poor", "30": "plain", "40": "pleasant", "50": "superb"}
CITIES = ["london", "nyc", "paris"]


def corpus(spark, n=600):
    """Reviews whose words betray the rating most of the time."""
    pick = random.Random(8)
    rows = []
    for i in range(n):
        rating = pick.choice(RATING_CODES)
        hint = WORDS[rating] if pick.random() < 0.9 else WORDS[pick.choice(RATING_CODES)]
        noise = " ".join(pick.choices(["tour", "guide", "queue", "ticket", "hall", "garden"], k=6))
        rows.append((i, rating, f"The {hint}, {hint}  visit: {noise}.", CITIES[i % 3], f"place_{i % 12}"))
    return spark.createDataFrame(rows, "review_id bigint, rating string, review string, city string, attraction string")


@pytest.fixture(scope="module")
def reviews(spark):
    return corpus(spark).cache()


@pytest.fixture(scope="module")
def result(reviews):
    return rank_city(reviews, "paris")


def test_hashed_counts_follow_the_words(spark, reviews):
    counting = M.counting_stages()
    hashing = counting.stages[-1]
    for row in counting.transform(reviews).limit(30).collect():
        expected = collections.Counter(hashing.indexOf(word) for word in row["review_words"])
        vector = row["tf_review"]
        assert vector.size == HASH_BUCKETS
        assert dict(zip(map(int, vector.indices), vector.values)) == expected


def test_empty_words(spark):
    df = spark.createDataFrame([("a  tour",), ("  tour ",), ("",), ("  ",)], "review string")
    kept = [r["review_words"] for r in M.counting_stages().transform(df).collect()]
    assert kept == [["", "tour"], ["", "", "tour"], [""], []]
    closed = [r["review_words"] for r in M.counting_stages(keep_empty=False).transform(df).collect()]
    assert closed == [["tour"], ["tour"], [""], []]


def test_words_equal_the_library_stages(spark):
    pick = random.Random(4)
    texts = ["", " ", "   ", " a", "the ", "Don't  STOP. Will", "é ñ", "K\u212a \u0130"] + [
        "".join(pick.choices("aeT'. é\n\tth", k=pick.randrange(30))) for _ in range(300)
    ]
    df = spark.createDataFrame([(t,) for t in texts], "review string")
    cleaned = df.withColumn("clean", F.regexp_replace(F.lower("review"), "[^A-Za-z ]+", ""))
    tokenised = Tokenizer(inputCol="clean", outputCol="tok").transform(cleaned)
    removed = StopWordsRemover(inputCol="tok", outputCol="expected").transform(tokenised)
    both = M.counting_stages().transform(removed).select("review", "review_words", "expected").collect()
    assert [r["review_words"] for r in both] == [r["expected"] for r in both]


def test_idf_by_hand(spark, reviews):
    counted = M.counting_stages().transform(reviews)
    weights = M.idf_stage().fit(counted).idf.toArray()
    vectors = [r["tf_review"] for r in counted.select("tf_review").collect()]
    freq = collections.Counter(int(i) for v in vectors for i in v.indices)
    for bucket in range(HASH_BUCKETS):
        df = freq[bucket]
        expected = math.log((len(vectors) + 1) / (df + 1)) if df >= 5 else 0.0
        assert weights[bucket] == pytest.approx(expected)


def test_held_out_city_is_not_learned_from(reviews):
    train, test = M.training_parts(reviews, "paris")
    for part in (train, test):
        assert part.filter(F.col("city") == "paris").count() == 0
    both = train.unionByName(test)
    assert len({r["n"] for r in both.groupBy("rating").agg(F.count("*").alias("n")).collect()}) == 1


def test_random_parts_lose_nothing(reviews):
    by_key = M.training_parts(reviews, "paris")
    drawn = M.training_parts(reviews, "paris", random=True)
    ids = [sorted(r["review_id"] for part in parts for r in part.collect()) for parts in (by_key, drawn)]
    assert ids[0] == ids[1]


def test_other_counting_stages(reviews):
    train, test = M.training_parts(reviews, "paris")
    model = M.fit(train, max_iter=5, counting=M.counting_stages(keep_empty=False))
    assert M.accuracy(model, test).first()["accuracy"] > 0.7


def test_accuracy_equals_the_evaluator(reviews, result):
    _, test = M.training_parts(reviews, "paris")
    row = result.accuracy.first()
    label = F.expr("array_position(array(" + ",".join(f"'{x}'" for x in result.model.labels) + "), rating) - 1.0")
    scored = result.model.predict(test).withColumn("label", label.cast("double"))
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    assert row["accuracy"] == pytest.approx(evaluator.evaluate(scored))
    assert row["accuracy"] > 0.7 and row["n_correct"] <= row["n_test"]


def test_predictions_decode_with_training_labels(reviews, result):
    rows = result.model.predict(reviews).select("prediction", "predicted_rating").distinct().collect()
    assert all(result.model.labels[int(r["prediction"])] == r["predicted_rating"] for r in rows)


def test_predicted_scores(reviews, result):
    paris = reviews.filter(F.col("city") == "paris")
    stars = collections.defaultdict(list)
    for row in result.model.predict(paris).collect():
        stars[row["attraction"]].append(int(row["predicted_rating"]) // 10)
    ranked = result.predicted.orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(stars) + 1))
    for row in ranked:
        found = stars[row["attraction"]]
        assert row["n"] == len(found) and row["score"] == pytest.approx(sum(found) / len(found))
    assert [r["score"] for r in ranked] == sorted((r["score"] for r in ranked), reverse=True)


def test_unseen_ratings_are_predicted_too(spark, result):
    odd = spark.createDataFrame([(1, "n/a", "superb superb visit", "paris", "x"), (2, "50", None, "paris", "x")], "review_id bigint, rating string, review string, city string, attraction string")
    predicted = {r["review_id"]: r["predicted_rating"] for r in result.model.predict(odd).collect()}
    assert predicted[1] == "50" and predicted[2] in RATING_CODES


def test_stop_words_may_hold_quotes(spark):
    df = spark.createDataFrame([("keep drop",)], "review string")
    stages = M.counting_stages(stop_words=["drop", "it's", "back\\"])
    assert stages.transform(df).first()["review_words"] == ["keep"]


def test_both_scores_differ_in_what_they_count(reviews, result):
    observed = {r["attraction"]: r["score"] for r in result.observed.collect()}
    given = collections.defaultdict(list)
    for row in reviews.filter(F.col("city") == "paris").collect():
        given[row["attraction"]].append(int(row["rating"]) // 10)
    assert observed == {name: pytest.approx(sum(x) / len(x)) for name, x in given.items()}


def test_every_city_equals_one_by_one_and_reads_texts_once(spark, reviews):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        read.add(1)
        return text

    rows = reviews.count()
    every = rank_every_city(reviews.withColumn("review", noted.asNondeterministic()("review")), CITIES)
    got = sorted(tuple(r) for r in every.predicted.collect())
    assert read.value == rows
    assert got == sorted(tuple(r) for city in CITIES for r in rank_city(reviews, city).predicted.collect())
    one = rank_city(reviews, "paris").model
    assert every.models["paris"].labels == one.labels
    assert every.models["paris"].text.stages[-1].getScalingVec().toArray() == pytest.approx(one.text.stages[-1].idf.toArray())


def test_every_city_without_a_class(spark, reviews):
    few = reviews.where("not (rating = '30' and city <> 'paris')")
    with pytest.raises(ValueError, match="nothing to balance"):
        _ = rank_every_city(few, CITIES).models
    models = rank_every_city(few, CITIES, skip_empty=True).models
    assert "30" not in models["paris"].labels and "30" in models["nyc"].labels


def test_a_saved_model_predicts_the_same(spark, reviews, result):
    for number, model in enumerate([result.model, rank_every_city(reviews, ["nyc"]).models["nyc"]]):
        path = scratch_path(spark, f"model{number}")
        model.save(spark, path)
        loaded = M.RatingModel.load(spark, path)
        assert loaded.labels == model.labels
        told = [sorted((r.review_id, r.predicted_rating, r.probability) for r in m.predict(reviews).collect()) for m in (model, loaded)]
        assert told[0] == told[1]
        with pytest.raises(Exception, match="already exists"):
            model.save(spark, path)
    spark.createDataFrame([(99,)], "version int").write.mode("overwrite").parquet(f"{path}/version")
    with pytest.raises(ValueError, match="version 99"):
        M.RatingModel.load(spark, path)


#: classes by term: probabilities and margins of a published model, in SQL
_MARGINS = """
    margin as (
        select f.review_id, c.label, sum(f.value * c.weight) + any_value(i.weight) as m
        from features f join coefficient c using (bucket) join intercept i on i.label = c.label group by all)"""


def test_whole_reviews_in_sql(spark):
    """Gradient of the fit and best class of each held-out review, from published coefficients in SQL."""
    sf_dir = "/root/testdata/sf0.01"
    reviews, duck = V.reviews(spark, sf_dir), compare.connect(sf_dir)
    train, _ = M.training_parts(reviews, Q.HELD_OUT)
    model = M.fit(train)
    weights, added = model.classifier.coefficientMatrix.toArray(), model.classifier.interceptVector.toArray()
    duck.execute("create table coefficient (label int, bucket int, weight double)")
    duck.executemany("insert into coefficient values (?, ?, ?)", [(k, int(b), float(w[b])) for k, w in enumerate(weights) for b in w.nonzero()[0]])
    duck.execute("create table intercept (label int, weight double)")
    duck.executemany("insert into intercept values (?, ?)", [(k, float(x)) for k, x in enumerate(added)])

    duck.execute("create table features as " + Q._with_views("select * from training_features", ["training_features"]))
    gradient = duck.execute(f"""
        with {_MARGINS},
        p as (select review_id, label, exp(m - max(m) over w) / sum(exp(m)) over w * exp(max(m) over w) as p
              from margin window w as (partition by review_id))
        select p.label, bucket, sum(value) filter (where f.label = p.label), sum(value * p)
        from features f join p using (review_id) group by p.label, bucket""").fetchall()
    sql = {(label, bucket): ((observed or 0) - expected, observed or 0) for label, bucket, observed, expected in gradient}
    gaps = {(r.label, r.bucket): r.observed - r.expected for r in M.moment_gaps(model, train).collect()}
    assert sql.keys() == gaps.keys() and len(gaps) > 5000
    assert all(abs(sql[k][0] - gaps[k]) < 1e-6 for k in gaps)
    assert max(abs(gap) / max(1, observed) for gap, observed in sql.values()) < 1e-3

    held = of_city(reviews, Q.HELD_OUT)
    own = model.text.transform(held).select("review_id", M._entries("features")).toPandas()
    duck.execute("drop table features; create table features as select * from own")
    best = dict(duck.execute(f"with {_MARGINS} select review_id, arg_max(label, m) from margin group by review_id").fetchall())
    predicted = {r.review_id: int(r.prediction) for r in model.predict(held).collect()}
    assert best == {i: predicted[i] for i in best} and len(best) > 300


def test_apply_model_gives_the_prediction_of_each_whole_review(spark):
    """The rows carry what the model says of the whole texts, class and certainty, not only that it agrees with itself."""
    sf_dir = "/root/testdata/sf0.001"
    reviews = V.reviews(spark, sf_dir)
    model = M.fit(M.training_parts(reviews, Q.HELD_OUT)[0])
    told = model.predict(of_city(reviews, Q.HELD_OUT)).collect()
    rows = Q.QUERIES["m4_apply_model"](spark, sf_dir).collect()
    got = {r.review_id: (r.prediction, r.sure) for r in rows}
    assert len(rows) == len(got) == len(told) and all(r.is_best for r in rows)
    assert got == {r.review_id: (r.prediction, max(r.probability) > 0.5) for r in told}
    assert len({p for p, _ in got.values()}) > 1


def test_decoded_predictions_are_counted_over_all_whole_reviews(spark):
    sf_dir = "/root/testdata/sf0.001"
    reviews = V.reviews(spark, sf_dir)
    model = M.fit(M.training_parts(reviews, Q.HELD_OUT)[0])
    expected = collections.Counter((r.city, r.prediction, r.predicted_rating) for r in model.predict(reviews).collect())
    rows = Q.QUERIES["m5_decode_prediction"](spark, sf_dir).collect()
    assert {(r.city, r.prediction, r.predicted_rating): r.n for r in rows} == expected
    assert sum(r.n for r in rows) == reviews.count()
