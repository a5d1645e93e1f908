"""Review lines: parsing, quarantine, scans and sinks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wayfare.operators.profile import line_audit
from wayfare.operators.balance import balanced
from wayfare.operators.scores import observed_scores
from wayfare.operators.split import with_split
from wayfare.functions.text import clean_text, content_tokens, tokens
from wayfare.sources import lines as L
from wayfare.sources import ranked as R
from wayfare.sources import tables as T

CASES = [
    ("normal", "ann||50||Great view. Don't miss it!||May 1, 2019"),
    ("empty user", "||40||Nice||May 2, 2019"),
    ("empty body", "bob||30||||May 3, 2019"),
    ("accents", "eve||40||Café GOOD.Nice||May 4, 2019"),
    ("short", "tail of a broken review"),
    ("extra", "dan||20||a||b||May 5, 2019"),
    ("odd rating", "sue||0||ok||May 6, 2019"),
    ("bad rating", "tom||n/a||ok||May 7, 2019"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(case, line, "london", "Sky_Garden", i) for i, (case, line) in enumerate(CASES)]
    lines = spark.createDataFrame(rows, "case string, line string, city string, attraction string, line_id bigint")
    return L.parse_lines(lines).cache()


def by_case(df):
    return {row["case"]: row for row in df.collect()}


def test_fields_by_position(parsed):
    rows = by_case(parsed)
    assert rows["normal"]["username"] == "ann" and rows["normal"]["rating"] == "50"
    assert rows["empty user"]["username"] == ""
    assert rows["empty body"]["review"] == ""
    assert (rows["extra"]["review"], rows["extra"]["date"]) == ("a", "b")
    assert rows["extra"]["field_count"] == 5
    assert rows["short"]["field_count"] == 1 and rows["short"]["rating"] is None


def test_quarantine_keeps_every_line(parsed):
    good, bad = L.well_formed(parsed), L.quarantined(parsed)
    assert good.count() + bad.count() == len(CASES)
    assert [row["case"] for row in bad.collect()] == ["short"]
    audit = {row["field_count"]: (row["n"], row["malformed"]) for row in line_audit(parsed).collect()}
    assert audit == {1: (1, True), 4: (6, False), 5: (1, False)}


def test_cleaning(parsed):
    rows = by_case(parsed.select("case", clean_text(F.col("review")).alias("clean")))
    assert rows["normal"]["clean"] == "great view dont miss it"
    assert rows["accents"]["clean"] == "caf goodnice"
    assert rows["empty body"]["clean"] == ""


def test_cleaning_twice_changes_nothing(parsed):
    once = clean_text(F.col("review"))
    assert L.well_formed(parsed).filter(clean_text(once) != once).count() == 0


def test_words(parsed):
    cleaned = clean_text(F.col("review"))
    rows = by_case(parsed.select("case", tokens(cleaned).alias("all"), content_tokens(cleaned).alias("kept")))
    assert rows["empty body"]["all"] == []
    # the apostrophe is gone before stop words are looked up
    assert rows["normal"]["kept"] == ["great", "view", "dont", "miss"]


def test_invalid_ratings_count_below_the_line_only(parsed):
    row = observed_scores(L.well_formed(parsed)).first()
    assert row["n"] == 7
    assert row["score"] == pytest.approx((5 + 4 + 3 + 4 + 2) / 7)


def test_city_folder_scan(spark, tmp_path):
    for city, name, text in [
        ("london", "St_James_s_Park", "a||50||x||d1\nb||40||y||d2\n"),
        ("paris", "Musée d'Orsay+50%", "c||10||z||d3\n"),
    ]:
        folder = tmp_path / "data set" / city
        folder.mkdir(parents=True)
        (folder / f"{name}.txt").write_text(text)
    reviews = L.reviews_of(L.scan_city_folders(spark, f"{tmp_path}/data set/*/*.txt"))
    rows = sorted(reviews.collect(), key=lambda row: row["username"])
    assert [(r["username"], r["city"], r["attraction"]) for r in rows] == [
        ("a", "london", "St_James_s_Park"),
        ("b", "london", "St_James_s_Park"),
        ("c", "paris", "Musée d'Orsay+50%"),
    ]
    assert rows[0]["review_id"] < rows[1]["review_id"]
    assert reviews.schema == L.REVIEWS or [f.name for f in reviews.schema] == [f.name for f in L.REVIEWS]


def sample(spark, n=40):
    return spark.range(n).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("u"), F.col("id").cast("string"))).alias("username"),
        ((F.col("id") % 5 + 1) * 10).cast("string").alias("rating"),
        F.concat(F.lit(' line "one"\n\\two, '), F.col("id").cast("string")).alias("review"),
        F.lit("May 1, 2019").alias("date"),
        F.when(F.col("id") % 2 == 0, "london").otherwise("paris").alias("city"),
        F.concat(F.lit("1984_"), (F.col("id") % 3).cast("string")).alias("attraction"),
    )


def test_line_round_trip(spark, tmp_path):
    reviews = sample(spark)
    L.write_lines(reviews, f"{tmp_path}/lines")
    back = L.parse_lines(L.scan_partitioned(spark, f"{tmp_path}/lines"))
    expected = {
        (r["username"] or "", r["rating"], r["review"].replace("\n", " "), r["city"], r["attraction"])
        for r in reviews.collect()
    }
    rows = back.collect()
    assert {(r["username"], r["rating"], r["review"], r["city"], r["attraction"]) for r in rows} == expected
    assert all(r["field_count"] == 4 for r in rows)


def test_csv_round_trip(spark, tmp_path):
    reviews = sample(spark)
    names = ["username", "rating", "review"]
    T.write_csv(reviews, f"{tmp_path}/lines", names)
    lines = T.read_csv(spark, f"{tmp_path}/lines", names)
    assert sorted(tuple(r) for r in lines.collect()) == sorted(
        (r["username"] or "", r["rating"], r["review"].replace("\n", " ")) for r in reviews.collect()
    )
    T.write_csv(reviews, f"{tmp_path}/csv", names, one_per_line=False)
    back = T.read_csv(spark, f"{tmp_path}/csv", names, multi_line=True)
    expected = sorted((r["username"] or "", r["rating"], r["review"]) for r in reviews.collect())
    assert sorted(tuple(r) for r in back.collect()) == expected


def test_landing_prunes_cities(spark, tmp_path):
    T.land_reviews(sample(spark), f"{tmp_path}/landed")
    landed = T.landed_reviews(spark, f"{tmp_path}/landed")
    assert sorted(landed.collect()) == sorted(sample(spark).select(landed.columns).collect())
    paris = T.of_city(landed, "paris")
    plan = paris._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan
    assert paris.count() == 20


def test_ranked_lists_keep_their_order(spark, tmp_path):
    ranked = spark.range(300).select(
        F.when(F.col("id") < 100, "paris").otherwise("nyc").alias("city"),
        F.concat(F.lit("place_"), F.col("id").cast("string")).alias("attraction"),
        F.when(F.col("id") < 100, F.col("id") + 1).otherwise(F.col("id") - 99).alias("rank"),
    ).repartition(7)
    R.write_ranked(ranked, f"{tmp_path}/lists")
    back = R.read_ranked(spark, f"{tmp_path}/lists")
    assert sorted(back.collect()) == sorted(ranked.select(back.columns).collect())


def test_published_list(spark, tmp_path):
    path = tmp_path / "london.txt"
    path.write_text("Wallace_Collection\nHighgate_Cemetery\nGreenwich")
    rows = sorted(R.read_city_file(spark, str(path), "london").collect(), key=lambda r: r["rank"])
    assert [(r["attraction"], r["rank"]) for r in rows] == [
        ("Wallace_Collection", 1),
        ("Highgate_Cemetery", 2),
        ("Greenwich", 3),
    ]


ODD = [("lon:don", "A/B? 50% + c=d"), ("são paulo", "x%41"), ("city=", "file=q"), ("paris", "{a}#^[1]")]


def test_written_names_come_back(spark, tmp_path):
    """Names that paths cannot hold are escaped by the writer; nothing is renamed."""
    rows = [(i, "u", "50", f"text {i}", "d", city, name) for i, (city, name) in enumerate(ODD)]
    reviews = spark.createDataFrame(rows, L.REVIEWS)
    L.write_city_folders(reviews, f"{tmp_path}/files")
    assert all(p.name.startswith("city=") for p in (tmp_path / "files").iterdir() if p.is_dir())
    back = L.reviews_of(L.scan_city_folders(spark, f"{tmp_path}/files/*/*.txt"))
    assert sorted((r.city, r.attraction, r.review) for r in back.collect()) == sorted((c, n, f"text {i}") for i, (c, n) in enumerate(ODD))


def _stable(spark, path, split):
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        lines = L.scan_partitioned(spark, path, stable=True)
        reviews = L.reviews_of(lines)
        marked = with_split(balanced(reviews))
        told = sorted((r.review_id, r.review, r.split) for r in marked.collect())
        return lines.rdd.getNumPartitions(), sorted((r.line_id, r.line) for r in lines.collect()), told
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_samples_do_not_move_with_the_splits(spark, tmp_path):
    """R2 and R3 by stable ids are equal at few and many splits; repeated lines have ids of their own."""
    rows = [(i, f"u{i % 50}", str(10 * (1 + i % 5)), "same words" if i % 3 else f"words {i} " * 20, "d", "london", f"a{i % 2}") for i in range(3000)]
    L.write_lines(spark.createDataFrame(rows, L.REVIEWS).repartition(1), f"{tmp_path}/lines")
    found = [_stable(spark, f"{tmp_path}/lines", split) for split in (10_000_000, 60_000, 9_000)]
    assert found[0][0] < 5 and found[1][0] >= 4 and found[2][0] >= 32
    assert found[0][1:] == found[1][1:] == found[2][1:]
    ids = [i for i, _ in found[0][1]]
    assert len(set(ids)) == len(ids) == 3000 and min(ids) >= 0
    assert len(found[0][2]) == 3000


def test_stable_ids_of_odd_lines(spark):
    schema = "line string, city string, attraction string, line_id long"
    rows = [("a", None, None, 1), ("a", None, None, 2), (None, "x", "y", 3), ("", "x", "y", 4), ("", "x", "y", 5)] + [("hot", "x", "y", 6)] * 500
    lines = spark.createDataFrame(rows, schema)
    one, two = ({(r.line_id, r.line, r.city) for r in L.stable_ids(df, window).collect()} for df, window in ((lines, 1000), (lines.repartition(3), 50)))
    assert len(one) == len(rows) and one == two
    assert L.stable_ids(spark.createDataFrame([], schema)).collect() == []


def test_a_city_is_landed_again_alone(spark, tmp_path):
    path = f"{tmp_path}/landed"
    reviews = sample(spark)
    files = lambda: {p.parent.name: set() for p in (tmp_path / "landed").glob("city=*/*.parquet")} | {
        name: {p.name for p in (tmp_path / "landed" / name).glob("*.parquet")} for name in ("city=london", "city=paris")
    }
    assert {(r.city, r.landing, r.n) for r in T.land_again(reviews, path).collect()} == {("london", 1, 20), ("paris", 1, 20)}
    before = files()
    changed = reviews.where("city = 'paris' and review_id > 10").withColumn("review", F.lit("anew"))
    assert [(r.city, r.landing, r.n) for r in T.land_again(changed, path).collect()] == [("paris", 2, 15)]
    after = files()
    assert after["city=london"] == before["city=london"] and not after["city=paris"] & before["city=paris"]
    landed = T.landed_reviews(spark, path)
    assert landed.where("city = 'london'").count() == 20
    assert {r.review for r in landed.where("city = 'paris'").collect()} == {"anew"}
    assert {(r.city, r.landing, r.n, len(r.files)) for r in T.landing_manifest(spark, path).collect()} == {
        ("london", 1, 20, len(after["city=london"])), ("paris", 2, 15, len(after["city=paris"])),
    }
    assert T.landing_manifest(spark, path, latest=False).count() == 3
    assert T.land_again(reviews.limit(0), path).collect() == [] and landed.count() == 35
    assert T.landing_manifest(spark, f"{tmp_path}/nothing").collect() == []
