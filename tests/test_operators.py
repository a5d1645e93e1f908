"""Balancing, ranking, labels, scores, joins and term weights by brute force."""

from __future__ import annotations

import collections
import html
import math
import random

import pytest
from pyspark.ml.feature import StopWordsRemover, StringIndexer
from pyspark.sql import functions as F

from wayfare.functions import html as H
from wayfare.functions.fixed import CATALOGUE, RATING_CODES, STOP_WORDS
from wayfare.functions.text import stop_words, term_counts
from wayfare.operators import balance, catalog, crawl, labels, profile, ranking, scores, split, tfidf
from wayfare.operators.joins import lookup_join


def ratings(spark, rows):
    return spark.createDataFrame(rows, "review_id bigint, rating string")


# --- balancing -------------------------------------------------------------------


@pytest.mark.parametrize("spread", [1, 10**6, 2**50])
def test_balanced_takes_the_first_of_each_class(spark, spread):
    pick = random.Random(spread)
    ids = pick.sample(range(-4000, 4000), 900)
    rows = [(i * spread, pick.choice(RATING_CODES + ["50"] * 6 + ["n/a"])) for i in ids]
    by_class = collections.defaultdict(list)
    for key, rating in sorted(rows):
        by_class[rating].append(key)
    if any(code not in by_class for code in RATING_CODES):
        pytest.skip("a class has no rows")
    n = min(len(by_class[code]) for code in RATING_CODES)
    expected = sorted((key, code) for code in RATING_CODES for key in by_class[code][:n])
    assert sorted(map(tuple, balance.balanced(ratings(spark, rows)).collect())) == expected


def test_balanced_at_the_ends_of_the_key_range(spark):
    keys = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**62, 2**63 - 2, 2**63 - 1]
    rows = [(key, "50") for key in keys] + [(7, code) for code in RATING_CODES[:4] for _ in [0]]
    kept = balance.balanced(ratings(spark, rows)).collect()
    assert sorted(map(tuple, kept)) == sorted([(-(2**63), "50")] + [(7, code) for code in RATING_CODES[:4]])


def test_balanced_is_a_filter(spark, tmp_path):
    rows = [(i, RATING_CODES[i % 5] if i < 50 else "50") for i in range(200)]
    ratings(spark, rows).write.parquet(f"{tmp_path}/r")
    plan = balance.balanced(spark.read.parquet(f"{tmp_path}/r"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "PushedFilters: [Or" in plan


def test_empty_class_is_an_error_or_skipped(spark):
    rows = [(i, code) for i, code in enumerate(["10", "20", "20", "30", "40"])]
    with pytest.raises(ValueError, match="50"):
        balance.balanced(ratings(spark, rows))
    assert balance.balanced(ratings(spark, rows), skip_empty=True).count() == 4
    with pytest.raises(ValueError):
        balance.balanced(ratings(spark, [(1, "n/a")]), skip_empty=True)


def test_repeated_key_is_an_error(spark):
    rows = [(1, "10"), (2, "20"), (3, "30"), (4, "40"), (5, "50"), (5, "50")]
    with pytest.raises(ValueError, match="not unique"):
        balance.balanced(ratings(spark, rows))


def test_absent_classes_count_zero(spark):
    found = {r["rating"]: r["n"] for r in balance.class_counts(ratings(spark, [(1, "50"), (2, "x")])).collect()}
    assert found == {"10": 0, "20": 0, "30": 0, "40": 0, "50": 1}
    assert balance.class_minimum(ratings(spark, [(1, "50")])).first()[0] == 0


# --- row numbers and lookups -------------------------------------------------------


@pytest.mark.parametrize("window_rows", [10**6, 10])
def test_row_numbers(spark, window_rows):
    pick = random.Random(5)
    rows = [("paris" if pick.random() < 0.6 else f"c{pick.randrange(9)}", pick.randrange(6) / 2, f"a{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "city string, score double, attraction string").repartition(6)
    order = [F.desc("score"), F.asc("attraction")]
    got = ranking.row_number_within(df, ["city"], order, "rank", window_rows)
    expected = []
    for city in {row[0] for row in rows}:
        members = sorted((r for r in rows if r[0] == city), key=lambda r: (-r[1], r[2]))
        expected += [(*row, place) for place, row in enumerate(members, start=1)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_row_numbers_without_groups(spark):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("x"))
    got = ranking.row_number_within(df, [], [F.asc("x")], "place", 10)
    expected = [(x, i) for i, x in enumerate(sorted(i * 37 % 101 for i in range(100)), start=1)]
    assert sorted(map(tuple, got.collect())) == expected


def test_equal_scores_rank_by_name(spark):
    df = spark.createDataFrame([("nyc", "b", 4.0), ("nyc", "a", 4.0), ("nyc", "c", 5.0)], "city string, attraction string, score double")
    ranked = {r["attraction"]: r["rank"] for r in ranking.rank_scores(df).collect()}
    assert ranked == {"c": 1, "a": 2, "b": 3}


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("rows, salt_rows", [(10**6, 10**6), (5, 10**6), (5, 20)])
def test_lookup_join(spark, how, rows, salt_rows):
    pick = random.Random(3)
    keys = [("hot" if pick.random() < 0.4 else "gone" if pick.random() < 0.2 else f"k{pick.randrange(60)}", i) for i in range(400)]
    left = spark.createDataFrame(keys, "k string, i int").repartition(5)
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(0, 60, 2)], "k string, v int")
    got = lookup_join(left, lookup, ["k"], how, rows=rows, salt_rows=salt_rows)
    expected = left.join(lookup, "k", how)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("weight", [None, "v"])
def test_hot_keys_are_dealt_over_tasks(spark, weight):
    left = spark.range(2000).select(F.when(F.col("id") < 900, 0).otherwise(F.col("id") % 40).alias("k"), "id")
    lookup = left.groupBy("k").agg(F.count("*").alias("v"))
    got = lookup_join(left, lookup, ["k"], "inner", weight, rows=3, salt_rows=100)
    expected = left.join(lookup, "k")
    assert sorted(got.select("k", "id", "v").collect()) == sorted(expected.select("k", "id", "v").collect())
    # without a weight it is one declarative join, left to adaptive execution
    assert ("_salt" in got._jdf.queryExecution().optimizedPlan().toString()) == (weight is not None)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("weight, rows, salt_rows", [(None, 9, 9), ("n", 10**6, 10**6), ("n", 2, 10**6), ("n", 2, 5)])
def test_null_keys_are_keys(spark, how, weight, rows, salt_rows):
    pairs = [(None if i % 3 == 0 else "a" if i % 3 == 1 else "b", None if i % 2 else i % 5, i) for i in range(120)]
    left = spark.createDataFrame(pairs, "k string, j int, i int").repartition(4)
    lookup = left.where("k <> 'b' or k is null").groupBy("k", "j").agg(F.count("*").alias("n"))
    got = lookup_join(left, lookup, ["k", "j"], how, weight, rows=rows, salt_rows=salt_rows, deal=["i"]).collect()
    size = {}
    for k, j, _ in pairs:
        if k != "b":
            size[k, j] = size.get((k, j), 0) + 1
    found = {r["i"]: r for r in got}
    assert len(found) == len(got)
    for k, j, i in pairs:
        kept = how == "left" or ((k, j) in size) == (how != "left_anti")
        assert (i in found) == kept
        if kept and how in ("inner", "left"):
            assert found[i]["n"] == size.get((k, j))


def test_large_lookup_is_not_broadcast(spark):
    left = spark.range(100).select((F.col("id") % 9).alias("k"))
    lookup = spark.createDataFrame([(k, "x" * 100, 11) for k in range(9)], "k bigint, text string, n int")
    small = lookup_join(left, lookup, ["k"], weight="n")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    by_bytes = lookup_join(left, lookup, ["k"], weight="n", size=500, salt_rows=5)
    wide = lookup_join(left, lookup, ["k"], weight="n", size=5, salt_rows=5)
    # salting stays on however wide the keys and the rows are
    for one in (by_bytes, wide):
        assert "_salt" in one._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(small.collect()) == sorted(by_bytes.collect()) == sorted(wide.collect())
    assert "ShuffledHashJoin" in by_bytes._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in wide._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("window_rows", [None, 10**6, 10])
def test_null_groups_are_numbered(spark, window_rows):
    df = spark.createDataFrame([(None if i % 4 == 0 else "x", i) for i in range(100)], "city string, i int").repartition(6)
    got = ranking.row_number_within(df, ["city"], [F.asc("i")], "n", window_rows).collect()
    assert len(got) == 100
    assert sorted(r["n"] for r in got if r["city"] is None) == list(range(1, 26))
    assert sorted(r["n"] for r in got if r["city"]) == list(range(1, 76))


def test_grouped_weights_keep_the_null_group(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x", "a", "alpha beta") for i in range(20)], "review_id int, city string, attraction string, review string")
    got = tfidf.tfidf(df, ["city", "attraction"], min_doc_freq=1).collect()
    assert len({r["review_id"] for r in got}) == 20 and {r["df"] for r in got} == {10}


def test_chunks_are_spread(spark):
    listed = spark.createDataFrame([("u", 1000)], "url string, num_reviews bigint")
    pages = crawl.expand_pages(listed, chunk_pages=2)
    tasks = pages.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


# --- labels, scores, split ------------------------------------------------------------


def test_label_index_equals_string_indexer(spark):
    rows = [(i, r) for i, r in enumerate(["50"] * 5 + ["10"] * 3 + ["40"] * 3 + ["20"] * 2 + ["n/a"])]
    df = ratings(spark, rows)
    ours = {r["rating"]: r["label"] for r in labels.label_index(df).collect()}
    theirs = StringIndexer(inputCol="rating", outputCol="label").fit(df).labels
    assert ours == {rating: float(i) for i, rating in enumerate(theirs)}


def test_score_equals_the_route_over_labels(spark):
    pick = random.Random(11)
    rows = [("nyc", f"a{pick.randrange(6)}", pick.choice(RATING_CODES + ["n/a", "0"])) for _ in range(300)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "review_id bigint, city string, attraction string, rating string")
    index = labels.label_index(df, labels.ATTRACTION)
    label_of = {(r["attraction"], r["rating"]): r["label"] for r in labels.label_lookup(index).collect()}
    row_labels = collections.defaultdict(list)
    known = {(r["attraction"], r["rating"]): r["label"] for r in index.collect()}
    for _, attraction, rating in rows:
        row_labels[attraction].append(known[(attraction, rating)])
    for row in scores.observed_scores(df).collect():
        name = row["attraction"]
        points = sum(
            star * row_labels[name].count(label_of[(name, code)]) for star, code in enumerate(RATING_CODES, start=1)
        )
        assert row["score"] == pytest.approx(points / len(row_labels[name]))


def test_all_invalid_ratings_score_zero(spark):
    df = spark.createDataFrame([("nyc", "a", "n/a"), ("nyc", "a", "0")], "city string, attraction string, rating string")
    assert scores.observed_scores(df).first()["score"] == 0.0


def test_one_scan_for_all_scores(spark, tmp_path):
    spark.createDataFrame([("nyc", "a", "10", "x")], "city string, attraction string, rating string, review string").write.parquet(f"{tmp_path}/r")
    plan = scores.observed_scores(spark.read.parquet(f"{tmp_path}/r"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan and "review" not in plan.split("ReadSchema")[1]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").alias("review_id"))
    splits = [sorted(map(tuple, split.with_split(df.repartition(n)).collect())) for n in (1, 3, 8)]
    assert splits[0] == splits[1] == splits[2]
    share = sum(part == "train" for _, part in splits[0]) / 2000
    assert 0.87 < share < 0.93


# --- term weights -----------------------------------------------------------------------


def test_stop_words_are_spark_s_own(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert "dont" in stop_words(clean=True) and "don't" not in stop_words(clean=True)


def test_term_counts(spark):
    texts = [["b", "a", "b", "b"], [], ["x"], ["q", "q"]]
    df = spark.createDataFrame([(t,) for t in texts], "w array<string>")
    got = [row[0] for row in df.select(term_counts(F.col("w"))).collect()]
    assert [dict(map(tuple, counts or [])) for counts in got] == [dict(collections.Counter(t)) for t in texts]


@pytest.mark.parametrize("group", [(), ("city", "attraction")])
def test_tfidf_by_hand(spark, group):
    pick = random.Random(2)
    vocabulary = [f"word{'abcdefghij'[i]}" for i in range(10)]
    rows = [
        (i, "nyc", f"a{i % 3}", " ".join(pick.choices(vocabulary, weights=range(1, 11), k=pick.randrange(8))))
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "review_id bigint, city string, attraction string, review string")
    keys = {row[0]: tuple(row[1:3]) if group else () for row in rows}
    size = collections.Counter(keys[row[0]] for row in rows)
    freq = collections.Counter((keys[row[0]], term) for row in rows for term in set(row[3].split()))
    expected = {}
    for row in rows:
        for term, tf in collections.Counter(row[3].split()).items():
            df_ = freq[keys[row[0]], term]
            idf = math.log((size[keys[row[0]]] + 1) / (df_ + 1)) if df_ >= 5 else 0.0
            expected[row[0], term] = (tf, df_, tf * idf)
    got = {(r["review_id"], r["term"]): (r["tf"], r["df"], r["tfidf"]) for r in tfidf.tfidf(df, group).collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values)


def test_terms_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a b")], "review_id bigint, review string")
    assert "Exchange" not in tfidf.review_terms(df)._jdf.queryExecution().executedPlan().toString()


# --- pages, catalogue, profile -------------------------------------------------------------

PAGE = """
<html><h1 class='x' id='HEADING'>St&nbsp;James&#39;s <i>Park</i></h1>
<span class="overallRating">4.5 </span>
<div class="prw_rup prw_filters_detail_language ui_column separated is-3"><div><div class="content">
<div class="choices is-shown-at-tablet"><div><label>All <span class="count">(9,999)</span></label></div>
<div><label>English <span class="count">(1,234)</span></label></div></div></div></div></div>
<div id="taplc_location_detail_about_card_0"><div><div><div>About</div><div><span>Caf&eacute; &amp; park</span><span>more</span></div></div></div></div>
<div data-reviewid="11" class="other"><div class="reviewSelector" data-reviewid="11">
 <div class='info_text'><div>Ann &lt;3</div><div>London</div></div>
 <span class="ui_bubble_rating bubble_50"></span><span title="May 1, '19" class="ratingDate">1 May</span>
 <p class="partial_entry">Great<br>view &amp; more</p></div></div>
<div data-reviewid="12"><div class="a reviewSelector b" data-reviewid="12">
 <span class='ui_bubble_rating bubble_20'></span><span class='ratingDate relativeDate' title='May 2'></span>
 <p class='x partial_entry'></p></div></div>
</html>"""


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([(1, PAGE), (2, "<html><h1>none</h1></html>"), (3, None)], "page_id bigint, html string")


def test_review_count(page):
    assert [tuple(r) for r in crawl.review_counts(page).orderBy("page_id").collect()] == [(1, 1234), (2, None), (3, None)]


def test_headings(page):
    by_id = [r["heading"] for r in crawl.headings(page, element_id="HEADING").orderBy("page_id").collect()]
    assert by_id == ["St\xa0James's Park", None, None]
    assert [r["heading"] for r in crawl.headings(page).orderBy("page_id").collect()][1] == "none"


def test_every_second_id(page):
    found = crawl.listed_reviews(page).orderBy("position").collect()
    assert [(r["position"], r["review_id"]) for r in found] == [(0, "11"), (1, "12")]


def test_review_records(page):
    found = crawl.review_records(page).orderBy("position").collect()
    assert [tuple(r) for r in found] == [
        (1, 0, "Ann <3", "50", "Greatview & more", "May 1, '19"),
        (1, 1, "", "20", "", "May 2"),
    ]


def test_attraction_info(page):
    first = crawl.attraction_info(page).orderBy("page_id").first()
    assert tuple(first) == (1, "St\xa0James's Park", 4.5, "Café & park")


@pytest.mark.parametrize("chunk", [10_000, 3])
def test_pagination_is_inclusive(spark, chunk):
    listed = spark.createDataFrame(
        [("http://x/d1-Reviews-A", 0), ("http://x/d2-Reviews-B", 20), ("http://x/d3-Reviews-C", 95), ("u", None)],
        "url string, num_reviews bigint",
    )
    rows = crawl.expand_pages(listed, chunk_pages=chunk).collect()
    offsets = collections.defaultdict(list)
    for row in rows:
        offsets[row["url"]].append(row["offset"])
        assert row["page_url"] == row["url"].replace("Reviews-", f"Reviews-or{row['offset']}-")
    assert {url: sorted(found) for url, found in offsets.items()} == {
        "http://x/d1-Reviews-A": [0],
        "http://x/d2-Reviews-B": [0, 10, 20],
        "http://x/d3-Reviews-C": list(range(0, 91, 10)),
    }


def test_stop_rule(spark):
    sizes = {"a": [10, 10, 4, 10], "b": [10, 0, 10], "c": [10, 10], "d": [0], "e": [3, 2]}
    rows = [(name, i * 10, n) for name, found in sizes.items() for i, n in enumerate(found)]
    df = spark.createDataFrame(rows, "attraction string, offset bigint, n_items bigint")
    kept = collections.Counter(r["attraction"] for r in crawl.until_short_page(df, ["attraction"]).collect())
    assert kept == {"a": 3, "b": 1, "c": 2, "e": 1}


def test_catalogue(spark):
    rows = catalog.catalogue(spark).collect()
    listed = {(city, key.lstrip("_").split("-")[0]) for (city, _), keys in CATALOGUE.items() for key in keys}
    assert {(r["city"], r["serial"]) for r in rows} == listed and len(rows) == len(listed)
    lower = collections.Counter(r["city"] for r in rows if r["tier"] == "11-30")
    assert lower == {"london": 20, "nyc": 20, "paris": 20}
    skyline = [r for r in rows if r["attraction"] == "Manhattan_Skyline"]
    assert [(r["serial"], r["tier"]) for r in skyline] == [("d267031", "11-30")]


def test_site_tables(spark):
    assert [f.name for f in catalog.ATTRACTION_TABLE] == ["ranking", "city", "title", "about", "serialNum", "rating", "result"]
    cities = catalog.city_table(spark)
    rows = [(1, 1, "A", "", "d1", 4.5, 100.0), (2, 9, "B", "", "d2", 4.0, 95.0)]
    attractions = spark.createDataFrame(rows, catalog.ATTRACTION_TABLE)
    assert [r["title"] for r in catalog.orphans(attractions, cities).collect()] == ["B"]
    joined = catalog.attractions_of_cities(attractions, cities).collect()
    assert [(r["title"], r["city_title"], r["city_serial"]) for r in joined] == [("A", "London", "g186338")]


def test_profile_of_nothing_valid(spark):
    df = spark.createDataFrame([("10", "abc"), ("n/a", "é")], "rating string, review string")
    found = {r["metric"]: r["value"] for r in profile.corpus_profile(df).collect()}
    assert found["total_rows"] == 2 and found["longest_review"] == 3
    assert found["class_minimum"] == 0 and found["balanced_rows"] == 0


REFERENCES = [
    "&", "&amp;", "&amp", "&#", "&#x", "&#233;", "&#xE9", "&#0;", "&#128;", "&#129;", "&#xD800;", "&#99999999999999999999;", "&#x110000;",
    "&#65534;", "&notit;", "&notin;", "&gtx", "&unknown;", "&#13;", "a b", "<;", "#", "é🙂", "&;", "&#0000065;", "&#x00041;", "&Aacute",
    "&nGt;", "\n", "&lt;&gt;", "&#1114111;", "&#128512;", "&#x1F600;x", "&nbsp;", "lt;", "&quot;", "&amp;lt;", "&#39;", "&#x27;",
]


def test_references_are_read_as_the_standard_library_does(spark):
    pick = random.Random(6)
    names = list(html.entities.html5)
    texts = [
        "".join(pick.choice(REFERENCES) if pick.random() < 0.7 else "&" + pick.choice(names) for _ in range(pick.randint(0, 8)))
        for _ in range(1500)
    ]
    texts += [f"&{n}" for n in names] + [f"&{n[:-1]}z" for n in names] + [f"&#{i};" for i in range(0, 70000, 61)]
    texts += [f"&#x{i:x}" for i in range(0x10FF00, 0x110010)] + ["&amp;" * 3000 + "&eacute", "x" * 100_000]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").repartition(4)
    rows = df.select("t", H.unescape(F.col("t")).alias("u")).collect()
    assert [r.t for r in rows if r.u != (None if r.t is None else html.unescape(r.t))] == [] and len(rows) == len(texts) + 1


def test_a_page_is_stripped_of_comments_once(spark):
    """However often a field is named while its references are resolved, the plan reads the page once a step."""
    html = (
        "<!-- <h1 id=HEADING>no</h1> --><h1 id='HEADING'>A &amp; <b>B</b></h1><script><h1>no</h1></script><span class=overallRating>4.5</span>"
        "<div id='taplc_location_detail_about_card_0'><div><div><div>About</div><div><span>C &eacute;</span></div></div></div></div>"
    )
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    for read, steps in ((crawl.attraction_info(pages), 1), (crawl.headings(pages, element_id="HEADING"), 3)):
        plan = read._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(script|style)") <= steps
    got = {r.page_id: (r.title, float(r.rating) if r.rating is not None else None, r.about) for r in crawl.attraction_info(pages).collect()}
    assert got[1] == ("A & B", 4.5, "C é") and set(got) == {1, 2, 3}
    assert {r.page_id: r.heading for r in crawl.headings(pages, element_id="HEADING").collect()}[1] == "A & B"
