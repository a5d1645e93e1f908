"""Bars in fields, collected files, the whole job, and page markup as it really is."""

from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfare.cluster import clear_scratch, scratch_path, scratch_root
from wayfare.operators import balance, catalog, crawl, ranking
from wayfare.plans.model import fit
from wayfare.plans.rank_city import publish, rank_city
from wayfare.sources import lines as L
from wayfare.sources import ranked as R
from wayfare.sources import tables as T

FIELDS = st.text(alphabet=st.sampled_from("a|&#124;38x "), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELDS, FIELDS, FIELDS, FIELDS), min_size=1, max_size=40))
def test_fields_with_bars_come_back(spark, rows):
    df = spark.createDataFrame(rows, "username string, rating string, review string, date string")
    parsed = L.parse_lines(df.select(L.review_line().alias("line")), bars=True)
    assert sorted(tuple(r)[1:] for r in parsed.collect()) == sorted((*row, 4) for row in rows)


def world(spark):
    stars = {"london": [5, 4, 1], "paris": [2, 3, 5], "nyc": [1, 1, 4]}
    rows, i = [], 0
    for city, means in stars.items():
        for a, mean in enumerate(means):
            for k in range(40):
                star = 1 + (mean + k) % 5 if k % 4 == 0 else mean
                rows.append((i, f"u{i}", str(10 * star), f"{'great bad fine poor good'.split()[star - 1]} place|| no {k}|", "May 1", city, f"spot {a}+{city}"))
                i += 1
    return spark.createDataFrame(rows, L.REVIEWS)


def test_collected_files_become_lists(spark, tmp_path):
    reviews = world(spark)
    L.write_city_folders(reviews, f"{tmp_path}/files")
    # a file as collected, next to the written ones
    (tmp_path / "files/london").mkdir()
    (tmp_path / "files/london/broken.txt").write_text("only||two\nann||50||fine||May 2\n")
    ranked = publish(spark, f"{tmp_path}/files", f"{tmp_path}/job", ["london", "paris", "nyc"], bars=True)
    assert spark.read.parquet(f"{tmp_path}/job/quarantine").count() == 1
    landed = T.landed_reviews(spark, f"{tmp_path}/job/reviews")
    assert sorted(r.review for r in landed.where("attraction <> 'broken'").collect()) == sorted(r.review for r in reviews.collect())
    assert {p.name for p in (tmp_path / "job/reviews").iterdir() if p.is_dir()} == {"city=london", "city=nyc", "city=paris"}
    by_city = {}
    for row in ranked.orderBy("city", "rank").collect():
        by_city.setdefault(row.city, []).append(row.attraction)
    assert by_city["london"][0] == "broken" and len(by_city["london"]) == 4
    R.export_city(ranked, "london", f"{tmp_path}/london.txt")
    assert (tmp_path / "london.txt").read_text() == "\n".join(by_city["london"])
    back = R.read_ranked(spark, f"{tmp_path}/job/ranked")
    assert {(r.city, r.attraction, r["rank"]) for r in back.collect()} == {
        (c, a, i) for c, names in by_city.items() for i, a in enumerate(names, 1)
    }


def test_only_what_is_asked_is_computed(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    result = rank_city(world(spark), "london")
    result.observed  # noqa: B018
    jobs = len(tracker.getJobIdsForGroup("lazy"))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs == 0


def test_training_tasks_are_even(spark, monkeypatch):
    from wayfare.plans import model

    monkeypatch.setattr(model, "ROWS_PER_TASK", 30)
    df = world(spark).select("rating", "review").coalesce(1)
    tasks = -(-df.count() // 30)
    dealt = df.repartition(tasks, F.xxhash64("rating", "review"))
    sizes = sorted(len(p) for p in dealt.rdd.glom().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] + 6
    assert len(fit(df).labels) == 5


def test_reviews_without_a_key_are_in_no_sample(spark):
    rows = [(None, "10"), (None, "10"), (1, "10")] + [(i, c) for i, c in enumerate(["20", "30", "40", "50"], 2)]
    df = spark.createDataFrame(rows, "review_id long, rating string")
    assert sorted(r.review_id for r in balance.balanced(df).collect()) == [1, 2, 3, 4, 5]
    union = balance.union_of(balance.class_samples(df))
    assert sorted(r.review_id for r in union.collect()) == [1, 2, 3, 4, 5]


def test_attraction_table_has_no_nulls(spark):
    ranked = spark.createDataFrame([("london", "St_A", 3.0, 1, None, None, None), ("oslo", "B", 1.0, 1, "d1", "x", 4.0)],
                                   "city string, attraction string, score double, rank long, serial string, about string, rating double")
    table = catalog.attraction_table(ranked)
    assert table.columns == catalog.ATTRACTION_TABLE.names
    assert [tuple(r) for r in table.collect()] == [(1, 1, "St A", "", "", 0.0, 100.0)]


# --- markup -----------------------------------------------------------------------------


def page(spark, html):
    return spark.createDataFrame([(1, html)], "page_id long, html string")


BLOCKS = [
    ("<p class=partial_entry>body</p><span class=ratingDate title='May 1'>", "bare values"),
    ('<p title="a > b" class="partial_entry">body</p><span title="May 1" class="x ratingDate">', "> in quotes"),
    ("<p\n  class = 'partial_entry y' data-x>body</p><span data-y='>' class='ratingDate' title=\"May 1\">", "blanks and bare names"),
]


@pytest.mark.parametrize("inner", [b for b, _ in BLOCKS], ids=[n for _, n in BLOCKS])
def test_records_in_real_markup(spark, inner):
    html = (
        '<!-- <div class="reviewSelector" data-reviewid="9"><p class="partial_entry">no</p></div> -->'
        "<script>var s = '<div class=\"reviewSelector\" data-reviewid=\"8\">';</script>"
        '<div title="1 > 0" class=reviewSelector data-reviewid=7><div data-reviewid="7">'
        "<div class=info_text><b>x</b><div>ann &amp; <i>bob</i></div></div>"
        "<span data-q='>' class='ui_bubble_rating bubble_40'></span>" + inner + "</span></div></div>"
    )
    rows = crawl.review_records(page(spark, html)).collect()
    assert [tuple(r)[1:] for r in rows] == [(0, "ann & bob", "40", "body", "May 1")]
    assert [r.review_id for r in crawl.listed_reviews(page(spark, html)).collect()] == ["7"]


def test_count_and_info_in_real_markup(spark):
    html = (
        "<!-- prw_filters_detail_language --><div class='x prw_filters_detail_language'><div class=choices>"
        "<div title='a > b'><span class=count>(1)</span></div> <div><label>English <span data-a='>' class='count'>(1,234)</span></label></div></div></div>"
        "<h1 data-x='>' id=HEADING>Big <b>Ben</b></h1><span title='>' class=overallRating>4.5 </span>"
        "<div data-y='>' id='taplc_location_detail_about_card_0' class=z><div><div><div>About</div><div><span>old &amp; tall</span></div></div></div></div>"
    )
    assert crawl.review_counts(page(spark, html)).first().num_reviews == 1234
    assert tuple(crawl.attraction_info(page(spark, html)).first())[1:] == ("Big Ben", 4.5, "old & tall")


@pytest.mark.parametrize("piece", [
    "<div class='prw_filters_detail_language'><div class='choices'><div>", "<div class=choices><div>(</div><div><span class=count",
    "<!-- ", "<script>", "<div class=\"reviewSelector\" data-reviewid='1", "<p class=partial_entry>",
])
def test_a_hostile_page_takes_no_time(spark, piece):
    df = page(
        spark, "prw_filters_detail_language" + piece * (1_000_000 // len(piece))
    )
    crawl.review_counts(page(spark, "warm")).collect()
    start = time.perf_counter()
    crawl.review_counts(df).collect()
    crawl.listed_reviews(df).count()
    assert time.perf_counter() - start < 10


def test_uncounted_listings_are_kept_aside(spark):
    listed = spark.createDataFrame([("a", 20), ("b", None), ("c", -1)], "url string, num_reviews long")
    assert {r.url for r in crawl.expand_pages(listed).collect()} == {"a"}
    assert {r.url for r in crawl.uncounted(listed).collect()} == {"b", "c"}


def test_short_pages_end_a_listing(spark):
    rows = [("u", 0, 10), ("u", 10, 3), ("u", 20, 10), ("v", 0, 10), ("v", 10, 0), ("v", 20, 10), (None, 0, 2), (None, 10, 9)]
    kept = crawl.until_short_page(spark.createDataFrame(rows, "url string, offset int, n_items int"), ["url"])
    assert {(r.url, r.offset) for r in kept.collect()} == {("u", 0), ("u", 10), ("v", 0), (None, 0)}


def test_ranks_run_no_jobs_beforehand(spark):
    scores = spark.createDataFrame([("x", "a", 1.0)], "city string, attraction string, score double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "ranks")
    ranking.rank_scores(scores)
    jobs = len(tracker.getJobIdsForGroup("ranks"))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs == 0


def test_scratch_tables_can_be_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert path.startswith(scratch_root(spark))
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
