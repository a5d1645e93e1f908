"""Every operator as a query over the test tables, next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.cluster import materialise, scratch_path, written
from wayfare.functions import html as H
from wayfare.functions import strings as S
from wayfare.functions import text as X
from wayfare.functions.fixed import CATALOGUE, CITIES, RATING_CODES, REVIEW_FIELDS, STOP_WORDS
from wayfare.operators import balance, catalog, crawl, labels, profile, ranking, scores, split, tfidf
from wayfare.operators.joins import lookup_join
from wayfare.plans import model as M
from wayfare.plans.rank_city import publish, rank_city, rank_every_city, rank_observed
from wayfare.registry import views as V
from wayfare.sources import lines as L
from wayfare.sources import ranked as R
from wayfare.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: the city whose attractions are scored; the others are learned from
HELD_OUT = "london"

# --- the views of views.py, in SQL --------------------------------------------
_STOP_LIST = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS) + "]"
_VIEWS = {
    "reviews": """
        select doc_id as review_id, 'user' || (doc_id % 97) as username,
               case when doc_id % 100 < 5 then '10' when doc_id % 100 < 10 then '20'
                    when doc_id % 100 < 20 then '30' when doc_id % 100 < 50 then '40'
                    else '50' end as rating,
               text as review,
               cast(date '2019-01-01' + cast(doc_id % 365 as int) as varchar) as date,
               case cast(substr(source, 4) as int) % 3
                    when 0 then 'london' when 1 then 'paris' else 'nyc' end as city,
               source as attraction, cast(substr(source, 4) as int) as num
        from documents""",
    "dirty": """
        select review_id, city, attraction,
               case review_id % 37 when 5 then 'n/a' when 6 then '0' else rating end as rating
        from reviews""",
    "barred": """
        select * replace (case review_id % 5 when 0 then '|' || review || '||x|' when 1 then review || '|'
                               when 2 then '&#124;|' || review else review end as review)
        from reviews""",
    "first_rows": """
        select row_number() over (order by review_id) - 1 as position, * from reviews order by review_id limit 5""",
    "placed": "select * replace (case when review_id % 41 <> 3 then city end as city) from reviews",
    "wholes": r"""
        select *, username || '||' || rating || '||' || replace(replace(replace(replace(
                   regexp_replace(replace(regexp_replace(review, '[\r\n]+', ' ', 'g'), '&#', '&#38;#'), '^\||\|$', '&#124;', 'g'),
                   '|||', '&#124;&#124;&#124;'), '||', '&#124;&#124;'), '&#124;|', '&#124;&#124;'), '|&#124;', '&#124;&#124;')
               || '||' || date as whole
        from reviews""",
    "lines": """
        select review_id, city, attraction,
               string_split(case review_id % 50 when 7 then username || '||' || rating
                            when 13 then whole || '||tail' else whole end, '||') as parts
        from wholes""",
    "cleaned": """
        select review_id, city, attraction, rating,
               regexp_replace(lower(review), '[^A-Za-z ]+', '', 'g') as clean
        from reviews""",
    "words": """
        select review_id, city, attraction,
               list_filter(string_split(clean, ' '), lambda x: x <> '') as words
        from cleaned""",
    "stops": f"select unnest({_STOP_LIST}) as stop",
    "occurrences": """
        select review_id, city, attraction, term
        from (select review_id, city, attraction, unnest(words) as term from words)
        where term not in (select stop from stops)""",
    "pairs": """
        select review_id, city, attraction, term, count(*) as tf
        from occurrences group by all""",
    "scores": """
        select city, attraction, count(*) as n,
               cast(sum(cast(rating as int) // 10) as bigint) / count(*) as score
        from reviews group by all""",
    "ranked": """
        select *, row_number() over (partition by city order by score desc, attraction) as rank
        from scores""",
    "classes": """
        select rating, count(r.review_id) as n
        from (select unnest(['10', '20', '30', '40', '50']) as rating)
        left join reviews r using (rating) group by rating""",
    "cities": "select * from (values "
    + ", ".join(
        f"({i}, " + ", ".join("'" + part.replace("'", "''") + "'" for part in row) + ")"
        for i, row in enumerate(CITIES, start=1)
    )
    + ") as c(id, city, name, geo_id, suffix, about)",
    "cat_keys": """
        select distinct city, attraction, num,
               case when num % 7 = 0 then '_' else '' end || 'd' || (num + 1000)
               || '-Reviews-' || attraction as key
        from reviews""",
    "tiers": """
        select city, attraction, num, key, 'd' || (num + 1000) as serial,
               unnest(case when num % 5 = 0 then ['1-10', '11-30']
                           when num % 2 = 0 then ['1-10'] else ['11-30'] end) as tier
        from cat_keys""",
    "rev_pages": """
        select *, doc_page as page_no,
               row_number() over (partition by attraction, doc_page order by review_id) - 1 as position
        from (select *, review_id // 200 as doc_page from reviews)""",
}
_VIEWS["training"] = f"""
    select review_id, rating,
           case when cast('0x' || substr(md5(review_id || ':2000'), 1, 8) as bigint) < 3865470566
                then 'train' else 'test' end as split
    from (select *, row_number() over (partition by rating order by review_id) as place
          from reviews where city <> '{HELD_OUT}')
    where place <= (select min(n) from (select count(*) as n from reviews
                                        where city <> '{HELD_OUT}' group by rating))"""
_VIEWS["training_labels"] = """
    select rating, row_number() over (order by count(*) desc, rating) - 1 as label
    from training where split = 'train' group by rating"""

# --- the hash that terms are counted by, in SQL: MurmurHash3 (x86, 32 bits, seed 42), public domain;
# --- its multipliers and rotations are fixed values
_WORD_LIMIT = 2**32


def _turn(x: str, bits: int) -> str:
    return f"(({x}) * {2**bits} % {_WORD_LIMIT} + ({x}) // {2 ** (32 - bits)})"


def _stirred(k: str) -> str:
    return f"({_turn(f'({k}) * 3432918353 % {_WORD_LIMIT}', 15)} * 461845907 % {_WORD_LIMIT})"


def _bytes(at: str) -> str:
    """Four letters as a number, the first one lowest; nothing beyond the word's end."""
    return " + ".join(f"coalesce(ascii(nullif(word[{at} + {i + 1}], '')), 0) * {256**i}::hugeint" for i in range(4))


_VIEWS["model_words"] = f"""
    select review_id, rating, unnest(list_filter(case when clean = '' then ['']
                                             when trim(clean, ' ') = '' then []
                                             else string_split(rtrim(clean, ' '), ' ') end,
                                        lambda x: not list_contains({_STOP_LIST}, x))) as word
    from cleaned"""
_VIEWS["buckets"] = f"""
    select word, cast(xor(h3, h3 // 65536) % 4096 as int) as bucket
    from (select word, xor(h2, h2 // 8192) * 3266489909 % {_WORD_LIMIT} as h3
          from (select word, xor(h1, h1 // 65536) * 2246822507 % {_WORD_LIMIT} as h2
                from (select word, xor(case when n % 4 = 0 then h else xor(h, {_stirred("tail")}) end, n::hugeint) as h1
                      from (select word, n, tail,
                                   list_reduce(list_prepend(42::hugeint, list_transform(blocks, lambda k: {_stirred("k")})),
                                               lambda h, k: ({_turn("xor(h, k)", 13)} * 5 + 3864292196) % {_WORD_LIMIT}) as h
                            from (select word, length(word) as n, {_bytes("length(word) // 4 * 4")} as tail,
                                         list_transform(range(0, length(word) // 4), lambda i: {_bytes("i * 4")}) as blocks
                                  from (select distinct word from model_words))))))"""
_VIEWS["bucket_counts"] = """
    select review_id, rating, bucket, cast(count(*) as double) as tf
    from model_words join buckets using (word) group by all"""
_VIEWS["bucket_weights"] = """
    select bucket, count(f.review_id) as doc_freq,
           case when count(f.review_id) >= 5 then ln(((select count(*) from reviews) + 1) / (count(f.review_id) + 1)) else 0 end as idf
    from (select unnest(range(0, 4096)) as bucket) b left join bucket_counts f using (bucket) group by bucket"""
_VIEWS["training_features"] = """
    with own as (select review_id, label, rating from training join training_labels using (rating) where split = 'train'),
    counted as (select review_id, label, rating, bucket, tf from bucket_counts join own using (review_id, rating)),
    weighed as (select bucket, ln(((select count(*) from own) + 1) / (count(*) + 1)) as idf
                from counted group by bucket having count(*) >= 5)
    select review_id, label, rating, bucket, tf * idf as value from counted join weighed using (bucket) where idf <> 0"""
#: read by several views each, so computed once
_ONCE = {"model_words", "buckets", "bucket_counts", "bucket_weights", "training", "training_labels", "training_features"}
_NEEDS = {
    "training_features": ["training", "training_labels", "bucket_counts"],
    "model_words": ["cleaned"],
    "buckets": ["model_words"],
    "bucket_counts": ["model_words", "buckets"],
    "bucket_weights": ["reviews", "bucket_counts"],
    "training": ["reviews"],
    "training_labels": ["training"],
    "dirty": ["reviews"],
    "barred": ["reviews"],
    "placed": ["reviews"],
    "placed_pairs": ["placed", "stops"],
    "first_rows": ["reviews"],
    "site": ["ranked", "tiers", "cities"],
    "real_keys": ["cities"],
    "visits": ["reviews", "real_keys"],
    "wholes": ["reviews"],
    "lines": ["wholes"],
    "cleaned": ["reviews"],
    "words": ["cleaned"],
    "occurrences": ["words", "stops"],
    "pairs": ["occurrences"],
    "scores": ["reviews"],
    "ranked": ["scores"],
    "classes": ["reviews"],
    "cat_keys": ["reviews"],
    "tiers": ["cat_keys"],
    "rev_pages": ["reviews"],
}


def _with_views(sql: str, names: list[str]) -> str:
    """Put the views a statement uses in front of it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    kind = {True: "as materialized", False: "as"}
    return "with " + ",\n".join(f"{name} {kind[name in _ONCE]} ({_VIEWS[name]})" for name in ordered) + "\n" + sql


def query(name: str, sql: str | None = None, uses: str = "") -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = _with_views(sql, uses.split())
        return function

    return register


# --- scans, sources, sinks -------------------------------------------------------


@query(
    "s1_text_scan",
    # the fields as they were, but for line breaks: bars at the ends of a body come back
    r"""select city, attraction, username, rating, regexp_replace(review, '[\r\n]+', ' ', 'g') as review, date,
              4 as field_count
       from barred""",
    "barred",
)
def s1_text_scan(spark, sf_dir):
    path = scratch_path(spark, "lines")
    L.write_lines(V.barred_reviews(spark, sf_dir), path)
    parsed = L.parse_lines(L.scan_partitioned(spark, path), bars=True)
    return parsed.select("city", "attraction", *REVIEW_FIELDS, "field_count")


@query(
    "s1_stable_ids",
    "select city, attraction, count(*) as n, count(*) as n_same, count(*) as n_ids from reviews group by all",
    "reviews",
)
def s1_stable_ids(spark, sf_dir):
    """Ids of lines, some of them repeated, at two split sizes: the same line has the same id."""
    path = scratch_path(spark, "lines")
    texts = V.reviews(spark, sf_dir).withColumn("review", F.when(F.col("review_id") % 7 != 0, F.col("review")))
    L.write_lines(texts.withColumn("username", F.lit("user")), path)
    whole = written(L.scan_partitioned(spark, path, stable=True), "ids")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        split = written(L.scan_partitioned(spark, path, stable=True), "ids")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    other = split.select("line_id", F.xxhash64("city", "attraction", "line").alias("other"))
    met = whole.join(other, "line_id", "left")
    same = F.col("other") == F.xxhash64("city", "attraction", "line")
    return met.groupBy("city", "attraction").agg(
        F.count("*").alias("n"), F.count_if(same).alias("n_same"), F.count_distinct("line_id").alias("n_ids")
    )


@query(
    "s2_city_folders",
    "select city, attraction, count(*) as n, sum(length(review)) as chars from reviews group by all",
    "reviews",
)
def s2_city_folders(spark, sf_dir):
    """The layout of collected files: ``<city>/<attraction>.txt``, names from the path."""
    path = scratch_path(spark, "folders")
    L.write_city_folders(V.reviews(spark, sf_dir), path)
    scanned = L.reviews_of(L.scan_city_folders(spark, f"{path}/*/*.txt"), bars=True)
    return scanned.groupBy("city", "attraction").agg(
        F.count("*").alias("n"), F.sum(F.length("review")).alias("chars")
    )


@query(
    "s2_attraction_scan",
    "select city, attraction, count(*) as n from reviews group by all",
    "reviews",
)
def s2_attraction_scan(spark, sf_dir):
    path = scratch_path(spark, "lines")
    L.write_lines(V.reviews(spark, sf_dir), path)
    return L.scan_partitioned(spark, path).groupBy("city", "attraction").agg(F.count("*").alias("n"))


@query(
    "s3_entity_from_path",
    """select review_id, city as path_city, attraction as path_attraction from reviews""",
    "reviews",
)
def s3_entity_from_path(spark, sf_dir):
    path = F.concat(F.lit("file:/data/my%20set/"), "city", F.lit("/"), "attraction", F.lit(".txt"))
    return V.reviews(spark, sf_dir).select(
        "review_id",
        S.path_city(path).alias("path_city"),
        S.path_attraction(path).alias("path_attraction"),
    )


@query(
    "s4_parse_lines",
    """select review_id as line_id, parts[1] as username, parts[2] as rating,
              parts[3] as review, parts[4] as date, len(parts) as field_count
       from lines""",
    "lines",
)
def s4_parse_lines(spark, sf_dir):
    parsed = L.parse_lines(V.lines(spark, sf_dir))
    return parsed.select("line_id", *REVIEW_FIELDS, "field_count")


@query(
    "s5_typed_reviews",
    """select review_id, parts[1] as username, parts[2] as rating, parts[3] as review,
              parts[4] as date, city, attraction
       from lines where len(parts) >= 4""",
    "lines",
)
def s5_typed_reviews(spark, sf_dir):
    return L.reviews_of(V.lines(spark, sf_dir))


@query("s6_format_lines", "select review_id, whole as line from wholes", "wholes")
def s6_format_lines(spark, sf_dir):
    return V.reviews(spark, sf_dir).select("review_id", L.review_line().alias("line"))


@query(
    "s7_csv_round_trip",
    r"select date, rating, regexp_replace(review, '[\r\n]+', ' ', 'g') as review, username from reviews",
    "reviews",
)
def s7_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    headers = ["username", "rating", "review", "date"]
    T.write_csv(V.reviews(spark, sf_dir), path, headers)
    return T.read_csv(spark, path, headers)


@query(
    "s8_landing",
    "select review_id, username, rating, review, date, city, attraction, city = 'paris' as scanned from reviews",
    "reviews",
)
def s8_landing(spark, sf_dir):
    """All that was landed; a scan for one city finds that city's reviews."""
    path = scratch_path(spark, "reviews")
    T.land_reviews(V.reviews(spark, sf_dir), path)
    landed = T.landed_reviews(spark, path)
    one, rest = T.of_city(landed, "paris"), T.except_city(landed, "paris")
    return one.withColumn("scanned", F.lit(True)).unionByName(rest.withColumn("scanned", F.lit(False)))


@query(
    "s8_landing_again",
    f"""select city, count(*) filter (where city <> '{HELD_OUT}' or review_id % 3 <> 0) as n,
               case when city = '{HELD_OUT}' then 2 else 1 end as landing, city <> '{HELD_OUT}' as files_kept
        from reviews group by city""",
    "reviews",
)
def s8_landing_again(spark, sf_dir):
    """All cities landed, then one of them anew with fewer rows: the others keep their files."""
    path, reviews = scratch_path(spark, "landed"), V.reviews(spark, sf_dir)
    first = T.land_again(reviews, path).select("city", F.col("files").alias("first")).collect()
    T.land_again(T.of_city(reviews, HELD_OUT).where("review_id % 3 <> 0"), path)
    before = spark.createDataFrame(first, "city string, first array<string>")
    held = T.landed_reviews(spark, path).groupBy("city").agg(F.count("*").alias("n"))
    kept = T.landing_manifest(spark, path).join(before, "city").select("city", "landing", (F.col("files") == F.col("first")).alias("files_kept"))
    return held.join(kept, "city").select("city", "n", "landing", "files_kept")


@query("s9_ranked_lines", "select city, attraction as line, rank as line_no from ranked", "ranked")
def s9_ranked_lines(spark, sf_dir):
    """The published form, one file a city, read in the order of its lines."""
    path = scratch_path(spark, "published")
    ranked = k2_rank(spark, sf_dir)
    out = None
    for city, *_ in CITIES:
        R.export_city(ranked, city, f"{path}/{city}.txt")
        listed = R.read_city_file(spark, f"{path}/{city}.txt", city)
        out = listed if out is None else out.unionByName(listed)
    return out.select("city", F.col("attraction").alias("line"), F.col("rank").alias("line_no"))


@query("s10_read_ranked", "select city, attraction, rank from ranked", "ranked")
def s10_read_ranked(spark, sf_dir):
    path = scratch_path(spark, "ranked")
    R.write_ranked(k2_rank(spark, sf_dir), path)
    return R.read_ranked(spark, path)


_SITE = """
    select cast(r.rank as int) as ranking, c.id as city, replace(r.attraction, '_', ' ') as title,
           coalesce(i.about, '') as about, coalesce(k.serial, '') as "serialNum",
           coalesce(cast(i.rating as double), 0.0) as rating, cast(100 - 5 * (r.rank - 1) as double) as result
    from ranked r join cities c using (city)
    left join (select city, attraction, max(serial) as serial from tiers group by all) k using (city, attraction)
    left join (select city, attraction, 'about ' || min(username) as about, max(cast(rating as int)) / 10 as rating
               from reviews where num % 3 <> 1 group by all) i using (city, attraction)"""
_VIEWS["site"] = _SITE


def _site_table(spark, sf_dir):
    parsed = catalog.one_tier(catalog.parse_keys(V.catalogue_keys(spark, sf_dir)))
    return catalog.attraction_table(
        catalog.described(k2_rank(spark, sf_dir), parsed, V.info_rows(spark, sf_dir))
    )


@query(
    "s11_fk_check",
    # every fifth rank refers to a city that is not there
    """select * replace (city + 3 as city) from site where ranking % 5 = 0""",
    "site",
)
def s11_fk_check(spark, sf_dir):
    shifted = F.when(F.col("ranking") % 5 == 0, F.col("city") + 3).otherwise(F.col("city"))
    table = _site_table(spark, sf_dir).withColumn("city", shifted)
    return catalog.orphans(table, catalog.city_table(spark))


@query("s11_attraction_table", "select * from site", "site")
def s11_attraction_table(spark, sf_dir):
    return _site_table(spark, sf_dir)


@query("s12_scan_pages", "select page_id, url, md5(html) as digest, length(html) as chars from pages")
def s12_scan_pages(spark, sf_dir):
    return T.scan_pages(spark, f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.md5("html").alias("digest"), F.length("html").alias("chars")
    )


# --- projections, filters, predicates -----------------------------------------------


@query("p1_project_column", "select username from reviews", "reviews")
def p1_project_column(spark, sf_dir):
    return V.reviews(spark, sf_dir).select("username")


@query("p2_drop_columns", "select review_id, rating, city, attraction from reviews", "reviews")
def p2_drop_columns(spark, sf_dir):
    return V.reviews(spark, sf_dir).drop("username", "date", "review")


@query("p3_rating_filter", "select review_id, rating from reviews where rating = '10'", "reviews")
def p3_rating_filter(spark, sf_dir):
    return V.reviews(spark, sf_dir).filter(F.col("rating") == "10").select("review_id", "rating")


@query(
    "p4_rating_numeric",
    "select review_id, rating from dirty where try_cast(rating as int) = 10",
    "dirty",
)
def p4_rating_numeric(spark, sf_dir):
    code = F.col("rating").try_cast("int")
    return V.dirty_reviews(spark, sf_dir).filter(code == 10).select("review_id", "rating")


@query(
    "p5_rating_present",
    """select a.city, a.attraction, c.rating,
              coalesce(bool_or(try_cast(d.rating as int) = cast(c.rating as int)), false) as present
       from (select distinct city, attraction from dirty) a, (select unnest(['10','20','30','40','50']) as rating) c
       left join dirty d on d.city = a.city and d.attraction = a.attraction
       group by all""",
    "dirty",
)
def p5_rating_present(spark, sf_dir):
    return labels.present_ratings(V.dirty_reviews(spark, sf_dir))


_GROUP_LABELS = """
    select city, attraction, rating, count(*) as n,
           row_number() over (partition by city, attraction order by count(*) desc, rating) - 1.0 as label
    from {table} group by city, attraction, rating"""


@query(
    "p6_label_default",
    f"""select a.city, a.attraction, c.rating, cast(coalesce(l.label, 20.0) as double) as label
        from (select distinct city, attraction from dirty) a
        cross join (select unnest(['10','20','30','40','50']) as rating) c
        left join ({_GROUP_LABELS.format(table="dirty")}) l
        on l.city = a.city and l.attraction = a.attraction and l.rating = c.rating""",
    "dirty",
)
def p6_label_default(spark, sf_dir):
    group = labels.ATTRACTION
    return labels.label_lookup(labels.label_index(V.dirty_reviews(spark, sf_dir), group), group)


@query(
    "p7_label_filter",
    f"""select r.review_id, r.city, r.attraction, r.rating
        from reviews r join ({_GROUP_LABELS.format(table="reviews")}) l using (city, attraction, rating)
        where l.label = 0""",
    "reviews",
)
def p7_label_filter(spark, sf_dir):
    reviews = V.reviews(spark, sf_dir).select("review_id", "city", "attraction", "rating")
    index = labels.label_index(reviews, labels.ATTRACTION).drop("n")
    labelled = lookup_join(reviews, index, ["city", "attraction", "rating"], "inner")
    return labelled.filter(F.col("label") == 0.0).drop("label")


@query(
    "p8_preview",
    "select review_id, username, rating, review, date, city, attraction from reviews order by review_id limit 10",
    "reviews",
)
def p8_preview(spark, sf_dir):
    return ranking.first_rows(V.reviews(spark, sf_dir).select("*"), 10, ["review_id"])


@query(
    "p9_leave_one_city_out",
    f"""select review_id, city, case when city = '{HELD_OUT}' then 'score' else 'train' end as used_for
        from reviews""",
    "reviews",
)
def p9_leave_one_city_out(spark, sf_dir):
    reviews = V.reviews(spark, sf_dir).select("review_id", "city")
    return T.except_city(reviews, HELD_OUT).withColumn("used_for", F.lit("train")).unionByName(
        T.of_city(reviews, HELD_OUT).withColumn("used_for", F.lit("score"))
    )


@query(
    "p10_tier",
    "select city, serial, attraction, max(tier) as tier from tiers group by all having max(tier) = '11-30'",
    "tiers",
)
def p10_tier(spark, sf_dir):
    parsed = catalog.one_tier(catalog.parse_keys(V.catalogue_keys(spark, sf_dir)))
    return catalog.in_tier(parsed).select("city", "serial", "attraction", "tier")


_REAL = ", ".join(f"('{city}', '{tier}', '{key}')" for (city, tier), keys in CATALOGUE.items() for key in keys)
_VIEWS["real_keys"] = rf"""
    select city, regexp_extract(key, '^_?(d\d+)-Reviews-(.+)$', 1) as serial,
           regexp_extract(key, '^_?(d\d+)-Reviews-(.+)$', 2) as attraction, max(tier) as tier
    from (values {_REAL}) as k(city, tier, key) group by all"""
_VIEWS["visits"] = """
    select r.review_id, r.rating, r.city, names[r.num % len(names) + 1] as attraction
    from reviews r join (select city, list(attraction order by attraction) as names from real_keys group by city) n using (city)"""


@query(
    "p10_real_catalogue",
    """select k.city, c.geo_id, k.tier, k.serial, k.attraction, count(v.review_id) as n
       from real_keys k join cities c using (city)
       left join visits v using (city, attraction) where k.tier = '11-30' group by all""",
    "real_keys visits cities",
)
def p10_real_catalogue(spark, sf_dir):
    """The scored tier of the real catalogue with the reviews landed for it."""
    path = scratch_path(spark, "visits")
    T.land_reviews(V.visited(spark, sf_dir), path)
    counted = T.landed_reviews(spark, path).groupBy("city", "attraction").agg(F.count("*").alias("n"))
    joined = lookup_join(catalog.in_tier(catalog.catalogue(spark)), counted, ["city", "attraction"])
    return joined.withColumn("n", F.coalesce("n", F.lit(0)))


# --- joins ---------------------------------------------------------------------------


@query(
    "j1_city_join",
    "select s.*, c.name as city_title, c.geo_id as city_serial from site s join cities c on c.id = s.city",
    "site cities",
)
def j1_city_join(spark, sf_dir):
    return catalog.attractions_of_cities(_site_table(spark, sf_dir), catalog.city_table(spark))


@query(
    "j2_city_dim",
    """select r.review_id, r.city, c.name as city_name, c.geo_id, c.about as city_about
       from reviews r left join cities c using (city)""",
    "reviews cities",
)
def j2_city_dim(spark, sf_dir):
    return catalog.with_city(V.reviews(spark, sf_dir).select("review_id", "city"))


@query(
    "j3_label_join",
    """select r.review_id, r.rating, cast(l.label as double) as label
       from dirty r join (select rating, row_number() over (order by count(*) desc, rating) - 1 as label
                          from dirty group by rating) l using (rating)""",
    "dirty",
)
def j3_label_join(spark, sf_dir):
    reviews = V.dirty_reviews(spark, sf_dir).select("review_id", "rating")
    return lookup_join(reviews, labels.label_index(reviews).drop("n"), ["rating"])


_INFO = """
    select city, attraction, 'about ' || min(username) as about, max(cast(rating as int)) / 10 as rating
    from reviews where num % 3 <> 1 group by all"""


@query(
    "j4_catalog_join",
    f"""select r.city, r.attraction, r.n, r.score, r.rank, k.serial, i.about, i.rating
        from ranked r
        left join (select city, attraction, serial from tiers where tier = '11-30') k using (city, attraction)
        left join ({_INFO}) i using (city, attraction)""",
    "ranked tiers",
)
def j4_catalog_join(spark, sf_dir):
    parsed = catalog.in_tier(catalog.parse_keys(V.catalogue_keys(spark, sf_dir)))
    return catalog.described(k2_rank(spark, sf_dir), parsed, V.info_rows(spark, sf_dir))


@query(
    "j5_site_view",
    f"""select r.city, c.name as city_name, 'https://www.tripadvisor.com/Home-' || c.geo_id as home_link, r.rank,
               replace(r.attraction, '_', ' ') as title,
               'https://www.tripadvisor.com/Attraction_Review-' || c.geo_id || '-' || k.serial as link,
               i.about, i.rating, 100 - 5 * (r.rank - 1) as result
        from ranked r join cities c using (city)
        left join (select city, attraction, max(serial) as serial from tiers group by all) k using (city, attraction)
        left join ({_INFO}) i using (city, attraction)""",
    "ranked tiers cities",
)
def j5_site_view(spark, sf_dir):
    parsed = catalog.one_tier(catalog.parse_keys(V.catalogue_keys(spark, sf_dir)))
    shown = catalog.described(k2_rank(spark, sf_dir), parsed, V.info_rows(spark, sf_dir))
    return catalog.site_view(shown)


# --- aggregations ----------------------------------------------------------------------


@query("a1_rating_counts", "select rating, n from classes", "classes")
def a1_rating_counts(spark, sf_dir):
    return balance.class_counts(V.reviews(spark, sf_dir))


@query("a2_class_min", "select min(n) as min_n from classes", "classes")
def a2_class_min(spark, sf_dir):
    return balance.class_minimum(V.reviews(spark, sf_dir))


@query("a3_max_len", "select max(length(review)) as max_len from reviews", "reviews")
def a3_max_len(spark, sf_dir):
    return profile.longest_review(V.reviews(spark, sf_dir))


@query("a4_total", "select 5 * min(n) as n_balanced from classes", "classes")
def a4_total(spark, sf_dir):
    return balance.balanced(V.reviews(spark, sf_dir)).agg(F.count("*").alias("n_balanced"))


@query(
    "a5_label_counts",
    """select city, attraction,
              count(*) filter (where try_cast(rating as int) = 10) as n1,
              count(*) filter (where try_cast(rating as int) = 20) as n2,
              count(*) filter (where try_cast(rating as int) = 30) as n3,
              count(*) filter (where try_cast(rating as int) = 40) as n4,
              count(*) filter (where try_cast(rating as int) = 50) as n5,
              count(*) as n
       from dirty group by all""",
    "dirty",
)
def a5_label_counts(spark, sf_dir):
    return scores.rating_counts(V.dirty_reviews(spark, sf_dir))


@query(
    "a6_observed_score",
    """select city, attraction, count(*) as n,
              cast(sum(case when rating in ('10','20','30','40','50')
                            then cast(rating as int) // 10 else 0 end) as bigint) / count(*) as score
       from dirty group by all""",
    "dirty",
)
def a6_observed_score(spark, sf_dir):
    return scores.observed_scores(V.dirty_reviews(spark, sf_dir))


@query("a7_predicted_score")
def a7_predicted_score(spark, sf_dir):
    reviews = V.reviews(spark, sf_dir)
    train, _ = M.training_parts(reviews, HELD_OUT)
    return M.predicted_scores(M.fit(train), T.of_city(reviews, HELD_OUT))


@query("a8_accuracy")
def a8_accuracy(spark, sf_dir):
    train, test = M.training_parts(V.reviews(spark, sf_dir), HELD_OUT)
    return M.accuracy(M.fit(train), test)


@query(
    "a9_filled_report",
    """select 'review_id' as "column", 'bigint' as type, count(review_id) as filled from reviews
       union all select 'username', 'string', count(username) from reviews
       union all select 'rating', 'string', count(rating) from reviews
       union all select 'review', 'string', count(review) from reviews
       union all select 'date', 'string', count(date) from reviews
       union all select 'city', 'string', count(city) from reviews
       union all select 'attraction', 'string', count(attraction) from reviews""",
    "reviews",
)
def a9_filled_report(spark, sf_dir):
    return profile.schema_report(V.reviews(spark, sf_dir), filled=True)


@query(
    "a9_schema_report",
    """select unnest(['review_id', 'username', 'rating', 'review', 'date', 'city', 'attraction']) as "column",
              unnest(['bigint', 'string', 'string', 'string', 'string', 'string', 'string']) as type""",
)
def a9_schema_report(spark, sf_dir):
    return profile.schema_report(V.reviews(spark, sf_dir))


# --- sorts, limits, sampling, ranking -----------------------------------------------------


@query("r1_first_n", "select review_id, username from reviews order by review_id limit 5", "reviews")
def r1_first_n(spark, sf_dir):
    return ranking.first_rows(V.reviews(spark, sf_dir).select("review_id", "username"), 5, ["review_id"])


@query(
    "r2_balanced",
    """select review_id, rating, city, attraction
       from (select *, row_number() over (partition by rating order by review_id) as place from reviews)
       where place <= (select min(n) from classes)""",
    "reviews classes",
)
def r2_balanced(spark, sf_dir):
    return balance.balanced(V.reviews(spark, sf_dir)).select("review_id", "rating", "city", "attraction")


@query(
    "r3_md5_split",
    """select review_id,
              case when cast('0x' || substr(md5(review_id || ':2000'), 1, 8) as bigint) < 3865470566
                   then 'train' else 'test' end as split
       from reviews""",
    "reviews",
)
def r3_md5_split(spark, sf_dir):
    return split.with_split(V.reviews(spark, sf_dir).select("review_id"))


@query(
    "r3_random_split",
    # a tenth of n rows, give or take four standard deviations
    "select count(*) as n, count(*) as together, true as about_a_tenth, 0 as twice from reviews",
    "reviews",
)
def r3_random_split(spark, sf_dir):
    train, test = split.random_parts(V.reviews(spark, sf_dir).select("review_id"))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    seen = parts.groupBy("review_id").agg(F.count("*").alias("times"), F.min("part").alias("part"))
    n, held = F.count("*"), F.count_if(F.col("part") == "test")
    return seen.agg(
        n.alias("n"),
        F.sum("times").cast("bigint").alias("together"),
        (F.abs(held - n / 10) < 4 * F.sqrt(n * 0.09)).alias("about_a_tenth"),
        F.count_if(F.col("times") > 1).alias("twice"),
    )


@query(
    "k1_sorted_scores",
    """select city, attraction, score, row_number() over (order by score desc, attraction) as place
       from scores""",
    "scores",
)
def k1_sorted_scores(spark, sf_dir):
    """Sorted scores with the place each row comes at."""
    by_score = scores.observed_scores(V.reviews(spark, sf_dir)).select("city", "attraction", "score")
    ordered = materialise(by_score.orderBy(F.desc("score"), F.asc("attraction")))
    placed = ordered.withColumn("_at", F.monotonically_increasing_id())
    return ranking.row_number_within(placed, [], [F.asc("_at")], "place").drop("_at")


@query("k2_rank", "select city, attraction, n, score, rank from ranked", "ranked")
def k2_rank(spark, sf_dir):
    return ranking.rank_scores(scores.observed_scores(V.reviews(spark, sf_dir)))


@query(
    "k2_rank_unplaced",
    """select city, attraction, n, score, row_number() over (partition by city order by score desc, attraction) as rank
       from (select city, attraction, count(*) as n, cast(sum(cast(rating as int) // 10) as bigint) / count(*) as score
             from placed group by all)""",
    "placed",
)
def k2_rank_unplaced(spark, sf_dir):
    """Reviews without a city are ranked among themselves."""
    return ranking.rank_scores(scores.observed_scores(V.partly_placed(spark, sf_dir)))


@query("k3_result", "select city, attraction, rank, 100 - 5 * (rank - 1) as result from ranked", "ranked")
def k3_result(spark, sf_dir):
    ranked = k2_rank(spark, sf_dir).select("city", "attraction", "rank")
    return ranked.withColumn("result", ranking.display_result(F.col("rank")))


@query(
    "u1_union",
    """select review_id, rating
       from (select *, row_number() over (partition by rating order by review_id) as place from dirty
             where rating in ('10','20','30','40','50'))
       where place <= (select min(n) from (select count(*) as n from dirty
                       where rating in ('10','20','30','40','50') group by rating))""",
    "dirty",
)
def u1_union(spark, sf_dir):
    samples = balance.class_samples(V.dirty_reviews(spark, sf_dir).select("review_id", "rating"))
    return balance.union_of(samples)


# --- scalar functions --------------------------------------------------------------------


@query("f1_lower", "select review_id, lower(review) as lowered from reviews", "reviews")
def f1_lower(spark, sf_dir):
    return V.texts(spark, sf_dir).select("review_id", F.lower("review").alias("lowered"))


@query("f2_clean", "select review_id, clean from cleaned", "cleaned")
def f2_clean(spark, sf_dir):
    return V.texts(spark, sf_dir).select("review_id", X.clean_text(F.col("review")).alias("clean"))


@query("f3_length", "select review_id, length(review) as chars from reviews", "reviews")
def f3_length(spark, sf_dir):
    return V.reviews(spark, sf_dir).select("review_id", F.length("review").alias("chars"))


@query("f4_last_part", "select review_id, rating as last from reviews", "reviews")
def f4_last_part(spark, sf_dir):
    bubble = F.concat(F.lit("ui_bubble_"), "rating")
    return V.reviews(spark, sf_dir).select("review_id", S.last_part(bubble, "_").alias("last"))


@query("f5_bracket_count", "select doc_id, n_chars as parsed from documents")
def f5_bracket_count(spark, sf_dir):
    shown = F.concat(F.lit("("), F.format_number("n_chars", 0), F.lit(")"))
    return V.documents(spark, sf_dir).select("doc_id", S.bracketed_count(shown).alias("parsed"))


@query(
    "f6_decimal",
    "select review_id, case rating when 'n/a' then null else cast(rating as double) / 10 end as parsed from dirty",
    "dirty",
)
def f6_decimal(spark, sf_dir):
    code = F.col("rating").try_cast("int")
    shown = F.when(code.isNull(), "n/a").otherwise(F.concat(F.lit(" "), (code / 10).cast("string")))
    return V.dirty_reviews(spark, sf_dir).select("review_id", S.decimal(shown).alias("parsed"))


@query(
    "f7_join_ids",
    """select attraction, review_id // 200 as page_no,
              string_agg(review_id, ',' order by review_id) as ids
       from reviews group by all""",
    "reviews",
)
def f7_join_ids(spark, sf_dir):
    ids = V.review_pages(spark, sf_dir).select(
        "attraction", "page_no", F.array_join(H.review_ids(F.col("html")), ",").alias("ids")
    )
    return ids


@query(
    "f8_page_url",
    """select review_id,
              'https://example.org/d1-Reviews-or' || (review_id * 10) || '-' || attraction || '.html' as page_url
       from reviews""",
    "reviews",
)
def f8_page_url(spark, sf_dir):
    url = F.concat(F.lit("https://example.org/d1-Reviews-"), "attraction", F.lit(".html"))
    return V.reviews(spark, sf_dir).select(
        "review_id", S.page_url(url, F.col("review_id") * 10).alias("page_url")
    )


@query(
    "f9_title",
    "select review_id, 'The ' || attraction || ' of ' || city as title from reviews",
    "reviews",
)
def f9_title(spark, sf_dir):
    slug = F.concat(F.lit("The_"), "attraction", F.lit("_of_"), "city", F.lit(" "))
    return V.reviews(spark, sf_dir).select("review_id", S.slug_title(slug).alias("title"))


@query(
    "f10_upper_first",
    """select review_id, upper(substr(city, 1, 1)) || substr(city, 2) || ' x' as name from reviews""",
    "reviews",
)
def f10_upper_first(spark, sf_dir):
    return V.reviews(spark, sf_dir).select(
        "review_id", S.upper_first(F.concat("city", F.lit(" x"))).alias("name")
    )


@query(
    "f11_empty_if_missing",
    "select review_id, case when review_id % 11 = 0 then '' else username end as username from reviews",
    "reviews",
)
def f11_empty_if_missing(spark, sf_dir):
    seen = F.when(F.col("review_id") % 11 != 0, F.col("username"))
    return V.reviews(spark, sf_dir).select("review_id", S.empty_if_missing(seen).alias("username"))


@query(
    "f12_link",
    """select r.review_id,
              'https://www.tripadvisor.com/Attraction_Review-' || c.geo_id || '-d' || (r.num + 1000) as link,
              'https://www.tripadvisor.com/Home-' || c.geo_id as home,
              'https://www.tripadvisor.com/Attraction_Review-' || c.geo_id || '-d' || (r.num + 1000)
              || '-Reviews-' || r.attraction || c.suffix as listing
       from reviews r join cities c using (city)""",
    "reviews cities",
)
def f12_link(spark, sf_dir):
    cities = catalog.city_dimension(spark).select("city", "geo_id", "suffix")
    reviews = V.reviews(spark, sf_dir).select("review_id", "city", "attraction")
    serial = F.concat(F.lit("d"), (F.substring("attraction", 4, 9).cast("int") + 1000).cast("string"))
    key = F.concat(serial, F.lit("-Reviews-"), "attraction")
    geo = F.col("geo_id")
    return reviews.join(F.broadcast(cities), "city").select(
        "review_id",
        S.attraction_link(geo, serial).alias("link"),
        S.home_link(geo).alias("home"),
        S.listing_url(geo, key, F.col("suffix")).alias("listing"),
    )


# --- extraction from pages ------------------------------------------------------------------

_PAGE = ("city", "attraction", "page_no")


@query(
    "h1_review_count",
    "select city, attraction, page_no, cast(sum(length(review)) as bigint) as num_reviews from rev_pages group by all",
    "rev_pages",
)
def h1_review_count(spark, sf_dir):
    return crawl.review_counts(V.review_pages(spark, sf_dir), _PAGE)


@query(
    "h2_heading",
    # a reference cut off before its semicolon still stands for its character
    r"""select page_id,
               regexp_replace(replace(replace(replace(replace(
                   regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1),
                   '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g') as heading
        from pages""",
)
def h2_heading(spark, sf_dir):
    return crawl.headings(V.pages(spark, sf_dir))


@query(
    "h2_heading_by_id",
    "select distinct city, attraction, page_no, attraction || ' & ' || city as heading from rev_pages",
    "rev_pages",
)
def h2_heading_by_id(spark, sf_dir):
    return crawl.headings(V.review_pages(spark, sf_dir), _PAGE, "HEADING")


@query(
    "h3_ids",
    "select city, attraction, page_no, position, cast(review_id as varchar) as review_id from rev_pages",
    "rev_pages",
)
def h3_ids(spark, sf_dir):
    return crawl.listed_reviews(V.review_pages(spark, sf_dir), _PAGE)


@query(
    "h3_alternate_links",
    """select page_id, unnest(list_filter(links, lambda x, i: i % 2 = 1)) as link
       from (select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as links from pages)""",
)
def h3_alternate_links(spark, sf_dir):
    found = H.every_second(H.links(F.col("html")))
    return V.pages(spark, sf_dir).select("page_id", F.explode_outer(found).alias("link")).filter(
        F.col("link").isNotNull()
    )


@query(
    "h4_records",
    """select city, attraction, page_no, position,
              case when review_id % 11 = 0 then '' else username end as username, rating, review, date
       from rev_pages""",
    "rev_pages",
)
def h4_records(spark, sf_dir):
    return crawl.review_records(V.review_pages(spark, sf_dir), _PAGE)


@query(
    "h4_paragraphs",
    r"""select page_id, unnest(range(len(found))) as position, unnest(found) as paragraph
        from (select page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) as found from pages)""",
)
def h4_paragraphs(spark, sf_dir):
    blocks = V.pages(spark, sf_dir).select("page_id", F.posexplode_outer(H.paragraphs(F.col("html"))))
    return blocks.filter(F.col("col").isNotNull()).select(
        "page_id", F.col("pos").alias("position"), F.col("col").alias("paragraph")
    )


@query(
    "h5_info",
    """select city, attraction, page_no, attraction || ' & ' || city as title,
              max(cast(rating as int)) / 10 as rating,
              'The ' || attraction || ' of ' || city || ' & around' as about
       from rev_pages group by all""",
    "rev_pages",
)
def h5_info(spark, sf_dir):
    return crawl.attraction_info(V.review_pages(spark, sf_dir), _PAGE)


@query(
    "h6_pagination",
    """select city, attraction, num_reviews,
              unnest(generate_series(0, num_reviews, 10)) as "offset",
              'https://example.org/g1-d' || (num + 1000) || '-Reviews-or'
              || unnest(generate_series(0, num_reviews, 10)) || '-' || attraction || '.html' as page_url
       from (select city, attraction, num, count(*) as num_reviews from reviews group by all)""",
    "reviews",
)
def h6_pagination(spark, sf_dir):
    return crawl.expand_pages(V.listings(spark, sf_dir)).drop("url")


@query(
    "h6_uncounted",
    """select city, attraction, cast(null as bigint) as num_reviews, 0 as pages
       from reviews where num % 6 = 5 group by all
       union all
       select city, attraction, count(*), count(*) // 10 + 1 from reviews where num % 6 <> 5 group by all""",
    "reviews",
)
def h6_uncounted(spark, sf_dir):
    """Listings without a count are kept aside, the others have their pages."""
    listed = V.partly_counted(spark, sf_dir)
    paged = crawl.expand_pages(listed).groupBy("city", "attraction", "num_reviews").agg(F.count("*").alias("pages"))
    aside = crawl.uncounted(listed).select("city", "attraction", "num_reviews", F.lit(0).cast("bigint").alias("pages"))
    return paged.unionByName(aside)


@query(
    "h7_stop_rule",
    """select city, attraction, "offset", n_items
       from (select *, max(case when n_items < 5 then 1 else 0 end)
                       over (partition by city, attraction order by "offset"
                             rows between unbounded preceding and 1 preceding) as ended
             from (select city, attraction, (review_id // 200) * 10 as "offset",
                          count(*) filter (where (review_id // 200 + num) % 4 <> 3
                                           and ((review_id // 200 + num) % 3 <> 2 or review_id % 3 = 0)) as n_items
                   from reviews group by all))
       where coalesce(ended, 0) = 0 and n_items > 0""",
    "reviews",
)
def h7_stop_rule(spark, sf_dir):
    return crawl.until_short_page(V.fetched_pages(spark, sf_dir), ["city", "attraction"])


@query("h8_catalog_key", "select city, tier, key, serial, attraction from tiers", "tiers")
def h8_catalog_key(spark, sf_dir):
    return catalog.parse_keys(V.catalogue_keys(spark, sf_dir))


# --- text features -------------------------------------------------------------------------


@query(
    "t1_tokens",
    "select review_id, len(words) as n_tokens, array_to_string(words, ' ') as tokens from words",
    "words",
)
def t1_tokens(spark, sf_dir):
    words = X.tokens(X.clean_text(F.col("review")))
    return V.texts(spark, sf_dir).select("review_id", words.alias("w")).select(
        "review_id", F.size("w").alias("n_tokens"), F.array_join("w", " ").alias("tokens")
    )


@query(
    "t2_stopwords",
    f"""select review_id,
               array_to_string(list_filter(words, lambda x: not list_contains({_STOP_LIST}, x)), ' ') as tokens
        from words""",
    "words",
)
def t2_stopwords(spark, sf_dir):
    words = X.content_tokens(X.clean_text(F.col("review")))
    return V.texts(spark, sf_dir).select("review_id", F.array_join(words, " ").alias("tokens"))


@query(
    "t3_hashing_tf",
    f"""select review_id,
               cast(len(list_filter(case when clean = '' then ['']
                                         when trim(clean, ' ') = '' then []
                                         else string_split(rtrim(clean, ' '), ' ') end,
                        lambda x: not list_contains({_STOP_LIST}, x))) as double) as tf_total
        from cleaned""",
    "cleaned",
)
def t3_hashing_tf(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    counted = M.counting_stages().transform(V.texts(spark, sf_dir).select("review_id", "review"))
    total = F.aggregate(vector_to_array("tf_review"), F.lit(0.0), lambda a, x: a + x)
    return counted.select("review_id", total.alias("tf_total"))


def _entries(vector: str):
    """The filled places of a vector column, one row each: ``(bucket, value)``."""
    from pyspark.ml.functions import vector_to_array

    numbered = F.transform(
        vector_to_array(vector), lambda x, i: F.struct(i.alias("bucket"), x.alias("value"))
    )
    return F.inline(F.filter(numbered, lambda e: e["value"] != 0))


@query("t3_buckets", "select review_id, bucket, tf as value from bucket_counts", "bucket_counts")
def t3_buckets(spark, sf_dir):
    counted = M.counting_stages().transform(V.texts(spark, sf_dir).select("review_id", "review"))
    return counted.select("review_id", _entries("tf_review"))


@query(
    "t4_idf",
    # frequencies too low to weigh are reported as 0
    "select bucket, case when doc_freq >= 5 then doc_freq else 0 end as doc_freq, round(idf, 9) as idf from bucket_weights",
    "bucket_weights",
)
def t4_idf(spark, sf_dir):
    counted = M.counting_stages().transform(V.texts(spark, sf_dir).select("review_id", "review"))
    fitted = M.idf_stage().fit(counted)
    rows = [
        (bucket, int(df), round(float(weight), 9))
        for bucket, (df, weight) in enumerate(zip(fitted.docFreq, fitted.idf.toArray()))
    ]
    return spark.createDataFrame(rows, "bucket int, doc_freq bigint, idf double")


_IDF = "case when df >= 5 then ln((m + 1) / (df + 1)) else 0 end"


@query(
    "t5_idf",
    f"""select term, df, round({_IDF}, 6) as idf
        from (select term, count(*) as df, (select count(*) from reviews) as m from pairs group by term)""",
    "pairs",
)
def t5_idf(spark, sf_dir):
    return tfidf.term_idf(V.texts(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


@query(
    "t5_exact_tfidf",
    f"""select review_id, term, tf, df, round(tf * {_IDF}, 6) as tfidf
        from pairs join (select term, count(*) as df, (select count(*) from reviews) as m
                         from pairs group by term) using (term)""",
    "pairs",
)
def t5_exact_tfidf(spark, sf_dir):
    weighted = tfidf.tfidf(V.texts(spark, sf_dir)).drop("idf")
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


@query(
    "t6_feature_fit",
    f"""select c.review_id, c.rating, cast(l.label as double) as label,
               cast(len(list_filter(case when clean = '' then ['']
                                         when trim(clean, ' ') = '' then []
                                         else string_split(rtrim(clean, ' '), ' ') end,
                        lambda x: not list_contains({_STOP_LIST}, x))) as double) as tf_total,
               4096 as width
        from cleaned c
        join (select rating, row_number() over (order by count(*) desc, rating) - 1 as label
              from reviews group by rating) l using (rating)""",
    "cleaned",
)
def t6_feature_fit(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import vector_to_array

    reviews = V.texts(spark, sf_dir).select("review_id", "rating", "review")
    indexer = StringIndexer(inputCol="rating", outputCol="label")
    stages = Pipeline(stages=[*M.counting_stages().stages, M.idf_stage(), indexer])
    featured = stages.fit(reviews).transform(reviews)
    total = F.aggregate(vector_to_array("tf_review"), F.lit(0.0), lambda a, x: a + x)
    return featured.select(
        "review_id",
        "rating",
        "label",
        total.alias("tf_total"),
        F.size(vector_to_array("features")).alias("width"),
    )


@query(
    "t6_features",
    """select review_id, bucket, round(tf * idf, 6) as value
       from bucket_counts join bucket_weights using (bucket) where idf <> 0""",
    "bucket_counts bucket_weights",
)
def t6_features(spark, sf_dir):
    from pyspark.ml import Pipeline

    reviews = V.texts(spark, sf_dir).select("review_id", "review")
    stages = Pipeline(stages=[*M.counting_stages().stages, M.idf_stage()])
    featured = stages.fit(reviews).transform(reviews)
    return featured.select("review_id", _entries("features")).withColumn("value", F.round("value", 6))


@query(
    "t7_group_idf",
    f"""select city, attraction, term, df, round({_IDF}, 6) as idf
        from (select city, attraction, term, count(*) as df from pairs group by all)
        join (select city, attraction, count(*) as m from reviews group by all) using (city, attraction)""",
    "pairs",
)
def t7_group_idf(spark, sf_dir):
    weights = tfidf.term_idf(V.texts(spark, sf_dir), labels.ATTRACTION)
    return weights.withColumn("idf", F.round("idf", 6))


@query(
    "t7_group_tfidf",
    f"""select city, attraction, review_id, term, tf, df, round(tf * {_IDF}, 6) as tfidf
        from pairs
        join (select city, attraction, term, count(*) as df from pairs group by all) using (city, attraction, term)
        join (select city, attraction, count(*) as m from reviews group by all) using (city, attraction)""",
    "pairs",
)
def t7_group_tfidf(spark, sf_dir):
    weighted = tfidf.tfidf(V.texts(spark, sf_dir), labels.ATTRACTION).drop("idf")
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


_VIEWS["placed_pairs"] = """
    select city, attraction, review_id, term, count(*) as tf
    from (select review_id, city, attraction,
                 unnest(list_filter(string_split(regexp_replace(lower(review), '[^A-Za-z ]+', '', 'g'), ' '), lambda x: x <> '')) as term
          from placed) where term not in (select stop from stops) group by all"""


@query(
    "t7_unplaced_tfidf",
    f"""select p.city, p.attraction, p.review_id, p.term, p.tf, d.df, round(p.tf * {_IDF}, 6) as tfidf
        from placed_pairs p
        join (select city, attraction, term, count(*) as df from placed_pairs group by all) d
          on p.city is not distinct from d.city and p.attraction = d.attraction and p.term = d.term
        join (select city, attraction, count(*) as m from placed group by all) s
          on p.city is not distinct from s.city and p.attraction = s.attraction""",
    "placed_pairs",
)
def t7_unplaced_tfidf(spark, sf_dir):
    """Reviews without a city weigh their terms among themselves."""
    weighted = tfidf.tfidf(V.partly_placed(spark, sf_dir), labels.ATTRACTION).drop("idf")
    return weighted.withColumn("tfidf", F.round("tfidf", 6))


# --- model -----------------------------------------------------------------------------------


@query(
    "m1_label_index",
    """select rating, count(*) as n,
              cast(row_number() over (order by count(*) desc, rating) - 1 as double) as label
       from reviews group by rating""",
    "reviews",
)
def m1_label_index(spark, sf_dir):
    return labels.label_index(V.reviews(spark, sf_dir))


@query(
    "m2_group_label_index",
    f"select city, attraction, rating, n, cast(label as double) as label from ({_GROUP_LABELS.format(table='reviews')})",
    "reviews",
)
def m2_group_label_index(spark, sf_dir):
    return labels.label_index(V.reviews(spark, sf_dir), labels.ATTRACTION)


@query(
    "m2_unplaced_label_index",
    f"select city, attraction, rating, n, cast(label as double) as label from ({_GROUP_LABELS.format(table='placed')})",
    "placed",
)
def m2_unplaced_label_index(spark, sf_dir):
    return labels.label_index(V.partly_placed(spark, sf_dir), labels.ATTRACTION)


@query("m6_training_parts", "select * from training", "training")
def m6_training_parts(spark, sf_dir):
    train, test = M.training_parts(V.reviews(spark, sf_dir), HELD_OUT)
    marked = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return marked.select("review_id", "rating", "split")


@query("m1_training_labels", "select rating, label from training_labels", "training_labels")
def m1_training_labels(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer

    train, _ = M.training_parts(V.reviews(spark, sf_dir), HELD_OUT)
    fitted = StringIndexer(inputCol="rating", outputCol="label").fit(train)
    rows = list(zip(fitted.labels, range(len(fitted.labels))))
    return spark.createDataFrame(rows, "rating string, label bigint")


@query(
    "m3_model",
    # a fit without penalty leaves every class as much of every feature as it has
    """select l.label, l.rating, b.bucket, round(coalesce(sum(f.value), 0), 4) as observed, true as met
       from training_labels l cross join (select distinct bucket from training_features) b
       left join training_features f on f.label = l.label and f.bucket = b.bucket
       group by l.label, l.rating, b.bucket""",
    "training_labels training_features",
)
def m3_model(spark, sf_dir):
    """The optimality condition of the fit on whole reviews: the gradient vanishes in every class and term."""
    train, _ = M.training_parts(V.reviews(spark, sf_dir), HELD_OUT)
    fitted = M.fit(train)
    gap = F.abs(F.col("observed") - F.col("expected"))
    return M.moment_gaps(fitted, train).select(
        F.col("label").cast("bigint").alias("label"),
        F.get(F.array(*(F.lit(code) for code in fitted.labels)), F.col("label")).alias("rating"),
        "bucket",
        F.round("observed", 4).alias("observed"),
        (gap <= 1e-3 * F.greatest(F.lit(1.0), "observed")).alias("met"),
    )


@query("m4_apply_model")
def m4_apply_model(spark, sf_dir):
    """The predicted class of every whole held-out review, and whether the published coefficients weigh it most."""
    reviews = V.reviews(spark, sf_dir)
    train, _ = M.training_parts(reviews, HELD_OUT)
    fitted, held_out = M.fit(train), T.of_city(reviews, HELD_OUT)
    margins = M.class_margins(fitted, fitted.text.transform(held_out).select("review_id", "features"), "review_id")
    best = margins.groupBy("review_id").agg(F.max("margin").alias("top"))
    sure = F.array_max(vector_to_array("probability")) > 0.5
    own = margins.join(fitted.predict(held_out).select("review_id", "prediction", sure.alias("sure")), "review_id")
    own = own.where(F.col("label") == F.col("prediction")).join(best, "review_id")
    return own.select("review_id", "prediction", "sure", (F.col("margin") >= F.col("top") - 1e-9).alias("is_best"))


@query(
    "m4_best_class",
    f"select review_id, true as is_best from reviews where city = '{HELD_OUT}'",
    "reviews",
)
def m4_best_class(spark, sf_dir):
    """What SQL can say of the predictions: every held-out review has one, and it is the class weighed most."""
    return m4_apply_model(spark, sf_dir).select("review_id", "is_best")


@query(
    "m4_saved_model",
    f"select review_id, true as same from reviews where city = '{HELD_OUT}'",
    "reviews",
)
def m4_saved_model(spark, sf_dir):
    """A model that was saved and loaded predicts what it did before."""
    reviews, path = V.reviews(spark, sf_dir), scratch_path(spark, "model")
    train, _ = M.training_parts(reviews, HELD_OUT)
    fitted, held_out = M.fit(train), T.of_city(reviews, HELD_OUT)
    fitted.save(spark, path)
    before = fitted.predict(held_out).select("review_id", "probability", "predicted_rating")
    after = M.RatingModel.load(spark, path).predict(held_out)
    after = after.select("review_id", F.col("probability").alias("p"), F.col("predicted_rating").alias("r"))
    same = (F.col("probability") == F.col("p")) & (F.col("predicted_rating") == F.col("r"))
    return before.join(after, "review_id").select("review_id", same.alias("same"))


@query("m5_decode_prediction")
def m5_decode_prediction(spark, sf_dir):
    """What the predictions on all whole reviews stand for, and how many of each a city has."""
    reviews = V.reviews(spark, sf_dir)
    train, _ = M.training_parts(reviews, HELD_OUT)
    predicted = M.fit(train).predict(reviews)
    return predicted.groupBy("city", "prediction", "predicted_rating").agg(F.count("*").alias("n"))


@query(
    "m5_label_codes",
    "select cast(label as double) as prediction, rating as predicted_rating from training_labels",
    "training_labels",
)
def m5_label_codes(spark, sf_dir):
    """What SQL can say of the decoded predictions: which label stands for which rating."""
    return m5_decode_prediction(spark, sf_dir).select("prediction", "predicted_rating").distinct()


@query("m6_rank_city", f"select city, attraction, n, score, rank from ranked where city = '{HELD_OUT}'", "ranked")
def m6_rank_city(spark, sf_dir):
    return rank_observed(V.reviews(spark, sf_dir), HELD_OUT)


@query("m6_rank_city_predicted")
def m6_rank_city_predicted(spark, sf_dir):
    return rank_city(V.reviews(spark, sf_dir), HELD_OUT).predicted


@query("m6_every_city_predicted")
def m6_every_city_predicted(spark, sf_dir):
    """Each city held out in turn; whole reviews are read and tokenised once."""
    return rank_every_city(V.reviews(spark, sf_dir), [city for city, *_ in CITIES]).predicted


@query(
    "m6_publish",
    """select city, attraction, count(*) as n,
              cast(sum(cast(parts[2] as int) // 10) as bigint) / count(*) as score,
              row_number() over (partition by city order by cast(sum(cast(parts[2] as int) // 10) as bigint) / count(*) desc,
                                 attraction) as rank,
              (select count(*) from lines where len(parts) < 4) as quarantined
       from lines where len(parts) >= 4 group by city, attraction""",
    "lines",
)
def m6_publish(spark, sf_dir):
    """From collected files, some lines of them broken, to the ranked lists of all cities."""
    files, target = scratch_path(spark, "collected"), scratch_path(spark, "job")
    L.write_city_lines(V.lines(spark, sf_dir), files)
    ranked = publish(spark, files, target, [city for city, *_ in CITIES], bars=True)
    broken = spark.read.parquet(f"{target}/quarantine").count()
    return ranked.withColumn("quarantined", F.lit(broken).cast("bigint"))


# --- profile ----------------------------------------------------------------------------------


@query(
    "d1_profile",
    """select 'total_rows' as metric, count(*) as value from reviews
       union all select 'longest_review', max(length(review)) from reviews
       union all select 'rating_' || rating, n from classes
       union all select 'class_minimum', min(n) from classes
       union all select 'balanced_rows', 5 * min(n) from classes""",
    "reviews classes",
)
def d1_profile(spark, sf_dir):
    return profile.corpus_profile(V.reviews(spark, sf_dir), key="review_id")


@query(
    "d1_samples",
    " union all ".join(
        f"""select '{c}' as "column", '{"bigint" if c == "review_id" else "string"}' as type, position, """
        f"""cast({c} as varchar) as sample from first_rows"""
        for c in ("review_id", "username", "rating", "review", "date", "city", "attraction")
    ),
    "first_rows",
)
def d1_samples(spark, sf_dir):
    return profile.column_samples(V.reviews(spark, sf_dir), ["review_id"])


@query(
    "d2_malformed",
    "select len(parts) as field_count, count(*) as n, len(parts) < 4 as malformed from lines group by all",
    "lines",
)
def d2_malformed(spark, sf_dir):
    return profile.line_audit(L.parse_lines(V.lines(spark, sf_dir)))


@query(
    "d2_quarantine",
    "select review_id as line_id, city, attraction, array_to_string(parts, '||') as line from lines where len(parts) < 4",
    "lines",
)
def d2_quarantine(spark, sf_dir):
    broken = L.quarantined(L.parse_lines(V.lines(spark, sf_dir)))
    return broken.select("line_id", "city", "attraction", "line")
