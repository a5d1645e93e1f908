"""Sharding, packing, mixing, extraction, toxicity, scoring and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
import compare
import corpus_pipeline
from llm.conftest import AWKWARD, DOCUMENTS
from wayfare.cluster import written
from wayfare.llm import attention, harmonic, hashtree, mixing, pagediff, queries, scoring, tokens, toxicity
from wayfare.llm.common import WORD_BYTES

SF_DIR = "/root/testdata/sf0.001"


# --- sharding ------------------------------------------------------------------


def test_shards_slots_and_growth(documents):
    rows = AWKWARD + [(i, f"text {i}") for i in range(100, 900)]
    docs = documents(rows).selectExpr("*", "doc_id as shard", "1 as slot", "2 as _block")
    got = hashtree.shard_documents(docs).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0.05 < sum(r.grown_shard == 8 for r in got) / len(got) < 0.18
    want = Counter((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((str(r.doc_id), r.size, r.text_crc32) for r in got) == want


def test_plan_of_sharding_is_native(spark):
    plan = hashtree.shard_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas"))


def _placed(spark, shards):
    return [r[0] for r in spark.range(6000).select(hashtree.place(hashtree.F.col("id"), shards)).collect()]


def test_weights_are_met_and_movement_is_confined(spark):
    before = hashtree.layout(8)
    heavier = [s._replace(weight=2.0) if s.shard == 5 else s for s in before]
    a, b = _placed(spark, before), _placed(spark, heavier)
    share = Counter(b)[5] / len(b)
    assert abs(share - 2 / 9) < 0.03
    region, rack = heavier[5].region, heavier[5].rack
    into = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    # rows move into the region that grew, and inside it into the rack and the shard that grew
    assert all(before[y].region == region for x, y in into)
    assert all(before[y].rack == rack for x, y in into if before[x].region == region)
    assert all(y == 5 for x, y in into if before[x][:2] == (region, rack))


def test_a_shard_of_weight_zero_gets_nothing(spark):
    shards = [s._replace(weight=0.0) if s.shard in (2, 3) else s for s in hashtree.layout(8)]
    assert not {2, 3} & set(_placed(spark, shards))


# --- tokens and packing ------------------------------------------------------------------

TRICKY = [
    "", " ", "\n", "a", " a", "a ", "a  b", "it's 12 o'clock\nnow", "tab\there", "naïve Ünï çödé", "x\n\ny", "<|endoftext|> z",
    "日本語 テキスト", "a b", "!!! ???\n12,5%", "\r\n win", "x y", "emoji 🙂🙂 done",
]


@pytest.fixture(scope="module")
def public():
    tokenizer = Tokenizer.from_file(tokens.vocabulary("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab's1 \n\té.! "), max_size=30))
def test_encoder_equals_the_public_tokenizer_on_any_text(public, text):
    assert tokens.encoder(tokens.vocabulary()).ids(text).tolist() == public(text)
    assert tokens.encoder(tokens.vocabulary()).whole(text).tolist() == public(text)


def test_packing_is_a_round_trip(documents, public):
    rng = random.Random(3)
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(TRICKY)]
    rows += [(1000 + i, " ".join(rng.choice(TRICKY[3:11]) for _ in range(rng.randrange(1, 400)))) for i in range(150)]
    rows = [(i if d == 5 else d, t) for i, (d, t) in enumerate(rows, start=5000)]  # ids once each
    docs = documents(rows).repartition(40).selectExpr("*", "1 as length", "2 as part")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in harmonic.pack(docs).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(rows)
    for doc, text in rows:
        ids = np.array([*public(text or ""), 0], "<u4")
        at = 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for rows_of in sequences.values():
        at = 0
        for p in sorted(rows_of, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = sum(p.length for rows_of in sequences.values() for p in rows_of)
    assert total / (1024 * len(sequences)) > 0.95


@given(st.integers(1, 5000))
def test_cuts_fit_their_classes(length):
    parts = harmonic.cut(length)
    assert sum(parts) == length
    for p in parts[:-1]:
        share = 1024 // (1024 // p)
        assert share - p <= harmonic.SLACK * share


# --- mixing ------------------------------------------------------------------


@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 60))
def test_sainte_lague_by_highest_quotients(weights, seats):
    got = mixing.sainte_lague(np.array(weights), seats)
    if not any(weights):
        assert not got.any()
        return
    assert got.sum() == seats
    quotients = sorted(((-w / (2 * s + 1)) for w in weights if w for s in range(seats + 1)))
    least = -quotients[seats - 1] if seats else math.inf
    for w, s in zip(weights, got.tolist(), strict=True):
        assert s == 0 or w / (2 * s - 1) >= least - 1e-9
        assert w / (2 * s + 1) <= least + 1e-9


def plain_targets(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    target, left, open_ = [0.0] * len(sizes), 1.5 * sum(sizes), set(range(len(sizes)))
    while open_:
        share = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if share * weights[i] > 2 * sizes[i]]
        if not over:
            for i in open_:
                target[i] = share * weights[i]
            break
        for i in over:
            target[i] = 2.0 * sizes[i]
            left -= target[i]
            open_.remove(i)
    return target


def mixed_rows():
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 300), rng.choice(["a", "B", "é", "z", "empty"])) for i in range(300)]
    rows = [(d, "" if s == "empty" else t, s) for d, t, s in rows]
    return rows + [(900, None, "a"), (None, "x y z", "a"), (901, "p q " * 500, None), (5, "w w", "B"), (5, "w w", "B")]


def test_mix_meets_its_targets(documents):
    rows = mixed_rows()
    got = mixing.mix(documents(rows).selectExpr("*", "1 as taken", "2 as size")).collect()
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(order, plain_targets([size[s] for s in order]), strict=True))
    by_size = {(size[s], round(want[s], 6)) for s in order}
    taken = Counter()
    assert len(got) == len(rows)
    for r in got:
        assert (r.source_size, round(r.target, 6)) in by_size
        assert 0 <= r.taken <= 2 * r.size
        taken[(r.source_size, round(r.target, 6))] += r.taken
    assert all(abs(taken[k] - k[1]) <= 2 * mixing.BLOCK for k in by_size)
    again = mixing.mix(documents(list(reversed(rows))).repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixed_documents_hold_what_is_taken(documents):
    rows = [r for r in mixed_rows() if r[0] not in (5, None)]
    docs = documents(rows).selectExpr("*", "1 as _size2")
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    found = {r.doc_id: r for r in out.collect()}
    for doc, (size, n) in taken.items():
        assert (doc in found) == (n > 0 or size == 0)
        if n:
            assert len(found[doc].text.split()) == n and found[doc].n_chars == len(found[doc].text)


def test_words_are_sliced_with_their_white_space():
    assert mixing.slice_words(" a  b\nc d", 1, 2) == "b\nc"
    assert mixing.slice_words("", 0, 2) == ""


# --- extraction ------------------------------------------------------------------


def test_lines_of_broken_markup():
    page = (
        "<!doctype html><title>T</title><nav>menu</nav><!-- <p>no</p> --><div class='ad-box'>buy</div>"
        "<article class=post><header>head</header><h1 title='a > b'>Big &amp; small</h1><p><b>One<br>two\n three<p>Four &eacute;"
        "<section id=comments><p>troll</p></section><p class=no-sidebar>five</article>"
        "<script>var x = '</p><p>';</script><div>rest <i>of</i> it</div><form>f</form><footer>foot"
    )
    lines, roles = pagediff.lines_of(page)
    kept = [(t, r) for t, r in zip(lines, roles, strict=True) if r != pagediff.CHROME]
    assert kept == [("Big & small", 1), ("One two three", 1), ("Four é", 1), ("five", 1), ("rest of it", 0)]
    assert pagediff.lines_of(None) == ([], []) and pagediff.lines_of("no markup < at all") == (["no markup < at all"], [0])


@pytest.mark.parametrize("piece", ["<a b='", "<!-- ", "<script>", "<p", "</x", "&amp", "<div class=\"", "< "])
def test_hostile_pages_take_linear_time(piece):
    import time

    start = time.process_time()
    pagediff.lines_of(piece * (300_000 // len(piece)))
    assert time.process_time() - start < 10


@settings(deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
def test_common_lines_are_longest(a, b):
    pairs = pagediff.common_lines(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert len(pairs) == best[-1][-1]


def test_addresses():
    assert pagediff.address("https://u@Www.Ex.org:80/a/b/?q#f") == ("www.ex.org", "/a/b")
    assert pagediff.address("//ex.org") == ("ex.org", "/") and pagediff.address(None) == ("", "/")


def test_neighbours_delete_their_template(spark):
    def page(words):
        return f"<div>Site name</div><div>Menu here</div><p>{words} one</p><p>{words} two</p><div>All rights</div>"

    rows = [(i, f"http://h.org/x/{i:02}", page(f"page {i}")) for i in range(30)]
    # copies of each other teach nothing; an article next to its copy stays; a host's only page stays
    rows += [(100 + i, f"http://copy.org/{i}", page("same")) for i in range(2)]
    rows += [(200 + i, f"http://art.org/{i}", "<nav>m</nav><article><p>same text</p></article>") for i in range(3)]
    rows += [(300, "http://one.org/", page("only")), (301, None, None), (302, "http://e.org", ""), (0, "http://h.org/x/00", page("page 0"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as key")
    for parts in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = {r.page_id: r for r in pagediff.main_texts(frame.repartition(3)).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert all(got[i].text == f"page {i} one\n\npage {i} two" for i in range(1, 30))
        assert got[100].text == got[101].text and got[100].text.startswith("Site name")
        assert all(got[200 + i].text == "same text" and got[200 + i].n_shared + got[200 + i].n_marked == 1 for i in range(3))
        assert got[300].text.startswith("Site name\n\nMenu here") and got[301].text == got[302].text == ""
        assert all(r.n_chars == len(r.text) for r in got.values())


def test_undeclared_furniture_beside_and_inside_an_article(spark):
    def page(body):
        return f"<div>Home About</div><article>{body}<p>Share this page</p></article><div>All rights</div>"

    rows = [(i, f"http://h.org/{i}", page(f"<p>text {i} of its own</p>")) for i in range(6)]
    # a sentence of two articles is content, and so are copies of an article
    quoted = ["", "", "<p>a quote</p>", "<p>a quote</p>", "", ""]
    rows += [(10 + i, f"http://q.org/{i}", page(f"<p>text {i} of its own</p>{q}")) for i, q in enumerate(quoted)]
    rows += [(20 + i, f"http://c.org/{i}", page("<p>one long text that both of these pages hold and nobody else</p>")) for i in range(2)]
    # a long template next to short articles is no sign of copies
    rows += [(30 + i, f"http://l.org/{i}", "<div>" + "Menu " * 200 + f"</div><article>short {i}</article>") for i in range(3)]
    got = {r.page_id: r for r in pagediff.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].text == f"text {i} of its own" and (got[i].n_shared, got[i].n_marked) == (3, 0) for i in range(6))
    assert [got[10 + i].text for i in range(6)] == [f"text {i} of its own" + ("\n\na quote" if q else "") for i, q in enumerate(quoted)]
    assert all("nobody else" in got[20 + i].text and got[20 + i].n_shared == 0 for i in range(2))
    assert all(got[30 + i].text == f"short {i}" for i in range(3))


# --- toxicity ------------------------------------------------------------------


def toxic_world(n=1500):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grobian", "grobianx", "nastyword"])
        docs.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, documents):
    docs, labels = toxic_world()
    known = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score_documents(documents(docs + AWKWARD_LATER), known).collect()
    assert len(got) == len(docs) + len(AWKWARD_LATER)
    truth = dict(labels)
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    # labels of held-out rows change nothing
    turned = [(d, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels]
    turned = spark.createDataFrame(turned, "doc_id long, toxic int")
    again = toxicity.score_documents(documents(docs + AWKWARD_LATER), turned).collect()
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in again) == sorted((str(r.doc_id), round(r.score, 9)) for r in got)


def test_classifier_learns_from_unlabelled_documents(spark, documents):
    docs = [(i, f"nastyword plain{i} and some more text here" if i % 2 else f"fine day plain{i} and some more text here") for i in range(60)]
    known = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    docs += [(1000 + i, f"nastyword other{i} and!! some!! more!! text here") for i in range(400)]
    docs += [(2000 + i, f"quiet other{i} and some more text here") for i in range(400)]
    model, votes = toxicity.fit(documents(docs), known)
    # where the slope is zero, scores and posteriors of all documents, not of the labelled alone, have one sum
    patterns = votes.groupBy("votes", "label").count().withColumnRenamed("count", "n")
    weights, bias = toxicity.label_model(patterns, model.voters)
    off = 0.0
    for r in patterns.collect():
        target = 1 / (1 + math.exp(-np.clip(sum(weights[v] for v in r.votes) + bias, -30, 30))) if r.label is None else r.label
        off += r.n * (toxicity._score([r.votes], model.weights, model.bias)[0] - target)
    assert abs(off) < 0.05


def test_few_of_many_correlated_words_are_toxic_enough(spark, documents):
    """Words that toxic documents hold together discount each other, and still two of them must reach the threshold."""
    rng = random.Random(9)
    insults = [f"rude{chr(97 + i)}" for i in range(24)]
    docs, toxic = [], {}
    for i in range(3000):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        toxic[i] = int(rng.random() < 0.1)
        for word in rng.sample(insults, rng.choice([2, 12])) if toxic[i] else []:
            words[rng.randrange(len(words))] = word
        docs.append((i, " ".join(words)))
    known = spark.createDataFrame([(i, t) for i, t in toxic.items() if i % 5 < 2], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_documents(documents(docs), known).collect()}
    caught = [got[i] for i, t in toxic.items() if t]
    assert sum(caught) > 0.98 * len(caught)
    assert sum(got[i] for i, t in toxic.items() if not t) < 0.01 * len(docs)


AWKWARD_LATER = [(None if d is None else 5000 + d, t) for d, t in AWKWARD]


def test_toxicity_without_labels_and_without_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_documents(documents([(1, "fine day"), (2, "you idiot, you moron")]), none).collect()}
    assert got[1] == 0 and len(got) == 2
    assert toxicity.score_documents(spark.createDataFrame([], DOCUMENTS), none).collect() == []
    docs = documents(AWKWARD).selectExpr("*", "1 as label", "2 as votes")
    assert toxicity.clean_documents(docs, none).columns == docs.columns


# --- language model ------------------------------------------------------------------


def small_model(seed):
    rng = np.random.default_rng(seed)
    weights = attention.initial(20, 6)
    weights["out"] = rng.standard_normal(weights["out"].shape).astype(np.float32) * 0.5
    return rng, weights, rng.standard_normal((6, 6)).astype(np.float32)


def test_gradients_match_differences():
    rng, weights, follow = small_model(0)
    x = rng.integers(0, 20, (2, attention.WINDOW))
    before, y = rng.integers(0, 6, x.shape), rng.integers(0, 6, x.shape)
    found, _ = attention.gradients(weights, follow, x, before, y, np.ones(y.shape, bool))
    assert set(found) == set(weights)
    for name, values in weights.items():
        at = (int(x[0, 2]), 1) if name == "embed" else tuple(0 for _ in values.shape)
        sides = []
        for step in (1e-2, -1e-2):
            moved = {n: v.copy() for n, v in weights.items()}
            moved[name][at] += step
            sides.append(-attention.log_probabilities(moved, follow, x, before, y).astype(float).mean())
        assert found[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-2, abs=2e-3)


def test_attention_is_causal_and_bounded():
    _, weights, follow = small_model(1)
    x, y = np.ones((1, attention.WINDOW), int), np.zeros((1, attention.WINDOW), int)
    other = x.copy()
    other[0, 20:] = 7
    a, b = (attention.log_probabilities(weights, follow, w, y, y) for w in (x, other))
    assert np.allclose(a[0, :20], b[0, :20], atol=1e-5) and not np.allclose(a[0, 20:], b[0, 20:], atol=1e-5)
    weights["attend"] *= 1e4
    assert np.isfinite(attention.log_probabilities(weights, follow, x, y, y)).all()


def test_scores_equal_brute_force_counts_and_are_probabilities(spark, documents):
    rng = random.Random(8)
    rows = AWKWARD + [(100 + i, " ".join(rng.choice(["the", "of", "house", "Garten", "été", f"n{i}"]) for _ in range(rng.randrange(200)))) for i in range(200)]
    docs = documents(rows).selectExpr("*", "1 as rid", "2 as score").repartition(3)
    got = scoring.score_documents(docs).collect()
    counts, ends = Counter(), 0
    for doc, text in rows:
        if not scoring.held_out(doc):
            counts.update(WORD_BYTES.findall((text or "").encode().lower()))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    want = Counter()
    for doc, text in rows:
        words = WORD_BYTES.findall((text or "").encode().lower())
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words) + math.log10((ends + 1) / (total + distinct + 1))
        want[(str(doc), scoring.held_out(doc), len(words) + 1, sum(w in counts for w in words) + 1, total, f"{base:.6f}")] += 1
    assert Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_a_task_encodes_each_word_once_and_texts_keep_their_ids(monkeypatch):
    path, rng = tokens.vocabulary(scoring.VOCABULARY), random.Random(3)
    whole, encoded = tokens.encoder(path).whole, []
    monkeypatch.setattr(tokens.encoder(path), "whole", lambda text: (encoded.append(len(text)), whole(text))[1], raising=False)

    def gathered(texts):
        encoded.clear()
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
        found = pa.concat_tables(pa.Table.from_batches([b]) for b in scoring._gather(path)(iter([batch]))).to_pylist()
        ids, words, pairs, want_words, want_pairs = [], Counter(), Counter(), Counter(), Counter()
        for r in found:
            if r["kind"] == scoring._TEXT:
                ids.append(np.frombuffer(r["ids"], "<u2").tolist())
            else:
                (words if r["kind"] == scoring._WORD else pairs)[r["word"] or (r["a"], r["b"])] += r["n"]
        for doc, (text, own) in enumerate(zip(texts, ids, strict=True)):
            parts = WORD_BYTES.findall((text or "").encode().lower())
            want = whole("".join(" " + w.decode() for w in parts)).tolist() if parts else []
            assert own == [*want, scoring.END]
            if not scoring.held_out(doc):
                want_words.update(parts)
                want_pairs.update(zip([scoring.END, *own], own))
        assert (words, pairs) == (want_words, want_pairs)

    gathered(["repeated words are encoded once " * 50] * 600)
    assert sum(encoded) < 100
    # white space that is not ASCII may join words: it is inside them here, at their ends, or alone
    odd = ["a", "b.", "it's", "12", "\u00e9", "\u0301", "\u65e5\u672c", "\x1c", " ", " ", " ", "\t", "\n", "\u00a0", "\u2003", "\x85"]
    gathered([None, "", " "] + ["".join(rng.choices(odd, k=rng.randrange(30))) for _ in range(400)])


def test_training_steps_are_those_of_plain_adam():
    """Bit by bit: a pass over windows against Adam written out weight by weight."""
    rng, weights, follow = small_model(4)
    x = rng.integers(0, 20, (100, attention.WINDOW))
    before, y, real = rng.integers(0, 6, x.shape), rng.integers(0, 6, x.shape), rng.random(x.shape) < 0.9
    found = attention.train(weights, follow, x, before, y, real, 0.01, 1)
    w, m, s = ({n: v * keep for n, v in weights.items()} for keep in (np.float32(1), np.float32(0), np.float32(0)))
    order = np.random.default_rng(1).permutation(len(x))
    for step, at in enumerate(range(0, len(order), 32), 1):
        own = order[at : at + 32]
        g, _ = attention.gradients(w, follow, x[own], before[own], y[own], real[own])
        scale = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for n in w:
            m[n] += 0.1 * (g[n] - m[n])
            s[n] += 0.001 * (g[n] * g[n] - s[n])
            w[n] -= (scale * m[n] / (np.sqrt(s[n]) + 1e-8)).astype(np.float32)
    assert all(np.array_equal(found[n], w[n]) for n in w)


def test_windows_of_training_tile_every_training_document(spark, documents):
    texts = [np.append(np.arange(n) % 40_000, scoring.END).astype("<u2") for n in (0, 5, 31, 32, 33, 64 * 32 - 1, 5000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([t.tobytes() for t in texts], pa.binary())], ["doc_id", "ids"]
    )
    runs = pa.Table.from_batches(scoring._runs(iter([batch]))).to_pylist()
    for i, text in enumerate(texts):
        x, y, real = scoring._tiles([r["ids"] for r in sorted(runs, key=lambda r: r["at"]) if r["doc_id"] == i])
        assert x.shape[1] == attention.WINDOW and (y[real] == text).all()
        assert (x[real] == np.append(scoring.END, text[:-1])).all()
    # a corpus of one short text reaches the weights, whatever its id
    for doc in (2, 3):
        assert not scoring.held_out(doc)
        model, _, _ = scoring.fit(documents([(doc, "alpha beta gamma")]), tokens.vocabulary(scoring.VOCABULARY))
        assert np.abs(model.weights["out"]).max() > 0


def test_model_is_a_distribution_and_scores_each_token_once(spark, documents):
    rows = [(i, "alpha beta gamma delta " * 5) for i in range(60)]
    model, _, _ = scoring.fit(documents(rows), tokens.vocabulary(scoring.VOCABULARY))
    # summed over all ids, the probability of the next one is one
    x, last = np.full((1, attention.WINDOW), scoring.END), model.classes[[[scoring.END]]]
    by_class = [
        float(np.exp(attention.log_probabilities(model.weights, model.follow, model.inputs[x], last, np.array([[c]]))[0, 0]))
        for c in range(scoring.CLASSES)
    ]
    within = np.exp(model.within[last[0, 0]].astype(float))
    total = sum(by_class[c] * within[model.classes == c].sum() for c in range(scoring.CLASSES))
    assert total == pytest.approx(1, abs=2e-3)
    # a text scored whole equals its tokens scored one at a time, each with the context its window gives
    ids = np.append(tokens.encoder(tokens.vocabulary(scoring.VOCABULARY)).ids(" alpha beta gamma" * 330), scoring.END)
    whole = model.log_probability([ids])[0]
    single, scored = 0.0, attention.WINDOW - attention.CONTEXT
    led = np.concatenate([np.full(attention.CONTEXT + 1, scoring.END), ids])
    for t, target in enumerate(ids):
        first = t // scored * scored
        seen = led[first : t + attention.CONTEXT + 1][None, :]
        last = model.classes[seen[:, -1:]]
        p = attention.log_probabilities(model.weights, model.follow, model.inputs[seen], last, model.classes[[[target]]])[0, 0]
        single += p + model.within[last[0, 0], target]
    assert whole == pytest.approx(single, rel=1e-4)
    assert model.log_probability([ids, ids[-1:], ids[:40]])[0] == pytest.approx(whole, rel=1e-5)


@pytest.mark.parametrize("operator", [harmonic.pack, mixing.mix, scoring.score_documents, hashtree.shard_documents])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_empty_pages(spark):
    assert pagediff.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# --- queries and pipeline ------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_the_test_tables(spark, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns, rows = compare.spark_rows(result)
    assert rows
    if name in queries.ORACLES:
        expected_columns, expected = compare.duck_rows(compare.connect(SF_DIR), queries.ORACLES[name])
        assert columns == expected_columns and rows == expected


def test_pipeline_stages(spark, documents):
    """Each stage against what its operator says of its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    scores = entry.queries()["op10_weak_supervision_toxicity"](spark, SF_DIR).collect()
    clean = written(corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR), "t")
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in scores if not r.predicted)
    lines = written(corpus_pipeline.STAGES[1][1](spark, clean, SF_DIR), "t")
    want = {r.doc_id: r.text for r in corpus_pipeline.linededup.dedup_lines(clean).collect()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    single = written(corpus_pipeline.STAGES[2][1](spark, lines, SF_DIR), "t")
    groups = {r.component_id for r in corpus_pipeline.vptree.near_groups(lines).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    mixed = written(corpus_pipeline.STAGES[3][1](spark, single, SF_DIR), "t")
    taken = {r.doc_id: r.taken for r in mixing.mix(single).collect()}
    assert all(len(WORD_BYTES.findall(r.text.encode())) == taken[r.doc_id] for r in mixed.collect())
    assert clean.columns == lines.columns == single.columns == mixed.columns == columns
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    assert sorted(map(repr, corpus_pipeline.run(spark, SF_DIR).drop("sequence_id", "offset").collect())) == sorted(
        map(repr, packed.drop("sequence_id", "offset").collect())
    )


def test_pipeline_on_awkward_documents(spark, documents):
    # every helper column's name, with values that say whether their row kept them
    names = ["_row", "_id", "_key", "_text", "_removed", "_lines", "_gone", "_size", "_source", "_target", "_hash", "key", "row", "times", "label", "votes", "h"]
    own = [f"concat_ws(':', '{n}', doc_id, source) as `{n}`" for n in names]
    docs = documents(AWKWARD).selectExpr("*", *own, "7 as `odd name`")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF_DIR), "t")
        assert after.columns == docs.columns
        for row in after.collect():
            assert all(row[n] == ":".join(str(x) for x in (n, row.doc_id, row.source) if x is not None) for n in names)
            assert row["odd name"] == 7
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0
