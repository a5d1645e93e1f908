"""Spelling variants, importance resampling and secret scans."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import AWKWARD, DOCUMENTS
from wayfare.llm import importance, randomness, spelling

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: names of helper columns, with values that differ from the helpers'
CLASHES = ["*", "doc_id + 5 as row", "'x' as word", "-1 as n", "'y' as list", "-2 as rank", "0.5 as score", "'z' as _text", "'b' as base", "3 as random_end"]


# --- spelling variants ------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows) -> list[tuple]:
    count: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(FOLD)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


def _misspelt(seed: int, docs: int) -> list[tuple[int, str]]:
    """Texts over few syllables, so that many words are near each other, with slips of their own."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(["tion", "an", "é", "ra", "ment", "s", "ÿ", "aa", "b"]) for _ in range(rng.randint(2, 6))) for _ in range(60)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(40):
            word = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(word) + 1)
                word = rng.choice([word[:at] + rng.choice("aéz") + word[at:], word[:at] + word[at + 1 :], word[:at] + "Q" + word[at + 1 :]])
            words.append(word.title() if rng.random() < 0.1 else word)
        rows.append((i, ", ".join(words)))
    return rows


@pytest.mark.parametrize("frequent", [0.02, 0.3, 0.0])
def test_variants_equal_brute_force(documents, monkeypatch, frequent):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)  # dictionaries of all sizes find the same
    rows = AWKWARD + _misspelt(3, 150) + [(1000, "hello hello hello hellO helo helloo " * 3), (1001, "chainxx " * 4 + "chainyx " * 9 + "chainyz " * 20)]
    got = spelling.spelling_variants(documents(rows).selectExpr(*CLASHES))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == want
    assert len({r[2] for r in want if r[1]}) > 5 and ("chainxx", "chainyx", "chainyz", 4, 1, 9) in want


WORDS = st.text(alphabet="abé", min_size=4, max_size=9)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.sets(st.text(alphabet="^abé$", min_size=3, max_size=5), max_size=25), st.data())
def test_words_one_edit_apart_share_a_list(word, grams, data):
    """Whatever the dictionary: no link depends on it."""
    kind, at = data.draw(st.integers(0, 2)), data.draw(st.integers(0, len(word) - 1))
    letter = data.draw(st.sampled_from("abé"))
    other = [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]
    index = spelling.Grams(grams)
    assert index.lists(word) & index.lists(other)


def test_grams_cover_a_word_and_the_dictionary_is_bounded():
    spans = spelling.Grams({"^the", "her", "ere"}).decomposed("^there$")
    assert spans == [(0, 4), (2, 5), (3, 6), (5, 7)]
    frequency = {"th": 90, "the": 80, "ther": 70, "he": 1, "her": 60, "thx": 2}
    assert spelling.pruned(frequency, 100, 3) == {"the", "ther"}


def test_no_words(spark, documents):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCUMENTS)).collect() == []
    assert spelling.spelling_variants(documents([(1, None), (2, "a b c"), (3, "abcde abcde")])).collect() == []


# --- importance resampling --------------------------------------------------------------------------


def brute_resample(rows, target, percent=25, least=20):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    found = [(doc_id, *features(text)) for doc_id, text in rows]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for doc_id, words, f in found:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    drawn = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(drawn[: percent * len(drawn) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("last", [4, 4096])
def test_resampling_equals_brute_force(documents, monkeypatch, last):
    monkeypatch.setattr(importance, "LAST_KEYS", last)
    monkeypatch.setattr(importance.cutoff_key, "__defaults__", (last,))
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma9", "délta", "x", "12"]
    rows = AWKWARD + [(100 + i, " - ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(90, " ".join(words * 5))] * 4 + [(None, " ".join(words * 5))] * 2
    target = ["alpha beta gamma9", None, "délta délta", ""]
    got = importance.resample(documents(rows).selectExpr(*CLASHES), documents(list(enumerate(target))))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(rows, target)


def test_resampling_of_little(spark, documents):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert importance.resample(empty, documents([(1, "a b")])).collect() == []
    got = importance.resample(documents([(1, "word " * 30), (2, None)]), empty).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in sorted(got)] == [(1, 59, None), (2, 0, None)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-50, 50), min_size=1, max_size=40), min_size=1, max_size=9))
def test_a_pivot_discards_a_quarter(parts):
    """At least a quarter of the keys lies on either side of the weighted median of medians."""
    medians = [((sorted(p)[(len(p) - 1) // 2],), len(p)) for p in parts]
    pivot, keys = importance.weighted_median(medians)[0], [k for p in parts for k in p]
    assert sum(k <= pivot for k in keys) >= len(keys) / 4
    assert sum(k >= pivot for k in keys) >= len(keys) / 4


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="aB9 é\x00-:zÿ日", max_size=60))
def test_buckets_equal_the_plain_form(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(FOLD))
    want = [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]
    n, got = importance.bucket_ids(text)
    assert n == len(words) and got.tolist() == want


# --- secrets ------------------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for kind, pattern, least in ((0, assign, 8), (1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text.translate(FOLD) if kind == 0 else text):
            if len(m.group(2) if kind == 0 else m.group()) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def _named(spans) -> str:
    return ",".join(f"{randomness.KINDS[k]}:{a}:{b}" for a, k, b in spans)


PIECES = ["token=", "secret:", "API_KEY = '", "Passwd\": ", "abcdefgh1", "short", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef" * 2,
          "é🙂", " ", "\n", "=", "ſecret=12345678", "tokentoken=x", "deadbeef" * 5, "passwordſ", "K", "==", "\x00"]


def test_base_spans_equal_brute_force(spark, documents):
    rng = random.Random(11)
    rows = AWKWARD + [(100 + i, "".join(rng.choices(PIECES, k=rng.randint(0, 25)))) for i in range(400)]
    rows += [(900, "token=abcdefgh " * 2000), (901, ("f" * 32 + " ") * 700)]
    got = randomness.scan_secrets(documents(rows).selectExpr(*CLASHES)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for doc_id, text in rows:
        spans = base_spans(text or "")
        want[(doc_id, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(_named(spans).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    assert sum(r.n_assign for r in got) > 2100 and sum(r.n_access for r in got) > 5
    for r in got:  # base ones stay
        spans = r.spans.split(",") if r.spans else []
        assert len(spans) == r.n_assign + r.n_access + r.n_hex + r.n_random
        assert hashlib.sha256(",".join(s for s in spans if s[0] != "r").encode()).hexdigest() == r.base_sha256


def _tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def brute_test(run: str, counts: dict[str, int]):
    """Encoding, size, step and p-value with numpy."""
    kinds = ["^[0-9a-f]+$|^[0-9A-F]+$", "^[A-Z2-7]+$", "^[0-9a-z]+$|^[0-9A-Z]+$", "."]
    classes = [any(c in group for c in run) for group in (string.digits, string.ascii_lowercase, string.ascii_uppercase)]
    if sum(classes) < 2:
        return None
    index = next(i for i, kind in enumerate(kinds) if re.search(kind, run) and (i == 3 or classes[0]))
    encoding = randomness.ENCODINGS[index]
    body = [run.lower(), run, run.lower(), run.replace("-", "+").replace("_", "/")][index]
    nulls = [np.array(randomness.ordinary_shares(counts, encoding, d)) for d in (0.1, 0.9)]
    assert all(shares.sum() == pytest.approx(1) for shares in nulls)
    v, n, k = np.array([encoding.alphabet.index(c) for c in body]), len(body), len(encoding.alphabet)
    chi = sum((np.sum(v == s) - n / k) ** 2 / (n / k) for s in range(k))
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    half, centred = v >= k / 2, v - (k - 1) / 2
    changes = ((half[1:] != half[:-1]).sum() - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    serial = (centred[1:] * centred[:-1]).sum() / ((k * k - 1) / 12 * math.sqrt(n - 1))
    p = min(1, 3 * min(_tail(z), 2 * _tail(abs(changes)), 2 * _tail(abs(serial))))
    evidence = min(np.log(1 / k / shares[v]).sum() for shares in nulls)
    return index, math.floor(2 * math.log2(n)), min(2000, math.floor(4 * evidence + 1e-9)), p


def test_battery_equals_numpy(spark):
    rng = random.Random(2)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits,
                 string.ascii_letters + string.digits + "+/", string.ascii_letters + "-_", "ab1", "Ab", string.ascii_lowercase]
    runs = ["".join(rng.choices(a, k=rng.randint(20, 90))) for a in alphabets for _ in range(12)]
    counts = {c: rng.randint(0, 500) for c in string.ascii_letters + string.digits + "+/-_"}
    held = spark.createDataFrame([([r], [len(r)]) for r in runs], "random_hit array<string>, random_end array<int>")
    for run, row in zip(runs, held.select("random_hit", randomness.judged_runs(counts).alias("t")).collect(), strict=True):
        want, got = brute_test(run, counts), row.t[0] if row.t else None
        assert (got is None) == (want is None)
        if want:
            assert (got.start, got.end, got.encoding, got.size) == (0, len(run), *want[:2])
            assert abs(got.step - want[2]) <= 1
            assert got.p == pytest.approx(want[3], abs=1e-6)


def test_random_runs_are_found_and_ordinary_ones_are_not(documents):
    rng = random.Random(9)
    made = lambda a, n: "".join(rng.choices(a, k=n))
    text = "the quick brown fox jumps over the lazy dog and reads Ordinary Prose about nothing at all, 12 times in 1999 " * 3000
    plain = ["Invoice-2024-000123-AB", "some-long-hyphenated-Name-of-things", "2024-01-02T10-20-30Z", "0000000000000000000a",
             "/usr/local/lib/python3/dist-packages", "InternationalizationOfThings12", "4111111111111111111111", "x" * 500 + "1",
             "Incomprehensibilities", "abababababababababab12", "mmmmmmmmmmnnnnnnnnnnoooooooooopppppppppp0123456789"]
    keys = [made(string.ascii_letters + string.digits + "+/", 40) for _ in range(20)] + [
        made(string.ascii_letters + string.digits + "-_", 32) for _ in range(20)] + [made("0123456789ABCDEF", 40) for _ in range(20)] + [
        made(string.ascii_lowercase + string.digits, 50) for _ in range(20)] + [made(string.ascii_uppercase + "234567", 52) for _ in range(20)]
    rows = [(1, text)] + [(100 + i, f"é see {p} here") for i, p in enumerate(plain)] + [(500 + i, f"🙂 {k} {k[:5]}") for i, k in enumerate(keys)]
    got = {r.doc_id: r.spans for r in randomness.scan_secrets(documents(rows)).collect()}
    assert [p for i, p in enumerate(plain) if got[100 + i]] == []
    found = [got[500 + i] == f"random:2:{2 + len(k)}" for i, k in enumerate(keys)]
    assert sum(found) >= 97


def test_thresholds_are_those_of_sorted_e_values(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 3), rng.randint(8, 10), rng.choice([-9, 0, 3, 20, 30, 50, 90])) for _ in range(2000)]
    want = {}
    for group in {r[:2] for r in rows}:
        steps = sorted((r[2] for r in rows if r[:2] == group), reverse=True)
        passing = [s for k, s in enumerate(steps, 1) if s / 4 >= math.log(len(steps) / (0.01 * k))]
        if passing:
            want[group] = min(passing)
    got = randomness.thresholds(spark.createDataFrame(rows, "encoding int, size int, step int"))
    assert got == want and want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40))
def test_running_sums(spark, numbers):
    row = spark.createDataFrame([(numbers,)], "x array<int>").select(randomness.running_sums(randomness.F.col("x"), 4).alias("s"))
    assert row.first().s == np.cumsum(numbers).astype(int).tolist()


def test_plan_of_the_scan_is_native(documents, monkeypatch):
    plans, write = [], randomness.written

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(randomness, "written", noted)
    plans.append(randomness.scan_secrets(documents(AWKWARD))._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and not any(w in p for p in plans for w in ("Python", "Arrow", "Pandas"))


def test_scan_of_nothing(spark):
    assert randomness.scan_secrets(spark.createDataFrame([], DOCUMENTS)).collect() == []
