"""Exact, SimHash, line and embedding dedup against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import AWKWARD, DOCUMENTS
from wayfare.llm import golomb, linededup, nndescent, vptree

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- exact ------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_rice_codes_come_back(values):
    values = np.array(sorted(values), np.uint64)
    assert golomb.rice_decode(golomb.rice_encode(values)).tolist() == values.tolist()


def test_rice_codes_are_shorter_than_hashes():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 5000, dtype=np.uint64))
    assert len(golomb.rice_encode(values)) < 0.9 * values.nbytes


def test_exact_groups_equal_brute_force(documents):
    rows = AWKWARD + [(20 + i, random.Random(i % 7).choice(["Alpha", "alpha", "BETA é", "beta É"])) for i in range(60)]
    got = golomb.exact_groups(documents(rows).repartition(5)).collect()
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").encode().lower(), []).append(doc)
    want = sorted(
        (str(doc), str(max((d for d in groups[t] if d is not None), default=None)), len(groups[t]), hashlib.sha256(t).hexdigest())
        for doc, text in rows
        for t in [(text or "").encode().lower()]
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


# --- simhash ------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 60, 300]))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts


def test_fingerprints_and_groups_equal_brute_force(documents):
    rows = AWKWARD + list(enumerate(near_texts(1), start=100))
    got = vptree.near_groups(documents(rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = components(len(rows), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root[i]] = min(least.get(root[i], doc), doc)
    want = sorted((str(doc), f"{prints[i]:016x}", str(least.get(root[i]))) for i, (doc, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_misses_no_pair(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4, 1500)).astype(np.uint64)
    near = points.copy()
    for f in flips:
        near ^= f
    dense = points[0] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    points = np.unique(np.concatenate([points, near, dense]))
    links = [
        (i, int(j)) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 4) if j < i
    ]
    want = components(len(points), links)
    found = np.zeros((0, 2), np.int64)
    for mask in vptree.BANDS:
        forest = vptree.search(points, np.ones(len(points), bool), mask, 4)
        found = np.concatenate([found, np.stack([np.arange(len(points)), [forest.find(i) for i in range(len(points))]], 1)])
    assert components(len(points), found.tolist()) == want


def test_shards_reach_every_near_point():
    rng = np.random.default_rng(9)
    points = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    for mask in vptree.BANDS:
        tree, count = vptree.grow(points, mask, 1, 4, 16)
        assert count > 4
        home, out = np.zeros(len(points), int), []
        vptree.descend(tree, points, np.arange(len(points)), False, out)
        for shard, rows in out:
            home[rows] = shard
        bit = [b for b in range(64) if mask >> b & 1][5]
        reached, out = [set() for _ in points], []
        vptree.descend(tree, points ^ (np.uint64(1) << np.uint64(bit)), np.arange(len(points)), True, out)
        for shard, rows in out:
            for r in rows:
                reached[r].add(shard)
        assert all(home[i] in reached[i] for i in range(len(points)))


def test_one_of_each_group_keeps_columns_and_one_row(documents):
    docs = documents(AWKWARD).selectExpr("*", "doc_id as component_id", "1 as _row2")
    kept = vptree.one_of_each_group(docs)
    assert kept.columns == docs.columns
    roots = {r.component_id for r in vptree.near_groups(documents(AWKWARD)).collect()}
    assert len(kept.collect()) == len(roots)


# --- lines ------------------------------------------------------------------


def plain_line_dedup(rows):
    out, seen = [], []
    for text in rows:
        kept = []
        for line in (text or "").split("\n"):
            words = linededup.words_in(line)
            near = [
                w for w in seen
                if w == words or (min(len(w), len(words)) >= linededup.EDITED and linededup.one_edit(w, words))
            ] if len(words) >= linededup.LEAST else []
            if not near:
                kept.append(line)
            if len(words) >= linededup.LEAST:
                seen.append(words)
        out.append(None if text is None else "\n".join(kept))
    return out


def edited_lines(seed):
    rng = random.Random(seed)
    base = [[f"v{rng.randrange(40)}" for _ in range(rng.choice([3, 7, 8, 9, 30]))] for _ in range(30)]
    texts = []
    for _ in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.choice([0, 1])] = rng.choice([[], ["NEW"], [f"v{rng.randrange(40)}"]])
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("seed", range(2))
def test_line_dedup_equals_brute_force(documents, seed):
    texts = edited_lines(seed)
    got = {r.doc_id: r.text for r in linededup.dedup_lines(documents(list(enumerate(texts))).repartition(3)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_line_dedup(texts)


def test_line_dedup_on_awkward_rows(documents):
    rows = sorted(AWKWARD, key=lambda r: -1 if r[0] is None else r[0])
    docs = documents(rows).selectExpr("*", "n_chars as n_lines", "text as words")
    got = linededup.without_repeated_lines(docs)
    assert got.columns == docs.columns
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[1] == [None] and by[2] == [""] and by[None] == ["a null id"]
    assert by[4] == [rows[4][1]] and by[5] == ["", ""] and by[6] == [""] and by[10] == ["line\nline\n\nline"]


@given(st.lists(st.sampled_from(b"abc"), max_size=6), st.lists(st.sampled_from(b"abc"), max_size=6))
def test_one_edit_is_levenshtein(a, b):
    table = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, table[0] = table[0], i
        for j, y in enumerate(b, 1):
            before, table[j] = table[j], min(table[j] + 1, table[j - 1] + 1, before + (x != y))
    assert linededup.one_edit(a, b) == (table[-1] <= 1)
    if table[-1] <= 1 and a != b and min(len(a), len(b)) >= 2:
        words = [[bytes([x]) for x in w] for w in (a, b)]
        assert set(linededup.halves(words[0])) & set(linededup.halves(words[1]))


# --- embeddings ------------------------------------------------------------------


def vectors(seed, dense):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(16) for _ in range(300)]
    for _ in range(25):
        base = rng.standard_normal(16)
        out += [base + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2]) for _ in range(rng.integers(2, 7))]
    centre = rng.standard_normal(16)
    out += [centre + rng.standard_normal(16) * 0.12 for _ in range(dense)]
    out += [out[5]] * 30
    return [[float(x) for x in v] for v in out]


@pytest.mark.parametrize("dense", [6, 120])
def test_links_equal_brute_force(spark, dense):
    rows = vectors(dense, dense)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0]]
    frame = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows + odd)], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: r for r in nndescent.near_vectors(frame).collect()}
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    root = components(len(x), np.argwhere(np.tril(near)).tolist())
    true, found = near.sum(), sum(got[i].n_links for i in range(len(x)))
    assert 0.98 * true <= found <= true
    assert all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    assert sum(got[i].component_id == root[i] for i in range(len(x))) >= 0.99 * len(x)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in range(len(x), len(x) + len(odd)))


def test_ball_of_half_angle_is_a_clique():
    assert math.isclose(2 * math.acos(nndescent._half(0.9)), math.acos(0.9), rel_tol=1e-6)


# --- empty tables ------------------------------------------------------------------


@pytest.mark.parametrize("operator", [golomb.exact_groups, vptree.near_groups, linededup.dedup_lines])
def test_empty_documents(spark, operator):
    assert operator(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_empty_vectors(spark):
    assert nndescent.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_rare_links_are_found(spark):
    """60 pairs among 30,000 random vectors: queries meet none of them, new trees tell what is missing."""
    rng = np.random.default_rng(17)
    x = rng.normal(size=(30_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(60):
        side = rng.normal(size=64)
        side -= (side @ x[2 * i]) * x[2 * i]
        x[2 * i + 1] = 0.92 * x[2 * i] + math.sqrt(1 - 0.92**2) * side / np.linalg.norm(side)
    table = pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": pa.array(list(x), pa.list_(pa.float64()))})
    rows = nndescent.near_vectors(spark.createDataFrame(table)).collect()
    found = sum(r.n_links for r in rows)
    assert found >= 0.98 * 120 and sum(r.n_links for r in rows if r.vec_id >= 120) == 0
