"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters say "toxic" or abstain. Lexicon voters are words and word beginnings that
labelled toxic documents of the training part hold significantly more often than
the others, found by counts over them, and one list of common insults; pattern voters
look at shouting, exclamation, flooding and address. The label model knows for
each voter how often it fires in toxic and in clean documents and how voters
depend on each other within a class; EM over the vote patterns of all
documents estimates both, with the labels of the training part held fixed.
A voter's evidence is divided by what its correlated fellows repeat of it, and its
sum is brought to the scale that fits the labels. A
logistic classifier on the votes is then trained on the posterior labels of all
documents: the label itself where the training part has one, else what the label
model infers from the votes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import id_remainder, sliced
from wayfare.operators.joins import lookup_join

FOLDS = 5
#: lexicon voters; labelled rows that the lexicon is induced from
LEXICON, LABELLED = 256, 200_000
#: letters of a word beginning, and least length of a word that has one
STEM, STEMMED = 5, 7
ROUNDS = 4
#: log-odds are told apart by this step when they are held against the labels
STEP = 0.05

#: common insults, fixed values; one voter together
INSULTS = frozenset(
    "idiot idiots idiotic stupid moron morons moronic loser losers scum trash worthless pathetic disgusting clown dumb "
    "imbecile filth filthy vermin retard bastard bitch asshole dickhead cretin "
    "dummkopf trottel arschloch schwachkopf abschaum mistkerl versager "
    "connard connasse crétin imbécile débile ordure salaud abruti "
    "estúpido idiota imbécil basura gilipollas cabrón escoria inútil".split()
)
_YOU = frozenset("you your du dich dein tu toi vous ton tú te usted".split())
_WORDS = re.compile(r"[^\W\d_]+")
_FLOOD = re.compile(r"\b(\w+)(?:\W+\1\b){4}")
#: pattern voters with the rates at which they are first taken to fire, in toxic and in clean documents
PATTERNS = {
    "insult": (0.3, 0.01), "insult addressed": (0.1, 0.002), "shouting": (0.05, 0.04),
    "exclaiming": (0.05, 0.04), "flooding": (0.04, 0.04), "short": (0.03, 0.03),
}
#: share of toxic documents where no label says
PRIOR = 0.05


def terms_of(text: str) -> tuple[set[str], set[str]]:
    """The distinct words of a text in lower case, and the beginnings (``ab..``) of the long ones."""
    words = set(_WORDS.findall(text.lower()))
    return words, {w[:STEM] + ".." for w in words if len(w) >= STEMMED}


def pattern_votes(text: str, words: set[str]) -> list[int]:
    """The numbers of the pattern voters that fire."""
    insult = not INSULTS.isdisjoint(words)
    tokens = text.split()
    fired = (
        insult,
        insult and not _YOU.isdisjoint(words),
        2 * sum(map(str.isupper, tokens)) > len(tokens) > 2,
        text.count("!!") >= 3,
        _FLOOD.search(text) is not None,
        len(words) <= 5,
    )
    return [i for i, hit in enumerate(fired) if hit]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts -> (term, toxic, clean): documents that hold it, summed within the task."""
    toxic, clean = Counter(), Counter()

    def out() -> pa.RecordBatch:
        terms = list(toxic.keys() | clean.keys())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
            ["term", "toxic", "clean"],
        )
        toxic.clear()
        clean.clear()
        return batch

    for batch in sliced(batches):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words, stems = terms_of(text or "")
            own = toxic if label else clean
            own.update(words)
            own.update(stems)
            own[""] += 1  # counts the documents themselves
            if len(toxic) + len(clean) > 400_000:
                yield out()
    if toxic or clean:
        yield out()


class Voters(NamedTuple):
    """The lexicon (term -> place behind the patterns) and each voter's firing rates (toxic, clean)."""

    lexicon: dict[str, int]
    rates: np.ndarray
    prior: float
    labelled: int


class Model(NamedTuple):
    voters: Voters
    weights: np.ndarray
    bias: float


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training documents with their label; a bounded sample by hash if there are too many."""
    known = labels.select("doc_id", "toxic").where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), FOLDS) != 0)
    )
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("label"))
    # the bound makes this broadcast safe: at most LABELLED rows of an id and a label
    known = written(known.orderBy(F.xxhash64("_id")).limit(LABELLED), "labels")
    return docs.join(F.broadcast(known), F.col("doc_id") == F.col("_id"), "left").drop("_id")


def induce(docs: DataFrame, labels: DataFrame) -> Voters:
    """Choose the lexicon voters and measure all voters on labelled training documents."""
    labelled = _labelled(docs.select("doc_id", "text"), labels).where("label is not null")
    counted = written(
        labelled.select("text", "label").mapInArrow(_counts, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "terms",
    )
    total = counted.where("term = ''").first()
    toxic, clean = (total["toxic"], total["clean"]) if total else (0, 0)
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    base = (toxic + 0.5) / (toxic + clean + 1.0) if toxic + clean else PRIOR
    n, share = t + c, t / (t + c)
    # lower end of the share's confidence interval (Wilson, 2 standard errors)
    lower = (share + 2 / n - 2 * F.sqrt(share * (1 - share) / n + 1 / (n * n))) / (1 + 4 / n)
    gain = t * F.log(share / F.lit(base)) + F.when(c > 0, c * F.log((1 - share) / F.lit(1 - base))).otherwise(0)
    chosen = (
        counted.where((F.col("term") != "") & (t >= 3) & (lower > min(0.5, 4 * base)))
        .orderBy(gain.desc(), "term").limit(LEXICON).collect()
    )
    lexicon = {r["term"]: len(PATTERNS) + i for i, r in enumerate(chosen)}
    rates = np.concatenate([np.array(list(PATTERNS.values())), np.zeros((len(chosen), 2))])
    for i, r in enumerate(chosen):
        rates[len(PATTERNS) + i] = (r["toxic"] + 0.5) / (toxic + 1), (r["clean"] + 0.5) / (clean + 1)
    return Voters(lexicon, rates, base, toxic + clean)


def votes_of(text: str | None, lexicon: dict[str, int]) -> list[int]:
    """The voters that call a text toxic, in order; an empty text has the pattern of short texts."""
    text = text or ""
    words, stems = terms_of(text)
    found = [lexicon[w] for w in words if w in lexicon] + [lexicon[s] for s in stems if s in lexicon]
    return sorted(pattern_votes(text, words) + found)


def _voted(lexicon: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            votes = [votes_of(t, lexicon) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("label"), pa.array(votes, pa.list_(pa.int32()))],
                ["doc_id", "key", "label", "votes"],
            )

    return run


def _evidence(rates: np.ndarray, overlap: np.ndarray) -> tuple[np.ndarray, float]:
    """Log-odds of a vote beyond an abstention, shared among correlated voters, and those of silence."""
    fired = np.log(rates[:, 0] / rates[:, 1])
    silent = np.log((1 - rates[:, 0]) / (1 - rates[:, 1]))
    return (fired - silent) / overlap, float((silent / overlap).sum())


def _matrix(votes: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(votes), width), np.float32)
    for i, own in enumerate(votes):
        out[i, own] = 1
    return out


def _posterior(x: np.ndarray, label: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    p = 1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30)))
    return np.where(label < 0, p, label)


def _expected(weights: np.ndarray, bias: float):
    """Vote patterns -> (i, toxic, clean): how often voter i and each other one fire together, expected.

    One row a voter and task, the other voters in its arrays; i = -1 counts documents.
    """
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, docs = np.zeros((2, width, width)), np.zeros((2, 1, width))
        for batch in batches:
            label = np.array([-1 if v is None else v for v in batch.column("label").to_pylist()], float)
            x = _matrix(batch.column("votes").to_pylist(), width)
            n = batch.column("n").to_numpy().astype(float)
            p = _posterior(x, label, weights, bias)
            for k, w in enumerate((p * n, (1 - p) * n)):
                docs[k] += w.sum()
                sums[k] += x.T @ (x * w[:, None])
        fired = np.flatnonzero(sums.sum(axis=(0, 2)))
        rows = np.concatenate([docs, sums[:, fired]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *fired.tolist()], pa.int32()), *(pa.array([r.tobytes() for r in side], pa.binary()) for side in rows)],
            ["i", "toxic", "clean"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    """One voter's rows from all tasks, summed."""
    sums = [np.sum([np.frombuffer(d) for d in table[n].to_pylist()], axis=0).tobytes() for n in ("toxic", "clean")]
    return pa.table({"i": table["i"][:1], "toxic": pa.array(sums[:1], pa.binary()), "clean": pa.array(sums[1:], pa.binary())})


def _summed(patterns: DataFrame, weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """The expected counts over all patterns: documents (2,), and pairs of voters (2, V, V)."""
    schema, width = "i int, toxic binary, clean binary", len(weights)
    rows = patterns.mapInArrow(_expected(weights, bias), schema).groupBy("i").applyInArrow(_added, schema).collect()
    docs, sums = np.zeros(2), np.zeros((2, width, width))
    for r in rows:
        both = [np.frombuffer(r["toxic"]), np.frombuffer(r["clean"])]
        if r["i"] < 0:
            docs[:] = both[0][0], both[1][0]
        else:
            sums[:, r["i"]] = both
    return docs, sums


def _binned(weights: np.ndarray, bias: float):
    """Labelled vote patterns -> (bin, toxic, clean): documents by their log-odds, in steps of ``STEP``."""
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _matrix(batch.column("votes").to_pylist(), width) @ weights + bias
            toxic, n = batch.column("label").to_numpy(zero_copy_only=False), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.rint(np.clip(z, -30, 30) / STEP).astype(np.int32)), pa.array(np.where(toxic > 0, n, 0)), pa.array(np.where(toxic > 0, 0, n))],
                ["bin", "toxic", "clean"],
            )

    return run


def _calibrated(patterns: DataFrame, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """The same evidence, stretched and moved so that its log-odds fit the labels (Platt scaling).

    Voters that share one cause are discounted by their correlation, which keeps their order but
    not their scale. What comes back is a row per step of the log-odds at most, whatever the number of documents.
    """
    labelled = patterns.where("label is not null").mapInArrow(_binned(weights, bias), "bin int, toxic long, clean long")
    rows = labelled.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()
    x = np.array([(r["bin"] * STEP, 1.0) for r in rows]).reshape(-1, 2)
    toxic, clean = (np.array([r[n] for r in rows], float) for n in ("toxic", "clean"))
    if not toxic.sum() or not clean.sum():
        return weights, bias
    # targets short of 0 and 1 keep the scale finite where the classes don't overlap
    target = toxic * (toxic.sum() + 1) / (toxic.sum() + 2) + clean / (clean.sum() + 2)
    line, n = np.array([1.0, 0.0]), toxic + clean
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (n * p - target))
        line = line - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    if line[0] <= 0:
        return weights, bias
    return line[0] * weights, float(line[0] * bias + line[1])


def label_model(patterns: DataFrame, voters: Voters) -> tuple[np.ndarray, float]:
    """Evidence of each voter and the bias, by EM over the vote patterns (``votes, label, n``) of all documents.

    Equal patterns are one row, so a round reads a small table; what comes
    back is one number a voter, or pair of voters, whatever the number of documents.
    """
    rates, prior, overlap = voters.rates, voters.prior, np.ones(len(voters.rates))

    def evidence() -> tuple[np.ndarray, float]:
        weights, silence = _evidence(rates, overlap)
        bias = float(np.log(prior / (1 - prior))) + silence
        return _calibrated(patterns, weights, bias) if voters.labelled else (weights, bias)

    # without a label, EM would find some two classes, not these two
    for _ in range(ROUNDS if voters.labelled else 0):
        docs, sums = _summed(patterns, *evidence())
        fired = np.stack([np.diag(s) for s in sums])
        rates = ((fired + 0.5) / (docs[:, None] + 1)).T
        prior = float((docs[0] + 0.5) / (docs.sum() + 1))
        # correlation within the classes, pooled
        joint = sum(s / max(d, 1) * d for s, d in zip(sums, docs, strict=True)) / max(docs.sum(), 1)
        alone = sum(np.outer(f, f) / max(d, 1) for f, d in zip(fired, docs, strict=True)) / max(docs.sum(), 1)
        cov = joint - alone
        spread = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        corr = np.clip(cov / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(corr, 0)
        corr[corr < 0.05] = 0
        overlap = 1 + corr.sum(axis=1)
    return evidence()


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the votes of all documents (``doc_id, key, label, votes``); ``key`` is the text's hash."""
    voters = induce(docs, labels)
    marked = _labelled(docs.select("doc_id", "text"), labels).select("doc_id", F.xxhash64("text").alias("key"), "text", "label")
    kind = docs.schema["doc_id"].dataType.simpleString()
    votes = written(marked.mapInArrow(_voted(voters.lexicon), f"doc_id {kind}, key long, label int, votes array<int>"), "votes")
    patterns = written(votes.groupBy("votes", "label").agg(F.count("*").alias("n")), "patterns")
    weights, bias = label_model(patterns, voters)
    if voters.labelled:
        return Model(voters, *_logistic(patterns, weights, bias)), votes
    return Model(voters, weights, bias), votes


def _slopes(w: np.ndarray, weights: np.ndarray, bias: float):
    """Vote patterns -> (i, toxic, clean): a row of the loss's curvature at ``w`` and the slope, weighted by documents."""
    width = len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curve, slope = np.zeros((width, width)), np.zeros((width, 1))
        for batch in batches:
            label = np.array([-1 if v is None else v for v in batch.column("label").to_pylist()], float)
            x = np.ones((batch.num_rows, width))
            x[:, :-1] = _matrix(batch.column("votes").to_pylist(), width - 1)
            n = batch.column("n").to_numpy().astype(float)
            target = _posterior(x[:, :-1], label, weights, bias)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve += x.T @ (x * (n * p * (1 - p))[:, None])
            slope[:, 0] += x.T @ (n * (p - target))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), *(pa.array([r.tobytes() for r in side], pa.binary()) for side in (curve, slope))],
            ["i", "toxic", "clean"],
        )

    return run


def _logistic(patterns: DataFrame, weights: np.ndarray, bias: float, ridge: float = 1.0, rounds: int = 25):
    """Logistic regression on the posteriors of all patterns by Newton steps, drawn towards half the label model's evidence.

    Slope and curvature are summed on Spark: as many numbers as pairs of voters, whatever the number of documents.
    """
    schema, start = "i int, toxic binary, clean binary", np.append(np.clip(weights, -3, 3) / 2, min(bias, 0.0))
    w, penalty = start.copy(), np.append(np.full(len(weights), ridge), 1e-3)
    for _ in range(rounds):
        curve, slope = np.diag(penalty), penalty * (w - start)
        for r in patterns.mapInArrow(_slopes(w, weights, bias), schema).groupBy("i").applyInArrow(_added, schema).collect():
            curve[r["i"]] += np.frombuffer(r["toxic"])
            slope[r["i"]] += np.frombuffer(r["clean"])[0]
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _score(votes: list[list[int]], weights: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.array([weights[v].sum() + bias for v in votes], float).clip(-30, 30)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels of documents whose ``crc32`` of the id leaves no remainder by 5 are
    never read. Null and empty texts are scored by their pattern alone; null
    ids are scored and never learned from; repeated rows get equal scores; a
    document with two labels counts as toxic if one says so; without any usable
    label the pattern voters decide at their first rates; an empty table gives no rows;
    other columns are not read. The classifier is fit on all documents, the lexicon on a
    bounded sample of labelled rows (``LABELLED``).
    """
    model, votes = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _score(batch.column("votes").to_pylist(), model.weights, model.bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = votes.select("doc_id", "votes").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")


def clean_documents(docs: DataFrame, labels: DataFrame, reject: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more; all columns stay.

    The votes of the fit are scored, no text is read a second time by Python. Rejected
    are ids with the hash of their text (equal ids and texts have equal scores); their list is
    measured, and broadcast only within the bounds of ``lookup_join``.
    """
    model, votes = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _score(batch.column("votes").to_pylist(), model.weights, model.bias)
            yield batch.select(["doc_id", "key"]).filter(pa.array(score >= reject))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rejected = votes.select("doc_id", "key", "votes").mapInArrow(run, f"doc_id {kind}, key long")
    rejected = rejected.groupBy("doc_id", "key").agg(F.count("*").alias("times"))
    # the row itself stays whole in one column: its names cannot clash with the keys
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("key"))
    told = lookup_join(rows, rejected, ["doc_id", "key"], weight="times")
    return told.where("times is null").select("row.*")
