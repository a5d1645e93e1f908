"""Scoring texts with a causal self-attention model over subword ids.

Ids of a public vocabulary are sorted into classes by the company they keep. The
attention model predicts the class of the next id from the ids before it; the
id within its class follows from counts over the whole training corpus, given the
class before. A text is cut into overlapping windows of which each scores
its last tokens, so that every token is scored once and has context.

One scan writes every text as ids and counts words and pairs of neighbouring ids in the
training documents. Training runs on Spark: windows tile every training document, each
window is trained on once, in one of ``ROUNDS`` rounds; in a round each task trains on its
windows from the common weights, and the weights are averaged. A last step scores the texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm import attention as A
from wayfare.llm.common import sliced
from wayfare.llm.tokens import encoder, vocabulary

FOLDS, HELD_OUT = 7, 2
#: a vocabulary made for many languages: fewer ids a text
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: ids of the vocabulary, and the free one that ends a text and stands before its first word
IDS, END = 50257, 50256
CLASSES, INPUTS = 96, 2048
#: contexts that ids are clustered by, and pseudo-counts of the classes' own frequencies
CONTEXTS, PSEUDO = 96, 4.0
#: windows that travel together, windows a training task has about, rounds that share the training documents
RUN, PER_TASK, ROUNDS, RATE = 64, 16384, 3, 0.01
#: words whose counts every task knows (some 2 MB); the others' counts are joined
HEAD = 1 << 17
#: distinct words, and pairs, a task counts before it passes on what it has
KNOWN, PAIRS = 250_000, 1 << 22
#: bytes of texts that are cut into words together
BLOCK = 1 << 22
#: white space that a word may hold and that the pre-tokeniser may join with the next word's blank
_ODD = re.compile(r"[^\S ]")


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_hash(word: bytes) -> int:
    """A word's name in the counts, 64 bits: equal names of different words are as good as impossible."""
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


_ROWS = [
    pa.field("kind", pa.int32()), pa.field("held_out", pa.bool_()), pa.field("a", pa.int64()), pa.field("b", pa.int64()),
    pa.field("n", pa.int64()), pa.field("word", pa.binary()), pa.field("ids", pa.binary()),
]
_ROWS_SQL = "kind int, held_out boolean, a long, b long, n long, word binary, ids binary"
#: kinds of rows: texts as ids, counts of words, counts of pairs of ids
_TEXT, _WORD, _PAIR = range(3)


def _batch(kind: int, size: int, schema: pa.Schema, **columns) -> pa.RecordBatch:
    known = {"kind": np.full(size, kind, np.int32)} | columns
    return pa.RecordBatch.from_arrays(
        [pa.array(known[f.name], f.type) if f.name in known else pa.nulls(size, f.type) for f in schema], schema=schema
    )


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The bytes of each id, whether they begin with a blank, and how many blanks they hold."""
    pieces = encoder(path).pieces()
    pieces += [b""] * (IDS - len(pieces))
    return pa.array(pieces, pa.binary()), np.array([p[:1] == b" " for p in pieces]), np.array([p.count(b" ") for p in pieces])


def _blocks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of some ``limit`` in all: long texts go alone."""
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= limit or i + 1 == len(sizes):
            yield first, i + 1
            first, total = i + 1, 0


class _Words(dict):
    """A task's words, numbered as they come, with the ids of each and how often it came in training texts.

    The pre-tokeniser never joins a word with the blank after it, so the ids of a text are those of
    its words, and a word that comes often is encoded once. Texts with other white space are encoded whole.
    """

    def __init__(self, path: str):
        super().__init__()
        self._encode, self._starts = encoder(path).whole, _pieces(path)[1]
        self.forget()

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at

    def forget(self) -> None:
        self.clear()
        self.times, self._odd = np.zeros(0, np.int64), np.zeros(0, bool)
        self._ids, self._lows, self._sizes = (np.zeros(0, np.int64) for _ in range(3))

    def _learn(self) -> None:
        """The ids of the words that came since."""
        names = list(islice(self, len(self.times), None))
        if not names:
            return
        odd = np.zeros(len(names), bool)
        if _ODD.search(b" ".join(names).decode()):
            odd[:] = [bool(_ODD.search(n.decode())) for n in names]
        plain = [b"x" if o else n for n, o in zip(names, odd.tolist(), strict=True)]
        found = self._encode((b" " + b" ".join(plain)).decode()).astype(np.int64)
        lows = np.flatnonzero(self._starts[found])
        self._lows = np.append(self._lows, len(self._ids) + lows)
        self._sizes = np.append(self._sizes, np.diff(lows, append=len(found)))
        self._ids, self._odd = np.append(self._ids, found), np.append(self._odd, odd)
        self.times = np.append(self.times, np.zeros(len(names), np.int64))

    def ids_of(self, own: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts as words -> their ids one after the other, END after each text; how many each has; the words' numbers."""
        counts = np.array([len(w) for w in own], np.int64)
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(own)), np.int64, int(counts.sum()))
        self._learn()
        # one more word, the end, behind each text's
        ends = np.cumsum(counts)
        ended = np.insert(codes, ends, len(self))
        low, size, ids = np.append(self._lows, len(self._ids))[ended], np.append(self._sizes, 1)[ended], np.append(self._ids, END)
        after = np.cumsum(size)
        ids = ids[np.repeat(low - (after - size), size) + np.arange(after[-1])]
        lengths = np.diff(after[ends + np.arange(len(own))], prepend=0)
        if self._odd[codes].any():
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            for i, odd in enumerate(np.split(self._odd[codes], ends[:-1])):
                if odd.any():
                    parts[i] = np.append(self._encode((b" " + b" ".join(own[i])).decode()), END).astype(np.int64)
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, lengths, codes


def _gather(path: str):
    """Documents -> their ids (two bytes each), and the counts of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, words, pairs = None, _Words(path), []

        def counted() -> Iterator[pa.RecordBatch]:
            names = list(compress(words, words.times.tolist()))
            if names:
                yield _batch(_WORD, len(names), schema, word=names, a=[word_hash(w) for w in names], n=words.times[words.times > 0])
            words.forget()
            if pairs:
                codes, n = np.unique(np.concatenate(pairs), return_counts=True)
                yield _batch(_PAIR, len(codes), schema, a=codes // IDS, b=codes % IDS, n=n)
                pairs.clear()

        for batch in sliced(batches):
            schema = schema or pa.schema([batch.schema.field("doc_id"), *_ROWS])
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for first, last in _blocks([len(t or "") for t in texts], BLOCK):
                own = [words_of(t) for t in texts[first:last]]
                ids, lengths, codes = words.ids_of(own)
                held = np.array([held_out(d) for d in docs[first:last]])
                offsets = pa.py_buffer(np.append(0, np.cumsum(lengths) * 2).astype(np.int32))
                rows = pa.Array.from_buffers(pa.binary(), len(own), [None, offsets, pa.py_buffer(ids.astype("<u2"))])
                yield _batch(_TEXT, len(own), schema, doc_id=docs[first:last], held_out=held, ids=rows)
                # the first id of a text follows the end of the one before it
                both = np.append(END, ids[:-1]) * IDS + ids
                pairs.append(both[np.repeat(~held, lengths)])
                learnt = codes[np.repeat(~held, [len(w) for w in own])]
                words.times += np.bincount(learnt, minlength=len(words))
                if len(words) > KNOWN or sum(map(len, pairs)) > PAIRS:
                    yield from counted()
        yield from counted()

    return run


def classes_of(counts: np.ndarray, before: np.ndarray, after: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each id: frequent ids have their own, others share one with ids of similar neighbours.

    ``before`` and ``after`` (ids, contexts) count the frequent ids next to each
    id. Ids never seen share the last class.
    """
    order = np.argsort(-counts, kind="stable")
    alone = classes // 2
    out = np.full(len(counts), classes - 1)
    out[order[:alone]] = np.arange(alone)
    rest = order[alone:][counts[order[alone:]] > 0]
    groups = classes - alone - 1
    if len(rest):
        x = np.concatenate([before[rest], after[rest]], axis=1, dtype=float)
        x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
        np.sqrt(x, out=x)
        centres, weight = x[:groups].copy(), counts[rest].astype(float)
        for _ in range(12):
            own = (x @ centres.T).argmax(axis=1)
            for k in np.unique(own):
                centre = (x[own == k] * weight[own == k, None]).sum(axis=0)
                centres[k] = centre / max(np.linalg.norm(centre), 1e-12)
        out[rest] = alone + own
    return out


class Model:
    """What scoring needs: classes, weights, the counts between and within classes, the frequent words."""

    def __init__(self, classes, inputs, weights, follow, within, head, ends, total, distinct):
        self.classes, self.inputs, self.weights, self.follow, self.within = classes, inputs, weights, follow, within
        self.head, self.ends, self.total, self.distinct = head, ends, total, distinct

    def _windows(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        before = self.classes[x[:, A.CONTEXT :]]
        by_class = A.log_probabilities(self.weights, self.follow, self.inputs[x], before, self.classes[y])
        return by_class + self.within[before, y]

    def log_probability(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each text's ids, of which the last is END.

        A window's last WINDOW - CONTEXT tokens are scored; the windows of short texts
        are computed together, long texts in pieces, so memory stays small.
        """
        scored, sums = A.WINDOW - A.CONTEXT, np.zeros(len(texts))
        held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> None:
            out = self._windows(np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            out[~np.concatenate([h[3] for h in held])] = 0
            rows, first = out.sum(axis=1, dtype=np.float64), 0
            for i, x, _, _ in held:
                sums[i] += rows[first : first + len(x)].sum()
                first += len(x)
            held.clear()

        offsets = np.arange(A.WINDOW)
        for i, ids in enumerate(texts):
            count = -(-len(ids) // scored)
            padded = np.full(count * scored, END, np.int32)
            padded[: len(ids)] = ids
            led = np.concatenate([np.full(A.CONTEXT + 1, END, np.int32), padded])
            real = (np.arange(count * scored) < len(ids)).reshape(count, scored)
            y = padded.reshape(count, scored)
            for at in range(0, count, 32):
                x = led[(np.arange(at, min(at + 32, count)) * scored)[:, None] + offsets]
                held.append((i, x, y[at : at + 32], real[at : at + 32]))
                waiting += len(x)
                if waiting >= 28:
                    flush()
                    waiting = 0
        if held:
            flush()
        return sums


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as ids -> runs of up to RUN windows, which tile each text; the id before it leads each run."""
    for batch in sliced(batches):
        rows, places, runs = [], [], []
        for i, ids in enumerate(batch.column("ids").to_pylist()):
            led = END.to_bytes(2, "little") + ids
            for at in range(0, len(ids), 2 * RUN * A.WINDOW):
                rows.append(i)
                places.append(at)
                runs.append(led[at : at + 2 * (RUN * A.WINDOW + 1)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(places, pa.int64()), pa.array(runs, pa.binary())],
            ["doc_id", "at", "ids"],
        )


def _tiles(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of runs: ids, the ids that follow them, and which of those are real."""
    x, y, real = [], [], []
    for run in runs:
        ids = np.frombuffer(run, "<u2")
        size = -(-(len(ids) - 1) // A.WINDOW) * A.WINDOW
        padded = np.full(size + 1, END)
        padded[: len(ids)] = ids
        x.append(padded[:-1].reshape(-1, A.WINDOW))
        y.append(padded[1:].reshape(-1, A.WINDOW))
        real.append((np.arange(size) < len(ids) - 1).reshape(-1, A.WINDOW))
    return np.concatenate(x), np.concatenate(y), np.concatenate(real)


def _train_task(weights: dict, follow: np.ndarray, inputs: np.ndarray, classes: np.ndarray, turn: int):
    """One task's windows -> its weights after one pass, with the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in an order that does not depend on the shuffle
        rows = sorted(d for b in batches for d in b.column("ids").to_pylist())
        if not rows:
            return
        x, y, real = _tiles(rows)
        y = classes[y]
        new = A.train(weights, follow, inputs[x], classes[x], y, real, RATE * (1 - turn / ROUNDS), turn)
        flat = np.concatenate([new[n].ravel() for n in sorted(new)]).astype(np.float64) * len(x)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([len(x)], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["part", "n", "data"]
        )

    return run


def _add(table: pa.Table) -> pa.Table:
    """The sum of several tasks' weights."""
    total = sum(np.frombuffer(d, np.float64) for d in table["data"].to_pylist())
    return pa.table({"part": [table["part"][0].as_py() // 32], "n": [sum(table["n"].to_pylist())], "data": pa.array([total.tobytes()], pa.binary())})


def _trained(texts: DataFrame, weights: dict, follow: np.ndarray, inputs: np.ndarray, classes: np.ndarray) -> dict:
    """Rounds of local training and averaging; sums of 32 tasks meet in one group, then 32 of those.

    Each training text (``doc_id, ids``) is in one round, and all of its windows are trained on.
    """
    kind, turns = texts.schema["doc_id"].dataType.simpleString(), F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))
    windows = F.sum(F.ceil(F.length("ids") / (2 * A.WINDOW))).alias("n")
    counts = {r["turn"]: r["n"] for r in texts.groupBy(turns.alias("turn")).agg(windows).collect()}
    for turn in range(ROUNDS):
        if not counts.get(turn):
            continue
        tasks = -(-counts[turn] // PER_TASK)
        runs = texts.where(turns == turn).mapInArrow(_runs, f"doc_id {kind}, at long, ids binary")
        dealt = runs.repartition(tasks, F.xxhash64("doc_id", "at", "ids")).select("ids")
        sums = dealt.mapInArrow(_train_task(weights, follow, inputs, classes, turn), "part long, n long, data binary")
        left = max(tasks, 33)  # once at least: Spark may deal more tasks than asked for
        while left > 32:
            sums = sums.groupBy(F.floor(F.col("part") / 32)).applyInArrow(_add, "part long, n long, data binary")
            left = -(-left // 32)
        rows = sums.collect()
        mean = sum(np.frombuffer(r["data"], np.float64) for r in rows) / max(1, sum(r["n"] for r in rows))
        at, weights = 0, dict(weights)
        for name in sorted(weights):
            size = weights[name].size
            weights[name] = mean[at : at + size].reshape(weights[name].shape).astype(np.float32)
            at += size
    return weights


def fit(docs: DataFrame, path: str) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the training documents, the counts ``a, n`` of their words, and all texts as ids."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    gathered = written(docs.select("doc_id", "text").mapInArrow(_gather(path), f"doc_id {kind}, {_ROWS_SQL}"), "gathered")
    words = gathered.where(F.col("kind") == _WORD).groupBy("a")
    words = written(words.agg(F.sum("n").alias("n"), F.min("word").alias("word")), "words")
    pairs = gathered.where(F.col("kind") == _PAIR).groupBy("a", "b").agg(F.sum("n").alias("n"))
    pairs = written(pairs, "pairs")
    size = words.agg(F.count("*").alias("distinct"), F.sum("n").alias("total")).first()
    # one row an id of the vocabulary at most
    counts = np.zeros(IDS, np.int64)
    for r in pairs.groupBy("b").agg(F.sum("n").alias("n")).collect():
        counts[r["b"]] = r["n"]
    ends = int(counts[END])
    frequent = np.argsort(-counts, kind="stable")[:CONTEXTS]
    place = np.full(IDS, -1)
    place[frequent] = np.arange(CONTEXTS)
    near = spark.createDataFrame([(int(i),) for i in frequent], "f long")
    neighbours = []
    for own, other in (("b", "a"), ("a", "b")):
        side = np.zeros((IDS, CONTEXTS), np.float32)
        for r in pairs.join(F.broadcast(near), F.col(other) == F.col("f"), "left_semi").toLocalIterator():
            side[r[own], place[r[other]]] = r["n"]
        neighbours.append(side)
    classes = classes_of(counts, *neighbours)
    shares = np.bincount(classes, weights=counts + 1.0, minlength=CLASSES) + 1e-9
    own = (counts + 1) / shares[classes]
    # ids given the class before: at most classes x ids numbers
    named = F.broadcast(spark.createDataFrame(list(zip(range(IDS), classes.tolist(), strict=True)), "a long, before int"))
    after = np.zeros((CLASSES, IDS), np.float32)
    for r in pairs.join(named, "a").groupBy("before", "b").agg(F.sum("n").alias("n")).toLocalIterator():
        after[r["before"], r["b"]] = r["n"]
    totals = np.zeros((CLASSES, CLASSES))
    np.add.at(totals.T, classes, after.T)
    within = np.log((after + PSEUDO * own) / (totals[:, classes] + PSEUDO)).astype(np.float32)
    smooth = totals + PSEUDO * shares / shares.sum()
    follow = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    # frequent ids have an input of their own, others their class's
    inputs = classes.copy()
    inputs[np.argsort(-counts, kind="stable")[:INPUTS]] = CLASSES + np.arange(INPUTS)
    start = A.initial(CLASSES + INPUTS, CLASSES)
    learnt = gathered.where((F.col("kind") == _TEXT) & ~F.col("held_out")).select("doc_id", "ids")
    weights = _trained(learnt, start, follow, inputs, classes)
    top = words.orderBy(F.col("n").desc(), "a").limit(HEAD).select("word", "n").collect()
    head = {bytes(r["word"]): float(np.log10(r["n"] + 1)) for r in top}
    total, distinct = (size["total"] or 0) + ends, size["distinct"] + (ends > 0)
    model = Model(classes, inputs, weights, follow, within, head, ends, total, distinct)
    return model, words, gathered.where(F.col("kind") == _TEXT).select("doc_id", "held_out", "ids")


_SCORED = [
    ("rid", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
    ("score", pa.float64()), ("word", pa.int64()),
]
_SCORED_SQL = "rid long, held_out boolean, n_tokens long, known long, base double, score double, word long"


def _score(path: str, shared):
    """Texts as ids -> a scored row each, and rows (rid, word) for words whose count the task doesn't know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (pieces, _, blanks) = shared.value, _pieces(path)
        ends = float(np.log10(model.ends + 1.0))
        rid = TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            schema = pa.schema([batch.schema.field("doc_id"), *_SCORED])
            texts = [np.frombuffer(d, "<u2") for d in batch.column("ids").to_pylist()]
            score = model.log_probability(texts) / np.log(10)
            n, known, base, rids, names = [], [], [], [], []
            for first, last in _blocks([2 * len(t) for t in texts], BLOCK):
                own = texts[first:last]
                ids = np.concatenate(own)
                # a blank stands before each word and nowhere else
                counts = np.add.reduceat(blanks[ids], np.cumsum([0, *map(len, own[:-1])]))
                # the bytes of an Arrow column lie one behind the other
                _, ends_at, text = pieces.take(pa.array(ids)).buffers()
                words = text.slice(0, int(np.frombuffer(ends_at, np.int32)[len(ids)])).to_pybytes().split()
                logs = np.array(list(map(model.head.get, words)), float)  # None becomes nan
                rest, row = np.isnan(logs), np.repeat(np.arange(len(own)), counts)
                missing = np.bincount(row[rest], minlength=len(own))
                n.append(counts + 1)
                known.append(counts - missing + (model.ends > 0))
                base.append(np.bincount(row, weights=np.where(rest, 0, logs), minlength=len(own)) + ends)
                names.append(np.array([word_hash(words[i]) for i in np.flatnonzero(rest).tolist()], np.int64))
                rids.append(rid + first + row[rest])
            size = len(texts)
            columns = {"rid": np.arange(rid, rid + size), "n_tokens": np.concatenate(n), "known": np.concatenate(known), "base": np.concatenate(base), "score": score}
            full = [batch.column(f.name) if f.name in ("doc_id", "held_out") else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(full, schema=schema)
            rid += size
            tail = {"rid": np.concatenate(rids), "word": np.concatenate(names)}
            rows = len(tail["rid"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(tail[f.name], f.type) if f.name in tail else pa.nulls(rows, f.type) for f in schema], schema=schema
            )

    return run


def score_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: its log10-probability under the model and under word counts.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. The model learns from documents that are not held out; held-out ones are only scored. A
    null or blank text is the end token alone; a null id counts as empty text when
    folds are drawn; repeated rows are scored each; without training documents
    the scores are those of a model that has seen nothing; an empty table gives no rows;
    other columns are not read. Every window of a text of any length is scored.
    """
    path = path or vocabulary(VOCABULARY)
    plain = docs.select("doc_id", "text")
    model, words, texts = fit(plain, path)
    kind = plain.schema["doc_id"].dataType.simpleString()
    shared = plain.sparkSession.sparkContext.broadcast(model)
    out = written(texts.mapInArrow(_score(path, shared), f"doc_id {kind}, {_SCORED_SQL}"), "scored")
    tail = out.where("word is not null").groupBy("rid", F.col("word").alias("a")).agg(F.count("*").alias("times"))
    counted = (
        tail.join(words.select("a", "n"), "a").groupBy("rid")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("seen"))
    )
    scored = out.where("word is null").join(counted, "rid", "left")
    per_token = float(np.log10(model.total + model.distinct + 1.0))
    return scored.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        "score",
    )
