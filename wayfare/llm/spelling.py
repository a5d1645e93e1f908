"""Spelling variants by a variable-length gram index.

Words stand between two marks and are decomposed into grams of 2 to ``LONGEST``
characters: at each place the longest gram of the dictionary, or two
characters where it has none, and no gram inside the one before it. The dictionary
is pruned by frequency: a gram is lengthened only where its own list would be
long, and longer grams stay only while they are frequent enough to be worth an
entry.

One edit affects few grams of a word: those that hold it, those before it whose
look-up reads on into it, and those after it that a gram across the edit could
swallow. All others are grams of the edited word too, and the edited word
leaves the same ones, so two words one edit apart agree, for that edit, in all
unaffected grams. The index therefore lists each word once under every
such set of grams, instead of once under each gram: merging the lists
of a word and counting up to its bound is one equality. Where an edit affects all
grams of a word, the list is named by the word without the edited character. What stands in one list is
verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.cluster import written
from wayfare.llm.common import sliced

#: shortest word that counts, and how often it must occur
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: a run whose hash this divides loses a character
SLIPS = 97
#: longest gram; a gram in more than this share of the words is lengthened; entries of the dictionary
LONGEST, FREQUENT, DICTIONARY = 4, 0.02, 20_000
#: a form occurs at least so many times as often as its variant
DOMINANCE = 2
#: distinct words or grams a task holds before it sends what it counted
HELD = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: marks of a word's beginning and end, outside the characters of runs
_FIRST, _LAST = "^", "$"


def slipped(doc_id, run: str) -> str:
    """The run as it counts: without one character where the hash of id and run asks for it."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % SLIPS else run[: h % len(run)] + run[h % len(run) + 1 :]


def _sent(counter: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())], [name, "n"]
    )


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> (word, n) of the task."""
    total: Counter = Counter()
    for batch in sliced(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text:
                for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                    word = slipped(doc_id, run) if len(run) >= LEAST_LENGTH else run
                    if len(word) >= LEAST_LENGTH:
                        total[word] += n
        if len(total) > HELD:
            yield _sent(total, "word")
            total.clear()
    yield _sent(total, "word")


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of ``docs`` and their occurrences, counted in the tasks before the shuffle."""
    counted = docs.select("doc_id", "text").mapInArrow(_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- the dictionary -----------------------------------------------------------------------


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in sliced(batches, 4096):
        for word in batch.column("word").to_pylist():
            marked = _FIRST + word + _LAST
            total.update(marked[p : p + q] for q in range(2, LONGEST + 1) for p in range(len(marked) - q + 1))
        if len(total) > HELD:
            yield _sent(total, "gram")
            total.clear()
    yield _sent(total, "gram")


def pruned(frequency: dict[str, int], words: int, least: int) -> set[str]:
    """Grams of three characters and more whose shorter forms all stand in too many words."""
    kept: set[str] = set()
    for gram in sorted(frequency, key=len):
        shorter = gram[:-1]
        if len(gram) > 2 and frequency[gram] >= least and frequency.get(shorter, 0) > FREQUENT * words:
            if len(gram) == 3 or shorter in kept:
                kept.add(gram)
    return kept


def gram_dictionary(words: DataFrame) -> set[str]:
    """The dictionary of a vocabulary, at most ``DICTIONARY`` grams however large that is.

    Of the occurrences of grams above two characters no more than ``DICTIONARY``
    grams can have their share of ``1 / DICTIONARY`` each, so that share is
    the least frequency. A dictionary decides what lists hold, not which words are found.
    """
    counts = written(
        words.select("word").mapInArrow(_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams"
    )
    size, total = words.count(), counts.where("length(gram) > 2").agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-total // DICTIONARY))
    bound = F.when(F.length("gram") > 2, F.lit(least)).otherwise(FREQUENT * size)
    return pruned({r.gram: r.n for r in counts.where(F.col("n") >= bound).collect()}, size, least)


# --- decomposition and lists -----------------------------------------------------------------------


class Grams:
    """A dictionary with the beginnings and ends of its grams."""

    def __init__(self, dictionary: Iterable[str]):
        self.known = set(dictionary)
        self.longest = max([2, *map(len, self.known)])
        self.beginnings = {g[:k] for g in self.known for k in range(2, len(g))}
        self.ends = {g[-k:] for g in self.known for k in range(2, len(g))}

    def decomposed(self, marked: str) -> list[tuple[int, int]]:
        """Spans of the grams of a marked word."""
        out, reach, size = [], 0, len(marked)
        for p in range(size - 1):
            end = p + 2
            for e in range(min(size, p + self.longest), end, -1):
                if marked[p:e] in self.known:
                    end = e
                    break
            if end > reach:
                out.append((p, end))
                reach = end
        return out

    def unaffected(self, marked: str, spans: list[tuple[int, int]], start: int, after: int) -> tuple[int, int]:
        """What an edit of ``marked[start:after]`` leaves: grams up to the first number and from the second.

        Before the edit a gram stays unless its look-up, or that of an earlier place
        that could swallow it, reads a beginning of some gram up to the edit; after
        it a gram stays unless it ends inside an end of some gram that begins at the edit. An
        insertion edits the empty span at its place.
        """
        first, last, size = start, after, len(marked)
        for k in range(2, self.longest):
            if start >= k and marked[start - k : start] in self.beginnings:
                first = start - k
            if after + k <= size and marked[after : after + k] in self.ends:
                last = after + k
        left, right = 0, size
        for p, e in spans:
            if e <= start and p < first:
                left = e
            elif p >= after and e > last:
                right = p
                break
        return left, right

    def lists(self, word: str) -> set[str]:
        """Names of the lists of a word: for every edit what it leaves of the grams."""
        marked = _FIRST + word + _LAST
        spans, names = self.decomposed(marked), set()
        for start in range(1, len(marked)):
            for after in (start, start + 1):
                if after == len(marked):
                    continue
                left, right = self.unaffected(marked, spans, start, after)
                if left or right < len(marked):
                    names.add(f"{marked[:left]} {marked[right:]}")
                else:
                    names.add(marked[:start] + marked[after:])
        return names


def _listed(dictionary: set[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(dictionary)
        for batch in sliced(batches, 2048):
            words = batch.column("word").to_pylist()
            lists = [sorted(grams.lists(w)) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name for own in lists for name in own], pa.string()),
                    pa.array([w for w, own in zip(words, lists, strict=True) for _ in own], pa.string()),
                ],
                ["list", "word"],
            )

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs ``a < b`` of distinct ``words(word)`` that one inserted, deleted or replaced character parts.

    Lists go by the hash of their name; what a clash brings together fails the
    verification, which is part of the join, so only links leave it.
    """
    dictionary = gram_dictionary(words)
    lists = words.select("word").mapInArrow(_listed(dictionary), "list string, word string")
    lists = written(lists.select(F.xxhash64("list").alias("list"), "word"), "lists")
    one = lists.select("list", F.col("word").alias("a"))
    two = lists.select("list", F.col("word").alias("b"))
    close = (F.col("a") < F.col("b")) & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return one.join(two, "list").where(close).select("a", "b").distinct()


# --- forms and roots --------------------------------------------------------------------------


def _best(n: Column, word: Column) -> Column:
    """Least for the most frequent word, then for the first in code-point order."""
    return F.struct((-n).alias("n"), word.alias("word"))


def _roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """``word, root``: pointers along ``forms(word, form)`` doubled until they rest.

    Each form occurs at least twice as often as its variant, so chains are short and have no loops.
    """
    up = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        up = moved.select("word", "root")
        if moved.where("next is not null").isEmpty():
            return up
    raise RuntimeError("chains of forms did not end")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Group the words of ``docs(doc_id, text)`` by spelling.

    Returns ``word, form, root, n, n_near, form_n``, one row per word of at least ``LEAST_LENGTH``
    characters and ``LEAST_COUNT`` occurrences. Near words are one inserted, deleted or replaced character apart;
    the form of a word is its most frequent near word, ties to the first in code-point order, if it
    occurs ``DOMINANCE`` times as often, else null; the root is the last form of the chain, or the
    word. Null and empty texts have no words; a null id counts as empty text; repeated
    rows count again; a table without words gives no rows; other columns are not read.
    """
    words = written(vocabulary(docs), "words")
    pairs = written(near_pairs(words), "pairs")
    one, two = words.select(F.col("word").alias("a"), F.col("n").alias("n_a")), words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    counted = pairs.join(one, "a").join(two, "b")
    links = counted.select(F.col("a").alias("word"), _best(F.col("n_b"), F.col("b")).alias("near")).unionByName(
        counted.select(F.col("b").alias("word"), _best(F.col("n_a"), F.col("a")).alias("near"))
    )
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    told = words.join(best, "word", "left")
    rules = -F.col("near.n") >= DOMINANCE * F.col("n")
    told = written(
        told.select(
            "word", F.when(rules, F.col("near.word")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(rules, -F.col("near.n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
