"""Secret scans by a randomness test battery, in DataFrame functions alone.

Three patterns give the base spans. The battery adds what no pattern names: long
unbroken runs of key characters that mix classes, read in the encoding their
characters allow (hex, base 32, base 36, base 64). Each is tested for

* uniform use of the encoding's alphabet (chi-squared, upper tail),
* runs: how often neighbours change between the halves of the alphabet,
* serial correlation of neighbouring symbol values.

A run that any of the three rejects, at ``ALPHA`` shared by the three, is structured and
goes. Of the rest, ordinary names and numbers must not pass for random ones however
many there are: each run has the likelihood ratio of the uniform alphabet
against the symbols of the corpus' own text, the lesser of a run mostly of digits and a
run mostly of others. That is an e-value which grows with the length, and Benjamini-Hochberg
for e-values keeps the expected share of ordinary runs among the reported ones below
``Q`` in every class of encoding and length, whatever the dependence between runs.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.cluster import written

#: letters of the keywords in either case; the value is group 2
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: a run shorter than the bound fails as a whole, so the bound can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
#: shortest run that is tested, and the run itself
LEAST_RUN = 20
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST_RUN},}}"
KINDS = ["assign", "access", "hex", "random"]
#: level of the battery, and the share of ordinary runs allowed among the reported
ALPHA, Q = 0.001, 0.01
#: shares of digits in the two sorts of ordinary runs
DIGIT_SHARES = (0.1, 0.9)
#: e-values are rounded down to this fraction of a natural logarithm; above the last step they are equal
STEPS, LAST_STEP = 4, 2000

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Encoding(NamedTuple):
    name: str
    alphabet: str
    #: what its runs look like
    pattern: str


ENCODINGS = [
    Encoding("hex", _DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[A-Fa-f])(?:[0-9a-f]+|[0-9A-F]+)$"),
    Encoding("base32", _UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    Encoding("base36", _DIGITS + _LOWER, r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-z]+|[0-9A-Z]+)$"),
    Encoding("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^(?:(?=.*[0-9])(?=.*[A-Za-z])|(?=.*[a-z])(?=.*[A-Z]))"),
]


def _literal(values: list) -> Column:
    """An array of numbers or texts as one literal."""
    return F.expr(f"array({', '.join(repr(v) for v in values)})")


# --- spans --------------------------------------------------------------------------------


def running_sums(lengths: Column, block: int = 256) -> Column:
    """Inclusive running sums of an array; blocks keep the work of long arrays small."""
    zero, none = F.lit(0), F.array().cast("array<int>")
    add = lambda state, n: F.struct(
        (state["at"] + n).alias("at"), F.concat(state["sums"], F.array(state["at"] + n)).alias("sums")
    )
    summed = lambda array, start: F.aggregate(array, F.struct(start.alias("at"), none.alias("sums")), add)["sums"]
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")),
        lambda b: F.slice(lengths, b * block + 1, block),
    )
    ends = summed(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, n: a + n)), zero)
    inside = F.transform(F.arrays_zip(blocks.alias("b"), ends.alias("e")), lambda x: summed(
        x["b"], x["e"] - F.aggregate(x["b"], zero, lambda a, n: a + n)))
    return F.when(F.size(lengths) > 0, F.flatten(inside)).otherwise(none)


def _matches(df: DataFrame, kind: str, pattern: str, group: int | None = None) -> DataFrame:
    """Add arrays of the leftmost non-overlapping matches: ``{kind}_hit``, ``{kind}_end`` and, with ``group``, ``{kind}_value``.

    What lies between the matches is the text split at the pattern, so the
    ends are the running sums of both lengths, in code points.
    """
    text, regex = F.col("_text"), F.lit(pattern)
    some = text.rlike(pattern)
    columns = {
        f"{kind}_hit": F.when(some, F.regexp_extract_all(text, regex, F.lit(0))),
        f"{kind}_gap": F.when(some, F.transform(F.split(text, pattern, -1), F.length)),
    }
    if group is not None:
        columns[f"{kind}_value"] = F.when(some, F.regexp_extract_all(text, regex, F.lit(group)))
    df = df.withColumns(columns)
    lengths = F.transform(f"{kind}_hit", lambda hit, i: F.length(hit) + F.get(F.col(f"{kind}_gap"), i))
    return df.withColumn(f"{kind}_end", running_sums(lengths)).drop(f"{kind}_gap")


def _spans(kind: str, keep=None) -> Column:
    """Spans ``(start, kind, end)`` of a kind's matches; ``keep`` judges a match by its place."""
    order = KINDS.index(kind)
    made = F.transform(f"{kind}_hit", lambda hit, i: F.struct(
        (F.get(F.col(f"{kind}_end"), i) - F.length(hit)).alias("start"), F.lit(order).alias("kind"),
        F.get(F.col(f"{kind}_end"), i).alias("end"), (F.lit(True) if keep is None else keep(i)).alias("kept")))
    made = F.transform(F.filter(made, lambda s: s["kept"]), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return F.coalesce(made, F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def _joined(spans: Column) -> Column:
    named = lambda s: F.concat_ws(":", F.get(_literal(KINDS), s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, named), ",")


# --- the battery ------------------------------------------------------------------------------


def upper_tail(z: Column) -> Column:
    """Probability that a standard normal exceeds ``z``."""
    # fixed values: rational approximation of the normal tail, error below 1e-7
    slope, terms = 0.2316419, [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]
    t = 1 / (1 + slope * F.abs(z))
    series = F.lit(0.0)
    for term in reversed(terms):
        series = (series + term) * t
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def chi_squared_p(counts: Column, n: Column, k: Column) -> Column:
    """Upper tail of the chi-squared statistic of uniform use, by the cube-root normal form."""
    squares = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c.cast("long") * c)
    statistic = squares * k.cast("double") / n - n
    spread = 2.0 / (9 * (k - 1))
    return upper_tail((F.pow(F.greatest(statistic, F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def neighbour_p(body: Column, alphabet: Column, k: Column) -> Column:
    """The lesser two-sided tail of the changes between alphabet halves and of the serial correlation.

    Under uniform symbols changes are binomial with one half, and products of centred
    neighbours have mean 0 and the square of the symbol variance as variance.
    """
    values = F.transform(F.split(body, ""), lambda c: F.position(c, alphabet) - (k + 1) / 2)
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("changes"), F.lit(0.0).alias("products"))
    state = F.aggregate(values, start, lambda s, v: F.struct(
        v.alias("last"),
        (s["changes"] + F.when(s["last"] * v < 0, 1.0).otherwise(0.0)).alias("changes"),
        (s["products"] + F.coalesce(s["last"] * v, F.lit(0.0))).alias("products")))
    steps = F.length(body) - 1
    changes = (state["changes"] - steps / 2) / F.sqrt(steps / 4)
    products = state["products"] / ((k * k - 1) / 12 * F.sqrt(steps))
    return 2 * upper_tail(F.greatest(F.abs(changes), F.abs(products)))


def symbol_counts(docs: DataFrame) -> dict[str, int]:
    """How often the corpus has each key character: one row."""
    symbols = _DIGITS + _LOWER + _UPPER + "+/-_"
    text = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    count = "sum(octet_length(text) - octet_length(replace(text, '{}', '')))"
    row = text.agg(*(F.expr(count.format(c)).alias(f"c{i}") for i, c in enumerate(symbols))).first()
    return {c: row[i] or 0 for i, c in enumerate(symbols)}


def ordinary_shares(counts: dict[str, int], encoding: Encoding, digit_share: float) -> list[float]:
    """How ordinary runs use the alphabet: digits as often as told, both sides as the corpus does."""
    folded = []
    for c in encoding.alphabet:
        same = {"+": "+-", "/": "/_"}.get(c, c if encoding.name == "base64" else c.lower() + c.upper())
        folded.append(1 + sum(counts[s] for s in set(same)))
    digits = sum(n for c, n in zip(encoding.alphabet, folded, strict=True) if c.isdigit())
    others = sum(folded) - digits
    return [
        n * (digit_share / digits if c.isdigit() else (1 - digit_share) / others)
        for c, n in zip(encoding.alphabet, folded, strict=True)
    ]


def judged_runs(counts: dict[str, int]) -> Column:
    """Each run with its place and what the battery says; runs of one class of characters are left out.

    The verdict is the encoding, the length class, the step of the e-value and the p-value of the battery.
    """
    ratios = lambda e, d: _literal([-math.log(len(e.alphabet) * p) for p in ordinary_shares(counts, e, d)])
    gains = [F.array(*(ratios(e, d) for e in ENCODINGS)) for d in DIGIT_SHARES]
    alphabets = _literal([e.alphabet for e in ENCODINGS])

    def read(run: Column, i: Column) -> Column:
        encoding, end = F.lit(None).cast("int"), F.get(F.col("random_end"), i)
        for index, e in reversed(list(enumerate(ENCODINGS))):
            encoding = F.when(run.rlike(e.pattern), index).otherwise(encoding)
        # hex and base 36 are written in either case, base 64 in two forms
        body = F.when(encoding % 2 == 0, F.lower(run)).otherwise(F.translate(run, "-_", "+/"))
        return F.struct((end - F.length(run)).alias("start"), end.alias("end"), encoding.alias("encoding"), body.alias("body"))

    def count(r: Column) -> Column:
        alphabet = F.get(alphabets, r["encoding"])
        used = F.transform(F.split(alphabet, ""), lambda c: F.length(r["body"]) - F.length(F.replace(r["body"], c, F.lit(""))))
        return F.struct(*(r[c].alias(c) for c in ("start", "end", "encoding", "body")), alphabet.alias("alphabet"), used.alias("used"))

    def judge(r: Column) -> Column:
        n, k = F.length(r["body"]), F.length(r["alphabet"])
        gained = [F.zip_with(r["used"], F.get(g, r["encoding"]), lambda c, x: c * x) for g in gains]
        evidence = F.least(*(F.aggregate(x, F.lit(0.0), lambda a, g: a + g) for x in gained))
        worst = F.least(chi_squared_p(r["used"], n, k), neighbour_p(r["body"], r["alphabet"], k))
        return F.struct(
            r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
            F.floor(2 * F.log2(n)).cast("int").alias("size"),
            F.least(F.floor(evidence * STEPS), F.lit(LAST_STEP)).cast("int").alias("step"),
            F.least(F.lit(1.0), 3 * worst).alias("p"),
        )

    known = F.filter(F.transform("random_hit", read), lambda r: r["encoding"].isNotNull())
    return F.coalesce(
        F.transform(F.transform(known, count), judge),
        F.array().cast("array<struct<start:int,end:int,encoding:int,size:int,step:int,p:double>>"),
    )


def thresholds(runs: DataFrame, q: float = Q) -> dict[tuple[int, int], int]:
    """The least step reported in each class ``(encoding, size)``; classes that report nothing are absent.

    Benjamini-Hochberg for e-values: the largest k whose k-th e-value is at
    least m / (q k), over counts of steps, whose number does not grow with the data.
    """
    steps = runs.groupBy("encoding", "size", "step").agg(F.count("*").alias("n"))
    down = Window.partitionBy("encoding", "size").orderBy(F.desc("step"))
    ranked = steps.withColumn("k", F.sum("n").over(down)).withColumn("m", F.sum("n").over(Window.partitionBy("encoding", "size")))
    passing = ranked.where(F.col("step") / STEPS >= F.log(F.col("m") / (q * F.col("k"))))
    return {(r.encoding, r.size): r.step for r in passing.groupBy("encoding", "size").agg(F.min("step").alias("step")).collect()}


def scan_secrets(docs: DataFrame, alpha: float = ALPHA, q: float = Q) -> DataFrame:
    """Find the secrets of ``docs(doc_id, text)``.

    Returns ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random``: one row per
    input row, repeated rows and null ids included. Spans are
    ``kind:start:end`` in code points, end exclusive, by start, then by kind as listed in ``KINDS``. A null
    text is empty and has none. A run inside a base span adds nothing. An empty
    table gives no rows; other columns are not read.

    One scan counts symbols, one finds and tests; its arrays are written, so
    the thresholds and the result read those and not the texts. No row is
    shuffled but the counts of steps.
    """
    counts = symbol_counts(docs)
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    found = _matches(found, "assign", ASSIGN, 2)
    for kind, pattern in (("access", ACCESS), ("hex", HEX), ("random", RUN)):
        found = _matches(found, kind, pattern)
    long_value = lambda i: F.length(F.get(F.col("assign_value"), i)) >= LEAST_VALUE
    held = written(
        found.select(
            "doc_id", _spans("assign", long_value).alias("assign"), _spans("access").alias("access"),
            _spans("hex").alias("hex"), judged_runs(counts).alias("runs"),
        ),
        "spans",
    )
    runs = held.select(F.explode("runs").alias("run")).select("run.*")
    least = thresholds(runs, q)
    step = F.lit(None).cast("int")
    if least:
        step = F.create_map(*(F.lit(x) for (e, s), x in sorted(least.items()) for x in (f"{e}/{s}", x)))
    bound = lambda r: step[F.concat_ws("/", r["encoding"], r["size"])] if least else step
    random = F.filter("runs", lambda r: (
        (r["p"] >= alpha) & (r["step"] >= bound(r))
        & ~F.exists("base", lambda s: (s["start"] <= r["start"]) & (s["end"] >= r["end"]))))
    random = F.transform(random, lambda r: F.struct(r["start"], F.lit(KINDS.index("random")).alias("kind"), r["end"]))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return (
        held.withColumn("base", base)
        .withColumn("random", random)
        .select(
            "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
            F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
            _joined(F.array_sort(F.concat("base", "random"))).alias("spans"),
            F.size("random").cast("long").alias("n_random"),
        )
    )
