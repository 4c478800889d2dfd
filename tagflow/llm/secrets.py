"""Secret scan in DataFrame functions alone: three fixed patterns, and two character Markov models.

Positions come from Java's regular expressions without a UDF: splitting at a pattern gives the
stretches between matches, extracting it gives the matches, and their running lengths give each
match's place. Running sums go in blocks of BLOCK matches, so that no step copies more than that
and a text full of matches costs hardly more than its length. The models are first-order over the
characters of ALPHABET, one of random strings (values that the fixed patterns found), one of
ordinary identifiers (long words elsewhere). Both are counted over all rows; the log-likelihood
ratios of all character pairs, a fixed number of values, are then looked up by position in a nested
array literal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import table, text_of

#: Fixed patterns: kind, pattern, cheap test that a text may have a match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MAY = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What the models judge: shorter runs give too few character pairs to tell the two kinds apart (see README).
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{12,}"
#: Mean log-likelihood ratio a character pair from which a candidate is reported.
RATIO = 1.0
PRIOR = 20.0
#: Share of the ordinary model's prior that is even over ALPHABET: what joins words is rare in prose, not in identifiers.
EVEN = 0.05
BLOCK = 256
SPANS = "array<struct<s:int,e:int,m:string>>"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column, pattern: str, use) -> Column:
    """array of use(gap, match) along the text; the last match is null."""
    return F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), use)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s,e,m>>: the leftmost non-overlapping matches; code points, end exclusive."""
    lens = F.filter(_pieces(text, pattern, lambda g, m: F.struct(F.char_length(g).alias("g"), F.char_length(m).alias("n"), m.alias("m"))), lambda x: x.m.isNotNull())
    none = F.array().cast(SPANS)
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda k: F.slice(v, k * BLOCK + 1, BLOCK))
    sums = lambda v: F.transform(v, lambda x: F.aggregate(x, F.lit(0), lambda acc, y: acc + y.g + y.n))
    add = lambda acc, n: F.struct((acc.at + n).alias("at"), F.array_append(acc.out, acc.at).alias("out"))
    starts = lambda v: F.aggregate(sums(v), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), add, lambda acc: acc.out)
    span = lambda acc, x: F.struct((acc.at + x.g).alias("s"), (acc.at + x.g + x.n).alias("e"), x.m.alias("m"))
    step = lambda acc, x: F.struct((acc.at + x.g + x.n).alias("at"), F.array_append(acc.out, span(acc, x)).alias("out"))
    place = lambda x, at: F.aggregate(x, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc.out)
    placed = let(lens, lambda v: F.when(F.size(v) == 0, none).otherwise(let(cut(v), lambda blocks: F.flatten(F.zip_with(blocks, starts(blocks), place)))))
    return placed


def _is_assign(m: Column) -> Column:
    return F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12


#: By kind: pattern, whether a text may have a match, whether a match counts.
BASE = {
    "assign": (ASSIGN, lambda t: t.rlike(ASSIGN_MAY), _is_assign),
    "access": (ACCESS, lambda t: t.contains("AKIA"), lambda m: F.lit(True)),
    "hex": (HEX, lambda t: t.rlike(HEX), lambda m: F.lit(True)),
}


def base_spans(text: Column) -> dict[str, Column]:
    """Spans by kind; an empty array where a text has none."""
    return {k: F.when(may(text), F.filter(matches(text, pattern), lambda x: good(x.m))).otherwise(F.array().cast(SPANS)) for k, (pattern, may, good) in BASE.items()}


def outside(text: Column, kind: str) -> Column:
    """The text with a kind's matches blanked, so that all else keeps its place."""
    pattern, may, good = BASE[kind]
    blank = lambda m: F.when(good(m), F.repeat(F.lit(" "), F.char_length(m))).otherwise(m)
    return F.when(may(text), F.array_join(_pieces(text, pattern, lambda g, m: F.concat(g, F.coalesce(blank(m), F.lit("")))), "")).otherwise(text)


def labelled_samples(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, random): values that the fixed patterns find, and long words without a long digit run.

    Of every row's whole text, null as empty, repeats counted each for itself; ids and further
    columns are not read, and an empty table gives none.
    """
    text, none = text_of(rows, text_col), F.array().cast("array<string>")
    values = F.when(text.rlike(ASSIGN_MAY), F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= 12)).otherwise(none)
    keys = F.when(text.contains("AKIA"), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0))).otherwise(none)
    words = F.filter(F.regexp_extract_all(text, F.lit(ORDINARY), F.lit(0)), lambda x: ~x.rlike("[0-9]{4}|AKIA|[0-9a-f]{16}"))
    told = lambda arr, random: F.transform(arr, lambda x: F.struct(x.alias("token"), F.lit(random).alias("random")))
    return rows.select(F.inline(F.concat(told(values, True), told(keys, True), told(words, False))))


def _pairs(token: Column, use) -> Column:
    """array of use(a, b) over the token's neighbouring characters."""
    chars = F.split(token, "")
    return let(F.filter(chars, lambda c: c != ""), lambda v: F.zip_with(F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 2, F.size(v)), use))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of ALPHABET characters, row by row; at most 67 x 67 values.

    ``samples`` are (token, random) rows. Pair counts are summed in the tasks first. A pair's rate
    is its count with PRIOR more of what the second character has alone: in the model of random
    strings each character alike, in the other as often as it comes. With no samples every ratio is 0.
    """
    pairs = samples.select("random", F.explode(_pairs(F.col("token"), lambda a, b: F.concat(a, b))).alias("pair"))
    n = len(ALPHABET)
    counts = {r: [[0.0] * n for _ in range(n)] for r in (False, True)}
    at = {c: k for k, c in enumerate(ALPHABET)}
    for r in pairs.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("random", "pair").count().collect():  # at most 2 x 67 x 67 rows
        counts[r["random"]][at[r["pair"][0]]][at[r["pair"][1]]] += r["count"]
    column = [sum(row[j] for row in counts[False]) + 0.5 for j in range(n)]
    alone = {True: [1 / n] * n, False: [(1 - EVEN) * c / sum(column) + EVEN / n for c in column]}
    rate = lambda r, i, j: math.log((counts[r][i][j] + PRIOR * alone[r][j]) / (sum(counts[r][i]) + PRIOR))
    return [rate(True, i, j) - rate(False, i, j) for i in range(n) for j in range(n)]


def ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of the token's character pairs, random against ordinary."""
    n = len(ALPHABET)
    values = F.array(*(F.array(*map(F.lit, table[k * n : (k + 1) * n])) for k in range(n)))
    places = F.array(*(F.lit(ALPHABET.find(chr(c))) for c in range(128)))
    at = lambda c: F.get(places, F.ascii(c))
    total = F.aggregate(_pairs(token, lambda a, b: F.get(F.get(values, at(a)), at(b))), F.lit(0.0), lambda acc, x: acc + x)
    return total / (F.char_length(token) - 1)


def scan(rows: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id and ``found``, array<struct<s,kind,e>> by start, then kind.

    ``kind`` is an index of KINDS. The models look at runs of 16 or more ALPHABET characters outside
    the fixed patterns' matches. Null and empty texts have no spans; very long ones are read whole.
    Rows with equal or null ids are scanned each for itself; equal starts go by kind; an empty table
    gives no rows; further columns, whatever their names, are not read.
    """
    own = rows.select(rows[id_col].alias("doc_id"), text_of(rows, text_col).alias("t"))
    base = base_spans(F.col("t"))
    tag = lambda arr, k: F.transform(arr, lambda x: F.struct(x.s.alias("s"), F.lit(k).alias("kind"), x.e.alias("e")))
    own = own.select("doc_id", "t", *(tag(base[x], k).alias(f"b{k}") for k, x in enumerate(KINDS[:3])))
    free = F.col("t")
    for kind in BASE:
        free = outside(free, kind)
    own = own.select("doc_id", F.array_sort(F.concat("b0", "b1", "b2")).alias("base"), F.when(F.size("b0") + F.size("b1") + F.size("b2") > 0, free).otherwise(F.col("t")).alias("free"))
    runs = F.when(F.col("free").rlike(CANDIDATE), matches(F.col("free"), CANDIDATE)).otherwise(F.array().cast(SPANS))
    hot = F.filter(runs, lambda x: ratio(x.m, table) >= RATIO)
    return own.select("doc_id", F.array_sort(F.concat("base", tag(hot, 3))).alias("found"))


def op8(spark, sf_dir: str) -> DataFrame:
    """Secrets of all documents, as digest columns; edge cases as in ``scan``."""
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, train(labelled_samples(docs)))
    named = lambda arr: F.array_join(F.transform(arr, lambda x: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), x.kind), x.s, x.e)), ",")
    count = lambda k: F.size(F.filter("found", lambda x: x.kind == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{x}") for k, x in enumerate(KINDS[:3])),
        F.sha2(named(F.filter("found", lambda x: x.kind < 3)), 256).alias("base_sha256"),
        named(F.col("found")).alias("spans"),
    )
