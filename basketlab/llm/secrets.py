"""Secret scan: fixed patterns, and character Markov models on top.

Everything is DataFrame expressions. A pattern's matches come from
``regexp_extract_all`` and the text between them from ``split`` on the same
pattern; the running sum of both lengths gives positions in code points.
Running sums and maxima over an array go in blocks of about the root of its
size, characters come from one ``split``, and cuts of a text are made inside
blocks of it: a text of a million characters or a hundred thousand matches
takes seconds, not their square.

The models are first-order Markov chains over the characters of tokens, one
of random strings and one of ordinary identifiers, trained from labelled
samples. A token that is more than a match of a pattern is added when the log-likelihood
ratio of its transitions, in nats a transition, reaches a limit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Kinds in their order, pattern, and least characters of the
# whole match (of group 2 for assign).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more in all
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A run of these characters that starts after another character.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+"
SPANS = "array<struct<start:int,kind:int,end:int>>"


def _scan(values: Column, start: Column, step, kind: str) -> Column:
    """Of an array the running results of ``step`` in front of each element,
    from ``start`` on. It copies what it has at each element: for short arrays."""
    empty = F.array().cast(f"array<{kind}>")
    return F.aggregate(values, F.struct(start.alias("at"), empty.alias("out")), lambda acc, x: F.struct(
        step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, step, kind: str = "int") -> Column:
    """The same from 0 for arrays of any size: blocks of about the root of the
    size, first their totals, then inside each. ``step`` must be associative."""
    zero = F.lit(0).cast(kind)

    def blocked(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(v) - 1), width)
        return F.when(F.size(v) > 0, F.transform(starts, lambda at: F.slice(v, at + 1, width))).otherwise(
            F.array().cast(f"array<array<{kind}>>"))

    def summed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda at, x: step(at, x)))
        return F.flatten(F.zip_with(blocks, _scan(totals, zero, step, kind),
                                    lambda b, base: _scan(b, base, step, kind)))

    return _let(_let(values, blocked), summed)


def _characters(text: Column) -> Column:
    """The characters, by one walk."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def _matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: array of (start, end, value) of the pattern's leftmost,
    non-overlapping matches in ``text``."""
    df = df.withColumn("found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    some = F.size("found") > 0
    # The text behind the last match comes last.
    gaps = F.slice(F.split("text", pattern, -1), F.lit(1), F.size("found"))
    df = df.withColumn("gaps", F.when(some, F.transform(gaps, F.length)))
    df = df.withColumn("before", F.when(some, running(
        F.zip_with("gaps", "found", lambda g, v: g + F.length(v)), lambda at, x: at + x)))
    spans = F.transform(F.arrays_zip("before", "gaps", "found"), lambda x: F.struct(
        (x["before"] + x["gaps"]).alias("start"), (x["before"] + x["gaps"] + F.length(x["found"])).alias("end"),
        x["found"].alias("value")))
    return df.withColumn(name, F.when(some, spans).otherwise(empty)).drop("found", "gaps", "before")


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and the arrays assign, access and hex."""
    docs = _matches(docs, "assign", ASSIGN)
    docs = docs.withColumn("assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= 6))
    return _matches(_matches(docs, "access", ACCESS), "hex", HEX)


@dataclass
class Model:
    """``ratio[i * n + j]``: log P(j | i) of random strings less that of
    identifiers, for the n characters of ``alphabet``."""
    alphabet: str
    ratio: list[float]

    def score(self, token: Column) -> Column:
        """Log-likelihood ratio a transition. Other characters don't count."""
        n = len(self.alphabet)
        table = F.from_json(F.lit("[" + ",".join(f"{x:.5f}" for x in self.ratio) + "]"), "array<double>")
        places = F.transform(_characters(token), lambda c: F.instr(F.lit(self.alphabet), c))

        def step(acc: Column, p: Column) -> Column:
            known = (p > 0) & (acc["last"] > 0)
            gain = F.when(known, F.element_at(table, (acc["last"] - 1) * n + p)).otherwise(0.0)
            return F.struct((acc["sum"] + gain).alias("sum"), p.alias("last"))

        total = F.aggregate(places, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last")), step,
                            lambda acc: acc["sum"])
        return F.when(F.length(token) > 1, total / (F.length(token) - 1)).otherwise(0.0)


def train(samples: DataFrame, alphabet: str = ALPHABET, smoothing: float = 0.5) -> Model:
    """From labelled strings: ``text`` and ``label`` (1 random string, 0
    ordinary identifier); equal ones are cut into pairs once. Null texts and labels, and characters beyond the
    alphabet, don't count; with no samples every ratio is 0. The driver gets
    counts of character pairs: at most len(alphabet)**2 a label."""
    strings = (samples.filter("text IS NOT NULL AND label IN (0, 1) AND length(text) > 1")
               .groupBy(F.col("label").cast("int").alias("label"), "text").agg(F.count("*").alias("n")))
    strings = strings.select("label", "n", _characters(F.col("text")).alias("c"))
    rows = strings.select("label", "n", F.explode(F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1),
        lambda a, b: F.concat(a, b))).alias("pair"))
    inside = "^[" + alphabet.replace("-", r"\-") + "]{2}$"
    n, place = len(alphabet), {c: i for i, c in enumerate(alphabet)}
    counts = [[[smoothing] * n for _ in range(n)] for _ in range(2)]
    for label, pair, k in rows.filter(F.col("pair").rlike(inside)).groupBy("label", "pair").agg(F.sum("n")).collect():
        counts[label][place[pair[0]]][place[pair[1]]] += k
    sums = [[sum(row) for row in one] for one in counts]
    return Model(alphabet, [math.log(counts[1][i][j] / sums[1][i]) - math.log(counts[0][i][j] / sums[0][i])
                            for i in range(n) for j in range(n)])


def samples_from(docs: DataFrame) -> DataFrame:
    """Labelled strings taken from all ``docs`` (with ``text``): the values of
    base matches are random strings; tokens of four characters or more outside
    such matches are ordinary identifiers."""
    found = base_spans(docs.select("text"))
    values = F.concat(F.transform("assign", lambda x: F.regexp_extract(x["value"], ASSIGN, 2)),
                      F.transform("access", lambda x: x["value"]), F.transform("hex", lambda x: x["value"]))
    random = found.select(F.explode(values).alias("text"), F.lit(1).alias("label"))
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    ordinary = docs.select(F.explode(F.regexp_extract_all(rest, F.lit(TOKEN % 4), F.lit(0))).alias("text"),
                           F.lit(0).alias("label"))
    return random.unionByName(ordinary)


def scan(docs: DataFrame, model: Model, *, id_col="doc_id", text_col="text", least_chars: int = 20,
         least_ratio: float = 0.5) -> DataFrame:
    """Per document: doc_id, text and ``spans``, an array of (start, kind, end)
    in order, with positions in code points, end exclusive, and kind a place
    in KINDS. Base spans always stay; a Markov span is a token of at least
    ``least_chars`` characters that lies in no base span (it may overlap some)
    and whose log-likelihood ratio a transition is at least ``least_ratio``. Null texts
    are empty and have no spans, null ids stay null, repeated rows are
    scanned each, an empty table gives no rows. Spans that start together are
    in the order of KINDS. Very long texts, tokens and runs of matches are
    read to their end; other columns, whatever their names, play no part."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    return _scanned(rows, model, least_chars, least_ratio).select("doc_id", "text", "spans")


def _scanned(rows: DataFrame, model: Model, least_chars: int, least_ratio: float) -> DataFrame:
    """``rows`` with ``text``, and the array ``spans``."""
    rows = _matches(base_spans(rows), "token", TOKEN % least_chars)

    def typed(name: str, spans=None) -> Column:
        kind = KINDS.index(name)
        return F.transform(F.col(name) if spans is None else spans, lambda x: F.struct(
            x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    rows = rows.withColumn("base", F.concat(typed("assign"), typed("access"), typed("hex")))
    # In order of their starts, base spans first: a token lies in one of them
    # if the farthest end so far reaches its own.
    entry = lambda at, end, value: F.struct(at.alias("start"), value.isNotNull().alias("token"), end.alias("end"),
                                            value.alias("value"))
    none = F.lit(None).cast("string")
    rows = rows.withColumn("both", F.when(F.size("token") > 0, F.array_sort(F.concat(
        F.transform("base", lambda x: entry(x["start"], x["end"], none)),
        F.transform("token", lambda x: entry(x["start"], x["end"], x["value"]))))))
    far = running(F.transform("both", lambda x: F.when(x["token"], 0).otherwise(x["end"])),
                  lambda at, x: F.greatest(at, x))
    rows = rows.withColumn("far", F.when(F.size("token") > 0, far))
    free = F.filter(F.arrays_zip("both", "far"), lambda x: x["both"]["token"] & (x["far"] < x["both"]["end"]))
    empty = F.array().cast("array<struct<start:int,token:boolean,end:int,value:string>>")
    rows = rows.withColumn("token", F.when(F.size("token") > 0, F.transform(free, lambda x: x["both"])).otherwise(empty))
    added = F.filter("token", lambda x: model.score(x["value"]) >= least_ratio)
    spans = F.array_sort(F.concat("base", typed("markov", F.when(F.size("token") > 0, added).otherwise(F.col("token")))))
    return rows.withColumn("spans", spans.cast(SPANS))


def redacted(docs: DataFrame, model: Model, *, text_col="text", least_chars: int = 20,
             least_ratio: float = 0.5) -> DataFrame:
    """``docs`` with every span of its text replaced; the other columns, and
    null texts, stay as they are."""
    row = docs.select(F.struct(*docs.columns).alias("row"), common.text_or_empty(text_col).alias("text"))
    done = _scanned(row, model, least_chars, least_ratio)
    text = F.when(F.size("spans") > 0, redact(F.col("text"), F.col("spans"))).otherwise(F.col(f"row.{text_col}"))
    return done.select(*(text.alias(c) if c == text_col else F.col(f"row.{c}") for c in docs.columns))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, counts by kind, sha256 of the base spans, and all spans."""
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    base = F.filter("spans", lambda x: x["kind"] < KINDS.index("markov"))
    return scanned.select("doc_id", *(of(k).alias(f"n_{k}") for k in KINDS[:3]),
                          F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                          of("markov").alias("n_markov"))


#: Characters of the blocks that cuts are made in.
BLOCK = 4096


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (exclusive) of a text in blocks."""
    inside = lambda i: F.substring(
        F.get(blocks, i), F.greatest(F.lit(0), start - i * BLOCK) + 1,
        F.least(F.lit(BLOCK), end - i * BLOCK) - F.greatest(F.lit(0), start - i * BLOCK))
    numbers = F.sequence(F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int"))
    return F.when(start < end, F.array_join(F.transform(numbers, inside), "")).otherwise("")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones together) replaced. Spans
    are in order of their starts."""
    far = running(F.transform(spans, lambda x: x["end"]), lambda at, x: F.greatest(at, x))
    opens = F.filter(F.zip_with(spans, far, lambda x, f: F.struct(f.alias("from"), x["start"].alias("to"))),
                     lambda x: x["to"] >= x["from"])

    def pieced(blocks: Column) -> Column:
        parts = F.transform(opens, lambda x: F.concat(_cut(blocks, x["from"], x["to"]), F.lit(mark)))
        tail = _cut(blocks, F.array_max(F.transform(spans, lambda x: x["end"])), F.length(text))
        return F.concat(F.array_join(parts, ""), tail)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(blocks, pieced)).otherwise(text)
