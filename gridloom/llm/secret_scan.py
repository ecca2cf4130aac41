"""Secret scan: fixed patterns, and character Markov models of random strings
and ordinary identifiers compared by log-likelihood ratio.

All of it is DataFrame functions.  Match positions come from ``split`` and
``regexp_extract_all`` of one pattern: the pieces between the matches and the
matches alternate, so their lengths (code points) add up to the positions.
Both run only on texts that hold a match.

The models are first-order Markov chains over the token alphabet, with
additive smoothing.  ``labelled_samples`` counts the distinct tokens of all
documents, ``train`` the transitions of these labelled tokens (label 1 random,
0 ordinary), times their counts, in one aggregate; at most 2 x (alphabet +
1)^2 counts reach the driver, as one literal array.  A candidate token is a run of
``[A-Za-z0-9+/_-]`` of at least ``MIN_TOKEN`` characters; it is a span of kind
``markov`` when its log-likelihood ratio reaches ``MIN_RATIO`` in all and
``MIN_MEAN`` a character, and it overlaps no base span.

Edge cases: a null text is empty and has no spans; ties (equal starts) are
ordered by kind as listed; overlapping spans of different kinds are all kept;
very long texts are scanned whole; repeated rows each give the same result;
without training samples the ratio is 0 and nothing is added; an empty table
gives no rows.  Input columns that clash with the operator's are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import isolated, null_safe

# The base patterns and their least lengths.
KEYWORD = r"(?i:(password|passwd|secret|token|api_?key))"
ASSIGN = KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TOKEN = r"[A-Za-z0-9+/_-]+"
MIN_TOKEN = 16
MIN_RATIO, MIN_MEAN = 10.0, 0.6
SMOOTHING = 0.5
RANDOM_SAMPLES = 4000

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _positions(text: Column, pattern: str, least: int, group: int = 0) -> Column:
    """Matches (start, kind 0, end) of ``pattern``, leftmost and not
    overlapping, whose ``group`` has at least ``least`` characters."""
    pieces = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + F.length(row["piece"])
        end = begin + F.coalesce(F.length(row["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(0).alias("kind"), end.alias("end"))
        found = F.when(F.coalesce(F.length(row["value"]), F.lit(0)) >= least,
                       F.concat(acc["found"], F.array(span))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(rows, start, step)["found"]


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _scan(text: Column, pattern: str, probe: str, least: int, kind: int, group: int = 0) -> Column:
    """Spans of a kind; only texts that hold ``probe`` are cut up."""
    return (F.when(text.rlike(probe), _of_kind(_positions(text, pattern, least, group), kind))
            .otherwise(F.array().cast(_SPAN)))


def base_spans(text: Column) -> tuple[Column, Column, Column]:
    """(assign, access, hex) spans of a text that is not null."""
    return (_scan(text, ASSIGN, ASSIGN.removesuffix("+)") + f"{{{ASSIGN_MIN},}})", ASSIGN_MIN, 0, 2),
            _scan(text, ACCESS, rf"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}", ACCESS_MIN, 1),
            _scan(text, HEX, rf"[0-9a-f]{{{HEX_MIN},}}", HEX_MIN, 2))


# ------------------------------------------------------------------- models

def _code(char: Column) -> Column:
    """1.. for a character of the alphabet, 0 for any other."""
    return F.instr(F.lit(ALPHABET), char)


def train(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Labelled tokens (token, label, and ``n`` if they stand for several) ->
    the log-likelihood ratio of every transition, as one flat table of
    (alphabet + 1)^2 numbers."""
    size = len(ALPHABET) + 1
    times = F.col("n") if "n" in samples.columns else F.lit(1)
    moves = (samples.filter(F.length("token") > 1)
             .select("label", "token", times.alias("n"), F.explode(F.sequence(F.lit(2), F.length("token"))).alias("i"))
             .select("label", "n", F.expr("substring(token, i - 1, 1)").alias("a"), F.expr("substring(token, i, 1)").alias("b"))
             .groupBy("label", _code(F.col("a")).alias("a"), _code(F.col("b")).alias("b")).agg(F.sum("n").alias("n")).collect())
    counts = {0: [[0] * size for _ in range(size)], 1: [[0] * size for _ in range(size)]}
    for r in moves:
        counts[int(r["label"])][r["a"]][r["b"]] += r["n"]
    logs = {}
    for label, rows in counts.items():
        logs[label] = [[math.log((n + smoothing) / (sum(row) + smoothing * size)) for n in row] for row in rows]
    if not moves:
        return [0.0] * size * size
    return [logs[1][a][b] - logs[0][a][b] for a in range(size) for b in range(size)]


def token_ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, random against ordinary."""
    size = len(ALPHABET) + 1
    ratios = F.array_repeat(F.lit(0.0), 0) if not table else F.from_json(F.lit(str(table)), "array<double>")

    def step(acc: Column, char: Column) -> Column:
        code = _code(char)
        ratio = F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(ratios, acc["last"] * size + code + 1))
        return F.struct(code.alias("last"), (acc["sum"] + ratio).alias("sum"))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(token, ""), start, step)["sum"]


def labelled_samples(docs: DataFrame, text_col: str = "text", randoms: int = RANDOM_SAMPLES) -> DataFrame:
    """Training tokens (token, label, n) from all documents, counted before
    they are spelt out.  Label 1: the values that the base patterns find, and
    strings that are random by construction (base64 and upper-case digests of
    as many numbers as there are documents, ``randoms`` at least).  Label 0:
    words of 8 or more letters, as written, in capitals and joined as an
    identifier."""
    spark = docs.sparkSession
    text = null_safe(F.col(text_col))
    values = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all(text, F.lit(rf"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}"), F.lit(0)))
    words = F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z0-9+/=])[A-Za-z]{8,}(?![A-Za-z0-9+/=])"), F.lit(0))

    def labelled(tokens: Column, label: int) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("token"), F.lit(label).alias("label")))

    found = (docs.select(F.explode(F.concat(labelled(F.filter(values, lambda t: F.length(t) >= ASSIGN_MIN), 1), labelled(words, 0))).alias("t"))
             .groupBy("t.token", "t.label").agg(F.count(F.lit(1)).alias("n")))
    word = F.col("token")
    written = F.when(F.col("label") == 1, F.array(word)).otherwise(F.array(
        word, F.upper(word), F.concat_ws("_", F.lower(word), F.lower(word)),
        F.concat_ws("-", F.initcap(word), word), F.concat_ws("/", word, word)))
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(max(randoms, docs.count())).select(F.explode(F.array(
        F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.upper(digest),
        F.translate(F.base64(F.unhex(digest)), "+/=", "-_"))).alias("token"), F.lit(1).alias("label"), F.lit(1).cast("long").alias("n"))
    return found.select(F.explode(written).alias("token"), "label", "n").unionByName(made)


def scan(docs: DataFrame, ratios: list[float], text_col: str = "text") -> DataFrame:
    """``docs`` plus ``base`` (base spans) and ``spans`` (all), both sorted by
    start, then kind: arrays of (start, kind number, end)."""
    text = null_safe(F.col(text_col))
    assign, access, hexes = base_spans(text)
    out = docs.withColumn("base", F.array_sort(F.concat(assign, access, hexes)))
    tokens = _scan(text, TOKEN, rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}", MIN_TOKEN, 3)

    def random_like(s: Column) -> Column:
        token = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        ratio = token_ratio(token, ratios)
        return (ratio >= MIN_RATIO) & (ratio >= MIN_MEAN * (s["end"] - s["start"]))

    added = F.filter(F.filter(tokens, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))),
                     random_like)
    return out.withColumn("spans", F.array_sort(F.concat("base", added)))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ratios: list[float], text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (same columns) with every span replaced by ``mark``;
    overlapping spans share one mark, texts without spans stay as they are."""
    text = F.col(text_col)

    def step(acc: Column, s: Column) -> Column:
        kept = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] < acc["at"], acc["out"]).otherwise(kept).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return isolated(docs, (text_col,), lambda rows: scan(rows, ratios, text_col).withColumn(
        text_col, F.when(F.size("spans") > 0, cut).otherwise(text)))
