"""Secrets in texts: fixed patterns, and strings that look random to a character model.

1. Base patterns find key assignments, access keys and long hexadecimal strings.
2. Two Markov models over pairs of neighbouring characters are trained from labelled
   samples: one of random strings (what the base patterns find), one of ordinary
   identifiers (words and names without digits that stand by themselves and are no find). Every distinct string of
   all documents counts once. A string with letters and at least ``min_length`` characters that does not touch a base find is a secret
   too if its mean log-likelihood ratio over all pairs exceeds ``threshold``.

All of it is built-in functions. Places of matches are running sums of the lengths of the matches and
of the text between them; overlaps are found by a running maximum over both kinds of spans in order. Both are taken in blocks of
the square root of their number, so a text with a hundred thousand finds takes seconds. A first scan stores
matches and candidates, a second trains, and a third judges what was stored.

Rules: a null text is empty and has no finds. Texts are judged row by row, repeated ones too. Without any
sample both models are uniform and nothing is added. Places count code points; ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import constant_array, free_name, stored

#: In this order spans of equal start are listed. Fixed values.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LENGTH = 12

#: Characters of a candidate, and what a candidate must have besides.
CANDIDATE = r"[A-Za-z0-9+/_=-]"
MIN_LENGTH = 16
#: A word or name that stands by itself, without digits.
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{4,}(?![A-Za-z0-9+/_=-])"
THRESHOLD = 0.0
#: Pairs of each first character that are counted in advance, and counts of each character.
PRIOR_PAIRS = 50.0
SMOOTHING = 0.5
_CODES = 128

_SPAN = "array<struct<start: int, kind: int, end: int, value: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it, also inside of other functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _in_blocks(values: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of each block of ``values``, which is a bound name; a block has about as many values as there are blocks."""
    most = F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), most), lambda at: at <= F.size(values))
    return F.transform(starts, lambda at: body(F.slice(values, at, most)))


def _running(values: Column, both: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values``, whole numbers from 0 up, the sum or maximum (``both``) of all up to it."""

    def within(block: Column) -> Column:
        begin = F.array().cast("array<int>")
        step = lambda acc, x: F.concat(acc, F.array(both(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)), x)))
        return F.aggregate(block, begin, step)

    def joined(blocks: Column) -> Column:
        ends = within(F.transform(blocks, lambda block: F.get(block, F.size(block) - 1)))
        shifted = lambda before: F.transform(blocks, lambda block, k: F.transform(block, lambda x: both(x, F.coalesce(F.get(before, k - 1), F.lit(0)))))
        return F.flatten(_let(ends, shifted))

    return _let(values, lambda own: _let(_in_blocks(own, within), joined))


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """(start, kind, end, value) of all matches, leftmost and without overlap. Only for texts with matches."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )

    def placed(found: Column) -> Column:
        lengths = F.transform(found, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0)))
        span = lambda ends: lambda x, k: F.struct((F.get(ends, k) - F.length(x["match"])).alias("start"), F.lit(kind).alias("kind"), F.get(ends, k).alias("end"), x["value"].alias("value"))
        spans = lambda ends: F.transform(F.filter(found, lambda x: x["match"].isNotNull()), span(ends))
        return _let(_running(lengths, lambda a, b: a + b), spans)

    return _let(found, placed)


def _none() -> Column:
    return F.array().cast(_SPAN)


def _scanned(text: Column, min_length: int) -> tuple[Column, Column]:
    """Base spans, and candidates of the model, of ``text``. The cheap tests before a pattern spare most texts the costly one."""
    assigned = F.filter(_spans(text, ASSIGN, 0, 2), lambda span: F.length(span["value"]) >= ASSIGN_LENGTH)
    base = F.concat(
        F.when(text.rlike("[:=]") & text.rlike(ASSIGN), assigned).otherwise(_none()),
        F.when(text.contains("AKIA") & text.rlike(ACCESS), _spans(text, ACCESS, 1)).otherwise(_none()),
        F.when(text.rlike("[0-9]|[a-f]{16}") & text.rlike(HEX), _spans(text, HEX, 2)).otherwise(_none()),
    )
    candidate = f"{CANDIDATE}{{{min_length},}}"
    candidates = F.filter(_spans(text, candidate, 3), lambda span: span["value"].rlike("[A-Za-z]"))
    return base, F.when(text.rlike(candidate), candidates).otherwise(_none())


def _pairs(value: Column) -> Column:
    """Codes of neighbouring characters of an ASCII string, as one number each."""
    codes = F.transform(F.filter(F.split(value, "", -1), lambda c: c != ""), lambda c: F.ascii(c))
    return F.transform(
        F.arrays_zip(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))).alias("a"), F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(1))).alias("b")),
        lambda pair: pair["a"] * _CODES + pair["b"],
    )


def train_character_models(samples: DataFrame, *, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio of each pair of characters. ``samples``: value, label (1 random, 0 ordinary); each distinct
    value counts once, as random if it is so anywhere."""
    values = samples.filter("length(value) >= 2 and value rlike '^[!-~]+$'").groupBy("value").agg(F.max("label").alias("label"))
    pairs = values.select("label", F.explode(_pairs(F.col("value"))).alias("pair"))
    counts = pairs.groupBy("label", "pair").count().collect()  # at most 2 x 128 x 128 rows
    return _ratios({(row.label, row.pair): row["count"] for row in counts}, smoothing)


def _ratios(counts: dict[tuple[int, int], int], smoothing: float) -> list[float]:
    """log P(b | a) of random strings less that of ordinary ones. A pair that was not seen is as likely as its
    second character is among all of the label's."""
    printable, tables = range(33, 127), []
    for label in (0, 1):
        single = dict.fromkeys(printable, smoothing)
        for (own, pair), n in counts.items():
            if own == label:
                single[pair % _CODES] += n
        total = sum(single.values())
        table = [0.0] * _CODES**2
        for a in printable:
            row = [counts.get((label, a * _CODES + b), 0) for b in printable]
            for b, n in zip(printable, row):
                table[a * _CODES + b] = log((n + PRIOR_PAIRS * single[b] / total) / (sum(row) + PRIOR_PAIRS))
        tables.append(table)
    return [random - ordinary for ordinary, random in zip(*tables)]


def _samples(docs: DataFrame, scanned: DataFrame, text_col: str) -> DataFrame:
    """What base patterns find is random. Words and names of all documents without a digit are ordinary."""
    random = scanned.select(F.explode("base").alias("span")).select(F.col("span.value").alias("value"), F.lit(1).alias("label"))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(ORDINARY), F.lit(0)))).alias("value"))
    return random.unionByName(words.select("value", F.lit(0).alias("label")))


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base, added: arrays of (start, kind, end, value), ordered by start and kind; ``kind`` counts :data:`KINDS`."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    base, candidates = _scanned(F.col("text"), min_length)
    scanned = stored(texts.select("doc_id", base.alias("base"), candidates.alias("candidates")), "secret-candidates")
    ratios = train_character_models(_samples(docs, scanned, text_col))
    return judge_candidates(scanned, ratios, threshold)


def judge_candidates(scanned: DataFrame, ratios: list[float], threshold: float) -> DataFrame:
    weights = constant_array(ratios)

    def mean_ratio(value: Column) -> Column:
        begin = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
        step = lambda acc, pair: F.struct((acc["sum"] + F.get(weights, pair)).alias("sum"), (acc["n"] + 1).alias("n"))
        return F.aggregate(_pairs(value), begin, step, lambda acc: acc["sum"] / F.greatest(acc["n"], F.lit(1)))

    # base finds that begin before a candidate's end come before it; the largest of their ends tells whether one touches it
    event = lambda at, is_base, end, span: F.struct(at.alias("at"), F.lit(is_base).alias("is_base"), end.alias("end"), span.alias("span"))
    events = F.concat(
        F.transform("base", lambda span: event(span["start"], 1, span["end"], span)),
        F.transform("candidates", lambda span: event(span["end"], 0, F.lit(0), span)),
    )

    def apart(events: Column) -> Column:
        reach = _running(F.transform(events, lambda x: x["end"]), F.greatest)
        told = lambda reach: F.filter(events, lambda x, k: (x["is_base"] == 0) & (F.get(reach, k) <= x["span"]["start"]))
        return F.transform(_let(reach, told), lambda x: x["span"])

    added = F.filter(_let(F.sort_array(events), apart), lambda span: mean_ratio(span["value"]) > threshold)
    return scanned.select("doc_id", F.sort_array("base").alias("base"), F.when(F.size("candidates") > 0, F.sort_array(added)).otherwise(_none()).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", F.get(kinds, span["kind"]), span["start"].cast("string"), span["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[secret]", **parameters: float) -> DataFrame:
    """``docs`` with ``mark`` in place of each find, overlapping ones as one, and ``length_col`` set anew where
    that happens. The judgement is made anew per row from its own text, so it needs no join."""
    base, candidates = _scanned(F.coalesce(text_col, F.lit("")), int(parameters.get("min_length", MIN_LENGTH)))
    whole = free_name(docs, "row")
    texts = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias(whole), base.alias("base"), candidates.alias("candidates"))
    scanned = docs.select(base.alias("base"))
    ratios = train_character_models(_samples(docs, scanned.filter(F.size("base") > 0), text_col))
    judged = judge_candidates(texts.withColumn("doc_id", F.col(whole)), ratios, parameters.get("threshold", THRESHOLD))
    found = judged.select(F.col("doc_id").alias(whole), F.sort_array(F.concat("base", "added")).alias("found"))
    text = F.coalesce(F.col(whole)[text_col], F.lit(""))
    changed = F.size("found") > 0
    rows = found.withColumn("text", F.when(changed, _replaced(text, F.col("found"), mark)).otherwise(F.col(whole)[text_col]))
    columns = []
    for name in docs.columns:
        column = F.col(whole)[name]
        if name == text_col:
            column = F.col("text")
        elif name == length_col:
            column = F.when(changed, F.length("text").cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return rows.select(*columns)


def _replaced(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with ``mark`` in place of ``spans``, which are in order; what overlaps is one. The text is cut first into a stretch for each block
    of spans, and each stretch by its own spans."""

    def cut(reach: Column) -> Column:
        before = lambda k: F.coalesce(F.get(reach, k - 1), F.lit(0))
        gaps = F.transform(spans, lambda span, k: F.when(span["start"] >= before(k), F.struct(before(k).alias("from"), span["start"].alias("to"))))

        def within(block: Column) -> Column:
            begin, end = F.get(block, F.lit(0))["from"], F.get(block, F.size(block) - 1)["to"]
            kept = lambda stretch: F.transform(block, lambda gap: F.concat(F.substring(stretch, gap["from"] - begin + 1, gap["to"] - gap["from"]), F.lit(mark)))
            return F.array_join(_let(F.substring(text, begin + 1, end - begin), kept), "")

        parts = _let(F.array_compact(gaps), lambda gaps: _in_blocks(gaps, lambda block: _let(block, within)))
        return F.concat(F.array_join(parts, ""), F.substring(text, F.get(reach, F.size(reach) - 1) + 1, F.length(text)))

    return _let(_running(F.transform(spans, lambda span: span["end"]), F.greatest), cut)
