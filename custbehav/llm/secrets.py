"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

The patterns find assignments, access keys and long hexadecimal runs. Beside them, every long token that the
patterns do not cover to its ends is scored whole under two first-order character models, one of random strings and one of ordinary
identifiers; it is a secret if the log-likelihood ratio of its transitions passes a threshold. Both models
are trained from labelled samples: counts of character pairs, at most one number per pair of 67 characters,
which come to the driver and go back as a constant.

Scanning is a projection in built-in functions: the text between matches (``split``) and the matches
themselves (``regexp_extract_all``) give all positions in code points, no row meets another.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.llm.common import columns, set_aside

# The patterns of the contract with the length they need, in the order of the kinds.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12
LEAST_VARIETY = 8

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_CLASS = "[A-Za-z0-9+/_=-]"
LONG_TOKEN = rf"(?<!{_CLASS}){_CLASS}{{20,}}"
ORDINARY = rf"(?<!{_CLASS}){_CLASS}{{5,}}"
KINDS = ("assign", "access", "hex", "random")


def _spans(text: Column, pattern: str, kind: int, keep=None, value_group: int = 0) -> Column:
    """Spans (start, kind, end, value) of the matches of a pattern, leftmost and without overlap."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))

    def placed(rows: Column) -> Column:
        first = F.struct(empty.alias("spans"), F.lit(0).alias("at"))

        def step(acc: Column, row: Column) -> Column:
            start = acc["at"] + F.length(row["gap"])
            end = start + F.length(row["found"])
            span = F.struct(
                start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), row["value"].alias("value")
            )
            wanted = F.lit(True) if keep is None else keep(row["value"])
            spans = F.when(wanted, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct(spans.alias("spans"), end.alias("at"))

        return F.aggregate(rows, first, step, lambda acc: acc["spans"])

    zipped = F.arrays_zip(found.alias("found"), values.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    return F.when(text.rlike(pattern), placed(zipped)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All spans of the three patterns, by start and kind."""
    assign = _spans(text, ASSIGN, 0, lambda value: F.length(value) >= ASSIGN_VALUE, value_group=2)
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def training_samples(docs: DataFrame, max_documents: int = 20_000) -> DataFrame:
    """Labelled strings (``value``, ``label``) of at most about ``max_documents`` documents.

    Values of the patterns are labelled random if they have ``LEAST_VARIETY`` different characters (a row of
    equal digits is not random), the other words ordinary. The documents are those with
    the smallest hashes of their text, so the sample is the same in every run.
    """
    rows = columns(docs, text="text").filter("text is not null")
    total = rows.count()
    share = min(1.0, max_documents / max(total, 1))
    steps = 1 << 30
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(steps)) < int(share * steps))
    text = F.col("text")
    varied = F.filter(base_spans(text), lambda span: F.size(F.array_distinct(F.split(span["value"], ""))) >= LEAST_VARIETY)
    secrets = F.transform(varied, lambda span: span["value"])
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = F.regexp_extract_all(plain, F.lit(ORDINARY), F.lit(0))
    labelled = F.concat(
        F.transform(secrets, lambda v: F.struct(v.alias("value"), F.lit(1).alias("label"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("value"), F.lit(0).alias("label"))),
    )
    return sample.select(F.explode(labelled).alias("s")).select("s.value", "s.label")


def _codes(value: Column) -> Column:
    """Positions of the characters in the alphabet; a token holds no others."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def train(samples: DataFrame, backoff: float = 5.0, priors: tuple[float, float] = (0.5, 20.0)) -> list[float]:
    """Log ratio of the transition probabilities (random over ordinary) of every pair of characters.

    A pair is smoothed towards its second character, with ``backoff`` counts, and a character towards all
    alike, with the class's prior counts (ordinary, random): a random string may hold any character, whatever
    the alphabet of the samples. Without samples of both classes all ratios are zero and nothing is called random.
    """
    size = len(ALPHABET)
    pairs = samples.select("label", _codes(F.regexp_replace("value", "[^A-Za-z0-9+/_=-]", "")).alias("codes"))
    pairs = pairs.filter(F.size("codes") > 1).select(
        "label",
        F.explode(
            F.zip_with(
                F.slice("codes", 1, F.size("codes") - 1), F.slice("codes", 2, F.size("codes") - 1), lambda a, b: a * size + b
            )
        ).alias("pair"),
    )
    counts = [[0] * (size * size) for _ in range(2)]
    for row in pairs.groupBy("label", "pair").count().collect():  # at most two rows per pair of characters
        counts[row["label"]][row["pair"]] = row["count"]
    if not all(map(sum, counts)):
        return [0.0] * (size * size)

    def log_probabilities(own: list[int], prior: float) -> list[float]:
        after = [sum(own[b::size]) + prior for b in range(size)]
        single = [n / sum(after) for n in after]
        before = [sum(own[a * size : (a + 1) * size]) for a in range(size)]
        return [math.log((n + backoff * single[i % size]) / (before[i // size] + backoff)) for i, n in enumerate(own)]

    ordinary, random = map(log_probabilities, counts, priors)
    return [round(r - o, 6) for r, o in zip(random, ordinary)]


def _log_ratio(token: Column, weights: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    size = len(ALPHABET)

    def of(codes: Column) -> Column:
        n = F.size(codes) - 1
        terms = F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: F.get(table, a * size + b))
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)

    return F.element_at(F.transform(F.array(_codes(token)), of), 1)


def all_spans(text: Column, weights: list[float], threshold: float = 20.0) -> tuple[Column, Column]:
    """(base spans, base and random spans) of a text, each by start and kind.

    A random span may hold base spans, which stay: a token is left out only if they cover all of it.
    """
    base = base_spans(text)
    long_tokens = _spans(text, LONG_TOKEN, 3, lambda token: _log_ratio(token, weights) > threshold)

    def joined(own: Column) -> Column:
        def covered_to(token: Column) -> Column:
            """Where the base spans, which come by start, leave the token free first."""
            step = lambda at, b: F.when((b["start"] <= at) & (at < b["end"]), b["end"]).otherwise(at)
            return F.aggregate(own, token["start"], step)

        free = F.filter(long_tokens, lambda t: covered_to(t) < t["end"])
        return F.array_sort(F.concat(own, free))

    return base, F.element_at(F.transform(F.array(base), joined), 1)


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def scan(
    docs: DataFrame, weights: list[float], threshold: float = 20.0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs`` with its numbers and places of secrets.

    Null texts are empty and have none. Rows are scanned one by one: repeated rows give repeated results, an
    empty table none.
    """
    rows = columns(docs, doc_id=id_column, text=text_column)
    base, every = all_spans(F.coalesce("text", F.lit("")), weights, threshold)
    found = rows.select("doc_id", F.struct(base.alias("base"), every.alias("every")).alias("s"))

    def number(kind: int) -> Column:
        return F.size(F.filter("s.base", lambda span: span["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_written(F.col("s.base")), 256).alias("base_sha256"),
        _written(F.col("s.every")).alias("spans"),
        F.size(F.filter("s.every", lambda span: span["kind"] == 3)).cast("long").alias("n_random"),
    )


def redact(docs: DataFrame, weights: list[float], threshold: float = 20.0, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans become one. Clean rows stay as they are."""
    docs, back = set_aside(docs, "text", "n_chars")
    text = F.col("text")
    _, spans = all_spans(F.coalesce(text, F.lit("")), weights, threshold)

    def step(acc: Column, span: Column) -> Column:
        """Text up to the span, then the mark; a span that begins inside the one before only lengthens it."""
        apart = span["start"] >= acc["at"]
        between = F.substring(text, acc["at"] + 1, span["start"] - acc["at"])
        return F.struct(
            F.when(apart, F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], span["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    struct = F.struct(text.alias("old"), F.when(text.isNotNull(), cut).alias("new"))
    rows = docs.withColumn("_s", struct)
    changed = ~F.col("_s.old").eqNullSafe(F.col("_s.new"))
    new = {"text": F.col("_s.new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("_s.new").cast("long")).otherwise(F.col("n_chars"))
    return back(rows.withColumns(new))
