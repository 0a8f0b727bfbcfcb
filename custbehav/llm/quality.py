"""Line-first cleaning of documents, in built-in functions only.

Every line is judged by itself, failing lines are removed, and a document that loses too much of its text
that way is rejected. A line fails one of three kinds of rules:

* punctuation: symbols of mark-up or tables make up more than ``symbol_share`` of its characters, exclamation
  or question marks come in runs in more than that share, or it is a longer line mostly in capitals;
* navigation: it is a row of items between bars, bullets or arrows, or a short line that is only a menu item;
* boilerplate: it is a notice about cookies, scripts, subscriptions or rights and is not longer than one.

Beside the verdict stand the base counts of the contract. All of it is a projection of the text: no row
meets another, so there is no shuffle, and a document of any length costs n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from custbehav.llm.common import SPACE, SPACES, columns, set_aside, words

SYMBOLS = "#*$%&|<>"
MENU_ITEM = r"(?i)^(home|menu|login|log in|sign in|sign up|register|search|next|previous|back|top|contact|about|sitemap|share|print)$"
NOTICE = (
    r"(?i)(all rights reserved|accept (all )?cookies|uses cookies|cookie policy|privacy policy|terms of (use|service)"
    r"|enable javascript|subscribe to our|sign up for our|click here to|lorem ipsum)"
)
WINDOW = 5


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _length_without_space(text: Column) -> Column:
    return F.length(_without(text, SPACES))


def _kept_line(line: Column, symbol_share: float) -> Column:
    """True for a blank line and for one that breaks no rule."""

    def judged(bare: Column) -> Column:
        size = F.length(bare)
        limit = size * F.lit(symbol_share)
        symbols = size - F.length(_without(bare, SYMBOLS))
        shouts = size - F.length(F.regexp_replace(bare, "[!?]{2,}", ""))
        capitals = size - F.length(F.regexp_replace(bare, "[A-Z]", ""))
        small = size - F.length(F.regexp_replace(bare, "[a-z]", ""))
        dividers = size - F.length(_without(bare, "|»›•·"))
        plain = F.btrim(line, F.lit(SPACES))
        fails = (
            (symbols > limit)
            | (shouts > limit)
            | ((size >= 40) & (capitals > small * 4))
            | ((dividers >= 3) & (dividers * 12 >= size))
            | plain.rlike(MENU_ITEM)
            | ((F.length(plain) <= 200) & plain.rlike(NOTICE))
        )
        return (size == 0) | ~fails

    return _let(_without(line, SPACES), judged)


def _repeat_words(word_list: Column) -> Column:
    """Words within five-word windows that the text holds twice or more."""

    def counted(sorted_rows: Column) -> Column:
        """From (window, position) in order: positions whose window has an equal neighbour, then their cover."""
        hit = F.filter(
            sorted_rows,
            lambda row, i: (F.get(sorted_rows, i - 1)["w"] == row["w"]) | (F.get(sorted_rows, i + 1)["w"] == row["w"]),
        )
        positions = F.sort_array(F.transform(hit, lambda row: row["p"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        # From one start to the next a window covers the distance between them, five words at most.
        return F.aggregate(
            positions,
            start,
            lambda acc, p: F.struct((acc["n"] + F.least(p - acc["last"], F.lit(WINDOW))).alias("n"), p.alias("last")),
            lambda acc: acc["n"],
        )

    def windows(ws: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))

    def of_windows(hashes: Column) -> Column:
        indexed = F.transform(hashes, lambda w, i: F.struct(w.alias("w"), i.alias("p")))
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(_let(F.array_sort(indexed), counted))

    def of_words(ws: Column) -> Column:
        return F.when(F.size(ws) <= WINDOW, F.lit(0)).otherwise(_let(windows(ws), of_windows))

    return _let(word_list, of_words)


def judged(
    docs: DataFrame,
    max_lost_share: float = 0.3,
    symbol_share: float = 0.1,
    min_words: int = 10,
    max_repeat_percent: int = 20,
) -> DataFrame:
    """``docs`` with ``_q``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text, kept.

    ``docs`` needs the column ``text``; a null text is an empty one and fails for having too few words.
    ``clean_text`` is the text without its failing lines. Rows are judged one by one, so repeated rows and
    ties get equal results, and an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    with_words = docs.withColumn(
        "_t",
        F.struct(text.alias("text"), words(text).alias("words"), F.split(text, "\n").alias("lines")),
    )
    t = F.col("_t")
    lines = t["lines"]
    worded = F.filter(lines, lambda line: _without(line, SPACES) != "")
    clean = F.array_join(F.filter(lines, lambda line: _kept_line(line, symbol_share)), "\n")
    counts = with_words.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.struct(
            F.size(t["words"]).cast("long").alias("n_words"),
            _length_without_space(t["text"]).cast("long").alias("word_chars"),
            (F.length(t["text"]) - F.length(_without(t["text"], SYMBOLS))).cast("long").alias("n_symbols"),
            _let(worded, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
            _repeat_words(t["words"]).cast("long").alias("n_repeat_words"),
            clean.alias("clean_text"),
        ).alias("_c"),
    )
    c = F.col("_c")
    failed = (c["n_words"] < min_words) | (c["n_repeat_words"] * 100 > c["n_words"] * max_repeat_percent)
    lost = c["word_chars"] - _length_without_space(c["clean_text"])
    kept = ~failed & (lost <= c["word_chars"] * F.lit(max_lost_share))
    return counts.select(
        *[F.col(f"`{name}`") for name in docs.columns],
        F.struct("_c.*", failed.alias("base_failed"), kept.alias("kept")).alias("_q"),
    )


def quality_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **limits) -> DataFrame:
    """The contract's row per document."""
    rows = judged(columns(docs, doc_id=id_column, text=text_column), **limits)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rows.select("doc_id", *[F.col(f"_q.{name}") for name in names])


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, without their failing lines; ``n_chars`` is set anew if there is one."""
    docs, back = set_aside(docs, "text", "n_chars")
    # The filter on the verdict stays above the explode; it would otherwise be moved below and judge every text twice.
    rows = judged(docs, **limits).select(*docs.columns, F.explode(F.array("_q")).alias("_one")).filter("_one.kept")
    text = F.col("_one.clean_text")
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return back(rows.withColumns({name: value for name, value in new.items() if name in docs.columns}))
