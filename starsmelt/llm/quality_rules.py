"""Quality rules: base counts of each text, and adaptive thresholds per language and source.

Thresholds come from mergeable quantile sketches: integer histograms of fixed bin width, which add
up in any order to the same counts, so a result does not depend on how rows are spread. A quantile
is exact to one bin. Everything is a Spark expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsmelt.llm.common import null_to_empty, stage

BLANKS = r"[ \t-\r]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: measure -> (count, of which, bins for one, highest bin). A value is a bin number.
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 1000, 1000),
    "repeats": ("n_repeat_words", "n_words", 1000, 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 1000),
    "word_length": ("word_chars", "n_words", 100, 10_000),
}
#: measure -> (percent of the low rank, of the high rank, half spreads to the fence, least spread).
#: A spread is the distance of the two ranks and at least so many bins. Symbols go by the median, so
#: that a group may be junk by nearly a half; repeats are 0 in most clean texts but not in all, so
#: their fences start from the tail. A least spread keeps a group of copies from rejecting the rest.
RANKS = {
    "symbols": (25, 50, 12, 4),
    "repeats": (50, 99, 3, 4),
    "dup_lines": (50, 99, 3, 4),
    "word_length": (25, 75, 12, 25),
}
#: The ranks of a language, or of the corpus for a language, count like this many rows of the group.
PRIOR = 100


def _joined(name: str, step: int) -> Column:
    """Hashes of windows of ``2 * step`` words from those of ``step`` words."""
    firsts = F.slice(name, 1, F.greatest(F.size(name) - step, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(name, i + step)))


def _repeated_windows(df: DataFrame, size_log2: int = 3) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows of 8 words that a text has twice or more.

    Window hashes are built by doubling, two, four and eight words. They are sorted only where
    some are equal.
    """
    df = df.withColumn("h0", F.transform("words", lambda w: F.xxhash64(w)))
    for level in range(size_log2):
        df = df.withColumn(f"h{level + 1}", _joined(f"h{level}", 1 << level))
    last, width = f"h{size_log2}", 1 << size_log2
    repeats = F.size(F.array_distinct(last)) < F.size(last)
    df = df.withColumn("ordered", F.when(repeats, F.array_sort(
        F.transform(last, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("ordered", lambda x, k: (
        F.coalesce(F.get("ordered", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("ordered", k + 1)["h"] == x["h"], F.lit(False))))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, i: F.struct((s["n"] + i + width - F.greatest(i, s["end"])).alias("n"),
                              (i + width).alias("end")),
        lambda s: s["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def text_counts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words``.

    A word is a run of characters other than space and tab to carriage return. A null text has
    no words and no lines. ``n_lines`` counts the lines with a word.
    """
    text = null_to_empty(F.col(text_col))
    df = docs.select(*keep, text.alias("body")).select(
        *keep,
        F.filter(F.split("body", BLANKS), lambda w: w != "").alias("words"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"),
        F.length(F.regexp_replace("body", BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    return _repeated_windows(df).select(
        *keep, F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), "n_repeat_words")


def base_failed() -> Column:
    """Under 20 words, or over 30 % of the words in repeated windows."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def bins(counts: DataFrame) -> DataFrame:
    """One row for each document that passes the base rules and measure: the bin of its value."""
    value = lambda part, of, scale, top: F.least(
        F.expr(f"{part} * {scale} div greatest({of}, 1)"), F.lit(top).cast("long"))
    return counts.filter(~base_failed()).select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), value(*spec).alias("bin"))
        for name, spec in MEASURES.items()])).alias("m")).select("lang", "source", "m.*")


def _of_measure(place: int) -> Column:
    """An entry of ``RANKS`` for the row's measure."""
    pairs = [F.lit(x) for name, spec in RANKS.items() for x in (name, spec[place])]
    return F.element_at(F.create_map(*pairs), F.col("measure")).cast("long")


def _ranks(sketch: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """Rows, low and high rank of each measure of the groups ``by``: ``name_n, name_low, name_high``.

    A rank is the first bin with its share of the rows below or in it. Sketches of a group add up to
    those of its language and of the corpus.
    """
    keys = (*by, "measure")
    merged = sketch.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = merged.select("*", F.sum("n").over(upto).alias("below"), F.sum("n").over(group).alias("total"))
    rank = lambda place: F.min(F.when(
        F.col("below") * 100 >= F.col("total") * _of_measure(place), F.col("bin")))
    return summed.groupBy(*keys).agg(F.max("total").alias(f"{name}_n"), rank(0).alias(f"{name}_low"),
                                     rank(1).alias(f"{name}_high"))


def fences(counts: DataFrame) -> DataFrame:
    """``lang, source`` and a lowest and highest bin for each measure.

    Histograms are added up within each task before they are shuffled, so a hot source sends as
    few rows as any other, and a group has at most as many rows as there are bins; they are staged,
    so languages and the corpus are added up from them and not from texts. Ranks of a group are
    averaged with its language's, and those with the corpus's, weighted by rows: a group of few texts
    is judged by its language, a large one by itself.
    """
    sketch = stage(bins(counts).groupBy("lang", "source", "measure", "bin").agg(
        F.count(F.lit(1)).alias("n")), "sketch")
    own, corpus = _ranks(sketch, ("lang", "source"), "own"), _ranks(sketch, (), "corpus")
    language = _ranks(sketch, ("lang",), "lang").join(corpus, "measure").select(
        F.col("lang").alias("of_lang"), F.col("measure").alias("of_measure"), *[
            F.expr(f"(lang_n * lang_{side} + {PRIOR} * corpus_{side}) div (lang_n + {PRIOR})").alias(f"parent_{side}")
            for side in ("low", "high")])
    drawn = own.join(language, F.col("lang").eqNullSafe(F.col("of_lang"))
                     & (F.col("measure") == F.col("of_measure"))).select("lang", "source", "measure", *[
        F.expr(f"(own_n * own_{side} + {PRIOR} * parent_{side}) div (own_n + {PRIOR})").alias(side)
        for side in ("low", "high")])
    spread = F.greatest(F.col("high") - F.col("low"), _of_measure(3))
    bounds = drawn.withColumn("reach", spread * _of_measure(2)).select(
        "lang", "source", "measure", F.expr("low - reach div 2").alias("low"),
        F.expr("high + reach div 2").alias("high"))
    return bounds.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{name}_{side}")
        for name in MEASURES for side in ("low", "high")])


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for every row.

    A text is kept if it passes the base rules and every measure lies within the fences of its
    language and source. Null languages and sources are groups like any other; a null text fails.
    A language or source of one text is judged by its parent and itself, see :data:`PRIOR`.
    Repeated rows count each. Counts are staged, so texts are read once.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    counts = stage(text_counts(named, keep=("doc_id", "lang", "source")), "counts")
    limits = fences(counts)
    both = counts.alias("c").join(
        limits.alias("f"), F.col("c.lang").eqNullSafe(F.col("f.lang"))
        & F.col("c.source").eqNullSafe(F.col("f.source")), "left")
    inside = ~base_failed()
    for name, (part, of, scale, top) in MEASURES.items():
        value = F.least(F.expr(f"{part} * {scale} div greatest({of}, 1)"), F.lit(top).cast("long"))
        inside &= F.coalesce(value.between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(False))
    return both.select("doc_id", *COUNTS, base_failed().alias("base_failed"), inside.alias("kept"))


def _sql() -> str:
    value = {name: f"least(({part} * {scale}) // greatest({of}, 1), {top})"
             for name, (part, of, scale, top) in MEASURES.items()}
    union = " UNION ALL ".join(
        f"SELECT lang, source, '{n}' AS measure, {v} AS bin FROM based WHERE NOT base_failed"
        for n, v in value.items())
    spec = ", ".join(f"('{n}', {lo}, {hi}, {halves}, {least})" for n, (lo, hi, halves, least) in RANKS.items())

    def ranks(keys: str) -> str:
        return (f"SELECT {keys}, count(*) AS n, min(bin) FILTER (place * 100 >= n_all * lo) AS low, "
                f"min(bin) FILTER (place * 100 >= n_all * hi) AS high FROM (SELECT *, "
                f"row_number() OVER (PARTITION BY {keys} ORDER BY bin) AS place, "
                f"count(*) OVER (PARTITION BY {keys}) AS n_all FROM vals JOIN spec USING (measure)) GROUP BY {keys}")

    def drawn(own: str, parent: str) -> str:
        return ", ".join(f"({own}.n * {own}.{side} + {PRIOR} * {parent}.{side}) // ({own}.n + {PRIOR}) AS {side}"
                         for side in ("low", "high"))
    inside = " AND ".join(
        f"coalesce(({v}) BETWEEN max(low) FILTER (measure = '{n}') AND max(high) FILTER (measure = '{n}'), false)"
        for n, v in value.items())
    return rf"""
WITH docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM docs),
spots AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM cut WHERE len(words) >= 8),
wins AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM spots),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS w FROM wins WHERE n >= 2),
reps AS (SELECT doc_id, count(*) AS n_repeat_words FROM hit GROUP BY doc_id),
counts AS (SELECT c.doc_id, lang, source, len(words)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM cut c LEFT JOIN reps USING (doc_id)),
based AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM counts),
vals AS ({union}),
spec(measure, lo, hi, halves, least_spread) AS (VALUES {spec}),
own AS ({ranks("lang, source, measure")}), whole AS ({ranks("measure")}),
lang_own AS ({ranks("lang, measure")}),
lang_all AS (SELECT l.lang, l.measure, {drawn("l", "w")} FROM lang_own l JOIN whole w USING (measure)),
mixed AS (SELECT o.lang, o.source, o.measure, {drawn("o", "p")} FROM own o
          JOIN lang_all p ON o.measure = p.measure AND o.lang IS NOT DISTINCT FROM p.lang),
lim AS (SELECT lang, source, measure, low - greatest(high - low, least_spread) * halves // 2 AS low,
        high + greatest(high - low, least_spread) * halves // 2 AS high FROM mixed JOIN spec USING (measure))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside} AS kept
FROM based b LEFT JOIN lim l ON b.lang IS NOT DISTINCT FROM l.lang AND b.source IS NOT DISTINCT FROM l.source
GROUP BY doc_id, b.lang, b.source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed
"""


SQL = _sql()
