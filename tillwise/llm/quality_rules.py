"""Quality rules whose limits come from quantile sketches per language and source.

Each document is measured once. The sketch of a measure is a histogram over integers of which only the leading
BITS binary digits are kept, so a quantile is off by less than one part in 2**(BITS - 1). Sketches merge by
adding counts: the histogram of a language is the sum of those of its sources, whatever the order. A measure
fails beyond its quartiles by more than REACH interquartile ranges, or by the measure's least gap where the
quartiles lie closer. Groups with fewer than LEAST_GROUP documents take the limits of their language, small
languages those of the whole table. Limits are joined to the measured rows: no group is gathered anywhere.

Null texts have no words. Documents without words are counted nowhere and fail the base rule. Null languages and
sources are groups like any other. Rows that repeat a doc_id are measured each on their own; equal rows get
equal results. An empty table gives an empty result. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import durable, slices, table

WINDOW = 8  # words
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
SCALE = 10_000  # measures are ratios to the number of words, in these parts
BITS = 8
REACH = 4
LEAST_GROUP = 50
# measure: numerator, least gap beyond the quartiles, whether small values fail too
MEASURES = {
    "word_length": ("word_chars", 5_000, True),
    "symbols": ("n_symbols", 1_000, False),
    "repeated_lines": ("n_dup_lines", 500, False),
    "repeated_words": ("n_repeat_words", 3_000, False),
}
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.ones(256, bool)  # bytes that begin a character of a word
_LETTER[[*range(9, 14), 32, *range(0x80, 0xC0)]] = False


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window found twice or more; width is a power of two.

    Windows get numbers, equal ones the same: of one word first, then of twice as many each time.
    """
    n = len(words)
    if n <= width:
        return 0
    numbers: dict[bytes, int] = {}
    window = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    step = 1
    while step < width:
        if len(window) == window.max() + 1:  # all differ, so do longer ones
            return 0
        window = np.unique(window[:-step] * (n + 1) + window[step:], return_inverse=True)[1]
        step *= 2
    starts = np.flatnonzero(np.bincount(window)[window] > 1)
    cover = np.zeros(n + 1, np.int64)
    cover[starts] += 1
    cover[starts + width] -= 1
    return int(np.count_nonzero(np.cumsum(cover)))


def measured(raw: bytes | None) -> tuple[int, ...]:
    """The counts of one text, in the order of _COUNTS."""
    if not raw:
        return (0,) * len(_COUNTS)
    data = np.frombuffer(raw, np.uint8)
    words = raw.split()  # at the white space of ASCII
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        int(np.count_nonzero(_LETTER[data])),
        int(np.count_nonzero(_SYMBOL[data])),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [measured(raw) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
        counts = np.array(rows, np.int64).reshape(-1, len(_COUNTS))
        kept = [batch.column(name) for name in ("doc_id", "lang", "source")]
        yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c) for c in counts.T)], ["doc_id", "lang", "source", *_COUNTS])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each row of docs."""
    rows = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"doc_id {id_type}, lang string, source string, " + ", ".join(f"{c} bigint" for c in _COUNTS))


def ratio(measure: str) -> Column:
    """A measure of a document, as a whole number; null without words."""
    return F.expr(f"{MEASURES[measure][0]} * {SCALE} div nullif(n_words, 0)")


def sketched(rows: DataFrame) -> DataFrame:
    """lang, source, measure, value, n: the histogram of each group, values cut to their leading digits."""
    pairs = F.array(*(F.struct(F.lit(m).alias("measure"), ratio(m).alias("value")) for m in MEASURES))
    exact = rows.where("n_words > 0").select("lang", "source", F.explode(pairs).alias("pair")).select("lang", "source", "pair.*")
    cut = F.expr(f"value - value % shiftleft(1L, greatest(length(bin(value)) - {BITS}, 0))")
    return exact.groupBy("lang", "source", "measure", cut.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """group, measure, n, q1, q3: read off the sketches of a finer grouping, merged by adding counts."""
    merged = sketch.groupBy(*group, "measure", "value").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "measure")  # one row a cut value: a few thousand at most
    below = merged.withColumn("upto", F.sum("n").over(whole.orderBy("value"))).withColumn("all", F.sum("n").over(whole))
    return below.groupBy(*group, "measure").agg(
        F.max("all").alias("n"),
        F.min(F.when(F.expr("upto * 4 >= all"), F.col("value"))).alias("q1"),
        F.min(F.when(F.expr("upto * 4 >= all * 3"), F.col("value"))).alias("q3"),
    )


def limits(sketch: DataFrame) -> DataFrame:
    """lang, source and, for each measure, the least and the largest value that passes."""
    fine, by_lang, overall = quartiles(sketch, "lang", "source"), quartiles(sketch, "lang"), quartiles(sketch)

    def aside(level: DataFrame, prefix: str) -> DataFrame:
        return level.select([F.col(c).alias(f"{prefix}_{c}") for c in level.columns])

    tongue, every = aside(by_lang, "lang"), aside(overall, "all")
    joined = fine.join(tongue, fine["lang"].eqNullSafe(tongue["lang_lang"]) & (fine["measure"] == tongue["lang_measure"])).join(
        every, fine["measure"] == every["all_measure"]
    )

    def pick(quartile: str) -> Column:
        return (
            F.when(F.col("n") >= LEAST_GROUP, F.col(quartile))
            .when(F.col("lang_n") >= LEAST_GROUP, F.col(f"lang_{quartile}"))
            .otherwise(F.col(f"all_{quartile}"))
        )

    chosen = joined.select("lang", "source", "measure", pick("q1").alias("q1"), pick("q3").alias("q3"))
    columns = []
    for name, (_, gap, both) in MEASURES.items():
        own = F.col("measure") == name
        reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(gap))
        columns.append(F.max(F.when(own, F.col("q3") + reach)).alias(f"most_{name}"))
        if both:
            columns.append(F.max(F.when(own, F.col("q1") - reach)).alias(f"least_{name}"))
    return chosen.groupBy("lang", "source").agg(*columns)


def judged(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Measured rows with base_failed, the names of the failed measures, and kept."""
    bounds = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(bounds, rows["lang"].eqNullSafe(bounds["_lang"]) & rows["source"].eqNullSafe(bounds["_source"]), "left")
    failures = []
    for name, (_, _, both) in MEASURES.items():
        outside = ratio(name) > F.col(f"most_{name}")
        if both:
            outside = outside | (ratio(name) < F.col(f"least_{name}"))
        failures.append(F.when(outside, F.lit(name)))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    failed = F.concat_ws(",", *failures)
    return joined.select("doc_id", "lang", "source", *_COUNTS, base.alias("base_failed"), failed.alias("failed"), (~base & (failed == "")).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The counts, the failed rules and the verdict of each row of docs."""
    rows = durable(measures(docs))
    return judged(rows, durable(limits(durable(sketched(rows)))))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("lang", "source")


OP12_SQL = rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT *, len(words) AS n_words, list_transform(range(1, greatest(len(words) - {WINDOW - 2}, 1)), lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS win FROM split
), numbered AS (
  SELECT row_number() OVER () AS nr, * FROM windows
), places AS (
  SELECT nr, unnest(win) AS w, unnest(range(len(win))) AS place FROM numbered
), twice AS (
  SELECT nr, place, count(*) OVER (PARTITION BY nr, w) AS n FROM places
), covered AS (
  SELECT nr, count(DISTINCT place + o) AS n_repeat_words FROM twice, range({WINDOW}) AS s(o) WHERE n > 1 GROUP BY nr
), d AS (
  SELECT doc_id, lang, source, n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (nr)
), long AS (
  SELECT lang, source, m.measure, m.v - m.v % (1::BIGINT << greatest(length(bin(m.v)) - {BITS}, 0)::BIGINT) AS v FROM (
    SELECT lang, source, unnest([{", ".join(f"{{'measure': '{m}', 'v': {c} * {SCALE} // n_words}}" for m, (c, _, _) in MEASURES.items())}]) AS m
    FROM d WHERE n_words > 0)
), ranked AS (
  SELECT lang, source, measure, v,
    row_number() OVER a AS fine_r, count(*) OVER (PARTITION BY lang, source, measure) AS fine_n,
    row_number() OVER b AS lang_r, count(*) OVER (PARTITION BY lang, measure) AS lang_n,
    row_number() OVER c AS all_r, count(*) OVER (PARTITION BY measure) AS all_n
  FROM long WINDOW a AS (PARTITION BY lang, source, measure ORDER BY v), b AS (PARTITION BY lang, measure ORDER BY v), c AS (PARTITION BY measure ORDER BY v)
), fine AS (
  SELECT lang, source, measure, max(fine_n) AS n, min(v) FILTER (fine_r * 4 >= fine_n) AS q1, min(v) FILTER (fine_r * 4 >= fine_n * 3) AS q3 FROM ranked GROUP BY ALL
), tongue AS (
  SELECT lang, measure, max(lang_n) AS n, min(v) FILTER (lang_r * 4 >= lang_n) AS q1, min(v) FILTER (lang_r * 4 >= lang_n * 3) AS q3 FROM ranked GROUP BY ALL
), every AS (
  SELECT measure, min(v) FILTER (all_r * 4 >= all_n) AS q1, min(v) FILTER (all_r * 4 >= all_n * 3) AS q3 FROM ranked GROUP BY ALL
), chosen AS (
  SELECT f.lang, f.source, f.measure,
    CASE WHEN f.n >= {LEAST_GROUP} THEN f.q1 WHEN t.n >= {LEAST_GROUP} THEN t.q1 ELSE e.q1 END AS q1,
    CASE WHEN f.n >= {LEAST_GROUP} THEN f.q3 WHEN t.n >= {LEAST_GROUP} THEN t.q3 ELSE e.q3 END AS q3
  FROM fine f JOIN tongue t ON f.lang IS NOT DISTINCT FROM t.lang AND f.measure = t.measure JOIN every e ON f.measure = e.measure
), bounds AS (
  SELECT lang, source, {", ".join(
    f"max(CASE WHEN measure = '{m}' THEN q3 + greatest({REACH} * (q3 - q1), {gap}) END) AS most_{m}, max(CASE WHEN measure = '{m}' THEN q1 - greatest({REACH} * (q3 - q1), {gap}) END) AS least_{m}"
    for m, (_, gap, _) in MEASURES.items())}
  FROM chosen GROUP BY ALL
), verdict AS (
  SELECT d.*, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
    concat_ws(',', {", ".join(
    f"CASE WHEN n_words > 0 AND ({c} * {SCALE} // n_words > most_{m}" + (f" OR {c} * {SCALE} // n_words < least_{m}" if both else "") + f") THEN '{m}' END"
    for m, (c, _, both) in MEASURES.items())}) AS failed
  FROM d LEFT JOIN bounds b ON d.lang IS NOT DISTINCT FROM b.lang AND d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, {", ".join(_COUNTS)}, base_failed, failed, NOT base_failed AND failed = '' AS kept FROM verdict
"""
