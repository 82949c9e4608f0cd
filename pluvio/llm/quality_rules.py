"""Quality rules: a threshold table compiled into one Spark projection.

Every statistic is a native column expression over one document, so a table of
rules costs one pass and no shuffle. Repeated three-word windows are found by
sorting the document's own window hashes, which stays n log n on very long
texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_letters, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on with as be by at this from or an are not which "
    "der die das und in von zu den mit ist im des auf für ein eine dem nicht als auch es an werden "
    "de la le et les des en un une du que est pour dans qui par sur au plus il ne se ce pas "
    "el los las y del se por con una su para al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject a document whose ``ratio`` (a statistic over its words, lines or
    characters) lies outside ``[low, high]``; documents under ``min_words`` are
    left to the base rule."""

    name: str
    ratio: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: name, ratio, lower and upper bound. Bounds are wide: ordinary prose of any
#: length stays far inside, so only text of another kind is rejected.
RULES = (
    Rule("mean word length", "word_length", 2.0, 12.0),
    Rule("symbols per word", "symbol_ratio", None, 0.25),
    Rule("stop words", "stop_ratio", 0.02, None),
    Rule("capital letters", "capital_ratio", None, 0.7),
    Rule("repeated lines", "duplicate_line_ratio", None, 0.6),
    Rule("separators per word", "bar_ratio", None, 0.25),
)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def base_columns(text: Column) -> dict[str, Column]:
    """Statistics as native expressions over helper columns ``_words``, ``_lines``."""
    return {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(_without(text, SPACES)).cast("long"),
        "n_symbols": _occurrences(text, SYMBOLS),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }


def repeated_window_words(words: str) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Windows are hashed; if all hashes differ, nothing repeats. Otherwise the
    (hash, position) pairs are sorted, positions with an equal neighbour kept,
    and the union of the three-word intervals at these positions is measured.
    """
    return F.expr(f"""
      CASE WHEN size({words}) < 4 THEN 0L ELSE
        aggregate(
          array(transform(sequence(0, size({words}) - 3),
                i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))),
          0L, (zero, hashes) ->
            CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN 0L ELSE
              aggregate(
                array(sort_array(transform(hashes, (h, i) -> struct(h AS h, i AS i)))),
                0L, (zero2, s) ->
                  aggregate(
                    sort_array(transform(
                      filter(transform(s, (x, k) ->
                        CASE WHEN (k > 0 AND s[greatest(k - 1, 0)].h = x.h)
                               OR (k < size(s) - 1 AND s[least(k + 1, size(s) - 1)].h = x.h)
                             THEN x.i ELSE -1 END), p -> p >= 0), p -> p)),
                    named_struct('n', 0L, 'last', -3),
                    (acc, p) -> named_struct('n', acc.n + least(3, p - acc.last), 'last', p),
                    acc -> acc.n))
            END)
      END""")


def text_statistics(docs: DataFrame) -> DataFrame:
    """The whole input row as ``_row`` plus all statistics and ratios."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    d = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text.alias("text"),
        F.filter(F.split(spaced, " "), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACES)) > 0).alias("_lines"))
    d = d.select("*", *[c.alias(n) for n, c in base_columns(F.col("text")).items()],
                 repeated_window_words("_words").alias("n_repeat_words"),
                 F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
                 _occurrences(F.col("text"), ascii_uppercase).alias("n_capitals"),
                 _occurrences(F.col("text"), ascii_letters).alias("n_letters"),
                 _occurrences(F.col("text"), "|").alias("n_bars"))
    n = F.nullif(F.col("n_words").cast("double"), F.lit(0.0))
    lines = F.nullif(F.size("_lines").cast("double"), F.lit(0.0))
    stats = d.select("_row", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / n).alias("word_length"),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("n_stop_words") / n).alias("stop_ratio"),
        (F.col("n_capitals") / F.nullif(F.col("n_letters").cast("double"), F.lit(0.0))).alias("capital_ratio"),
        (F.col("n_bars") / n).alias("bar_ratio"),
        (F.col("n_dup_lines") / lines).alias("duplicate_line_ratio")).alias("s"))
    # a one-row generator: filters on the results stay above it instead of being
    # rewritten into a second evaluation of the statistics
    return stats.select("_row", F.inline(F.array("s")))


def _occurrences(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(_without(text, chars))).cast("long")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True if no rule rejects; a ratio without words or lines rejects nothing."""
    ok = F.lit(True)
    for r in rules:
        x = F.col(r.ratio)
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (x < r.low)
        if r.high is not None:
            bad = bad | (x > r.high)
        ok = ok & ~F.coalesce(bad & (F.col("n_words") >= r.min_words), F.lit(False))
    return ok


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """:func:`text_statistics` with ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (text_statistics(docs).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, statistics, ``base_failed``, ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in
    repeated three-word windows. ``kept``: not failed and no rule rejects.
    Null text has no words and fails; null or repeated ``doc_id`` rows are kept
    as rows; other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    return judged(docs, rules).select("_row.doc_id", "*").drop("_row")


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that the rules keep."""
    return judged(docs, rules).where("kept").select("_row.*")


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB SQL, windows compared as text."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    bad = []
    for r in rules:
        parts = [f"{r.ratio} < {r.low}"] if r.low is not None else []
        parts += [f"{r.ratio} > {r.high}"] if r.high is not None else []
        bad.append(f"coalesce(({' OR '.join(parts)}) AND n_words >= {r.min_words}, false)")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
    c AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
    v AS (SELECT r, count(DISTINCT i + k) AS n FROM c, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                 coalesce(v.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
                 len(list_filter(ws, lambda x: x IN ({stop}))) AS n_stop,
                 length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_up,
                 length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_let,
                 length(regexp_replace(t, '[^|]', '', 'g')) AS n_bar
          FROM w LEFT JOIN v USING (r)),
    q AS (SELECT *, word_chars / nullif(n_words, 0)::DOUBLE AS word_length,
                 n_symbols / nullif(n_words, 0)::DOUBLE AS symbol_ratio,
                 n_stop / nullif(n_words, 0)::DOUBLE AS stop_ratio,
                 n_up / nullif(n_let, 0)::DOUBLE AS capital_ratio,
                 n_bar / nullif(n_words, 0)::DOUBLE AS bar_ratio,
                 n_dup_lines / nullif(n_lines, 0)::DOUBLE AS duplicate_line_ratio,
                 n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept FROM q"""
