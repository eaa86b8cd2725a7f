"""Quality rules: base counts, and distance of a text's histograms from language references.

Two histograms describe a text: its characters by class, and its words by the language's ten most
common words as written in lower case (all others in one bin). Each is compared with a fixed reference by Jensen-Shannon
distance (base 2, 0 to 1). Short texts have noisy histograms, so each rule has a minimum length
below which it says nothing.

Everything is Column expressions over one row, without a shuffle. ``with_computed`` keeps an array
that a lambda reads as a value, so it is built once per row.

Cases: a null or empty text has no words and fails the base rule; an unknown or null language is
judged by character classes alone, against the mean of the references; repeated rows are judged one
by one; an empty table gives an empty result; other columns are carried on, whatever their names
(working columns start with ``__q_``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.registry import read, register
from skytally.operators.joins import with_computed

# Shares of running text by character class, from general language statistics.
CHAR_CLASSES = ("ascii_letter_lower", "ascii_letter_upper", "digit", "space", "other_ascii", "non_ascii")
CHAR_REFERENCE = {
    "en": (0.780, 0.022, 0.004, 0.168, 0.025, 0.001),
    "de": (0.762, 0.022, 0.004, 0.157, 0.025, 0.030),
    "fr": (0.720, 0.018, 0.004, 0.168, 0.026, 0.064),
    "es": (0.735, 0.019, 0.004, 0.165, 0.025, 0.052),
}
# Each language's ten most common words and their shares of running words.
WORD_REFERENCE = {
    "en": {"the": 0.060, "of": 0.035, "and": 0.026, "to": 0.021, "a": 0.018, "in": 0.015,
           "is": 0.011, "that": 0.010, "it": 0.009, "for": 0.009},
    "de": {"der": 0.055, "die": 0.036, "und": 0.027, "in": 0.020, "den": 0.016, "von": 0.013,
           "zu": 0.012, "das": 0.011, "mit": 0.009, "sich": 0.008},
    "fr": {"de": 0.060, "la": 0.035, "le": 0.026, "et": 0.020, "les": 0.017, "des": 0.014,
           "en": 0.012, "un": 0.010, "du": 0.009, "une": 0.008},
    "es": {"de": 0.060, "la": 0.035, "que": 0.026, "el": 0.020, "en": 0.017, "y": 0.014,
           "los": 0.011, "se": 0.010, "del": 0.009, "un": 0.008},
}
MIN_CHARS, MAX_CHAR_DISTANCE = 200, 0.22
MIN_WORDS, MAX_WORD_DISTANCE = 100, 0.265

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t-\\r]+"
SYMBOLS = "#*$%&|<>"


def mean_reference(table: dict[str, tuple[float, ...]]) -> tuple[float, ...]:
    return tuple(sum(column) / len(table) for column in zip(*table.values()))


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _by_language(lang: Column, arrays: dict[str, Column], otherwise: Column | None) -> Column:
    chosen = F.lit(None)
    for code, value in arrays.items():
        chosen = F.when(lang == code, value) if code == next(iter(arrays)) else chosen.when(lang == code, value)
    return chosen if otherwise is None else chosen.otherwise(otherwise)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares of equal length."""
    def term(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.ln(a / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: term(a, (a + b) / 2) + term(b, (a + b) / 2))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)) / F.lit(2 * math.log(2)))


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with the value computed once, as a lambda's argument."""
    return F.transform(F.array(value), body)[0]


FEW_REPEATS = 256


def _covered_by_repeats(words: Column) -> Column:
    """Words in three-word windows found twice or more, by hashes of the windows.

    A row's repeated hashes are found by sorting. Where they are few, each window looks itself up
    among them; else (very long or repetitive texts) the windows are sorted with their positions.
    """
    none = F.lit(0).cast("long")

    def union_length(starts: Column) -> Column:
        first = F.struct(none.alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts, first,
            lambda acc, x: F.struct(
                (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")),
            lambda acc: acc["n"])

    def by_lookup(hashes: Column, repeated: Column) -> Column:
        starts = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return union_length(F.filter(starts, lambda i: i.isNotNull()))

    def by_position(hashes: Column) -> Column:
        def starts(s: Column) -> Column:
            same = lambda k, other: F.coalesce(
                F.get(s, k)["h"] == F.get(s, other)["h"], F.lit(False))
            twins = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
            return F.sort_array(F.transform(twins, lambda k: F.get(s, k)["i"]))

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return union_length(let(pairs, starts))

    def count(hashes: Column) -> Column:
        repeated = let(F.sort_array(hashes), lambda s: F.array_distinct(
            F.filter(s, lambda h, k: h == F.get(s, k - 1))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, none)
                   .when(F.size(r) <= FEW_REPEATS, by_lookup(hashes, r)).otherwise(by_position(hashes)))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, none).otherwise(let(windows, count))


def quality_columns(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_distance,
    word_distance (null below the minimum length), base_failed and kept."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    edge = lambda c: c.isin(*SPACES)
    core = F.when(edge(F.substring(t, 1, 1)) | edge(F.substring(t, -1, 1)), F.trim(t, F.lit(SPACES))).otherwise(t)
    length = lambda c: F.length(c).cast("long")
    lines = F.filter(F.split(t, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    common = _by_language(
        F.col(f"`{lang}`"), {k: F.array(*map(F.lit, v)) for k, v in WORD_REFERENCE.items()}, None)

    def of_words(words: Column) -> Column:
        # A text without words splits into one empty piece.
        n = F.when(F.get(words, F.lit(0)) == "", 0).otherwise(F.size(words))
        hits = lambda c: F.filter(words, lambda w: F.array_contains(c, w))
        counts = let(common, lambda c: let(hits(c), lambda h: F.transform(
            F.concat(c, F.array(F.lit(None).cast("string"))),
            lambda k: F.when(k.isNull(), F.size(words) - F.size(h)).otherwise(F.size(F.filter(h, lambda w: w == k))))))
        return F.struct(
            n.cast("long").alias("n"), _covered_by_repeats(words).alias("repeated"),
            F.when((n >= MIN_WORDS) & common.isNotNull(), counts).alias("common"))

    rest = F.regexp_replace(t, "[a-z]+", "")
    rows = with_computed(docs, {
        "__q_words": let(F.split(core, SPACE_RUN), of_words),
        "__q_rest": rest,
        "__q_chars": length(t),
        "__q_dup": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    })
    rest, n_chars, of = F.col("__q_rest"), F.col("__q_chars"), F.col("__q_words")
    rows = with_computed(rows, {"__q_marks": F.translate(rest, SPACES, "")})
    marks, n = F.col("__q_marks"), of["n"]
    # Characters that are no small ASCII letter: spaces, capitals, digits, other ASCII, wide ones.
    spaces = length(rest) - length(marks)
    without = lambda pattern: length(marks) - length(F.regexp_replace(marks, pattern, ""))
    upper, digit, wide = without("[A-Z]+"), without("[0-9]+"), without("[^\\x00-\\x7F]+")
    chars = F.array(n_chars - length(rest), upper, digit, spaces, length(marks) - upper - digit - wide, wide)
    char_reference = _by_language(
        F.col(f"`{lang}`"), {k: _doubles(v) for k, v in CHAR_REFERENCE.items()},
        _doubles(mean_reference(CHAR_REFERENCE)))
    word_reference = _by_language(
        F.col(f"`{lang}`"),
        {k: _doubles([*v.values(), 1 - sum(v.values())]) for k, v in WORD_REFERENCE.items()}, None)
    rows = with_computed(rows, {
        "n_words": n,
        "word_chars": n_chars - spaces,
        "n_symbols": length(marks) - length(F.translate(marks, SYMBOLS, "")),
        "n_dup_lines": F.col("__q_dup"),
        "n_repeat_words": of["repeated"],
        "char_distance": F.when(n_chars >= MIN_CHARS, js_distance(
            F.transform(chars, lambda c: c / n_chars), char_reference)),
        "word_distance": F.when(of["common"].isNotNull(), js_distance(
            F.transform(of["common"], lambda c: c / n), word_reference)),
    })
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE)
    rows = rows.withColumns({"base_failed": base, "kept": ~(base | far)})
    return rows.drop(*[c for c in rows.columns if c.startswith("__q_")])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The key and the measures of each document."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.col(f"`{lang}`").alias("lang"))
    return quality_columns(slim).select("doc_id", *MEASURES, "char_distance", "word_distance")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"),
                         F.col(f"`{lang}`").alias("lang"))
    return quality_columns(packed).filter("kept").select("row.*")


def _sql() -> str:
    def case(table: dict[str, list[float]], otherwise: str) -> str:
        whens = " ".join(f"WHEN lang = '{k}' THEN {list(v)}" for k, v in table.items())
        return f"CASE {whens} ELSE {otherwise} END"

    chars = case(CHAR_REFERENCE, str(list(mean_reference(CHAR_REFERENCE))))
    shares = case({k: [*v.values(), 1 - sum(v.values())] for k, v in WORD_REFERENCE.items()}, "NULL")
    common = "CASE " + " ".join(
        f"WHEN lang = '{k}' THEN {list(v)}" for k, v in WORD_REFERENCE.items()) + " END"

    def distance(p: str, q: str) -> str:
        term = "CASE WHEN {a} > 0 THEN {a} * ln({a} / ((x[1] + x[2]) / 2)) ELSE 0.0 END"
        return (f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda x: "
                f"{term.format(a='x[1]')} + {term.format(a='x[2]')})), 0.0) / {2 * math.log(2)!r})")

    return f"""
WITH base AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^ \\t-\\r]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g
  FROM base WHERE len(w) >= 3),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(d) GROUP BY doc_id),
counted AS (
  SELECT b.doc_id, lang, len(w) AS n_words, length(t) AS n_chars,
         length(regexp_replace(t, '[ \\t-\\r]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_n,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_n,
         length(regexp_replace(t, '[^0-9]', '', 'g')) AS digit_n,
         length(regexp_replace(t, '[\\x00-\\x7F]', '', 'g')) AS wide_n,
         {common} AS common,
         list_filter(w, lambda x: list_contains({common}, x)) AS hits
  FROM base b LEFT JOIN covered c ON b.doc_id = c.doc_id),
shaped AS (
  SELECT *, list_transform([lower_n, upper_n, digit_n, n_chars - word_chars,
                            word_chars - lower_n - upper_n - digit_n - wide_n, wide_n],
                           lambda c: c / n_chars) AS p_chars,
         list_append(list_transform(common, lambda k: len(list_filter(hits, lambda h: h = k)) / n_words),
                     (n_words - len(hits)) / n_words) AS p_words
  FROM counted),
judged AS (
  SELECT *, CASE WHEN n_chars >= {MIN_CHARS} THEN {distance('p_chars', chars)} END AS char_distance,
         CASE WHEN n_words >= {MIN_WORDS} AND common IS NOT NULL THEN {distance('p_words', shares)} END AS word_distance,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM shaped)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(char_distance, 0) > {MAX_CHAR_DISTANCE}
            OR coalesce(word_distance, 0) > {MAX_WORD_DISTANCE}) AS kept
FROM judged"""


ORACLE = _sql()


@register("op1_quality_divergence", ORACLE)
def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read(spark, sf_dir, "documents")).select("doc_id", *MEASURES)
