"""Quality rules: fixed base rules, then fences learned from the documents themselves.

Everything runs as DataFrame expressions. A document's measures come from array functions
inside its row, so no word is shuffled. Their distribution is kept as a mergeable sketch
per language and source: counts of log-linear buckets (32 per power of two, so a quantile
is off by 3 % at most). Sketches of sources add up to one of the language and to one of
everything; a source of few documents takes its fences from there. Fences of word lengths
come first; those of the other measures are learned from the documents within them, so
that what is odd in one respect does not set the scale of the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from paperloom.llm.staging import staged, unused

GAP = r"[\x20\x09-\x0D]+"
NO_SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Measures that fences are set for. Word lengths are hundredths of a character, the others
#: thousandths. Of the first, both ends are odd; of the others, the upper one.
SPREAD_MEASURE = "word_length"
UPPER_MEASURES = ["symbols", "dup_lines", "repeats"]
MEASURES = [SPREAD_MEASURE, *UPPER_MEASURES]
#: The fences of the first lie so many interquartile ranges, one bucket at least, outside the quartiles.
SPREAD = 3
#: The fence of the others is so many times this percentile, and one bucket on top.
FACTOR = 4
PERCENTILE = 99
#: A sketch of fewer documents is merged with those of its whole language.
LEAST_DOCUMENTS = 200

Body = Callable[[Column], Column]


def _let(value: Column, body: Body) -> Column:
    """body(value), with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(words: Column) -> Column:
    """A 64-bit hash of every window of three words."""
    def of(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    return _let(words, of)


def _repeated_places(windows: Column) -> Column:
    """Places of the windows found more than once, in order.

    Sorted by (hash, place), equal windows are neighbours.
    """
    def of(pairs: Column) -> Column:
        found = F.filter(pairs, lambda x, k: (
            F.get(pairs, k - 1)["h"].eqNullSafe(x["h"]) | F.get(pairs, k + 1)["h"].eqNullSafe(x["h"])))
        return F.sort_array(F.transform(found, lambda x: x["i"]))
    return _let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of)


def _covered(places: Column) -> Column:
    """Words covered by windows that begin at the places."""
    def of(at: Column) -> Column:
        steps = F.transform(at, lambda i, k: F.coalesce(F.least(F.lit(3), F.get(at, k + 1) - i), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)
    return _let(places, of)


def _repeat_words(words: Column) -> Column:
    none = F.lit(0).cast("long")
    some = _let(_windows(words), lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), _covered(_repeated_places(w))).otherwise(none))
    return F.when(F.size(words) < 4, none).otherwise(some)


def _counts(text: Column) -> Column:
    """The base counts of a text as one struct."""
    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    words = F.array_remove(F.split(text, GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        _let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
        F.length(F.regexp_replace(text, NO_SYMBOLS, "")).cast("long").alias("n_symbols"))


def _ratio(part: Column, whole: Column, scale: int) -> Column:
    return F.when(whole > 0, F.floor(scale * part / whole)).otherwise(F.lit(0).cast("long"))


def _measures(counts: Column) -> Column:
    """Counts, the base verdict and the measures as one flat struct."""
    def of(c: Column) -> Column:
        n_words, word_chars, repeats = c["w"]["n_words"], c["w"]["word_chars"], c["w"]["n_repeat_words"]
        failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
        return F.struct(
            n_words.alias("n_words"), word_chars.alias("word_chars"), c["n_symbols"].alias("n_symbols"),
            c["l"]["n_dup_lines"].alias("n_dup_lines"), repeats.alias("n_repeat_words"), failed.alias("base_failed"),
            _ratio(word_chars, n_words, 100).alias("word_length"),
            _ratio(c["n_symbols"], word_chars, 1000).alias("symbols"),
            _ratio(c["l"]["n_dup_lines"], c["l"]["n_lines"], 1000).alias("dup_lines"),
            _ratio(repeats, n_words, 1000).alias("repeats"))
    return _let(counts, of)


def measure(df: DataFrame, text_col: str = "text", into: str = "rules") -> DataFrame:
    """Add a struct column: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, and the measures that fences are set for.

    Null and empty texts have no words and fail the base rules. Every row is measured by
    itself, so repeated rows and ids do not matter. A column called like `into` is replaced.
    """
    return df.withColumn(into, _measures(_counts(F.coalesce(F.col(text_col), F.lit("")))))


def _bucket(value: str) -> Column:
    """Log-linear bucket of a value: its highest bit and the five bits below it."""
    bit = f"cast(floor(log2({value}) + 1e-9) as int)"
    return F.expr(f"case when {value} < 32 then {value} else {bit} * 32 + (shiftright({value}, {bit} - 5) & 31) end")


def _bucket_start(bucket: str) -> Column:
    return F.expr(f"case when {bucket} < 32 then {bucket} "
                  f"else shiftleft(32L + ({bucket} & 31), cast({bucket} div 32 as int) - 5) end")


def sketch(measured: DataFrame, groups: list[str], into: str = "rules", measures: list[str] = MEASURES) -> DataFrame:
    """Quantile sketch of every measure per group: (groups, measure, bucket, n).

    Only documents that pass the base rules take part. Sketches are merged by adding n.
    """
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{into}.{m}").alias("value")) for m in measures])
    rows = measured.where(~F.col(f"{into}.base_failed")).select(*groups, F.inline(each))
    return rows.groupBy(*groups, "measure", _bucket("value").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _fences(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Per group, the number of documents and a map from measure to its fences.

    A group is a row per bucket here, not per document.
    """
    merged = sketches.groupBy(*groups, "measure").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets"))

    def percentile(k: int) -> Column:
        def step(state: Column, b: Column) -> Column:
            seen = state["seen"] + b["n"]
            hit = (state["at"] < 0) & (100 * seen >= k * F.col("total"))
            return F.struct(seen.alias("seen"), F.when(hit, b["bucket"]).otherwise(state["at"]).alias("at"))
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).cast("long").alias("at"))
        return F.aggregate("buckets", start, step, lambda s: s["at"])

    found = merged.select(*groups, "measure", "total", *[percentile(k).alias(f"b{k}") for k in (25, 75, PERCENTILE)])
    found = found.select(*groups, "measure", "total", F.expr("case when b75 < 32 then 1L else shiftleft(1L, cast(b75 div 32 as int) - 5) end").alias("bucket"),
                         *[_bucket_start(f"b{k}").alias(f"q{k}") for k in (25, 75, PERCENTILE)])
    width = SPREAD * F.greatest(F.col("q75") - F.col("q25"), F.col("bucket"))
    both = F.struct((F.col("q25") - width).alias("low"), (F.col("q75") + width).alias("high"))
    upper = F.struct(F.lit(0).cast("long").alias("low"), (FACTOR * F.col(f"q{PERCENTILE}") + 1).alias("high"))
    fence = F.struct("measure", F.when(F.col("measure") == SPREAD_MEASURE, both).otherwise(upper))
    return found.groupBy(*groups).agg(
        F.max("total").alias("documents"), F.map_from_entries(F.collect_list(fence)).alias("fences"))


def _literal(row: Row | None) -> Column:
    """The fences of a row as a constant map."""
    if row is None:
        return F.lit(None).cast("map<string,struct<low:bigint,high:bigint>>")
    return F.create_map(*[x for m, (low, high) in sorted(row["fences"].items()) for x in (
        F.lit(m), F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")))])


def _within(fences: str, into: str, measures: list[str]) -> Column:
    """Whether all measures lie within the fences of a map; not if it has none for them."""
    inside = F.lit(True)
    for m in measures:
        fence = F.element_at(fences, m)
        inside = inside & F.coalesce(F.col(f"{into}.{m}").between(fence["low"], fence["high"]), F.lit(False))
    return inside


def _with(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows with the fences chosen for their group."""
    return df.join(chosen, F.col("_lang").eqNullSafe(F.col("_t_lang")) & F.col("_source").eqNullSafe(F.col("_t_source")), "left")


def _chosen(groups: DataFrame, sketches: DataFrame) -> DataFrame:
    """The fences of every group (_lang, _source): from its own sketch if that has
    LEAST_DOCUMENTS, else from that of its language, else from all."""
    own = _fences(sketches, ["_lang", "_source"]).select(
        F.col("_lang").alias("_o"), F.col("_source").alias("_s"), F.col("documents").alias("_do"), F.col("fences").alias("_fo"))
    lang = _fences(sketches, ["_lang"]).select(
        F.col("_lang").alias("_l"), F.col("documents").alias("_dl"), F.col("fences").alias("_fl"))
    every = _fences(sketches.withColumn("_all", F.lit(1)), ["_all"]).first()  # a pair of numbers per measure
    joined = (groups.join(own, F.col("_lang").eqNullSafe(F.col("_o")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
              .join(lang, F.col("_lang").eqNullSafe(F.col("_l")), "left").withColumn("_fa", _literal(every)))
    chosen = (F.when(F.col("_do") >= LEAST_DOCUMENTS, F.col("_fo"))
              .when(F.col("_dl") >= LEAST_DOCUMENTS, F.col("_fl")).otherwise(F.col("_fa")))
    return joined.select(F.col("_lang").alias("_t_lang"), F.col("_source").alias("_t_source"), chosen.alias("_fences"))


def thresholds(measured: DataFrame, into: str = "rules", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Fences of every (lang, source) among the documents that pass the base rules:
    (_t_lang, _t_source, _fences).

    Learned from the group itself if it has LEAST_DOCUMENTS, else from its language, else
    from everything; the upper fences from those of its documents whose word lengths are
    within theirs. A null language or source is a group like any other.
    """
    keyed = measured.select(F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), into)
    lengths = staged(sketch(keyed, ["_lang", "_source"], into, [SPREAD_MEASURE]), "quality-sketch")
    groups = lengths.select("_lang", "_source").distinct()
    first = staged(_chosen(groups, lengths), "quality-fences")
    inside = _with(keyed.where(~F.col(f"{into}.base_failed")), first).where(_within("_fences", into, [SPREAD_MEASURE]))
    rest = staged(sketch(inside, ["_lang", "_source"], into, UPPER_MEASURES), "quality-sketch")
    second = _chosen(groups, rest).withColumnsRenamed({"_t_lang": "_lang", "_t_source": "_source", "_fences": "_upper"})
    both = F.map_concat("_fences", F.coalesce("_upper", F.create_map().cast("map<string,struct<low:bigint,high:bigint>>")))
    return _with(second, first).select("_t_lang", "_t_source", both.alias("_fences"))


def judge(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    into: str = "rules", keep_columns: list[str] | None = None,
) -> DataFrame:
    """The rows of `df` (or their `keep_columns`) with the struct `into`: base counts,
    base_failed, measures and kept.

    kept is true if the base rules pass and every measure lies within the fences of its
    language and source. Rows keep their multiplicity, ties and repeated ids included; an
    empty table gives an empty result. `into` replaces a column of that name; columns
    `_lang`, `_source` and those beginning with `_t_` are reserved.
    """
    measured = measure(df, text_col, into)
    if keep_columns is not None:
        measured = measured.select(*dict.fromkeys([*keep_columns, lang_col, source_col, into]))
    measured = staged(measured, "quality-measures")
    joined = measured.join(
        thresholds(measured, into, lang_col, source_col),
        F.col(lang_col).eqNullSafe(F.col("_t_lang")) & F.col(source_col).eqNullSafe(F.col("_t_source")), "left")
    kept = ~F.col(f"{into}.base_failed") & _within("_fences", into, MEASURES)
    return joined.withColumn(into, F.struct(f"{into}.*", kept.alias("kept"))).select(*measured.columns)


def keep_good(df: DataFrame, **columns: str) -> DataFrame:
    """The rows of `df` that the rules keep, with the columns they came with, one called
    like a column of ours included. Null and empty texts fail the rules; repeated rows stay
    as often as they are kept, and an empty table stays empty."""
    (into,) = unused(df, "_rules")
    return judge(df, into=into, **columns).where(F.col(f"{into}.kept")).select(*df.columns)
