"""Quality rules with adaptive thresholds, in DataFrame functions only.

Base rules fail texts of under MIN_WORDS words or with more than a fifth of their words in
repeated five-word windows. For the rest, three measures (symbols per word, mean word
length, share of repeated lines) are held against fences that each group of equal language
and source sets itself, from its mergeable KLL sketch: a fence lies as far beyond the median as
REACH times the distance from the median to an outer quantile, on either side. The less a
group has to say, the more its quantiles are those of its language, and the language's those of all
rows. A text's size and the group's add what chance allows; both shrink as these grow.
"""

from pyspark.sql import functions as F

from naviscope.llm.common import checked_join, without
from naviscope.session import materialise

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
REACH = 4
# Rows that weigh as much as those of the next wider group.
SUPPORT = 30
SKETCH_K = 1024
# Measure: its outer quantile (the share of texts beyond it that may be of any kind), and what chance adds to
# a fence: the third value, divided by the root of the text's size (the second) and by that of the group's.
MEASURES = {"symbols_per_word": (0.9, "n_words", 0.5), "word_length": (0.9, "n_words", 10.0), "repeated_lines": (0.98, "n_lines", 0.5)}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value, f):
    """`f(value)` with `value` computed once."""
    return F.transform(F.array(value), f)[0]


def repeated_words(words):
    """Words within windows that occur twice or more in the same text, each counted once."""

    def covered(windows):
        at = F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))

        def marked(s):
            same = lambda x, k: F.coalesce(x["h"] == F.get(s, k)["h"], F.lit(False))
            return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

        def total(p):
            steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        places = let(F.sort_array(at), lambda s: F.sort_array(F.transform(marked(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(places, total)).otherwise(F.lit(0).cast("long"))

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, let(windows, covered)).otherwise(F.lit(0).cast("long"))


def count_text(df):
    """`df` with the counts of its `text`; a null or empty text has no words, all counts are 0."""
    text = F.coalesce("text", F.lit(""))
    without = lambda chars: F.length(F.translate(text, chars, "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    counted = df.withColumn("_words", F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")).withColumn("_lines", lines)
    return counted.select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        without(BLANKS).alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )


def measured(documents, key):
    """Per row: `key` columns, language, source, counts, measures and the base verdict; stored."""
    rows = count_text(documents.select(*key, F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rows = rows.select(
        *[c for c in rows.columns if c != "text"],
        failed.alias("base_failed"),
        F.try_divide("n_symbols", "n_words").alias("symbols_per_word"),
        F.try_divide("word_chars", "n_words").alias("word_length"),
        F.try_divide("n_dup_lines", "n_lines").alias("repeated_lines"),
    )
    return materialise(rows, "quality-counts")


def thresholds(rows):
    """Fences per (lang, source): one row each, stored; sketches are merged upwards."""
    sketch = [F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES]
    merge = [F.kll_merge_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MEASURES]
    count = F.count(F.lit(1)).alias("n")
    groups = materialise(rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(count, *sketch), "quality-sketches")
    languages = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), *[m.alias(f"lang_{k}") for m, k in zip(merge, MEASURES)])
    whole = groups.agg(*[m.alias(f"all_{k}") for m, k in zip(merge, MEASURES)]).withColumn("one", F.lit(1))
    found = rows.select("lang", "source").distinct().withColumn("one", F.lit(1))
    groups = groups.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    languages = languages.withColumnRenamed("lang", "_language")
    found = found.join(groups, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    found = found.join(languages, F.col("lang").eqNullSafe(F.col("_language")), "left").join(F.broadcast(whole), "one", "left")
    rows_of = {"": F.coalesce("n", F.lit(0)), "lang_": F.coalesce("lang_n", F.lit(0))}

    def quantile(m, share):
        """Of the group, shrunk towards its language's, shrunk towards that of all rows."""
        out = F.kll_sketch_get_quantile_double(f"all_{m}", F.lit(share))
        for level in ("lang_", ""):
            weight = rows_of[level] / (rows_of[level] + F.lit(float(SUPPORT)))
            own = F.kll_sketch_get_quantile_double(f"{level}{m}", F.lit(share))
            out = F.when(rows_of[level] > 0, weight * own + (1 - weight) * out).otherwise(out)
        return out

    fences = []
    for m, (outer, _, chance) in MEASURES.items():
        low, middle, high = (quantile(m, p) for p in (round(1 - outer, 9), 0.5, outer))
        more = chance / F.sqrt(F.greatest(rows_of[""], F.lit(1)))
        fences += [(middle - REACH * (middle - low) - more).alias(f"low_{m}"), (middle + REACH * (high - middle) + more).alias(f"high_{m}")]
    return materialise(found.select("lang", "source", *fences), "quality-fences")


def judge(documents, key=("doc_id",)):
    """Counts and verdict of every row.

    One row per input row with the `key` columns, the counts, `base_failed` and `kept`. Null
    language or source is a group of its own; repeated rows are judged alike; rows without
    words fail; an empty table gives none; other columns are ignored.
    """
    rows = measured(documents, key)
    fences = thresholds(rows)
    renamed = fences.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    inside = ~F.col("base_failed")
    for m, (_, size, chance) in MEASURES.items():
        more = chance / F.sqrt(F.greatest(F.col(size), F.lit(1)))
        inside &= F.coalesce(F.col(m).between(F.col(f"low_{m}") - more, F.col(f"high_{m}") + more), F.lit(True))
    names = [c for c in rows.columns if c not in ("lang", "source", "n_lines", *MEASURES)]
    return checked_join(rows, renamed, on, "left").select(*names, inside.alias("kept"))


def kept_documents(documents):
    """`documents` without the rows that the rules reject; all columns stay."""
    fingerprint = F.xxhash64(*[F.col(c).cast("string") for c in ("text", "lang", "source")])
    verdicts = judge(documents.withColumn("fingerprint", fingerprint), key=("doc_id", "fingerprint"))
    rejected = materialise(verdicts.where("NOT kept").select("doc_id", "fingerprint").distinct(), "rejected")
    return without(documents, rejected, fingerprint)
