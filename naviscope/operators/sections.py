"""Section context of sectioned text: scheme type and family of each data line.

Marker lines carry context for the data lines below them. In a run of markers
numbered k = 1, 2, ... every even k sets the type to the marker before it, and
the last marker is the family. Sections may cross chunk borders, so each chunk
is solved for both parities of the run it may continue, and a scan over one
summary row per chunk picks the right one.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.functions import text
from naviscope.operators.scan import with_place
from naviscope.schemas import DERIVED_HEADINGS


def _inside_chunks(df, order, line, marker, headings):
    """Per line: the family and both candidate types known inside its chunk."""
    w = Window.partitionBy("__at").orderBy(*order)
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.select(
        "*",
        F.row_number().over(w).alias("__n"),
        F.lag(line).over(w).alias("__previous"),
        *([F.first(line).over(sofar).alias("__first")] if headings else []),
        F.sum(F.col(marker).cast("int")).over(sofar).alias("__markers"),
    )
    df = df.withColumn(
        "__closed", F.last(F.when(~F.col(marker), F.col("__markers")), ignorenulls=True).over(sofar)
    )
    k = F.col("__markers") - F.coalesce("__closed", F.lit(0))
    leading = F.col("__closed").isNull()
    k_odd = k + leading.cast("int")
    as_type = F.struct(F.col("__previous").alias("text"), (F.col("__n") == 1).alias("inherit"))
    return df.select(
        "*",
        F.last(F.when(F.col(marker), F.col(line)), ignorenulls=True).over(sofar).alias("__family"),
        F.last(F.when(F.col(marker) & (k % 2 == 0), as_type), ignorenulls=True)
        .over(sofar)
        .alias("__type_even"),
        F.last(F.when(F.col(marker) & (k_odd % 2 == 0), as_type), ignorenulls=True)
        .over(sofar)
        .alias("__type_odd"),
    )


def _resolve(odd, family_in, type_in):
    """The type, given the parity of the run open at the chunk's start."""
    found = F.when(odd, F.col("__type_odd")).otherwise(F.col("__type_even"))
    return (
        F.when(found.isNull(), type_in)
        .when(found["inherit"], family_in)
        .otherwise(found["text"])
    )


def _across_chunks(local, keys, chunk, headings):
    """Per chunk: the context in force just before its first line."""
    kept = ["__family", "__type_even", "__type_odd", *(["__first"] if headings else [])]
    ends = local.groupBy("__at").agg(
        F.max("__n").alias("lines"),
        F.max("__markers").alias("markers"),
        F.max("__closed").alias("closed"),
        F.max_by(F.struct(*kept), "__n").alias("end"),
    ).select("*", "__at.*", "end.*")
    w = Window.partitionBy(*keys).orderBy(chunk)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("seen", F.coalesce(F.sum("markers").over(before), F.lit(0)))
    ends = ends.withColumn(
        "shut",
        F.coalesce(F.last(F.col("seen") + F.col("closed"), ignorenulls=True).over(before), F.lit(0)),
    )
    ends = ends.withColumn("odd", (F.col("seen") - F.col("shut")) % 2 == 1)
    ends = ends.withColumn("family_in", F.last("__family", ignorenulls=True).over(before))
    own_type = _resolve(F.col("odd"), F.col("family_in"), F.lit(None).cast("string"))
    ends = ends.withColumn("own_type", own_type)
    first = []
    if headings:
        line = F.first("__first").over(w.rowsBetween(Window.unboundedPreceding, 0))
        first = [headings(line).alias("headings")]
    return ends.select(
        "__at",
        *first,
        F.col("odd").alias("__odd"),
        F.col("family_in").alias("__family_in"),
        F.last("own_type", ignorenulls=True).over(before).alias("__type_in"),
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("__lines_before"),
    )


def add_section_context(df, keys, chunk, order, line, marker, headings=None):
    """Add `section_type`, `section_family` and `line_no` (from 0) to every line.

    `marker` is a boolean column, `line` is read where it is true; `chunk` bounds the rows one task sorts. Both
    context columns are null before the first header of their kind. `headings`
    maps the key's first line to an extra column of that name; it is worked
    out once per chunk.
    """
    # Without the bare key columns both uses of `local` need the same columns, so
    # that Spark shuffles the lines once for both.
    placed = with_place(df, *keys, chunk).drop(*keys, chunk)
    local = _inside_chunks(placed, order, line, marker, headings)
    joined = local.join(_across_chunks(local, keys, chunk, headings), "__at")
    own = [F.col(f"__at.{c}").alias(c) if c in (*keys, chunk) else c for c in df.columns]
    return joined.select(
        *own,
        *(["headings"] if headings else []),
        (F.col("__lines_before") + F.col("__n") - 1).alias("line_no"),
        _resolve(F.col("__odd"), F.col("__family_in"), F.col("__type_in")).alias("section_type"),
        F.coalesce("__family", "__family_in").alias("section_family"),
    )


def with_context(lines, delimiter=";"):
    """Feed lines (file, block, pos, line) without blanks, each with its context.

    The header is line 0 of its file; it counts as a data line, which is what
    ends a run of markers, so it does not disturb the numbering.
    """
    kept = lines.filter(~text.is_blank("line")).withColumn("line", text.strip("line"))
    marked = kept.withColumn(
        "is_marker", text.is_marker("line", delimiter)
    )
    return add_section_context(
        marked,
        ["file"],
        "block",
        ["pos"],
        "line",
        "is_marker",
        headings=lambda first: text.split_fields(first, delimiter),
    )


def split_rows(sectioned, delimiter=";"):
    """(data rows, rejects): lines split into `fields` to match their `headings`.

    A row whose field count differs from its file's heading count is rejected
    instead of being shifted under the wrong headings.
    """
    data = sectioned.filter(~F.col("is_marker") & (F.col("line_no") > 0))
    data = data.withColumn("fields", text.split_fields("line", delimiter))
    fits = F.size("fields") == F.size("headings")
    return data.filter(fits), data.filter(~fits)


def zip_headings(rows, names):
    """One string column per heading in `names`, null where a file lacks it; the last of equal headings counts."""
    def value(name):
        at = F.array_position(F.reverse("headings"), F.lit(name)).cast("int")
        return F.when(at > 0, F.get(F.col("fields"), F.size("headings") - at)).alias(name)

    rest = [c for c in rows.columns if c not in ("fields", "headings")]
    return rows.select(*rest, *[value(n) for n in names])


def enrich(rows, names, dimension, name_heading="Scheme Name", name_index=3, strict=False):
    """Feed columns plus the six derived ones.

    `dimension` is (family, family_id) with one row per family. A family it
    lacks gives a null id, or with `strict` an error at run time.
    """
    classification = F.col("section_type")
    short = text.short_name(F.get("fields", F.lit(name_index))).alias("__short")
    out = zip_headings(rows.withColumn("__short", short), names)
    out = out.join(dimension, F.col("section_family") == dimension["family"], "left")
    fund_id = F.col("family_id")
    if strict:
        fund_id = F.coalesce(
            fund_id, F.raise_error(F.concat_ws(" ", F.lit("unknown family:"), "section_family"))
        )
    derived = dict(
        zip(
            DERIVED_HEADINGS,
            (
                classification,
                text.before_last_paren(classification),
                text.between_parens(classification),
                F.col("section_family"),
                fund_id,
                F.col("__short"),
            ),
        )
    )
    base = [
        text.collapse_spaces(n).alias(n) if n == name_heading else F.col(f"`{n}`") for n in names
    ]
    return out.select("file", "line_no", *base, *[c.alias(n) for n, c in derived.items()])


def unmatched_families(sectioned, dimension):
    """Families the feed names but the dimension lacks, with their data rows."""
    data = sectioned.filter(~F.col("is_marker") & (F.col("line_no") > 0))
    counts = data.groupBy(F.col("section_family").alias("family")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return counts.join(dimension, "family", "left_anti")
