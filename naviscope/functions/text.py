"""Text cleaning as native column expressions, plus their SQL names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from naviscope.schemas import MISSING_TOKENS, RISK_CODES

# What `to_numeric` deletes (case ignored) before parsing.
NUMERIC_NOISE = r"(?i)(Rs[ ]*\.)|[^\d|.|-]|(Rank[ ]*)"


# Unicode white space, with the four separators that Java's class leaves out.
WHITE = r"[\s\x1c-\x1f]"


def _col(x):
    return x if isinstance(x, Column) else F.col(x)


def to_numeric_sql(x):
    """SQL text of `to_numeric` for the SQL expression `x`."""
    noise = NUMERIC_NOISE.replace("\\", "\\\\")
    return f"try_cast(regexp_replace({x}, '{noise}', '') AS DOUBLE)"


def encode_risk_sql(x):
    """SQL text of `encode_risk` for the SQL expression `x`."""
    pairs = ", ".join(f"'{k}', {v}" for k, v in RISK_CODES.items())
    return f"coalesce(try_element_at(map({pairs}), upper({x})), 0)"


def to_numeric(x) -> Column:
    """Text to double; null when what is left after cleaning is no number."""
    return F.regexp_replace(_col(x), NUMERIC_NOISE, "").try_cast("double")


def encode_risk(x) -> Column:
    """Risk text to its code 1..5, ignoring case but not blanks; else 0."""
    codes = F.create_map(*[F.lit(v) for pair in RISK_CODES.items() for v in pair])
    return F.coalesce(F.try_element_at(codes, F.upper(_col(x))), F.lit(0))


def null_missing(x, tokens=MISSING_TOKENS) -> Column:
    """Null for any of the missing-value tokens, else the text unchanged."""
    x = _col(x)
    return F.when(~strip(x).isin(*tokens), x)


def missing_to_zero(x) -> Column:
    """Parsed number, 0 where missing or unparsable."""
    return F.coalesce(to_numeric(x), F.lit(0.0))


def zero_fill(x) -> Column:
    return F.coalesce(_col(x).cast("double"), F.lit(0.0))


def strip(x) -> Column:
    """Trim any Unicode whitespace, line ends included."""
    return F.regexp_replace(_col(x), rf"(?U)^{WHITE}+|{WHITE}+$", "")


def collapse_spaces(x) -> Column:
    """Runs of whitespace to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(_col(x), rf"(?U){WHITE}+", " "))


def short_name(x) -> Column:
    """Collapsed text before the first hyphen."""
    return F.trim(F.substring_index(collapse_spaces(x), "-", 1))


def before_last_paren(x) -> Column:
    return F.regexp_extract(F.when(F.instr(_col(x), "(") > 0, _col(x)), r"(?s)^(.*)\(", 1)


def between_parens(x) -> Column:
    """Text between the first `(` and the last `)`, null without a pair."""
    pattern = r"(?s)\((.*)\)"
    return F.when(_col(x).rlike(pattern), F.regexp_extract(_col(x), pattern, 1))


def split_fields(x, delimiter=";") -> Column:
    """Delimited line to an array of trimmed fields."""
    return F.transform(F.split(_col(x), f"\\Q{delimiter}\\E", -1), strip)


def url_shortcode(x) -> Column:
    return F.substring_index(_col(x), "/", -1)


def absolute_url(root, x) -> Column:
    return F.concat(F.lit(root), _col(x))


def is_blank(x) -> Column:
    return ~_col(x).rlike(r"(?U)[^\s\x1c-\x1f]")


def is_marker(x, delimiter=";") -> Column:
    """A line without the delimiter carries section context, not data."""
    return F.instr(_col(x), delimiter) == 0


def unescape(x) -> Column:
    """The named HTML entities that occur in plain labels."""
    x = _col(x)
    # Fixed values; the ampersand comes last so that no entity is made anew.
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def register_sql(spark):
    """Offer `encode_risk` and `to_numeric` to SQL, without a Python worker."""
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    spark.sql(f"{create} encode_risk(x STRING) RETURNS INT RETURN {encode_risk_sql('x')}")
    spark.sql(f"{create} to_numeric(x STRING) RETURNS DOUBLE RETURN {to_numeric_sql('x')}")
