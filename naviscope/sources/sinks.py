"""Delimited text output. An empty field stands for missing and empty text alike."""


# Blanks inside fields are data, and a quote inside a field is doubled.
FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_delimited(df, path, columns=None, delimiter=";", mode="error"):
    """Header and all rows, columns in the given order, one file per partition."""
    out = df.select(*[f"`{c}`" for c in columns]) if columns else df
    out.write.mode(mode).options(**FORMAT).option("sep", delimiter).csv(path)


def read_delimited(spark, path, schema, delimiter=";"):
    return spark.read.schema(schema).options(**FORMAT).option("sep", delimiter).csv(path)
