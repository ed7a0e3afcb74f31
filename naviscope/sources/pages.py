"""Tables of saved web pages."""

from naviscope.schemas import TABLES


def read_pages(spark, path):
    """(page_id, url, html) of saved pages."""
    return spark.read.schema(TABLES["pages"]).parquet(path)
