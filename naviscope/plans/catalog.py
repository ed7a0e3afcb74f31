"""Every operator as a query over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from pyspark.sql import functions as F

from naviscope.functions import text
from naviscope.operators import (
    evaluate,
    extract,
    features,
    forest,
    joins,
    models,
    ranking,
    reshape,
    risk,
    sampling,
    schemes,
    similar,
    sections,
)
from naviscope.operators.scan import add_chunk, position_chunk
from naviscope.plans import binding, derived
from naviscope.plans.binding import table
from naviscope.schemas import CHOSEN_TREES, HORIZONS, NUMERIC_COLUMN_ORDER, SCHEME_SCHEMA, measure_columns
from naviscope.session import materialise, new_folder
from naviscope.sources import feed, feed_source, pages, sinks
from naviscope.streaming import feed_stream

QUERIES = {}

# Steps of the stand-in grid: a row counts as good at step n from score 0.40 + n / 100 on.
GRID = 40
REPORTED = ("scheme_name", "scheme_url", "fund_ret", *[f"ret_{h}" for h in HORIZONS])
PASSED_THROUGH = ("scheme_plan", "scheme_option", "scheme_fund_type", "scheme_benchmark", "category", "category_url")


def query(f):
    QUERIES[f.__name__] = f
    return f


def snake(name):
    return name.replace(" ", "_").lower()


# --- Pages -----------------------------------------------------------------


@query
def page_anchors(spark, sf_dir):
    found = extract.anchors(pages.read_pages(spark, f"{sf_dir}/pages.parquet"), binding.ROOT)
    return found.select("page_id", "pos", "href", "url")


@query
def page_title(spark, sf_dir):
    return extract.page_title(pages.read_pages(spark, f"{sf_dir}/pages.parquet"))


@query
def url_shortcode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_shortcode("url").alias("shortcode"))


@query
def family_options(spark, sf_dir):
    page = derived.family_dimension_page(table(spark, sf_dir, "part"))
    return extract.option_dimension(page, "MFName")


@query
def family_table(spark, sf_dir):
    page = derived.family_pages(binding.all_families(spark, sf_dir))
    rows = extract.family_rows(page, binding.ROOT)
    return rows.select("row_no", "family_name", "family_url", "family_aum", "family_shortcode")


@query
def scheme_table(spark, sf_dir):
    facts = binding.stored_facts(spark, sf_dir)
    listed = derived.scheme_pages(binding.schemes_text(table(spark, sf_dir, "part"), facts))
    return extract.scheme_rows(listed, binding.ROOT).drop("page_id", "row_no")


def _details(spark, sf_dir):
    # Parsing is CPU work: even shares of the rows, before they are rendered.
    wide = binding.scheme_wide(spark, sf_dir).hint("rebalance")
    return extract.parse_details(derived.detail_pages(wide))


@query
def scheme_details(spark, sf_dir):
    return extract.detail_fields(_details(spark, sf_dir))


@query
def measure_rows(spark, sf_dir):
    cells = extract.performance_rows(_details(spark, sf_dir))
    return cells.select(
        F.col("page_id").alias("scheme_idx"), "measure", "horizon", text.to_numeric("value").alias("value")
    )


@query
def performance_columns(spark, sf_dir):
    wide = extract.performance_columns(_details(spark, sf_dir))
    return wide.selectExpr(
        "page_id AS scheme_idx", *[f"{text.to_numeric_sql(c)} AS {c}" for c in measure_columns()]
    )


# --- Scalar functions ------------------------------------------------------


@query
def missing_tokens(spark, sf_dir):
    # Every text as it is (variant 0), and next to it a token or a plain value (variant 1).
    cells = None
    for name, key, cell in (("orders", "o_orderkey", "o_orderpriority"), ("events", "event_id", "props")):
        other = f"array('NA', ' N.A. ', '--', '-', 'None', '', 'value')[int({key} % 7)]"
        rows = table(spark, sf_dir, name).selectExpr(
            f"'{name}' AS source", f"{key} AS id", f"posexplode(array({cell}, {other})) AS (variant, cell)"
        )
        cells = rows if cells is None else cells.union(rows)
    return cells.select("source", "id", "variant", text.null_missing("cell").alias("cell"))


@query
def risk_codes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    orders = orders.selectExpr("o_orderkey", "substring_index(o_orderpriority, '-', -1) AS risk_text")
    return orders.select("*", text.encode_risk("risk_text").alias("risk_code"))


@query
def numeric_from_text(spark, sf_dir):
    cells = None
    for name, key, cell in (
        ("orders", "o_orderkey", "o_orderpriority"),
        ("part", "p_partkey", "p_brand"),
        ("events", "event_id", "props"),
        ("customer", "c_custkey", "c_name"),
    ):
        rows = table(spark, sf_dir, name).selectExpr(f"'{name}' AS source", f"{key} AS id", f"{cell} AS cell")
        cells = rows if cells is None else cells.union(rows)
    return cells.select("source", "id", text.to_numeric("cell").alias("value"))


@query
def sql_functions(spark, sf_dir):
    text.register_sql(spark)
    orders = table(spark, sf_dir, "orders")
    return orders.selectExpr(
        "o_orderkey",
        "encode_risk(substring_index(o_orderpriority, '-', -1)) AS risk_code",
        "to_numeric(concat('Rs. ', o_orderkey, ',', o_orderstatus)) AS value",
    )


@query
def whitespace_collapse(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse_spaces("text").alias("text"))


@query
def short_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "concat('  ', replace(p_name, ' ', ' \t  '), '  -  Growth-', p_size) AS name"
    )
    return names.select("p_partkey", text.short_name("name").alias("short_name"))


@query
def composite_split(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "if(p_size % 10 = 0, p_type, concat(p_type, ' (', p_name, ' (', p_size, '))x')) AS composite",
    )
    return rows.select(
        "p_partkey",
        text.before_last_paren("composite").alias("before"),
        text.between_parens("composite").alias("inside"),
    )


@query
def delimited_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "concat(p_name, ' ;', p_brand, '; \t', p_type, ';;', p_size, '\\r') AS line"
    )
    fields = rows.select("p_partkey", text.split_fields("line").alias("f"))
    return fields.selectExpr(
        "p_partkey", "size(f) AS n_fields", *[f"get(f, {i}) AS field_{i}" for i in range(5)]
    )


# --- Lines and sections ----------------------------------------------------


def _document_lines(spark, sf_dir):
    """Non-blank lines; a document is one row, so its lines are a bounded group."""
    lines = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", r"posexplode(split(text, '\n')) AS (pos, line)"
    )
    return lines.filter(~text.is_blank("line"))


@query
def nonblank_lines(spark, sf_dir):
    return _document_lines(spark, sf_dir)


@query
def marker_lines(spark, sf_dir):
    lines = _document_lines(spark, sf_dir)
    return lines.select("doc_id", "pos", text.is_marker("line", ",").alias("is_marker"))


@query
def section_carry_lines(spark, sf_dir):
    lines = _document_lines(spark, sf_dir).withColumn("is_marker", text.is_marker("line", ","))
    # Only marker text is asked for, so only marker text is shuffled.
    lines = lines.withColumn("line", F.when(F.col("is_marker"), F.col("line")))
    lines = lines.withColumn("chunk", position_chunk("pos"))
    out = sections.add_section_context(lines, ["doc_id"], "chunk", ["pos"], "line", "is_marker")
    return out.select("doc_id", "pos", "line_no", "section_type", "section_family")


@query
def section_carry_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "event_id",
        "if(event_type IN ('signup', 'error'), concat(event_type, '#', event_id), NULL) AS line",
        "event_type IN ('signup', 'error') AS is_marker",
    )
    # A user may own any share of the events; a chunk of ids is what a task sorts.
    events = add_chunk(events, ["user_id"], "event_id")
    out = sections.add_section_context(events, ["user_id"], "chunk", ["event_id"], "line", "is_marker")
    return out.select("user_id", "event_id", "line_no", "section_type", "section_family")


# --- Feeds -----------------------------------------------------------------


def _dimension(spark, sf_dir):
    return family_options(spark, sf_dir)


def _plain(rows):
    return rows.select(*[F.col(f"`{c}`").alias(snake(c)) for c in rows.columns if c not in ("file", "line_no")])


@query
def feed_enriched(spark, sf_dir):
    lines = feed.read_lines(spark, derived.write_feed(spark, sf_dir))
    rows, _ = feed.enriched_feed(lines, _dimension(spark, sf_dir))
    return _plain(rows)


@query
def feed_delimited(spark, sf_dir):
    lines = feed.read_lines(spark, derived.write_feed(spark, sf_dir))
    rows, _ = feed.enriched_feed(lines, _dimension(spark, sf_dir), derived.FEED_HEADINGS)
    rows = rows.drop("file", "line_no")
    path = new_folder(spark, "delimited")
    sinks.write_delimited(rows, path, rows.columns)
    return _plain(sinks.read_delimited(spark, path, rows.schema))


@query
def feed_line_numbers(spark, sf_dir):
    lines = feed.read_lines(spark, derived.write_feed(spark, sf_dir))
    context = sections.with_context(lines)
    return context.groupBy("is_marker").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("line_no").alias("sum_line_no")
    )


@query
def feed_unmatched(spark, sf_dir):
    lines = feed.read_lines(spark, derived.write_feed(spark, sf_dir))
    known = _dimension(spark, sf_dir).join(
        schemes.top_families(binding.all_families(spark, sf_dir)).select("family_name"),
        F.col("family") == F.col("family_name"),
        "left_anti",
    )
    return sections.unmatched_families(sections.with_context(lines), known)


@query
def feed_rejects(spark, sf_dir):
    """Document lines whose number of comma-separated fields is not that of the document's first line."""
    lines = table(spark, sf_dir, "documents").selectExpr("doc_id AS file", r"posexplode(split(text, '\n')) AS (pos, line)")
    lines = lines.withColumn("block", position_chunk("pos"))
    _, rejects = sections.split_rows(sections.with_context(lines, ","), ",")
    return rejects.select(
        F.col("file").alias("doc_id"), "line_no", F.size("fields").alias("n_fields"), F.size("headings").alias("n_headings")
    )


@query
def incremental_feed(spark, sf_dir):
    target, checkpoint = new_folder(spark, "ingested"), new_folder(spark, "ingest-state")
    source = derived.write_feed(spark, sf_dir)
    feed_stream.ingest(
        spark, source, target, checkpoint, _dimension(spark, sf_dir), derived.FEED_HEADINGS
    )
    return spark.read.parquet(f"{target}/rows").drop("batch", "file", "line_no")


@query
def upserted_feed(spark, sf_dir):
    """A feed, then a second one that corrects a third of its rows: one row per day and code is left."""
    target, checkpoint = new_folder(spark, "snapshots"), new_folder(spark, "upsert-state")
    part, names = table(spark, sf_dir, "part"), derived.FEED_HEADINGS
    dimension = _dimension(spark, sf_dir)
    source = derived.write_feed(spark, sf_dir)
    feed_stream.upsert(spark, source, target, checkpoint, dimension, names)
    corrected = part.filter("p_partkey % 3 = 0").withColumn("p_retailprice", F.col("p_retailprice") + 1)
    derived.write_feed(spark, sf_dir, corrected, source)
    feed_stream.upsert(spark, source, target, checkpoint, dimension, names)
    return feed_stream.read_snapshots(spark, target).drop("version")


@query
def feed_source_lines(spark, sf_dir):
    """What the feed data source reads, by many ranges a file, next to the lines of the text reader."""
    path = derived.write_feed(spark, sf_dir)
    ranged = feed_source.read_feed(spark, path, rangeBytes=4096).select("line", F.lit(1).alias("ranged"), F.lit(0).alias("plain"))
    plain = feed.read_lines(spark, path).select("line", F.lit(0).alias("ranged"), F.lit(1).alias("plain"))
    both = ranged.unionByName(plain).withColumn("line", text.strip("line"))
    return both.groupBy("line").agg(F.sum("ranged").alias("n_ranged"), F.sum("plain").alias("n_plain"))


@query
def schemes_delimited(spark, sf_dir):
    rows = binding.selected_schemes(spark, sf_dir)
    path = new_folder(spark, "schemes")
    sinks.write_delimited(rows, path, SCHEME_SCHEMA.names)
    return sinks.read_delimited(spark, path, SCHEME_SCHEMA)


# --- Joins -----------------------------------------------------------------


@query
def top_families(spark, sf_dir):
    top = schemes.top_families(binding.all_families(spark, sf_dir))
    return top.select("family_name", "family_url", "family_aum", "family_shortcode", "num_family_aum")


@query
def family_scheme_join(spark, sf_dir):
    rows = binding.selected_schemes(spark, sf_dir)
    return rows.select("scheme_idx", "scheme_name", "family_name", "family_aum", "family_shortcode")


@query
def scheme_detail_join(spark, sf_dir):
    facts = binding.stored_facts(spark, sf_dir)
    rows = binding.schemes_text(table(spark, sf_dir, "part"), facts)
    listed = rows.select("scheme_idx", "scheme_url", "scheme_name", "latest_nav")
    details = rows.select("scheme_url", "scheme_risk_text", "scheme_option", "scheme_min_investment")
    return schemes.join_details(listed, details)


def _listed_and_details(spark, sf_dir):
    """Schemes of the largest families and, as another source, what the events say of a scheme."""
    listed = binding.selected_schemes(spark, sf_dir).select("scheme_idx", "scheme_url", "scheme_name")
    details = table(spark, sf_dir, "events").selectExpr(
        f"concat('{binding.ROOT}/schemes/', user_id) AS scheme_url", "event_id", "event_type AS status", "value AS latest_value"
    )
    return joins.details_by_key(listed, details, "scheme_url", ["event_id"])


@query
def detail_sources_join(spark, sf_dir):
    return _listed_and_details(spark, sf_dir)[0]


@query
def detail_sources_exceptions(spark, sf_dir):
    return _listed_and_details(spark, sf_dir)[1]


@query
def dimension_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return joins.lookup(customers, nations, "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey", "n_name")


@query
def dimension_gaps(spark, sf_dir):
    """Every customer's last event, null for the many that have none."""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    last = extract.last_wins(table(spark, sf_dir, "events"), ["user_id"], "event_id", ["event_type"])
    return joins.lookup(customers, last, "c_custkey", "user_id").select("c_custkey", "event_type")


@query
def dimension_unmatched(spark, sf_dir):
    """Customers without any event."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.unmatched(customers, table(spark, sf_dir, "events").select("user_id"), "c_custkey", "user_id")


@query
def dimension_strict(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    found = joins.lookup(suppliers, nations, "s_nationkey", "n_nationkey", strict=True)
    return found.select("s_suppkey", "s_nationkey", "n_name")


@query
def dimension_last_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return extract.last_wins(events, ["user_id"], "event_id", ["event_type", "value"])


def _name_key(name):
    """What must be equal for two names to be taken for one."""
    return F.lower(text.short_name(name))


@query
def similar_names(spark, sf_dir):
    """The part behind each name of a feed that spells, orders and abbreviates names in its own way."""
    part = table(spark, sf_dir, "part")
    listed = part.selectExpr("p_partkey AS scheme_idx", f"{binding.SITE_NAME} AS scheme_name")
    fed = part.selectExpr("p_partkey AS code", f"{binding.FEED_NAME} AS feed_name")
    found = similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx")
    return found.select("code", "feed_name", "matched_name", "scheme_idx", "n_candidates", "edits")


@query
def name_ambiguous(spark, sf_dir):
    top = schemes.top_families(binding.all_families(spark, sf_dir)).select("family_name")
    listed = table(spark, sf_dir, "part").selectExpr("p_partkey AS scheme_idx", "p_name AS scheme_name", "p_brand AS family_name")
    listed = schemes.expand_families(top, listed, "family_name")
    return joins.ambiguous_names(listed, {"name": _name_key("scheme_name"), "family": F.col("family_name")}, "scheme_idx")


@query
def name_join(spark, sf_dir):
    feed_rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS code",
        "p_brand AS fund_family",
        "concat(replace(p_name, ' ', '   '), '  - Growth') AS feed_name",
    )
    top = schemes.top_families(binding.all_families(spark, sf_dir)).select("family_name")
    listed = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS scheme_idx", "upper(p_name) AS scheme_name", "p_brand AS family_name"
    )
    listed = schemes.expand_families(top, listed, "family_name")
    matches = joins.name_matches(
        feed_rows,
        listed,
        [_name_key("feed_name"), F.col("fund_family")],
        [_name_key("scheme_name"), F.col("family_name")],
        "scheme_idx",
    )
    return matches.select("code", "fund_family", "scheme_idx", "n_candidates")


# --- Schemes ---------------------------------------------------------------


@query
def scheme_numeric(spark, sf_dir):
    rows = schemes.add_numbers(binding.selected_schemes(spark, sf_dir))
    return rows.select("scheme_idx", *NUMERIC_COLUMN_ORDER, *PASSED_THROUGH)


@query
def horizon_returns_long(spark, sf_dir):
    return binding.scheme_long(spark, sf_dir).select("scheme_idx", "horizon", "fund_ret")


@query
def performance_unpivot(spark, sf_dir):
    return reshape.performance_cells(binding.scheme_wide(spark, sf_dir), ["scheme_idx"])


@query
def performance_pivot(spark, sf_dir):
    cells = reshape.performance_cells(binding.scheme_wide(spark, sf_dir), ["scheme_idx"])
    return reshape.performance_wide(cells, ["scheme_idx"])


@query
def category_benchmarks(spark, sf_dir):
    numbers = schemes.add_numbers(binding.selected_schemes(spark, sf_dir))
    wide = schemes.category_benchmarks(numbers)
    rows = ", ".join(
        f"struct('{h}' AS horizon, cat_avg_{h} AS cat_avg, cat_best_{h} AS cat_best, cat_worst_{h} AS cat_worst)"
        for h in HORIZONS
    )
    return wide.selectExpr("category", f"inline(array({rows}))")


@query
def scheme_scores(spark, sf_dir):
    rows = schemes.add_scores(binding.scheme_long(spark, sf_dir))
    return rows.select("scheme_idx", "horizon", *schemes.SCORE_COLUMNS, "alloc_undefined", "volat_undefined")


@query
def scheme_labels(spark, sf_dir):
    return binding.labelled(spark, sf_dir).select("scheme_idx", "horizon", "mean_score", "label", "label_bin")


@query
def label_balance(spark, sf_dir):
    return features.balance(binding.labelled(spark, sf_dir))


@query
def entity_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    top = schemes.top_families(binding.all_families(spark, sf_dir)).select("family_name")
    flagged = part.join(F.broadcast(top), F.col("p_brand") == F.col("family_name"), "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("schemes"),
        F.count("family_name").alias("analysed"),
        F.countDistinct("family_name").alias("families"),
    )


@query
def train_test_split(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey")
    return ranking.add_train_flag(part, part, "p_partkey")


# --- Features and evaluation ----------------------------------------------


def _features(spark, sf_dir, mode, keep=()):
    return features.feature_rows(binding.labelled(spark, sf_dir), mode, keep)


@query
def feature_rows_per_horizon(spark, sf_dir):
    return _features(spark, sf_dir, "per_horizon")


@query
def feature_rows_reference(spark, sf_dir):
    return _features(spark, sf_dir, "reference")


@query
def imputed_means(spark, sf_dir):
    means = features.feature_means(_features(spark, sf_dir, "reference"))
    return means.select("horizon", *[F.round(f, 6).alias(f) for f in features.FEATURES])


@query
def imputed_rows(spark, sf_dir):
    # Stored, since the means read the rows too.
    rows = features.impute_means(materialise(_features(spark, sf_dir, "reference"), "feature-rows"))
    return rows.select("scheme_idx", "horizon", F.round("f8", 9).alias("f8"), F.round("f9", 9).alias("f9"))


@query
def feature_coverage(spark, sf_dir):
    coverage = features.feature_coverage(_features(spark, sf_dir, "per_horizon"))
    return coverage.withColumn("coverage", F.round("coverage", 6))


def _scored(spark, sf_dir):
    """Labelled rows with a rule in place of a model: the mean of three scores."""
    rows = binding.labelled(spark, sf_dir).selectExpr(
        "scheme_idx", "horizon", "is_train", "fund_ret", "label_bin",
        "round((m_risk + m_rating + m_diff) / 3D, 6) AS score",
    )
    return rows.selectExpr(
        "*",
        "int(score >= 0.6D) AS prediction",
        f"int(greatest(0, least({GRID}, floor(round(score * 100, 3)) - 40))) AS level",
    )


@query
def fold_assignment(spark, sf_dir):
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin")
    return evaluate.add_folds(materialise(train, "scored"))


def _fold_f1(spark, sf_dir):
    # Stored, since numbering the rows reads them twice.
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin", "level")
    rows = evaluate.add_folds(materialise(train, "scored"))
    counts = rows.groupBy("horizon", "fold", "label_bin", "level").agg(F.count(F.lit(1)).alias("n"))
    grid = evaluate.expand_levels(counts, GRID)
    return evaluate.f1_scores(grid, ["horizon", "num_trees", "fold"], weight="n")


@query
def fold_f1(spark, sf_dir):
    return _fold_f1(spark, sf_dir)


@query
def score_boxplot(spark, sf_dir):
    return evaluate.box_plot(materialise(_fold_f1(spark, sf_dir), "scores"), ["horizon", "num_trees"])


@query
def best_tree_count(spark, sf_dir):
    return evaluate.best_tree_count(_fold_f1(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    return evaluate.accuracy(_scored(spark, sf_dir).filter("NOT is_train"))


@query
def precision_recall(spark, sf_dir):
    return evaluate.precision_recall(_scored(spark, sf_dir), ["horizon", "is_train"])


@query
def roc_points(spark, sf_dir):
    # Stored, since running sums read the rows twice.
    rows = _scored(spark, sf_dir).select("horizon", "score", "label_bin")
    return evaluate.roc_points(materialise(rows, "scored"))


@query
def rebalanced(spark, sf_dir):
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin")
    return features.duplicate_minority(train)


@query
def roc_area(spark, sf_dir):
    rows = _scored(spark, sf_dir).select("horizon", "score", "label_bin")
    return evaluate.roc_area(materialise(rows, "scored"))


@query
def exact_sample(spark, sf_dir):
    """Thirty training rows per horizon and label, all where there are fewer."""
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin")
    return sampling.sample_exactly(materialise(train, "training"), ["horizon", "label_bin"], 30, ["scheme_idx", "horizon"])


@query
def class_weights(spark, sf_dir):
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin")
    return sampling.class_weights(materialise(train, "training"), ["horizon"], "label_bin")


@query
def price_boxplot(spark, sf_dir):
    """Prices of all line items by return flag: groups that hold a third of all rows and more."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return evaluate.box_plot(rows, ["l_returnflag"], "l_extendedprice", large_groups=True)


@query
def thinned(spark, sf_dir):
    train = _scored(spark, sf_dir).filter("is_train").select("scheme_idx", "horizon", "label_bin")
    return features.thin_majority(train, 0.25)


def _monthly_prices(lineitem):
    months = lineitem.groupBy(F.col("l_partkey").alias("scheme_idx"), F.date_trunc("month", "l_shipdate").alias("month"))
    return months.agg(F.expr("try_divide(sum(bigint(rint(l_extendedprice * 100))), sum(bigint(l_quantity))) AS price"))


def _rounded(measures):
    return measures.select(
        "scheme_idx",
        "n_periods",
        "mean_excess",
        *[F.round(c, 4).alias(c) for c in measures.columns[3:]],
    )


def _categories(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS scheme_idx", "p_type AS category")


@query
def risk_measures(spark, sf_dir):
    prices = _monthly_prices(table(spark, sf_dir, "lineitem"))
    returns = risk.period_returns(prices, ["scheme_idx"], "month", "price")
    # Stored: the benchmark and the measures both start from it.
    returns = materialise(returns.join(_categories(spark, sf_dir), "scheme_idx"), "returns")
    # Stored, its size decides whether it is broadcast.
    bench = materialise(risk.benchmark_returns(returns, ["category"], "month"), "benchmark")
    return _rounded(risk.risk_measures(returns, bench, "scheme_idx", ["category"], "month"))


@query
def risk_measures_by_month(spark, sf_dir):
    """The measures from stored moments: all months but the last loaded, the last one added from its own line items."""
    lineitem, groups = table(spark, sf_dir, "lineitem"), _categories(spark, sf_dir)
    last = lineitem.agg(F.date_trunc("month", F.max("l_shipdate"))).first()[0]
    store = risk.MomentStore(spark, new_folder(spark, "moments"), "scheme_idx", ["category"], "month", "price")
    prices = materialise(_monthly_prices(lineitem.where(F.col("l_shipdate") < F.lit(last))), "prices")
    store.load(prices, groups)
    before = prices.agg(F.max("month")).first()[0]
    store.add(_monthly_prices(lineitem.where(F.col("l_shipdate") >= F.lit(last))), groups, last, before)
    return _rounded(store.measures())


# --- Rankings --------------------------------------------------------------


@query
def top5_per_horizon(spark, sf_dir):
    good = ranking.chosen(binding.labelled(spark, sf_dir), "label_bin")
    return ranking.report(ranking.top_per_horizon(good))


@query
def horizon_ranking(spark, sf_dir):
    good = ranking.chosen(binding.labelled(spark, sf_dir), "label_bin")
    return ranking.rank_horizons(good.select("scheme_idx", "horizon", "scheme_name", "fund_ret", "scheme_url"))


# --- Forests ---------------------------------------------------------------


def _stored_features(spark, sf_dir, folds=False, keep=(), mode="per_horizon"):
    rows = materialise(_features(spark, sf_dir, mode, keep), "feature-rows")
    rows = features.impute_means(rows, train_only=mode == "per_horizon")
    if folds:
        rows = evaluate.add_folds(materialise(rows.filter("is_train"), "training"))
    return forest.assemble(rows)


@query
def cv_scores(spark, sf_dir):
    return forest.cross_validate(_stored_features(spark, sf_dir, folds=True))


@query
def forest_importances(spark, sf_dir):
    models = forest.fit_horizons(_stored_features(spark, sf_dir))
    return forest.reported_importances(forest.importances(spark, models))


def _predictions(spark, sf_dir):
    stored = _stored_features(spark, sf_dir)
    return forest.predict(stored, forest.fit_horizons(stored))


@query
def forest_predictions(spark, sf_dir):
    found = _predictions(spark, sf_dir)
    return found.select("scheme_idx", "horizon", "is_train", "label_bin", "prediction", "probability")


@query
def cv_checks(spark, sf_dir):
    scores = cv_scores(spark, sf_dir)
    return scores.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.count_distinct("fold").alias("n_folds"),
        F.count_distinct("num_trees").alias("n_trees"),
        F.count_if(F.col("f1").between(0, 1)).alias("n_in_range"),
    )


@query
def forest_checks(spark, sf_dir):
    stored = _stored_features(spark, sf_dir)
    models = forest.fit_horizons(stored)
    sums = forest.importances(spark, models).groupBy("horizon").agg(F.sum("importance").alias("total"))
    found = forest.predict(stored, models).groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_train").alias("n_train"),
        F.sum("label_bin").alias("n_good"),
        F.count_if(F.col("prediction").isin(0, 1) & F.col("probability").between(0, 1)).alias("n_scored"),
    )
    # A forest that found nothing to split on has importances of 0.
    whole = (F.abs(F.col("total") - 1) < 1e-6) | (F.col("total") == 0)
    return found.join(sums, "horizon").select(*found.columns, whole.alias("importances_sum"))


@query
def forest_accuracy(spark, sf_dir):
    return evaluate.accuracy(_predictions(spark, sf_dir).filter("NOT is_train"))


@query
def forest_accuracy_checks(spark, sf_dir):
    """Held-out accuracy next to the confusion counts of the same stored predictions."""
    found = materialise(_predictions(spark, sf_dir).filter("NOT is_train"), "predictions")
    counts = evaluate.confusion(found, ["horizon"])
    right = F.col("tp") + F.col("tn")
    total = right + F.col("fp") + F.col("fn")
    agree = (total == F.col("n_rows")) & (F.abs(F.col("accuracy") * total - right) < 1e-6)
    both = evaluate.accuracy(found).join(counts, "horizon")
    return both.select("horizon", "n_rows", F.round("majority_share", 9).alias("majority_share"), (F.col("tp") + F.col("fn")).alias("n_good"), agree.alias("counts_agree"), F.col("accuracy").between(0, 1).alias("in_range"))


@query
def forest_importance_checks(spark, sf_dir):
    found = forest_importances(spark, sf_dir)
    return found.select("horizon", "feature", F.col("importance").between(0, 1).alias("in_range"))


@query
def forest_saved(spark, sf_dir):
    """Pipelines fitted on raw feature rows, saved, loaded again and scored: each row's result before and after."""
    rows = materialise(_features(spark, sf_dir, "reference"), "feature-rows")
    folder = new_folder(spark, "models")
    fitted = models.fit_and_save(rows, folder)
    before = models.score(rows, fitted).select("scheme_idx", "horizon", "prediction", "probability")
    after = models.score(rows, models.load(folder, fitted)).select("scheme_idx", "horizon", F.col("prediction").alias("again"), F.col("probability").alias("probability_again"))
    both = before.join(after, ["scheme_idx", "horizon"])
    same = F.col("prediction").eqNullSafe(F.col("again")) & F.col("probability").eqNullSafe(F.col("probability_again"))
    return both.groupBy("horizon").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same"), F.count("again").alias("n_scored"))


@query
def forest_reference(spark, sf_dir):
    """Accuracy on the features and means of the `reference` mode."""
    stored = _stored_features(spark, sf_dir, mode="reference")
    return evaluate.accuracy(forest.predict(stored, forest.fit_horizons(stored)).filter("NOT is_train"))


@query
def forest_roc(spark, sf_dir):
    # Rounded, so that the points of a horizon stay few; stored, since running sums read the rows twice.
    found = _predictions(spark, sf_dir).select("horizon", F.round("probability", 6).alias("score"), "label_bin")
    return evaluate.roc_points(materialise(found, "scored"))


@query
def tuned_forest(spark, sf_dir):
    """Forests whose tree counts come from a cross-validation of the training rows, on the other rows."""
    scores = materialise(cv_scores(spark, sf_dir), "scores")
    stored = _stored_features(spark, sf_dir)
    best = {r.horizon: r.num_trees for r in evaluate.best_tree_count(scores).collect()}
    # A horizon with too few rows to hold a fold out keeps its fixed count.
    models = forest.fit_horizons(stored, trees={**CHOSEN_TREES, **best})
    chosen = spark.createDataFrame([(h, m.getNumTrees) for h, m in models.items()], "horizon string, num_trees int")
    boxes = evaluate.box_plot(scores, ["horizon", "num_trees"])
    found = evaluate.accuracy(forest.predict(stored, models).filter("NOT is_train"))
    found = found.join(chosen, "horizon").join(boxes, ["horizon", "num_trees"], "left")
    inside = F.col("accuracy").between(0, 1) & F.col("whisker_low").between(0, F.col("whisker_high")) & (F.col("whisker_high") <= 1)
    return found.select("horizon", "n_rows", F.col("num_trees").between(1, 40).alias("trees_in_grid"), inside.alias("scores_in_range"))


@query
def forest_balanced(spark, sf_dir):
    stored = _stored_features(spark, sf_dir)
    models = forest.fit_horizons(stored, balanced=True)
    return evaluate.precision_recall(forest.predict(stored, models), ["horizon", "is_train"])


@query
def forest_recommendations(spark, sf_dir):
    stored = _stored_features(spark, sf_dir, keep=REPORTED)
    found = forest.predict(stored, forest.fit_horizons(stored))
    return ranking.report(ranking.top_per_horizon(ranking.chosen(found)))
