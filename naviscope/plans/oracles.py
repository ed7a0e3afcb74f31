"""The same queries as plain SQL for another engine, written from the definitions.

Nothing here is shared with the Spark side but the fixed values: returns come
from direct date windows, folds from `ntile`, sections from one window per key.
"""

from naviscope.plans.binding import FEED_NAME, RISK_TEXTS, ROOT, SITE_NAME
from naviscope.schemas import (
    FEATURE_NAMES,
    HORIZONS,
    MEASURES,
    MISSING_TOKENS,
    NUMERIC_COLUMN_ORDER,
    RISK_CODES,
    SPARSE_FEATURES,
    TRAIN_RATIO,
)

ORACLES = {}

BLANKS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"
# What is no part of a number.
NOISE = r"(Rs[ ]*\.)|[^\d|.|-]|(Rank[ ]*)"


def numeric(x):
    return f"try_cast(regexp_replace({x}, '{NOISE}', '', 'gi') AS DOUBLE)"


def strip(x):
    return f"regexp_replace(regexp_replace({x}, '^{BLANKS}+', ''), '{BLANKS}+$', '')"


def collapse(x):
    return f"trim(regexp_replace({x}, '{BLANKS}+', ' ', 'g'))"


def plain(x):
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


def case(x, pairs, otherwise="NULL"):
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in pairs.items())
    return f"CASE {x} {whens} ELSE {otherwise} END"


def _window_sums():
    out = []
    for h, n in HORIZONS.items():
        now = f"l_shipdate > t.t - INTERVAL {n} MONTH"
        before = f"l_shipdate > t.t - INTERVAL {2 * n} MONTH AND l_shipdate <= t.t - INTERVAL {n} MONTH"
        for name, value in (("c", "cents"), ("q", "qty")):
            out.append(f"sum({value}) FILTER ({now}) AS {name}_{h}")
            out.append(f"sum({value}) FILTER ({before}) AS {name}p_{h}")
    return ", ".join(out)


def _return(h):
    now = f"((c_{h}::DOUBLE / 1e2) / nullif(q_{h}, 0)::DOUBLE)"
    before = f"((cp_{h}::DOUBLE / 1e2) / nullif(qp_{h}, 0)::DOUBLE)"
    return f"round(({now} / {before} - 1) * 100, 4) + 0e0 AS fund_ret_{h}"


RETURNS = ", ".join(f"fund_ret_{h}" for h in HORIZONS)

FACTS = f"""
t AS (SELECT max(l_shipdate) AS t FROM lineitem),
li AS (SELECT l_partkey, l_shipdate, l_quantity::BIGINT AS qty,
    round(l_extendedprice * 100)::BIGINT AS cents,
    (l_shipdate::DATE - DATE '1970-01-01') * 1000 + round(l_tax * 100)::BIGINT AS dated_tax FROM lineitem),
sums AS (SELECT l_partkey AS scheme_idx, sum(cents) AS aum_cents, min(qty) AS min_qty,
    max(dated_tax) % 1000 AS tax_cents, {_window_sums()} FROM li, t GROUP BY l_partkey),
facts AS (SELECT scheme_idx, aum_cents, min_qty, tax_cents, {', '.join(map(_return, HORIZONS))} FROM sums),
fam AS (SELECT p_brand AS family_name, sum(aum_cents)::BIGINT AS family_cents
    FROM facts JOIN part ON p_partkey = scheme_idx GROUP BY p_brand),
top AS (SELECT * FROM fam ORDER BY family_cents DESC, family_name LIMIT 10)
"""


def money(c):
    return f"concat(({c}::BIGINT // 100), '.', lpad(({c}::BIGINT % 100)::VARCHAR, 2, '0'))"


def decimal(c, places):
    return f"({c}::DECIMAL(18,{places}))::VARCHAR"


def _family_url(brand):
    return f"concat('{ROOT}/families/', replace({brand}, '#', '-'))"


RISK_CODE = case("p_type", {k: RISK_CODES.get(v.upper(), 0) for k, v in RISK_TEXTS.items()}, 0)

SCHEME = f"""
sch AS (SELECT f.*, p.*, top.family_name, top.family_cents,
    concat(p_name, ' ', scheme_idx) AS scheme_name,
    concat('{ROOT}/schemes/', scheme_idx) AS scheme_url,
    concat(p_type, '-', p_size) AS category,
    {RISK_CODE} AS num_scheme_risk,
    aum_cents::DOUBLE / 1e2 AS num_scheme_aum,
    family_cents::DOUBLE / 1e2 AS num_family_aum,
    (1 + p_size % 5)::DOUBLE AS num_crisil_rating,
    (p_retailprice::DECIMAL(18,2))::DOUBLE AS num_latest_nav,
    fund_ret_1y AS num_1yr_return,
    min_qty::DOUBLE AS num_min_investment,
    tax_cents::DOUBLE / 1e2 AS num_last_dividend,
    NULL::DOUBLE AS num_bonus
    FROM facts f JOIN part p ON p_partkey = scheme_idx JOIN top ON p_brand = top.family_name)
"""

_STATS = ", ".join(
    f"round(avg(fund_ret_{h}), 9) AS cat_avg_{h}, max(fund_ret_{h}) AS cat_best_{h}, min(fund_ret_{h}) AS cat_worst_{h}"
    for h in HORIZONS
)
_DIFFS = ", ".join(f"round(fund_ret_{h} - cat_avg_{h}, 9) AS diff_{h}" for h in HORIZONS)
_LONG = " UNION ALL ".join(
    f"SELECT *, '{h}' AS horizon, fund_ret_{h} AS fund_ret, cat_avg_{h} AS cat_avg, diff_{h} AS diff, "
    f"cat_best_{h} AS cat_best, cat_worst_{h} AS cat_worst FROM wide"
    for h in HORIZONS
)

WIDE = f"""
cat AS (SELECT category, {_STATS} FROM sch GROUP BY category),
wide AS (SELECT sch.*, cat.* EXCLUDE (category), {_DIFFS} FROM sch JOIN cat USING (category))
"""

CUT = f"(SELECT floor({TRAIN_RATIO!r}e0 * (max(p_partkey) + 1)) FROM part)"

SCORED = f"""
long AS ({_LONG}),
scored AS (SELECT *, num_scheme_risk / 5e0 AS m_risk,
    coalesce(num_crisil_rating / 5e0, 0) AS m_rating,
    coalesce(num_scheme_aum / nullif(num_family_aum - num_scheme_aum, 0), 0) AS m_alloc,
    num_family_aum = num_scheme_aum AS alloc_undefined,
    CASE WHEN diff > 0 THEN 1e0 ELSE 0e0 END AS m_diff,
    CASE WHEN cat_worst > 0 THEN coalesce(cat_worst / nullif(cat_best, 0), 0) ELSE 0e0 END AS m_volat,
    coalesce(cat_worst > 0 AND cat_best = 0, false) AS volat_undefined,
    scheme_idx < {CUT} AS is_train FROM long),
meaned AS (SELECT *, ((((m_risk + m_rating) + m_alloc) + m_diff) + m_volat) / 5e0 AS mean_score FROM scored),
lab AS (SELECT *, round(mean_score) AS label, (round(mean_score) >= 1)::INT AS label_bin FROM meaned)
"""

RULE = """
ruled AS (SELECT scheme_idx, horizon, is_train, label_bin,
    round((m_risk + m_rating + m_diff) / 3e0, 6) AS score FROM lab),
pred AS (SELECT *, (score >= 0.6e0)::INT AS prediction,
    greatest(0, least(40, floor(round(score * 100, 3)) - 40))::INT AS level FROM ruled)
"""

FOLDS = """
fold AS (SELECT scheme_idx, horizon, label_bin, level,
    (ntile(10) OVER (PARTITION BY horizon, label_bin ORDER BY scheme_idx) - 1)::INT AS fold
    FROM pred WHERE is_train),
f1 AS (SELECT horizon, num_trees, fold, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM (
    SELECT horizon, g.n::INT AS num_trees, fold,
        count(*) FILTER (level >= g.n AND label_bin = 1)::DOUBLE AS tp,
        count(*) FILTER (level >= g.n AND label_bin = 0)::DOUBLE AS fp,
        count(*) FILTER (level < g.n AND label_bin = 1)::DOUBLE AS fn
    FROM fold, (SELECT unnest(range(1, 41)) AS n) g GROUP BY ALL))
"""


def sql(name, select, *ctes):
    ORACLES[name] = (f"WITH {', '.join(c.strip() for c in ctes)} " if ctes else "") + select


FIRST = (FACTS, SCHEME)
ALL = (FACTS, SCHEME, WIDE, SCORED)

# --- Pages ---

sql(
    "page_anchors",
    f"""SELECT page_id, pos, q[2:-2] AS href, concat('{ROOT}', q[2:-2]) AS url FROM (
    SELECT page_id, unnest(range(len(h)))::INT AS pos, unnest(h) AS q FROM (
    SELECT page_id, regexp_extract_all(html, '(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*("[^"]*"|''[^'']*'')', 1) AS h FROM pages))""",
)
sql("page_title", "SELECT page_id, nullif(regexp_extract(html, '(?is)<title(?:\\s[^>]*)?>(.*?)</title>', 1), '') AS title FROM pages")
sql("url_shortcode", "SELECT page_id, string_split(url, '/')[-1] AS shortcode FROM pages")
sql("family_options", "SELECT DISTINCT p_brand AS family, string_split(p_brand, '#')[-1] AS family_id FROM part")
sql(
    "family_table",
    f"""SELECT row_no::INT AS row_no, family_name, {_family_url('family_name')} AS family_url,
    concat('Rs. ', {money('family_cents')}) AS family_aum, replace(family_name, '#', '-') AS family_shortcode
    FROM (SELECT *, row_number() OVER (ORDER BY family_name) AS row_no FROM fam) WHERE row_no <= 10""",
    FACTS,
)
sql(
    "scheme_table",
    f"""SELECT concat(p_name, ' ', scheme_idx) AS scheme_name, concat('{ROOT}/schemes/', scheme_idx) AS scheme_url,
    concat('Rank ', 1 + p_size % 5) AS crisil_rating,
    CASE WHEN scheme_idx % 7 <> 0 THEN concat(p_type, '-', p_size) END AS category,
    CASE WHEN scheme_idx % 7 <> 0 THEN concat('{ROOT}/categories/', p_type, '-', p_size) END AS category_url,
    {decimal('p_retailprice', 2)} AS latest_nav, {decimal('fund_ret_1y', 4)} AS "1yr_return",
    CASE WHEN scheme_idx % 11 <> 0 THEN concat('Rs. ', {money('aum_cents')}) END AS scheme_aum
    FROM facts JOIN part ON p_partkey = scheme_idx""",
    FACTS,
)
sql(
    "scheme_details",
    f"""SELECT scheme_idx AS page_id, {case('p_type', RISK_TEXTS)} AS scheme_risk_text,
    CASE WHEN scheme_idx % 5 <> 0 THEN 'Regular' END AS scheme_plan,
    CASE WHEN scheme_idx % 5 <> 0 THEN CASE WHEN p_size % 2 = 0 THEN 'Growth' ELSE 'Dividend' END END AS scheme_option,
    concat(p_type, ' ended') AS scheme_fund_type, concat('Index ', p_type) AS scheme_benchmark,
    concat('Rs. ', min_qty) AS scheme_min_investment, {money('tax_cents')} AS scheme_last_dividend,
    NULL::VARCHAR AS scheme_bonus FROM sch""",
    *FIRST,
)
_CELLS = " UNION ALL ".join(
    f"SELECT scheme_idx, '{m}' AS measure, horizon, {m} AS value FROM long" for m in MEASURES.values()
)
_LONG_ONLY = f"long AS ({_LONG})"
_PIVOT = ", ".join(f"{m}_{h}" for m in MEASURES.values() for h in HORIZONS)
sql("measure_rows", _CELLS, *FIRST, WIDE, _LONG_ONLY)
sql("performance_columns", f"SELECT scheme_idx, {_PIVOT} FROM wide", *FIRST, WIDE)

# --- Scalar functions ---

_OTHERS = "['NA', ' N.A. ', '--', '-', 'None', '', 'value']"
sql(
    "missing_tokens",
    f"""SELECT source, id, variant, CASE WHEN {strip('cell')} NOT IN {MISSING_TOKENS} THEN cell END AS cell FROM (
    SELECT 'orders' AS source, o_orderkey AS id, unnest([0, 1])::INT AS variant,
    unnest([o_orderpriority, ({_OTHERS})[o_orderkey % 7 + 1]]) AS cell FROM orders
    UNION ALL SELECT 'events', event_id, unnest([0, 1])::INT, unnest([props, ({_OTHERS})[event_id % 7 + 1]]) FROM events)""",
)
_CODES = case("upper(risk_text)", RISK_CODES, 0)
sql(
    "risk_codes",
    f"""SELECT o_orderkey, risk_text, {_CODES} AS risk_code
    FROM (SELECT o_orderkey, string_split(o_orderpriority, '-')[-1] AS risk_text FROM orders)""",
)
sql(
    "numeric_from_text",
    f"""SELECT source, id, {numeric('cell')} AS value FROM (
    SELECT 'orders' AS source, o_orderkey AS id, o_orderpriority AS cell FROM orders
    UNION ALL SELECT 'part', p_partkey, p_brand FROM part
    UNION ALL SELECT 'events', event_id, props FROM events
    UNION ALL SELECT 'customer', c_custkey, c_name FROM customer)""",
)
sql(
    "sql_functions",
    f"""SELECT o_orderkey, {_CODES} AS risk_code, o_orderkey::DOUBLE AS value
    FROM (SELECT o_orderkey, string_split(o_orderpriority, '-')[-1] AS risk_text FROM orders)""",
)
sql("whitespace_collapse", f"SELECT doc_id, {collapse('text')} AS text FROM documents")
sql("short_names", "SELECT p_partkey, p_name AS short_name FROM part")
sql(
    "composite_split",
    """SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN concat(p_type, ' (', p_name, ' ') END AS "before",
    CASE WHEN p_size % 10 <> 0 THEN concat(p_name, ' (', p_size, ')') END AS inside FROM part""",
)
sql(
    "delimited_fields",
    """SELECT p_partkey, 5 AS n_fields, p_name AS field_0, p_brand AS field_1, p_type AS field_2,
    '' AS field_3, p_size::VARCHAR AS field_4 FROM part""",
)

# --- Lines and sections ---

_LINES = rf"""
lines AS (SELECT doc_id, pos, line FROM (
    SELECT doc_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
    WHERE regexp_matches(line, '[^\s\p{{Z}}\x0b\x1c-\x1f\x85]'))
"""
sql("nonblank_lines", "SELECT doc_id, pos, line FROM lines", _LINES)
sql("marker_lines", "SELECT doc_id, pos, instr(line, ',') = 0 AS is_marker FROM lines", _LINES)


def sections(key, order, source):
    """Context by one window per key: runs of markers, numbered, even ones set the type."""
    return f"""
marked AS ({source}),
runs AS (SELECT *, sum((NOT is_marker)::INT) OVER w AS run, lag(line) OVER w AS previous,
    row_number() OVER w - 1 AS line_no FROM marked WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
numbered AS (SELECT *, row_number() OVER (PARTITION BY {key}, run, is_marker ORDER BY {order}) AS k FROM runs),
sectioned AS (SELECT {key}, {order}, line_no::BIGINT AS line_no,
    last_value(CASE WHEN is_marker AND k % 2 = 0 THEN previous END IGNORE NULLS) OVER w AS section_type,
    last_value(CASE WHEN is_marker THEN line END IGNORE NULLS) OVER w AS section_family
    FROM numbered WINDOW w AS (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING))
"""


sql(
    "section_carry_lines",
    "SELECT * FROM sectioned",
    _LINES,
    sections("doc_id", "pos", "SELECT *, instr(line, ',') = 0 AS is_marker FROM lines"),
)
sql(
    "section_carry_events",
    "SELECT * FROM sectioned",
    sections(
        "user_id",
        "event_id",
        """SELECT user_id, event_id, concat(event_type, '#', event_id) AS line,
        event_type IN ('signup', 'error') AS is_marker FROM events""",
    ),
)

# --- Feeds ---

_FEED = """SELECT p_partkey::VARCHAR AS code, concat('K', p_size) AS k1, 'B' AS k2,
    concat(p_name, ' - Growth - ', p_size) AS scheme_name, (p_retailprice::DECIMAL(18,2))::VARCHAR AS "value",
    concat('d', p_size % 28) AS "day", concat(p_type, ' Ended (Plan (', p_type, '))') AS scheme_classification,
    concat(p_type, ' Ended (Plan ') AS scheme_type, concat('Plan (', p_type, ')') AS scheme_category,
    p_brand AS fund_family, string_split(p_brand, '#')[-1] AS fund_id, p_name AS scheme_short_name FROM part"""
sql("feed_enriched", _FEED)
sql("feed_delimited", _FEED)
sql("incremental_feed", _FEED)
sql("upserted_feed", _FEED.replace("(p_retailprice::", "((p_retailprice + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END)::"))
_FEED_FILES = """
ordered AS (SELECT p_partkey // 1000 AS feed, p_type, p_brand,
    lag(p_type) OVER w AS last_type, lag(p_brand) OVER w AS last_brand,
    row_number() OVER w AS ord FROM part
    WINDOW w AS (PARTITION BY p_partkey // 1000 ORDER BY p_type, p_brand, p_partkey)),
counted AS (SELECT *, (p_type IS DISTINCT FROM last_type)::INT AS new_type,
    (p_type IS DISTINCT FROM last_type OR p_brand IS DISTINCT FROM last_brand)::INT AS new_family FROM ordered),
placed AS (SELECT *, sum(new_type + new_family + 1) OVER (PARTITION BY feed ORDER BY ord) AS data_no FROM counted)
"""
sql(
    "feed_line_numbers",
    """SELECT false AS is_marker, (count(*) + count(DISTINCT feed))::BIGINT AS n_lines, sum(data_no)::BIGINT AS sum_line_no FROM placed
    UNION ALL SELECT true, sum(new_type + new_family)::BIGINT,
    sum(CASE WHEN new_type = 1 THEN (data_no - 1) + (data_no - 2) WHEN new_family = 1 THEN data_no - 1 ELSE 0 END)::BIGINT FROM placed""",
    _FEED_FILES,
)
sql(
    "feed_source_lines",
    """SELECT line, count(*) AS n_ranged, count(*) AS n_plain FROM (
    SELECT concat(p_partkey, ';K', p_size, '; B ;', replace(p_name, ' ', '   '), '  - Growth - ', p_size, ';', p_retailprice::DECIMAL(18,2), ';d', p_size % 28) AS line FROM part
    UNION ALL SELECT 'Code;K1 ; K2;Scheme Name;Value;Day' FROM (SELECT DISTINCT feed FROM placed)
    UNION ALL SELECT unnest(['', '', concat(p_type, ' Ended (Plan (', p_type, '))')]) FROM placed WHERE new_type = 1
    UNION ALL SELECT p_brand FROM placed WHERE new_family = 1) GROUP BY line""",
    _FEED_FILES,
)
sql(
    "feed_rejects",
    """SELECT doc_id, line_no::BIGINT AS line_no, len(string_split(line, ','))::INT AS n_fields,
    len(string_split(head, ','))::INT AS n_headings FROM (
    SELECT doc_id, line, row_number() OVER w - 1 AS line_no, first_value(line) OVER w AS head FROM lines
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
    WHERE line_no > 0 AND instr(line, ',') > 0 AND len(string_split(line, ',')) <> len(string_split(head, ','))""",
    _LINES,
)
sql(
    "feed_unmatched",
    "SELECT p_brand AS family, count(*) AS n_rows FROM part JOIN top ON p_brand = family_name GROUP BY p_brand",
    FACTS,
)

sql(
    "schemes_delimited",
    f"""SELECT family_name, {_family_url('family_name')} AS family_url, concat('Rs. ', {money('family_cents')}) AS family_aum,
    replace(family_name, '#', '-') AS family_shortcode, scheme_name, scheme_url, concat('Rank ', 1 + p_size % 5) AS crisil_rating,
    category, concat('{ROOT}/categories/', category) AS category_url, {decimal('p_retailprice', 2)} AS latest_nav,
    coalesce({decimal('fund_ret_1y', 4)}, '--') AS "1yr_return", concat('Rs. ', {money('aum_cents')}) AS scheme_aum FROM sch""",
    *FIRST,
)

# --- Joins ---

_FAMILY = f"""family_name, {_family_url('family_name')} AS family_url, concat('Rs. ', {money('family_cents')}) AS family_aum,
    replace(family_name, '#', '-') AS family_shortcode"""
sql("top_families", f"SELECT {_FAMILY}, family_cents::DOUBLE / 1e2 AS num_family_aum FROM top", FACTS)
sql(
    "family_scheme_join",
    f"""SELECT scheme_idx, scheme_name, family_name, concat('Rs. ', {money('family_cents')}) AS family_aum,
    replace(family_name, '#', '-') AS family_shortcode FROM sch""",
    *FIRST,
)
sql(
    "scheme_detail_join",
    f"""SELECT scheme_idx, concat('{ROOT}/schemes/', scheme_idx) AS scheme_url, concat(p_name, ' ', scheme_idx) AS scheme_name,
    {decimal('p_retailprice', 2)} AS latest_nav, {case('p_type', RISK_TEXTS)} AS scheme_risk_text,
    CASE WHEN p_size % 2 = 0 THEN 'Growth' ELSE 'Dividend' END AS scheme_option,
    concat('Rs. ', min_qty) AS scheme_min_investment FROM facts JOIN part ON p_partkey = scheme_idx""",
    FACTS,
)
_DETAILS = (
    f"listed AS (SELECT scheme_idx, concat('{ROOT}/schemes/', scheme_idx) AS scheme_url, scheme_name FROM sch)",
    f"details AS (SELECT concat('{ROOT}/schemes/', user_id) AS scheme_url, event_id, event_type AS status, value AS latest_value FROM events)",
    "n AS (SELECT scheme_url, count(*) AS n FROM details GROUP BY scheme_url)",
)
sql(
    "detail_sources_join",
    """SELECT listed.*, event_id, status, latest_value FROM listed JOIN details USING (scheme_url)
    QUALIFY row_number() OVER (PARTITION BY scheme_idx ORDER BY event_id DESC) = 1""",
    *FIRST,
    *_DETAILS,
)
sql(
    "detail_sources_exceptions",
    """SELECT scheme_url, 'missing' AS kind, 1::BIGINT AS n_rows FROM listed WHERE scheme_url NOT IN (SELECT scheme_url FROM n)
    UNION ALL SELECT scheme_url, 'extra', n FROM n WHERE scheme_url NOT IN (SELECT scheme_url FROM listed)
    UNION ALL SELECT scheme_url, 'repeated', n FROM n WHERE n > 1""",
    *FIRST,
    *_DETAILS,
)
sql("dimension_lookup", "SELECT c_custkey, c_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
sql(
    "dimension_gaps",
    "SELECT c_custkey, event_type FROM customer LEFT JOIN (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id) ON c_custkey = user_id",
)
sql("dimension_unmatched", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
sql("dimension_strict", "SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
sql(
    "dimension_last_wins",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id",
)
sql(
    "name_join",
    """SELECT p_partkey AS code, p_brand AS fund_family,
    CASE WHEN n_candidates = 1 THEN g.scheme_idx END AS scheme_idx, g.n_candidates FROM part LEFT JOIN (
    SELECT p_name, p_brand, min(p_partkey) AS scheme_idx, count(*) AS n_candidates
    FROM part JOIN top ON p_brand = family_name GROUP BY p_name, p_brand) g USING (p_name, p_brand)""",
    FACTS,
)

sql(
    "name_ambiguous",
    """SELECT lower(p_name) AS name, p_brand AS family, p_partkey AS scheme_idx FROM part JOIN top ON p_brand = family_name
    QUALIFY count(*) OVER (PARTITION BY p_name, p_brand) > 1""",
    FACTS,
)

sql(
    "similar_names",
    """SELECT code, feed_name, best.r AS matched_name, CASE WHEN n_candidates = 1 THEN scheme_idx END AS scheme_idx,
    coalesce(n_candidates, 0) AS n_candidates, edits FROM fed
    LEFT JOIN best ON fed.name = best.l LEFT JOIN rows ON best.r = rows.name""",
    f"fed AS (SELECT p_partkey AS code, {FEED_NAME} AS feed_name, {plain(FEED_NAME)} AS name FROM part)",
    f"rows AS (SELECT {plain(SITE_NAME)} AS name, min(p_partkey) AS scheme_idx, count(*) AS n_candidates FROM part GROUP BY 1)",
    "names AS (SELECT DISTINCT 'l' AS side, name FROM fed UNION ALL SELECT 'r', name FROM rows)",
    "grams AS (SELECT side, name, unnest(list_distinct(list_transform(range(1, length(name) + 2), lambda i: substr(concat('  ', name, ' '), i, 3)))) AS gram FROM names)",
    "weights AS (SELECT gram, length(bin((SELECT count(*) FROM names) // count(*))) AS w FROM grams GROUP BY gram)",
    "weighed AS (SELECT side, name, gram, w FROM grams JOIN weights USING (gram))",
    "totals AS (SELECT side, name, sum(w) AS total FROM weighed GROUP BY side, name)",
    "shared AS (SELECT a.name AS l, b.name AS r, sum(a.w) AS s FROM weighed a JOIN weighed b ON a.gram = b.gram AND a.side = 'l' AND b.side = 'r' GROUP BY 1, 2)",
    """near AS (SELECT l, r, levenshtein(l, r) AS edits, x.total + y.total - 2 * s AS apart FROM shared
    JOIN totals x ON x.side = 'l' AND x.name = l JOIN totals y ON y.side = 'r' AND y.name = r
    WHERE 10 * s >= 6 * (x.total + y.total - s))""",
    """best AS (SELECT l, r, edits FROM near WHERE edits <= greatest(length(l), length(r)) // 4
    QUALIFY row_number() OVER (PARTITION BY l ORDER BY edits, apart, r) = 1)""",
)

# --- Schemes ---

sql(
    "scheme_numeric",
    f"""SELECT scheme_idx, {', '.join(NUMERIC_COLUMN_ORDER)}, 'Regular' AS scheme_plan,
    CASE WHEN p_size % 2 = 0 THEN 'Growth' ELSE 'Dividend' END AS scheme_option,
    concat(p_type, ' ended') AS scheme_fund_type, concat('Index ', p_type) AS scheme_benchmark,
    category, concat('{ROOT}/categories/', category) AS category_url FROM sch""",
    *FIRST,
)
sql("horizon_returns_long", "SELECT scheme_idx, horizon, fund_ret FROM long", *FIRST, WIDE, _LONG_ONLY)
sql("performance_unpivot", f"SELECT * FROM ({_CELLS})", *FIRST, WIDE, _LONG_ONLY)
sql(
    "performance_pivot",
    f"SELECT scheme_idx, {_PIVOT} FROM wide",
    *FIRST,
    WIDE,
)
sql(
    "category_benchmarks",
    " UNION ALL ".join(
        f"SELECT category, '{h}' AS horizon, cat_avg_{h} AS cat_avg, cat_best_{h} AS cat_best, cat_worst_{h} AS cat_worst FROM cat"
        for h in HORIZONS
    ),
    *FIRST,
    WIDE,
)
sql(
    "scheme_scores",
    "SELECT scheme_idx, horizon, m_risk, m_rating, m_alloc, m_diff, m_volat, alloc_undefined, volat_undefined FROM scored",
    *ALL,
)
sql("scheme_labels", "SELECT scheme_idx, horizon, mean_score, label, label_bin FROM lab", *ALL)
sql("label_balance", "SELECT horizon, sum(label_bin)::BIGINT AS good, count(*) AS total FROM lab GROUP BY horizon", *ALL)
sql(
    "entity_counts",
    """SELECT (SELECT count(*) FROM part) AS schemes,
    (SELECT count(*) FROM part WHERE p_brand IN (SELECT family_name FROM top)) AS analysed,
    (SELECT count(*) FROM top) AS families""",
    FACTS,
)
sql("train_test_split", f"SELECT p_partkey, p_partkey < {CUT} AS is_train FROM part")

# --- Features and evaluation ---

_BASE = """num_scheme_risk::DOUBLE AS f0, coalesce(num_crisil_rating, 0) AS f1, coalesce(num_family_aum, 0) AS f2,
    num_scheme_aum AS f3, coalesce(num_latest_nav, 0) AS f4, coalesce(num_min_investment, 0) AS f5,
    coalesce(num_last_dividend, 0) AS f6, coalesce(num_bonus, 0) AS f7"""


def _gated(x):
    return f"""CASE WHEN horizon = '1m' THEN coalesce({x}, 0)
    WHEN {x} IS NULL OR {x} = 0 THEN 0 ELSE {x}_1m END"""


PER_HORIZON = f"""feat AS (SELECT scheme_idx, horizon, is_train, {_BASE}, coalesce(fund_ret, 0) AS f8,
    coalesce(cat_avg, 0) AS f9, label, label_bin FROM lab)"""
GATED = f"""feat AS (SELECT scheme_idx, horizon, is_train, {_BASE}, {_gated('fund_ret')} AS f8,
    {_gated('cat_avg')} AS f9, label, label_bin FROM lab)"""
sql("feature_rows_per_horizon", "SELECT * FROM feat", *ALL, PER_HORIZON)
sql("feature_rows_reference", "SELECT * FROM feat", *ALL, GATED)
sql(
    "imputed_means",
    f"SELECT horizon, {', '.join(f'round(avg(f{i}), 6) AS f{i}' for i in range(10))} FROM feat GROUP BY horizon",
    *ALL,
    GATED,
)
sql(
    "imputed_rows",
    """SELECT scheme_idx, horizon, round(coalesce(f8, avg(f8) OVER w), 9) AS f8,
    round(coalesce(f9, avg(f9) OVER w), 9) AS f9 FROM feat WINDOW w AS (PARTITION BY horizon)""",
    *ALL,
    GATED,
)
sql(
    "feature_coverage",
    " UNION ALL ".join(
        f"SELECT horizon, '{n}' AS feature, round(avg((f{i} <> 0)::INT), 6) AS coverage FROM feat GROUP BY horizon"
        for i, n in enumerate(FEATURE_NAMES)
    ),
    *ALL,
    PER_HORIZON,
)
sql("fold_assignment", "SELECT scheme_idx, horizon, label_bin, fold FROM fold", *ALL, RULE, FOLDS)
sql("fold_f1", "SELECT * FROM f1", *ALL, RULE, FOLDS)
sql(
    "score_boxplot",
    """SELECT horizon, num_trees, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    min(f1) FILTER (f1 BETWEEN low AND high) AS whisker_low, max(f1) FILTER (f1 BETWEEN low AND high) AS whisker_high,
    (count(*) FILTER (NOT f1 BETWEEN low AND high))::INT AS outliers FROM (
    SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM f1 JOIN (
    SELECT horizon, num_trees, quantile_cont(f1, 0.25) AS q1, quantile_cont(f1, 0.5) AS median,
    quantile_cont(f1, 0.75) AS q3 FROM f1 GROUP BY ALL) USING (horizon, num_trees)) GROUP BY ALL""",
    *ALL,
    RULE,
    FOLDS,
)
sql(
    "best_tree_count",
    """SELECT horizon, num_trees, mean_f1 FROM (
    SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mean_f1 DESC, num_trees) AS r FROM (
    SELECT horizon, num_trees, round(avg(f1), 6) AS mean_f1 FROM f1 GROUP BY ALL)) WHERE r = 1""",
    *ALL,
    RULE,
    FOLDS,
)
sql(
    "accuracy",
    """SELECT horizon, avg((prediction = label_bin)::INT) AS accuracy,
    greatest(avg(label_bin), 1 - avg(label_bin)) AS majority_share, count(*) AS n_rows
    FROM pred WHERE NOT is_train GROUP BY horizon""",
    *ALL,
    RULE,
)
sql(
    "precision_recall",
    """SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall FROM (SELECT horizon, is_train,
    count(*) FILTER (prediction = 1 AND label_bin = 1) AS tp, count(*) FILTER (prediction = 1 AND label_bin = 0) AS fp,
    count(*) FILTER (prediction = 0 AND label_bin = 1) AS fn, count(*) FILTER (prediction = 0 AND label_bin = 0) AS tn
    FROM pred GROUP BY ALL)""",
    *ALL,
    RULE,
)
sql(
    "roc_points",
    """SELECT horizon, score, coalesce(tp::DOUBLE / nullif(sum(p) OVER h, 0)::DOUBLE, 0) AS tpr,
    coalesce(fp::DOUBLE / nullif(sum(n) OVER h, 0)::DOUBLE, 0) AS fpr FROM (
    SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM (
    SELECT horizon, score, sum(label_bin) AS p, sum(1 - label_bin) AS n FROM pred GROUP BY ALL)
    WINDOW w AS (PARTITION BY horizon ORDER BY score DESC)) WINDOW h AS (PARTITION BY horizon)""",
    *ALL,
    RULE,
)
sql(
    "roc_area",
    """SELECT horizon, max(tp) AS positives, max(fp) AS negatives, sum((fp - old_fp) * (tp + old_tp)) / nullif(2e0 * max(tp) * max(fp), 0) AS area FROM (
    SELECT horizon, tp, fp, lag(tp, 1, 0) OVER w AS old_tp, lag(fp, 1, 0) OVER w AS old_fp FROM (
    SELECT horizon, score, (sum(p) OVER w)::BIGINT AS tp, (sum(n) OVER w)::BIGINT AS fp FROM (
    SELECT horizon, score, sum(label_bin) AS p, sum(1 - label_bin) AS n FROM pred GROUP BY ALL)
    WINDOW w AS (PARTITION BY horizon ORDER BY score DESC)) WINDOW w AS (PARTITION BY horizon ORDER BY tp, fp)) GROUP BY horizon""",
    *ALL,
    RULE,
)
sql(
    "exact_sample",
    """SELECT scheme_idx, horizon, label_bin FROM pred WHERE is_train QUALIFY row_number() OVER (
    PARTITION BY horizon, label_bin ORDER BY substr(md5(concat('0|', scheme_idx, '|', horizon)), 1, 15), scheme_idx) <= 30""",
    *ALL,
    RULE,
)
sql(
    "class_weights",
    """SELECT scheme_idx, horizon, label_bin, n / (count(DISTINCT label_bin) OVER (PARTITION BY horizon) * m) AS weight FROM (
    SELECT *, count(*) OVER (PARTITION BY horizon) AS n, count(*) OVER (PARTITION BY horizon, label_bin) AS m FROM pred WHERE is_train)""",
    *ALL,
    RULE,
)
sql(
    "price_boxplot",
    """SELECT l_returnflag, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    min(l_extendedprice) FILTER (l_extendedprice BETWEEN low AND high) AS whisker_low,
    max(l_extendedprice) FILTER (l_extendedprice BETWEEN low AND high) AS whisker_high,
    (count(*) FILTER (NOT l_extendedprice BETWEEN low AND high))::INT AS outliers FROM (
    SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM lineitem JOIN (
    SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY ALL) USING (l_returnflag)) GROUP BY ALL""",
)
sql(
    "rebalanced",
    """SELECT scheme_idx, horizon, label_bin, unnest(range(1, 1 + CASE WHEN label_bin = 1 THEN times ELSE 1 END))::INT AS copy
    FROM (SELECT scheme_idx, horizon, label_bin FROM pred WHERE is_train) JOIN (
    SELECT horizon, coalesce(greatest(floor((count(*) - sum(label_bin))::DOUBLE / nullif(sum(label_bin), 0)::DOUBLE + 0.5), 1), 1)::INT AS times
    FROM pred WHERE is_train GROUP BY horizon) USING (horizon)""",
    *ALL,
    RULE,
)
sql(
    "thinned",
    """SELECT scheme_idx, horizon, label_bin FROM pred WHERE is_train
    AND (label_bin = 1 OR substr(md5(concat(scheme_idx, '|', horizon)), 1, 8) < '40000000')""",
    *ALL,
    RULE,
)
_RISK = """
prices AS (SELECT l_partkey AS scheme_idx, date_trunc('month', l_shipdate) AS month,
    sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / sum(l_quantity::BIGINT)::DOUBLE AS price
    FROM lineitem GROUP BY ALL),
rets AS (SELECT scheme_idx, month, p_type, round((price / lag(price) OVER w - 1) * 100, 4)::DECIMAL(18,4) AS exact, exact::DOUBLE AS ret
    FROM prices JOIN part ON p_partkey = scheme_idx WINDOW w AS (PARTITION BY scheme_idx ORDER BY month)),
known AS (SELECT * FROM rets WHERE ret IS NOT NULL),
bench AS (SELECT p_type, month, sum(exact)::DOUBLE / count(*) AS bench FROM known GROUP BY ALL),
m AS (SELECT scheme_idx, count(*) AS n_periods, sum(exact)::DOUBLE / count(*) AS mean_excess, stddev_samp(ret) AS std_dev,
    sqrt(avg(least(ret, 0) * least(ret, 0))) AS downside, regr_r2(ret, bench) AS r_squared,
    regr_slope(ret, bench) AS beta, regr_intercept(ret, bench) AS alpha,
    avg(ret) FILTER (bench > 0) / nullif(avg(bench) FILTER (bench > 0), 0) AS up_capture,
    avg(ret) FILTER (bench < 0) / nullif(avg(bench) FILTER (bench < 0), 0) AS down_capture
    FROM known JOIN bench USING (p_type, month) GROUP BY scheme_idx)
"""
sql(
    "risk_measures",
    """SELECT scheme_idx, n_periods, mean_excess, round(std_dev, 4) AS std_dev,
    round(mean_excess / nullif(std_dev, 0), 4) AS sharpe, round(mean_excess / nullif(downside, 0), 4) AS sortino,
    round(r_squared, 4) AS r_squared, round(beta, 4) AS beta, round(alpha, 4) AS alpha,
    round(mean_excess / nullif(beta, 0), 4) AS treynor, round(up_capture, 4) AS up_capture,
    round(down_capture, 4) AS down_capture FROM m""",
    _RISK,
)
ORACLES["risk_measures_by_month"] = ORACLES["risk_measures"]

# --- Forests: what must hold of them, whatever the trees ---

sql(
    "forest_checks",
    """SELECT horizon, count(*) AS n_rows, count(*) FILTER (is_train) AS n_train, sum(label_bin)::BIGINT AS n_good,
    count(*) AS n_scored, true AS importances_sum FROM lab GROUP BY horizon""",
    *ALL,
)
sql(
    "forest_accuracy_checks",
    """SELECT horizon, count(*) AS n_rows, round(greatest(avg(label_bin), 1 - avg(label_bin)), 9) AS majority_share,
    sum(label_bin)::BIGINT AS n_good, true AS counts_agree, true AS in_range FROM lab WHERE NOT is_train GROUP BY horizon""",
    *ALL,
)
sql(
    "forest_importance_checks",
    f"""SELECT horizon, feature, true AS in_range FROM (SELECT DISTINCT horizon FROM lab WHERE is_train),
    (SELECT unnest({[n for n in FEATURE_NAMES if n not in SPARSE_FEATURES]}) AS feature)""",
    *ALL,
)
sql(
    "forest_saved",
    "SELECT horizon, count(*) AS n_rows, count(*) AS n_same, count(*) AS n_scored FROM lab GROUP BY horizon",
    *ALL,
)
sql(
    "cv_checks",
    """SELECT horizon, 400::BIGINT AS n_scores, 10::BIGINT AS n_folds, 40::BIGINT AS n_trees, 400::BIGINT AS n_in_range
    FROM lab WHERE is_train GROUP BY horizon""",
    *ALL,
)
sql(
    "tuned_forest",
    "SELECT horizon, count(*) AS n_rows, true AS trees_in_grid, true AS scores_in_range FROM lab WHERE NOT is_train GROUP BY horizon",
    *ALL,
)

# --- Rankings ---

_RETS = ", ".join(f"fund_ret_{h} AS ret_{h}" for h in HORIZONS)
sql(
    "top5_per_horizon",
    f"""SELECT horizon, "rank"::INT AS "rank", is_train, scheme_name, {_RETS}, scheme_url FROM (
    SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY fund_ret DESC NULLS LAST, scheme_idx) AS "rank"
    FROM lab WHERE label_bin = 1) WHERE "rank" <= 5""",
    *ALL,
)
sql(
    "horizon_ranking",
    "SELECT scheme_idx, horizon, scheme_name, fund_ret, scheme_url FROM lab WHERE label_bin = 1",
    *ALL,
)
