import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from naviscope.operators import sections
from naviscope.schemas import DERIVED_HEADINGS
from naviscope.sources import feed, sinks

FEED = """Code;K1;K2;Scheme Name;Value;Day

Open Ended (Income)

Alpha House
101;A;B;Alpha  Bond   Fund - Growth;10.5;d1
102;A;B;Alpha Cash;1,000.25;d1

Beta House
201;A;B;Beta Bond-Plan A-Growth;N.A.;d1

Close Ended (Equity (Large))
Alpha House
103;A;B;Alpha Equity;7;d1
"""
EXPECTED = [
    ("101", "Open Ended (Income)", "Open Ended ", "Income", "Alpha House", "a", "Alpha Bond Fund"),
    ("102", "Open Ended (Income)", "Open Ended ", "Income", "Alpha House", "a", "Alpha Cash"),
    ("201", "Open Ended (Income)", "Open Ended ", "Income", "Beta House", None, "Beta Bond"),
    ("103", "Close Ended (Equity (Large))", "Close Ended (Equity ", "Equity (Large)", "Alpha House", "a", "Alpha Equity"),
]


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([("Alpha House", "a")], "family string, family_id string")


@pytest.fixture
def small_blocks(spark):
    """Splits of a few bytes, so that sections cross block borders."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def write(tmp_path, **files):
    for name, body in files.items():
        (tmp_path / f"{name}.txt").write_bytes(body.encode())
    return str(tmp_path)


def derived(rows):
    return sorted(tuple(r[c] for c in ("Code", *DERIVED_HEADINGS)) for r in rows.collect())


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_feed(spark, tmp_path, dimension, small_blocks, block, ends):
    path = write(tmp_path, a=FEED.replace("\n", ends))
    small_blocks(block)
    rows, rejects = feed.enriched_feed(feed.read_lines(spark, path), dimension)
    assert derived(rows) == sorted(EXPECTED)
    assert rejects.count() == 0
    names = {r["Code"]: r["Scheme Name"] for r in rows.collect()}
    assert names["101"] == "Alpha Bond Fund - Growth"
    if block == 7:
        assert feed.read_lines(spark, path).select("block").distinct().count() > 5


def test_headers_differ_by_file(spark, tmp_path, dimension):
    other = "Code;Scheme Code;ISIN;Scheme Name\nT (C)\nAlpha House\n9;x;y;Z - G\n"
    path = write(tmp_path, a=FEED, b=other)
    lines = feed.read_lines(spark, path)
    assert set(feed.heading_names(lines)) == {"Code", "K1", "K2", "Scheme Name", "Value", "Day", "Scheme Code", "ISIN"}
    rows, _ = feed.enriched_feed(lines, dimension)
    last = rows.filter("Code = '9'").first()
    assert (last["ISIN"], last["K1"], last["Scheme Short Name"], last["Scheme Type"]) == ("y", None, "Z", "T ")
    assert rows.count() == 5


def test_rejects_data_without_header_and_unknown_families(spark, tmp_path, dimension):
    body = "Code;K1;K2;Scheme Name\n1;a;b;Early\nOnly Family\n2;a;b;One\n3;a;b\n4;a;b;c;d\n"
    lines = feed.read_lines(spark, write(tmp_path, a=body))
    rows, rejects = feed.enriched_feed(lines, dimension)
    found = {r["Code"]: (r["Scheme Classification"], r["Fund Family"], r["Fund ID"]) for r in rows.collect()}
    assert found == {"1": (None, None, None), "2": (None, "Only Family", None)}
    assert sorted(r.line for r in rejects.collect()) == ["3;a;b", "4;a;b;c;d"]
    missing = sections.unmatched_families(sections.with_context(lines), dimension)
    assert {r.family: r.n_rows for r in missing.collect()} == {None: 1, "Only Family": 3}
    strict, _ = feed.enriched_feed(lines, dimension, strict=True)
    with pytest.raises(PySparkException, match="unknown family"):
        strict.collect()


def machine(lines):
    """Context of every line, read one after the other."""
    kind, family, open_header, out = None, None, False, []
    for marker, line in lines:
        if marker:
            if open_header:
                kind = family
            open_header = not open_header
            family = line
        else:
            open_header = False
        out.append((kind, family))
    return out


@pytest.mark.parametrize("chunk", [1, 3, 8, 1000])
def test_context_equals_the_state_machine(spark, chunk):
    rng = random.Random(chunk)
    data, wanted = [], {}
    for key in range(40):
        share = rng.choice([0.2, 0.5, 0.9, 1.0])
        lines = [(rng.random() < share, f"{key}-{i}") for i in range(rng.choice([1, 2, 60]))]
        wanted.update({(key, i): c for i, c in enumerate(machine(lines))})
        data += [(key, i, m, s) for i, (m, s) in enumerate(lines)]
    df = spark.createDataFrame(data, "key int, pos long, m boolean, line string")
    df = df.withColumn("chunk", F.floor(F.col("pos") / chunk))
    out = sections.add_section_context(df, ["key"], "chunk", ["pos"], "line", "m")
    rows = out.collect()
    assert {(r.key, r.pos): (r.section_type, r.section_family) for r in rows} == wanted
    assert all(r.line_no == r.pos for r in rows)


def test_delimited_round_trip(spark, tmp_path):
    rows = [("a;b", ' "q" ', None), ("x", "", "line"), (" y ", "back\\slash", "z")]
    df = spark.createDataFrame(rows, "`A B` string, c string, d string")
    path = str(tmp_path / "out")
    sinks.write_delimited(df, path, ["d", "A B", "c"])
    back = sinks.read_delimited(spark, path, df.select("d", "A B", "c").schema)
    assert back.columns == ["d", "A B", "c"]
    wanted = df.withColumn("c", F.nullif("c", F.lit("")))
    assert sorted(map(str, back.select("A B", "c", "d").collect())) == sorted(map(str, wanted.collect()))
