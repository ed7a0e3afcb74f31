"""What runs in Python workers must not need this package there."""

import base64
import subprocess
import sys

import pyarrow as pa
from pyspark import cloudpickle

from naviscope.functions import html
from naviscope.schemas import DETAIL_SCHEMA, FAMILY_SCHEMA, PERFORMANCE_SCHEMA, SCHEME_SCHEMA

CHECK = """
import base64, pickle, sys
import pyarrow as pa
run = pickle.loads(base64.b64decode(sys.argv[1]))
batch = pa.RecordBatch.from_pydict({"page_id": [7], "html": ["<p class='a'>x</p>"]})
print(next(run([batch])).to_pylist())
assert "naviscope" not in sys.modules
"""


def test_page_parser_is_self_contained(tmp_path):
    run = html.page_parser({"t": (html.parse_selector("p.a"), "nodes")})
    body = base64.b64encode(cloudpickle.dumps(run)).decode()
    done = subprocess.run([sys.executable, "-c", CHECK, body], cwd=tmp_path, capture_output=True, text=True)
    assert "'text': 'x'" in done.stdout, done.stderr


def test_selectors():
    page = html.PageTree(
        "<div id=a class='x y'><ul><li>1<li><b>2</b></ul></div><div class=x><li>3</div><br/><!-- <li>4 -->"
    ).nodes

    def texts(selector):
        return [n.only_text() for n in html.select(page, html.parse_selector(selector))]

    assert texts("li") == ["1", "2", "3"]
    assert texts("#a li") == ["1", "2"]
    assert texts(".x.y ul li b") == ["2"]
    assert texts("div.x li") == ["1", "2", "3"]
    assert texts(".y .x") == []


def test_declared_schemas_are_text():
    for schema in (FAMILY_SCHEMA, SCHEME_SCHEMA, DETAIL_SCHEMA, PERFORMANCE_SCHEMA):
        assert all(f.dataType.typeName() == "string" and f.nullable for f in schema)
    assert len(SCHEME_SCHEMA) == 12 and len(DETAIL_SCHEMA) == 9


def test_empty_batch():
    run = html.page_parser({"t": (html.parse_selector("p"), "rows")})
    empty = pa.RecordBatch.from_pydict({"page_id": pa.array([], pa.int64()), "html": pa.array([], pa.string())})
    assert next(run([empty])).num_rows == 0


def test_batches_are_handed_on_in_parts():
    run = html.page_parser({"t": (html.parse_selector("table"), "first_table")})
    bodies = [f"<table><tr>{f'<td>{i}</td>' * (i % 50)}</tr></table>" for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"page_id": [*range(1999), None], "html": bodies})
    parts = list(run([batch]))
    cells = [sum(len(row) for page in part.column("t").to_pylist() for row in page) for part in parts]
    assert sum(cells) == sum(i % 50 for i in range(2000)) and max(cells) <= html.CELLS + 50
    found = [(r["page_id"], [c["text"] for c in r["t"][0]]) for part in parts for r in part.to_pylist()]
    assert found == [(i if i < 1999 else None, [str(i)] * (i % 50)) for i in range(2000)]
