"""Jaccard join, decontamination, personal data, main text and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from naviscope.llm import leaks, main_text, near, pii
from test_filters import verdicts


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def classes(rows):
    """(class id, links, least copy, class number) of each (doc_id, text), over all pairs."""
    sets = [shingles(t) for _, t in rows]
    low = lambda ids: None if None in ids else min(ids)
    linked = [[j for j in range(len(rows)) if i != j and sets[i] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))] for i in range(len(rows))]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        out.append((low([rows[j][0] for j in seen]), len(linked[i]), low([rows[j][0] for j in linked[i] if sets[i] == sets[j]] + [key]), min(seen)))
    return out


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((3, 6, 40, 150)))]
        for _ in range(rng.randint(1, 7)):
            mine = list(words)
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                mine[rng.randrange(len(mine))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(mine)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_join(copies, documents, awkward, no_documents):
    for df in (copies, documents.select("doc_id", "text"), awkward):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        found = [tuple(r) for r in near.join(df).select("doc_id", "class_id", "n_links", "copy_id").collect()]
        assert sorted(found, key=str) == sorted(((r[0], *c[:3]) for r, c in zip(rows, classes(rows))), key=str)
    assert near.join(no_documents).count() == 0


def test_blocks_of_a_large_group(copies, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in copies.collect()]
    monkeypatch.setattr(near, "BLOCK_NODES", 2)
    found = [tuple(r) for r in near.join(copies).select("doc_id", "class_id", "n_links", "copy_id").collect()]
    assert sorted(found) == sorted((r[0], *c[:3]) for r, c in zip(rows, classes(rows)))


def test_one_row_of_each_class_stays(copies, awkward, documents):
    for df in (copies, awkward, documents):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        kept = near.without_duplicates(df)
        groups = {c[3] for c in classes(rows)}
        assert kept.columns == df.columns and kept.count() == len(groups)


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    hub = [(100, i) for i in range(101, 400)]
    loose = [(rng.randint(500, 900), rng.randint(500, 900)) for _ in range(250)]
    for links in (chain, hub, loose, [*chain, *hub, (39, 399), *loose], [(7, 7)]):
        root = {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = sorted((top(a), top(b)))
            root[b] = a
        wanted = {(x, top(x)) for pair in links for x in pair if top(x) != x}
        found = near.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted
    assert near.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_depth():
    assert near.prefix_depth() == 6 and near.prefix_depth(recall=0.5) == near.DEPTH and near.prefix_depth(recall=1) == 1


def distance(piece, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(piece, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_lemma_loses_no_occurrence():
    rng, table = random.Random(1), leaks.fold_table()
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    hits = 0
    for _ in range(120):
        passage = some(rng.randint(2, 30))
        text = list(passage)
        for _ in range(rng.randint(0, max(1, len(text) // 14))):
            k = rng.randrange(len(text))
            text[k : k + rng.randint(0, 1)] = rng.choice(("", "x", "-"))
        whole = f"{some(15)} {''.join(text).upper()}\n{some(15)}"
        index = leaks.Passages([(1, passage)], table)
        found = index.search(["zz", whole, ""], table)
        codes = leaks.fold([whole], table)[0][:-1].tolist()
        if not index.codes:
            assert not found
            continue
        code = index.codes[0].tolist()
        size = min(len(code), leaks.REGION)
        least = min(distance(code[s : s + size], codes) for s in range(len(code) - size + 1))
        assert set(found) == ({(1, 0)} if least <= leaks.budget(size)[0] else set())
        hits += len(found)
        assert all(edits == least for edits, _, _ in found.values())
    assert hits > 50


def test_every_quote_of_80_characters_is_found():
    rng, table = random.Random(8), leaks.fold_table()
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(80))[:400]
    index = leaks.Passages([(1, passage)], table)
    texts = [f"{rng.random()} {passage[a : a + n]} {rng.random()}" for n in (80, 81, 90, 100, 115, 130) for a in range(0, 400 - n + 1)]
    # A quote that begins or ends within a run of blanks or signs folds to one character less.
    folded = [len(leaks.fold([passage[a : a + n].strip()], table)[0]) - 1 for n in (80, 81, 90, 100, 115, 130) for a in range(0, 400 - n + 1)]
    found = {t for t, _ in index.search(texts, table)}
    assert found >= {t for t, n in enumerate(folded) if n >= 80} and len(found) > 1500
    short = [f"{rng.random()} {passage[a : a + 60]} {rng.random()}" for a in range(0, 340)]
    assert not index.search(short, table)


def test_hits_are_taken_in_slices(monkeypatch):
    import resource

    rng, table = random.Random(4), leaks.fold_table()
    passages = [(1, "a" * 200), (2, "ab " * 90), (3, " ".join(rng.choice(["one", "two", "three"]) for _ in range(60)))]
    index = leaks.Passages(passages, table)
    texts = ["a" * 300 + " x " + "ab " * 50, passages[2][1][30:140], "aa " * 400, passages[2][1][5:70] + "q" + passages[2][1][70:200]]
    wanted = index.search(texts, table)
    assert {k: v[0] for k, v in wanted.items()}.items() >= {(0, 0): 0, (0, 1): 0, (1, 2): 0}.items()
    for hits in (1, 50, 3000):
        monkeypatch.setattr(leaks, "HITS", hits)
        assert {k: v[0] for k, v in index.search(texts, table).items()} == {k: v[0] for k, v in wanted.items()}
    monkeypatch.undo()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert leaks.Passages(passages[:1], table).search(["a" * 1_000_000], table) == {(0, 0): (0, 0, 80)}
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000


def leaking(rows, passages):
    """(doc_id, item_id) by plain search, for texts that hold folded passages unchanged."""
    table = leaks.fold_table()
    folded = lambda t: "".join(map(chr, leaks.fold([t or ""], table)[0][:-1]))
    texts = [(k, folded(t)) for k, t in rows]
    return {(k, i) for i, p in passages for k, t in texts if len(folded(p).strip()) >= leaks.Q and folded(p).strip() in t}


def test_decontamination(spark, sf_dir, awkward, no_documents, monkeypatch):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, passages = ([tuple(r) for r in df.collect()] for df in (documents.select("doc_id", "text"), benchmark.select("item_id", "text")))
    wanted = leaking(rows, passages)
    found = leaks.search(documents, benchmark).collect()
    assert wanted and {(r["doc_id"], r["item_id"]) for r in found} >= wanted
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 300)
    assert sorted(leaks.search(documents, benchmark).collect()) == sorted(found)
    clean = leaks.clean_documents(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r["doc_id"] for r in clean.collect()} == {k for k, _ in rows} - {r["doc_id"] for r in found}
    odd = spark.createDataFrame([(None, "w100 W101, w102 w103!"), (7, None), (8, "short"), (9, "")], "item_id long, text string")
    assert [tuple(r)[:1] + (r["item_id"],) for r in leaks.search(awkward, odd).collect()] == [(4, None)]
    assert leaks.search(no_documents, benchmark).count() == leaks.search(documents, odd.limit(0)).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    good = {"email": lambda m: True, "ip": lambda m: all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")), "card": lambda m: 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m)), "phone": lambda m: 8 <= len(digits(m)) <= 15}
    return {k: [m.span() for m in re.finditer(p, text) if good[k](m)] for k, p in BASE.items()}


def test_base_spans(documents):
    rng, found = random.Random(1), pii.anchors()
    noise = ["".join(rng.choice(c) for _ in range(rng.randint(1, 60))) for c in ("ab1.@-+ ", "0123456789 -+.()", "aé@.1", "+1 4") for _ in range(3000)]
    for text in [*noise, *[r["text"] or "" for r in documents.select("text").collect()], "4111 1111 1111 1111 x@y.z +1 (555) 010-9999", "0" * 10_000 + "1.1.1.1", "1.2.3." + "9" * 10_000, "0.0.0.0"]:
        spans = pii.find(text, found)
        assert {k: spans.get(k, []) for k in pii.BASE} == base_spans(text)


def test_more_kinds_and_redaction():
    found = pii.anchors()
    text = "Account no: 12345678, IBAN DE89 3704 0044 0532 0130 00; ftp://bob:pw@h.example/x token = \"abcdefgh1\" a@b.cd"
    spans = pii.find(text, found)
    assert [text[s:e] for k in ("account", "iban", "secret", "login") for s, e in spans[k]] == ["12345678", "DE89 3704 0044 0532 0130 00", "abcdefgh1", "bob:pw@h.example"]
    assert pii.redact(text, spans) == 'Account no: [ACCOUNT], IBAN [IBAN]; ftp://[LOGIN]/x token = "[SECRET]" [EMAIL]'
    assert "iban" not in pii.find("IBAN DE88 3704 0044 0532 0130 00", found) and pii.find("", found) == {}


def test_pii_rows(awkward, no_documents):
    rows = pii.scan(awkward).collect()
    assert len(rows) == awkward.count() and {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert pii.scan(no_documents).count() == pii.redacted(no_documents).count() == 0
    assert sorted(pii.redacted(awkward).collect(), key=str) == sorted(awkward.collect(), key=str)


PAGE = "<html><head><title>t</title></head><body><div class=top><p>{site}</p></div><nav><a>m</a></nav>{body}<footer>f</footer>"


def test_templates_go_and_articles_stay(spark):
    body = "<div><p>text {i} &amp; <b>more&nbsp; x</b><br>y<p>z{i}<ul><li>a{i}<li>b{i}</ul></div>"
    rows = [(i, "http://a.example/x", PAGE.format(site="Welcome to a", body=body.format(i=i))) for i in range(6)]
    rows += [(10 + i, "http://b.example/x", PAGE.format(site=f"Only {i}", body=f"<article><h1>T{i}</h1><p>same</article><p>out")) for i in range(6)]
    rows += [(None, None, None), (30, "x", ""), (31, None, "<p>a"), (31, None, "<p>a"), (32, "http://c/", "<script>var a='<p>no</p>'</script><!-- x --><div id='user-comments'>c</div>ok")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    found = {(r["page_id"], r["text"]) for r in main_text.extract(df).collect()}
    assert found == {*((i, f"text {i} & more x y\nz{i}\na{i}\nb{i}") for i in range(6)), *((10 + i, f"T{i}\nsame") for i in range(6)), (None, ""), (30, ""), (31, "a"), (32, "ok")}
    assert main_text.extract(df).count() == len(rows) and main_text.extract(df.limit(0)).count() == 0


def test_templates_within_articles_and_on_part_of_a_host(spark):
    box = "<div class=x1><p>Jane Doe</p><p>writes about rivers.</p></div>"
    notice = "<p>This text was first printed elsewhere.</p>"
    rows = [(i, "http://a.example/x", f"<body><article><h1>Rivers and lakes</h1>{notice}<p>story {i}</p>{box}</article></body>") for i in range(5)]
    # A menu on 10 of 100 pages without an article.
    rows += [(100 + i, "http://b.example/x", f"<body>{'<div><p>Section menu</p></div>' if i < 10 else ''}<p>other {i}</p></body>") for i in range(100)]
    # Copies of one page are no evidence of a template.
    rows += [(300 + i, "http://c.example/x", "<body><article><p>A page that is stored often.</p><p>It has two parts.</p></article></body>") for i in range(6)]
    # What recurs beside the article in its wrapper doesn't take the article away.
    rows += [(400 + i, "http://d.example/x", f"<body><div><p>Hello</p><article><p>tale {i}</p></article></div></body>") for i in range(6)]
    found = {r["page_id"]: r["text"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    wanted = {i: f"Rivers and lakes\nstory {i}" for i in range(5)} | {100 + i: f"other {i}" for i in range(100)}
    wanted |= {300 + i: "A page that is stored often.\nIt has two parts." for i in range(6)} | {400 + i: f"tale {i}" for i in range(6)}
    assert found == wanted


def test_malformed_and_deep_pages(spark):
    import time

    deep = [("<b>", "</b>"), ("<div>", "</div>"), ("<foo>", "</foo>"), ("<b><p>", ""), ("<li><b>", "")]
    pages = ["<![foo[x]]>a", "<![ a", "<![CDATA[x]]>b", "<!", "<p>c<![if !IE]>d<![endif]></p>", "a" + "<ul><li>" * 30_000 + "z"]
    pages += [f"<article>{o * 50_000}word" for o, _ in deep] + [f"{o * 20_000}x{c * 20_000}<p>y" for o, c in deep]
    pages += ["<b>" * 20_000 + "<p>q</p>" * 20_000, "<li>" + "<ul>" + "<b>" * 20_000 + "<li>q</li>" * 20_000]
    start = time.time()
    found = [main_text.Page(h).main_text(lambda d: False) for h in pages]
    assert time.time() - start < 60
    assert found[:5] == ["a", "", "b", "", "cd"] or found[:5] == ["a", "<![ a", "b", "<!", "cd"]
    assert found[5] == "a\nz" and set(found[6:11]) == {"word"} and all(f.split() in (["x", "y"], ["xy"]) for f in found[11:16])
    df = spark.createDataFrame([(i, "http://x.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    assert main_text.extract(df).count() == len(pages)


def test_what_some_articles_of_a_host_share_stays(spark, monkeypatch):
    shared = "<p>A paragraph that several articles have in common.</p>"
    rows = [(i, "http://a.example/x", f"<article>{shared if i < 5 else ''}<p>story number {i}</p></article>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = {i: "A paragraph that several articles have in common.\n" * (i < 5) + f"story number {i}" for i in range(12)}
    assert {r["page_id"]: r["text"] for r in main_text.extract(df).collect()} == wanted
    monkeypatch.setattr(main_text, "BROADCAST_HASHES", 0)
    assert {r["page_id"]: r["text"] for r in main_text.extract(df).collect()} == wanted


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_given_pages(spark, sf_dir):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in main_text.extract(pages).collect():
        article = re.search(r"(?s)<article>(.*?)</article>", given[r["page_id"]])[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pipeline(spark, sf_dir, vocabulary):
    from tokenizers import Tokenizer

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    passages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r[:2] for r, (_, kept) in zip(rows, verdicts([r[1:] for r in rows])) if kept]
    rows = [r for r, c in zip(rows, classes(rows)) if c[0] == r[0]]
    leaked = {k for k, _ in leaking(rows, passages)}
    found, library = pii.anchors(), Tokenizer.from_file(vocabulary)
    wanted = {}
    for key, text in rows:
        if key not in leaked:
            ids = library.encode(pii.redact(text, pii.find(text, found)), add_special_tokens=False).ids
            wanted[key] = np.array(ids, "<u4").tobytes()
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in got} == wanted and len(got) == len(wanted)


def test_stages_keep_the_columns_and_bear_empty_tables(spark, sf_dir, awkward, no_documents):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == list(corpus_pipeline.DOCUMENT), name
        assert stage(spark, no_documents, sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
