"""The native filters (license, URL, quality) against plain Python."""

import collections
import math
import re

from naviscope.llm import licenses, quality, urls


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def notices_of(words):
    """(score, label, first, last) of templates in runs of words, from every place that a template's word starts, closest ones."""
    found = set()
    for label, text in licenses.TEMPLATES:
        own, width = set(text.split()), math.ceil(1.25 * len(text.split()))
        need = licenses.needed(len(own))
        runs = []
        for s in range(len(words)):
            run = words[s : s + width]
            places = [s + j for j, w in enumerate(run) if w in own]
            n = len(own & set(run))
            if places:
                runs.append((n, places[0] - places[-1], places[0], places[-1], s))
        for p in range(len(words)):
            near = [r[:4] for r in runs if p - width < r[4] <= p]
            if words[p] in own and near and max(near)[0] >= need:
                n, _, first, last = max(near)
                found.add((n / len(own), label, first, last))
    covered = lambda m: any(a[0] > m[0] and 2 * (min(a[3], m[3]) - max(a[2], m[2]) + 1) >= m[3] - m[2] + 1 for a in found)
    return [m for m in found if not covered(m)]


def licenses_of(text):
    words = words_of(text)
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels, best = {x for _, x in places}, 0.0
    for line in (text or "").split("\n"):
        block = set(words_of(line))
        scores = [(len(set(t.split()) & block) / len(set(t.split())), label) for label, t in licenses.TEMPLATES]
        top = max(scores)[0]
        if top >= licenses.CONTAINMENT:
            labels |= {label for s, label in scores if s == top}
            best = max(best, top)
    notices = notices_of(words)
    labels |= {label for _, label, _, _ in notices}
    best = max([best, *[s for s, *_ in notices]])
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), 1.0 if places else best


def test_licenses(spark, documents, awkward, no_documents):
    lines = [
        (-1, "Licensed under CC BY-NC 4.0. MIT license, mit LICENSE\nof the Apache License"),
        (-2, "subject of the terms Mozilla public license this source code form is to\nnothing"),
        (-3, "Mozilla public license\nthis source code form is subject to the terms of the"),
        (-4, "gnu general public\nlicense " * 3),
        (-5, "permission granted free of charge any person obtaining copy this software x y z of to"),
    ]
    df = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).unionByName(spark.createDataFrame(lines, "doc_id long, text string"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    found = sorted(((r["doc_id"], *[r[n] for n in names]) for r in licenses.scan(df.selectExpr("*", "1 AS labels", "2 AS _words")).collect()), key=str)
    assert found == sorted(((r["doc_id"], *licenses_of(r["text"])) for r in df.collect()), key=str)
    assert any(r[6] == "mpl" for r in found) and licenses.scan(no_documents).count() == 0


def test_wrapped_and_neighbouring_notices(spark):
    by_label = {label: text for label, text in licenses.TEMPLATES}
    rows = [(i, "some prose before it\n" + by_label[x].replace(" of ", "\n * of ").replace(" and ", "\n * and ").replace(" to ", "\n# to ") + "\nand after") for i, x in enumerate(("mit", "bsd", "isc", "gpl", "mpl"))]
    rows += [(10, by_label["gpl"] + " or else " + by_label["bsd"].replace("binary", "other")), (11, "Licensed under CC BY-NC 4.0"), (12, "nothing here"), (13, None)]
    found = {r["doc_id"]: (r["notice_labels"], r["notice_score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in range(5)] == [(x, 1.0) for x in ("mit", "bsd", "isc", "gpl", "mpl")]
    whole = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert whole[0] == ("mit", 1.0) and whole[10][0] == "bsd,gpl"
    assert found[10] == ("bsd,gpl", 1.0) and found[11] == ("cc-by-nc", 1.0) and found[12] == found[13] == ("", 0.0)


def counts_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.defaultdict(list)
    for k in range(len(words) - 4):
        windows[tuple(words[k : k + 5])].append(k)
    covered = {i for v in windows.values() if len(v) > 1 for k in v for i in range(k, k + 5)}
    n = len(words)
    base = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)
    return base, len(lines)


def verdicts(rows):
    """(base counts, kept) of each (text, lang, source), by exact quantiles."""
    measured, groups = [], collections.defaultdict(lambda: collections.defaultdict(list))
    for text, lang, source in rows:
        base, n_lines = counts_of(text)
        m = {"symbols_per_word": base[2] / base[0], "word_length": base[1] / base[0], "repeated_lines": base[3] / n_lines} if base[0] else {}
        measured.append((base, n_lines, m, lang, source))
        if not base[-1]:
            for key in ((lang, source), (lang,), ()):
                for k, v in m.items():
                    groups[key][k].append(v)
    out = []
    for base, n_lines, m, lang, source in measured:
        kept = not base[-1]
        for k, (outer, size, chance) in quality.MEASURES.items():
            if not kept:
                break
            whole, *narrower = [sorted(groups[key][k]) for key in ((), (lang,), (lang, source))]

            def quantile(p):
                found = whole[math.ceil(p * len(whole)) - 1]
                for values in filter(None, narrower):
                    weight = len(values) / (len(values) + float(quality.SUPPORT))
                    found = weight * values[math.ceil(p * len(values)) - 1] + (1 - weight) * found
                return found

            low, middle, high = (quantile(p) for p in (round(1 - outer, 9), 0.5, outer))
            group = chance / math.sqrt(max(1, len(narrower[-1])))
            text_size = chance / math.sqrt(max(1, base[0] if size == "n_words" else n_lines))
            kept &= (middle - quality.REACH * (middle - low) - group) - text_size <= m[k] <= (middle + quality.REACH * (high - middle) + group) + text_size
        out.append((base, kept))
    return out


def test_quality(documents, awkward, no_documents):
    columns = ["doc_id", "text", "lang", "source"]
    repeated = awkward.select(*columns)
    for df in (documents.select(*columns).unionByName(repeated), repeated):
        rows = df.collect()
        wanted = [(r["doc_id"], *base, kept) for r, (base, kept) in zip(rows, verdicts([tuple(r)[1:] for r in rows]))]
        found = quality.judge(df.selectExpr("*", "'x' AS n_words", "'y' AS kept")).select("doc_id", *quality.COUNTS, "base_failed", "kept").collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    kept = quality.kept_documents(df.selectExpr("*", "1 AS n_words"))
    assert kept.columns == [*columns, "n_words"] and kept.count() == sum(w[-1] for w in wanted)
    assert quality.judge(no_documents).count() == 0 and quality.kept_documents(no_documents).count() == 0


def test_fences_move_with_a_group_s_spread(spark):
    """The same text is kept where its source is as varied, and rejected where the source is not."""
    import random

    rng = random.Random(2)
    plain = lambda n: " ".join(rng.choice(("river", "lakes", "stone", "house", "green", "light")) + str(i) for i in range(n))
    marked = lambda n: " ".join(w + ("#" if i % 3 == 0 else "") for i, w in enumerate(plain(n).split()))
    rows = [(i, plain(60) if i % 4 else marked(60), "en", "varied") for i in range(400)] + [(1000 + i, plain(60), "en", "even") for i in range(400)]
    probe = marked(60)
    rows += [(5000, probe, "en", "varied"), (5001, probe, "en", "even")]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept[5000] and not kept[5001] and sum(kept.values()) == len(rows) - 1


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark, sf_dir):
    odd = [None, "", "no scheme/x", "http://", "HTTP://A.Net?x=/es/", "http://notnet/es/1", "http://com/es/", "x://WWW.EXAMPLE.com/en/?a://b/c", "http://example.com#/en/", "http://é.example.net/fr/ü\n", "a://b.net/es/x?y", "a://b.net/es/x?y"]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    df = pages.unionByName(spark.createDataFrame([(None if i == 3 else -1 - i, u) for i, u in enumerate(odd)], "page_id long, url string"))
    found = urls.judge(df.selectExpr("*", "1 AS host", "2 AS uid", "3 AS verdict")).collect()
    assert len(found) == df.count()
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r["page_id"]].append(r)
    for r in df.collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r["url"] or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        rule, verdict = rule_of(host, path)
        (got,) = by_id[r["page_id"]]
        assert (got["host"], got["path"], got["rule"]) == (host, path, rule)
        assert got["verdict"] == verdict if verdict else got["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0
    only = urls.judge(spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")).first()
    assert (only["rule"], only["verdict"]) == (None, "allow")


def test_grams_are_all_runs_of_characters(spark):
    import time

    texts = ["", None, "a", "http://é.org/😀/漢?a=\n1", "😀" * 9, "x" * 200_000]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "uid long, url string").select("uid", urls.framed("url").alias("framed"))
    start = time.time()
    found = collections.Counter(map(tuple, urls.grams(rows, "uid").collect()))
    assert time.time() - start < 60
    framed = [urls.START * urls.MEMORY + (t or "") + urls.END for t in texts]
    assert found == collections.Counter((i, t[k : k + urls.MEMORY + 1]) for i, t in enumerate(framed) for k in range(len(t) - urls.MEMORY))


def test_pieces_of_urls_are_not_broadcast(spark, monkeypatch):
    """However small the files of URLs and model are: their pieces may be millions."""
    plans, write = {}, urls.materialise
    explain = lambda df: df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    monkeypatch.setattr(urls, "materialise", lambda df, name: plans.update({name: explain(df)}) or write(df, name))
    rows = spark.range(2000).selectExpr("id AS page_id", "concat('http://a', id % 9, '.org/', repeat('x', 200)) AS url")
    assert urls.judge(rows).count() == 2000
    assert "Generate" in plans["url-scores"] and "Broadcast" not in plans["url-scores"]


def test_url_model_learns_what_rules_say(spark):
    """Held-out accuracy: half of the paths are judged by rules, the rest by the model."""
    rows = [(i, f"http://{'spam' if i % 2 else 'good'}{i % 7}.org/{'pills' if i % 2 else 'story'}-{i}") for i in range(400)]
    rules = [("block", f"spam{k}.org", "/") for k in range(4)] + [("allow", f"good{k}.org", "/") for k in range(4)]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule IS NULL").collect()
    assert len(found) > 100
    assert sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in found) / len(found) > 0.95


def test_url_model_sees_whole_urls(spark):
    """Only a query, letters outside ASCII, the digits or a text without `://` tell these apart."""
    pairs = (("http://{h}/p?ref=spam{i}", "http://{h}/p?id=story{i}"), ("http://{h}/казино", "http://{h}/погода"), ("http://{h}/777777", "http://{h}/123123"), ("spam-pills-{i}", "good-story-{i}"))
    for bad, good in pairs:
        rows = []
        for i in range(80):
            text, kind = (bad, "bad") if i % 2 else (good, "fine")
            host = f"{kind}{i}.org" if i < 40 else "new.net"
            url = text.format(h=host, i=i)
            rows.append((i, url if "://" in url or i >= 40 else f"http://{host}/{url}"))
        rules = [("block" if i % 2 else "allow", f"{'bad' if i % 2 else 'fine'}{i}.org", "/") for i in range(40)]
        found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule IS NULL").collect()
        assert len(found) == 40 and all((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in found)
