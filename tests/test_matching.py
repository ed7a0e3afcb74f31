"""Similar names and sources joined by key, against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from naviscope.operators import joins, similar
from naviscope.plans import binding
from naviscope.plans.catalog import _name_key
from naviscope.session import materialise


def plain(name):
    return re.sub(r"[^a-z0-9]+", " ", (name or "").lower()).strip()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def grams(name):
    padded = f"  {name} "
    return {padded[i : i + 3] for i in range(len(name) + 1)}


def all_pairs(left, right):
    """(matched name, id, candidates, edits) of each left name, by comparing every pair."""
    names = sorted({("l", plain(n)) for n in left if plain(n)} | {("r", plain(n)) for _, n in right if plain(n)})
    df = Counter(g for _, n in names for g in grams(n))
    weight = {g: (len(names) // f).bit_length() or 1 for g, f in df.items()}
    total = lambda s: sum(weight[g] for g in s)
    rights = {}
    for key, n in right:
        if plain(n):
            rights.setdefault(plain(n), []).append(key)
    out = {}
    for n in {plain(x) for x in left} - {""}:
        found = []
        for r in rights:
            shared, both = total(grams(n) & grams(r)), total(grams(n)) + total(grams(r))
            edits = edit_distance(n, r)
            if 10 * shared >= 6 * (both - shared) and edits <= max(len(n), len(r)) // 4:
                found.append((edits, both - 2 * shared, r))
        if found:
            edits, _, r = min(found)
            out[n] = (r, rights[r][0] if len(rights[r]) == 1 else None, len(rights[r]), edits)
    return [out.get(plain(x), (None, None, 0, None)) for x in left]


def sources(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    fed = [(r[0], r[1]) for r in part.selectExpr("p_partkey", binding.FEED_NAME).collect()]
    return fed, [(r[0], r[1]) for r in part.selectExpr("p_partkey", binding.SITE_NAME).collect()]


def awkward_names():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "growth", "fund", "index"]
    left = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(120)]
    right = [(i, n.replace("ph", "f", rng.randint(0, 1))) for i, n in enumerate(rng.sample(left, 80))]
    left += [None, "", " - ", "é", "alpha", "alpha", "x", "ab", "long " * 400]
    return [(i, n) for i, n in enumerate(left)], [*right, (200, None), (201, ""), (202, "alpha"), (203, "ALPHA"), (204, "x"), (205, "aab")]


@pytest.mark.parametrize("key_pairs", [similar.KEY_PAIRS, 20, 0])
def test_similar_names_equal_all_pairs(spark, key_pairs):
    left, right = awkward_names()
    fed, listed = spark.createDataFrame(left, "code long, feed_name string"), spark.createDataFrame(right, "scheme_idx long, scheme_name string")
    found = {r["code"]: tuple(r)[2:] for r in similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx", key_pairs).collect()}
    wanted = all_pairs([n for _, n in left], right)
    assert found == {k: (w[0], w[1], w[2], w[3]) for (k, _), w in zip(left, wanted)}
    assert sum(w[0] is not None for w in wanted) > 60


def test_perturbed_names_find_their_row(spark, sf_dir):
    left, right = sources(spark, sf_dir)
    fed, listed = spark.createDataFrame(left, "code long, feed_name string"), spark.createDataFrame(right, "scheme_idx long, scheme_name string")
    rows = similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx").collect()
    found = {r["code"]: (r["matched_name"], r["scheme_idx"], r["n_candidates"], r["edits"]) for r in rows}
    assert found == dict(zip([k for k, _ in left], all_pairs([n for _, n in left], right)))
    assert all(r["scheme_idx"] == r["code"] for r in rows if r["code"] % 5 in (0, 1, 3, 4))


def test_near_names_need_no_keys(spark, monkeypatch):
    left = ["alpha fund", "alpha fumd", "alpha fnd", "alphaa fund", "beta fund one", "alhpa fund", "x", "gamma funds", "éa índex"]
    right = ["alpha fund", "alphb fund", "beta fund two", "gamma fund", "gamma fundz", "y", "ea índex", "éa índexx"]
    rows = spark.createDataFrame([("l", n) for n in left] + [("r", n) for n in right], "side string, name string")
    weighed = materialise(similar.weighted(rows), "weighed")
    pairs = {tuple(r) for r in similar.candidate_pairs(weighed).collect()}
    equal = {p[0] for p in pairs if p[2] == 0}
    assert {tuple(r) for r in similar.near_pairs(weighed).collect()} == {p for p in pairs if p[2] == (0 if p[0] in equal else 1)} != set()
    seen, whole = [], similar.candidate_pairs
    monkeypatch.setattr(similar, "candidate_pairs", lambda rows, *a: seen.extend(r["name"] for r in rows.where("side = 'l'").collect()) or whole(rows, *a))
    fed, listed = spark.createDataFrame(list(enumerate(left)), "code long, feed_name string"), spark.createDataFrame(list(enumerate(right)), "scheme_idx long, scheme_name string")
    found = similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx").collect()
    assert sorted(seen) == sorted(set(left) - {p[0] for p in pairs if p[2] <= 1}) and len(seen) < len(left)
    for r in found:
        best = min(((e, a, n) for f, n, e, a in pairs if f == r["feed_name"]), default=(None, None, None))
        assert (r["edits"], r["matched_name"]) == (best[0], best[2])


def test_keys_of_many_pairs_grow(spark):
    names = [f"zzz{a}{b} tail{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrst"]
    rows = spark.createDataFrame([("l", n) for n in names] + [("r", n) for n in names], "side string, name string")
    weighed = similar.weighted(rows)
    sizes = similar.key_sizes(similar.first_keys(weighed))
    assert sizes.where("n_left * n_right > 30").count() > 0
    pairs = similar.candidate_pairs(weighed, 30)
    assert pairs.count() == pairs.distinct().count() == similar.candidate_pairs(weighed, 10**9).count()


def test_few_pairs_are_compared(spark, monkeypatch):
    """Names that differ in a number only: the pairs of all keys stay near the number of names, not its square."""
    kinds = [f"{a} {b} fund" for a in ("blue", "large", "cold") for b in ("ring", "gear", "plate", "bolt")]
    right = [f"{kinds[i % 12]} series {i}" for i in range(1000, 4000)]
    left = [f"{kinds[i % 12]} series {i} growth" for i in range(1000, 4000, 3)]
    sizes, write = [], similar.materialise
    monkeypatch.setattr(similar, "materialise", lambda df, name: sizes.append(write(df, name)) or sizes[-1] if name == "key-sizes" else write(df, name))
    fed, listed = spark.createDataFrame(list(enumerate(left)), "code long, feed_name string"), spark.createDataFrame(list(enumerate(right)), "scheme_idx long, scheme_name string")
    found = similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx").collect()
    assert all((r["matched_name"], r["edits"]) == (r["feed_name"].removesuffix(" growth"), 7) for r in found)
    pairs = sum(s.where("NOT large").agg(F.sum(F.col("n_left") * F.col("n_right"))).first()[0] or 0 for s in sizes)
    assert pairs < 20 * (len(left) + len(right)), pairs


def test_empty_sources(spark):
    fed = spark.createDataFrame([(1, "a b")], "code long, feed_name string")
    listed = spark.createDataFrame([], "scheme_idx long, scheme_name string")
    assert [tuple(r)[2:] for r in similar.similar_names(fed, listed, "feed_name", "scheme_name", "scheme_idx").collect()] == [(None, None, 0, None)]
    assert similar.similar_names(fed.limit(0), listed, "feed_name", "scheme_name", "scheme_idx").count() == 0


def test_every_nulled_name_is_listed_as_ambiguous(spark):
    listed = spark.createDataFrame([(1, "Blue Chip - Growth", "F"), (2, "blue  chip - Dividend", "F"), (3, "Value", "F"), (4, "Blue Chip", "G")], "scheme_idx long, scheme_name string, family_name string")
    fed = spark.createDataFrame([(10, "BLUE CHIP - Daily", "F"), (11, "value", "F"), (12, "blue chip", "G"), (13, "other", "F")], "code long, feed_name string, fund_family string")
    keys = lambda name, family: [_name_key(name), F.col(family)]
    found = {r["code"]: (r["scheme_idx"], r["n_candidates"]) for r in joins.name_matches(fed, listed, keys("feed_name", "fund_family"), keys("scheme_name", "family_name"), "scheme_idx").collect()}
    assert found == {10: (None, 2), 11: (3, 1), 12: (4, 1), 13: (None, None)}
    shared = joins.ambiguous_names(listed, {"name": _name_key("scheme_name"), "family": F.col("family_name")}, "scheme_idx").collect()
    assert {r["scheme_idx"] for r in shared} == {1, 2}


def test_bucketed_sources(spark):
    listed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 4), (None, 5)], "url string, scheme_idx long")
    details = spark.createDataFrame([("a", 1, "x"), ("c", 2, "y"), ("c", 3, "z"), ("d", 4, "w"), (None, 5, "n")], "url string, at long, risk string")
    rows, exceptions = joins.details_by_key(listed, details, "url", ["at"], buckets=3)
    assert sorted(map(tuple, rows.collect())) == [("a", 1, 1, "x"), ("c", 3, 3, "z"), ("c", 4, 3, "z")]
    assert sorted(map(tuple, exceptions.collect()), key=str) == sorted(
        [("b", "missing", 1), ("d", "extra", 1), ("c", "listed twice", 2), ("c", "repeated", 2), (None, "missing", 1), (None, "extra", 1)], key=str
    )
    for df in (rows, exceptions):
        assert "Exchange" not in df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
