"""Names of two sources matched by similarity, without comparing all pairs.

A name is the set of its character trigrams, each weighted by its rarity. Two names whose weighted
Jaccard similarity reaches the threshold share so much weight that neither can miss more than a
bounded part of its own. So candidates come from an equi-join on the rarest trigram they share,
which stands within the rare beginning (the prefix) of both. How long a prefix must be depends on
the other name's weight, so names are joined by classes of weight. A key with too many pairs is
replaced by longer ones, of that trigram and the next one shared, and so on; keys are hashes, and
what is left is compared by edit distance and by all trigrams.
"""

from pyspark.sql import functions as F

from naviscope.functions import text
from naviscope.session import materialise

# Share of the weight that two names must have in common, and of the longer name that may be edited.
SIMILARITY, EDITS = (6, 10), (1, 4)
# Pairs of one key from which on longer keys take its place, and the longest key.
KEY_PAIRS, KEY_LENGTH = 5_000, 8
# Pairs for each name of a key from which on it takes less to look at longer keys.
NAME_PAIRS = 2
# How many times as much as the lightest the heaviest name of a class of weight has, at most.
CLASS_WIDTH = 1.08


def plain_name(x):
    """Lower case, runs of anything but letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.lower(text.collapse_spaces(x)), r"[^\p{L}\p{N}]+", " "))


def trigrams(name):
    padded = F.concat(F.lit("  "), F.col(name), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substr(padded, i, F.lit(3))))


def weighted(names):
    """(side, name, grams, weights, rests, weight) of distinct (side, name): trigrams from the rarest to the most common.

    A trigram weighs as many bits as it takes to write how many times rarer than the number of
    names it is; in `grams` two digits of its weight follow it. Only trigrams that both sides have
    are listed; `weight` is that of all. `rests` is the weight from each to the end.
    """
    each = materialise(names.select("side", "name", F.explode(trigrams("name")).alias("gram")), "name-trigrams")
    total = names.agg(F.count(F.lit(1)).alias("n_names"))
    sides = [F.count_if(F.col("side") == s) for s in "lr"]
    counts = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), ((sides[0] > 0) & (sides[1] > 0)).alias("both"))
    # One row; the counts are stored, so that their real size decides how they are joined.
    counts = materialise(counts.join(F.broadcast(total)).withColumn("w", F.length(F.bin(F.expr("n_names div df")))), "trigram-weights")
    listed = F.when(F.col("both"), F.struct("df", "gram", "w"))
    rows = each.join(counts, "gram").groupBy("side", "name").agg(F.array_sort(F.collect_list(listed)).alias("t"), F.sum("w").alias("weight"))
    rows = rows.select("side", "name", F.transform("t", lambda t: F.concat(t["gram"], F.lpad(t["w"].cast("string"), 2, "0"))).alias("grams"), F.col("t.w").alias("weights"), "weight")
    rests = "reverse(aggregate(reverse(weights), array(0L), (a, x) -> array_append(a, element_at(a, -1) + x)))"
    return rows.select("side", "name", "grams", "weights", F.expr(f"slice({rests}, 1, size(weights))").alias("rests"), "weight")


def _reaches(shared, left, right):
    """Whether a shared weight makes the similarity of two names of these weights reach the threshold."""
    num, den = SIMILARITY
    return den * shared >= num * (left + right - shared)


def _class(weight):
    return F.floor(F.log(weight) / F.log(F.lit(CLASS_WIDTH))).cast("int")


def _hashed(rows):
    return rows.withColumn("id", F.xxhash64("name"))


def first_keys(rows):
    """Each name's prefix trigrams: side, id, key, at (place of the key's last trigram), got (the key's weight), ahead
    (the weight behind it), weight, whole (False).
    """
    num, den = SIMILARITY
    keys = _hashed(rows).withColumn("at", F.explode(F.expr(f"filter(sequence(0, size(rests)), i -> i < size(rests) AND {den} * rests[i] >= {num} * weight)")))
    keys = keys.withColumn("key", F.xxhash64(F.expr("grams[at]"))).withColumn("got", F.expr("weights[at]").cast("long"))
    return keys.select("side", "id", "key", "at", "got", _ahead(), "weight", F.lit(False).alias("whole"))


def classed_keys(keys, rows):
    """First keys for each class of weight of the other side that can be met there; `least` is the weight that must be shared."""
    num, den = SIMILARITY
    # As many rows as there are classes: the logarithm of a weight.
    classes = materialise(rows.groupBy("side", _class("weight").alias("other")).agg(F.min("weight").alias("low")), "weight-classes")
    classes = classes.select(F.when(F.col("side") == "l", "r").otherwise("l").alias("side"), "other", "low")
    keys = keys.withColumn("of", _class("weight")).join(F.broadcast(classes), "side")
    # What two names share is no more than the lighter one's weight.
    low = F.greatest("low", F.ceil(num * F.col("weight") / den))
    keys = keys.withColumn("least", F.ceil(num * (F.col("weight") + low) / (num + den))).where("got + ahead >= least")
    pair = [F.when(F.col("side") == "l", F.col(c)).otherwise(F.col(d)) for c, d in (("of", "other"), ("other", "of"))]
    return keys.withColumn("key", F.xxhash64("key", *pair)).drop("of", "other", "low")


def _ahead():
    return F.coalesce(F.expr("get(rests, at + 1)"), F.lit(0)).cast("long").alias("ahead")


def longer_keys(keys, rows):
    """Keys one trigram longer. A name that its key alone can carry keeps it too, marked as whole."""
    more = keys.join(_hashed(rows).select("side", "id", "grams", "weights", "rests"), ["side", "id"])
    more = more.withColumn("at", F.explode(F.expr("filter(sequence(at + 1, size(rests)), i -> i < size(rests) AND got + rests[i] >= least)")))
    more = more.withColumn("key", F.xxhash64("key", F.expr("grams[at]"))).withColumn("got", F.col("got") + F.expr("weights[at]"))
    more = more.select(*[c for c in keys.columns if c != "ahead"], _ahead()).select(*keys.columns)
    alone = keys.where("got >= least").withColumn("key", F.xxhash64("key", F.lit("whole"))).withColumn("ahead", F.lit(0).cast("long")).withColumn("whole", F.lit(True))
    return more.unionByName(alone)


def _sharing(pairs):
    """Pairs whose `shared` weight, that of their `common` trigrams, reaches the threshold."""
    pairs = pairs.withColumn("common", F.array_intersect("left_grams", "right_grams"))
    pairs = pairs.withColumn("shared", F.expr("aggregate(common, 0L, (a, x) -> a + int(right(x, 2)))"))
    return pairs.where(_reaches(F.col("shared"), F.col("left_weight"), F.col("right_weight")))


def _verified(pairs):
    """Pairs few enough edits apart: (left, right, edits, apart)."""
    num, den = EDITS
    allowed = F.floor(num * F.greatest(F.length("left_name"), F.length("right_name")) / den).cast("int")
    pairs = pairs.withColumn("edits", F.levenshtein("left_name", "right_name")).where(F.col("edits") <= allowed)
    return pairs.select(F.col("left_name").alias("left"), F.col("right_name").alias("right"), "edits", (F.col("left_weight") + F.col("right_weight") - 2 * F.col("shared")).alias("apart"))


def key_sizes(keys):
    sides = keys.groupBy("key").agg(F.count_if(F.col("side") == "l").alias("n_left"), F.count_if(F.col("side") == "r").alias("n_right"), F.max("whole").alias("whole"))
    return sides.where((F.col("n_left") > 0) & (F.col("n_right") > 0))


def candidate_pairs(rows, key_pairs=KEY_PAIRS):
    """(left, right, edits, apart): pairs whose weighted similarity reaches the threshold; `apart` is the weight not shared.

    A pair meets at the trigrams that the two share, from the rarest on, and may meet at others too.
    """
    out, keys = [], materialise(classed_keys(first_keys(rows), rows), "name-keys")
    for length in range(1, KEY_LENGTH + 1):
        # A whole key can't grow: its pairs share nothing else.
        n, pairs = F.col("n_left") + F.col("n_right"), F.col("n_left") * F.col("n_right")
        sizes = materialise(key_sizes(keys).withColumn("large", (pairs > F.least(F.lit(key_pairs), NAME_PAIRS * n)) & ~F.col("whole")), "key-sizes")
        last = length == KEY_LENGTH
        usable = keys.join((sizes if last else sizes.where("NOT large")).select("key"), "key")
        side = lambda s, n: usable.where(F.col("side") == s).select("key", *[F.col(c).alias(f"{n}_{c}") for c in ("id", "got", "ahead", "weight")])  # noqa: E731, B023
        # Positional filter: the key's trigrams are the first shared ones, the rest can add no more than either has left.
        met = side("l", "left").join(side("r", "right"), "key")
        met = met.where(_reaches(F.col("left_got") + F.least("left_ahead", "right_ahead"), F.col("left_weight"), F.col("right_weight")))
        out.append(materialise(met.select("left_id", "right_id").distinct(), "met-names"))
        large = sizes.where("large").select("key")
        if last or not large.limit(1).count():
            break
        keys = materialise(longer_keys(keys.join(large, "key"), rows), "name-keys")
    met = out[0]
    for part in out[1:]:
        met = met.unionByName(part)
    return _compared(met.distinct(), rows)


def _compared(met, rows):
    """(left, right, edits, apart) of the pairs among (left_id, right_id), hashes of names, that are alike."""
    num, den = EDITS
    rows = _hashed(rows)
    side = lambda s, n, *more: rows.where(F.col("side") == s).select(F.col("id").alias(f"{n}_id"), *[F.col(c).alias(f"{n}_{c}") for c in ("name", *more)])
    # Names first: most pairs end here, before their trigrams are fetched.
    pairs = met.join(side("l", "left"), "left_id").join(side("r", "right"), "right_id")
    allowed = F.floor(num * F.greatest(F.length("left_name"), F.length("right_name")) / den).cast("int")
    pairs = pairs.where((F.abs(F.length("left_name") - F.length("right_name")) <= allowed) & (F.levenshtein("left_name", "right_name") <= allowed))
    grams = [side(s, n, "grams", "weight").drop(f"{n}_id") for s, n in (("l", "left"), ("r", "right"))]
    pairs = materialise(pairs.select("left_name", "right_name"), "close-names").join(grams[0], "left_name").join(grams[1], "right_name")
    return _verified(_sharing(pairs))


def _without_one(name):
    """Hashes of a name and of what is left of it without each of its characters."""
    name = F.col(name)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.length(name)), lambda i: F.xxhash64(F.concat(F.substr(name, F.lit(1), i - 1), F.substr(name, i + 1)))))


def near_pairs(rows):
    """(left, right, edits, apart) as `candidate_pairs` has them: the equal name of a left name, or else all that are one edit from it.

    Names one edit apart are equal when at most one character is taken from each.
    """
    lefts, rights = rows.where("side = 'l'"), rows.where("side = 'r'")
    equal = lefts.select("name").join(rights.select("name"), "name")
    out = equal.select(F.col("name").alias("left"), F.col("name").alias("right"), F.lit(0).alias("edits"), F.lit(0).cast("long").alias("apart"))
    others = lefts.join(rights.select("name"), "name", "left_anti")
    # Hashes stand for names until the pairs are known; what they confuse is told apart below.
    keys = lambda side, n: side.select(F.xxhash64("name").alias(f"{n}_id"), F.explode(_without_one("name")).alias("key"))
    found = materialise(keys(others, "left").join(keys(rights, "right"), "key").select("left_id", "right_id").distinct(), "near-keys")
    named = lambda side, n: side.select(F.xxhash64("name").alias(f"{n}_id"), *[F.col(c).alias(f"{n}_{c}") for c in ("name", "grams", "weight")])
    pairs = found.join(named(others, "left"), "left_id").join(named(rights, "right"), "right_id")
    return out.unionByName(_verified(_sharing(pairs)).where("edits <= 1").select(*out.columns))


def similar_names(left, right, left_name, right_name, right_id, key_pairs=KEY_PAIRS):
    """Each left row with the right row whose name is most like its own.

    The fewest edits win, then the least weight not shared, then the first name. `matched_name` is
    the plain form of the name found, null without one; several right rows may have it: then the id
    is null, and `n_candidates` counts them (0 without a match). Names are compared once however
    many rows have them; null names and names without a letter or digit match nothing.
    """
    lefts = left.withColumn("__name", plain_name(left_name))
    rights = right.select(plain_name(right_name).alias("right"), F.col(right_id)).where("right <> ''")
    only = F.when(F.count(F.lit(1)) == 1, F.min(right_id)).alias(right_id)
    rights = materialise(rights.groupBy("right").agg(only, F.count(F.lit(1)).alias("n_candidates")), "right-names")
    names = lefts.select(F.lit("l").alias("side"), F.col("__name").alias("name")).where("name <> ''").distinct()
    names = materialise(names.unionByName(rights.select(F.lit("r").alias("side"), F.col("right").alias("name"))), "names")
    weighed = materialise(weighted(names), "weighted-names")
    # Edits come first: a name with a pair here needs no others, and the keys of the rest are shared by fewer.
    near = materialise(near_pairs(weighed), "near-names")
    settled = near.select(F.lit("l").alias("side"), F.col("left").alias("name")).distinct()
    others = materialise(weighed.join(settled, ["side", "name"], "left_anti"), "other-names")
    pairs = near.unionByName(candidate_pairs(others, key_pairs))
    best = pairs.groupBy("left").agg(F.min(F.struct("edits", "apart", "right")).alias("b")).select("left", "b.edits", "b.right")
    # Stored, their size decides whether they are broadcast to the left rows.
    found = materialise(best.join(rights, "right"), "similar-names")
    out = lefts.join(found, F.col("__name") == F.col("left"), "left")
    return out.select(*left.columns, F.col("right").alias("matched_name"), right_id, F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"), "edits")
