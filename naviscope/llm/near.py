"""N-gram Jaccard join of whole texts with a MinHash LSH forest.

Texts with the same set of five-word shingles are one node. A node's signature is cut into
TREES paths of DEPTH symbols, one path for each sorted prefix trie of the forest. Nodes that
share a prefix are candidates; prefixes start at full depth and are shortened symbol by symbol
until the chance to meet a partner at the threshold reaches the target recall.

Candidates are not listed as pairs: each bucket links its nodes to its least node, and the
components of these links are verified whole. A large component is cut into blocks and each
pair of blocks is one task's group, so no component meets in one task; within a group all exact
Jaccard similarities come from one product of 0/1 matrices, and only counts of links and one
link per node leave the task.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.common import checked_join, chunks, process_cache, tidy
from naviscope.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
THRESHOLD = (4, 5)
TREES, DEPTH = 16, 8
RECALL = 0.99
BLOCK_NODES = 512
SEED = 20240229
SIGNED = "doc_id long, fingerprint long, node binary, n_shingles int, signature binary"
U = np.uint64


def mix(x):
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n):
    """B ** i and B ** -i modulo 2 ** 64 for i < n, for one odd B."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, U), np.full(n, pow(base, -1, 1 << 64), U)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def shingles(texts):
    """(hashes, ends): the distinct shingles of text k, sorted, are hashes[ends[k-1]:ends[k]].

    Words are runs without blanks (space, tab, line ends). A text of one to four words has
    one shingle, all its words; a text without words has none.
    """
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    text_ends = np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1) - 1
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    first, last = edge[::2], edge[1::2]
    up, down = process_cache("powers", lambda: powers(1 << 20)) if len(data) < 1 << 20 else powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
    word = mix((total[last] - total[first]) * down[first] + (last - first).astype(U))
    owner = np.searchsorted(text_ends, first)
    count = np.bincount(owner, minlength=len(texts))
    turn = [U((2 * k + 1) * 0xD1342543DE82EF95 % 2**64) for k in range(SHINGLE)]
    hashes, owners = np.zeros(0, U), np.zeros(0, np.int64)
    if len(word) >= SHINGLE:
        n = len(word) - SHINGLE + 1
        hashes = sum((word[k : k + n] * turn[k] for k in range(1, SHINGLE)), word[:n] * turn[0])
        inside = owner[:n] == owner[SHINGLE - 1 :]
        hashes, owners = mix(hashes[inside]), owner[:n][inside]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        begin = np.cumsum(count) - count
        extra = [mix(sum((word[begin[t] + k : begin[t] + k + 1] * turn[k] for k in range(1, count[t])), word[begin[t] : begin[t] + 1] * turn[0] + U(count[t])))[0] for t in short]
        hashes, owners = np.concatenate((hashes, np.array(extra, U))), np.concatenate((owners, short))
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return hashes, np.searchsorted(owners, np.arange(len(texts)), "right")


def signatures(hashes, first):
    """TREES * DEPTH minima of 16 bits for each run of hashes that begins at `first`."""
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * U(2) + U(1)
    shifts = rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
    out, work = np.empty((len(first), TREES * DEPTH), ">u2"), np.empty_like(hashes)
    for k in range(TREES * DEPTH):
        np.multiply(hashes, factors[k], out=work)
        np.add(work, shifts[k], out=work)
        least = np.minimum.reduceat(work, first)
        out[:, k] = mix(least) >> U(48)
    return out


def sign(batches):
    names = [f.split()[0] for f in SIGNED.split(", ")]
    for batch in tidy(batches):
        done = 0
        for keys, texts in chunks(batch, 0, 1, 500_000):
            hashes, ends = shingles(texts)
            first = np.concatenate(([0], ends[:-1]))
            full = np.flatnonzero(ends > first)
            nodes, signed = [None] * len(texts), [None] * len(texts)
            if len(full):
                halves = [np.add.reduceat(mix(hashes ^ U(k)), first[full]) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                ids = np.stack(halves, 1).astype(">u8").tobytes()
                rows = signatures(hashes, first[full]).tobytes()
                size = 2 * TREES * DEPTH
                for i, t in enumerate(full.tolist()):
                    nodes[t], signed[t] = ids[16 * i : 16 * i + 16], rows[size * i : size * i + size]
            prints = batch.column(2).slice(done, len(keys))
            done += len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), prints, pa.array(nodes, pa.binary()), pa.array(ends - first, pa.int32()), pa.array(signed, pa.binary())], names)


def prefix_depth(recall=RECALL, trees=TREES, depth=DEPTH, similarity=THRESHOLD[0] / THRESHOLD[1]):
    """Symbols of a path to match: from all of them, shortened until partners at the threshold meet in some tree often enough."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def is_star_forest(links):
    """Does every node link to one root at most, and no root to another?"""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("up")).unionByName(links.select(F.col("b").alias("x"), F.lit(0).alias("up")))
    counted = ends.groupBy("x").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return counted.where("up > 0 AND n > 1").isEmpty()


def components(links):
    """(node, root) of every linked node that is not the least of its component, its root.

    `links` has columns a, b. Alternating large-star and small-star rounds, each written, until
    only stars are left. The least neighbours are written too: a join of two stored tables is
    one that AQE can broadcast, or split where a root holds a large share of the links.
    """
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not is_star_forest(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "links")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        links = materialise(small.where("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def similar(sets):
    """Boolean matrix of the pairs of distinct sets at or above the threshold, exactly."""
    sizes = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(column, minlength=len(values)) > 1
    renamed = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], renamed[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (start, start + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[lo:hi], column[lo:hi] - start] = 1
        both += part @ part.T
    up, low = THRESHOLD
    linked = (up + low) * both >= up * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    return linked


VERIFIED = "node binary, n_links long, root binary"


def verify(batches):
    """mapInArrow over rows sorted by (label, i, j): links of each node within its group."""
    names = ["node", "n_links", "root"]
    group, key = [], None

    def closed():
        seen, rows = set(), []
        for block, node, copies, held in group:
            if node not in seen:
                seen.add(node)
                rows.append((block, node, copies, held))
        _, i, j = key
        rows.sort(key=lambda r: r[1])
        block = np.array([r[0] for r in rows])
        linked = similar([r[3] for r in rows])
        if i != j:
            linked &= block[:, None] != block[None, :]
        copies = np.array([r[2] for r in rows], np.int64)
        root = np.arange(len(rows))
        while True:
            new = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(1))
            new = new[new]
            if (new == root).all():
                break
            root = new
        nodes = [r[1] for r in rows]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(linked @ copies, pa.int64()), pa.array([nodes[k] for k in root], pa.binary())], names)

    for batch in tidy(batches):
        rest = list(zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j", "block", "node", "n_copies"))))
        done = 0
        for _, texts in chunks(batch, 0, batch.schema.get_field_index("text"), 500_000):
            hashes, ends = shingles(texts)
            for k, part in enumerate(np.split(hashes, ends[:-1])):
                label, i, j, *row = rest[done + k]
                if group and key != (label, i, j):
                    yield closed()
                    group.clear()
                key = (label, i, j)
                group.append((*row, part.copy()))
            done += len(texts)
    if group:
        yield closed()


def join(documents):
    """Near-duplicate class and number of links of every document, stored.

    One row per input row: doc_id, fingerprint (xxhash64 of the text), class_id (least doc_id
    of the class: documents joined by chains of Jaccard similarities of 0.8 or more), n_links
    (other documents at 0.8 or more, copies among them), copy_id (least doc_id with the same
    shingles) and first (is it the row that stands for its class). Null or empty texts, and
    texts of blanks, are similar to nothing: each is its own class. Null doc_ids count as
    least; repeated rows are copies; empty tables give no row; other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("fingerprint", F.xxhash64("text"))
    signed = materialise(documents.select("doc_id", "text", "fingerprint").mapInArrow(sign, SIGNED), "signatures")
    row = F.struct("doc_id", "fingerprint")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("signature").alias("signature"))
    nodes = materialise(nodes, "nodes")

    depth = prefix_depth()
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.substring(F.col("signature"), t * 2 * DEPTH + 1, F.lit(2 * depth))))
    forest = nodes.select("node", F.explode(trees).alias("bucket"))
    buckets = forest.groupBy("bucket").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    candidates = components(forest.join(buckets, "bucket").select(F.col("node").alias("a"), F.col("least").alias("b")))

    candidates = candidates.unionByName(candidates.select(F.col("root").alias("node"), "root").distinct())
    sizes = candidates.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("blocks"))
    members = candidates.join(sizes, "root").join(nodes.drop("signature"), "node")
    members = materialise(members.select("node", F.col("root").alias("label"), "blocks", "n_copies", F.col("least.doc_id").alias("id"), F.col("least.fingerprint").alias("print")), "members")
    on = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("fingerprint").eqNullSafe(F.col("print"))
    texts = checked_join(documents, members, on, "inner")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = texts.select("label", "node", "n_copies", "text", block.alias("block"), other.alias("other"))
    pairs = pairs.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n_copies", "text")
    dealt = pairs.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    verified = materialise(dealt.mapInArrow(verify, VERIFIED), "verified")

    links = verified.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    roots = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classed = nodes.drop("signature").join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min("least").alias("class_least"))
    classed = classed.join(least, "root").select("node", "class_least", "least", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    found = signed.select("doc_id", "fingerprint", "node").join(classed, "node", "left")
    alone = F.col("class_least").isNull()
    return materialise(
        found.select(
            "doc_id",
            "fingerprint",
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_least.doc_id")).alias("class_id"),
            F.when(alone, 0).otherwise(F.col("n_links") + F.col("n_copies") - 1).cast("long").alias("n_links"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("copy_id"),
            (alone | (row == F.col("class_least"))).alias("first"),
        ),
        "near",
    )


def without_duplicates(documents):
    """`documents` with one row of each class, the one of the least doc_id (and fingerprint)."""
    found = join(documents)
    key = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("_print").eqNullSafe(F.col("_fingerprint"))]
    keys = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("fingerprint").alias("_fingerprint")).distinct()
    marked = documents.withColumn("_print", F.xxhash64(F.col("text").cast("string")))
    kept = checked_join(marked, materialise(keys(found.where(~F.col("first"))), "removed"), key[0] & key[1], "left_anti")
    again = found.where("first").groupBy("doc_id", "fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialise(keys(again), "repeated")
    if again.isEmpty():
        return kept.drop("_print")
    once = checked_join(kept, again, key[0] & key[1], "left_anti")
    repeated = checked_join(kept, again, key[0] & key[1], "left_semi").dropDuplicates(["doc_id", "_print"])
    return once.unionByName(repeated).drop("_print")
