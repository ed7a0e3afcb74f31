"""Phrase collocations, counted in quotient filters.

Texts become rows of places in a dictionary, of which a task makes one per language for as much text as
it can hold, so that few words go over the network more than once. One shuffle of the dictionaries
counts the words; those of at least LEAST occurrences in their language get ids, and the rows become
rows of such ids, 0 where a piece ends or a rarer word stands. Level k = 2, 3, ... counts phrases of k
words: both its phrases of k - 1 words have ids of their own, and the two ids, packed into no more bits
than the level's ids take, are its key. A phrase that is frequent has only frequent parts, so that
nothing countable is lost.

Each row's keys are permuted invertibly and counted in a quotient filter: the upper bits of a key
say where it stands, only the rest is stored, and both together give the key back. Filters are
cut into slices by their upper bits; the sorted filters of a slice are merged in one group. The
permutation spreads keys evenly, and a row holds a phrase once, so no phrase makes a slice large.
"""

import math
import re
import sys
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from naviscope.llm.common import arrow_records, columns, stored_large_rows, tidy
from naviscope.operators.scan import add_row_number
from naviscope.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 100
LONGEST = 5
TOP = 2000
# A row of words is closed once it holds so many (documents stay whole).
ROW_WORDS = 1 << 18
# Bytes, about, of the texts and dictionaries that a task holds before it hands the largest on.
HELD_BYTES, WORD_BYTES = 1 << 26, 120
# Words of a dictionary that are handed on in a row.
DICTIONARY_ROW = 1 << 15
# Texts, and rows of words, that are handed to a worker at a time.
BATCH_TEXTS, BATCH_ROWS = 1000, 2
# Entries that a task counts before it hands on filters.
TASK_ENTRIES = 1 << 21
# Entries of a slice before merging, about.
SLICE_ENTRIES = 1 << 20
# Parts of the words for each slice (as a power of 2), so that tasks get evenly many.
WORD_PARTS = 4
# Keys of one level (8 bytes each) up to which they are broadcast; beyond, they are joined.
BROADCAST_KEYS = 4_000_000
# Parts into which a language is dealt before its last sort.
DEALT = 64
# Odd factors of a 64-bit mix and their inverses.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
UNMIX = tuple(pow(m, -1, 1 << 64) for m in MIX)
PIECE_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
U64 = np.uint64


def permuted(keys, bits=64):
    """An invertible permutation of keys of so many bits."""
    x, half, below = np.asarray(keys, U64), U64((bits + 1) // 2), U64((1 << bits) - 1)
    x = (x ^ (x >> half)) * U64(MIX[0]) & below
    x = (x ^ (x >> half)) * U64(MIX[1]) & below
    return x ^ (x >> half)


def restored(keys, bits=64):
    x, half, below = np.asarray(keys, U64), U64((bits + 1) // 2), U64((1 << bits) - 1)
    x = (x ^ (x >> half)) * U64(UNMIX[1]) & below
    x = (x ^ (x >> half)) * U64(UNMIX[0]) & below
    return x ^ (x >> half)


class QuotientFilter:
    """Exact counters of sorted distinct keys of `bits` bits that share their upper `shared` bits.

    A key below these bits is a quotient of `q` bits and a remainder. One bitmap says which
    quotients occur, one where the run of a quotient ends, one which counts are not 1; remainders
    take the bits they have, counts but 1 one byte, with larger ones aside.
    """

    def __init__(self, bits, shared, q, size, occupied, run_ends, remainders, repeated, counts, large):
        self.bits, self.shared, self.q, self.size = bits, shared, q, size
        self.occupied, self.run_ends, self.remainders, self.repeated, self.counts, self.large = occupied, run_ends, remainders, repeated, counts, large

    @classmethod
    def of(cls, keys, counts, shared=0, bits=64):
        n = len(keys)
        q = min(max(n - 1, 0).bit_length(), bits - 1 - shared)
        rest = bits - shared - q
        below = keys & U64((1 << (bits - shared)) - 1)
        quotient = (below >> U64(rest)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        run_ends = np.ones(n, bool)
        run_ends[:-1] = quotient[1:] != quotient[:-1]
        remainder = below.astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-rest // 8)]
        remainder = np.unpackbits(remainder, axis=1, bitorder="little")[:, :rest].reshape(-1)
        repeated = counts != 1
        packed = [np.packbits(b, bitorder="little") for b in (occupied, run_ends, remainder, repeated)]
        return cls(bits, shared, q, n, *packed, np.minimum(counts[repeated], 255).astype(np.uint8), counts[counts >= 255].astype("<u8"))

    def entries(self):
        """(keys without the shared bits, counts), in order."""
        n, rest = self.size, self.bits - self.shared - self.q
        width = -(-rest // 8)
        places = np.flatnonzero(np.unpackbits(self.occupied, count=1 << self.q, bitorder="little"))
        ends = np.unpackbits(self.run_ends, count=n, bitorder="little")
        run = np.cumsum(ends, dtype=np.int64) - ends
        remainder = np.zeros((n, 8 * width), np.uint8)
        remainder[:, :rest] = np.unpackbits(self.remainders, count=n * rest, bitorder="little").reshape(n, rest)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = np.packbits(remainder, axis=1, bitorder="little")
        keys = whole.view("<u8").reshape(-1).astype(U64) | places[run].astype(U64) << U64(rest)
        counts = np.ones(n, np.int64)
        counts[np.unpackbits(self.repeated, count=n, bitorder="little").astype(bool)] = self.counts
        counts[counts == 255] = self.large
        return keys, counts

    def to_bytes(self):
        head = np.array([self.bits, self.shared, self.q, self.size], "<u4")
        return b"".join(x.tobytes() for x in (head, self.occupied, self.run_ends, self.remainders, self.repeated, self.counts, self.large))

    @classmethod
    def from_bytes(cls, data):
        bits, shared, q, n = np.frombuffer(data, "<u4", 4).tolist()
        at, parts = 16, []
        for size in (1 << q, n, n * (bits - shared - q), n):
            parts.append(np.frombuffer(data, np.uint8, -(-size // 8), at))
            at += len(parts[-1])
        parts.append(np.frombuffer(data, np.uint8, int(np.unpackbits(parts[-1], count=n, bitorder="little").sum()) if n else 0, at))
        return cls(bits, shared, q, n, *parts, np.frombuffer(data, "<u8", -1, at + len(parts[-1])))


def summed(keys, counts):
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def words_of(text):
    """The lower-cased words of a text, `\\n` between pieces."""
    return text.encode().lower().translate(PIECE_ENDS).replace(b"\n", b" \n ").split(b" ")


def packed(codes):
    """Numbers from 0, most of them small, in a byte each; larger ones aside in two, or again in four."""
    two = codes[codes >= 255] - 255
    parts = [np.minimum(codes, 255).astype(np.uint8), np.minimum(two, 65535).astype("<u2"), (two[two >= 65535] - 65535).astype("<u4")]
    return b"".join(x.tobytes() for x in (np.array([len(codes), len(two)], "<u4"), *parts))


def unpacked(data):
    n, n_two = np.frombuffer(data, "<u4", 2).tolist()
    codes = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    two = np.frombuffer(data, "<u2", n_two, 8 + n).astype(np.int64)
    two[two == 65535] += np.frombuffer(data, "<u4", -1, 8 + n + 2 * n_two)
    codes[codes == 255] += two
    return codes


class Dictionary:
    """The words of one language that a task has read, and its texts as places in them, 0 for the end of a piece."""

    def __init__(self):
        self.place = defaultdict()
        self.place.default_factory = self.place.__len__
        self.codes, self.cuts, self.chars = array("i", [self.place[b"\n"]]), [0], 0

    def add(self, text):
        self.codes.extend(map(self.place.__getitem__, filter(None, words_of(text))))
        self.codes.append(0)
        self.chars += len(text)
        if len(self.codes) - self.cuts[-1] >= ROW_WORDS:
            self.cuts.append(len(self.codes))

    def size(self):
        return self.chars + WORD_BYTES * len(self.place)

    def rows(self):
        """(words, counts, sequences): words from the most frequent on, which are 1, 2, ... in the packed sequences."""
        self.place.default_factory = None
        codes = np.frombuffer(self.codes, "i4")
        counts = np.bincount(codes, minlength=len(self.place))[1:]
        order = np.argsort(-counts, kind="stable")
        rank = np.zeros(len(order) + 1, np.int64)
        rank[order + 1] = np.arange(1, len(order) + 1)
        words = list(self.place)
        edges = [*self.cuts, len(codes)]
        return [words[i + 1] for i in order.tolist()], counts[order], [packed(rank[codes[i:j]]) for i, j in zip(edges, edges[1:]) if i < j]


def word_rows(batches):
    """Rows of a dictionary's words (lang, words, their counts; the first word's place) and of its sequences, each with the dictionary's number."""
    names = ["row", "dict", "lang", "first", "words", "counts", "sequence"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())
    base, made = TaskContext.get().partitionId() << 32, 0
    held, size = {}, 0

    def row(*values):
        nonlocal made
        made += 1
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((base + made, *values), kinds)], names)

    def rows(lang):
        number = base + made + 1
        words, counts, sequences = held.pop(lang).rows()
        for i in range(0, len(words), DICTIONARY_ROW):
            some = slice(i, i + DICTIONARY_ROW)
            yield row(number, lang, i + 1, [w.decode() for w in words[some]], counts[some], None)
        for sequence in sequences:
            yield row(number, None, None, None, None, sequence)

    for batch in tidy(batches):
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_py()
            if text:
                mine = held.setdefault(lang, Dictionary())
                size -= mine.size()
                mine.add(text)
                size += mine.size()
                while size >= HELD_BYTES:
                    largest = max(held, key=lambda k: held[k].size())
                    size -= held[largest].size()
                    yield from rows(largest)
    for lang in list(held):
        yield from rows(lang)


def known_words(rows, slice_bits, least):
    """(found, id_bits): each dictionary's words of `least` occurrences and more: dict, place, id, lang, word, f.

    All rows of a word meet in the part that its hash says, which is the upper bits of its id; the lower
    ones, as many as the largest part asks for, number the words of the part.
    """
    part_bits = slice_bits + WORD_PARTS
    each = rows.select("dict", "lang", "first", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x"))
    each = each.select("dict", "lang", (F.col("first") + F.col("at")).alias("place"), F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    spread = each.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(1 << part_bits))).repartition("part")
    counted = spread.withColumn("f", F.sum("n").over(Window.partitionBy("part", "lang", "word"))).where(F.col("f") >= least).drop("n")
    found = materialise(counted.withColumn("nth", F.dense_rank().over(Window.partitionBy("part").orderBy("lang", "word"))), "found-words")
    nth_bits = (found.agg(F.max("nth")).first()[0] or 0).bit_length()
    if part_bits + nth_bits > 32:
        raise ValueError("too many frequent words for ids of 32 bits")
    return found.withColumn("id", F.shiftleft(F.col("part").cast("long"), nth_bits) + F.col("nth")).drop("part", "nth"), part_bits + nth_bits


def numbered(frequent, order):
    """`frequent` (stored) with ids from 1; `order` orders its rows. Ids take 32 bits."""
    spread = frequent.withColumn("_chunk", F.col("part"))
    out = add_row_number(spread.withColumn("_all", F.lit(0)), ["_all"], "_chunk", order, "id").drop("_all", "_chunk", "part")
    return out.withColumn("id", F.when(F.col("id") < 1 << 32, F.col("id")).otherwise(F.raise_error(F.lit("more than 2^32 ids")).cast("long")))


def trimmed(ids):
    """The ids without those that stand alone, which no pair holds, and one 0 between the others."""
    paired = np.zeros(len(ids) + 1, bool)
    both = (ids[:-1] > 0) & (ids[1:] > 0)
    paired[:-2] |= both
    paired[1:-1] |= both
    kept = paired[:-1].copy()
    kept[1:] |= paired[:-2]
    return np.where(paired[:-1], ids, 0)[kept].astype("<u4")


def id_rows(rows, found):
    """(row, ids): the id of each word of a row, 0 for ends and words without one."""

    def run(left, right):
        out = []
        place, ids = right.column("place").to_numpy(), right.column("id").to_numpy()
        size = int(place.max(initial=0)) + 1
        for number, sequence in zip(left.column("row"), left.column("sequence")):
            at = unpacked(sequence.as_py())
            table = np.zeros(max(size, int(at.max(initial=0)) + 1), "<u4")
            table[place] = ids
            out.append((number.as_py(), trimmed(table[at]).tobytes()))
        return pa.table({"row": pa.array([o[0] for o in out], pa.int64()), "ids": pa.array([o[1] for o in out], pa.binary())})

    sequences = rows.where("sequence is not null").select("dict", "row", "sequence")
    known = found.select(F.col("dict").alias("of"), "place", "id")
    return sequences.groupBy("dict").cogroup(known.groupBy("of")).applyInArrow(run, "row long, ids binary")


def pair_keys(ids, id_bits=32):
    """(places, keys): where two neighbouring ids both exist, packed into twice `id_bits` bits."""
    ids = np.frombuffer(ids, "<u4").astype(U64)
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, ids[at] << U64(id_bits) | ids[at + 1]


def key_bits(slice_bits, id_bits):
    """The bits of a permuted key: those of a pair, and one more at least than say its slice."""
    return max(2 * id_bits, slice_bits + 1)


def count_pairs(rows, slice_bits, id_bits):
    """(slice, filter): the quotient filters of a task's pairs, cut by the upper bits of the permuted keys."""
    bits = key_bits(slice_bits, id_bits)

    def filters(keys, counts):
        slices = (keys >> U64(bits - slice_bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(slices)) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        parts = [(int(slices[i]), QuotientFilter.of(keys[i:j], counts[i:j], slice_bits, bits).to_bytes()) for i, j in zip(edges, edges[1:])]
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], ["slice", "filter"])

    def run(batches):
        held, size = [], 0
        for batch in tidy(batches, 1):
            for ids in batch.column(0):
                keys = np.sort(permuted(pair_keys(ids.as_py(), id_bits)[1], bits))
                held.append(summed(keys, np.ones(len(keys), np.int64)))
                size += len(held[-1][0])
                if size >= TASK_ENTRIES:
                    held = [_together(held)]
                    if len(held[0][0]) >= TASK_ENTRIES // 2:
                        yield filters(*held.pop())
                    size = sum(len(k) for k, _ in held)
        if size:
            yield filters(*_together(held))

    return rows.select("ids").mapInArrow(run, "slice int, filter binary")


def _together(parts):
    return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def merged(filters, slice_bits, id_bits, least):
    """(part, left, right, f): the keys whose merged count is `least` or more, taken apart."""
    bits = key_bits(slice_bits, id_bits)

    def run(table):
        number = table.column("slice")[0].as_py()
        keys, counts = np.empty(0, U64), np.empty(0, np.int64)
        waiting, size = [], 0
        for data in [*table.column("filter"), None]:
            if data is not None:
                waiting.append(QuotientFilter.from_bytes(data.as_py()).entries())
                size += len(waiting[-1][0])
            if data is None or size >= SLICE_ENTRIES:
                keys, counts = _together([(keys, counts), *waiting])
                waiting, size = [], 0
        kept = counts >= least
        pair = restored(keys[kept] | U64(number << (bits - slice_bits)), bits)
        return pa.table({"part": pa.array(np.full(len(pair), number), pa.int32()), "left": pa.array((pair >> U64(id_bits)).astype(np.int64)), "right": pa.array((pair & U64((1 << id_bits) - 1)).astype(np.int64)), "f": pa.array(counts[kept])})

    return filters.groupBy("slice").applyInArrow(run, "part int, left long, right long, f long")


def next_rows(rows, level):
    """(row, ids) one level up: at each place the id of the pair that starts there, 0 if it has none, trimmed."""
    spark = rows.sparkSession
    pairs = level.select("left", "right", "id")
    if pairs.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        table = pairs.toArrow()
        keys = table.column("left").to_numpy().astype(U64) << U64(32) | table.column("right").to_numpy().astype(U64)
        order = np.argsort(keys)
        known = spark.sparkContext.broadcast((keys[order], table.column("id").to_numpy().astype("<u4")[order]))

        def run(batches):
            sorted_keys, sorted_ids = known.value
            for batch in tidy(batches, 1):
                for number, ids in zip(batch.column(0), batch.column(1)):
                    yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), pa.array([_looked_up(ids.as_py(), sorted_keys, sorted_ids)], pa.binary())], ["row", "ids"])

        return rows.select("row", "ids").mapInArrow(run, "row long, ids binary")

    def distinct(batches):
        for batch in tidy(batches, 1):
            for number, ids in zip(batch.column(0), batch.column(1)):
                keys = np.unique(pair_keys(ids.as_py())[1])
                left, right = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number.as_py())), pa.array(left), pa.array(right)], ["row", "left", "right"])

    held = rows.select("row", "ids").mapInArrow(distinct, "row long, left long, right long")
    found = held.join(pairs, ["left", "right"]).select(F.col("row").alias("of"), "left", "right", "id")

    def applied(left, right):
        keys = right.column("left").to_numpy().astype(U64) << U64(32) | right.column("right").to_numpy().astype(U64)
        order = np.argsort(keys)
        ids = [_looked_up(x.as_py(), keys[order], right.column("id").to_numpy().astype("<u4")[order]) for x in left.column("ids")]
        return pa.table({"row": left.column("row"), "ids": pa.array(ids, pa.binary())})

    return rows.select("row", "ids").groupBy("row").cogroup(found.groupBy("of")).applyInArrow(applied, "row long, ids binary")


def _looked_up(ids, sorted_keys, sorted_ids):
    at, keys = pair_keys(ids)
    out = np.zeros(len(ids) // 4, "<u4")
    if len(sorted_keys):
        near = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        out[at] = np.where(sorted_keys[near] == keys, sorted_ids[near], 0)
    return trimmed(out).tobytes()


def described(level, parts):
    """A level with the words of each phrase and the counts of its first and last 1, 2, ... words."""
    side = lambda name: parts.select(F.col("id").alias(name), F.col("words").alias(f"{name}_words"), F.col("lang").alias(f"{name}_lang"), F.col("heads").alias(f"{name}_heads"), F.col("tails").alias(f"{name}_tails"))
    joined = level.join(side("left").drop("left_tails"), "left").join(side("right").drop("right_lang", "right_heads"), "right")
    return joined.select(
        "id", "left", "right", "f", F.col("left_lang").alias("lang"),
        F.concat("left_words", F.array(F.element_at("right_words", -1))).alias("words"),
        F.concat("left_heads", F.array("f")).alias("heads"),
        F.concat("right_tails", F.array("f")).alias("tails"),
    )


def phrases(documents, least=LEAST, longest=LONGEST):
    """(candidates, totals): every phrase of 2 to `longest` words and at least `least` occurrences, not
    yet rid of those inside others: lang, words, f, heads, tails (counts of its first and last words), kept
    (no longer candidate of the same count holds it); and the words of each lang: lang, n.
    """
    rows = columns(documents, lang="string", text="string").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    spark = documents.sparkSession
    with arrow_records(spark, BATCH_TEXTS):
        rows = stored_large_rows(rows.mapInArrow(word_rows, "row long, dict long, lang string, first long, words array<string>, counts array<long>, sequence binary"), "word-rows")
    totals = rows.where("counts is not null").groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (a, x) -> a + x)")).alias("n"))
    totals = materialise(totals, "totals")
    everything = totals.agg(F.sum("n")).first()[0] or 0
    slice_bits = min(28, math.ceil(math.log2(max(8, everything / SLICE_ENTRIES))))
    found, id_bits = known_words(rows, slice_bits, least)
    words = materialise(found.select("id", "lang", "word", "f").distinct(), "words")
    below = words.select("id", "lang", F.array("word").alias("words"), F.array("f").alias("heads"), F.array("f").alias("tails"))
    rows = stored_large_rows(id_rows(rows, found), "id-rows")
    levels = []
    for k in range(2, longest + 1):
        with arrow_records(spark, BATCH_ROWS):
            found = materialise(merged(count_pairs(rows, slice_bits, id_bits), slice_bits, id_bits, least), f"pairs-{k}")
        level = materialise(numbered(found, ["left", "right"]), f"pair-ids-{k}")
        id_bits = max(1, level.count().bit_length())
        below = materialise(described(level, below), f"phrases-{k}")
        levels.append(below)
        if k < longest:
            with arrow_records(spark, BATCH_ROWS):
                rows = stored_large_rows(next_rows(rows, level), f"id-rows-{k}")
    out = []
    for level, above in zip(levels, [*levels[1:], None]):
        if above is None:
            marked = level.withColumn("kept", F.lit(True))
        else:
            # A longer phrase of the same count gives every phrase between the same count, so that one word more is enough.
            inside = above.select(F.explode(F.array("left", "right")).alias("id"), F.col("f")).distinct().withColumn("inside", F.lit(True))
            marked = level.join(inside, ["id", "f"], "left").withColumn("kept", F.col("inside").isNull())
        out.append(marked.select("lang", "words", "f", "heads", "tails", "kept"))
    candidates = out[0]
    for more in out[1:]:
        candidates = candidates.unionByName(more)
    return candidates, totals


def scored(candidates, totals):
    """The kept candidates with a, l, r, n and score, by their lowest-scoring cut (of equal ones, the first)."""
    wide = "decimal(38,0)"
    kept = candidates.where("kept").join(totals, "lang")
    # At most 1000 a n and l r: 38 digits are enough up to 10^17 words.
    cut = lambda k: F.struct(
        F.expr(f"cast(cast(1000 as {wide}) * cast(f as {wide}) * cast(n as {wide}) div (cast(heads[{k} - 1] as {wide}) * cast(tails[size(words) - {k} - 1] as {wide})) as long)").alias("score"),
        F.lit(k).alias("k"),
        F.expr(f"heads[{k} - 1]").alias("l"),
        F.expr(f"tails[size(words) - {k} - 1]").alias("r"),
    )
    cuts = F.array(*[F.when(F.size("words") > k, cut(k)) for k in range(1, LONGEST)])
    best = kept.withColumn("best", F.array_min(F.filter(cuts, lambda c: c.isNotNull())))
    return best.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "n", "best.score")


def collocations(documents, least=LEAST, top=TOP):
    """Each lang's first `top` phrases by score, then a (both descending), then phrase in byte order.

    Columns lang, rank (from 1), phrase, a, l, r, n, score. Texts are lower-cased (A-Z), pieces end at
    `.,;:!?` and line ends, words at blanks and tabs. A null lang counts as `und`, null and empty texts
    hold nothing, repeated rows count each time, an empty table gives no row, other columns are
    ignored; a very long text is a row of its own. A level may have up to 2^32 frequent phrases.
    """
    candidates, totals = phrases(documents, least)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = materialise(scored(candidates, totals), "collocations")
    # First within parts of a language, so that the last sort sees at most DEALT x top rows of it.
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALT)))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
