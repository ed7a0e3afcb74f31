"""Alignment of two tokenizers: where tokens of both end, texts are cut into groups.

The shorter list of token ends drives: from where each of its ends should stand in the longer
list, steps of doubled length bracket it, and binary search within the bracket finds it. Ends that
both lists have cut the tokens into groups, and the differences of their ranks are the ranges of
tokens that overlap. All ends of a chunk of documents gallop at once.

Documents go in chunks. A chunk counts its id pairs once per document and keeps, per document, the
places of its pairs in the chunk's list; corpus-wide counts come back to it by a join on the pairs
and a cogroup on the chunk, so that nothing is broadcast but the vocabularies.
"""

import hashlib
import re
import sys
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.bpe import byte_letters, read_vocabulary
from naviscope.llm.common import arrow_records, chunks, columns, process_cache, stored_large_rows, tidy
from naviscope.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters of a chunk (a longer text makes a chunk of its own).
CHUNK_CHARS = 1_000_000
# Texts that are handed to a worker at a time.
BATCH_TEXTS = 1000
# Words a worker remembers.
REMEMBERED = 300_000
# A group of more links than this is spread by its distinct ids, not by its tokens.
LARGE_GROUP = 1 << 16
# Fixed value: how byte-level vocabularies cut texts before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The model reads this mark as a space.
WORD = re.compile("[ ▁]+[^ ▁]*")
FIELDS = "chunk long, doc_ids array<long>, sizes array<long>, digests array<string>, bounds binary, places binary, times binary, pairs array<long>, documents array<long>"


class ByteLevel:
    """Ids of space + text by a byte-level vocabulary of the tokenizers library; special strings are plain text.

    The ids follow the order of the merges, so that merging by least id is merging by rank.
    """

    def __init__(self, vocabulary):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        bytes_of = {letter: b for b, letter in byte_letters().items()}
        added, vocab = tokenizer.get_added_tokens_decoder(), tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if i in added else bytes(bytes_of[c] for c in token)
        ranks = {b: i for i, b in enumerate(self.bytes) if i not in added}
        self.model = tiktoken.Encoding("ranks", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts):
        """(ids of all texts, where each text's begin, the texts that tokens' bytes don't give back: none here)."""
        each = [self.model.encode_to_numpy(f" {t}", disallowed_special=()) for t in texts]
        begin = np.concatenate(([0], np.cumsum([len(e) for e in each]))).astype(np.int64)
        return np.concatenate([np.empty(0, np.int64), *each]).astype(np.int64), begin, []


class Pieces:
    """Ids of a text by a sentencepiece model that puts a space before it.

    No piece holds a space after another character, so that words, each with the spaces before it,
    are encoded on their own and remembered by a worker; for other models whole texts are.
    """

    def __init__(self, model):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.by_word = not any("▁" in p.lstrip("▁") for p in names)
        self.space = self.model.piece_to_id("▁")
        self.known = {}

    def encode(self, texts):
        words, bounds = [], [0]
        for t in texts:
            words += WORD.findall(f" {t}") if self.by_word else [f" {t}"]
            bounds.append(len(words))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(words).difference(self.known))
        # The model adds the first space itself, except to nothing.
        found = [ids if len(w) > 1 else [self.space] for w, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1))]
        flat = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        edges = [0, *accumulate(4 * len(f) for f in found)]
        self.known.update(zip(new, [flat[i:j] for i, j in zip(edges, edges[1:])]))
        encoded = list(map(self.known.__getitem__, words))
        sizes = np.concatenate(([0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4)))
        ids, begin = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64), sizes[bounds]
        # Ids of other bytes than the text's are rare; those of another length are found at once.
        total = np.concatenate(([0], np.cumsum(self.length[ids])))[begin]
        altered = []
        for k, t in enumerate(texts):
            whole = f" {t}".encode()
            if total[k + 1] - total[k] != len(whole) or b"".join(map(self.bytes.__getitem__, ids[begin[k] : begin[k + 1]].tolist())) != whole:
                altered.append(k)
        return ids, begin, altered


def gallop(sought, sought_from, sorted_ends, sorted_from):
    """(places in `sought`, places in `sorted_ends`) of the values that both hold.

    Both rise strictly over all documents; the `_from` arrays (one entry more than documents) say
    where each document begins. Values start where their rank in the document lets expect them.
    """
    if not len(sought) or not len(sorted_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    count, there = np.diff(sought_from), np.diff(sorted_from)
    rank = np.arange(len(sought)) - np.repeat(sought_from[:-1], count)
    at = np.repeat(sorted_from[:-1], count) + rank * np.repeat(there, count) // np.maximum(np.repeat(count, count), 1)
    last = len(sorted_ends) - 1
    at = np.minimum(at, last)
    # The first place that isn't less lies in (low, high]; -1 and last + 1 stand for the edges.
    less = sorted_ends[at] < sought
    low, high = np.where(less, at, -1), np.where(less, last + 1, at)
    step, todo = 1, np.arange(len(sought))
    while len(todo):
        up = less[todo]
        probe = at[todo] + np.where(up, step, -step)
        inside = (probe >= 0) & (probe <= last)
        todo, probe, up = todo[inside], probe[inside], up[inside]
        below = sorted_ends[probe] < sought[todo]
        low[todo[below]] = np.maximum(low[todo[below]], probe[below])
        high[todo[~below]] = np.minimum(high[todo[~below]], probe[~below])
        todo, step = todo[below == up], step * 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = (low[todo] + high[todo]) >> 1
        below = sorted_ends[middle] < sought[todo]
        low[todo[below]] = middle[below]
        high[todo[~below]] = middle[~below]
        todo = todo[high[todo] - low[todo] > 1]
    found = np.flatnonzero((high <= last) & (sorted_ends[np.minimum(high, last)] == sought))
    return found, high[found]


def spread(starts, sizes):
    """starts[0], starts[0] + 1, ... for each start, `sizes` of them."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def common_ends(ends_a, from_a, ends_b, from_b):
    """(places in a, places in b) of the ends that both have, each document driven by its shorter list."""
    a_drives = np.diff(from_a) <= np.diff(from_b)
    at_a, at_b = [], []
    for drives, swap in ((a_drives, False), (~a_drives, True)):
        (x, fx), (y, fy) = ((ends_b, from_b), (ends_a, from_a)) if swap else ((ends_a, from_a), (ends_b, from_b))
        own_x, own_y = (spread(f[:-1][drives], np.diff(f)[drives]) for f in (fx, fy))
        new_fx, new_fy = (np.concatenate(([0], np.cumsum(np.diff(f)[drives]))) for f in (fx, fy))
        i, j = gallop(x[own_x], new_fx, y[own_y], new_fy)
        i, j = own_x[i], own_y[j]
        at_a.append(j if swap else i)
        at_b.append(i if swap else j)
    at_a, at_b = np.concatenate(at_a), np.concatenate(at_b)
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


def weighted_links(a, b, start_a, start_b, size_a, size_b, document):
    """(document, pair, times) of all links, not yet summed; a pair is a's id and b's id in 64 bits."""
    out = []
    links = size_a * size_b
    usual = np.flatnonzero((links > 0) & (links <= LARGE_GROUP))
    n, nb = links[usual], size_b[usual]
    within = spread(np.zeros(len(usual), np.int64), n)
    wide = np.repeat(nb, n)
    i = np.repeat(start_a[usual], n) + within // np.maximum(wide, 1)
    j = np.repeat(start_b[usual], n) + within % np.maximum(wide, 1)
    out.append((np.repeat(document[usual], n), a[i] << 32 | b[j], np.ones(len(i), np.int64)))
    for g in np.flatnonzero(links > LARGE_GROUP).tolist():
        ids_a, times_a = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
        pairs, times = (ids_a[:, None] << 32 | ids_b[None, :]).ravel(), np.outer(times_a, times_b).ravel()
        out.append((np.full(len(pairs), document[g]), pairs, times))
    return [np.concatenate(x) for x in zip(*out)]


class Aligner:
    def __init__(self, vocabulary, model):
        self.a, self.b = ByteLevel(vocabulary), Pieces(model)
        self.length_a, self.length_b = (np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b))
        # What each token writes, followed by what stands between it and the next one.
        size_a = len(self.a.bytes)
        self.written = [f"{i}{mark}" for mark in ",|" for i in range(size_a)] + [f"{i}{mark}" for mark in ",;" for i in range(len(self.b.bytes))]
        self.size_a, self.size_b = size_a, len(self.b.bytes)

    def tokens(self, texts):
        """(ids, begins) of a and of b for all texts; none where the bytes of either aren't space + text."""
        sides = [side.encode(texts) for side in (self.a, self.b)]
        none = sorted({k for *_, altered in sides for k in altered} | {k for k, t in enumerate(texts) if not t})
        out = []
        for ids, begin, _ in sides:
            count = np.diff(begin)
            if none:
                kept = np.ones(len(texts), bool)
                kept[none] = False
                ids, count = ids[np.repeat(kept, count)], count * kept
            out.append((ids, np.concatenate(([0], np.cumsum(count)))))
        return out

    def align(self, texts):
        """(sizes: n_a, n_b, n_groups, n_links per text; digests; documents, pairs and times of links, summed)."""
        (a, from_a), (b, from_b) = self.tokens(texts)
        at_a, at_b = common_ends(np.cumsum(self.length_a[a]), from_a, np.cumsum(self.length_b[b]), from_b)
        # Documents with tokens end together, so groups follow each other without a gap.
        end_a, end_b = at_a + 1, at_b + 1
        start_a, start_b = (np.concatenate(([0], e[:-1])) if len(e) else e for e in (end_a, end_b))
        size_a, size_b = end_a - start_a, end_b - start_b
        document = np.searchsorted(from_a, at_a, "right") - 1
        sizes = [np.diff(from_a), np.diff(from_b), np.bincount(document, minlength=len(texts))]
        links = np.zeros(len(texts), np.int64)
        np.add.at(links, document, size_a * size_b)
        digests = self.digests(a, b, start_a, start_b, end_a, end_b, from_a + from_b)
        doc, pair, times = weighted_links(a, b, start_a, start_b, size_a, size_b, document)
        order = np.lexsort((pair, doc))
        doc, pair, times = doc[order], pair[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])))) if len(doc) else np.empty(0, np.int64)
        times = np.add.reduceat(times, first) if len(first) else times
        return [*sizes, links], digests, doc[first], pair[first], times

    def digests(self, a, b, start_a, start_b, end_a, end_b, from_both):
        """Per text the digest of its groups written as a1,a2|b1;..., empty for none."""
        place_a = np.arange(len(a)) + np.repeat(start_b, end_a - start_a)
        place_b = np.arange(len(b)) + np.repeat(end_a, end_b - start_b)
        code = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[end_a - 1], last_b[end_b - 1] = 1, 1
        code[place_a] = a + last_a * self.size_a
        code[place_b] = 2 * self.size_a + b + last_b * self.size_b
        written = list(map(self.written.__getitem__, code.tolist()))
        edges = from_both.tolist()
        return [hashlib.sha256("".join(written[i:j])[:-1].encode()).hexdigest() if j > i else "" for i, j in zip(edges, edges[1:])]


def aligned_chunks(documents, vocabulary_path, model_path):
    """Chunks of aligned documents: FIELDS. `places` are those of each document's pairs in `pairs` (`bounds` says
    whose), `times` how often each is linked there; `documents` counts the chunk's documents with a pair."""
    with open(model_path, "rb") as f:
        files = documents.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary_path), f.read()))

    def run(batches):
        aligner = process_cache(f"aligner_{hash(files.value)}", lambda: Aligner(*files.value))
        chunk = TaskContext.get().partitionId() << 32
        for batch in tidy(batches, 10_000):
            for keys, texts in chunks(batch, 0, 1, CHUNK_CHARS):
                sizes, digests, doc, pair, times = aligner.align(texts)
                pairs, place, count = np.unique(pair, return_inverse=True, return_counts=True)
                bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
                chunk += 1
                packed = [x.tobytes() for x in (bounds.astype("<i8"), place.astype("<u4"), times.astype("<i8"))]
                values = (chunk, keys, np.stack(sizes, 1).ravel(), digests, *packed, pairs, count)
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], FIELDS_NAMES)

    return columns(documents, doc_id="long", text="string").mapInArrow(run, FIELDS)


FIELDS_NAMES = [f.split(" ")[0] for f in FIELDS.split(", ")]


def pair_counts(chunked):
    """(pair, n, best): the documents that link an id pair, and whether no pair of its a id has more."""
    each = chunked.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x")).select("x.pairs", "x.documents")
    counts = materialise(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("n")), "pair-counts")
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", F.shiftright("pair", 32)).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(documents, vocabulary_path, model_path):
    """How two tokenizers' tokens of every whole text correspond.

    One row per input row: doc_id (may be null), n_a, n_b (tokens), n_groups, n_links, n_best (links
    whose pair is in as many documents as any pair of its a id), count_sum (over links, the documents
    that hold its pair linked), groups_sha256. Null and empty texts, and texts that either tokenizer
    doesn't give back, have zeros and an empty groups_sha256; repeated rows count each time; an
    empty table gives no row; other columns are ignored; a very long text is a chunk of its own.
    """
    with arrow_records(documents.sparkSession, BATCH_TEXTS):
        chunked = stored_large_rows(aligned_chunks(documents, vocabulary_path, model_path), "aligned")
    counts = materialise(pair_counts(chunked), "pairs")
    held = chunked.select("chunk", F.explode("pairs").alias("pair"))
    found = held.join(counts, "pair").select(F.col("chunk").alias("of"), "pair", "n", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(left, right):
        order = np.argsort(right.column("pair").to_numpy())
        n, best = (right.column(c).to_numpy().astype(np.int64)[order] for c in ("n", "best"))
        out = []
        for row in left.to_pylist():
            bounds, place, times = (np.frombuffer(row[k], t) for k, t in (("bounds", "<i8"), ("places", "<u4"), ("times", "<i8")))
            totals = [np.diff(np.concatenate(([0], np.cumsum(times * x[place])))[bounds]) for x in (best, n)]
            sizes = np.array(row["sizes"], np.int64).reshape(-1, 4)
            values = [row["doc_ids"], *sizes.T, *totals, row["digests"]]
            kinds = [pa.int64()] * 7 + [pa.string()]
            out.append(pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names))
        return pa.Table.from_batches(out)

    rows = chunked.drop("pairs", "documents").groupBy("chunk").cogroup(found.groupBy("of"))
    return rows.applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
