"""Benchmark decontamination by the q-gram lemma.

Texts are folded: letters and digits in lower case, anything else one blank. A document is
contaminated by a benchmark passage if any REGION characters of the passage in a row (all of a
shorter passage) occur in it with at most one edit per EDIT_SHARE characters. Such an occurrence
keeps at least `need` = n - Q + 1 - Q * edits of the region's q-grams, on diagonals (place in
the text minus place in the passage) at most `edits` apart: hits with the whole passage are
counted in overlapping bands of diagonals, and regions that hold `need` of a band's hits are
verified by banded alignment, wherever in the passage they begin. Nothing within the edit budget
is lost.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.common import chunks, columns, process_cache, tidy, without
from naviscope.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Q = 12
REGION = 80
EDIT_SHARE = 20
# The passages are searched for in blocks of so many characters, one pass over the documents each.
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
# Hits that are looked at at a time, about.
HITS = 1_000_000
BLANK, END = 32, 1


def fold_table():
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def fold(texts, table):
    """(codes of all texts, each closed by END; where each END is; place in the joined text of each code)."""
    big = "\0".join(texts) + "\0"
    code = table[np.frombuffer(big.encode("utf-32-le"), np.uint32)]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    code[ends] = END
    keep = code != 0
    keep[1:] |= code[:-1] > END
    place = np.flatnonzero(keep)
    code = code[place]
    code[code == 0] = BLANK
    return code, np.searchsorted(place, ends), place


def gram_hashes(code):
    """A 64-bit hash of every Q (12) consecutive codes."""
    if len(code) < Q:
        return np.zeros(0, np.uint64)
    h = code.astype(np.uint64)
    h *= np.uint64(0x9E3779B97F4A7C15)
    two = h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:]
    four = two[:-2] * np.uint64(0xA0761D6478BD642F) + two[2:]
    eight = four[:-4] * np.uint64(0xE7037ED1A0B428DB) + four[4:]
    h = eight[:-4] * np.uint64(0x8EBC6AF09C88C6E3) + four[8:]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def budget(n):
    """(edits allowed in a region of n characters, shared q-grams that they leave)."""
    edits = max(0, min(n // EDIT_SHARE, (n - Q) // Q))
    return edits, n - Q + 1 - Q * edits


class Passages:
    """Some passages, folded, and an index of their q-grams."""

    def __init__(self, items, table):
        self.codes, self.item = [], []
        for item, text in items:
            code = fold([text or ""], table)[0][:-1]
            code = code[(code == BLANK).argmin() :] if len(code) else code
            code = code[:-1] if len(code) and code[-1] == BLANK else code
            if len(code) >= Q:
                self.codes.append(code)
                self.item.append(item)
        hashes = [gram_hashes(c) for c in self.codes]
        grams = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(grams, kind="stable")
        sizes = [len(h) for h in hashes]
        self.passage_of = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place_of = np.concatenate([np.arange(n) for n in sizes])[order] if sizes else np.zeros(0, np.int64)
        self.grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.need = np.array([budget(min(len(c), REGION))[1] for c in self.codes], np.int64)

    def search(self, texts, table):
        """{(text number, passage number): (edits, first and last place in the text) of the best region}."""
        code, ends, place = fold(texts, table)
        hashes = gram_hashes(code)
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        row = np.searchsorted(self.grams, hashes[at])
        row[row == len(self.grams)] = 0
        same = self.grams[row] == hashes[at] if len(self.grams) else np.zeros(len(at), bool)
        at, row = at[same], row[same]
        count = self.first[row + 1] - self.first[row]
        total = np.concatenate(([0], np.cumsum(count)))
        # Whatever a region matches spans at most so many places: slices that overlap by them lose none.
        span = REGION + 2 * budget(REGION)[0] + 2
        best, start = {}, 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(total, total[start] + HITS)))
            until = int(np.searchsorted(at, at[min(stop, len(at)) - 1] + span, "right"))
            self._slice(best, code, ends, at[start:until], row[start:until], count[start:until])
            start = stop
        found = {}
        for (t, k), (edits, first, last) in best.items():
            origin = place[ends[t - 1] + 1 if t else 0]
            found[t, k] = (edits, int(place[first] - origin), int(place[last - 1] - origin) + 1)
        return found

    def _slice(self, best, code, ends, at, row, count):
        before = np.cumsum(count) - count
        entry = np.repeat(self.first[row] - before, count) + np.arange(count.sum())
        at = np.repeat(at, count)
        passage, inside = self.passage_of[entry], self.place_of[entry]
        pair = np.searchsorted(ends, at) * max(1, len(self.codes)) + passage
        order = np.lexsort((inside, pair))
        pair, at, inside = pair[order], at[order], inside[order]
        pairs, start = np.unique(pair, return_index=True)
        stop = np.append(start[1:], len(pair))
        text, passage = np.divmod(pairs, max(1, len(self.codes)))
        for i in np.flatnonzero(stop - start >= self.need[passage]):
            key = (int(text[i]), int(passage[i]))
            old = best.get(key)
            if old and old[0] == 0:
                continue
            lo, hits = ends[key[0] - 1] + 1 if key[0] else 0, slice(start[i], stop[i])
            found = self.verify(code[lo : ends[key[0]]], key[1], inside[hits], at[hits] - lo)
            if found:
                found = (found[0], int(found[1] + lo), int(found[2] + lo))
                best[key] = min(old, found) if old else found

    def verify(self, text, number, inside, at):
        """The best occurrence of a region of the passage where a band of diagonals holds enough hits, or None."""
        passage = self.codes[number]
        size = min(len(passage), REGION)
        edits, need = budget(size)
        width, grams = edits + 1, size - Q + 1
        diagonal = at - inside
        # Unchanged regions: runs of hits on one diagonal.
        order = np.lexsort((inside, diagonal))
        d, p = diagonal[order], inside[order]
        begins = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1))))
        lengths = np.diff(np.append(begins, len(d)))
        whole = begins[lengths >= grams]
        if len(whole):
            first = int((d + p)[whole].min())
            return 0, first, first + size
        best = None
        for band in np.unique(np.concatenate((diagonal // width, diagonal // width - 1))).tolist():
            p = np.unique(inside[(diagonal >= band * width) & (diagonal < (band + 2) * width)])
            if len(p) < need:
                continue
            # The region that begins with hit i ends with hit i + need - 1 or later.
            low = np.maximum(p[need - 1 :] - (grams - 1), 0)
            high = np.minimum(p[: len(p) - need + 1], len(passage) - size)
            next_start = 0
            for a, b in zip(low.tolist(), high.tolist()):
                begin = max(a, next_start)
                while begin <= b:
                    found = align(passage[begin : begin + size], text, band * width + begin - edits, (band + 2) * width + begin + edits)
                    if found[0] <= edits:
                        best = min(best, found) if best else found
                    # Moved by one place, a region's cost changes by at most two.
                    begin += max(1, (found[0] - edits + 1) // 2)
                next_start = max(next_start, begin)
        return best


def align(piece, text, low, high):
    """(edits, start, end) of the best occurrence on diagonals low..high.

    One row of the table per character of the piece, held by diagonal.
    """
    origin_of_text = max(0, low)
    text = text[origin_of_text : max(origin_of_text, high + len(piece) + 1)]
    low, high = low - origin_of_text, high - origin_of_text
    width, far = high - low + 1, len(piece) + 1
    steps = np.arange(width)
    cost = np.where((steps + low >= 0) & (steps + low <= len(text)), 0, far)
    start = steps + low
    padded = np.zeros(len(text) + 2 * width + len(piece) + abs(low) + abs(high), np.uint32)
    shift = width + max(0, -low)
    padded[shift : shift + len(text)] = text
    for i, c in enumerate(piece):
        same = padded[shift + i + low : shift + i + low + width] == c
        new, origin = cost + ~same, start.copy()
        up = np.append(cost[1:] + 1, far)
        better = up < new
        new[better] = up[better]
        origin[better] = np.append(start[1:], 0)[better]
        ends = steps + low + i + 1
        new[(ends < 0) | (ends > len(text))] = far
        # Insertions run along the row: the least of all earlier costs plus the distance.
        key = (new - steps) * width + steps
        pick = np.minimum.accumulate(key) % width
        cost, start = new[pick] + steps - pick, origin[pick]
        cost = np.minimum(cost, far)
    i = int(cost.argmin())
    return int(cost[i]), max(0, int(start[i])) + origin_of_text, int(i + low + len(piece)) + origin_of_text


def blocks(benchmark):
    """The passages, in lists of at most BLOCK_CHARS characters (or one passage)."""
    rows = columns(benchmark, item_id="long", text="string").where(F.col("text").isNotNull())
    held, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if held and size + len(r["text"]) > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if held:
        yield held


FOUND = "doc_id long, fingerprint long, item_id long, edits long, first_char long, last_char long"


def search(documents, benchmark):
    """Every (document, passage) pair with a region of the passage in the document.

    Columns: doc_id, fingerprint (xxhash64 of the text), item_id, the edits of the region that
    has the fewest, and its place in the text (last_char exclusive). The passages are the query
    set: blocks of them are held by every task, and each block takes a pass over all texts.
    Null and empty texts, and passages of under Q folded characters, match nothing; repeated
    rows give repeated pairs; a null id stays null; empty tables give no row; other columns
    are ignored. Long texts and repeated characters are taken HITS hits at a time.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("fingerprint", F.xxhash64("text"))
    result = spark.createDataFrame([], FOUND)
    for block in blocks(benchmark):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            table = process_cache("fold_table", fold_table)
            passages = Passages(held.value, table)
            names = [f.split()[0] for f in FOUND.split(", ")]
            for batch in tidy(batches):
                done = 0
                for keys, texts in chunks(batch, 0, 1, 500_000):
                    best = {}
                    for (text, passage), found in passages.search(texts, table).items():
                        key = (text, passages.item[passage])
                        best[key] = min(best.get(key, found), found)
                    prints = batch.column(2)
                    found = [(keys[t], prints[done + t].as_py(), item, *rest) for (t, item), rest in best.items()]
                    done += len(keys)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

        result = result.unionByName(rows.mapInArrow(run, FOUND))
    return result


def clean_documents(documents, benchmark):
    """`documents` without those that hold a passage; all columns stay."""
    found = materialise(search(documents, benchmark).select("doc_id", "fingerprint").distinct(), "leaks")
    return without(documents, found, F.xxhash64(F.col("text").cast("string")))
