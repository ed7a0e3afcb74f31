"""Token ids as files of directly addressable codes.

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of every
id, level k the next chunk of those ids that go on; a bitmap per level says which do,
and a directory holds the number of set bits before each block of 512, so that the
place of an id in the next level is one directory entry plus the bits of one block.

The file is a Parquet table of segments, written and committed by Spark. A segment is a
run of whole documents in ascending doc_id order: `shard` (range of doc_ids), `seq`
(segment within it), `offset` (ids of the shard before it), `doc_ids`, `doc_tokens`
and `payload` (the codes of all their ids).
"""

import os
import sys
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.bpe import byte_letters, read_vocabulary
from naviscope.llm.common import chunks, columns, process_cache, tidy
from naviscope.llm.pretokens import encode_texts
from naviscope.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 512
# A segment is closed once it holds so many ids (documents stay whole).
SEGMENT_TOKENS = 1 << 18
END_OF_DOCUMENT = 0
# Pre-tokens a worker remembers (about 250 bytes each).
REMEMBERED = 1_000_000
# New pre-tokens of one call of the library.
IN_A_ROW = 4096
SEGMENTS = "shard int, seq int, offset long, doc_ids array<long>, doc_tokens array<int>, payload binary"


def pack_codes(ids):
    """The codes of an array of unsigned 32-bit ids."""
    rest, out = np.asarray(ids, np.uint32), []
    while len(rest):
        low, rest = rest & 255, rest >> 8
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32)
        ranks = np.concatenate(([0], np.cumsum(per_block)[:-1])).astype("<u4")
        out += [np.array([len(low)], "<u4").tobytes(), low.astype(np.uint8).tobytes(), bits.tobytes(), ranks.tobytes()]
        rest = rest[more]
    return b"".join(out)


class Codes:
    """Reader of `pack_codes` bytes: `codes[i]` without decoding others, `codes.all()`."""

    def __init__(self, payload):
        self.levels, at = [], 0
        while at < len(payload):
            n = int(np.frombuffer(payload, "<u4", 1, at)[0])
            parts = [np.frombuffer(payload, np.uint8, n, at + 4)]
            at += 4 + n
            parts.append(np.frombuffer(payload, np.uint8, -(-n // 8), at))
            at += len(parts[1])
            parts.append(np.frombuffer(payload, "<u4", -(-n // BLOCK), at))
            at += 4 * len(parts[2])
            self.levels.append(parts)

    def __len__(self):
        return len(self.levels[0][0]) if self.levels else 0

    def __getitem__(self, i):
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for depth, (low, bits, ranks) in enumerate(self.levels):
            value |= int(low[i]) << (8 * depth)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            first = i // BLOCK * BLOCK
            inside = np.unpackbits(bits[first >> 3 : (i >> 3) + 1], bitorder="little")[: i - first]
            i = int(ranks[i // BLOCK]) + int(inside.sum())
        return value

    def all(self):
        values = np.empty(0, np.uint32)
        for low, bits, _ in reversed(self.levels):
            upper, values = values, low.astype(np.uint32)
            values[np.unpackbits(bits, count=len(low), bitorder="little").view(bool)] |= upper << 8
        return values


def library_encoder(vocabulary):
    """(known pre-tokens, function that encodes new ones with the tokenizers library, special token)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    (number, token), *others = [(i, t.content) for i, t in tokenizer.get_added_tokens_decoder().items()]
    if others:
        raise ValueError("one special token is expected")

    letters = {c: b for b, c in byte_letters().items()}
    length = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for t, i in tokenizer.get_vocab().items():
        length[i] = len(t) if all(c in letters for c in t) else len(t.encode())

    def each(pieces):
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def together(pieces):
        """Pieces that begin with the only blank they hold are cut apart again by the library when they stand in a row."""
        ids = np.array(tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(length[ids])
        wanted = np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(ends, wanted)
        if len(ids) and at[-1] == len(ids) - 1 and (ends[at] == wanted).all():
            data, edges = ids.tobytes(), [0, *(4 * at + 4).tolist()]
            return [data[i:j] for i, j in zip(edges, edges[1:])]
        return each(pieces)

    def encode_new(pieces):
        row = [p for p in pieces if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        known = {}
        for k in range(0, len(row), IN_A_ROW):
            known.update(zip(row[k : k + IN_A_ROW], together(row[k : k + IN_A_ROW])))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, each(rest)))
        return list(map(known.__getitem__, pieces))

    return {}, encode_new, (token, number)


def segment_writer(vocabulary, segment_tokens):
    def run(batches):
        known, encode_new, special = process_cache(f"library_{hash(vocabulary.value)}", lambda: library_encoder(vocabulary.value))
        end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
        shard, seq, offset, docs, sizes, held = TaskContext.get().partitionId(), 0, 0, [], [], []

        def segment():
            row = {"shard": shard, "seq": seq, "offset": offset, "doc_ids": docs, "doc_tokens": sizes, "payload": pack_codes(np.frombuffer(b"".join(held), "<u4"))}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))

        filled = 0
        for batch in tidy(batches):
            for keys, texts in chunks(batch, 0, 1):
                for key, ids in zip(keys, encode_texts(texts, known, encode_new, special, REMEMBERED)):
                    docs.append(key)
                    held.append(ids + end)
                    sizes.append(len(ids) // 4 + 1)
                    filled += sizes[-1]
                    if filled >= segment_tokens:
                        yield segment()
                        seq, offset, filled, docs, sizes, held = seq + 1, offset + filled, 0, [], [], []
        if docs:
            yield segment()

    return run


def write_tokens(documents, vocabulary_path, path, segment_tokens=SEGMENT_TOKENS):
    """Write every text's ids, each document ended by id 0, in ascending doc_id order.

    Null doc_ids come first, repeated ones in order of their texts; a null or empty text
    is the end id alone; an empty table gives no segment; extra columns are ignored.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = columns(documents, doc_id="long", text="string")
    # Rows of equal doc_id are dealt by how their texts begin.
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(segment_writer(vocabulary, segment_tokens), SEGMENTS).write.mode("overwrite").parquet(path)


def read_segments(spark, path):
    """The segments with `start`, the number of ids in all segments before them.

    Only one number a shard passes the driver.
    """
    found = spark.read.schema(SEGMENTS).parquet(path)
    sizes = found.groupBy("shard").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    totals = dict(tuple(r) for r in sizes.collect())
    shards = sorted(totals)
    bases = dict(zip(shards, accumulate([0, *[totals[s] for s in shards]])))
    rows = spark.createDataFrame(list(bases.items())[: len(shards)], "shard int, base long")
    return found.join(F.broadcast(rows), "shard").withColumn("start", F.col("base") + F.col("offset")).drop("base")


def document_digests(segments):
    """Per document, decoded from the codes: doc_id, start, n_tokens, ids_crc32."""

    def run(batches):
        for batch in tidy(batches):
            for row in batch.to_pylist():
                data = Codes(row["payload"]).all().astype("<u4").tobytes()
                sizes = row["doc_tokens"]
                at = list(accumulate(sizes, initial=0))
                crcs = [zlib.crc32(data[4 * i : 4 * j]) for i, j in zip(at, at[1:])]
                starts = [row["start"] + i for i in at[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row["doc_ids"], starts, sizes, crcs)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    needed = segments.select("start", "doc_ids", "doc_tokens", "payload")
    return needed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_at(segments, position):
    """The id at a place of the whole corpus: reads the one segment that holds it."""
    size = F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    row = segments.where((F.col("start") <= position) & (position < F.col("start") + size)).select("start", "payload").first()
    if row is None:
        raise IndexError(position)
    return Codes(row["payload"])[position - row["start"]]


def tokens_written_and_read(documents, vocabulary_path):
    """Write the token file into the shared folder, read it back and describe each document."""
    spark = documents.sparkSession
    path = new_folder(spark, "tokens")
    write_tokens(documents, vocabulary_path, path)
    return document_digests(read_segments(spark, path))
