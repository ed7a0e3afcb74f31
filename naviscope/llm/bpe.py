"""BPE encoding and decoding: a backtracking encoder and a decoder by offset table."""

import hashlib
import json
import sys
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.common import chunks, columns, process_cache, tidy
from naviscope.llm.pretokens import encode_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs of tokens whose compatibility a worker remembers.
REMEMBERED_PAIRS = 100_000


def byte_letters():
    """The printable letter that stands for each byte in byte-level vocabularies, by byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return letters


class Codec:
    """Encoder and decoder of a byte-level BPE vocabulary (text of a tokenizers file).

    Encoding of a pre-token: an Aho-Corasick automaton over the reversed tokens,
    run over the reversed bytes, gives the longest token that starts at each place.
    From the left, the longest token is taken if the pair with its predecessor is
    compatible, else its longest proper prefix that is a token, and so on; where
    none is left the last token is taken back, and its end is not entered again.
    Each place is given up at most once: linear time. A pair is compatible if no
    merge across its border comes before the merges that made the two tokens.
    """

    def __init__(self, vocabulary):
        whole = json.loads(vocabulary)
        model = whole["model"]
        bytes_of = {letter: b for b, letter in byte_letters().items()}
        ids = model["vocab"]
        special = [t for t in whole["added_tokens"] if t["special"]]
        if len(special) != 1:
            raise ValueError("one special token is expected")
        self.special = (special[0]["content"], special[0]["id"])
        size = max(max(ids.values()), self.special[1]) + 1
        self.token_bytes = [b""] * size
        self.id_of = {}
        for token, i in ids.items():
            if token != self.special[0]:
                self.token_bytes[i] = bytes(bytes_of[c] for c in token)
                self.id_of[self.token_bytes[i]] = i
        self.token_bytes[self.special[1]] = self.special[0].encode()
        self.left, self.right, self.merged = {}, {}, {}
        rank = -1
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            i, a, b = ids[a + b], ids[a], ids[b]
            if not rank < i or max(a, b) >= i:
                raise ValueError("ids must follow the order of the merges")
            rank = i
            self.left[i], self.right[i], self.merged[a, b] = a, b, i
        self.matcher = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.matcher.add_word(token[::-1].decode("latin-1"), i)
        self.matcher.make_automaton()
        self.shorter, self.length = {}, {}
        for token, i in self.id_of.items():
            self.length[i] = len(token)
            self.shorter[i] = next((self.id_of[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.id_of), None)
        self.compatible, self.known = {}, {}
        self.offset = np.zeros(size + 1, np.int64)
        np.cumsum([len(t) for t in self.token_bytes], out=self.offset[1:])
        self.blob = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def is_compatible(self, a, b):
        limit = len(self.token_bytes)
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            if a > b and a in self.right:
                limit, a = a, self.right[a]
            elif b in self.left:
                limit, b = b + 1, self.left[b]
            else:
                return True

    def encode_piece(self, piece):
        """Token ids of one pre-token."""
        word = piece.encode()
        whole = self.id_of.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        # Matches that end at one place come longest first; the reversed list lets that one win.
        matches = list(self.matcher.iter(word[::-1].decode("latin-1")))
        matches.reverse()
        longest = dict(matches)
        out, at, token, dead = [], 0, longest[n - 1], set()
        length, shorter, pairs = self.length, self.shorter, self.compatible
        while True:
            end = at + length[token]
            good = end not in dead
            if good and out:
                pair = (out[-1], token)
                good = pairs.get(pair)
                if good is None:
                    good = pairs[pair] = self.is_compatible(*pair)
            if good:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[n - 1 - at]
                continue
            token = shorter[token]
            while token is None:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def encode_new(self, pieces):
        if len(self.compatible) > REMEMBERED_PAIRS:
            self.compatible.clear()
        return [pack(f"<{len(ids)}I", *ids) for ids in map(self.encode_piece, pieces)]

    def encode_batch(self, texts):
        """Little-endian unsigned 32-bit ids of each text, as bytes."""
        return encode_texts(texts, self.known, self.encode_new, self.special)

    def decode_batch(self, encoded):
        """UTF-8 bytes of each id sequence: every id's slice of the table of all tokens' bytes."""
        sizes = [len(e) // 4 for e in encoded]
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
        begin = self.offset[ids]
        lengths = self.offset[ids + 1] - begin
        ends = np.cumsum(lengths)
        place = np.repeat(begin - (ends - lengths), lengths)
        place += np.arange(len(place))
        data = self.blob[place].tobytes()
        edge = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))].tolist()
        whole = (data[i:j] for i, j in zip(edge, edge[1:]))
        return [x.decode("utf-8", "replace").encode() for x in whole]


def read_vocabulary(path):
    with open(path, encoding="utf-8") as f:
        return f.read()


def worker(vocabulary, per_chunk):
    """A mapInArrow function: `per_chunk(codec, keys, values)` makes each output batch."""

    def run(batches):
        codec = process_cache(f"codec_{hash(vocabulary.value)}", lambda: Codec(vocabulary.value))
        for batch in tidy(batches):
            yield from per_chunk(codec, batch)

    return run


def encode(df, path, key="doc_id", text="text"):
    """(key, n_tokens, ids) with ids as little-endian unsigned 32-bit values; null text: no ids."""

    def per_chunk(codec, batch):
        for keys, texts in chunks(batch, 0, 1):
            ids = codec.encode_batch(texts)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["k", "n_tokens", "ids"])

    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = df.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(worker(vocabulary, per_chunk), "k long, n_tokens long, ids binary").withColumnRenamed("k", key)


def decode(df, path, key="doc_id", ids="ids"):
    """(key, text) of encoded rows; null ids: empty text."""

    def per_chunk(codec, batch):
        texts = codec.decode_batch([x.as_py() or b"" for x in batch.column(1)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode() for t in texts], pa.string())], ["k", "text"])

    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = df.select(F.col(key).cast("long"), F.col(ids).cast("binary"))
    return rows.mapInArrow(worker(vocabulary, per_chunk), "k long, text string").withColumnRenamed("k", key)


def round_trip(documents, path):
    """Encode each text, decode the ids, and give the digests of both.

    One row per input row: doc_id (null stays null), n_tokens, ids_sha256, decoded_sha256.
    A null or empty text has no tokens; repeated rows are repeated; extra columns are ignored.
    """

    def per_chunk(codec, batch):
        for keys, texts in chunks(batch, 0, 1):
            ids = codec.encode_batch(texts)
            back = codec.decode_batch(ids)
            digests = [[hashlib.sha256(x).hexdigest() for x in side] for side in (ids, back)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), *[pa.array(d, pa.string()) for d in digests]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    return columns(documents, doc_id="long", text="string").mapInArrow(worker(vocabulary, per_chunk), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
