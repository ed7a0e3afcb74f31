"""Chat formatting with loss masks that are aligned by offsets.

A turn is rendered as <|turn|>role<|says|>text<|done|>. The three marks and the file's own
special token all start with `<|`; in a text (or role) every `<`, backslashes, `|` gets one
more backslash, so that no mark can occur in it, and taking one away gives the text back.
The marks are added to the tokenizer as special tokens, hence no token straddles a turn.
"""

import hashlib
import os
import re
import sys
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.bpe import read_vocabulary
from naviscope.llm.common import columns, process_cache, tidy
from naviscope.llm.pretokens import encode_texts
from naviscope.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
MARKS = re.compile(r"(<\|(?:turn|says|done)\|>)")
TAUGHT = "assistant"
SEGMENTS = "conv_id long, part int, seq int, formatted string, token_ids array<int>, spans array<int>, masked array<int>"


def escape(text):
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text):
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns):
    """(formatted text, [(start, end) of each turn's text], [is it taught])."""
    out, spans, taught, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        out += [head, body, DONE]
        spans.append((at + len(head), at + len(head) + len(body)))
        taught.append(role == TAUGHT)
        at = spans[-1][1] + len(DONE)
    return "".join(out), spans, taught


def parse(formatted):
    """The turns of a formatted text."""
    for turn in formatted.split(TURN)[1:]:
        role, _, text = turn.partition(SAYS)
        yield unescape(role), unescape(text.removesuffix(DONE))


def mask(spans, starts, ends):
    """Token ranges [first, last) of sorted text spans, by binary search in the token spans."""
    spans = np.asarray(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, spans[:, 0], "right")
    last = np.searchsorted(starts, spans[:, 1], "left")
    return np.stack([first, np.where(spans[:, 0] < spans[:, 1], last, first)], 1)


def chat_tokenizer(vocabulary):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, SAYS, DONE)])
    return tokenizer


class OffsetEncoder:
    """Ids and offsets of formatted texts, as the tokenizer with the marks gives them.

    Marks part the text first, so each pre-token between them is encoded once per worker and
    remembered with its offsets, counted back from the pre-token's end.
    """

    def __init__(self, vocabulary):
        self.tokenizer, self.known = chat_tokenizer(vocabulary), {}
        self.mark = {m: pack("<4i", self.tokenizer.token_to_id(m), -len(m), 0, len(m)) for m in (TURN, SAYS, DONE)}
        # Escaped texts hold no `<|`, hence no special token of the file.
        self.special = (TURN, self.tokenizer.token_to_id(TURN))

    def encode_new(self, pieces):
        """Per token: id, start and end less the piece's length, and that length at the first token."""
        out = []
        for piece, found in zip(pieces, self.tokenizer.encode_batch(pieces, add_special_tokens=False)):
            n = len(piece)
            flat = [x for i, (start, end) in zip(found.ids, found.offsets) for x in (i, start - n, end - n, 0)]
            flat[3] = n
            out.append(pack(f"<{len(flat)}i", *flat))
        return out

    def encode(self, formatted):
        """(ids, starts, ends) of a formatted text."""
        parts = MARKS.split(formatted)
        rows = encode_texts(parts[::2], self.known, self.encode_new, self.special)
        joined = b"".join(chain.from_iterable(zip(rows, map(self.mark.get, parts[1::2])))) + rows[-1]
        table = np.frombuffer(joined, "<i4").reshape(-1, 4)
        read = np.cumsum(table[:, 3], dtype=np.int32)
        return table[:, 0], read + table[:, 1], read + table[:, 2]


def lists(arrays):
    """A column of integer lists from one array per row."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32)))


def formatter(vocabulary, limit):
    """mapInArrow over rows sorted by conversation and turn: a segment per run of turns.

    A conversation that goes over several partitions, or past `limit` characters, makes
    several segments; as marks split the text anyway, the tokens are those of the whole.
    Segments leave the task in batches of about `limit` characters.
    """
    names = [f.split()[0] for f in SEGMENTS.split(", ")]

    def run(batches):
        encoder = process_cache(f"chat_{hash(vocabulary.value)}", lambda: OffsetEncoder(vocabulary.value))
        part, seq = TaskContext.get().partitionId(), 0

        def segment(conv, turns):
            formatted, spans, taught = render(turns)
            ids, starts, ends = encoder.encode(formatted)
            ranges = mask([s for s, t in zip(spans, taught) if t], starts, ends)
            return conv, part, seq, formatted, ids, np.stack((starts, ends), 1).ravel(), ranges.ravel()

        def table(segments):
            convs, parts, seqs, formatted, *numbers = zip(*segments)
            return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(parts, pa.int32()), pa.array(seqs, pa.int32()), pa.array(formatted, pa.string()), *map(lists, numbers)], names)

        conv, turns, size, done, held = None, [], 0, [], 0
        for batch in tidy(batches):
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and (key != conv or size >= limit):
                    done.append(segment(conv, turns))
                    held += size
                    turns, size, seq = [], 0, seq + 1
                    if held >= limit:
                        yield table(done)
                        done, held = [], 0
                conv = key
                turns.append((role or "", text or ""))
                size += len(turns[-1][0]) + len(turns[-1][1])
        if turns:
            done.append(segment(conv, turns))
        if done:
            yield table(done)

    return run


def write_formatted(conversations, vocabulary_path, path, limit=250_000):
    """Write every conversation, formatted, encoded and masked, as segments.

    Rows are dealt out by ranges of (conv_id, turn), so a conversation with a third of all
    rows is spread over many tasks. Null roles and texts are empty, rows of equal turn go
    by role and text (nulls first), repeated rows are repeated turns; a null conv_id is a
    conversation of its own; other columns are ignored.
    """
    vocabulary = conversations.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string")
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    dealt.select("conv_id", "role", "text").mapInArrow(formatter(vocabulary, limit), SEGMENTS).write.mode("overwrite").parquet(path)


def masked_text(formatted, spans, ranges):
    """The text that the masked tokens cover, range by range."""
    at = np.asarray(spans, np.int64).reshape(-1, 2)
    return [formatted[at[i, 0] : at[j - 1, 1]] if i < j else "" for i, j in zip(ranges[::2], ranges[1::2])]


def digests(spark, path):
    """One row per conversation of the written segments.

    Digests are read in order, so one task passes over a conversation's text; it holds one
    segment at a time. Rendering, encoding and masking were done in parallel before.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"

    def run(batches):
        key, state, rows = None, None, []

        def closed():
            n, whole, chars, loss, size, tokens, taught = state
            return key, n, whole.hexdigest(), chars, loss.hexdigest(), size, tokens, taught

        def table():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("256") else pa.int64()) for n, c in zip(names, zip(*rows))], names)

        for batch in tidy(batches):
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("conv_id", "formatted")}
                row |= {n: batch.column(n)[i].values.to_numpy() for n in ("spans", "masked")}
                if state is None or row["conv_id"] != key:
                    if state:
                        rows.append(closed())
                    key, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                for role, text in parse(row["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for text in masked_text(row["formatted"], row["spans"], row["masked"]):
                    text = unescape(text)
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(row["formatted"])
                state[5] += len(row["spans"]) // 2
                state[6] += int(row["masked"][1::2].sum() - row["masked"][::2].sum())
            if rows:
                yield table()
                rows.clear()
        if state:
            rows.append(closed())
            yield table()

    found = spark.read.schema(SEGMENTS).parquet(path).select("conv_id", "part", "seq", "formatted", "spans", "masked")
    dealt = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return dealt.mapInArrow(run, schema)


def conversations_formatted(conversations, vocabulary_path):
    """Format all conversations into the shared folder, read the files back, and digest them."""
    spark = conversations.sparkSession
    path = new_folder(spark, "chats")
    write_formatted(conversations, vocabulary_path, path)
    return digests(spark, path)
