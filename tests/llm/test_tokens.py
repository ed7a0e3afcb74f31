"""BPE, token files and chat formatting against the tokenizers library and plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from naviscope.llm import bpe, chat, pretokens, token_file


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


@pytest.fixture(scope="module")
def codec(vocabulary):
    return bpe.Codec(bpe.read_vocabulary(vocabulary))


def odd_texts():
    rng = random.Random(3)
    letters = "ab's'tre'vll 1\n\t \xa0 éß漢字\u0663\u00bd'\u2019\x1c\x85\u200b<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    every = ["a" + "".join(chr(i) for i in range(b, b + 16)) + " b" for b in range(0, 0xD800, 16)]
    return [*texts, *every, "", "  ", "a" * 3000, "don't it'll've 's", "a<|endoftext|> b  <|endoftext|>", "<|endoftext|>"]


def test_ids_and_texts_are_the_library_s(library, codec, documents):
    texts = [*odd_texts(), *[r["text"] or "" for r in documents.select("text").collect()]]
    ids = codec.encode_batch(texts)
    wanted = library.encode_batch_fast(texts, add_special_tokens=False)
    assert ids == [np.array(e.ids, "<u4").tobytes() for e in wanted]
    assert [t.decode() for t in codec.decode_batch(ids)] == texts


def test_decoding_of_cut_characters(library, codec):
    ids = library.encode("漢字é", add_special_tokens=False).ids[1:-1] + [50256]
    assert codec.decode_batch([np.array(ids, "<u4").tobytes()])[0].decode() == library.decode(ids, skip_special_tokens=False)


def test_forgetting_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 3)
    assert codec.encode_batch(["one two three four", "five"]) == codec.encode_batch(["one two three four", "five"])


def test_round_trip_of_awkward_rows(library, awkward, no_documents, vocabulary):
    rows = bpe.round_trip(awkward, vocabulary).collect()
    wanted = []
    for r in awkward.collect():
        text = r["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, rows)) == sorted(map(str, [type(rows[0])(*w) for w in wanted])) or sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)
    assert bpe.round_trip(no_documents, vocabulary).count() == 0
    encoded = bpe.encode(awkward, vocabulary)
    assert sorted(r["text"] for r in bpe.decode(encoded, vocabulary).collect()) == sorted(r["text"] or "" for r in awkward.collect())


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 4000])
def test_codes(size):
    ids = np.random.default_rng(size).integers(0, 70_000, size).astype(np.uint32)
    ids[::5], ids[3:4] = 7, 2**32 - 1
    codes = token_file.Codes(token_file.pack_codes(ids))
    assert len(codes) == size and (codes.all() == ids).all()
    assert [codes[i] for i in range(0, size, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        codes[size]


def test_token_file(spark, awkward, no_documents, documents, vocabulary, library, tmp_path):
    for df in (awkward, documents, no_documents):
        path = str(tmp_path / str(df.count()))
        token_file.write_tokens(df, vocabulary, path, segment_tokens=5000)
        segments = token_file.read_segments(spark, path)
        found = [tuple(r) for r in token_file.document_digests(segments).collect()]
        rows = sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
        start, wanted, whole = 0, [], []
        for key, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids + [0]
            wanted.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
            whole += ids
        assert sorted(found, key=lambda r: r[1]) == wanted
        for i in range(0, len(whole), max(1, len(whole) // 5)):
            assert token_file.token_at(segments, i) == whole[i]


def test_chat(spark, sf_dir, vocabulary, tmp_path):
    odd = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (-2, 0, "assistant", "<|turn|>a<|done|>\n<\\|x é漢<"), (-2, 1, None, None), (-2, 1, None, None), (-2, None, "assistant", "\n|"), (-2, 3, "assistant", ""), (None, 3, "assistant", " <|endoftext|> ")]
    more = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").unionByName(more)
    path = str(tmp_path / "chats")
    chat.write_formatted(given.selectExpr("*", "'x' AS formatted", "1 AS part", "2 AS seq"), vocabulary, path, limit=1500)
    wanted = {}
    for r in sorted(given.collect(), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or "")):
        wanted.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    found = chat.digests(spark, path).collect()
    assert len(found) == len(wanted)
    for r in found:
        turns = wanted[r["conv_id"]]
        taught = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(taught), hashlib.sha256(taught.encode()).hexdigest())
        assert r["formatted_chars"] == len(chat.render(turns)[0])
    assert chat.conversations_formatted(more.limit(0), vocabulary).count() == 0


def test_segments_have_the_tokens_of_the_whole(vocabulary):
    tokenizer = chat.chat_tokenizer(bpe.read_vocabulary(vocabulary))
    turns = [("user", " a\n"), ("assistant", "\n\nb<|x"), ("user", "'s")] * 3
    parts = [tokenizer.encode(chat.render(turns[k : k + 2])[0]).ids for k in range(0, 9, 2)]
    assert sum(parts, []) == tokenizer.encode(chat.render(turns)[0]).ids


def test_remembered_offsets_are_the_library_s(vocabulary, monkeypatch):
    text = bpe.read_vocabulary(vocabulary)
    encoder, tokenizer = chat.OffsetEncoder(text), chat.chat_tokenizer(text)
    monkeypatch.setattr(pretokens, "REMEMBERED", 500)
    given = odd_texts()
    for k in range(0, len(given), 40):
        turns = [("user" if i % 2 else "assistant", t) for i, t in enumerate(given[k : k + 40])]
        formatted = chat.render(turns)[0]
        ids, starts, ends = encoder.encode(formatted)
        wanted = tokenizer.encode(formatted, add_special_tokens=False)
        assert ids.tolist() == wanted.ids
        assert list(zip(starts.tolist(), ends.tolist())) == wanted.offsets


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice("<\\|a") for _ in range(rng.randint(0, 9)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
