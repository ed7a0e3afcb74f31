"""Secret scans, collocations and tokenizer alignment against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import public_tokenizers
from naviscope.llm import alignment, collocations, secrets

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def keyed(rows):
    return sorted(map(tuple, rows), key=str)


# Secret scans


def plain_secrets(text):
    """(start, kind, end) of the base kinds, by the regexes as they are stated."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for n, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(m.start(), n, m.end()) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return sorted(out)


def secret_texts():
    rng = random.Random(2)
    parts = ["password", "PassWord", "passwd", "ſecret", "secret", "toKen", "api_key", "APIKEY", "'", '"', " ", "  ", ":", "=", "abc", "abcdefgh", "token", "AKIA", "AKIA" + "Z" * 12, "AKIAAKIA",
             "0123456789abcdef", "deadbeef" * 4, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-1234567890", "AIza" + "b" * 35, "sk_live_" + "c" * 20, "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "Bearer " + "d" * 20, "https://me:pw@host", "\n", "漢字", "İ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]


def test_secrets_equal_plain_regexes(documents):
    texts = [*secret_texts(), *[r["text"] or "" for r in documents.select("text").collect()], "", "to", "token=" + "a" * 200_000, "f" * 100_000]
    scanner = secrets.Scanner(secrets.RULES)
    found = [s for at in range(0, len(texts), 500) for s in scanner.scan(texts[at : at + 500])]
    for text, spans in zip(texts, found):
        wanted = sorted((m.start(), k, m.end()) for k, (r, p) in enumerate(zip(scanner.rules, scanner.patterns)) for m in p.finditer(text) if m.end(r.group) - m.start(r.group) >= r.least)
        assert spans == wanted and [s for s in spans if s[1] < 3] == plain_secrets(text)
    kinds = Counter(k for spans in found for _, k, _ in spans)
    assert len(kinds) == len(secrets.RULES)


def test_secret_query(spark, awkward, no_documents):
    texts = secret_texts()[:300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").union(awkward.select("doc_id", "text"))
    rows = [tuple(r) for r in df.collect()]
    names = ("assign", "access", "hex")
    wanted = []
    for key, text in rows:
        base = plain_secrets(text or "")
        listed = ",".join(f"{names[n]}:{s}:{e}" for s, n, e in base)
        wanted.append((key, *[sum(n == k for _, n, _ in base) for k in range(3)], hashlib.sha256(listed.encode()).hexdigest()))
    assert keyed(secrets.scan(df).drop("spans").collect()) == keyed(wanted)
    assert secrets.scan(no_documents).count() == 0
    assert secrets.scan(awkward).columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def holds(query, text):
    if query is None:
        return True
    if isinstance(query, str):
        return query in secrets.fold(text)
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1:])


@pytest.mark.parametrize(
    ("pattern", "texts", "query"),
    [
        ("abcd", ["abcd"], ("and", "abc", "bcd")),
        ("ab[cC]d?e", ["abce", "abcde", "abCde"], ("or", ("and", "abc", "bcd", "cde"), ("and", "abc", "bce"))),
        ("(?:foo|ba+r)x", ["foox", "barx", "baaaarx"], None),
        ("x{2,4}yz", ["xxyz", "xxxxyz"], None),
        (r"\bkey\b.*=", ["key = 1"], "key"),
        ("[^a]bc", ["xbc"], None),
        ("(abc)*", [""], None),
    ],
)
def test_trigram_queries(pattern, texts, query):
    found = secrets.trigram_query(pattern)
    assert found == query
    for t in texts:
        assert re.search(pattern, t) and holds(found, t)


def test_postings():
    texts = ["abcd", "", "xABCx", "ab", "cd"]
    index = secrets.Index(texts)
    assert index.find("abc").tolist() == [0, 2] and index.find("bcd").tolist() == [0]
    assert index.find(("or", ("and", "abc", "bcx"), "bcd")).tolist() == [0, 2] and index.find(None).tolist() == [0, 1, 2, 3, 4]
    assert secrets.Index(texts, {"abc"}).find("bcd").tolist() == []
    assert secrets.Index([]).postings == {}


# Collocations


def plain_phrases(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            totals[lang] += len(words)
            counts.update((lang, words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    candidates = {x: f for x, f in counts.items() if f >= least and len(x[1]) > 1}
    inside = {(lang, p[i:j]) for (lang, p), f in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and f >= candidates[lang, p[i:j]]}
    out = []
    for (lang, p), a in candidates.items():
        if (lang, p) not in inside:
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, n, *x[1:]) for n, x in enumerate(mine[:top], 1)]
    return ranked


def phrase_rows():
    rng = random.Random(4)
    words = ["a", "b", "C", "d", "é", "漢", "x y", "\x00", "long", "A"]
    texts = []
    for _ in range(300):
        parts = [rng.choice(words) + rng.choice((" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " fixed phrase of five words ")) for _ in range(rng.randint(0, 40))]
        texts.append((rng.choice(("en", "en", "de", None, "und")), "".join(parts)))
    return [*texts, ("en", None), (None, None), ("en", ""), ("fr", " "), ("en", "a b " * 3000)]


@pytest.mark.parametrize("keys", [collocations.BROADCAST_KEYS, 0])
def test_collocations_equal_plain_counting(spark, keys, monkeypatch):
    monkeypatch.setattr(collocations, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(collocations, "ROW_WORDS", 500)
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, lang, "clash", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, word string, f int").repartition(3)
    for least, top in ((3, 2000), (40, 5)) if keys else ((10, 50),):
        found = collocations.collocations(df, least, top).collect()
        assert keyed(found) == keyed(plain_phrases(rows, least, top)) and found


def test_collocations_of_little(spark, awkward, no_documents):
    assert collocations.collocations(no_documents).count() == 0
    rows = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert keyed(collocations.collocations(awkward, 2).collect()) == keyed(plain_phrases(rows, 2, 2000))


def test_quotient_filters_give_back_keys_and_counts():
    rng = np.random.default_rng(1)
    for shared, n in ((0, 0), (0, 1), (3, 2), (3, 5000), (10, 300), (31, 40), (5, 70_000)):
        keys = np.unique(collocations.permuted(rng.integers(0, 1 << 63, n, dtype=np.uint64)))
        low = np.unique(keys & np.uint64((1 << (64 - shared)) - 1))
        counts = rng.choice([1, 2, 254, 255, 256, 10**12], len(low))
        data = collocations.QuotientFilter.of(low, counts, shared).to_bytes()
        back, found = collocations.QuotientFilter.from_bytes(data).entries()
        assert (back == low).all() and (found == counts).all()
    assert len(data) < 9 * len(low) + 8 * (counts >= 255).sum() + 100
    some = rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
    assert (collocations.restored(collocations.permuted(some)) == some).all()


def test_filters_of_pairs_take_the_bits_of_their_ids():
    rng = np.random.default_rng(3)
    id_bits, slice_bits = 17, 7
    bits = collocations.key_bits(slice_bits, id_bits)
    ids = rng.integers(1, 1 << id_bits, 40_001).astype("<u4")
    at, pairs = collocations.pair_keys(ids.tobytes(), id_bits)
    keys = np.unique(collocations.permuted(pairs, bits))
    assert len(at) == 40_000 and (np.sort(collocations.restored(keys, bits)) == np.unique(pairs)).all()
    low = np.unique(keys & np.uint64((1 << (bits - slice_bits)) - 1))
    counts = rng.choice([1, 2, 300], len(low), p=[0.9, 0.09, 0.01])
    data = collocations.QuotientFilter.of(low, counts, slice_bits, bits).to_bytes()
    back, found = collocations.QuotientFilter.from_bytes(data).entries()
    assert (back == low).all() and (found == counts).all() and len(data) < 2.5 * len(low)
    for n_bits in (1, 2, 9, 33, 64):
        some = rng.integers(0, 1 << min(n_bits, 63), 500, dtype=np.uint64)
        moved = collocations.permuted(some, n_bits)
        assert (collocations.restored(moved, n_bits) == some).all() and (n_bits == 64 or (moved >> np.uint64(n_bits) == 0).all())


def test_places_and_ids_are_packed_without_loss():
    for codes in ([], [0], [254, 255, 256, 65789, 65790, 65791, 10**6], list(range(0, 200_000, 7))):
        assert collocations.unpacked(collocations.packed(np.array(codes, np.int64))).tolist() == codes
    assert len(collocations.packed(np.arange(1000) % 200)) < 1100
    for ids, kept in (([], []), ([5], []), ([0, 5, 0], []), ([1, 2], [1, 2]), ([1, 0, 2, 3, 0, 0, 4, 0, 5, 6, 7], [2, 3, 0, 5, 6, 7]), ([0, 1, 2, 0, 3], [1, 2, 0])):
        assert collocations.trimmed(np.array(ids, "<u4")).tolist() == kept


def test_a_task_hands_each_word_on_once_per_language(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ROW_WORDS", 100)
    rows = phrase_rows()
    df = spark.createDataFrame([("und" if lang is None else lang, t) for lang, t in rows], "lang string, text string").coalesce(1)
    schema = "row long, dict long, lang string, first long, words array<string>, counts array<long>, sequence binary"
    found = df.mapInArrow(collocations.word_rows, schema).collect()
    words = [(r["lang"], w) for r in found for w in r["words"] or ()]
    assert len(words) == len(set(words)) > 0 and sum(r["sequence"] is not None for r in found) > 20
    assert len({r["row"] for r in found}) == len(found)


def test_collocations_of_many_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_BYTES", 4000)
    monkeypatch.setattr(collocations, "ROW_WORDS", 30)
    monkeypatch.setattr(collocations, "DICTIONARY_ROW", 3)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    found = collocations.collocations(df, 5, 2000).collect()
    assert keyed(found) == keyed(plain_phrases(rows, 5, 2000)) and found


def test_scores_pass_64_bits(spark):
    big = 10**12
    rows = [("en", ["x", "y"], big, [3 * big, big], [2 * big, big], True)]
    df = spark.createDataFrame(rows, "lang string, words array<string>, f long, heads array<long>, tails array<long>, kept boolean")
    r = collocations.scored(df, spark.createDataFrame([("en", 10**13)], "lang string, n long")).first()
    assert r["score"] == 1000 * big * 10**13 // (3 * big * 2 * big) and (r["a"], r["l"], r["r"]) == (big, 3 * big, 2 * big)


# Tokenizer alignment


def odd_texts():
    rng = random.Random(7)
    letters = "ab's  the  of 12\n\t \xa0éß漢字😀́▁'’<s></s><unk><0x0A><|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    return [*texts, "", " ", "   ", "a ", " a", "a" * 3000, "<|endoftext|>", "<s> x", "\x00 b", "漢" * 500, "▁ a"]


def plain_alignment(rows, vocabulary):
    a_side = Tokenizer.from_file(vocabulary)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {c: b for b, c in alignment.byte_letters().items()}
    out, links_of, holding = [], [], Counter()
    for key, text in rows:
        text = text or ""
        a, b = a_side.encode(f" {text}", add_special_tokens=False).ids, b_side.encode(text)
        bytes_a = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        names = [b_side.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(n[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", n) else n.replace("▁", " ").encode() for n in names]
        if not text or b"".join(bytes_a) != f" {text}".encode() or b"".join(bytes_b) != f" {text}".encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (bytes_a, bytes_b)]
        cuts = sorted(ends[0] & ends[1])
        groups = []
        for low, high in zip([0, *cuts], cuts):
            sides = []
            for ids, sizes in ((a, bytes_a), (b, bytes_b)):
                at, mine = 0, []
                for i, x in zip(ids, sizes):
                    at += len(x)
                    if low < at <= high:
                        mine.append(i)
                sides.append(mine)
            groups.append(sides)
        links = [(i, j) for x, y in groups for i in x for j in y]
        holding.update(set(links))
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, len(a), len(b), len(groups), len(links), hashlib.sha256(written.encode()).hexdigest() if groups else ""))
        links_of.append(links)
    most = {}
    for (i, _), n in holding.items():
        most[i] = max(most.get(i, 0), n)
    return [(*o[:5], sum(holding[p] == most[p[0]] for p in links), sum(holding[p] for p in links), o[5]) for o, links in zip(out, links_of)]


def test_alignment_equals_plain_grouping(spark, vocabulary, documents, awkward, no_documents, monkeypatch):
    texts = odd_texts()
    given = documents.where("length(text) < 1500").select("text").limit(60).collect()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *[r["text"] for r in given]])], "doc_id long, text string").union(awkward.where("length(text) < 1000 or text is null").select("doc_id", "text"))
    rows = [tuple(r) for r in df.collect()]
    wanted = keyed(plain_alignment(rows, vocabulary))
    assert keyed(alignment.align(df, vocabulary, PIECES).collect()) == wanted
    assert sum(w[1] > 0 for w in wanted) > 500 and sum(w[1] == 0 for w in wanted) > 20
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 300)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 3)
    assert keyed(alignment.align(df, vocabulary, PIECES).collect()) == wanted
    assert alignment.align(no_documents, vocabulary, PIECES).count() == 0
    assert alignment.align(awkward, vocabulary, PIECES).count() == awkward.count()


def test_gallop_finds_common_values():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y, fx, fy, low = [], [], [0], [0], 0
        for _ in range(rng.integers(1, 6)):
            high = low + int(rng.integers(0, 60))
            values = np.arange(low, high)
            for side, edges in ((x, fx), (y, fy)):
                side.extend(values[rng.random(len(values)) < rng.random()].tolist())
                edges.append(len(side))
            low = high
        i, j = alignment.common_ends(np.array(x, np.int64), np.array(fx), np.array(y, np.int64), np.array(fy))
        common = sorted(set(x) & set(y))
        assert [x[k] for k in i] == common and [y[k] for k in j] == common


def test_words_give_the_ids_of_whole_texts(documents):
    with open(PIECES, "rb") as f:
        pieces = alignment.Pieces(f.read())
    texts = [*odd_texts(), *[r["text"] or "" for r in documents.select("text").collect()]]
    wanted = pieces.model.encode(texts)
    ids, begin, altered = pieces.encode(texts)
    assert pieces.by_word and [ids[i:j].tolist() if t else [] for t, i, j in zip(texts, begin, begin[1:])] == wanted
    assert {k for k, t in enumerate(texts) if "▁" in t} == set(altered)
