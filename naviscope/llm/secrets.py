"""Secret scans through a trigram inverted index.

Each rule's regex gives a Boolean query of trigrams that every match must hold. A chunk of
documents is indexed once: the postings of a trigram are the sorted numbers of the chunk's
documents that hold it, letters folded to lower case. Queries are answered by intersecting and
uniting postings, and only the documents left are verified with the regex. A rule whose regex has
no mandatory trigram scans every document.
"""

import hashlib
import re
import sys
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from naviscope.llm.common import chunks, columns, process_cache, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A match counts if `group` has at least `least` characters.
Rule = namedtuple("Rule", "kind pattern group least folded", defaults=(0, 1, False))

BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are maximal either way, so this finds what `[0-9a-f]+` of 32 characters or more does.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
RULES = (
    *BASE,
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{20,}=*", folded=True),
    Rule("login", r"://[A-Za-z0-9._%+-]+:[^\s/@:]+@"),
)
# A class of more characters, or more alternatives than this, ends a literal.
FEW_CHARACTERS, FEW_LITERALS = 8, 128
# Places that are turned into trigrams at a time.
PLACES = 1 << 20


def fold(text):
    """`text` with A-Z in lower case."""
    return text.translate({c: c + 32 for c in range(65, 91)})


def all_of(parts):
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def any_of(parts):
    parts = list(dict.fromkeys(parts))
    return None if None in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def literal(text):
    return all_of(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern):
    """What a text must hold to match: a trigram, ("and", ...), ("or", ...), or None for anything."""
    heads, clauses = _walk(re._parser.parse(pattern), {""})
    return all_of([*clauses, any_of(map(literal, sorted(heads)))])


def _walk(items, heads):
    """(the literals that end here, the queries of those that ended before)."""
    clauses = []

    def end():
        nonlocal heads
        clauses.append(any_of(map(literal, sorted(heads))))
        heads = {""}

    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            heads = {h + fold(chr(value)) for h in heads}
        elif name == "IN" and (members := _members(value)):
            heads = {h + c for h in heads for c in members}
        elif name == "SUBPATTERN":
            heads, more = _walk(value[-1], heads)
            clauses += more
        elif name == "BRANCH":
            walked = [_walk(branch, heads) for branch in value[1]]
            heads = set().union(*(h for h, _ in walked))
            clauses.append(any_of(all_of(c) for _, c in walked))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            if (least, most) == (0, 1):
                with_it, more = _walk(inner, heads)
                if more:
                    end()
                else:
                    heads = heads | with_it
            else:
                for _ in range(min(least, 3)):
                    heads, more = _walk(inner, heads)
                    clauses += more
                if most > min(least, 3):
                    end()
        elif name not in ("AT", "ASSERT", "ASSERT_NOT"):
            end()
        if len(heads) > FEW_LITERALS:
            end()
    return heads, [c for c in clauses if c is not None]


def _members(parts):
    """The characters of a small class, folded; None if there are many or it is open."""
    found = set()
    for kind, value in parts:
        if str(kind) == "LITERAL":
            found.add(fold(chr(value)))
        elif str(kind) == "RANGE" and value[1] - value[0] < FEW_CHARACTERS:
            found.update(fold(chr(c)) for c in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= FEW_CHARACTERS else None


def trigrams_of(query):
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


def packed(trigram):
    a, b, c = map(ord, trigram)
    return a << 42 | b << 21 | c


class Index:
    """Postings of a chunk of texts: `find(query)` gives the numbers of the texts that can match.

    `wanted`: the trigrams to index, all if None.
    """

    def __init__(self, texts, wanted=None):
        self.size = len(texts)
        ends = np.cumsum([len(t) for t in texts])
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        upper = (code >= 65) & (code <= 90)
        code = code + (upper.astype(np.uint32) << 5)
        keys = None if wanted is None else np.array(sorted(map(packed, wanted)), np.uint64)
        if keys is not None:
            maybe = np.zeros(1 << 16, bool)
            maybe[self._slot(keys >> np.uint64(42), keys >> np.uint64(21), keys)] = True
        found = []
        for start in range(0, max(0, len(code) - 2), PLACES):
            part = code[start : start + PLACES + 2]
            a, b, c = part[:-2], part[1:-1], part[2:]
            at = np.arange(len(a)) if keys is None else np.flatnonzero(maybe[self._slot(a, b, c)])
            gram = a[at].astype(np.uint64) << np.uint64(42) | b[at].astype(np.uint64) << np.uint64(21) | c[at]
            if keys is not None:
                near = np.searchsorted(keys, gram)
                kept = (near < len(keys)) & (keys[np.minimum(near, len(keys) - 1)] == gram) if len(keys) else np.zeros(len(at), bool)
                at, gram = at[kept], gram[kept]
            at = at + start
            text = np.searchsorted(ends, at, "right")
            inside = at + 3 <= ends[text]
            found.append(np.unique(np.stack([gram[inside], text[inside].astype(np.uint64)], 1), axis=0))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)
        grams, first = np.unique(pairs[:, 0], return_index=True)
        self.postings = dict(zip(grams.tolist(), np.split(pairs[:, 1].astype(np.int64), first[1:])))

    @staticmethod
    def _slot(a, b, c):
        mix = a.astype(np.uint32) * np.uint32(0x9E5) ^ b.astype(np.uint32) * np.uint32(0x61) ^ c.astype(np.uint32)
        return mix & np.uint32(0xFFFF)

    def find(self, query):
        if query is None:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings.get(packed(query), np.empty(0, np.int64))
        found = sorted(map(self.find, query[1:]), key=len)
        out = found[0]
        for other in found[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out


class Scanner:
    def __init__(self, rules):
        self.rules = rules
        self.patterns = [re.compile(r.pattern, re.I | re.A if r.folded else 0) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.wanted = set().union(*map(trigrams_of, self.queries))
        for r, q in zip(rules, self.queries):
            if any(ord(c) > 127 for t in trigrams_of(q) for c in t) and r.folded:
                raise ValueError("rules in either case are ASCII")

    def scan(self, texts):
        """Per text the (start, number of the rule, end) of its secrets, sorted."""
        index, found = Index(texts, self.wanted), [[] for _ in texts]
        for number, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries)):
            for at in index.find(query).tolist():
                for m in pattern.finditer(texts[at]):
                    start, end = m.span(rule.group)
                    if end - start >= rule.least:
                        found[at].append((m.start(), number, m.end()))
        for spans in found:
            spans.sort()
        return found


def scan(documents, rules=RULES):
    """Secrets of every whole text.

    One row per input row: doc_id (may be null), n_<kind> of the base kinds, base_sha256 of the list
    of their spans, and spans, the list of all rules' spans; lists are by start, then rule. Spans of
    one kind don't overlap, those of different kinds may. Null and empty texts have none; repeated
    rows are repeated; an empty table gives no row; other columns are ignored; a very long text is
    a chunk of its own, indexed PLACES places at a time.
    """
    rules = tuple(rules)
    if rules[: len(BASE)] != BASE:
        raise ValueError("the base rules come first")
    names = ["doc_id", *[f"n_{r.kind}" for r in BASE], "base_sha256", "spans"]

    def listed(spans):
        return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        scanner = process_cache(f"secrets_{hash(rules)}", lambda: Scanner(rules))
        for batch in tidy(batches):
            for keys, texts in chunks(batch, 0, 1):
                found = scanner.scan(texts)
                counts = [pa.array([sum(k == n for _, k, _ in spans) for spans in found], pa.int64()) for n in range(len(BASE))]
                digests = [hashlib.sha256(listed(s for s in spans if s[1] < len(BASE)).encode()).hexdigest() for spans in found]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *counts, pa.array(digests, pa.string()), pa.array(map(listed, found), pa.string())], names)

    schema = f"doc_id long, {', '.join(f'n_{r.kind} long' for r in BASE)}, base_sha256 string, spans string"
    return columns(documents, doc_id="long", text="string").mapInArrow(run, schema)
