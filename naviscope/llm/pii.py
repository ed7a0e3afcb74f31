"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, `://` and cue
words. From each, a local parser expands to the borders of an email address, an IP address, a
card or phone number (base kinds), a login in a URL, an account number, an IBAN or a secret.
"""

import hashlib
import re
import sys

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from naviscope.llm.common import chunks, columns, process_cache, tidy

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "account", "iban", "secret")
CUES = {"account": ("account", "acct", "konto", "compte", "cuenta"), "iban": ("iban",), "secret": ("password", "passwd", "token", "secret", "api_key", "apikey")}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"[A-Za-z0-9._%+~!$&'*,;=-]+(?::[^\s@/]*)?@[A-Za-z0-9.-]+")
ACCOUNT = re.compile(r"(?:\s?(?:no|nr|number|id))?[.:#=\s]{1,3}([0-9]{6,20})(?![0-9])", re.I | re.A)
IBAN = re.compile(r"[:=\s]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8})(?![A-Za-z0-9])")
SECRET = re.compile(r"\s{0,2}[:=]\s{0,2}[\"']?([A-Za-z0-9_+/=.-]{8,})")


def anchors():
    """The automaton; a cue counts in lower, upper and title case."""
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    for word, name in (("@", "email"), ("+", "phone"), ("://", "login")):
        found.add_word(word, (name, len(word)))
    for kind, words in CUES.items():
        for w in words:
            for form in {w, w.upper(), w.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def at_most_255(digits):
    """Of a run of digits of any length."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def iban_valid(text):
    text = text.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def find(text, automaton):
    """Spans by kind, each kind's in order and without overlap: {kind: [(start, end)]}."""
    found = {}
    done = dict.fromkeys((*KINDS, "chain"), 0)

    def add(kind, start, end):
        found.setdefault(kind, []).append((start, end))

    for end, (name, size) in automaton.iter(text):
        at = end + 1 - size
        if name == "digit":
            if at >= done["ip"]:
                chain = NUMBERS.match(text, at)
                done["ip"] = chain.end()
                parts, start = chain[0].split("."), at
                for k in range(0, len(parts) - 3, 4):
                    stop = start + sum(map(len, parts[k : k + 4])) + 3
                    if all(at_most_255(p) for p in parts[k : k + 4]):
                        add("ip", start, stop)
                    start = stop + 1
            if at >= done["card"]:
                m = CARD.match(text, at)
                done["card"] = m.end() if m else at + 1
                if m:
                    digits = re.sub("[ -]", "", m[0])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
        elif name == "email":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                add("email", start, m.end())
                done["email"] = m.end()
        elif name == "phone":
            m = PHONE.match(text, at) if at >= done["phone"] else None
            if m:
                done["phone"] = m.end()
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    add("phone", at, m.end())
        elif name == "login":
            m = LOGIN.match(text, end + 1)
            if m and end + 1 >= done["login"]:
                done["login"] = m.end()
                add("login", end + 1, m.end())
        else:
            m = {"account": ACCOUNT, "iban": IBAN, "secret": SECRET}[name].match(text, end + 1)
            if m and m.start(1) >= done[name] and (name != "iban" or iban_valid(m[1])):
                done[name] = m.end(1)
                add(name, m.start(1), m.end(1))
    return found


def listed(found, kinds):
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in found.get(k, ()))


def redact(text, found):
    """The text with every span replaced by its kind; of overlapping spans, the first to start (then the longest) names all."""
    out, at, merged = [], 0, []
    for start, end, kind in sorted(((s, e, k) for k, spans in found.items() for s, e in spans), key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def scan(documents):
    """Personal data of every whole text.

    One row per input row: doc_id (may be null), counts of the base kinds, base_sha256 of their
    list, and spans, the list of all. Null and empty texts have none; repeated rows are
    repeated; an empty table gives no row; other columns are ignored.
    """
    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"]

    def run(batches):
        automaton = process_cache("pii_anchors", anchors)
        for batch in tidy(batches):
            for keys, texts in chunks(batch, 0, 1):
                found = [find(t, automaton) for t in texts]
                counts = [pa.array([len(f.get(k, ())) for f in found], pa.int64()) for k in BASE]
                digests = [hashlib.sha256(listed(f, BASE).encode()).hexdigest() for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *counts, pa.array(digests, pa.string()), pa.array([listed(f, KINDS) for f in found], pa.string())], names)

    return columns(documents, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(documents):
    """`documents` with personal data replaced in `text` (and `n_chars` counted anew, if there)."""
    schema = documents.schema
    at = schema.names.index("text")

    def run(batches):
        automaton = process_cache("pii_anchors", anchors)
        for batch in tidy(batches):
            texts = [t and redact(t, find(t, automaton)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    rows = documents.mapInArrow(run, schema)
    return rows.withColumn("n_chars", F.coalesce(F.length("text").cast(schema["n_chars"].dataType), F.col("n_chars"))) if "n_chars" in schema.names else rows
