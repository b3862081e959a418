"""Personal data and secrets: expressions propose spans, validators confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) follow fixed rules and are always kept; context only moves their
score. The method adds spans of further kinds that reach a threshold: iban (mod-97), imei and short
cards (Luhn), and secrets (length, alphabet and entropy of a token). All scans are linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "account", "secret")
#: What a confirmed span scores; context words move it. A span of an extra kind needs the threshold.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "account": 0.5, "secret": 0.4, "known": 0.8}
STEP, THRESHOLD = 0.3, 0.7
#: Code points before and after a span in which context words count.
CONTEXT = 40


def any_of(words: str) -> re.Pattern:
    return re.compile(rf"(?i)(?<![^\W\d_])(?:{'|'.join(words.split())})(?![^\W\d_])")


BANKING = "card visa credit account iban bank imei device konto karte carte compte tarjeta cuenta"
NUMBERING = "order invoice isbn sku tracking ref version example"
SPEAKING = {
    "email": any_of("mail email e-mail contact correo courriel"),
    "ip": any_of("ip host server address login"),
    "card": any_of(BANKING),
    "phone": any_of("phone tel telephone call mobile fax telefon téléphone teléfono"),
    "iban": any_of(BANKING),
    "account": any_of(BANKING),
    "secret": any_of("token tokens key keys apikey secret password passwd pwd credential credentials bearer auth authorization"),
}
AGAINST = {
    "email": any_of("example"),
    "ip": any_of("version section release chapter"),
    "card": any_of(NUMBERING),
    "phone": any_of(NUMBERING),
    "iban": any_of(NUMBERING),
    "account": any_of(NUMBERING),
    "secret": any_of("sha sha1 sha256 md5 commit hash checksum digest uuid etag"),
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
DIGITS = re.compile(r"[0-9]")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+")
#: Tokens whose form says what they are, whatever stands nearby.
KNOWN = re.compile(r"sk-[A-Za-z0-9_-]{16,}|gh[oprsu]_[A-Za-z0-9]{20,}|hf_[A-Za-z0-9]{20,}|AKIA[A-Z0-9]{16}")
#: Bits of entropy per character and length of a secret; and at least one digit among so many characters.
ENTROPY, LONGEST, PER_DIGIT = 3.0, 512, 8

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail expression, found from each @ outwards: no rescan of long words."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """Base spans in the order of BASE, then by start."""
    out: list[Span] = [("email", *x) for x in emails(text)] if "@" in text else []
    if not DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def entropy(token: str) -> float:
    """Bits per character, from the token's own letter counts."""
    n = len(token)
    return -sum(c / n * log2(c / n) for c in Counter(token).values())


def random_looking(token: str) -> bool:
    """Whether a token has the length, alphabet (letters, and enough digits) and entropy of a secret."""
    digits = len(DIGITS.findall(token))
    return len(token) <= LONGEST and len(token) <= PER_DIGIT * digits < PER_DIGIT * len(token) and entropy(token) >= ENTROPY


def score(text: str, start: int, end: int, kind: str, known: bool = False) -> float:
    """From 0 to 1: the kind's start, STEP more for each speaking context word nearby, STEP less for each that speaks against."""
    near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}"
    moved = START["known" if known else kind] + STEP * len(SPEAKING[kind].findall(near)) - STEP * len(AGAINST[kind].findall(near))
    return round(min(1.0, max(0.0, moved)), 2)


def extra_spans(text: str, base: list[Span], threshold: float = THRESHOLD) -> list[Span]:
    """Confirmed spans of EXTRA kinds that reach the threshold and overlap no base span nor an extra one listed before, by kind, then start."""
    found: list[Span] = []
    if not DIGITS.search(text):
        return found
    for m in IBAN.finditer(text):
        if len(d := m[0].replace(" ", "")) <= 34 and mod97(d) and score(text, *m.span(), "iban") >= threshold:
            found.append(("iban", *m.span()))
    for m in CARD.finditer(text):
        if 13 <= len(d := digits_of(m[0])) <= 15 and luhn(d) and score(text, *m.span(), "account") >= threshold:
            found.append(("account", *m.span()))
    for m in TOKEN.finditer(text):
        known = KNOWN.fullmatch(m[0]) is not None
        if (known or random_looking(m[0])) and score(text, *m.span(), "secret", known) >= threshold:
            found.append(("secret", *m.span()))
    out: list[Span] = []
    for kind in EXTRA:
        taken = sorted([*base, *out], key=lambda s: s[1])
        starts, ends = [s[1] for s in taken], list(accumulate((s[2] for s in taken), max))
        out += [s for s in found if s[0] == kind and not overlaps(s, starts, ends)]
    return out


def overlaps(span: Span, starts: list[int], ends: list[int]) -> bool:
    """Whether a taken span overlaps; starts are sorted, ends the largest end so far."""
    k = bisect_left(starts, span[2])
    return k > 0 and ends[k - 1] > span[1]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: id, counts of base spans, the digest of base spans, all spans, their number and their scores (in the order of spans).

    Offsets are code points, ends exclusive. A null text is empty. Repeated rows repeat; only the two
    named columns are read, so other names can't clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                kinds = [s[0] for s in base]
                spans = base + extra_spans(text, base, threshold)
                scores = ",".join(f"{score(text, a, e, k, k == 'secret' and KNOWN.fullmatch(text, a, e) is not None):.2f}" for k, a, e in spans)
                rows.append((*(kinds.count(k) for k in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans), scores))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.string()]
            names = [id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans", "scores"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    schema = f"`{id_col}` long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, scores string"
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("t")).mapInArrow(run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with every span of text_col replaced by its kind in angle brackets; all other columns stay."""

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        base = base_spans(text)
        out, done = [], 0
        for kind, a, b in sorted(base + extra_spans(text, base, threshold), key=lambda s: (s[1], -s[2])):
            if a >= done:
                out += [text[done:a], f"<{kind}>"]
                done = b
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            texts = pa.array([clean(t) for t in b.column(at).to_pylist()], b.column(at).type)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], texts, *b.columns[at + 1 :]], b.schema.names)

    return docs.mapInArrow(run, docs.schema)
