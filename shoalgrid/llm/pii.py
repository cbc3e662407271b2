"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby move the score.

Base kinds (email, ip, card, phone) follow fixed patterns and are always reported. Patterns are run
without backtracking: an e-mail grows from its ``@``, numbers start where a run of digits starts.
On top of them the method adds ``iban`` (confirmed by mod 97), and ``ssn`` and ``local_phone``, which have
no checksum and so need a word nearby that tells what they are. A span is reported if its score reaches
``THRESHOLD``; base kinds start above it and words nearby only raise them.

Offsets are code points, the end exclusive. Defined cases: a null text is empty; rows with a null or
repeated id give one row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoalgrid.llm.common import chunks, map_arrow, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
THRESHOLD = 0.5
#: Code points on each side of a span in which words are looked for.
NEAR = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PHONE_HERE = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")

#: Base score of a kind, and words nearby that raise it by 0.3.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3, "local_phone": 0.3}
WORDS = {
    "email": r"e-?mail|mail|contact|write",
    "ip": r"ip|host|server|address",
    "card": r"card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|telefon|teléfono|téléphone",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social security|security number",
    "local_phone": r"phone|tel|call|mobile|fax|telefon|teléfono|téléphone",
}
_WORDS = {k: re.compile(rf"\b(?:{v})\b", re.IGNORECASE) for k, v in WORDS.items()}
_NO_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled (less nine above nine): the sum is a multiple of ten."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35: the number is 1 modulo 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            floor = found.end()
            yield start, floor
        else:
            floor = at + 1
        at = text.find("@", floor)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGITS.sub("", m[0])) <= 15:
                yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest prefix of the match, by whole groups after a space, that passes the checksum.

    The search goes on behind that prefix or, if none passes, from the next group inside the match.
    """
    m = _IBAN.search(text)
    while m:
        end, after = m.end(), text.find(" ", m.start(), m.end())
        after = m.end() if after < 0 else after
        while end - m.start() >= 15:
            plain = text[m.start(): end].replace(" ", "")
            if 15 <= len(plain) <= 34 and mod_97(plain):
                yield m.start(), end
                after = end
                break
            end = text.rfind(" ", m.start(), end)
        m = _IBAN.search(text, after)


_FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
    "ssn": lambda t: (m.span() for m in _SSN.finditer(t)), "local_phone": lambda t: (m.span() for m in _PHONE_HERE.finditer(t)),
}


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - NEAR): start] + "\n" + text[end: end + NEAR]
    return min(1.0, SCORES[kind] + (0.3 if _WORDS[kind].search(near) else 0.0))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """Reported spans (kind, start, end, score) by start, then kind; an added span never lies over a base one."""
    base = [(s, BASE_KINDS.index(k), k, e) for k in BASE_KINDS for s, e in _FINDERS[k](text)]
    more = []
    for i, k in enumerate(KINDS[len(BASE_KINDS):], len(BASE_KINDS)):
        for s, e in _FINDERS[k](text):
            if score(text, k, s, e) >= THRESHOLD and not any(a < e and s < b for a, _, _, b in base):
                more.append((s, i, k, e))
    return [(k, s, e, score(text, k, s, e)) for s, _, k, e in sorted(base + more)]


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        counts, base, spans, scores = [], [], [], []
        for text in batch.column("text").to_pylist():
            found = find(text)
            own = [x for x in found if x[0] in BASE_KINDS]
            counts.append([sum(x[0] == k for x in own) for k in BASE_KINDS])
            base.append(hashlib.sha256(_joined(own).encode()).hexdigest())
            spans.append(_joined(found))
            scores.append([x[3] for x in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)], pa.array(base, pa.string()),
             pa.array(spans, pa.string()), pa.array(scores, pa.list_(pa.float64()))],
            names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "scores"])


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, digest of the base spans, all spans and their scores."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kinds = T.StructType([
        rows.schema["doc_id"], *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS], T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    return map_arrow(rows, _rows, kinds)


def redact(text: str) -> str:
    """The text with each reported span as ``<KIND>``; of overlapping spans the first stands."""
    out, end = [], 0
    for kind, s, e, _ in find(text):
        if s >= end:
            out += [text[end:s], f"<{kind.upper()}>"]
            end = e
    return "".join([*out, text[end:]])
