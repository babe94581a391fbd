"""Personal data: patterns propose, checksums confirm, context adjusts.

Base kinds (their matches always stay once their own check passes): ``email``,
``ip`` (parts at most 255), ``card`` (14 to 19 digits, Luhn), ``phone`` (10 to
15 digits).  Further kinds start from a prior and gain or lose by words nearby;
they count from ``ACCEPT`` on: ``iban`` (mod 97 confirms), ``tax_id``
(nnn-nn-nnnn), ``local_phone`` (grouped digits without a plus), ``secret``
(long hexadecimal values).

Positions are code points, ends exclusive.  Within a kind matches are leftmost
and don't overlap; a match that fails its check is dropped without a retry.

Edge cases: null or empty text has no spans; every row gives one row, also with
a null or repeated doc_id; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, plain, ship, text_slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "tax_id", "local_phone", "secret")
_PLACE = {k: i for i, k in enumerate(KINDS)}
#: Code points on either side in which context words count.
REACH = 48
ACCEPT = 0.6

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does, so long runs cost nothing
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_TAX = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+()./-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{2,4}(?:[\x20./-][0-9]{2,4}){1,4}(?![0-9])")
_SECRET = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{32,128}(?![0-9A-Za-z])")
_NEAR = {
    "iban": re.compile(r"iban|bank|account|konto|compte|cuenta", re.I),
    "tax_id": re.compile(r"ssn|social|tax|security", re.I),
    "local_phone": re.compile(r"\btel|phone|call|mobile|fax|anruf|handy|appel|llam", re.I),
    "secret": re.compile(r"token|secret|key|password|passwd|bearer", re.I),
}
_AGAINST = re.compile(r"version|isbn|page|section|chapter|commit|checksum|sha", re.I)
_PRIOR = {"iban": 0.7, "tax_id": 0.5, "local_phone": 0.35, "secret": 0.45}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i & 1:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def mod97(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _emails(text: str):
    """As the leftmost search of local part, @ and domain would find them, but
    anchored on each @, so that long runs of letters cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _context(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - REACH) : start] + "\n" + text[end : end + REACH]
    score = _PRIOR[kind]
    if _NEAR[kind].search(near):
        score += 0.4
    if _AGAINST.search(near):
        score -= 0.3
    return min(1.0, max(0.0, score))


def _covered(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs that spans cover, in order and apart."""
    starts, ends = [], []
    for a, b in sorted((s.start, s.end) for s in spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find(text: str, has_digit: bool = True) -> list[Span]:
    """All spans of one text, by start, then by kind as listed in ``KINDS``."""
    out = []
    if "@" in text:
        out += [Span("email", a, b, 1.0) for a, b in _emails(text)]
    if has_digit:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append(Span("ip", m.start(), m.end(), 1.0))
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(Span("card", m.start(), m.end(), 1.0))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m[0])) <= 15:
                    out.append(Span("phone", m.start(), m.end(), 1.0))
        starts, ends = _covered(out)
        for kind, pattern in (("iban", _IBAN), ("tax_id", _TAX), ("local_phone", _LOCAL_PHONE), ("secret", _SECRET)):
            for m in pattern.finditer(text):
                a, b = m.span()
                i = bisect.bisect_left(starts, b)  # the covered runs before b
                if i and ends[i - 1] > a:
                    continue
                if kind == "iban" and not mod97(m[0]):
                    continue
                if kind == "local_phone" and not 7 <= len(_digits(m[0])) <= 12:
                    continue
                score = _context(text, kind, a, b)
                if score >= ACCEPT:
                    out.append(Span(kind, a, b, score))
        out.sort(key=lambda s: (s.start, _PLACE[s.kind]))
    return out


def _joined(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_OUT = pa.schema([("row_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string())])
_NOTHING = hashlib.sha256(b"").hexdigest()


def _suspects(col) -> tuple[list, list]:
    """Which texts hold a digit, and which an @ or a digit."""
    digit = pc.fill_null(pc.match_substring_regex(col, "[0-9]"), False)
    return digit.to_pylist(), pc.or_(digit, pc.fill_null(pc.match_substring(col, "@"), False)).to_pylist()


def _scan(batches):
    for b in text_slices(batches, 1):
        col = b.column(1)
        digit, any_ = _suspects(col)
        counts, sha, spans = {k: [] for k in BASE}, [], []
        for i in range(b.num_rows):
            found = find(col[i].as_py(), digit[i]) if any_[i] else []
            base = [s for s in found if s.kind in BASE]
            for k in BASE:
                counts[k].append(sum(s.kind == k for s in base))
            sha.append(hashlib.sha256(_joined(base).encode()).hexdigest() if base else _NOTHING)
            spans.append(_joined(found))
        yield batch(_OUT, b.column(0), *counts.values(), sha, spans)


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    ship(docs.sparkSession)
    docs = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ddl = "row_id long, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return docs.mapInArrow(_scan, ddl).withColumnRenamed("row_id", "doc_id")


def masked(text: str) -> str:
    """``text`` with each span replaced by its kind; overlaps become one mask
    named by the first of them."""
    out, at = [], 0
    for s in find(text):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
            at = s.end
        else:
            at = max(at, s.end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``; other columns stay,
    except that an ``n_chars`` follows the text."""
    ship(docs.sparkSession)
    text = docs.columns.index("text")

    def run(batches):
        for b in text_slices(batches, text):
            col = b.column(text)
            any_ = _suspects(col)[1]
            if any(any_):
                new = pa.array([masked(col[i].as_py()) if any_[i] else col[i].as_py() for i in range(b.num_rows)], col.type)
                b = pa.RecordBatch.from_arrays([new if k == text else b.column(k) for k in range(b.num_columns)], schema=b.schema)
            yield b

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
