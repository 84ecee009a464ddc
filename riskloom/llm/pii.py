"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import slices

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits fails from its first digit as from any later one, so matching may begin there only.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: Kinds in the order in which equal starts are listed; the first four are the base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
#: Further kinds: expression, score before words nearby are looked at, words that raise it.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
CONTEXT = {
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security", "sozialversicherung", "seguridad", "sociale"),
    "local_phone": ("phone", "tel", "call", "telefon", "mobile", "fax", "tél", "teléfono", "contact"),
}
PRIOR = {"iban": 0.9, "ssn": 0.5, "local_phone": 0.5}
#: Characters on either side that are searched for context words, what one adds, and the score needed.
NEARBY, BONUS, LEAST = 40, 0.3, 0.6


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str):
    """Leftmost matches of local part, @ and a domain with a dot, in time linear in the text."""
    end = 0
    at = text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        if m and at > end:
            start, width = at, 64
            while start > end:  # widen until the run of local characters is exhausted
                low = max(end, start - width)
                run = text[low:start]
                left = len(run.rstrip(LOCAL))
                start = low + left
                if left:
                    break
                width *= 2
            if start < at:
                yield start, m.end()
                end = m.end()
        at = text.find("@", max(at + 1, end))


def _short(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the four base kinds, failing candidates dropped without another try."""
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(map(_short, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = NOT_DIGIT.sub("", m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


def further_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """IBANs that pass mod-97, and social security and local phone numbers near a word that names them;
    none that overlaps a base span."""
    out = []
    for kind, pattern in (("iban", IBAN), ("ssn", SSN), ("local_phone", LOCAL_PHONE)):
        for m in pattern.finditer(text):
            if kind == "iban" and not mod97(m[0]):
                continue
            near = text[max(0, m.start() - NEARBY) : m.end() + NEARBY].lower()
            score = PRIOR[kind] + BONUS * any(w in near for w in CONTEXT[kind])
            if score >= LEAST and not any(a < m.end() and m.start() < b for a, b, _ in taken):
                out.append((m.start(), m.end(), kind))
    return out


HINT = re.compile(r"[0-9@]")


def find(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans of a text, each sorted by start, then kind; code points, end exclusive."""
    if not text or not HINT.search(text):
        return [], []
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + further_spans(text, base), key=order)


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union becomes
    one mark with the kind of the first."""
    spans = find(text)[1]
    if not spans:
        return text
    parts, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            parts += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*parts, text[end:]])


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _report(batches):
    for b in slices(batches):
        rows = []
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            base, spans = find(t)
            n = [sum(k == kind for _, _, k in base) for kind in BASE_KINDS]
            rows.append((i, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, REPORT, strict=True)], schema=REPORT)


REPORT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])


def report(docs: DataFrame) -> DataFrame:
    """Spans of every row of (doc_id, text); null and empty texts have none, a null doc_id stays null."""
    ddl = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(_report, ddl)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data of ``text`` masked; all other columns and all rows stay."""
    at = docs.columns.index("text")

    def run(batches):
        for b in slices(batches):
            text = pa.array([masked(t) for t in b.column(at).to_pylist()], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(b.columns)], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
