"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds are email, ip, card and phone, found leftmost and without overlap for each kind; what fails its check is
dropped. The method adds kinds that patterns alone cannot tell: ``iban`` (confirmed by mod 97), ``aba`` (a bank routing number,
confirmed by its weighted sum) and ``ssn``. Each candidate starts at its kind's score, gains if its checksum
holds or a context word of the kind stands within ``NEAR`` characters, loses if a word that speaks against it does, and counts
from ``THRESHOLD`` on. Base spans always stay; their score is reported.

All patterns are anchored so that a text of any length and content takes linear time. Texts without a digit and without an
at sign are not looked at. Offsets are code points, ends exclusive. Null text is empty. One row for each row given.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirgate.llm.common import batch, documents, id_and_text, mapped, pieces, real_id
from weirgate.llm.kernels import flat

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "aba", "ssn")
NEAR = 48
THRESHOLD = 0.5
#: Score of a pattern match alone.
START = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.5, "iban": 0.2, "aba": 0.05, "ssn": 0.3}
CHECKED, SPOKEN, DENIED = 0.4, 0.35, -0.4
CONTEXT = {
    "email": ("mail", "e-mail", "email", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "mastercard", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "konto", "cuenta", "compte", "bank"),
    "aba": ("aba", "routing", "rtn"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = {"ip": ("version", "release"), "aba": ("isbn", "order", "ticket"), "ssn": ("isbn", "order", "ticket"),
           "phone": ("isbn",), "card": ("isbn",), "iban": (), "email": ()}

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ABA = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[a-z-]+")


def digits_of(text: str) -> list[int]:
    return [ord(one) - 48 for one in text if "0" <= one <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        if place % 2:
            digit = 2 * digit - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def mod97(text: str) -> bool:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(one, 36)) for one in plain[4:] + plain[:4])) % 97 == 1


def routing(digits: list[int]) -> bool:
    return any(digits) and sum(weight * digit for weight, digit in zip((3, 7, 1) * 3, digits)) % 10 == 0


def emails(text: str):
    """Leftmost matches of a local part, an at sign and a domain with a dot, in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > last and text[first - 1] in _LOCAL:
            first -= 1
        found = _DOMAIN.match(text, at + 1) if first < at else None
        if found:
            last = found.end()
            yield first, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = digits_of(match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(digits_of(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


def _score(kind: str, confirmed: bool, text: str, first: int, last: int) -> float:
    near = set(_WORD.findall(text[max(first - NEAR, 0):first].lower()))
    near |= set(_WORD.findall(text[last:last + NEAR].lower()))
    score = START[kind] + CHECKED * confirmed
    score += SPOKEN * any(word in near for word in CONTEXT[kind])
    score += DENIED * any(word in near for word in AGAINST[kind])
    return round(min(max(score, 0.0), 1.0), 2)


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """All spans with their scores, by start, then by kind."""
    found = [(kind, a, b, _score(kind, kind in ("ip", "card"), text, a, b)) for kind, a, b in base_spans(text)]
    for kind, pattern, check in (("iban", _IBAN, mod97), ("aba", _ABA, lambda one: routing(digits_of(one))),
                                 ("ssn", _SSN, None)):
        for match in pattern.finditer(text):
            if check is not None and not check(match[0]):
                continue
            score = _score(kind, check is not None, text, *match.span())
            if score >= THRESHOLD:
                found.append((kind, *match.span(), score))
    return sorted(found, key=lambda one: (one[1], KINDS.index(one[0]), one[2]))


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in square brackets; of spans that overlap, the first and longest."""
    out, last = [], 0
    for kind, first, end, _ in sorted(spans, key=lambda one: (one[1], -one[2])):
        if first >= last:
            out += [text[last:first], f"[{kind}]"]
            last = end
        else:
            last = max(last, end)
    return "".join([*out, text[last:]])


def _candidates(texts: pa.Array) -> np.ndarray:
    """Texts with a digit or an at sign."""
    data, offsets = flat(texts)
    marks = ((data >= 48) & (data <= 57)) | (data == 64)
    return np.diff(np.concatenate(([0], np.cumsum(marks)))[offsets]) > 0


_ALL = ("d long, kinds array<string>, starts array<int>, ends array<int>, scores array<double>, redacted string")


def find_personal_data(docs: DataFrame, with_text: bool = True, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """``doc_id, kinds, starts, ends, scores`` (parallel lists, by start) and ``redacted`` (null unless ``with_text``)."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        column = rows.column("text")
        look = _candidates(column)
        found, texts = [], []
        for k, is_candidate in enumerate(look.tolist()):
            text = column[k].as_py() if is_candidate or with_text else None
            spans = spans_of(text) if is_candidate else []
            found.append(spans)
            texts.append(redacted(text, spans) if with_text else None)
        return batch(d=rows.column("d"), kinds=pa.array([[s[0] for s in one] for one in found], pa.list_(pa.string())),
                     starts=pa.array([[s[1] for s in one] for one in found], pa.list_(pa.int32())),
                     ends=pa.array([[s[2] for s in one] for one in found], pa.list_(pa.int32())),
                     scores=pa.array([[s[3] for s in one] for one in found], pa.list_(pa.float64())),
                     redacted=pa.array(texts, pa.string()))

    done = mapped(id_and_text(docs, id_column, text_column), work, _ALL)
    return done.select(real_id().alias("doc_id"), "kinds", "starts", "ends", "scores", "redacted")


def redact_column(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in the texts replaced; all columns stay, null texts stay null."""
    index = docs.columns.index(text_column)

    def run(batches):
        for rows in pieces(batches, index):
            column = rows.column(index)
            look = _candidates(column)
            if look.any():
                texts = column.to_pylist()
                for k in np.flatnonzero(look).tolist():
                    texts[k] = redacted(texts[k], spans_of(texts[k]))
                rows = rows.set_column(index, rows.schema.field(index), pa.array(texts, column.type))
            yield rows

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The counts of the base kinds, the hash of their spans, and all spans as text."""
    marks = F.zip_with(F.col("kinds"), F.zip_with("starts", "ends", lambda a, b: F.concat_ws(":", a, b)),
                       lambda kind, place: F.concat_ws(":", kind, place))
    base = F.filter(marks, lambda one: F.substring_index(one, ":", 1).isin(*BASE_KINDS))
    counts = [(F.size("kinds") - F.size(F.array_remove("kinds", kind))).cast("long").alias(f"n_{kind}")
              for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
                        F.concat_ws(",", marks).alias("spans"))


def op9_pii(spark, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(documents(spark, sf_dir), with_text=False))
