"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds email, ip, card and phone are always reported when pattern and check
hold. IBANs (mod-97) are a further kind that the checksum alone confirms.
Every span has a score from 0 to 1: words nearby that speak for its kind lift it, others
("version" before an address, "order" before a card) lower it. Digit runs near words such
as "phone" or "call" are proposed as ``number`` and reported only when the
context lifts their score over the threshold.

Null and empty texts have no spans, an empty table gives no rows. A row keeps all its other
columns, whatever their names; repeated rows and ids are each handled alone. Where base kinds overlap all
are reported; an iban or number never overlaps another span, the earlier one stays. All scans are
linear in the text, so very long texts and long runs of digits or letters cost no more per character.
"""


import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..shipping import mapped

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("iban", "number")
CONTEXT_CHARS = 40
THRESHOLD = 0.6
# Words nearby that speak for a kind, and words that speak against it.
_FOR = {
    "email": re.compile(r"(?i)\b(e-?mail|mail|contact|write|reach)\b"),
    "ip": re.compile(r"(?i)\b(ip|address|host|server|login)\b"),
    "card": re.compile(r"(?i)\b(card|visa|credit|debit|payment|cvv)\b"),
    "phone": re.compile(r"(?i)\b(phone|tel|telephone|call|mobile|fax)\b"),
    "number": re.compile(r"(?i)\b(phone|tel|telephone|call|mobile|fax|ssn|passport|account)\b"),
    "iban": re.compile(r"(?i)\b(iban|account|bank|transfer)\b"),
}
_AGAINST = {
    "email": re.compile(r"(?i)\b(example|sample|placeholder)\b"),
    "ip": re.compile(r"(?i)\b(version|release|section|chapter)\b"),
    "card": re.compile(r"(?i)\b(order|invoice|tracking|isbn|serial)\b"),
    "phone": re.compile(r"(?i)\b(total|sum|score|coordinates)\b"),
}
_LIFT = 0.4
_BASE_SCORE = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.9, "number": 0.3}
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?<![0-9+])[0-9](?:[\x20.()-]?[0-9]){6,14}(?![0-9])")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += _DOUBLED[d] if k % 2 else d
    return total % 10 == 0


def mod97(code):
    """Whether an account code passes the mod-97 check."""
    code = code.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text):
    """Anchored at each @, which equals a leftmost scan but stays linear."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL_CHARS:
            first -= 1
        if first < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((first, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            done = max(done, at)
            at = text.find("@", at + 1)
    return found


def ips(text):
    found = []
    for m in _DOTTED.finditer(text):
        parts = list(re.finditer("[0-9]+", m[0]))
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in four):
                found.append((m.start() + four[0].start(), m.start() + four[3].end()))
    return found


def cards(text):
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text):
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]


def _iban_end(text, start, end):
    """End of the longest confirmed code that starts here and stops at a space; ``start`` if none."""
    while end > start:
        if mod97(text[start:end]):
            return end
        end = text.rfind(" ", start, end)
    return start


def _score(kind, text, start, end):
    """The kind's score, lifted and lowered by words nearby, from 0 to 1."""
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    score = _BASE_SCORE[kind] + (_LIFT if _FOR[kind].search(around) else 0.0)
    if kind in _AGAINST and _AGAINST[kind].search(around):
        score -= _LIFT
    return min(1.0, max(0.0, round(score, 9)))


def spans(text):
    """All (kind, start, end, score), kinds in order, then by start."""
    out = []
    has_digit = any(d in text for d in "0123456789")
    if "@" in text:
        out += [("email", s, e, _score("email", text, s, e)) for s, e in emails(text)]
    if not has_digit:
        return out
    if "." in text:
        out += [("ip", s, e, _score("ip", text, s, e)) for s, e in ips(text)]
    out += [("card", s, e, _score("card", text, s, e)) for s, e in cards(text)]
    if "+" in text:
        out += [("phone", s, e, _score("phone", text, s, e)) for s, e in phones(text)]
    taken = bytearray(len(text))
    for _, s, e, _ in out:
        taken[s:e] = b"\1" * (e - s)
    for kind, pattern in (("iban", _IBAN), ("number", _NUMBER)):
        for m in pattern.finditer(text):
            s, e = m.span()
            if kind == "iban":
                e = _iban_end(text, s, e)
            if e <= s or 1 in taken[s:e]:
                continue
            score = _score(kind, text, s, e)
            if score >= THRESHOLD:
                out.append((kind, s, e, score))
                taken[s:e] = b"\1" * (e - s)
    return out


def redact(text, found):
    """The text with each span replaced by its kind in brackets; overlapping spans merge."""
    parts, done = [], 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e, _ in found):
        if s >= done:
            parts += [text[done:s], f"[{kind.upper()}]"]
        done = max(done, e)
    return "".join(parts) + text[done:]


_SPAN = "struct<kind:string,start:long,end:long,score:double>"


def _rows(batches, text_col, with_text):
    kind_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col))
        # Only texts with a digit or an @ can hold anything; the rest skip the scan.
        maybe = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False).to_numpy(zero_copy_only=False)
        found = [[] for _ in range(len(column))]
        clean = {}
        for k in np.flatnonzero(maybe):
            text = column[int(k)].as_py()
            found[k] = spans(text)
            if with_text and found[k]:
                clean[int(k)] = redact(text, found[k])
        arrays = list(batch.columns)
        names = list(batch.schema.names)
        if with_text:
            where = names.index(text_col)
            if clean:
                mask = np.zeros(len(column), bool)
                mask[list(clean)] = True
                replacement = pa.array([clean[k] for k in sorted(clean)], column.type)
                arrays[where] = pc.replace_with_mask(column, pa.array(mask), replacement)
        else:
            keep = [k for k, name in enumerate(names) if name != text_col]
            arrays, names = [arrays[k] for k in keep], [names[k] for k in keep]
        listed = pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in row] for row in found], pa.list_(kind_type))
        yield pa.RecordBatch.from_arrays([*arrays, listed], names=[*names, "pii_spans"])


def find_pii(df, text_col="text"):
    """``df`` without its text but with ``pii_spans``, an array of (kind, start, end, score).

    Positions count code points, end exclusive. An input column named
    ``pii_spans`` is replaced.
    """
    df = df.drop("pii_spans")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text_col]
    schema = ", ".join([*fields, f"pii_spans array<{_SPAN}>"])
    return df.transform(mapped, lambda it: _rows(it, text_col, False), schema)


def redact_pii(df, text_col="text"):
    """``df`` with its spans replaced in the text, and ``pii_spans`` (positions in the old text)."""
    df = df.drop("pii_spans")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*fields, f"pii_spans array<{_SPAN}>"])
    return df.transform(mapped, lambda it: _rows(it, text_col, True), schema)


def digest(found, id_col="doc_id"):
    """Counts per base kind, hash of the base spans, and all spans as one string."""
    spans_col = F.col("pii_spans")
    base = F.filter(spans_col, lambda s: s["kind"].isin(*KINDS))

    def joined(column):
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter(spans_col, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        id_col, *[count(kind) for kind in KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(spans_col).alias("spans")
    )


def op_digest(documents):
    return digest(find_pii(documents.select("doc_id", "text")))
