"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton accepts exactly the substrings of its
labelled reference text. A text is cut greedily into the longest phrases that
the automaton accepts; the language that needs the fewest phrases per
character wins. Parsing starts anew every ``SEGMENT`` characters, which lets
many pieces run in step through dense transition tables.

Texts are lower-cased; every run of non-letters counts as one space. Null
texts and texts without a letter are ``und`` with score 0. Ties go to the
first language by code point. Repeated rows agree. Without any labelled text
every row is ``und``. The score is q / (p + q) for the phrase counts p of the
best and q of the second language (1 with a single language). Very long texts are parsed whole,
slice by slice; an empty table gives no rows. All other columns stay; input columns called
``lang_pred`` or ``score`` are replaced.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..shipping import mapped
from .text import slices

# Bounds of the fit: characters of reference per language, documents asked for
# per language (in hash order), characters taken from each in turn until the
# reference is full or the documents end, and letters told apart.
REFERENCE_CHARS = 20_000
REFERENCE_DOCS = 60
REFERENCE_DOC_CHARS = 2_000
ALPHABET = 126
SEGMENT = 256
SLICE = 1 << 20

_TABLES = {}


def _letters():
    """One flag per code point: is it a letter?"""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _TABLES["letters"]


def normalise(text):
    letters = _letters()
    return " ".join("".join(c if letters[ord(c)] else " " for c in text.lower()).split())


def suffix_automaton(codes):
    """Transitions (list of dicts) of the automaton of all substrings; state 0 is the root."""
    following, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        state = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = state
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                split = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = split
                    p = link[p]
                link[q] = link[state] = split
        last = state
    return following


class Model:
    """Alphabet and stacked transition tables of all languages."""

    def __init__(self, references):
        self.langs = sorted(references)
        counts = Counter()
        for text in references.values():
            counts.update(text)
        counts.pop(" ", None)
        chosen = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]]
        # 0 is the space, 1 a letter that no reference holds.
        self.code = {c: k + 2 for k, c in enumerate(sorted(chosen))}
        self.width = len(chosen) + 2
        tables, self.roots, rows = [], [], 0
        for lang in self.langs:
            following = suffix_automaton([0 if c == " " else self.code.get(c, 1) for c in references[lang]])
            table = np.zeros((len(following), self.width), np.int32)
            for state, arcs in enumerate(following):
                for c, to in arcs.items():
                    table[state, c] = (rows + to) * self.width
            tables.append(table)
            self.roots.append(rows * self.width)
            rows += len(following)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def codes(self):
        """Code per code point; 255 marks non-letters."""
        table = np.where(_letters(), 1, 255).astype(np.uint8)
        for c, k in self.code.items():
            table[ord(c)] = k
        return table

    def phrases(self, texts, table):
        """(phrase counts [language, text], letters per text)."""
        lowered = [t.lower() for t in texts]
        ends = np.cumsum([0, *map(len, lowered)])
        flat = table[np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)]
        letter = flat != 255
        letters = np.diff(np.concatenate([[0], np.cumsum(letter)])[ends])
        # One space between words, none in front of a text.
        first = np.zeros(len(flat) + 1, bool)
        first[ends] = True
        keep = letter.copy()
        keep[1:] |= letter[:-1] & ~first[1:-1]
        flat = np.where(letter, flat, 0)[keep]
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        size = np.diff(ends)
        pieces = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = ends[:-1][owner] + nth * SEGMENT
        length = np.minimum(ends[1:][owner] - start, SEGMENT)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        active = np.searchsorted(-length, -np.arange(SEGMENT), "left")
        counts = np.ones((len(self.langs), len(start)), np.int32)
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(start), 1)
        for step in range(SEGMENT):
            n = active[step]
            if not n:
                break
            c = flat[start[:n] + step].astype(np.int32)
            then = self.table[state[:, :n] + c]
            failed = then == 0
            if step:
                counts[:, :n] += failed
            # A phrase starts with this character, at the root if no reference holds it.
            again = self.table[roots + c]
            np.copyto(then, np.where(again == 0, roots, again), where=failed)
            state[:, :n] = then
        total = np.zeros((len(self.langs), len(size)), np.int64)
        for k in range(len(self.langs)):
            total[k] = np.bincount(owner, counts[k], len(size))
        return total, letters


def references(documents, id_col="doc_id", text_col="text", lang_col="lang"):
    """{language: normalised reference text} from a bounded, hash-ordered sample."""
    rows = documents.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text")
    )
    held = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not held:
        return {}
    # The share of each language's hash range that holds about REFERENCE_DOCS documents.
    limits = [(lang, min(2**63 - 1, int(min(1.0, REFERENCE_DOCS / n) * 2**64) - 2**63)) for lang, n in held.items()]
    limits = documents.sparkSession.createDataFrame(limits, "lang string, most long")
    taken = (
        rows.join(F.broadcast(limits), "lang").where(F.col("h") <= F.col("most"))
        .select("lang", "h", F.substring("text", 1, REFERENCE_CHARS).alias("text")).collect()
    )
    taken = sorted(taken, key=lambda r: (r["lang"], r["h"], r["text"]))
    out = {}
    for start in range(0, REFERENCE_CHARS, REFERENCE_DOC_CHARS):
        for r in taken:
            piece = r["text"][start : start + REFERENCE_DOC_CHARS]
            if piece and len(out.setdefault(r["lang"], "")) < REFERENCE_CHARS:
                out[r["lang"]] = f"{out[r['lang']]} {normalise(piece)}".strip()[:REFERENCE_CHARS]
    return {lang: text for lang, text in out.items() if text}


def identify(df, model, text_col="text"):
    """``df`` without its text but with ``lang_pred`` and ``score``.

    Input columns of these names are replaced.
    """
    df = df.drop("lang_pred", "score")
    names = [f.name for f in df.schema if f.name != text_col]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        model = shared.value
        table = model.codes()
        langs = np.array([*model.langs, "und"], object)
        for batch in batches:
            best, score = [], []
            for _, piece in slices(batch.column(batch.schema.get_field_index(text_col)), SLICE):
                if not model.langs:
                    best.append(np.full(len(piece), -1))
                    score.append(np.zeros(len(piece)))
                    continue
                counts, letters = model.phrases(piece.to_pylist(), table)
                pick = counts.argmin(0)
                ordered = np.sort(counts, 0)
                p, q = ordered[0].astype(float), (ordered[1] if len(ordered) > 1 else ordered[0] * 0).astype(float)
                sure = q / np.maximum(p + q, 1) if len(ordered) > 1 else np.ones(len(p))
                best.append(np.where(letters > 0, pick, -1))
                score.append(np.where(letters > 0, sure, 0.0))
            pick = np.concatenate(best) if best else np.empty(0, int)
            kept = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs[pick].tolist(), pa.string()), pa.array(np.concatenate(score) if score else np.empty(0))],
                names=[*names, "lang_pred", "score"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text_col]
    return df.transform(mapped, rows, ", ".join([*fields, "lang_pred string, score double"]))


def op_languages(documents):
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = Model(references(documents.where(remainder != 1)))
    return identify(documents.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
