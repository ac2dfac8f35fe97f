"""Operators with one right answer, against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from meterflow.durable import durable
from meterflow.llm import components as link_components
from meterflow.llm import jaccard_join, line_rules, mixing, native, pii, substring_dedup

from .samples import awkward, frame, space_words, text

CLASHES = {"key": "k", "cls": 1, "n": 2, "h": 3, "label": "x", "size": 4, "target": 0.5, "pii_spans": "old", "score": 1.0}


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def families(rows):
    """Component per row by comparing all pairs."""
    sets = []
    for _, t, _, _ in rows:
        w = space_words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    members = {}
    for k in range(len(rows)):
        members.setdefault(top(k), []).append(rows[k][0])
    out = []
    for k in range(len(rows)):
        ids = [i for i in members[top(k)] if i is not None]
        out.append((rows[k][0], len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr)


def copies(seed, groups=6, size=12):
    """Groups of texts with a few changed words, around the similarity limit."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = text(rng, rng.randint(4, 120)).split()
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(["new", "Other", "words"])
            rows.append((len(rows), " ".join(w), "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [awkward(), copies(1), copies(2, 3, 40)], ids=["awkward", "copies", "family"])
def test_jaccard_components(spark, rows):
    got = found(jaccard_join.jaccard_components(frame(spark, rows, **CLASHES)))
    assert got == families(rows)


def test_jaccard_large_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEADS", 0)
    rows = copies(3, 2, 60)
    assert found(jaccard_join.jaccard_components(frame(spark, rows))) == families(rows)


def test_jaccard_large_groups_are_settled_whole(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LARGE", 2)
    monkeypatch.setattr(jaccard_join, "LEADS", 0)
    rows = copies(4, 2, 50) + [(1000 + k, t, s, u) for k, t, s, u in copies(5, 3, 20)]
    assert found(jaccard_join.jaccard_components(frame(spark, rows))) == families(rows)


def test_links_of_any_shape_settle_in_few_rounds(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(link_components, "durable", lambda df: stored.append(1) or durable(df))
    chain = [(k, k + 1) for k in range(300)]
    star = [(1_000 + k, 500) for k in range(200)]
    rng = random.Random(4)
    loose = [(rng.randrange(2_000, 2_400), rng.randrange(2_000, 2_400)) for _ in range(250)]
    links = chain + star + loose + [(7, 7), (-5, 3_000), (3_000, -5)]
    rows = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = [tuple(r) for r in link_components.components(rows).collect()]
    least = {}
    for a, b in links:
        x, y = ({c, *[k for k, v in least.items() if v == least.get(c, c)]} for c in (a, b))
        least.update(dict.fromkeys(x | y, min(least.get(c, c) for c in (a, b))))
    assert sorted(got) == sorted((k, v) for k, v in least.items() if k != v)
    assert len(stored) <= 10


def test_jaccard_blocks_of_a_group():
    import numpy as np
    import pyarrow as pa

    from meterflow.llm import blobs

    n = jaccard_join.BLOCK + 10
    record = blobs.pack([np.full(n, 5, np.uint64), np.arange(n), np.zeros(n, np.uint8)])
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([record], pa.binary())], names=["bucket", "data"])
    out = list(jaccard_join._groups([batch]))
    lists = [np.frombuffer(v.as_buffer(), np.int64) for b in out for v in b.column(2)]
    assert max(map(len, lists)) <= jaccard_join.BLOCK
    assert len(lists) == 3
    assert len(np.unique(np.concatenate(lists))) == n


def variants(seed, size, words, least, most):
    """Sets of 64-bit shingles: parts of one base, each with own shingles and some that a few share."""
    import numpy as np

    rng = np.random.default_rng(seed)
    base, rare = (rng.integers(0, 2**62, k).astype(np.uint64) for k in (words, 40 * size))
    out = []
    for _ in range(size):
        own = base[rng.random(words) > rng.uniform(least, most)]
        out.append(np.unique(np.concatenate([own, rng.choice(rare, words // 30), rng.integers(0, 2**62, words // 30).astype(np.uint64)])))
    return out


@pytest.mark.parametrize("bits", [64, 4096])
def test_jaccard_large_groups_compare_few_pairs_in_full(monkeypatch, bits):
    import numpy as np

    monkeypatch.setattr(jaccard_join, "BITS", bits)
    sets = variants(2, 200, 400, 0.05, 0.5)
    compared, enough = [], jaccard_join._enough
    monkeypatch.setattr(jaccard_join, "_enough", lambda x, y: compared.append(1) or enough(x, y))
    a, b = jaccard_join.spanning_links(np.arange(len(sets)), sets, np.arange(len(sets)))
    labels = list(range(len(sets)))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        assert enough(sets[i], sets[j]) and labels[i] != labels[j]
        labels = [labels[i] if x == labels[j] else x for x in labels]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if enough(sets[i], sets[j])]
    assert pairs and all(labels[i] == labels[j] for i, j in pairs)
    assert 1 < len(set(labels)) < len(sets)
    # A pair that does not link is hardly ever looked at shingle by shingle.
    assert bits < 4096 or len(compared) < 2 * len(sets)


def grouped(spark, lists):
    import numpy as np

    rows = [(g, bytearray(np.array(sorted(m), np.int64).tobytes())) for g, m in enumerate(lists)]
    signs = spark.createDataFrame([(c, 10) for c in sorted(set().union(*lists))], "cls long, n long")
    out = {}
    for r in jaccard_join.searched(spark.createDataFrame(rows, "gid long, members binary"), signs).collect():
        out.setdefault((r["gid"], r["pieces"]), []).append(r["cls"])
    return sorted(((sorted(m), pieces) for (_, pieces), m in out.items()), key=repr)


def test_jaccard_groups_of_a_family_are_searched_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LARGE", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 50)
    rng = random.Random(6)
    family = [rng.randrange(2**40) for _ in range(60)]
    lists = [set(rng.sample(family, 50)) for _ in range(40)] + [set(family[:5]), {1, 2}]
    got = grouped(spark, lists)
    for m in lists[:-1]:
        assert any(m <= set(x) for x, _ in got)
    assert sum(len(x) for x, _ in got) < 600  # 2,005 members before
    assert (sorted(family[:5]), None) in got and all(len(x) > 2 for x, _ in got)
    assert all(pieces == (1 if len(x) <= 50 else 3) for x, pieces in got if len(x) > 8)


def test_jaccard_groups_with_little_in_common_stay_apart(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(jaccard_join, "LARGE", 8)
    first = int(np.argmin(jaccard_join.mix(np.arange(1000, dtype=np.uint64))))
    others = [c for c in range(1000) if c != first]
    lists = [{first, *others[k : k + 20]} for k in (0, 100, 200)]
    # As one they would make 1,830 pairs instead of 630.
    assert grouped(spark, lists) == sorted([(sorted(m), 1) for m in lists], key=repr)


def test_jaccard_cut_groups_lose_no_pair(spark):
    rows = spark.createDataFrame([(1, c, 4) for c in range(40)] + [(2, c, 1) for c in range(5)] + [(3, 7, None), (3, 8, None)], "gid long, cls long, pieces int")
    for in_pairs in (False, True):
        groups = {}
        for r in jaccard_join.cut(rows, in_pairs).collect():
            groups.setdefault((r["gid"], r["pieces"]), set()).add(r["cls"])
        large = [m for (_, pieces), m in groups.items() if pieces == 4]
        assert groups[2, 1] == set(range(5)) and groups[3, None] == {7, 8}
        assert set().union(*large) == set(range(40)) and max(map(len, large)) < 40
        assert len(large) == (6 if in_pairs else 4)
        if in_pairs:
            assert all(any({a, b} <= m for m in large) for a in range(40) for b in range(a))


def test_jaccard_large_groups_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LARGE", 8)
    monkeypatch.setattr(jaccard_join, "LEADS", 0)
    monkeypatch.setattr(jaccard_join, "PIECE_SHINGLES", 1500)
    rows = copies(7, 2, 60) + [(1000 + k, t, s, u) for k, t, s, u in copies(8, 3, 40)]
    assert found(jaccard_join.jaccard_components(frame(spark, rows))) == families(rows)


def test_signature_tree_loses_no_pair():
    import numpy as np

    rng = np.random.default_rng(4)
    sets = []
    for size in (5, 40, 90, 300, 700):
        base = rng.integers(0, 2**62, size).astype(np.uint64)
        for _ in range(25):
            own = base[rng.random(size) > 0.08]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 2**62, size // 12).astype(np.uint64)])))
    n = np.array([len(s) for s in sets])
    bits = [jaccard_join._bitmap(s).view(np.uint64) for s in sets]
    a, b = jaccard_join.tree_pairs(np.arange(len(sets)), n, bits, np.arange(len(sets)))
    got = set(zip(a.tolist(), b.tolist(), strict=True))
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 75 * (n[i] + n[j] - shared):
                assert (j, i) in got
    assert len(got) < len(sets) ** 2 / 4


def test_keep_one(spark):
    rows = awkward()
    kept = frame(spark, rows, **CLASHES)
    out = jaccard_join.keep_one(kept)
    assert out.columns == kept.columns
    ids = sorted([r["doc_id"] for r in out.collect()], key=repr)
    # 0 stands for its copies 1, 2 and 10, 6 for 7, 8 for 9; rows without words stay.
    assert ids == sorted([0, 3, 4, 5, 6, 8, None, None, 11, 11, 12, 13, 14], key=repr)


def repeats(rows):
    first, listed = {}, []
    order = sorted({(i is not None, i or 0) for i, *_ in rows})
    rank = {o: k for k, o in enumerate(order)}
    for i, t, *_ in rows:
        w = space_words(t)
        own = rank[(i is not None, i or 0)]
        listed.append((i, own, w))
        for p in range(len(w) - 19):
            key = tuple(w[p : p + 20])
            first[key] = min(first.get(key, (own, p)), (own, p))
    out = []
    for i, own, w in listed:
        gone = set()
        for p in range(len(w) - 19):
            if first[tuple(w[p : p + 20])] < (own, p):
                gone.update(range(p, p + 20))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passages(seed):
    rng = random.Random(seed)
    shared = [text(rng, n).split() for n in (19, 20, 21, 25, 33, 60)]
    rows = []
    for k in range(40):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += text(rng, rng.randint(0, 30)).split() + (rng.choice(shared) if rng.random() < 0.6 else [])
        rows.append((k, rng.choice([" ", "\n", "  "]).join(w), "en", "a"))
    return rows


@pytest.mark.parametrize("rows", [awkward(), passages(1), passages(2)], ids=["awkward", "passages", "more"])
def test_repeated_passages(spark, rows):
    assert found(substring_dedup.remove_repeats(frame(spark, rows, **CLASHES))) == repeats(rows)


def test_repeats_with_text(spark):
    rows = passages(3)
    got = substring_dedup.remove_repeats(frame(spark, rows).repartition(8), with_text=True)
    assert found(got.drop("kept_text")) == repeats(rows)
    for r in got.where("n_removed > 0").collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_cover_has_every_difference():
    c, p = substring_dedup.COVER, substring_dedup.PERIOD
    assert {(a - b) % p for a in c for b in c} == set(range(p))


def test_flush_keeps_every_anchor():
    import numpy as np

    h = np.array([5, 5, 7, 5, 9], np.uint64)
    key, own, at = np.array([1, 2, 1, 1, 3]), np.array([1, 2, 1, 1, 3]), np.array([0, 0, 3, 9, 1], np.int32)
    out = list(substring_dedup._flush([(h, key, own, at)], 1, False))
    assert {k for b in out for k in b.column(1).to_pylist()} == {True, False}


PII_TEXTS = [
    "mail a.b+c@x-y.co.uk, or @no a@b c@d.e@f.g x@y..z q@w.e-1.org.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 1..2.3.4 10.20.30 0001.2.3.255",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 123456789012345678901234567890", "+1 (206) 555-0100 +123 +44 20 7946 0958. ++49 30 1",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 or DE00 3704 0044 0532 0130 00", "call 555 123 4567 now; total 555 123 4567",
    "é 中 x@y.zz é", "", None,
]


def base_spans(value):
    """The base rules by plain leftmost scans."""
    out, value = [], value or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", value):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", value):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", value):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", value):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def random_pii(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab0123456789..@@+-- ()") for _ in range(rng.randint(0, 60))) for _ in range(300)]


def test_pii_base(spark):
    texts = PII_TEXTS + random_pii(1) + ["4" * 40, "0." * 50, "a" * 5000 + " @ b@c.d"]
    rows = [(k, t, None, None) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in pii.digest(pii.find_pii(frame(spark, rows, **CLASHES))).collect()}
    for k, t in enumerate(texts):
        want = base_spans(t)
        joined = ",".join(":".join(map(str, s)) for s in want)
        assert got[k]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (t, want, got[k]["spans"])
        assert got[k]["spans"].startswith(joined)
        assert [got[k][f"n_{kind}"] for kind in pii.KINDS] == [sum(s[0] == kind for s in want) for kind in pii.KINDS]


def test_pii_context_and_checksums():
    kinds = {t: [s[0] for s in pii.spans(t)] for t in PII_TEXTS if t}
    assert kinds[PII_TEXTS[4]].count("iban") == 2
    assert kinds[PII_TEXTS[5]] == ["number", "number"] or kinds[PII_TEXTS[5]] == ["number"]
    assert pii.spans("total 555 123 4567 items") == []
    assert pii.redact("x a@b.cc y", pii.spans("x a@b.cc y")) == "x [EMAIL] y"


def test_pii_context_moves_every_kind():
    def score(text, kind):
        return {s[0]: s[3] for s in pii.spans(text)}[kind]

    card = "4111 1111 1111 1111"
    for kind, value, good, bad in (
        ("email", "a@b.cc", "contact", "example"), ("ip", "10.0.0.1", "server", "version"), ("card", card, "visa", "invoice"), ("phone", "+1 555 123 4567", "call", "total"),
    ):
        plain = score(f"so {value} it is", kind)
        assert score(f"{good} {value}", kind) > plain > score(f"{bad} {value}", kind) >= 0
        assert score(f"{good} {'x' * 60} {value}", kind) == plain


def test_repeats_with_text_ids(spark):
    rows = [(i, t) for i, t, *_ in awkward() if i is not None]
    df = spark.createDataFrame([(f"doc-{i:03d}", t) for i, t in rows] + [(None, rows[0][1])], "doc_id string, text string")
    numbered = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    want = sorted((f"doc-{r['doc_id']:03d}" if r["doc_id"] is not None else "", *r[1:]) for r in substring_dedup.op_repeats(numbered).collect())
    got = sorted((r["doc_id"] or "", *r[1:]) for r in substring_dedup.op_repeats(df).collect())
    assert got == want


def test_pii_keeps_columns_and_rows(spark):
    df = frame(spark, awkward(), **CLASHES)
    out = pii.redact_pii(df)
    assert set(out.columns) == set(df.columns) and out.count() == df.count()
    assert found(out.select("doc_id", "text")) == found(df.select("doc_id", "text"))


def line_stats(value):
    w = space_words(value)
    value = value or ""
    seen, dup = set(), 0
    for line in value.split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    where = {}
    for p in range(len(w) - 7):
        where.setdefault(tuple(w[p : p + 8]), []).append(p)
    cover = {k for at in where.values() if len(at) > 1 for p in at for k in range(p, p + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in value), dup, len(cover)


def test_line_rules_statistics(spark):
    rows = awkward() + [(20, "a b c d e f g h " * 3 + "z", "en", "a"), (21, "# x\n# x\n\n\n |<> y", "en", "a")]
    got = found(line_rules.judge(frame(spark, rows, **CLASHES)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == sorted([(i, *line_stats(t)) for i, t, *_ in rows], key=repr)


def test_line_rules_verdicts(spark):
    rng = random.Random(5)
    notice = "all rights belong to those who wrote this page and to nobody else at all"
    rows = [(k, f"{notice}\n{text(rng, 10)}\n  ALL  Rights" + notice[10:], "en", "h") for k in range(30)]
    rows += [(100 + k, text(rng, 40), "en", "h") for k in range(20)] + [(200, f"{notice}\n{text(rng, 60)}", "en", "h"), (201, f"{notice}\n{text(rng, 9)}", "en", None)]
    df = frame(spark, rows)
    got = {r["doc_id"]: r for r in line_rules.judge(df).collect()}
    assert not any(got[k]["kept"] for k in range(30)) and all(got[k]["words_left"] == 10 for k in range(30))
    assert all(got[100 + k]["kept"] for k in range(20))
    assert got[200]["kept"] and got[200]["lines_removed"] == 1
    assert got[201]["kept"] and got[201]["lines_removed"] == 0
    cut = {r["doc_id"]: r["text"] for r in line_rules.remove_lines(df, line_rules.frequent_lines(df)).collect()}
    assert len(space_words(cut[0])) == 10 and cut[201] == rows[-1][1]


def test_native_words(spark):
    values = [None, "", " \n", "a", " a\tb\x0bc\x0c\rd\n", "a\x1cb", "é  ü"]
    df = spark.createDataFrame([(v,) for v in values], "text string").select("text", native.words(F.col("text")).alias("w"))
    for r in df.collect():
        assert r["w"] == space_words(r["text"])


def targets_of(sizes):
    """{source: target} by giving out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in full}
        left = total - sum(full.values())
        now = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s, t in now.items() if t >= 3 * sizes[s]]
        if not over:
            return {**full, **now}
        full.update({s: 3 * sizes[s] for s in over})
        if len(full) == len(sizes):
            return full


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = awkward(seed) + [(100 + k, text(rng, rng.randint(1, 200)), None, rng.choice("aaaaabcdefgh")) for k in range(400)]
    df = frame(spark, rows, **CLASHES)
    got = mixing.mix(df).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len(space_words(t))) for i, t, *_ in rows if i is not None
    )
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(space_words(t))
    want = targets_of(sizes)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(6, 0.03 * t), (s, taken[s], t)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([("aa", 1000), ("ab", 1000), ("ac", 8000)], "__s string, size long")
    planned = mixing.plan_blocks(mixing.source_targets(sizes), least_slots=1000, source_slots=10)
    n = planned.agg(F.max("slots")).first()[0]
    rows = mixing.schedule(planned, n).orderBy("slot").collect()
    share = {r["__s"]: (r["hi"] - r["lo"]) / 2**32 for r in planned.collect()}
    seen = dict.fromkeys(share, 0)
    for k, r in enumerate(rows, 1):
        assert r["rank"] == seen[r["__s"]]
        seen[r["__s"]] += 1
        assert all(abs(seen[s] - share[s] * (r["slot"] + 1)) < 4 + (r["slot"] + 1 - k) for s in share)


def test_empty_tables(spark):
    empty = frame(spark, [], **CLASHES)
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert line_rules.judge(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert pii.find_pii(empty).count() == 0
