"""Learned operators and benchmark leaks: held-out accuracy and brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from meterflow.llm import decontaminate, langid, lm_score, quality, toxicity
from meterflow.llm.registry import QUERIES, read
from meterflow.llm import queries  # noqa: F401

from .samples import awkward, frame, space_words, text, words

SF = "/root/testdata/sf0.01"
CLASHES = {"label": "x", "n": 2, "h": 3, "stats": 4, "lang_pred": "old", "score": 9.0, "n_words": 1}


def held_out(spark, name, column):
    rows = QUERIES[name](spark, SF).join(read(spark, SF, "labels"), "doc_id").where("held_out").collect()
    return rows, np.mean([r["predicted"] == r[column] for r in rows])


def test_quality_held_out(spark):
    rows, accuracy = held_out(spark, "op5_quality", "quality")
    assert accuracy > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_held_out(spark):
    rows, accuracy = held_out(spark, "op1_toxicity", "toxic")
    assert accuracy > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_held_out(spark):
    got = QUERIES["op3_langid"](spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.98


@pytest.mark.parametrize("name", ["op1_toxicity", "op3_langid", "op5_quality", "op10_lm_score"])
def test_every_row_is_scored(spark, name):
    assert QUERIES[name](spark, SF).count() == read(spark, SF, "documents").count()


def naive_phrases(value, reference):
    """Greedy longest phrases found by substring search, anew every SEGMENT characters."""
    count = 0
    for a in range(0, len(value), langid.SEGMENT):
        part, at = value[a : a + langid.SEGMENT], 0
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at : at + size + 1] in reference and part[at : at + size] in reference:
                size += 1
            count += 1
            at += size
    return count


def test_cross_parsing_equals_substring_search():
    rng = random.Random(3)
    references = {"a": text(rng, 300), "b": text(random.Random(9), 200, 2)}
    model = langid.Model(references)
    texts = [text(rng, n) for n in (1, 5, 80, 400)] + ["", "QX? 12", "kalo-Ka  TEN"]
    counts, letters = model.phrases(texts, model.codes())
    for d, t in enumerate(texts):
        plain = langid.normalise(t)
        assert letters[d] == sum(c.isalpha() for c in t)
        if plain == plain.strip() and not t[-1:].isdigit():
            for k, lang in enumerate(model.langs):
                # A final space of the text is a character of its own here.
                assert abs(counts[k, d] - naive_phrases(plain, references[lang])) <= (t != t.rstrip()) + 0


def test_automaton_accepts_all_and_only_substrings():
    rng = random.Random(1)
    word = [rng.randrange(3) for _ in range(60)]
    arcs = langid.suffix_automaton(word)

    def accepted(part):
        state = 0
        for c in part:
            if c not in arcs[state]:
                return False
            state = arcs[state][c]
        return True

    held = {tuple(word[a:b]) for a in range(60) for b in range(a + 1, 61)}
    assert all(accepted(p) for p in held)
    for _ in range(300):
        part = tuple(rng.randrange(3) for _ in range(rng.randint(1, 7)))
        assert accepted(part) == (part in held)


def test_few_long_documents_fill_the_reference(spark):
    rng = random.Random(3)
    rows = [(k, text(rng, 4000), "rare", "a") for k in range(3)] + [(9, "kalo " + "mi " * 700, "short", "a")]
    held = langid.references(frame(spark, rows))
    assert len(held["rare"]) == langid.REFERENCE_CHARS
    assert held["short"] == langid.normalise(rows[-1][1])


def test_language_edge_cases(spark):
    df = frame(spark, awkward(), **CLASHES)
    model = langid.Model(langid.references(df))
    got = langid.identify(df, model).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(awkward())
    assert all(by_id[k]["lang_pred"] == "und" and by_id[k]["score"] == 0 for k in (3, 4, 5))
    nothing = langid.identify(df, langid.Model({})).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert langid.identify(df.where("false"), model).count() == 0


def naive_kernel(s, t):
    """Sum over common subsequences of four and three letters with their gaps."""
    def features(u):
        out = {}
        for order, span, scale in ((4, toxicity.SPAN, 1.0), (3, toxicity.SHORT_SPAN, toxicity.SHORT_WEIGHT)):
            for places in itertools.combinations(range(len(u)), order):
                wide = places[-1] - places[0] + 1
                if wide <= span:
                    out.setdefault(tuple(u[p] for p in places), []).append(scale * toxicity.DECAY ** (wide - order))
        return out

    def norm(f):
        return np.sqrt(sum(w * w for v in f.values() for w in v)) or 1.0

    a, b = features(s), features(t)
    return sum(sum(v) * sum(b.get(key, [])) for key, v in a.items()) / norm(a) / norm(b)


def test_kernel_equals_enumeration():
    units = ["idiot", "idxiot", "idot", "banana", "abcabcabcabc", "heisanidiotindeed"]
    got = toxicity.kernel(toxicity.rows_of(units), toxicity.rows_of(units))
    for a, s in enumerate(units):
        for b, t in enumerate(units):
            assert abs(got[a, b] - naive_kernel(s, t)) < 1e-5
    assert got[0, 1] > 0.4 > got[0, 3]


def test_letters_run_across_signs():
    texts = ["I d-i.o,t! Zoë", "", "id\n\nIOT", "中a", "..."]
    found = toxicity.Letters(texts)
    spelled = ["".join(chr(96 + c) if 0 < c < 27 else "|" if c == 0 else "#" for c in found.codes[a:b]) for a, b in zip(found.start, found.end)]
    assert spelled[0] == "idiot|zoe" and spelled[1] == "" and spelled[2] == "id||iot" and spelled[4] in ("", "|")
    assert len(spelled[3]) == 4 and spelled[3][-1] == "a" and spelled[3][0] == "#"


def test_text_scores_equal_the_loop():
    """A text's block margins against a plain loop over all subsequences."""
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(size=toxicity.TABLE).astype(np.float32), 0.25, 0.5)
    texts = ["abcdefghij klmno pqrst", "xy", "hello. there\nworld and much more of this text to see", "q" * 90]
    letters = toxicity.Letters(texts)
    best, first, blocks = model.margins(letters)
    for d in range(len(texts)):
        codes = letters.codes[letters.start[d] : letters.end[d]].tolist()
        place = []
        for p in range(len(codes)):
            total = 0.0
            for back, weight in toxicity.patterns():
                if back[0] <= p:
                    key = 0
                    for b in (*back, 0):
                        key = key << toxicity.BITS | codes[p - b]
                    total += weight * float(model.weights[key + (0 if len(back) == 3 else toxicity.CODES**4)])
                else:  # letters before the text are breaks
                    key = 0
                    for b in (*back, 0):
                        key = key << toxicity.BITS | (codes[p - b] if p >= b else 0)
                    total += weight * float(model.weights[key + (0 if len(back) == 3 else toxicity.CODES**4)])
            place.append(total)
        want = []
        for a in range(0, len(codes), toxicity.STRETCH):
            ends = range(a, min(a + toxicity.STRETCH, len(codes)))
            want.append(max(sum(place[max(0, e - toxicity.STRETCH + 1) : e + 1]) / toxicity._norms()[min(e + 1, toxicity.STRETCH)] + 0.25 for e in ends))
        assert np.allclose(best[first[d] : first[d] + blocks[d]], want, atol=1e-4)


def insulted(seed, n, insult, decoys=()):
    """Rows and labels; toxic ones hold ``insult(rng)``, all others now and then one of the decoys."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w, bad = words(rng, rng.randint(20, 80)), int(rng.random() < 0.3)
        for d in decoys:
            if rng.random() < 0.7:
                w.insert(rng.randrange(len(w)), d)
        if bad:
            w.insert(rng.randrange(len(w)), insult(rng))
        rows.append((k, " ".join(w), "en", "a"))
        labels.append((k, bad, 1 - bad))
    return rows, labels


def inserted(rng):
    w = list(rng.choice(["blockhead", "scoundrel"]))
    w.insert(rng.randrange(2, len(w) - 1), rng.choice("xqz"))
    return "".join(w)


@pytest.mark.parametrize("insult, decoys", [
    (lambda rng: "utter garden table", ("utter", "garden", "table")),  # a phrase of harmless words
    (lambda rng: "nit wit" if rng.random() < 0.5 else "nitw it", ("nit", "wit")),  # cut in pieces
    (inserted, ()),  # a further letter somewhere
], ids=["phrase", "pieces", "inserted"])
def test_toxicity_learns_from_sentences(spark, insult, decoys):
    rows, labels = insulted(11, 900, insult, decoys)
    model = toxicity.train(frame(spark, rows[:600]), spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    scores, y = model.score([t for _, t, *_ in rows[600:]]), np.array([bad for _, bad, _ in labels[600:]])
    above = (scores[y == 1][:, None] > scores[y == 0]).mean() + 0.5 * (scores[y == 1][:, None] == scores[y == 0]).mean()
    assert above > 0.9


def test_repeated_ids_stay_within_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_DOCS", 20)
    monkeypatch.setattr(toxicity, "OTHER_DOCS", 30)
    rng = random.Random(7)
    rows = [(k % 3, text(rng, 20) if k % 5 else "same text", "en", "a") for k in range(300)]
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (2, 0), (2, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(frame(spark, rows), labels).groupBy("__y").count().collect()
    assert {r["__y"]: r["count"] for r in got} == {1: 20, 0: 30}


def toxic_rows(seed, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w, bad = words(rng, rng.randint(5, 60)), int(rng.random() < 0.4)
        for _ in range(2 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["blockhead", "nitwit", "scoundrel"]))
        rows.append((k, " ".join(w), "en", "a"))
        labels.append((k, bad, 1 - bad))
    return rows, labels


def test_toxicity_finds_disguised_words(spark):
    rows, labels = toxic_rows(1)
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    rng = random.Random(2)
    plain = text(rng, 40)
    disguised = ["blockhead", "BLOCKHEAD", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blockxhead", "nitxwit", "s-c-o-u-n-drel"]
    bad = model.score([f"{plain} {w} {plain} {w}" for w in disguised])
    good = model.score([plain, text(rng, 500), "", "...", "12 34"])
    assert bad.min() > 0.5 > good.max()


def test_toxicity_edge_cases(spark):
    rows, labels = toxic_rows(3, 150)
    df = frame(spark, rows + [(i, t, l, s) for i, t, l, s in awkward()], **CLASHES)
    labels = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(df, labels)
    got = toxicity.score(df, model)
    assert got.count() == df.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    for few in (labels.where("false"), labels.where("toxic = 1"), labels.where("toxic = 0")):
        share = toxicity.train(df, few).score(["x", ""])
        assert len(set(share)) == 1 and 0 <= share[0] <= 1
    assert toxicity.score(df.where("false"), model).count() == 0


def test_quality_edge_cases(spark):
    rng = random.Random(4)
    rows = [(k, text(rng, 50) if k % 2 else " ".join(w + "###" for w in words(rng, 50)), "en", "a") for k in range(200)] + awkward()[3:6]
    rows = [(i if k < 200 else 1000 + k, *r) for k, (i, *r) in enumerate(rows)]
    df = frame(spark, rows, **CLASHES)
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(1, None)], "doc_id long, quality int")
    stats, model = quality.train(df, labels)
    scored = {r["doc_id"]: r["score"] for r in quality.score_stats(stats, model).collect()}
    assert len(scored) == len(rows) and all(0 <= v <= 1 for v in scored.values())
    assert np.mean([(scored[k] >= 0.3) == bool(k % 2) for k in range(200)]) > 0.97
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, v in scored.items() if v >= 0.3}
    for few in (labels.where("false"), labels.where("quality = 1")):
        assert set(quality.train(df, few)[1].score(np.zeros((2, len(quality.FEATURES))))) <= {0.5, 1.0}
    empty = df.where("false")
    assert quality.keep_good(empty, model).count() == 0
    assert quality.train(empty, labels)[0].count() == 0


def test_quality_density_matches_definition():
    rng = np.random.default_rng(0)
    p = len(quality.FEATURES)
    data = {0: rng.normal(0, 2, (300, p)), 1: rng.normal(1, 1, (500, p))}
    model = quality.Model({k: (len(x), x.sum(0), x.T @ x) for k, x in data.items()}, to_pooled=0.0, to_identity=0.0)
    x = rng.normal(0.5, 1.5, (20, p))
    pooled = sum(np.cov(v.T) * (len(v) - 1) for v in data.values()) / 798
    gap = 0
    for k, sign in ((1, 1), (0, -1)):
        n = len(data[k])
        own = n / (n + p)
        cov = own * np.cov(data[k].T) + (1 - own) * pooled + 1e-6 * np.diag(np.diag(pooled))  # the ridge on scaled statistics
        z = x - data[k].mean(0)
        # The scale is shared by both classes and cancels out of the difference.
        gap = gap + sign * (np.log(n / 800) - 0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-np.clip(gap, -500, 500))), atol=1e-6)


def test_language_model_prefers_order(spark):
    rng = random.Random(6)
    phrases = [words(rng, 6) for _ in range(30)]
    rows = [(k, " ".join(w for _ in range(25) for w in rng.choice(phrases)), "en", "a") for k in range(600)]
    df = frame(spark, rows)
    known, weights = lm_score.train(df, rounds=4)
    tests = [" ".join(w for _ in range(25) for w in rng.choice(phrases)) for _ in range(30)]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in tests]
    got = lm_score.score(frame(spark, [(k, t, None, None) for k, t in enumerate(tests + mixed)]), known, weights).collect()
    by_id = {r["doc_id"]: r["per_word"] for r in got}
    assert np.mean([by_id[k] > by_id[k + 30] for k in range(30)]) > 0.9
    start = lm_score.start_weights(lm_score.vocabulary(df)[1])
    first = lm_score.score(frame(spark, [(k, t, None, None) for k, t in enumerate(tests)]), known, start).agg(F.avg("per_word")).first()[0]
    assert np.mean([by_id[k] for k in range(30)]) > first + 0.3


def test_language_model_is_a_distribution():
    rng = np.random.default_rng(2)
    weights = lm_score.start_weights(np.log(np.full(lm_score.VOCABULARY, 1 / lm_score.VOCABULARY)))
    around = np.repeat(rng.integers(0, lm_score.VOCABULARY, (1, 2 * lm_score.SIDE)), lm_score.VOCABULARY, 0)
    total = np.exp(lm_score.log_probabilities(weights, around, np.arange(lm_score.VOCABULARY))).sum()
    assert abs(total - 1) < 1e-4


def test_language_model_edge_cases(spark):
    df = frame(spark, awkward(), **CLASHES)
    known, weights = lm_score.train(df, rounds=1)
    got = {r["doc_id"]: r for r in lm_score.score(df, known, weights).collect()}
    for k in (3, 4, 5):
        assert got[k]["n_words"] == 0 and got[k]["log_likelihood"] == 0 and got[k]["per_word"] is None
    for i, t, *_ in awkward()[:3]:
        assert got[i]["n_words"] == len(space_words(t))
    empty = df.where("false")
    known, weights = lm_score.train(empty, rounds=1)
    assert lm_score.score(empty, known, weights).count() == 0


@pytest.mark.parametrize("rare", [lm_score.RARE, 1])
def test_every_word_has_its_own_probability(spark, monkeypatch, rare):
    monkeypatch.setattr(lm_score, "RARE", rare)
    rng = random.Random(8)
    own = [f"w{k}" for k in range(4000)]
    held = [w for k, w in enumerate(own) for _ in range(1 + 40 // (k + 1) + k % 3)]
    rng.shuffle(held)
    df = frame(spark, [(k, " ".join(held[a : a + 50]), None, None) for k, a in enumerate(range(0, len(held), 50))])
    known, log_frequency = lm_score.vocabulary(df)
    assert len(known.words) == (4000 if rare > 1 else lm_score.KNOWN)
    weights = lm_score.start_weights(log_frequency)
    singles = frame(spark, [(k, w, None, None) for k, w in enumerate(own)])
    got = {r["doc_id"]: r["log_likelihood"] for r in lm_score.score(singles, known, weights).collect()}
    # Alone in a text, all words together with the unseen ones make up the whole distribution.
    buckets = np.arange(known.known, known.size)
    edge = np.full((len(buckets), 2 * lm_score.SIDE), known.size)
    unseen = np.exp(lm_score.log_probabilities(weights, edge, buckets) - known.log_bucket).sum()
    unused = np.arange(len(known.words), known.known)
    unseen += np.exp(lm_score.log_probabilities(weights, edge[:1].repeat(len(unused), 0), unused)).sum()
    assert abs(sum(map(np.exp, got.values())) + unseen - 1) < 1e-3


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_every_word_is_trained_on_once(spark, monkeypatch, rounds):
    rows = awkward()
    df = frame(spark, rows)
    trained, whole_step = [], lm_score._step

    def counted(w, squares, around, ids, rate):
        trained.append(len(ids))
        whole_step(w, squares, around, ids, rate)

    words = lm_score.vocabulary(df)[0]
    start = lm_score.start_weights(np.log(np.full(words.size, 1 / words.size)))
    monkeypatch.setattr(lm_score, "_step", counted)
    batches = df.select("text").toArrow().to_batches()
    seen = [sum(r["n"][0].as_py() for r in lm_score._train_copy(batches, words, start, turn, rounds, 0.1)) for turn in range(rounds)]
    assert sum(seen) == sum(trained) == sum(len(space_words(t)) for _, t, *_ in rows)
    assert max(seen) < 1.1 * min(seen)


def around_by_loop(ids, ptr, edge):
    text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    places = [k for k in range(-lm_score.SIDE, lm_score.SIDE + 1) if k]
    return np.array([[ids[t + k] if 0 <= t + k < len(ids) and text[t + k] == text[t] else edge for k in places] for t in range(len(ids))])


def small_model(seed):
    rng = np.random.default_rng(seed)
    weights = lm_score.start_weights(np.log(rng.dirichlet(np.ones(lm_score.VOCABULARY))))
    count = np.array([0, 1, 2, 7, 0, 40, 3, 25, 1, 0])
    ids = rng.integers(0, 60, count.sum()) * rng.integers(1, 30, count.sum())
    return weights, ids, np.concatenate([[0], np.cumsum(count)])


def test_word_ids_equal_a_dictionary():
    rng = np.random.default_rng(4)
    near = rng.integers(-(2**63), 2**63, 40)
    for words in ([], [7], np.unique(np.concatenate([near, near[:20] + 1, rng.integers(-(2**63), 2**63, 5000)]))):
        known = lm_score.Vocabulary(words)
        hashes = np.concatenate([np.array(words, np.int64), near + 2, [7]]).view(np.uint64)
        by_word = {w: k for k, w in enumerate(np.array(words, np.int64).view(np.uint64).tolist())}
        got = known.ids(hashes).tolist()
        assert all(by_word[h] == k if h in by_word else k >= known.known for h, k in zip(hashes.tolist(), got, strict=True))


def test_texts_score_like_their_words():
    weights, ids, ptr = small_model(5)
    want = lm_score.log_probabilities(weights, around_by_loop(ids, ptr, lm_score.VOCABULARY), ids)
    assert np.allclose(lm_score.text_log_probabilities(weights, ids, ptr), want, atol=1e-4)
    # Logits beyond a float's exponentials.
    weights["bias_1"][:, 0] += 200
    want = lm_score.log_probabilities(weights, around_by_loop(ids, ptr, lm_score.VOCABULARY), ids)
    assert np.isfinite(want).all() and np.allclose(lm_score.text_log_probabilities(weights, ids, ptr), want, atol=1e-2)
    assert len(lm_score.text_log_probabilities(weights, ids[:0], ptr[:1])) == 0


@pytest.mark.parametrize("rounds", [1, 2, 3, 5])
def test_a_training_step_follows_the_gradient(rounds):
    start, ids, ptr = small_model(rounds)
    around = around_by_loop(ids, ptr, lm_score.VOCABULARY)
    shift = [ids[a:b].sum() for a, b in zip(ptr, ptr[1:], strict=False)]
    for turn in range(rounds):
        lines, at = lm_score.laid_out(ids, ptr, lm_score.VOCABULARY, turn, rounds)
        target = np.array([a + k for a, b, s in zip(ptr, ptr[1:], shift, strict=False) for k in range(b - a) if (k + s) % rounds == turn])
        assert lines[at, 0].tolist() == ids[target].tolist()
        got = {k: v.copy() for k, v in start.items()}
        lm_score._step(got, {k: np.full(v.shape, 1e-4, np.float32) for k, v in got.items()}, (lines, at), lines[at, 0], 0.1)
        # The same, word by word.
        gradient = {k: np.zeros(v.shape) for k, v in start.items()}
        sizes = lm_score.grid(lm_score.VOCABULARY)
        for t in target:
            near = start["embed"][around[t]].ravel().astype(float)
            hidden, back, row = np.tanh(near @ start["place"] + start["hidden_bias"]), 0, 0
            for level, digit in enumerate(np.unravel_index(ids[t], sizes)):
                p = np.exp(hidden @ start[f"to_{level}"] + start[f"bias_{level}"][row])
                p /= p.sum()
                p[digit] -= 1
                gradient[f"bias_{level}"][row] += p
                gradient[f"to_{level}"] += np.outer(hidden, p)
                back = back + start[f"to_{level}"] @ p
                row = row * sizes[level] + digit
            back *= 1 - hidden**2
            gradient["hidden_bias"] += back
            gradient["place"] += np.outer(near, back)
            np.add.at(gradient["embed"], around[t], (start["place"] @ back).reshape(-1, lm_score.HIDDEN))
        for name, g in gradient.items():
            g /= len(target)
            assert np.allclose(got[name], start[name] - 0.1 * g / np.sqrt(1e-4 + g * g + 1e-8), atol=1e-5), name


def test_a_step_fetches_a_word_once_not_once_per_neighbour(spark, monkeypatch):
    rng = random.Random(9)
    df = frame(spark, [(k, " ".join(words(rng, 200)), None, None) for k in range(50)])
    known = lm_score.vocabulary(df)[0]
    fetched = []
    monkeypatch.setattr(lm_score, "_step", lambda w, squares, around, ids, rate: fetched.append((np.size(around if isinstance(around, np.ndarray) else around[0]), len(ids))))
    start = lm_score.start_weights(np.log(np.full(known.size, 1 / known.size)))
    for turn in range(2):
        list(lm_score._train_copy(df.select("text").toArrow().to_batches(), known, start, turn, 2, 0.1))
    assert sum(n for n, _ in fetched) < 2.5 * sum(n for _, n in fetched)


def grams(w):
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])


def similarity(a, b):
    from collections import Counter

    x, y = Counter(grams(a)), Counter(grams(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def leak_rows(seed):
    rng = random.Random(seed)
    items = [(k, text(rng, rng.randint(8, 60))) for k in range(25)] + [(25, "short one"), (26, None), (27, " "), (28, "b a c d e")]
    rows = []
    for k in range(120):
        body = words(rng, rng.randint(0, 80))
        if k % 3 == 0:
            w = space_words(rng.choice(items[:26])[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = "altered"
            at = rng.randint(0, len(body))
            body[at:at] = [x.upper() if k % 2 else x for x in w]
        rows.append((k, " ".join(body), "en", "a"))
    return rows + awkward()[3:6], items


@pytest.mark.parametrize("limit", [10**9, 0], ids=["small benchmark", "large benchmark"])
def test_leaks_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", limit)
    rows, items = leak_rows(1)
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(frame(spark, rows, **CLASHES), benchmark).collect()}
    want = {}
    for k, t, *_ in rows:
        w = space_words((t or "").lower())
        for item, passage in items:
            p = space_words((passage or "").lower())
            if not p or not w:
                continue
            at = [similarity(w[max(0, s) : s + len(p)], p) for s in range(-len(p) + 1, len(w))]
            if max(at) >= 0.75:
                want[k, item] = max(at)
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


@pytest.mark.parametrize("limit", [10**9, 0], ids=["small benchmark", "large benchmark"])
def test_leaks_with_moved_parts(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", limit)
    rng = random.Random(12)
    items = [(k, words(rng, 60, 6)) for k in range(4)]
    rows = []
    for k, w in items:
        for turned in (w[30:] + w[:30], w[40:] + w[20:40] + w[:20]):
            for around in (0, 45):
                rows.append((len(rows), " ".join(words(rng, around, 6) + turned + words(rng, around, 6)), "en", "a"))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(frame(spark, rows), benchmark).collect()}
    want = {}
    for k, t, *_ in rows:
        w = space_words(t)
        for item, p in items:
            best = max(similarity(w[max(0, s) : s + len(p)], p) for s in range(-len(p) + 1, len(w)))
            if best >= 0.75:
                want[k, item] = best
    assert len(want) >= 8 and set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_fingerprint_equals_definition(spark):
    rng = random.Random(8)
    lists = [[rng.getrandbits(63) - 2**62 for _ in range(n)] for n in (1, 2, 7, 40)] + [[]]
    df = spark.createDataFrame([(x,) for x in lists], "g array<long>").select("g", decontaminate.fingerprint(F.col("g")).alias("f"))
    for r in df.collect():
        bits = sum((1 << b) for b in range(64) if 2 * sum((h >> b) & 1 for h in r["g"]) > len(r["g"]))
        assert r["f"] & (2**64 - 1) == bits


def test_blocks_find_all_within_radius(spark):
    rng = random.Random(9)
    a = rng.getrandbits(63)
    for radius in (3, 28):
        b = a
        for bit in rng.sample(range(63), radius):
            b ^= 1 << bit
        df = spark.createDataFrame([(a, b)], "a long, b long")
        both = df.select(F.arrays_overlap(decontaminate._blocks(F.col("a"), radius), decontaminate._blocks(F.col("b"), radius)).alias("x"))
        assert both.first()["x"]


def test_leaked_documents_go(spark):
    rows, items = leak_rows(2)
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    df = frame(spark, rows, **CLASHES)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    bad = {r["doc_id"] for r in decontaminate.leaks(df, benchmark).collect()}
    left = decontaminate.drop_leaked(df, benchmark)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - bad
    for empty in (benchmark.where("false"), benchmark.where("text is null")):
        assert decontaminate.drop_leaked(df, empty).count() == len(rows)
    assert decontaminate.leaks(df.where("false"), benchmark).count() == 0


def test_spark_hash_is_the_public_one(spark):
    """The native hash equals XXH64 with seed 42, so fingerprints can be recomputed elsewhere."""
    got = spark.sql("select xxhash64('abc') as h").first()["h"]
    assert got & (2**64 - 1) == xxhash.xxh64(b"abc", seed=42).intdigest()
