"""Quality, toxicity, decontamination and language-model scoring: held-out accuracy, brute force and edge cases."""

import math
import random

import numpy as np
import pytest

from quillspark.llm import decontam, lmscore, quality, toxicity

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, score double, label string"
SF = "/root/testdata/sf0.01"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 1.0, "x") for d, t in rows], DOCS)


EDGE = [(9001, None), (9002, ""), (9003, " \n "), (None, "null id text here"), (9004, "word " * 20_000), (9004, "word " * 20_000), (9005, "x" * 50_000)]


def made_quality(rng, n):
    good = "the results of this study show that careful measurement leads to a clear answer for most readers".split()
    bad = "CLICK BUY now !!! free free $$$ win win http offer best best deal".split()
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(good if k % 2 else bad) for _ in range(rng.randint(8, 60))]
        rows.append((k, " ".join(words)))
        labels.append((k, k % 2, 0))
    return rows, labels


def test_quality_held_out(spark):
    rows, labels = made_quality(random.Random(1), 300)
    got = {r["doc_id"]: r["keep"] for r in quality.score(docs_of(spark, rows), spark.createDataFrame(labels[:200], LABELS)).collect()}
    assert sum(got[k] == bool(q) for k, q, _ in labels[200:]) >= 97


def test_quality_on_the_tables(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 4 = 0").collect()}
    got = {r["doc_id"]: r["keep"] for r in quality.score(spark.read.parquet(f"{SF}/documents.parquet"), labels.where("doc_id % 4 <> 0")).collect()}
    known = [k for k in held if held[k] is not None and k in got]
    assert sum(got[k] == bool(held[k]) for k in known) >= 0.9 * len(known)


def test_quality_score_is_the_sparse_dot_product(spark):
    rows, labels = made_quality(random.Random(2), 60)
    model = quality.train(docs_of(spark, rows), spark.createDataFrame(labels, LABELS))
    for r in quality.score(docs_of(spark, rows), spark.createDataFrame(labels, LABELS)).collect():
        f = quality.features(dict(rows)[r["doc_id"]])
        x = float(np.sum(model[0][f], dtype=np.float64)) * quality._SCALE / len(f) + model[1]
        assert abs(r["score"] - 1 / (1 + math.exp(-x))) < 1e-5


def test_quality_edges(spark):
    rows, labels = made_quality(random.Random(3), 80)
    odd = [*labels, (9001, 0, 0), (None, 1, 0), (5, 0, 0), (6, None, 0)]
    docs = docs_of(spark, rows + EDGE)
    got = [(r["doc_id"], r["score"], r["keep"]) for r in quality.score(docs, spark.createDataFrame(odd, LABELS)).collect()]
    assert len(got) == len(rows) + len(EDGE)
    assert all(s is None and k for d, s, k in got if d in (9001, 9002, 9003)) and sum(d == 9004 for d, _, _ in got) == 2
    kept = quality.keep_good(docs, spark.createDataFrame(odd, LABELS))
    assert kept.columns == docs.columns and kept.count() == sum(k for _, _, k in got)
    none = spark.createDataFrame([], LABELS)
    assert quality.keep_good(docs, none).count() == docs.count() and quality.score(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(k, 1, 0) for k in range(9)], LABELS)
    assert quality.keep_good(docs, one).count() == docs.count()


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    m = quality.Ftrl()
    for _ in range(2000):
        y = int(rng.integers(2))
        index = np.array([10 + y, 100 + int(rng.integers(500))])
        m.learn(index, np.ones(2), y)
    w = m.weights()
    assert w[11] > 0.5 and w[10] < -0.5 and np.count_nonzero(w) < 502


def test_ftrl_is_the_proximal_update():
    """Against the update written out for one coordinate at a time, with weights from z and n only."""
    rng, m = np.random.default_rng(4), quality.Ftrl(0.3, 1.0, 0.05, 0.02)
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= 0.05 else -(zi - math.copysign(0.05, zi)) / ((1.0 + math.sqrt(n.get(i, 0.0))) / 0.3 + 0.02)

    for _ in range(300):
        index = np.sort(rng.choice(40, 5, replace=False))
        value, label = rng.random(5), int(rng.integers(2))
        w = {int(i): weight(int(i)) for i in index}
        b = -bias[0] / ((1.0 + math.sqrt(bias[1])) / 0.3)
        p = 1 / (1 + math.exp(-(sum(w[int(i)] * v for i, v in zip(index, value)) + b)))
        for i, v in zip(index.tolist(), value.tolist()):
            g = (p - label) * v
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / 0.3
            z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
        e = p - label
        bias[0] += e - (math.sqrt(bias[1] + e * e) - math.sqrt(bias[1])) / 0.3 * b
        bias[1] += e * e
        m.learn(index, value, label)
    assert np.allclose([m.weights()[i] for i in range(40)], [weight(i) for i in range(40)], atol=1e-9)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def test_matcher_is_edit_distance():
    rng, terms = random.Random(6), {"idiot": 1, "worthless": 2, "scum": 0, "pathetic": 1, "worthy": 1}
    m = toxicity.Matcher(terms, {})
    words = {"idiot", "idoit", "worthles", "wrthlss", "scums", "scum", "", "x" * 40}
    for t in terms:
        for _ in range(200):
            w = list(t)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(w) + 1)
                op = rng.random()
                if op < 0.35 and k < len(w):
                    del w[k]
                elif op < 0.7:
                    w.insert(k, rng.choice("abcdiotw"))
                elif k < len(w):
                    w[k] = rng.choice("abcdiotw")
            words.add("".join(w))
    for w in words:
        near = [(edits(w, t), t) for t in terms if edits(w, t) <= terms[t]]
        got = m.match(w)
        assert (got is None) == (not near) and (got is None or got[1] == min(near)[0])
    tiny = toxicity.Matcher(terms, {}, most_states=5)
    assert all((tiny.match(w) or (0, 9))[1] == (m.match(w) or (0, 9))[1] for w in words)
    assert toxicity.Matcher({}, {"brok": 0}).match("broken") == ("brok", 0)


def test_matcher_allows_edits_within_stems():
    rng, terms, stems = random.Random(7), {"brokers": 1, "idiot": 0}, {"broke": 1, "stupid": 1, "moro": 0}
    m = toxicity.Matcher(terms, stems)
    words = set()
    for stem in stems:
        for _ in range(300):
            w = list(stem + rng.choice(["", "n", "ness", "rs", "ity"]))
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w))
                w[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "o", "e"])
            words.add("".join(w))
    for w in words:
        near = [edits(w, t) for t in terms if edits(w, t) <= terms[t]]
        near += [e for t in stems if (e := min(edits(w[:k], t) for k in range(len(w) + 1))) <= stems[t]]
        got = m.match(w)
        assert (got is None) == (not near) and (got is None or got[1] == min(near)), w


def brute_toxicity(text, terms):
    """The score by the docstring: weights by edits, quotation, reporting and address within six words, joined as independent evidence."""
    words, rest = text.lower().split(), 1.0
    strip = lambda w: w.strip("\"'`“”‘’«».,;:!?()[]{}<>…*_~|-")
    for k, word in enumerate(words):
        near = sorted((edits(strip(word), t), -len(t)) for t in terms if edits(strip(word), t) <= terms[t])
        if not near:
            continue
        window = [strip(w) for w in words[max(0, k - 6) : k] + words[k + 1 : k + 7]]
        before, after = " ".join(words[max(0, k - 6) : k]) + " " + word.split(strip(word))[0], word.split(strip(word))[-1] + " " + " ".join(words[k + 1 : k + 7])
        quoted = before.count('"') % 2 == 1 and after.count('"') % 2 == 1
        weight = (0.8, 0.55, 0.4)[near[0][0]] * (0.4 if quoted else 1) * (0.6 if {"said", "called", "word", "insult"} & set(window) else 1)
        if {"you", "your"} & set(window) and not quoted:
            weight = 1 - (1 - weight) * 0.6
        rest *= 1 - weight
    return round(1 - rest, 6)


def test_scores_match_brute_force():
    rng, terms = random.Random(3), {"idiot": 1, "worthless": 2, "scum": 0}
    s = toxicity.Scorer(terms, {})
    pool = ["the", "a", "you", "your", "said", "called", "word", "insult", '"idiot"', "idiot", "idoit", "worthles", "wrthles!", "scum,", '"a', 'b"', "plain", "text", "more", "of", "it", "here", "and", "there"]
    for _ in range(400):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(1, 30)))
        assert s.score(text)[0] == brute_toxicity(text, terms), text


def test_quotation_counts_less():
    s = toxicity.Scorer({"idiot": 1}, {})
    plain, misspelt, quoted, address = (s.score(t)[0] for t in ("what an idiot he is", "what an idiott he is", 'the word "idiot" is an insult he said', "you idiot"))
    assert quoted < 0.5 <= misspelt < plain <= address
    assert s.score("a clean sentence") == (0.0, [])


def test_toxicity_on_the_tables(spark):
    at = "/root/testdata/sf0.1"  # the lexicon is mined from labels, so it takes some
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    want = {r["doc_id"]: r["toxic"] for r in labels.where("toxic is not null").collect()}
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score_toxicity(docs, labels).collect()}
    bad = [k for k in want if want[k]]
    assert sum(got[k] for k in bad) >= 0.8 * len(bad)
    assert sum(got[k] for k in want if not want[k]) <= 0.005 * len(want)


def test_toxicity_held_out(spark):
    """Mined from one half of the labels, held against the other."""
    at = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet").where("toxic is not null")
    mined, held = labels.where("pmod(xxhash64(doc_id, 5), 2) = 0"), labels.where("pmod(xxhash64(doc_id, 5), 2) = 1")
    want = {r["doc_id"]: r["toxic"] for r in held.collect()}
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score_toxicity(docs, mined).collect()}
    bad = [k for k in want if want[k]]
    assert sum(got[k] for k in bad) >= 0.9 * len(bad)
    assert sum(got[k] for k in want if not want[k]) <= 0.005 * len(want)


def test_toxicity_edges(spark):
    docs = docs_of(spark, [(1, "you idiot"), (1, "you idiot"), *EDGE])
    got = [(r["doc_id"], r["score"], r["toxic"]) for r in toxicity.score_toxicity(docs).collect()]
    assert len(got) == docs.count() and sum(t for _, _, t in got) == 2
    assert {(d, s, t) for d, s, t in got if d in (9001, 9002, 9003)} == {(9001, None, False), (9002, 0.0, False), (9003, 0.0, False)}
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 1, None)], LABELS)
    assert toxicity.score_toxicity(docs, labels).where("toxic").count() == 2
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


ITEM = "A farmer in Boston bought 12 apples for 5 dollars and gave 3 of them to a neighbour before selling the rest at noon"
SAME = "Filler before it. A farmer in London bought 40 apples for 9 euros and gave 7 of them to a neighbour before selling the rest at noon. Filler after."


def test_decontamination_cases(spark):
    twice = "Ann has 4 red balls and buys 4 more of those red balls from the shop before she counts them all again"
    items = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "x"), (2, twice, "x"), (3, None, "x"), (4, "", "x"), (None, ITEM, "x"), (5, "short one here", "x"), (6, "exactly five plain words here", "x")], "item_id bigint, text string, doc_id string")
    rows = [
        (10, ITEM), (11, SAME), (11, SAME), (12, "Nothing in common with any question in the list of items at all, only prose."), (13, ITEM.replace("12", "12.5").upper().lower()),
        (14, twice.replace("4", "9")), (15, twice.replace("has 4", "has 8").replace("buys 4", "buys 6")), (16, "so exactly five plain words here then"), (17, "short one here"), *EDGE,
    ]
    docs = docs_of(spark, rows)
    for most in (decontam.MOST_SENT, 0):  # with the windows sent to all, and hash-joined
        got = {(r["doc_id"], r["item_id"]) for r in decontam.decontaminate(docs, items, most_sent=most).collect()}
        assert {(10, 1), (11, 1), (14, 2), (16, 6)} <= got
        assert not {d for d, _ in got} & {12, 17, None, 9001, 9004} and (15, 2) not in got
    assert decontam.decontaminate(docs.limit(0), items).count() == 0 and decontam.decontaminate(docs, items.limit(0)).count() == 0


def test_decontamination_of_changed_copies(spark):
    first = "we packed the blue crates with fresh apples before the long trip across the wide valley and then"
    item = f"{first} sold them all for 12 km of strong rope to some old farmers near the quiet lake"
    named = "if Alice has three old books and gives Alice two more of the same books then how many are left there"
    rows = [
        (1, item.replace("and then", "and only then")), (2, item.replace("and then", "then")), (3, item.replace("12 km", "40km")), (4, item.replace("12 km", "$5")), (5, item.replace("12 km", "5 dollars")),
        (6, f"some heading here\n{named.capitalize().replace('alice', 'Alice')}"), (7, f"as we said to Mary {named[3:]}"), (8, item.replace(" ", "\n")), (9, " ".join(reversed(item.split()))),
        (10, named.replace("Alice two", "Mary two")), (11, first), (12, f"{first} and {' '.join(item.split()[18:24])}"), (13, "some heading here\n" + named.replace("if Alice", "If Rosa").replace("gives Alice", "gives Rosa")),
    ]
    items = spark.createDataFrame([(1, item), (2, named)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontam.decontaminate(docs_of(spark, rows), items).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 2), (7, 2), (8, 1), (13, 2)} <= set(got)
    assert not {d for d, _ in got} & {9, 10, 11, 12}
    assert got[3, 1] == got[4, 1] == got[5, 1] == got[8, 1] == 1 and 0.6 < got[1, 1] < 0.9


def brute_windows(text, width=decontam.WIDTH):
    hashes, _, _ = decontam.canonical(text)
    return {tuple(hashes[i : i + width].tolist()) for i in range(len(hashes) - width + 1)}


def test_decontamination_against_brute_force_on_the_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.decontaminate(docs, items).collect()}
    parts = {r["item_id"]: (r["text"], brute_windows(r["text"])) for r in items.collect()}
    verbatim, possible = set(), set()
    for r in docs.select("doc_id", "text").collect():
        have = brute_windows(r["text"])
        for item, (text, windows) in parts.items():
            if text in r["text"]:
                verbatim.add((r["doc_id"], item))
            if windows and len(windows & have) >= 0.5 * len(windows) - 1:
                possible.add((r["doc_id"], item))
    assert verbatim <= got and verbatim
    assert {p for p in got if len(brute_windows(parts[p[1]][0])) > 2} <= possible


def test_language_model_is_normalised_and_learns(spark):
    rng = random.Random(9)
    pairs = {f"a{k}": f"b{k}" for k in range(30)}

    def text(shuffled):
        words = []
        for _ in range(60):
            a = rng.choice(list(pairs))
            words += [a, rng.choice(list(pairs.values())) if shuffled else pairs[a]]
        return " ".join(words)

    train = docs_of(spark, [(k, text(False)) for k in range(4000)])
    words, frequency = lmscore.choose_vocabulary(train, 128)
    model = lmscore.train(train, words, frequency)
    v = len(words)
    for w1, w2 in ((1, 1), (5, 9), (0, 3)):
        assert abs(np.exp(model.log_probabilities(np.full(v, w1), np.full(v, w2), np.arange(v))).sum() - 1) < 1e-3
    test = docs_of(spark, [(k, text(k >= 20)) for k in range(40)])
    got = {r["doc_id"]: r["perplexity"] for r in lmscore.score_documents(test, model, words).collect()}
    natural, odd = np.mean([got[k] for k in range(20)]), np.mean([got[k] for k in range(20, 40)])
    assert natural < 0.75 * odd and natural < 45


def test_language_model_scores_match_a_direct_sum(spark):
    docs = docs_of(spark, [(1, "a b c a b"), (2, "zzz unseen"), (None, "a"), (1, "a b c a b"), *EDGE[:3]])
    words, frequency = lmscore.choose_vocabulary(docs, 8)
    model = lmscore.train(docs, words, frequency)
    known = lmscore.numbers(words)
    for r in lmscore.score_documents(docs, model, words).collect():
        if r["doc_id"] == 9001:
            assert r["log_prob"] is None and r["n_words"] is None
            continue
        ids = lmscore.word_ids(dict([(1, "a b c a b"), (2, "zzz unseen"), (None, "a"), (9002, ""), (9003, " ")])[r["doc_id"]].split(), known)
        want = 0.0
        for w1, w2, w in zip(ids, ids[1:], ids[2:]):
            context = model.scales[0] * model.r[w1] + model.scales[1] * model.r[w2]
            k = w // model.width
            own = slice(k * model.width, (k + 1) * model.width)
            classes, inside = model.s.astype(float) @ context + model.t, model.q[own].astype(float) @ context + model.b[own]
            want += classes[k] - np.log(np.exp(classes).sum()) + inside[w - own.start] - np.log(np.exp(inside).sum())
        assert abs(r["log_prob"] - want) < 1e-3 * max(1, abs(want)) and r["n_words"] == len(ids) - 3


def test_contrast_gradient_is_the_slope_of_the_objective():
    rng = np.random.default_rng(3)
    frequency = rng.random(23) + 0.1
    frequency /= frequency.sum()
    start = lmscore.Model.fresh(frequency, 4)
    m = lmscore.Model(*(x.astype(np.float64) for x in (start.words, start.scales, start.s, start.t)))
    noise = lmscore.Noise(frequency, 3, 2)
    w1, w2, w = rng.integers(0, 23, (3, 40))
    drawn = noise.draw()
    assert (drawn[1] // m.width == np.arange(len(m.t))[:, None]).all()
    _, g = lmscore.contrast(m, noise, w1, w2, w, *drawn)
    whole = {"scales": g["scales"], "s": g["s"], "t": g["t"], "words": np.zeros_like(m.words)}
    whole["words"][g["r"][0], :4] += g["r"][1]
    whole["words"][g["q"][0], 4:] += g["q"][1]
    for name, want in whole.items():
        x = getattr(m, name)
        for at in np.ndindex(x.shape):
            was, slope = x[at], []
            for move in (1e-5, -1e-5):
                x[at] = was + move
                slope.append(lmscore.contrast(m, noise, w1, w2, w, *drawn, measured=True)[0])
            x[at] = was
            assert abs((slope[0] - slope[1]) / 2e-5 - want[at]) < 1e-4 * max(1, abs(want[at])), (name, at)


def test_vocabulary_grows_with_the_corpus(spark):
    assert lmscore.vocabulary_size(10**6) < lmscore.vocabulary_size(10**8) < lmscore.vocabulary_size(10**11) == lmscore.MOST_WORDS
    docs = docs_of(spark, [(1, "a a a a b b b c c d")])
    assert lmscore.choose_vocabulary(docs, 5)[0][2:] == ["a", "b", "c"] and lmscore.choose_vocabulary(docs, 2)[0][2:] == []


def test_language_model_tells_unknown_words_apart(spark):
    common = " ".join(["a b c"] * 9)
    rows = [(k, f"{common} bald{'abcdefgh'[k % 8]}eren {common}") for k in range(40)]
    docs = docs_of(spark, [*rows, (100, f"{common} baldaeren"), (101, f"{common} zq9éxkqq"), (102, f"{common} balderen")])
    got = {r["doc_id"]: r["log_prob"] for r in lmscore.lm_scores(docs, 5).collect()}
    assert got[100] > got[102] > got[101] + 5 or got[102] > got[100] > got[101] + 5


def test_spelling_is_a_distribution_over_unknown_words(spark):
    import itertools

    counts = spark.createDataFrame([("ab", 6), ("a", 5), ("b", 2), ("ba", 1), ("bb", 9)], "word string, n bigint")
    spelling = lmscore.Spelling(*lmscore.count_trigrams(counts, ["\x00unknown", "\x00edge", "bb"]), ["bb"])
    strings = ["".join(x) for n in range(1, 14) for x in itertools.product("ab", repeat=n)]
    total = np.exp(spelling.log_probabilities([x for x in strings if x != "bb"])).sum()
    # What is left are longer strings and those with other bytes.
    assert 0.4 < total < 1
    each = {w: float(spelling.log_probabilities([w])[0]) for w in ("ab", "a", "ba", "é", "x")}
    assert each["ab"] > each["ba"] > each["x"] > each["é"] and np.allclose(spelling.log_probabilities(list(each)), list(each.values()))
    # All bytes that may follow one context.
    alphabet = np.concatenate([spelling.table[0, 0, :-1], np.full(256 - len(np.unique(spelling.place)) + 1, spelling.table[0, 0, -1])])
    assert abs(np.exp(alphabet.astype(float)).sum() - 1) < 1e-3


def test_language_model_edges(spark):
    got = lmscore.lm_scores(docs_of(spark, EDGE)).collect()
    assert len(got) == len(EDGE) and all(math.isfinite(r["perplexity"]) for r in got if r["doc_id"] != 9001)
    assert lmscore.lm_scores(docs_of(spark, EDGE).limit(0)).count() == 0
    assert lmscore.lm_scores(docs_of(spark, [(1, None)])).first()["log_prob"] is None
