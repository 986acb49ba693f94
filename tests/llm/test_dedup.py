"""Duplicates of documents, lines and passages against brute force on small tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import exactdup, jaccard, linededup, suffixdedup

WORDS = [f"w{k}" for k in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Originals, edits at several rates, exact copies, shared passages, and edge cases."""
    rng, rows = random.Random(11), []
    for k in range(40):
        text = prose(rng, rng.choice([3, 30, 120, 300]))
        rows.append((10 * k, text))
        for j, rate in enumerate((0.0, 0.02, 0.08, 0.3)):
            if rng.random() < 0.6:
                rows.append((10 * k + j + 1, " ".join(rng.choice(WORDS) if rng.random() < rate else w for w in text.split())))
    shared = prose(rng, 70)
    rows += [(1000 + k, f"{prose(rng, 20)} {shared} {prose(rng, 10 * k)}") for k in range(5)]
    rows += [(2000, None), (2001, ""), (2002, ""), (2003, "   "), (None, "null id"), (None, rows[0][1]), (2004, "one"), (2005, "one"), (2006, "Two Words"), (2006, "two words")]
    rows += [rows[3], rows[3], (0, prose(rng, 50)), (2007, "word " * 20_000), (2008, "word " * 20_000 + "end")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "z", 1, 2) for d, t in rows], "doc_id bigint, text string, th string, anchor int, members int")


def brute_jaccard(rows, threshold=0.5, n=3):
    sets, best = [], {}
    for d, t in {(d, t) for d, t in rows if d is not None and t and t.split()}:
        w = t.lower().split()
        m = min(n, len(w))
        sets.append((d, {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}))
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            j = len(x & y) / len(x | y)
            if a != b and j >= threshold:
                key = (min(a, b), max(a, b))
                best[key] = max(best.get(key, 0), round(j, 6))
    return best


def brute_classes(rows, threshold=0.5, n=3):
    """(doc_id, set) to (class_id, n_links), and the pairs of different sets by their least doc_ids."""
    docs = set()
    for d, t in rows:
        if d is not None and t and t.split():
            w = t.lower().split()
            m = min(n, len(w))
            docs.add((d, frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1))))
    docs = sorted(docs, key=lambda x: (x[0], sorted(x[1])))
    links, edges, pairs, least = Counter(), [], {}, {}
    for d, x in docs:
        least[x] = min(d, least.get(x, d))
    for i, (a, x) in enumerate(docs):
        for k, (b, y) in enumerate(docs[:i]):
            j = len(x & y) / len(x | y)
            if j >= threshold:
                links[a, x] += 1
                links[b, y] += 1
                edges.append((i, k))
                if x != y:
                    pairs[tuple(sorted((least[x], least[y]))), frozenset((x, y))] = round(j, 6)
    root = groups_of(edges)
    of = defaultdict(set)
    for i, r in root.items():
        of[r].add(docs[i][0])
    return {docs[i]: (min(of[r]), links[docs[i]]) for i, r in root.items()}, Counter((*k[0], j) for k, j in pairs.items())


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_classes(spark, corpus, small, monkeypatch):
    if small:  # many blocks of documents, and every tile divided
        monkeypatch.setattr(jaccard, "AT_ONCE", 500)
        monkeypatch.setattr(jaccard, "_HOT", 0)
        monkeypatch.setattr(jaccard, "BLOCK", 3)
    rng = random.Random(8)
    text = prose(rng, 80).split()
    many = [(5000 + k, " ".join(rng.choice(WORDS) if rng.random() < 0.06 else w for w in text)) for k in range(60)]
    rows = [*corpus, *many, *((6000 + k, "the same text in many rows of the table") for k in range(40))]
    classes, pairs = brute_classes(rows)
    docs = frame(spark, rows)
    assert Counter(map(tuple, jaccard.similar_documents(docs).collect())) == Counter((d, *v) for (d, _), v in classes.items())
    assert Counter(map(tuple, jaccard.similar_pairs(docs).collect())) == pairs
    assert jaccard.similar_documents(docs.limit(0)).count() == 0


def test_jaccard_bitmap_bounds_from_above():
    rng = np.random.default_rng(2)
    for bits in (64, 256):
        a, b = (np.unique(rng.integers(0, 1 << 48, 90, dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([b[:30], a[:60]]))
        x, y = jaccard.bitmaps(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, bits)
        assert (len(a) + len(b) - int(np.bitwise_count(x ^ y).sum())) / 2 >= len(np.intersect1d(a, b))
        z = jaccard.bitmaps(a, np.zeros(len(a), np.int64), 1, 4 * bits)
        assert (jaccard.folded(z, bits)[0] == x).all()


def groups_of(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == groups_of([e for e in edges if e[0] != e[1]])
    assert jaccard.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_drop_near_copies(spark, corpus):
    docs = frame(spark, corpus)
    gone = {x for x, (root, _) in brute_classes(corpus)[0].items() if x[0] != root}
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns

    def set_of(text):
        w = (text or "").lower().split()
        m = min(3, len(w))
        return frozenset(tuple(w[i : i + m]) for i in range(len(w) - m + 1))

    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((d, t) for d, t in corpus if (d, set_of(t)) not in gone)


def test_exact_copies(spark, corpus):
    groups = defaultdict(list)
    for d, t in corpus:
        if d is not None and t is not None:
            groups[t].append(d)
    want = sorted((d, min(g), len(g)) for g in groups.values() if len(g) > 1 for d in g)
    docs = frame(spark, corpus)
    for bits in (128, 10):  # with few bits hashes collide and the contents decide
        assert sorted((r["doc_id"], r["first_doc_id"], r["n_copies"]) for r in exactdup.exact_copies(docs, bits).collect()) == want
    assert sorted((r["doc_id"], r["first_doc_id"], r["n_copies"]) for r in exactdup.exact_copies(docs, hot=2).collect()) == want
    many = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit("one text that all rows have").alias("text")).unionByName(spark.range(2500).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("again").alias("text")))
    got = exactdup.exact_copies(many, hot=10_000).groupBy("first_doc_id", "n_copies").count().collect()
    assert sorted(map(tuple, got)) == [(0, 50_000, 50_000), (7, 2500, 2500)]
    assert exactdup.exact_copies(docs.limit(0)).count() == 0


def test_chunks_are_cut_by_content():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, 200_000, dtype=np.uint8).tobytes()
    ends = exactdup.cuts(data)
    assert ends[-1] == len(data) and all(b - a <= exactdup.MOST for a, b in zip([0, *ends], ends))
    pieces = {data[a:b] for a, b in zip([0, *ends], ends)}
    moved = b"xyz" * 50 + data
    again = exactdup.cuts(moved)
    assert len(pieces & {moved[a:b] for a, b in zip([0, *again], again)}) > 0.9 * len(pieces)
    assert exactdup.cuts(b"") == []


def brute_lines(rows, least=linededup.MIN_CHARS):
    docs = sorted({(d, t) for d, t in rows if d is not None and t})
    lines = {k: [(p, x) for p, x in enumerate(k[1].split("\n")) if x.strip(" \t\r")] for k in docs}
    gone, seen = defaultdict(set), set()
    order = sorted(((k[0], k, i) for k in docs for i in range(len(lines[k]))), key=lambda x: (x[0], x[1], x[2]))
    for _, k, i in order:
        p, x = lines[k][i]
        if (x,) in seen and len(x) >= least:
            gone[k].add(p)
        seen.add((x,))
        if i + 1 < len(lines[k]):
            q, y = lines[k][i + 1]
            if (x, y) in seen:
                gone[k] |= {p, q}
            seen.add((x, y))
    return {k: ("\n".join(x for p, x in enumerate(k[1].split("\n")) if p not in gone[k]), len(lines[k]), len(gone[k])) for k in docs}


def test_line_dedup(spark, monkeypatch):
    monkeypatch.setattr(linededup, "_PART_BITS", 2)  # ranks summed in many parts
    rng = random.Random(4)
    pool = [f"line {k} " + "x" * rng.randint(0, 25) for k in range(25)]
    rows = [(k, "\n".join(rng.choice([*pool, "", f"own {k} {j}"]) for j in range(rng.randint(1, 12)))) for k in range(60)]
    run = "\n".join(f"run line {k}" for k in range(9))
    rows += [(100, run), (101, "before\n" + run + "\nafter"), (102, run + "\n" + run), (200, None), (201, ""), (202, "\n\n"), (None, run), rows[5], rows[5], (300, "same\n" * 3_000)]
    docs = frame(spark, rows).withColumnRenamed("anchor", "n_deleted")
    want = brute_lines(rows)
    got = linededup.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        pass
    out = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_deleted"]) for r in got)
    expect = Counter()
    for d, t in rows:
        if d is not None and t:
            expect[(d, *want[d, t])] += 1
        else:
            lines = None if t is None else sum(1 for x in t.split("\n") if x.strip(" \t\r"))
            expect[(d, t, lines, None if t is None else 0)] += 1
    # Texts that share a doc_id don't occur here, so order by doc_id and place is total.
    assert out == expect
    assert max(r["run_reach"] for r in got if r["doc_id"] in (101, 102)) == 8
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def brute_spans(rows, least=suffixdedup.MIN_WORDS):
    docs = sorted({(d, t) for d, t in rows if d is not None and t})
    where = defaultdict(set)
    for k in docs:
        w = k[1].split()
        for i in range(len(w) - least + 1):
            where[tuple(w[i : i + least])].add(k)
    repeated, removable = defaultdict(set), defaultdict(set)
    for k in docs:
        w = k[1].split()
        for i in range(len(w) - least + 1):
            holders = where[tuple(w[i : i + least])]
            if len(holders) > 1:
                repeated[k] |= set(range(i, i + least))
                if min(holders) < k:
                    removable[k] |= set(range(i, i + least))
    return {k: (repeated[k], removable[k]) for k in repeated}


def test_suffix_array_dedup(spark, corpus):
    rows = [r for r in corpus if r[0] not in (2007, 2008)]  # brute force is quadratic there
    want = Counter((k[0], frozenset(a), frozenset(b)) for k, (a, b) in brute_spans(rows).items())

    def covered(spans):
        return frozenset(i for s in spans for i in range(s["start"], s["stop"]))

    # The order of texts under one doc_id is by hash in the operator; only removable parts depend on it.
    got = Counter((r["doc_id"], covered(r["repeated"]), covered(r["removable"])) for r in suffixdedup.repeated_spans(frame(spark, rows)).collect())
    assert got == want and want
    for hot in (2, 5):  # anchors of so many occurrences without a bucket
        again = suffixdedup.repeated_spans(frame(spark, rows), hot).collect()
        assert Counter((r["doc_id"], covered(r["repeated"]), covered(r["removable"])) for r in again) == want
    assert suffixdedup.repeated_spans(frame(spark, rows).limit(0)).count() == 0
    long = suffixdedup.repeated_spans(frame(spark, [(1, "word " * 20_000), (2, "word " * 20_000 + "end")])).collect()
    assert {r["doc_id"]: r["n_words"] for r in long} == {1: 20_000, 2: 20_000}


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3, (40, 12)).astype(np.uint64)
    buckets = np.sort(rng.integers(0, 4, 40))
    order = suffixdedup.suffix_sort(buckets, values, suffixdedup.prefixes(values))
    assert [tuple(values[k]) for k in order] == [tuple(values[k]) for k in sorted(range(40), key=lambda k: (buckets[k], tuple(values[k]), k))]
