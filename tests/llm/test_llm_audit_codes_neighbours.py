"""Source audit, vector codes and nearest vectors against plain versions, and on awkward rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import codes, divergence, neighbours


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# --- divergence -----------------------------------------------------------------------------


def audited(documents, least, top=10):
    """(lang, source, part, item, value, rank), by counting everything."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in documents:
        lowered = (text or "").translate(brute._LOWER)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in counts if g == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        every = {s: shares(counts[lang, s]) for s in sources}
        q = shares(whole)
        for s, p in every.items():
            pairs = [(o, sum(f(p[t], every[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[t], q[t])) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, listed, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                listed.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(listed[:most])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    random = np.random.default_rng(3)
    words = [*"abcdefghij", "Élan", "日本", "x9y", "don't", "zz_top"]
    out = [
        (" ".join(random.choice(words, random.integers(0, 12))), lang, source)
        for lang in ("en", "de", None)
        for source in ("s1", "s2", "s3", None, "s5")
        for _ in range(random.integers(1, 9))
    ]
    out += [(None, "en", "silent"), ("...", "en", "silent"), ("only here", "lone", "s1"), ("", "", "")]
    out += [("a b " * 3000, "en", "s1"), ("a", "en", "s1"), ("a", "en", "s1")]
    return out


@pytest.mark.parametrize("block, tile", [(4096, 24), (3, 2), (1, 1)])
def test_audit_matches_plain_counts(llm, texts, block, tile):
    df = llm.createDataFrame(
        [(*t, 1, 2, "x") for t in texts],
        "text STRING, lang STRING, source STRING, n INT, value INT, term STRING",
    )
    found = divergence.audit(df, documents_least=3, block_terms=block, tile_sources=tile)
    assert rows(found) == audited(texts, 3)
    assert rows(divergence.audit(df.where("false"))) == []


def test_equal_subtrees_are_one_node_and_met_once():
    random = np.random.default_rng(0)
    counts = np.where(random.random((6, 1024)) < 0.02, random.integers(1, 3, (6, 1024)), 0)
    counts[5] = counts[4]
    forest = divergence.Forest(counts)
    assert forest.roots[4] == forest.roots[5]
    assert forest.nodes() < 6 * 1023 / 3
    which, a, b, times = forest.leaf_pairs(0, np.array([1, 5]))
    for k, other in enumerate((1, 5)):
        mine = which == k
        met = {
            (forest.counts[x], forest.counts[y]): n
            for x, y, n in zip(a[mine], b[mine], times[mine], strict=True)
        }
        assert met == Counter(zip(counts[0], counts[other], strict=True))
    assert len(a) == len({*zip(which, a, b, strict=True)})


def test_shares_of_very_large_counts_are_exact():
    counts = np.array([-1, 0, 1, 10**12, 10**15])
    total, kept = 3 * 10**15, 7
    got = divergence.shares(counts, total, kept).tolist()
    assert got == [0, *(1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts.tolist()[1:])]


# --- codes ----------------------------------------------------------------------------------


def coded(vectors, parts=4, entries=256, rounds=4):
    """The rules in Python's whole numbers, by comparing everything."""
    kept = [
        (i, label, [math.floor(1024 * x) for x in v])
        for i, v, label in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    length = len(kept[0][2]) // parts
    cut = [[v[p * length : (p + 1) * length] for p in range(parts)] for _, _, v in kept]
    order = sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def nearest(p):
        out = []
        for row in cut:
            far = [sum((a - b) ** 2 for a, b in zip(row[p], e, strict=True)) for e in books[p]]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for row, (at, _) in zip(cut, nearest(p), strict=True):
                members[at].append(row[p])
            for at, held in members.items():
                books[p][at] = [sum(c) // len(held) for c in zip(*held, strict=True)]
    found = [nearest(p) for p in range(parts)]
    flat = ",".join(str(c) for book in books for e in book for c in e)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    errors = [sum(found[p][k][1] for p in range(parts)) for k in range(len(kept))]
    labels = Counter()
    for (_, label, _), error in zip(kept, errors, strict=True):
        labels[label] += error
    return sorted(
        (
            (i, "".join(f"{found[p][k][0]:02x}" for p in range(parts)), errors[k], labels[label], digest)
            for k, (i, label, _) in enumerate(kept)
        ),
        key=repr,
    )


VECTOR = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code INT, v STRING, error STRING"


@pytest.mark.parametrize("size, scale", [(12, 1.0), (8, 3000.0)])
def test_codes_match_plain_quantisation(llm, size, scale):
    random = np.random.default_rng(2)
    made = (random.standard_normal((300, size)) * scale).astype("f4").astype(float).tolist()
    made[10] = made[3]
    data = [(i * 3 - 40, v, int(i % 4) if i % 5 else None) for i, v in enumerate(made)]
    data += [
        (1000, None, 1),
        (1001, [None] * size, 1),
        (1002, [math.nan] * size, None),
        (1003, [math.inf] + [0.0] * (size - 1), None),
        (1004, [0.0] * size, None),
    ]
    df = llm.createDataFrame([(*r, 7, "x", "y") for r in data], VECTOR).repartition(5)
    assert rows(codes.quantised(df)) == coded(data)


def test_codes_of_few_odd_or_no_rows(llm):
    some = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [2.0, 2.0], None), (None, [2.5], None), (3, [], 1)]
    df = llm.createDataFrame([(*r, 7, "x", "y") for r in some], VECTOR)
    got = {r.vec_id: r for r in codes.quantised(df).collect()}
    assert set(got) == {1, 2, None, 3}
    assert all(len(r.code) == 8 for r in got.values())
    assert [got[k].error for k in (1, 2, None, 3)] == [0] * 4
    assert codes.quantised(df.where("false")).collect() == []
    # the same rows in other parts of the table give the same codes
    assert rows(codes.quantised(df.repartition(4))) == rows(codes.quantised(df.coalesce(1)))


def test_wide_components_stay_exact(llm):
    big = [(i, [1e23 * (i % 3), 1.0, float(i), -2.0], i % 2) for i in range(9)]
    df = llm.createDataFrame([(*r, 7, "x", "y") for r in big], VECTOR.replace("FLOAT", "DOUBLE"))
    assert rows(codes.quantised(df)) == coded(big)


def test_transform_keeps_distances_and_orders_by_sign_changes():
    for size in (1, 2, 16, 64):
        x = np.random.default_rng(size).integers(-500, 500, (5, size))
        y = codes.transformed(x)
        assert ((y**2).sum(axis=1) == size * (x**2).sum(axis=1)).all()
        signs = codes.transformed(np.eye(size, dtype=int))[:, codes.sequency_order(size)].T
        assert (np.diff(signs, axis=1) != 0).sum(axis=1).tolist() == list(range(size))


def test_ties_go_to_the_lower_entry():
    book = codes.Codebook(np.array([[5, 5], [1, 1], [-1, -1], [1, 1], [5, 5]]))
    at, far = book.nearest(np.array([[0, 0], [1, 1], [5, 5], [9, 9]]))
    assert at.tolist() == [1, 1, 0, 0]
    assert far.tolist() == [2, 0, 0, 32]


# --- nearest vectors ------------------------------------------------------------------------


def product(v, w):
    total = 0.0  # sum() would carry lost digits along
    for a, b in zip(v, w, strict=True):
        total += a * b
    return total


def brute_nearest(data, asks, k=20):
    out = {}
    for i, v in data:
        if not asks(i):
            continue
        scores = [
            (-product(v, w), j)
            for j, w in data
            if j != i and len(v) == len(w)
        ]
        out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def found_nearest(llm, data, **more):
    df = llm.createDataFrame(
        [(i, v, 1, "x", 2.0) for i, v in data],
        "vec_id BIGINT, embedding ARRAY<DOUBLE>, part INT, id STRING, score DOUBLE",
    ).repartition(4)
    out = defaultdict(dict)
    for r in neighbours.nearest_vectors(df, F.col("vec_id") % 20 == 0, **more).collect():
        out[r.query_id][r.rank] = (r.vec_id, r.score)
    return {q: [v[k] for k in sorted(v)] for q, v in out.items()}


def test_few_rows_are_compared_exactly(llm):
    random = np.random.default_rng(4)
    data = [(i, random.standard_normal(6).tolist()) for i in range(60)]
    data += [(i, data[1][1]) for i in range(100, 400)]  # one vector many times, also as a query
    data += [(1000 + i, [1.0 * i, 2.0]) for i in range(3)]
    odd = [
        (20_000, None),
        (20_020, []),
        (20_040, [0.0] * 6),
        (20_060, [1.0, math.nan, 0.0, 0.0, 0.0, 0.0]),
        (20_080, [1.0, math.inf, 0.0, 0.0, 0.0, 0.0]),
        (20_100, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (None, [1.0] * 6),
    ]
    got = found_nearest(llm, data + odd + data[:5], block_rows=16, chunk_queries=4)
    assert got == brute_nearest(data, lambda i: i % 20 == 0)
    assert found_nearest(llm, []) == {}
    assert found_nearest(llm, data[:1]) == {}


@pytest.mark.parametrize("lengths", ["equal", "heavy-tailed"])
def test_recall_of_learned_partitions(llm, lengths):
    random = np.random.default_rng(9)
    centres = random.standard_normal((40, 24)) * 1.2
    x = centres[random.integers(0, 40, 4000)] + random.standard_normal((4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths != "equal":
        x *= random.pareto(2, (4000, 1)) + 0.5
    got = found_nearest(llm, list(enumerate(x.tolist())), sample_rows=1500, parts=16)
    asks = np.arange(0, 4000, 20)
    close = x[asks] @ x.T
    close[np.arange(len(asks)), asks] = -np.inf
    best = np.argsort(-close, axis=1)[:, :20]
    assert set(got) == set(asks.tolist())
    hits = sum(len({i for i, _ in got[q]} & set(b.tolist())) for q, b in zip(asks.tolist(), best))
    assert hits / best.size >= 0.9
    for q, listed in got.items():
        assert len(listed) == 20 and listed == sorted(listed, key=lambda r: (-r[1], r[0]))


def test_partitions_are_balanced_and_cut_few_edges_and_fewer_are_visited():
    random = np.random.default_rng(1)
    x = np.repeat(random.standard_normal((8, 16)) * 3, 200, axis=0) + random.standard_normal((1600, 16))
    near = neighbours.graph(x, 10)
    part = neighbours.cut(x, near, 8, 20)
    assert np.bincount(part).tolist() == [200] * 8
    crossing = (part[:, None] != part[near]).mean()
    assert crossing < 0.2
