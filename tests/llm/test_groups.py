"""op3, op9: brute force over small fixtures, pigeonhole guarantees, components."""

import random
import re

import numpy as np
import pytest

from rillscore.llm import components, decontaminate, neardup


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den=100):
    """id -> (size, smallest id reachable) by comparing all pairs; rows of one id are one vertex, null ids join by copies."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    key = lambda n: ("id", sets[n][0]) if sets[n][0] is not None else ("row", n)
    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and den * len(s & t) >= num * len(s | t):
                up[find(key(a))] = find(key(b))
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[find(key(n))] = min(i, least.get(find(key(n)), i))
    return sorted(((i, len(s), least.get(find(key(n))) if s or i is not None else None) for n, (i, s) in enumerate(sets)), key=str)


def variants(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            ws = rng.choice(out)[1].split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(ws))
                ws = rng.choice([ws[:at] + ws[at + 1 :], [*ws[:at], rng.choice(words), *ws[at:]], [*ws[:at], rng.choice(words), *ws[at + 1 :]], [*ws, rng.choice(words)]]) or ["w0"]
        else:
            ws = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20, 40, 90, 200, 400]))]
        out.append((len(out), " ".join(ws)))
    return out


@pytest.mark.parametrize(("k", "num", "seed"), [(3, 90, 1), (5, 80, 2), (3, 60, 3)])
def test_groups_equal_brute_force(spark, k, num, seed):
    data = variants(seed)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, k, num, 100).collect()), key=str)
    assert got == brute(data, k, num)


def test_groups_of_awkward_rows(spark, docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 3, 90, 100).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], 3, 90)
    assert neardup.near_duplicates(docs.limit(0), 3, 90, 100).count() == 0


def test_a_chain_of_copies_without_a_centre(spark):
    """Each text is linked with the next one only: pivots decide few pairs, the rest must still be found."""
    words = [f"w{i}" for i in range(400)]
    data = [(i, " ".join(words[i * 4 : i * 4 + 200])) for i in range(40)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 3, 90, 100).collect()}
    assert got == {i: c for i, _, c in brute(data, 3, 90)} and set(got.values()) == {0}


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (50, 100)])
def test_linked_sets_share_a_key(num, den):
    """The pigeonhole guarantee itself, on random pairs at the threshold."""
    rng = np.random.default_rng(num)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        common = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        apart = int(rng.integers(0, 1 + n * (den - num) // num))
        cut = int(rng.integers(0, apart + 1))
        pair = [np.unique(np.concatenate([common, rng.integers(1, 1 << 63, m, dtype=np.uint64)])) for m in (cut, apart - cut)]
        same = len(np.intersect1d(*pair))
        if den * same < num * (len(pair[0]) + len(pair[1]) - same) or np.array_equal(*pair):
            continue
        which, key = neardup.keys_of(pair, np.array([len(p) for p in pair]), num, den)
        assert np.intersect1d(key[which == 0], key[which == 1]).size, (len(pair[0]), len(pair[1]), apart)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 7), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: i // 20 * 20 for i in range(61)} | {100: 0, 200: 200, 201: 200}
    want[60] = got.get(60)
    assert {k: v for k, v in got.items() if k != 60} == {k: v for k, v in want.items() if k != 60 and k in got} and len(got) >= 62
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


# Benchmark


def test_benchmark_windows_equal_brute_force(spark):
    rng = random.Random(9)
    words = [f"term{i}" for i in range(500)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, say(rng.randrange(12, 60))) for i in range(30)]
    texts = []
    for i in range(120):
        ws = say(rng.randrange(20, 300))
        if i % 3 == 0:
            item = list(items[i % 30][1])
            if i % 2:
                item[rng.choice([0, len(item) - 1])] = "changed"
            if i % 5 == 0:
                item = item[: len(item) // 2]
            at = rng.randrange(len(ws))
            ws = ws[:at] + [w.upper() + "," for w in item] + ws[at:]
        texts.append((i, " ".join(ws)))
    want = set()
    for d, t in texts:
        ws = decontaminate.tokens(t)
        for i, item in items:
            n = len(item)
            sims = [decontaminate.similarity(decontaminate.bag(ws[p : p + n], 5), decontaminate.bag(item, 5)) for p in range(len(ws) - n + 1)]
            if sims and max(sims) >= 0.8:
                want.add((d, i, round(max(sims), 9)))
    assert len(want) > 15
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    for at_once in (20_000, 7):
        got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.find_benchmark(df, bench, items_at_once=at_once).collect()}
        assert got == want
        left = {r.doc_id for r in decontaminate.decontaminate(df, bench, items_at_once=at_once).collect()}
        assert left == {d for d, _ in texts} - {d for d, _, _ in want}


def test_benchmark_in_documents_shorter_than_the_item(spark):
    """Items that stand alone, cut at either end or inside, down to less than is similar enough."""
    rng = random.Random(11)
    items = [(i, [f"term{rng.randrange(500)}" for _ in range(n)]) for i, n in enumerate((15, 23, 40, 59))]
    texts = [(w[c:], w[: len(w) - c], w[:7] + w[7 + c :]) for _, w in items for c in (0, 1, 2, 3, 5, 7, 12, len(w) - 6, len(w) - 3)]
    texts = list(enumerate(" ".join(t) for three in texts for t in three))
    want = set()
    for d, t in texts:
        ws = decontaminate.tokens(t)
        for i, item in items:
            n = min(len(item), len(ws))
            sims = [decontaminate.similarity(decontaminate.bag(ws[p : p + n], 5), decontaminate.bag(item, 5)) for p in range(len(ws) - n + 1)] if n >= 5 else []
            if sims and max(sims) >= 0.8:
                want.add((d, i, round(max(sims), 9)))
    assert 20 < len(want) < len(texts) - 20 and sum(s < 1 for *_, s in want) > 10
    df, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.find_benchmark(df, bench).collect()}
    assert got == want
    left = {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()}
    assert left == {d for d, _ in texts} - {d for d, _, _ in want}


def test_benchmark_items_shorter_than_a_shingle():
    long = " ".join(f"term{i}" for i in range(20))
    index = decontaminate.ItemIndex.build([(1, "Two, words"), (2, "two words"), (3, "日本語の長い文"), (4, "a b c d"), (5, long), (5, "term3"), (None, "!")], 5)
    find = lambda t: sorted(index.found(t, decontaminate.TokenHashes(), 0.8))
    assert find("words, two WORDS two words") == [(1, 1.0, 1), (2, 1.0, 1)]
    assert find("日本語の長い文。") == [(3, 1.0, 0)] and find("a b c e d a b c d") == [(4, 1.0, 5)]
    assert find(long + " two words") == [(1, 1.0, 20), (2, 1.0, 20), (5, 1.0, 0)]
    assert find("twowords a b c") == find("") == find(None) == []


def test_benchmark_awkward_rows(spark, docs):
    text = docs.where("doc_id = 1").first().text
    bench = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "short"), (None, text)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_benchmark(docs, bench).collect()}
    assert got == {(d, i) for d in (1, 2, 3, None) for i in (1, None)}
    assert decontaminate.find_benchmark(docs.limit(0), bench).count() == 0 and decontaminate.find_benchmark(docs, bench.limit(0)).count() == 0
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 4
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_radius_guarantee():
    """Any two fingerprints within the radius meet in a block."""
    rng = random.Random(2)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert any(((a >> 8 * k ^ b >> 8 * k) & 255).bit_count() <= decontaminate.RADIUS // decontaminate.BLOCKS for k in range(8))
