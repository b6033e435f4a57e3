"""Order MinHash, alignment and classes against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import order_minhash
from tidemark.llm.components import components


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words) + 1)
        way = rng.random()
        if way < 0.3 and words:
            words.pop(min(at, len(words) - 1))
        elif way < 0.6:
            words.insert(at, f"new{rng.randrange(99)}")
        elif words:
            words[min(at, len(words) - 1)] = f"other{rng.randrange(99)}"
    return words


def test_alignment():
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = [rng.randint(0, 30) for _ in range(rng.randint(1, 120))]
        b = [hash(w) % 1000 if isinstance(w, str) else w for w in changed(rng, a, rng.randint(0, 35))]
        pairs.append((np.array(a, np.int64), np.array(b, np.int64)))
    for (a, b), got in zip(pairs, order_minhash.similarities(pairs, 0.8), strict=True):
        longer = max(len(a), len(b))
        exact = 1 - edits(a, b) / longer
        if exact >= 0.8 - 1e-9:
            assert got == pytest.approx(exact)
        else:
            assert got is None


def test_sketch_keeps_order_and_occurrences():
    one = order_minhash.word_hashes("a b c d e f g h i j k l m n o p")[0]
    assert order_minhash.sketch(one) == order_minhash.sketch(one.copy())
    twice = np.concatenate((one, one))
    assert len(order_minhash.sketch(twice)) == order_minhash.SKETCHES
    assert order_minhash.sketch(one[:4]) is None
    turned = np.concatenate((one[8:], one[:8]))
    assert order_minhash.sketch(turned) != order_minhash.sketch(one)


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(200, x) for x in range(201, 240)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for link in links for x in link}
    for _ in range(len(links)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


@pytest.mark.parametrize("small", [12, 2, 1])
def test_classes(spark, monkeypatch, small):
    monkeypatch.setattr(order_minhash, "SMALL", small)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(70)]
    texts = {}
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        for _ in range(rng.randint(1, 8)):
            texts[len(texts)] = " ".join(changed(rng, base, rng.randint(0, 5)))
    for _ in range(30):  # unlike texts around one passage
        texts[len(texts)] = " ".join([rng.choice(vocabulary) for _ in range(60)] + shared + [rng.choice(vocabulary) for _ in range(60)])
    texts[len(texts)] = texts[0].upper() + "  "
    texts |= {900: "a b", 901: "A  b", 902: "a c", 903: "", 904: None, 905: " \n", 906: "one two three four five", 907: "one two three four five"}
    rows = [(k, t) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as class_id", "text as words")
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(docs).collect()}
    words = {k: (t or "").lower().split() for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = words[a], words[b]
            same = bool(x) and x == y
            longer = max(len(x), len(y))
            if not same and min(len(x), len(y)) >= 5 and min(len(x), len(y)) >= 0.8 * longer:
                shared_kmers = {*zip(*(x[n:] for n in range(5)))} & {*zip(*(y[n:] for n in range(5)))}
                same = bool(shared_kmers) and edits(x, y) <= 0.2 * longer + 1e-9
            if same:
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    assert got == {k: find(k) for k in texts}


def test_first_of_class(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(5, text, "x"), (3, text + " more", "y"), (4, "other", None)], "doc_id long, text string, class_id string")
    out = order_minhash.first_of_class(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 4]


def replaced(rng, words, share):
    """``share`` of the words replaced at random places."""
    words = list(words)
    for at in rng.sample(range(len(words)), round(share * len(words))):
        words[at] = f"n{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("last", [True, False])
def test_a_hub_and_its_variants_are_one_class(spark, last):
    rng = random.Random(3)
    hub = [f"w{rng.randrange(5000)}" for _ in range(300)]
    texts = [replaced(rng, hub, 0.12) for _ in range(400)]
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, hub] if last else [hub, *texts])]
    got = order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 401


@pytest.mark.parametrize("share, least", [(0.1, 0.99), (0.15, 0.98), (0.2, 0.9)])
def test_pairs_at_the_limit_are_found(spark, share, least):
    rng = random.Random(8)
    rows = []
    for pair in range(200):
        base = [f"p{pair}w{rng.randrange(10**6)}" for _ in range(rng.choice([100, 300, 1000]))]
        rows += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(replaced(rng, base, share)))]
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    joined = sum(got[2 * p + 1] == 2 * p for p in range(200))
    assert joined >= least * 200
    assert all(got[2 * p] == 2 * p for p in range(200))


def test_string_and_null_keys(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("b", text), ("a", text + " more"), (None, text), (None, text), ("c", None), ("d", "x")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = [(r.doc_id, r.class_id) for r in order_minhash.near_classes(docs).collect()]
    assert sorted(got, key=str) == sorted([("b", "a"), ("a", "a"), (None, None), (None, None), ("c", "c"), ("d", "d")], key=str)
    assert order_minhash.first_of_class(docs).count() == 5
    assert order_minhash.near_classes(docs.limit(0)).collect() == []


def test_members_unlike_the_lead_of_their_buckets_are_linked(spark):
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(40)]

    def around(own):
        return own[:30] + passage + own[30:]

    texts = [around([f"w{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(200)]
    pairs = []
    for _ in range(40):
        own = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        # every third of the own words replaced, so that no k-mer is common but those of the passage
        other = [f"n{rng.randrange(10**6)}" if n % 3 == 1 else w for n, w in enumerate(own)]
        pairs.append((len(texts), len(texts) + 1))
        texts += [around(own), around(other)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    made = {n: {*order_minhash.sketch(order_minhash.word_hashes(rows[n][1])[0])} for p in pairs for n in p}
    agreeing = [p for p in pairs if made[p[0]] & made[p[1]]]
    assert len(agreeing) >= 30
    assert [p for p in agreeing if got[p[1]] != p[0]] == []
    assert all(got[n] == n for n in range(200))


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_alike_leaves_out_no_pair(spark, least):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(60)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 40))]
        texts += [changed(rng, base, rng.randint(0, len(base) // 4)) for _ in range(4)]
    texts = [t for t in texts if len(t) >= 5]
    rows = [(n, n // 2, (order_minhash.word_hashes(" ".join(t))[0] >> np.uint64(32)).astype("<u4").tobytes()) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "node long, root long, words binary")
    got = [(r.a, r.b) for r in order_minhash.alike(df, least).collect()]
    assert len(got) == len(set(got)) and all(a < b and a // 2 != b // 2 for a, b in got)
    must = set()
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            longer = max(len(texts[a]), len(texts[b]))
            if a // 2 != b // 2 and edits(texts[a], texts[b]) <= (1 - least) * longer + 1e-9:
                must.add((a, b))
    assert len(must) > 40 and must <= set(got)
