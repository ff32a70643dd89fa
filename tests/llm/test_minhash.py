import random

import numpy as np
from gaugeloft.llm.components import components
from gaugeloft.llm.minhash import NearDuplicates, bitmap, keep_one, lowest_estimate, minima, near_duplicates, packed_bits, similarity_of_bits
from gaugeloft.llm.queries import op3_minhash
from gaugeloft.llm.shingles import shingle_set

from tests_support import against_sql


def brute(rows, size, percent=80):
    """Links of all pairs by their plain sets, and what they reach."""
    def grams(text):
        words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None), doc == min(ids, default=None)))
    return sorted(out, key=str)


def run(df, **more):
    return sorted(map(tuple, near_duplicates(df, **more).collect()), key=str)


def edited(words, share, rng):
    return " ".join(rng.choice("abcdefghij") * 5 if rng.random() < share else w for w in words)


def test_chains_and_families(make_docs):
    rng = random.Random(3)
    rows = []
    for family in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(rng.randrange(1, 12)):
            rows.append((len(rows), " ".join(words)))
            words = edited(words, rng.choice([0.0, 0.02, 0.05]), rng).split()
    for size in (2, 5):
        assert run(make_docs(rows), shingle=size) == brute(rows, size)


def test_a_large_family_whose_members_differ(make_docs):
    rng = random.Random(5)
    base = [f"v{i}" for i in range(100)]
    rows = [(i, edited(base, 0.08, rng)) for i in range(150)]
    assert run(make_docs(rows), shingle=2) == brute(rows, 2)


def short_variants(rng, families=40, size=10):
    """Texts of 5 to 15 words: of each family, words are left out of and added to what came before."""
    rows = []
    for family in range(families):
        words = [f"f{family}w{i}" for i in range(15)]
        for _ in range(size):
            rows.append((len(rows), " ".join(sorted(rng.sample(words, rng.randrange(5, 16))))))
    return rows


def test_families_of_short_texts(make_docs):
    rows = short_variants(random.Random(11))
    assert run(make_docs(rows), shingle=1) == brute(rows, 1)


def test_bits_of_small_sets_turn_no_link_away():
    rng = np.random.default_rng(7)
    for small in (4, 8, 12, 16):
        for _ in range(100):
            whole = np.unique(rng.integers(0, 1 << 64, small * 5 // 4, dtype=np.uint64))
            part = np.sort(rng.permutation(whole)[:small])
            nibbles = [np.unpackbits(packed_bits(minima(s)).view(np.uint8)).reshape(-1, 4) for s in (whole, part)]
            equal = (nibbles[0] == nibbles[1]).all(axis=1).mean()
            assert (equal - 2.0**-4) / (1 - 2.0**-4) >= lowest_estimate(80)


def variants(rng, count, edits, vocabulary):
    """Texts of one family: each with its own edits, words of a given vocabulary; most pairs under the limit."""
    base = [f"v{i}" for i in range(160)]
    rows = []
    for i in range(count):
        words = list(base)
        for at in rng.sample(range(160), rng.choice(edits)):
            words[at] = f"e{rng.randrange(vocabulary)}"
        rows.append((i, " ".join(words)))
    return rows


def fast_brute(rows, size):
    """The same as ``brute`` by a matrix of which set has which shingle."""
    sets = [shingle_set(t, size) for _, t in rows]
    known = np.unique(np.concatenate(sets))
    held = np.zeros((len(sets), len(known)), dtype=np.float32)
    for i, s in enumerate(sets):
        held[i, np.searchsorted(known, s)] = 1
    n = held.sum(axis=1)
    least = np.arange(len(rows))
    links = []
    for i in range(len(rows)):
        common = held @ held[i]
        links.append(np.flatnonzero(100 * common >= 80 * (n + n[i] - common)))
    while True:
        now = np.array([least[found].min() for found in links])
        if (now == least).all():
            return {rows[i][0]: rows[least[i]][0] for i in range(len(rows))}, n
        least = now


def test_a_large_family_below_the_limit_makes_few_pairs(make_docs, monkeypatch):
    rng = random.Random(9)
    rows = variants(rng, 900, range(7, 9), 10**6)
    want, n = fast_brute(rows, 2)
    found = []
    crossing = NearDuplicates._crossing

    def counted(self, apart):
        pairs = crossing(self, apart)
        found.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(NearDuplicates, "_crossing", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(make_docs(rows), shingle=2).collect()}
    assert got == want and len(set(want.values())) > 300
    assert found and max(found)[0] < 10 * len(rows) and all(a == b for a, b in found)


def test_bitmaps_never_rule_a_link_out():
    rng = np.random.default_rng(3)
    for size in (3, 40, 300, 5000):
        for _ in range(30):
            whole = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            a, b = (np.sort(rng.permutation(whole)[: rng.integers(1, len(whole) + 1)]) for _ in range(2))
            apart = np.unpackbits((bitmap(a) ^ bitmap(b)).view(np.uint8)).sum()
            assert (len(a) + len(b) - apart) / 2 >= len(np.intersect1d(a, b))


def test_edits_of_few_words(make_docs):
    rng = random.Random(10)
    rows = variants(rng, 400, range(4, 16), 12)
    want, _ = fast_brute(rows, 2)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(make_docs(rows), shingle=2).collect()} == want


def test_odd_documents(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert run(odd_docs, shingle=2) == brute(rows, 2)
    assert run(make_docs([])) == []
    assert run(make_docs([(1, "x"), (2, None)])) == [(1, 1, 1, True), (2, 0, 2, True)]


def test_keep_one_keeps_the_columns(odd_docs, make_docs):
    kept = keep_one(odd_docs.withColumnRenamed("n_chars", "component"), shingle=5)
    assert kept.columns == ["doc_id", "text", "lang", "source", "component"]
    found = sorted(((r["doc_id"], (r["text"] or "")[:8]) for r in kept.collect()), key=str)
    assert [f for f in found if f[0] in (3, 4, 5, 6, 8, 9, 10)] == [(3, "one"), (4, "Élan vit"), (5, "same wor"), (8, "word0 an")]
    assert {(0, ""), (1, ""), (2, " \t\n "), (7, "a first "), (7, "a second"), (None, "a text w"), (None, "")} <= set(found)
    assert keep_one(make_docs([(1, "p q r s t u"), (1, "p q r s t u")])).count() == 1
    clash = make_docs([(1, "p q r s t u"), (2, "p q r s t u")]).withColumnsRenamed({"lang": "__id", "source": "__key", "n_chars": "id"})
    assert [(r["doc_id"], r["__id"]) for r in keep_one(clash).collect()] == [(1, None)]


def test_bits_estimate_the_similarity(spark):
    rng = np.random.default_rng(1)
    shared = [f"s{i}" for i in range(600)]
    rows = []
    for own in (0, 60, 200, 600):
        a, b = (set(shared) | {f"{x}{i}" for i in range(own)} for x in "ab")
        sets = [shingle_set(" ".join(sorted(s)), 1) for s in (a, b)]
        rows.append((*[packed_bits(minima(s)).tolist() for s in sets], len(a & b) / len(a | b)))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, truth double")
    for r in df.select("truth", similarity_of_bits("x", "y").alias("s")).collect():
        assert abs(r["s"] - r["truth"]) < 0.13
    assert 0.6 < lowest_estimate(80) < 0.7 and rng is not None


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 501), (501, 502), (502, 500)] + [(900, 900)]
    random.Random(2).shuffle(links)
    label = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(label.get(i, i) == 0 for i in range(41)) and all(label.get(100 + i, 100) == 100 for i in range(300))
    assert label[502] == 500 and 900 not in label


def test_query_equals_sql(spark):
    against_sql(spark, op3_minhash, "op3_minhash")
