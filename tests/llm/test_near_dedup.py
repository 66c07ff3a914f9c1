"""Near-duplicates against brute force over all pairs."""

import random
import re
from collections import defaultdict

import pytest
from llm_rows import rows_of

from loamline.llm import near_dedup


def brute(rows):
    """(doc_id, n_shingles, component_id, kept), from all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), c := least[root(i)], rows[i][0] == c) for i in range(len(rows))]


def edited(r, words, share):
    return [f"{w}{r.randrange(10**6)}" if r.random() < share else w for w in words]


def families():
    """Large groups of copies with edits of their own, families within a group, and chains at the threshold."""
    r = random.Random(5)
    texts = []
    for n, copies, share in ((120, 60, 0.028), (60, 40, 0.02), (200, 60, 0.05)):
        core = [f"w{r.randrange(400)}" for _ in range(n)]
        texts += [" ".join(edited(r, core, share)) for _ in range(copies)]
        for _ in range(3):  # families: each has an edited core
            own = edited(r, core, 0.06)
            texts += [" ".join(edited(r, own, share / 3)) for _ in range(copies // 3)]
    core = [f"c{k}" for k in range(150)]
    texts += [" ".join(core[k : k + 100]) for k in range(0, 50, 2)]
    r.shuffle(texts)
    return list(enumerate(texts))


def test_equals_brute_force(spark):
    rows = families()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_chain_of_a_thousand_texts(spark):
    """Each text is similar enough to its neighbours alone."""
    texts = [" ".join(f"c{k}" for k in range(10 * i, 10 * i + 100)) for i in range(1000)]
    rows = list(enumerate(texts))
    random.Random(7).shuffle(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 1000 and all((x.n_shingles, x.component_id, x.kept) == (97, 0, x.doc_id == 0) for x in got)


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_a_search(spark, seed):
    """Paths, stars, cycles, a bare pair and random links with names in any order."""
    r = random.Random(seed)
    links = [(i, i + 1) for i in range(300)] + [(400, 401 + i) for i in range(60)] + [(500 + i, 500 + (i + 1) % 9) for i in range(9)] + [(600, 601), (601, 600), (600, 600)]
    links += [(700 + r.randrange(200), 700 + r.randrange(200)) for _ in range(110)]
    links += [(1000 + i // 4, 1000 + i) for i in range(1, 100)]
    names = r.sample(range(10**6), 1200)
    links = [(names[a], names[b]) for a, b in links]
    want = {}
    for a, b in links:
        if a != b:
            both = want.get(a, {a}) | want.get(b, {b})
            want.update(dict.fromkeys(both, both))
    got = {x.k: x.root for x in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got) == set(want)
    groups = defaultdict(set)
    for k, root in got.items():
        groups[root].add(k)
    assert all(root in group and group == want[root] for root, group in groups.items())


def test_odd_rows(odd):
    rows = [(x.doc_id, x.text) for x in odd.collect()]
    got = near_dedup.near_duplicates(odd).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_empty_table(none):
    assert near_dedup.near_duplicates(none).collect() == []


def test_keep_one_keeps_whole_rows_one_of_each_group(odd):
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    found = brute([(x.doc_id, x.text) for x in odd.collect()])
    with_words = {c for _, n, c, _ in found if n}
    got = rows_of(kept)
    assert sum(bool(re.search(r"[^\x20\x09-\x0D]", x[1] or "")) for x in got) == len(with_words)
    assert {x[0] for x in got} >= with_words - {None}
