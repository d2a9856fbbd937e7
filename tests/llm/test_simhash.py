import numpy as np
import pytest
import xxhash

from stormgrid.llm.simhash import (
    bucket_links, components, drop_near_copies, fingerprint_batch, fingerprint_links, near_groups,
)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def classes(numbers, radius=3):
    up = {n: n for n in numbers}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    some = sorted(up)
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {n: top(n) for n in some}


def near_numbers(seed, n, groups):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(groups):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
        for _ in range(n):
            out.add(x)
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                x ^= 1 << int(b)
    return sorted(out)


def test_fingerprints():
    texts = ["", "a", "a b", "a b c d e f g", "The the THE É é", "x " * 700]
    assert fingerprint_batch([t.encode() for t in texts]).tolist() == [fingerprint(t) for t in texts]
    assert fingerprint_batch([]).tolist() == []


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_links_of_a_bucket(radius):
    numbers = np.array(near_numbers(radius, 30, 8), np.uint64)
    keys = np.sort(np.arange(len(numbers)) % 3)
    u, v = bucket_links(keys, numbers.view(np.int64), radius)
    up = {}
    for a, b in zip(u.view(np.uint64).tolist(), v.view(np.uint64).tolist()):
        assert (a ^ b).bit_count() <= radius
        up.setdefault(a, set()).add(b)
    for k in range(3):
        own = numbers[keys == k].tolist()
        expected = classes(own, radius)
        assert sum(n != r for n, r in expected.items()) == sum(a in own for a in u.view(np.uint64).tolist())


@pytest.mark.parametrize("bucket_rows", [2048, 20, 3])
def test_links_are_whole_at_any_bucket_size(spark, bucket_rows):
    numbers = near_numbers(9, 40, 12) + list(range(40))
    numbers = sorted(set(numbers))
    nodes = spark.createDataFrame([(signed(n),) for n in numbers], "fp long")
    roots = {r["u"]: r["root"] for r in components(fingerprint_links(nodes, 3, bucket_rows)).collect()}
    expected = classes(numbers)
    groups, mine = {}, {}
    for n in numbers:
        groups.setdefault(expected[n], set()).add(n)
        mine.setdefault(roots.get(signed(n), signed(n)), set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {}
    for r in components(spark.createDataFrame(links, "u long, v long")).collect():
        found.setdefault(r["root"], set()).add(r["u"])
    assert sorted(map(len, found.values())) == [60, 61]


def test_groups_against_brute_force(awkward):
    rows = awkward.collect()
    root = classes({fingerprint(r["text"]) for r in rows})
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            k = root[fingerprint(r["text"])]
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    found = near_groups(awkward).collect()
    assert len(found) == len(rows)
    wanted = sorted((r["doc_id"] or -1, signed(fingerprint(r["text"])), least[root[fingerprint(r["text"])]]) for r in rows)
    assert sorted((r["doc_id"] or -1, r["fp"], r["component_id"]) for r in found) == wanted


def test_one_row_of_each_component_stays(awkward):
    out = drop_near_copies(awkward)
    assert out.columns == awkward.columns
    root = classes({fingerprint(r["text"]) for r in awkward.collect()})
    kept = [root[fingerprint(r["text"])] for r in out.collect()]
    assert sorted(kept) == sorted(set(root.values()))


def test_empty_table(nothing):
    assert near_groups(nothing).count() == 0
    assert drop_near_copies(nothing).count() == 0
