"""Near copies that share none of their least hashes, or lie beyond the bounds of the first pass, are joined all the same."""

import random
from itertools import combinations

import numpy as np
import pytest

from ticklore.llm import simhash_dedup as s


def rows(seed=5, groups=12):
    """Texts with some words changed in place, so that similarities lie around the bound."""
    r, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(r.choice([60, 160, 400]))]
        for _ in range(4):
            w = list(base)
            for at in r.sample(range(len(w)), max(1, len(w) * r.choice([15, 20, 25]) // 1000)):
                w[at] = f"x{r.randrange(10**9)}"
            out.append((len(out), " ".join(w) + " a very common ending of all these texts"))
    return out


def by_hand(texts, similarity):
    sets = {d: set(s.shingle_set(t.encode(), 5).tolist()) for d, t in texts}
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {d: top(d) for d in sets}


@pytest.mark.parametrize("keys,wide,part", [(1, 26, 2000), (8, 0, 2000), (1, 0, 7)])
def test_no_pair_is_lost(spark, monkeypatch, keys, wide, part):
    """The first pass may miss what it will: here nearly all."""
    monkeypatch.setattr(s, "KEYS", keys)
    monkeypatch.setattr(s, "WIDE", wide)
    monkeypatch.setattr(s, "PART_ROWS", part, raising=False)
    texts = rows()
    want = by_hand(texts, 0.8)
    assert 12 < len(set(want.values())) < len(texts)
    got = {r.doc_id: r.component_id for r in s.near_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == want


def test_pair_without_a_common_least_hash(spark):
    """The words under the least hashes of one text are changed in the other: far above the bound, and none of the 8 least is shared."""
    words = [f"w{i}" for i in range(604)]
    hashes = np.array([s.shingle_set(" ".join(words[i : i + 5]).encode(), 5)[0] for i in range(600)])
    other = list(words)
    for i in np.argsort(hashes)[: s.KEYS]:
        other[i + 2] = f"x{i}"
    a, b = (s.shingle_set(" ".join(w).encode(), 5) for w in (words, other))
    both = len(np.intersect1d(a, b))
    assert not len(np.intersect1d(a[: s.KEYS], b[: s.KEYS])) and both >= 0.8 * (len(a) + len(b) - both)
    got = s.near_dedup(spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, "far off")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_parities_are_a_bound():
    r = np.random.default_rng(3)
    for n, m in ((0, 5), (40, 60), (3000, 2800)):
        pool = np.unique(r.integers(0, 1 << 63, n + m, dtype=np.uint64))
        a, b = pool[: n + m // 2], pool[n // 2 :]
        apart = int(np.bitwise_count(s.parities(a) ^ s.parities(b)).sum())
        assert apart <= len(np.setxor1d(a, b))
        for x, y in ((512, 512), (4096, 512), (1024, 8192)):
            assert s.bits_apart(s.parities(a, x), s.parities(b, y)) == s.bits_apart(s.parities(a, min(x, y)), s.parities(b, min(x, y))) <= len(np.setxor1d(a, b))
