"""SimHash near-dedup against all pairs, and the claims its filter rests on."""

import random

import brute
import numpy as np
import pytest

from hirelens.llm import base, simhash_ring


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents(documents, pairs):
    got, want = rows(simhash_ring.near_duplicates(documents)), sorted(brute.simhash_rows(pairs), key=str)
    assert got == want
    assert any(i != c for i, _, c in got)


def test_edges(make):
    """Null, empty and wordless texts link; short ones are one shingle; repeated rows, a null doc_id, a text of 200,000 words."""
    long = " ".join(str(k % 77_777) for k in range(200_000))
    docs = [(5, None), (6, ""), (7, " \n\t"), (8, "One"), (9, "one"), (10, "one two"), (11, "one two three"), (11, "one two three"), (None, "one two three"), (None, "alone here now"), (12, long), (13, long + " end"), (14, "é É x\xa0y")]
    clash = {c: "clash" for c in ("print", "key", "component", "fingerprint", "id")}
    got = rows(simhash_ring.near_duplicates(make(docs, clash)))
    assert got == sorted(brute.simhash_rows(docs), key=str)
    assert {i: c for i, _, c in got if i in (5, 6, 7, 8, 9, 12, 13)} == {5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 12: 12, 13: 12}
    assert simhash_ring.near_duplicates(make([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 254, 255, 256, 1000])
def test_bit_counts(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert simhash_ring.bit_counts(hashes).tolist() == [sum(int(h) >> k & 1 for h in hashes) for k in range(64)]


def ball(rng, centre, reach, n):
    """Prints around a centre, of up to reach turned bits out of 20."""
    places = rng.sample(range(64), 20)
    for _ in range(n):
        x = centre
        for k in rng.sample(places, rng.randint(0, reach)):
            x ^= 1 << k
        yield x


def prints_of(seed):
    rng = random.Random(seed)
    made = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for reach, n in ((3, 300), (6, 300), (10, 300)):
        made |= set(ball(rng, rng.getrandbits(64), reach, n))
    for x in list(made)[:60]:  # pairs at 3 and 4 bits, across the ends of segments too
        for many in (1, 2, 3, 4):
            y = x
            at = rng.randrange(64)
            for k in range(many):
                y ^= 1 << (at + k * rng.choice([1, 1, 16])) % 64
            made.add(y)
    return sorted(made)


@pytest.mark.parametrize(("seed", "hot", "block", "ask"), [(1, 10_000, 4096, 1024), (2, 4, 4096, 1024), (3, 4, 7, 5), (4, 0, 3, 2)])
def test_links_lose_nothing(spark, seed, hot, block, ask, monkeypatch):
    """Whatever counts as a hot key, and however small the blocks, components are those of all pairs."""
    for name, value in (("HOT", hot), ("BLOCK", block), ("ASK", ask)):
        monkeypatch.setattr(simhash_ring, name, value)
    prints = prints_of(seed)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    parts = simhash_ring.links(spark.createDataFrame([(x,) for x in signed], "print bigint"), base.Scratch(spark, "test"))
    named = {r.id: r.component for r in parts.collect()}
    groups = {}
    for x in signed:
        groups.setdefault(named.get(x, x), []).append(x)
    low = dict(zip(signed, brute.near_prints(list(enumerate(prints))), strict=True))
    want = {}
    for x in signed:
        want.setdefault(low[x], []).append(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_the_ring_has_a_start():
    """Of any two prints within three bits one has the other's key among those it asks for, and both budgets hold there."""
    rng = random.Random(7)
    turn = lambda x, k: (x << 16 * k | x >> 64 - 16 * k) & (1 << 64) - 1
    for _ in range(20_000):
        d = 0
        for k in rng.sample(range(64), rng.randint(0, 3)):
            d |= 1 << k
        found = [k for k in range(4) if all((turn(d, k) >> 64 - 16 * n).bit_count() <= n * 3 // 4 for n in (1, 2, 3, 4))]
        assert found


@pytest.mark.parametrize("few", [-1, simhash_ring.FEW])
def test_what_grows_is_not_broadcast(make, few, monkeypatch):
    """Files of a table may be small where its rows are many: only a known number of hot keys is broadcast."""
    plans, write = {}, base.Scratch.write

    def seen(self, df, name, *rest):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return write(self, df, name, *rest)

    monkeypatch.setattr(base.Scratch, "write", seen)
    monkeypatch.setattr(simhash_ring, "HOT", 2)
    monkeypatch.setattr(simhash_ring, "FEW", few)
    docs = [(k, " ".join(str(k if n == 99 else n) for n in range(200))) for k in range(300, 360)]
    found = simhash_ring.near_duplicates(make(docs))
    plans["found"] = found._jdf.queryExecution().sparkPlan().toString()
    assert rows(found) == sorted(brute.simhash_rows(docs), key=str)
    wide = {name for name, plan in plans.items() if "Broadcast" in plan}
    assert wide <= ({"near", "led", "hot_rows", "rest"} if few > 0 else set())
    assert all("SortMergeJoin" in plans[name] for name in ("near", "hot_rows", "named", "by_print", "found"))
