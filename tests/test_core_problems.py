"""Caps, components, splits and near-duplicates against brute force, and their defined cases."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quernix.operators.caps import cap_contributors
from quernix.operators.components import connected_components
from quernix.operators.neardup import SignatureJoin, expand_pairs, near_duplicate_classes, near_duplicate_groups
from quernix.operators.splits import assign_splits

CAPS = "id string, g string, q double, cut string, rank int"


def brute_cap(rows, cap):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    kept = list(by.pop(None, []))
    for rs in by.values():
        known = lambda q: q is not None and q == q
        kept += sorted(rs, key=lambda r: (not known(r[2]), -r[2] if known(r[2]) else 0, r[0]))[:cap]
    return sorted(r[0] for r in kept)


@pytest.mark.parametrize("cap", [0, 1, 3, 50])
def test_cap_equals_brute_force(spark, cap):
    rng = random.Random(cap)
    qs = [None, float("nan"), 0.0, -0.0, 1.0, 1.0, 0.5, -3.0, 1e12, -1e12]
    rows = [(f"i{k:04d}", rng.choice(["hot"] * 8 + ["a", "b", "c", None]), rng.choice(qs + [rng.random()]), "x", k) for k in range(600)]
    got = cap_contributors(spark.createDataFrame(rows, CAPS), ["g"], cap, "q", "id", bins=16)
    assert got.columns == ["id", "g", "q", "cut", "rank"]
    assert sorted(r.id for r in got.collect()) == brute_cap(rows, cap)


def test_cap_share_repeated_and_empty(spark):
    rows = [("a", "g", 1.0, "x", 1)] * 6 + [("b", "h", None, None, None)] * 4
    df = spark.createDataFrame(rows, CAPS)
    assert Counter(r.g for r in cap_contributors(df, ["g"], None, "q", "id", share=0.2).collect()) == {"g": 2, "h": 2}
    assert cap_contributors(df.where("false"), ["g"], 3, "q", "id").count() == 0
    with pytest.raises(ValueError):
        cap_contributors(df, ["g"], -1, "q", "id")


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    n = 120
    edges = [(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(70)] + [(f"c{k}", f"c{k + 1}") for k in range(40)] + [("hub", f"h{k}") for k in range(60)]
    edges += [(None, "n1"), ("n2", None), ("n3", "n3")] + edges[:5]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            ra, rb = root(a), root(b)
            up[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    want = {x: root(x) for x in up}
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_splits_keep_entities_together(spark):
    rng = random.Random(1)
    rows = []
    for k in range(4000):
        author = None if k % 9 == 0 else "giant" if k % 10 < 2 else f"au{rng.randrange(900)}"
        rows.append((f"r{k}", author, None if k % 7 else f"src{rng.randrange(2000)}", "old", "c"))
    df = spark.createDataFrame(rows, "id string, author string, source string, split string, component string")
    out = assign_splits(df, {"author": F.col("author"), "source": F.col("source")}, "id", {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()
    assert len(out) == len(rows)
    for e in ("author", "source"):
        seen = defaultdict(set)
        for r in out:
            if r[e] is not None:
                seen[r[e]].add(r.split)
        assert all(len(s) == 1 for s in seen.values())
    share = Counter(r.split for r in out)
    assert abs(share["train"] / len(rows) - 0.8) < 0.04 and abs(share["test"] / len(rows) - 0.1) < 0.04


def test_splits_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None)], "id string, e string")
    out = assign_splits(df, {"e": F.col("e")}, "id", {"train": 1.0, "test": 1.0}).collect()
    assert len(out) == 3 and len({r.split for r in out if r.id == "a"}) == 1
    assert assign_splits(df.where("false"), {"e": F.col("e")}, "id", {"train": 1.0}).count() == 0


def _grams(text, width):
    from quernix.functions.words import words

    w = words(text)
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


@pytest.mark.parametrize("width,similarity", [(3, 0.6), (5, 0.8)])
def test_near_duplicates_equal_brute_force(spark, width, similarity):
    rng = random.Random(width)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for d in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        rows.append((f"d{d:03d}", " ".join(base)))
        for v in range(rng.randrange(4)):
            other = list(base)
            for _ in range(rng.randrange(0, 9)):
                at = rng.randrange(len(other))
                other[at : at + rng.randrange(2)] = [rng.choice(vocabulary)]
            rows.append((f"d{d:03d}v{v}", " ".join(other)))
    rows += [("copy1", rows[0][1].upper() + "!"), ("copy2", rows[0][1]), ("copy2", rows[0][1]), ("short", "one two"), ("none", None), ("blank", " ​"), (None, rows[0][1])]
    c = SignatureJoin(width=width, similarity=similarity, hot=6)
    members, links = near_duplicate_classes(spark.createDataFrame(rows, "id string, text string"), "id", F.col("text"), c)
    got = {(r.id_a, r.id_b) for r in expand_pairs(members, links).collect()}
    sets = {i: _grams(t, width) for i, t in rows if i and t}
    ids = sorted(i for i, s in sets.items() if s)
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}
    assert got == want
    groups = near_duplicate_groups(members, links).collect()
    assert {r.id for r in groups} == set(ids)
    by = {r.id: r.class_id for r in groups}
    assert all(by[a] == by[b] for a, b in want)


def _signature_rows(spark, lanes):
    return spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(lanes)], "h bigint, lanes binary")


def test_pair_that_shares_one_hot_key_is_kept(spark):
    import numpy as np

    from quernix.operators.neardup import candidate_pairs, chunk_keys

    c = SignatureJoin(similarity=0.6, hot=2)
    lanes = np.tile(np.random.default_rng(4).integers(0, 2**15, (1, c.lanes), dtype=np.uint16), (3, 1))
    for k in (1, 2):
        lanes[k, c.chunk_lanes - 1] += k
        for chunk in range(1, c.chunks):
            lanes[k, chunk * c.chunk_lanes + 2 * k - 2 : chunk * c.chunk_lanes + 2 * k] += k
    keys = chunk_keys(lanes, c)
    assert all((keys[0] == keys[k]).sum() == 1 for k in (1, 2))
    got = {(r.a, r.b) for r in candidate_pairs(_signature_rows(spark, lanes), c).collect()}
    assert {(0, 1), (0, 2)} <= got


@pytest.mark.parametrize("block", [3, 1000])
def test_hot_places_equal_brute_force(spark, block):
    import numpy as np

    from quernix.operators.neardup import candidate_pairs, chunk_keys

    c = SignatureJoin(similarity=0.6, hot=5, block=block)
    rng = np.random.default_rng(block)
    lanes = np.tile(rng.integers(0, 2**15, (1, c.lanes), dtype=np.uint16), (60, 1))
    off = rng.random(lanes.shape) < 0.3
    lanes[off] = rng.integers(2**15, 2**16, off.sum(), dtype=np.uint16)
    keys = chunk_keys(lanes, c)
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if (keys[a] == keys[b]).any() and (lanes[a] != lanes[b]).sum() <= c.most_distance}
    rows = candidate_pairs(_signature_rows(spark, lanes), c).collect()
    got = {(r.a, r.b) for r in rows}
    assert len(rows) == len(got) and all(a < b for a, b in got)
    assert {(a, b) for a, b in got if (lanes[a] != lanes[b]).sum() <= c.most_distance} == want


def test_near_duplicates_of_nothing(spark):
    members, links = near_duplicate_classes(spark.createDataFrame([], "id string, text string"), "id", F.col("text"), SignatureJoin())
    assert members.count() == 0 and links.count() == 0


def test_sure_distance_is_guaranteed():
    import numpy as np

    from quernix.operators.neardup import chunk_keys

    c = SignatureJoin()
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 2**16, (1, c.lanes), dtype=np.uint16)
        b = a.copy()
        off = rng.choice(c.lanes, c.sure_distance, replace=False)
        b[0, off] += 1
        assert (chunk_keys(a, c) == chunk_keys(b, c)).any()


def test_likely_rows_hold_all_wanted(spark):
    from quernix.operators.skew import keep_likely

    big = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit("x").alias("__x"))
    wanted = spark.range(0, 20_000, 50).select(F.concat(F.lit("k"), "id").alias("id")).unionByName(spark.createDataFrame([(None,), ("k0",)], "id string"))
    got = keep_likely(big.unionByName(spark.createDataFrame([(None, "x")], "id string, __x string")), "id", wanted)
    ids = {r.id for r in got.collect()}
    assert got.columns == ["id", "__x"] and {r.id for r in wanted.collect() if r.id} <= ids and len(ids) < 4_000
    assert keep_likely(big, "id", wanted.where("false")).count() == 0


def test_key_bitmap_has_every_key(spark):
    import numpy as np

    from quernix.operators.neardup import key_bitmap

    keys = [0, 1, -1, 5, 32_767, 32_768, -(2**63), 2**63 - 1, *random.Random(3).sample(range(-(2**60), 2**60), 3000)]
    bits = key_bitmap(spark.createDataFrame([(k,) for k in keys], "key bigint"))
    at = np.array(keys, dtype=np.int64) & np.int64(8 * len(bits) - 1)
    assert ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1).all()
    assert 0 < np.unpackbits(bits).sum() <= len(keys)


def test_share_of_a_contributor_of_one_quality(spark, monkeypatch):
    """A third of all rows are of one contributor and one reward; the cap is beyond what a window may rank."""
    from quernix.operators import caps

    monkeypatch.setattr(caps, "WINDOW_CAP", 20)
    rng = random.Random(3)
    rows = [("hot", 1.0, f"t{k:05d}") for k in range(500)] + [(f"c{k % 9}", rng.choice([0.0, 1.0, None, float("nan")]), f"u{k:05d}") for k in range(1000)]
    rows += [(None, 1.0, "x")]
    df = spark.createDataFrame(rows, "c string, q double, id string").repartition(7)
    got = {r.id for r in caps.cap_contributors(df, ["c"], None, "q", "id", share=0.05).collect()}
    cap, want = int(0.05 * len(rows)), {"x"}
    for c in {r[0] for r in rows} - {None}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is None or r[1] != r[1], -(r[1] or 0.0) if r[1] == r[1] else 0.0, r[2]))
        want |= {r[2] for r in own[:cap]}
    assert got == want


def test_many_cutoffs_are_joined_once(spark, monkeypatch):
    """Beyond the cutoffs that are broadcast, what a cap gives has no join left in it, which would move all rows a second time."""
    from quernix.operators import caps

    monkeypatch.setattr(caps, "BROADCAST_CUTS", 0)
    rng = random.Random(5)
    qs = [None, float("nan"), 0.0, 1.0, 1.0, 0.5, rng.random()]
    rows = [(f"i{k:04d}", rng.choice(["hot"] * 8 + ["a", "b", "c", None]), rng.choice(qs), "x", k) for k in range(600)]
    got = caps.cap_contributors(spark.createDataFrame(rows, CAPS), ["g"], 3, "q", "id")
    assert sorted(r.id for r in got.collect()) == brute_cap(rows, 3)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_pinned_components_stay(spark):
    from quernix.operators.splits import placements

    of = {"train": 0.5, "test": 0.5}
    rows = [(f"r{k}", f"g{k % 40}") for k in range(400)]
    df = lambda rs: spark.createDataFrame(rs, "id string, g string")
    first = assign_splits(df(rows), {"g": F.col("g")}, "id", of)
    pins = placements(first)
    before = {r.component: r.split for r in pins.collect()}
    more = rows + [(f"n{k}", "g1") for k in range(300)] + [(f"m{k}", f"h{k % 30}") for k in range(300)]
    after = assign_splits(df(more), {"g": F.col("g")}, "id", of, pinned=pins).collect()
    assert len(after) == len(more) and all(before.get(r.component, r.split) == r.split for r in after)
    assert 0.35 < sum(r.split == "train" for r in after) / len(more) < 0.65
