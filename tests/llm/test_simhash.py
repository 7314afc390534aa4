"""SimHash: fingerprints, the plan, and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from waybill.llm import components, queries, simhash
from waybill.llm.components import connected


def slow_fingerprint(text, n=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {i: " " for i in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or (
        [" ".join(words)] if words else []
    )
    if not shingles:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, radius=4):
    fps = np.array(sorted(set(fps)), np.uint64)
    up = list(range(len(fps)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius):
            up[top(i)] = top(i + 1 + int(j))
    return {int(f): top(i) for i, f in enumerate(fps)}


def expected(rows):
    fp = {k: slow_fingerprint(t) for k, t in enumerate(t for _, t in rows)}
    parts = slow_components(fp.values())
    least = {}
    for k, (doc, _) in enumerate(rows):
        c = parts[fp[k]]
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted((repr(doc), f"{fp[k]:016x}", repr(least.get(parts[fp[k]]))) for k, (doc, _) in enumerate(rows))


def found(df):
    rows = df.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("f"), "component_id").collect()
    return sorted((repr(r.doc_id), r.f, repr(r.component_id)) for r in rows)


def texts():
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(300)]
    rows = [(None, None), (3, ""), (2, " \n"), (9, "One"), (8, "one"), (7, "a b c"), (None, "a b c")]
    for i in range(150):  # near copies of one text
        copy = base[:]
        for _ in range(random.randint(0, 6)):
            copy[random.randrange(300)] = random.choice(words)
        rows.append((100 + i, " ".join(copy)))
    for i in range(60):
        rows.append((300 + i, " ".join(random.choices(words, k=random.randint(1, 200)))))
    rows += [(500, "same " * 30_000), (501, "SAME\x0b" * 30_000), (500, "same " * 30_000)]
    return rows


def test_against_brute_force(spark, docs_of):
    rows = texts()
    docs = docs_of([(d, t, "s") for d, t in rows])
    assert found(simhash.near_duplicates(docs)) == expected(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({slow for _, _, slow in expected(rows)} | set())


@pytest.mark.parametrize("run", [2, 16, 8192])
def test_blocks_of_hot_values(spark, monkeypatch, run):
    """Values with many nodes are cut into blocks without losing a link."""
    monkeypatch.setattr(simhash, "RUN", run)
    random.seed(run)
    center = random.getrandbits(64)
    fps = {center}
    for _ in range(300):
        x = random.choice(sorted(fps))
        for _ in range(random.randint(1, 5)):
            x ^= 1 << random.randrange(64)
        fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    nodes = spark.createDataFrame(signed, "fp bigint")
    roots = {r.node % (1 << 64): r.root for r in connected(simhash.links(nodes)).collect()}
    parts = slow_components(fps)
    groups, mine = {}, {}
    for f in fps:
        groups.setdefault(parts[f], set()).add(f)
        mine.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_plan_is_a_pigeonhole():
    """Thresholds + 1 sum to radius + 1 over disjoint partitions, at every size."""
    rng = np.random.default_rng(0)
    bits = (rng.random((500, 64)) < np.linspace(0.05, 0.95, 64)).astype(float)
    bits[:, 1] = bits[:, 0]
    both = bits.T @ bits
    seen = set()
    for n in (500, 10**6, 10**9, 10**12):
        plan = simhash.plan_partitions(n, both * (n / 500), 4)
        used = [b for g, _ in plan for b in g]
        assert len(used) == len(set(used))
        assert sum(e + 1 for _, e in plan) == 5
        seen.add(tuple(e for _, e in plan))
    assert len(seen) > 1  # more fingerprints, larger balls in fewer partitions


@pytest.mark.parametrize("n", [10**7, 10**10])
def test_unequal_thresholds_lose_nothing(spark, monkeypatch, n):
    """Plans for larger tables (thresholds above 0) find the same components."""
    monkeypatch.setattr(simhash, "bit_moments", lambda nodes: (n, np.full((64, 64), n / 4) + np.eye(64) * n / 4))
    random.seed(n % 97)
    fps = {random.getrandbits(64) for _ in range(40)}
    for f in sorted(fps)[:20]:
        x = f
        for _ in range(4):
            x ^= 1 << random.randrange(64)
        fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    roots = {r.node % (1 << 64): r.root for r in connected(simhash.links(spark.createDataFrame(signed, "fp bigint"))).collect()}
    parts = slow_components(fps)
    assert len({roots.get(f, f) for f in fps}) == len(set(parts.values()))


def test_query_and_empty(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in queries.op2_simhash(spark, sf).collect())
    assert got == expected(rows)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5, 5)]
    rows = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in rows} == {
        **{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1301)}
    }
    assert len(rows) == 502


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    random.seed(12)
    pairs = [(random.randint(-400, 400), random.randint(-400, 400)) for _ in range(350)]
    pairs += [(i, i + 1) for i in range(1000, 1300)] + [(7, 7), (5000, 5000)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    root = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in range(400):
        for a, b in pairs:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert sorted(map(tuple, connected(links).collect())) == sorted(root.items())
