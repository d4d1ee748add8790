"""SimHash groups and benchmark leaks against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import components, decontamination, simhash

DOCS = "doc_id long, text string, fp string, key int, leaks string"


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(n)]
    out = list(base)
    for t in base[: n // 2]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        out += [" ".join(w), t.upper() + "\t\n"]
    return out + [None, "", " \x1f ", "\x85 one", "two words"]


def test_fingerprints_follow_the_definition():
    for t in texts(1, 40) + ["É ÀB\x0bc\x0cd e  f", "a " * 500]:
        assert simhash.fingerprint(t) == brute.simhash(t)


def test_components_equal_all_pairs(spark):
    rows = [(None if i == 3 else i * 2 % 101, t, "f", 1, "l") for i, t in enumerate(texts(2, 60))]
    rows += [rows[5], (rows[6][0], "another text of the same id", "f", 1, "l")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 4).collect()
    fps = [brute.simhash(r[1]) for r in rows]
    root = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, c in zip(rows, root):
        ids = [x for x in (least.get(c), r[0]) if x is not None]
        least[c] = min(ids, default=None)
    expect = sorted((str(r[0]), f, str(least[c])) for r, f, c in zip(rows, fps, root))
    assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in got) == expect


@pytest.mark.parametrize(("tile", "rows", "group"), [(16, 50, 4.0), (2048, 200_000, 0.01), (2, 7, 1e9)])
def test_links_in_dense_groups(spark, monkeypatch, tile, rows, group):
    """Clusters far above the tile size, and other numbers of blocks, give the same components."""
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "ROWS", rows)
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 64, (25, 2))}
    fps = sorted(fps | {int(x) for x in rng.integers(0, 1 << 63, 150, dtype=np.uint64)})
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    edges = simhash.link_edges(spark.createDataFrame(signed, "fp long"), 4, len(fps))
    linked = {r.node & (1 << 64) - 1: r.root for r in components.connected_components(edges).collect()}
    root = brute.components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    groups = {}
    for f, c in zip(fps, root):
        groups.setdefault(c, []).append(f)
    for own in groups.values():
        assert len({linked.get(f, f) for f in own}) == 1
    assert len({linked.get(f, f) for f in fps}) == len(groups)


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    fp = np.stack([a, b], 1).ravel()
    i, j = simhash.links_in_groups(np.repeat(np.arange(500), 2), np.zeros(1000, np.int64), fp, 4)
    assert sorted(i) == list(range(0, 1000, 2)) and (j == i + 1).all()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300)) and len(got) == 501
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_keeps_whole_rows(spark):
    rows = [(i, t, f"f{i}", i, "l") for i, t in enumerate(texts(4, 30))] + [(None, "alone with no id at all here", "f", 1, "l")]
    rows += [rows[3], (8, "the same id with quite another text", "g", 1, "l")]
    df = spark.createDataFrame(rows, DOCS)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    got = kept.collect()
    root = brute.components([brute.simhash(r[1]) for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, c in zip(rows, root):
        ids = [x for x in (least.get(c), r[0]) if x is not None]
        least[c] = min(ids, default=None)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(x) for x in least.values())  # one row of every component
    assert all(tuple(r) in rows for r in got)
    assert simhash.one_of_each(df.where("false")).count() == 0


def test_one_of_each_keeps_a_row_of_every_component(spark):
    """Null and repeated doc_ids name no group: each component keeps its smallest id, null last."""
    t = [" ".join(random.Random(i).choices([f"v{j}" for j in range(500)], k=30)) for i in range(9)]
    rows = [(None, t[0]), (None, t[1]), (None, t[2]), (None, t[2]),    # unrelated texts without an id, one of them twice
            (5, t[3]), (5, t[4]),                                      # one id for two texts
            (1, t[5]), (9, t[5]), (9, t[6]), (12, t[6]),               # the smallest id of t[6] lies in t[5]'s component too
            (None, t[7]), (7, t[7]), (-3, t[8]), (-3, t[8])]
    df = spark.createDataFrame([(i, x, "f", k, "l") for k, (i, x) in enumerate(rows)], DOCS).repartition(3)
    got = sorted((t.index(r.text), r.doc_id) for r in simhash.one_of_each(df).collect())
    assert got == [(0, None), (1, None), (2, None), (3, 5), (4, 5), (5, 1), (6, 9), (7, 7), (8, -3)]


def test_tiling_equals_trying_all_pairs():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice([0, 1, 2, -1]) if rng.random() < 0.3 else rng.randrange(6) for _ in range(rng.randrange(40))]
        b = [rng.randrange(6) for _ in range(rng.randrange(25))]
        a += b[6:] + b[:6]
        tiles = decontamination.greedy_tiles(a, b, 3)
        assert all(a[i:i + n] == b[j:j + n] for i, j, n in tiles)
        assert sorted((n for *_, n in tiles), reverse=True) == brute.tiling(a, b, 3)


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def leak_cases():
    w = ITEM.split()
    return [
        (1, f"before {ITEM} after", True), (2, "x " * 5000 + ITEM.upper() + " y" * 5000, True),
        (3, " ".join(["foo", *w[12:], "bar", *w[6:12], "baz", *w[:6]]), True),      # reordered
        (4, " ".join(w[:12]), True), (5, " ".join(w[:11]), False),                 # 12 and 11 of 20 words
        (6, " ".join(x for p in w for x in (p, "noise")), False),                  # every word, no seed
        (7, None, False), (8, "", False), (9, "!!! ... ???", False), (10, "short item", True),
        (11, ", ".join(w), True), (12, " ".join(w[:5]) + " gap " + " ".join(w[:5]) + " gap " + " ".join(w[:5]), False),
        (13, "Straße — çédille, naïve", True), (14, "nothing in common with the others at all", False)]


BENCH = [(100, ITEM), (101, "short item"), (102, None), (103, "..."), (104, ITEM), (None, "straße çédille NAÏVE")]


@pytest.mark.parametrize("broadcast_seeds", [2_000_000, 0])
def test_leaks(spark, broadcast_seeds):
    cases = leak_cases()
    docs = spark.createDataFrame([(k, t, "f", 1, "l") for k, t, _ in cases] + [(1, cases[0][1], "g", 2, "l")], DOCS)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = decontamination.contaminated(docs, bench, broadcast_seeds=broadcast_seeds).collect()
    assert {r.doc_id for r in rows} == {k for k, _, leak in cases if leak}
    assert sorted(str(r.item_id) for r in rows if r.doc_id == 1) == ["100", "100", "104", "104"]
    assert [str(r.item_id) for r in rows if r.doc_id == 13] == ["None"]
    third = next(r for r in rows if r.doc_id == 3 and r.item_id == 100)
    assert (third.covered, third.n_tiles, third.longest) == (20, 3, 8)
    kept = decontamination.decontaminated(docs, bench, broadcast_seeds=broadcast_seeds)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, _, leak in cases if not leak}


@pytest.mark.parametrize("broadcast_seeds", [2_000_000, 0])
def test_leaks_of_empty_tables(spark, broadcast_seeds):
    docs = spark.createDataFrame([(1, ITEM, "f", 1, "l")], DOCS)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontamination.contaminated(docs, bench.where("false"), broadcast_seeds=broadcast_seeds).count() == 0
    assert decontamination.contaminated(docs.where("false"), bench, broadcast_seeds=broadcast_seeds).count() == 0


def test_given_documents_against_plain_search(spark):
    """On the smallest given tables: the same (document, item) pairs as tiling every document with every item."""
    d = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "benchmark"))
    words = lambda t: decontamination.words_of((t or "").lower())
    items = [(r.item_id, words(r.text)) for r in bench.collect()]
    expect = set()
    for r in docs.where(F.length("text") < 20_000).collect():
        own = words(r.text)
        for item_id, w in items:
            if len(set(w) & set(own)) >= 0.6 * len(set(w)):
                number = {x: i for i, x in enumerate(dict.fromkeys(w))}
                tiles = brute.tiling([number.get(x, -1) for x in own], [number[x] for x in w], min(5, len(w)))
                if sum(tiles) >= 0.6 * len(w):
                    expect.add((r.doc_id, item_id))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs.where(F.length("text") < 20_000), bench).collect()}
    assert got == expect and expect


def test_one_of_each_with_map_columns(spark):
    rows = [(i % 2, "the same long text of several words", {"a": i, "b": None}, [{"k": i}]) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra map<string, int>, more array<map<string, int>>")
    got = simhash.one_of_each(df).collect()
    assert len(got) == 1 and got[0].doc_id == 0 and tuple(got[0]) in rows
