"""Exact dedup, line dedup and SimHash near-dedup against brute force."""

import hashlib
import itertools
import random
import re

import pytest
import xxhash
from llm_rows import by_id, docs  # noqa: F401  docs is a fixture
from planekit.llm.components import connected_components
from planekit.llm.exact_dedup import build_directory, dedup_exact
from planekit.llm.line_dedup import LineRuns, dedup_lines
from planekit.llm.simhash import fingerprint_edges, near_duplicates, simhash, trie_self_join
from pyspark.sql import functions as F

WS = " \t\n\x0b\x0c\r"
COLS = ("keep_id", "group_size", "kept", "text_sha256")


def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({ord(c): None for c in WS}), []).append((i, t or ""))
    out = {}
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))[0]
        for i, _ in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


@pytest.mark.parametrize("kw", [{}, {"hash_bits": 3, "capacity": 2, "buffer_bytes": 100}, {"capacity": 1, "hash_bits": 8}])
def test_exact_matches_brute_force(docs, kw):
    rng = random.Random(5)
    base = ["a b", "ab", " a\tb\n", "é é", "éé", "", None, " ", "x" * 50_000, " a b"]
    rows = [(i, rng.choice(base) if i % 3 else "".join(rng.choice("ab c\n") for _ in range(rng.randrange(6))))
            for i in range(150)]
    got = by_id(dedup_exact(docs(rows).repartition(7), **kw), *COLS)
    assert got == exact_brute(rows)


def test_exact_ties_repeats_nulls_and_empty_table(docs):
    rows = [(4, "x y"), (4, "x y"), (None, "xy "), (2, "x  y"), (None, None)]
    got = dedup_exact(docs(rows)).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 2
    assert {r.keep_id for r in got if r.group_size == 4} == {2}
    alone = [r for r in got if r.group_size == 1]
    assert alone[0].doc_id is None and alone[0].keep_id is None and alone[0].kept
    assert dedup_exact(docs([])).collect() == []
    twice = [r.kept for r in dedup_exact(docs([(4, "x"), (4, "x")])).collect()]
    assert sorted(twice) == [False, True]


def test_directory_splits_until_buckets_fit(spark):
    entries = spark.range(3000).select(F.xxhash64("id").alias("h"))
    buckets = build_directory(entries, 40, 20)
    hashes = [r.h & (2**64 - 1) for r in entries.collect()]
    sizes = [sum(h >> (64 - d) == p if d else True for h in hashes) for p, d in buckets]
    assert sum(sizes) == 3000 and max(sizes) <= 40
    assert sum(2.0**-d for _, d in buckets) == 1.0
    assert build_directory(entries.where("false"), 40, 20) == [(0, 0)]
    assert max(d for _, d in build_directory(entries.select(F.lit(7).cast("long").alias("h")), 40, 6)) == 6


def lines_brute(rows, min_docs=5, min_chars=40):
    holders = {}
    key = lambda x: re.sub("[A-Z]", lambda m: m.group().lower(), x.strip(WS))
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders.setdefault(key(x), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


@pytest.mark.parametrize("kw", [{}, {"n_batches": 1}, {"n_batches": 7, "fanout": 3}])
def test_lines_match_brute_force(docs, kw):
    rng = random.Random(2)
    pool = [c * 40 for c in "abcdéf"] + [c * 39 for c in "gh"] + ["É" + "x" * 39, "é" + "x" * 39, "short", "", " " * 50]
    rows = [(i, "\n".join(rng.choice((str.upper, str, lambda x: f" \t{x}\r"))(rng.choice(pool))
                          for _ in range(rng.randrange(1, 6)))) for i in range(80)] + [(90, None), (91, "")]
    assert by_id(dedup_lines(docs(rows), **kw), "n_lines", "n_dropped", "text") == lines_brute(rows)


def test_lines_null_ids_repeats_and_empty_table(docs):
    line = "z" * 45
    rows = [(i, line) for i in range(4)] + [(3, f"{line}\n{line}")] + [(None, line)] * 3
    assert all(r.n_dropped == 0 for r in dedup_lines(docs(rows)).collect())  # four documents only
    got = dedup_lines(docs(rows + [(7, line)])).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_dropped) for r in got) == [
        (-1, 0), (-1, 0), (-1, 0), (0, 1), (1, 1), (2, 1), (3, 1), (3, 2), (7, 0)]
    assert dedup_lines(docs([])).collect() == []


def test_runs_keep_first_keeper_and_compact(spark):
    runs = LineRuns(spark, fanout=2)
    for batch in ([(b"a", 2, 9), (b"b", 1, 8)], [(b"a", 1, 5)], [(b"b", 1, 4), (b"c", 1, 3)]):
        runs.add(spark.createDataFrame([(bytearray(k), n, d) for k, n, d in batch], "key binary, n_docs long, keeper long"))
    assert [len(level) for level in runs.levels] == [1, 1]
    got = {(bytes(r.key), r.n_docs, r.keeper) for r in runs.totals().collect()}
    assert got == {(b"a", 3, 9), (b"b", 2, 8), (b"c", 1, 3)}


def simhash_brute(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_brute(nodes, bits=4):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= bits:
            root[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), set()).add(n)
    return {frozenset(g) for g in groups.values()}


def near_fingerprints(n, spread, seed):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(4)]
    out = set()
    while len(out) < n:
        x = rng.choice(centers)
        for _ in range(rng.randrange(spread)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("n, spread", [(1, 2), (7, 3), (300, 3), (500, 9), (600, 30)])
def test_trie_join_matches_all_pairs(n, spread):
    fps = near_fingerprints(n, spread, n)
    groups = {}
    for fp, root in zip(fps, trie_self_join(fps)):
        groups.setdefault(root, set()).add(fp)
    assert {frozenset(g) for g in groups.values()} == component_brute(fps)
    assert trie_self_join([]) == []


@pytest.mark.parametrize("split_above", [1 << 18, 8])
def test_distributed_join_matches_all_pairs(spark, split_above):
    fps = near_fingerprints(400, 8, 3)
    signed = [x - ((x >> 63) << 64) for x in fps]
    edges = fingerprint_edges(spark.createDataFrame([(x,) for x in signed], "fp long"), split_above=split_above)
    groups = {}
    for r in connected_components(edges).collect():
        groups.setdefault(r.root, set()).add(r.node & (2**64 - 1))
    want = {g for g in component_brute(fps) if len(g) > 1}
    assert {frozenset(g) for g in groups.values()} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 200)] + [(300, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 200)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_fingerprints_and_components_of_documents(docs):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long), (3, long.upper()), (9, long.replace("w150 ", "")), (1, "one two"), (2, "one  TWO\n"),
            (7, None), (8, ""), (6, " \t"), (4, "É é"), (None, "one two"), (10, "a b c d e"), (10, "a b c d e")]
    got = near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault(i, simhash_brute(t))
        assert simhash((t or "").encode()) == simhash_brute(t)
    assert all((r.fp & (2**64 - 1)) == want[r.doc_id] for r in got if r.doc_id is not None)
    groups = component_brute(sorted({simhash_brute(t) for _, t in rows}))
    for r in got:
        group = next(g for g in groups if (r.fp & (2**64 - 1)) in g)
        assert r.component_id == min(i for i, t in rows if i is not None and simhash_brute(t) in group)
    assert near_duplicates(docs([])).collect() == []
