"""Hard-negative mining, quality rules and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import by_id, docs  # noqa: F401  docs is a fixture
from planekit.llm import hard_negatives as hn
from planekit.llm import quality_rules as qr
from planekit.llm.hard_negatives import Leaders, Residues, mine_hard_negatives, primes_for, share_of
from planekit.llm.quality_rules import judge_quality, order_rules
from planekit.llm.spelling import KdTree, group_variants, near_words
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<double>, label string, q string, row string, score string, id string"


def brute(rows, every, n_pos=5, n_neg=10, low=30, high=90, scale=256):
    live = [(i, [int(np.floor(scale * x)) for x in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  zip: missing components are zeros
    out = []
    for i, v, y in live:
        if i % every:
            continue
        own = sorted((-dot(v, w), j) for j, w, z in live if z == y and j != i)[:n_pos]
        for p, j in own:
            near = sorted((-dot(v, w), k) for k, w, z in live if z != y and low * -p <= 100 * dot(v, w) <= high * -p)
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(near[:n_neg])]
    return sorted(out)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], VECTORS).repartition(3)
    got = mine_hard_negatives(df, F.col("vec_id") % every == 0, **kw)
    return sorted(tuple(r) for r in got.collect())


def test_residue_product_is_exact():
    rng = np.random.default_rng(4)
    for bound, width in ((3, 1), (1000, 64), (1 << 28, 64), (1 << 20, 700)):
        a, b = rng.integers(-bound, bound + 1, (7, width)), rng.integers(-bound, bound + 1, (9, width))
        a[0], b[0] = bound, -bound
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        field = Residues(primes_for(width * bound * bound))
        assert field.product(field.of(a), field.of(b)).tolist() == want


def test_shares_round_as_the_inequalities_do():
    for p in (0, 1, 99, 100, 101, 12345, -7, -100, (1 << 62) - 5):
        down, up = share_of(np.array([p]), 90)[0][0], share_of(np.array([p]), 30)[1][0]
        assert 100 * int(down) <= 90 * p < 100 * (int(down) + 1)
        assert 100 * (int(up) - 1) < 30 * p <= 100 * int(up)


def test_leaders_keep_the_best_of_all_blocks():
    rng = np.random.default_rng(5)
    scores, ids = rng.integers(0, 6, (4, 500)), rng.permutation(500)
    ok = rng.random((4, 500)) < 0.7
    best = Leaders(4, 10)
    for k in range(0, 500, 60):
        best.offer(np.arange(4), scores[:, k:k + 60], ids[k:k + 60], ok[:, k:k + 60].copy())
    for r in range(4):
        want = sorted((-s, i) for s, i, k in zip(scores[r].tolist(), ids.tolist(), ok[r]) if k)[:10]
        assert list(zip((-best.scores[r]).tolist(), best.ids[r].tolist())) == want


@pytest.mark.parametrize("wave_bytes", [hn.WAVE_BYTES, 400])
def test_negatives_match_brute_force(spark, wave_bytes):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0.1, 0.4, 6).round(2)], str(i % 3)) for i in range(120)]
    rows += [(200 + i, rows[3][1], str(i % 2)) for i in range(30)]  # copies under other ids: ties
    assert mined(spark, rows, 10, wave_bytes=wave_bytes) == brute(rows, 10)


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.5], "a"), (1, [0.9, 0.5], "a"), (2, [0.5, 0.5], "b"), (3, None, "a"), (4, [1.0, 0.5], None),
            (5, [float("nan"), 1.0], "b"), (6, [float("inf"), 1.0], "b"), (7, [None, 1.0], "b"), (None, [0.6, 0.1], "b"),
            (8, [0.6], "b"), (9, [], "b"), (10, [1e300, 0.0], "b"), (11, [0.7, 0.2, 0.1], "b")]
    want = brute([r for r in rows if r[0] != 10], 10)
    assert mined(spark, rows, 10) == want and {r[3] for r in want} == {2, 8, 11}


def test_anchor_rows_that_repeat_have_lists_of_their_own(spark):
    rows = [(0, [1.0], "a"), (1, [1.0], "a"), (2, [0.5], "b")]
    assert mined(spark, rows + rows[:1], 10) == sorted(brute(rows, 10) * 2)


def test_tables_without_rows_or_anchors(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, [1.0], "a"), (2, [1.0], "a")], 10) == []
    assert mined(spark, [(0, [1.0], "a")], 10) == []


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, inside = Counter(zip(words, words[1:], words[2:])), set()
    for i in range(len(words) - 2):
        if n[tuple(words[i:i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(inside))


TEXTS = [None, "", " \t\n", "one", "a b c", "a b c a b c", "a a a a", "x\x0by\x0cz\rw", "ä𝕏 # $\n\nä𝕏 # $\nä𝕏 # $ ", "a b   c",
         "p q r s p q r t p q", " ".join(str(i) for i in range(20000)), "spam and eggs " * 5000, "\n".join(["- point of order"] * 40),
         "word " * 60, "this line ends ...\n" * 3 + " ".join(f"w{i}ord" for i in range(60))]


def test_measures_match_brute_force(spark, docs):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[6]), (3, TEXTS[6])]
    got = judge_quality(docs(rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    assert sorted((r.doc_id, *(r[c] for c in names)) for r in got) == sorted((i, *counts(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.rejected_by is None) and not (r.base_failed and r.kept)


def test_each_rule_rejects_its_own_case(spark, docs):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    cases = {"few_words": "a few words", "repeated_words": "over and over again " * 20, "symbols": clean + " #" * 10,
             "word_length": " ".join(f"{'y' * 12}{i}" for i in range(80)), "letters": clean + " 1234" * 25,
             "dup_lines": clean + "\nand so on\nand so on\nand so on\nand so on",
             "bullets": "\n".join(f"-{w}" for w in clean.split()), "placeholder": clean + " Lorem Ipsum dolor",
             "ellipsis": clean + " ...\n" + clean[::-1] + "…\nend of it", None: clean}
    cases["letters"] = " ".join(f"{w} {i}{i}{i}" for i, w in enumerate(clean.split(), 100))
    names = list(cases)
    got = by_id(judge_quality(docs(list(enumerate(cases.values())))), "rejected_by", "kept")
    assert {names[i]: v[0] for i, v in got.items()} == {n: n for n in names}
    assert [i for i, v in got.items() if v[1]] == [names.index(None)]


def test_order_goes_by_rejection_per_cost():
    sets = [(frozenset("ab"), 50), (frozenset("c"), 30), (frozenset("b"), 5), (frozenset(), 100)]
    # a rejects most per cost; then b is left with five documents only
    assert order_rules({"a": 1.0, "b": 1.5, "c": 2.0}, sets) == ["a", "c", "b"]
    assert order_rules({"a": 9.0, "b": 1.0, "c": 2.0}, sets) == ["b", "c", "a"]
    assert order_rules({}, []) == []


def test_verdicts_do_not_depend_on_the_order(spark, docs):
    frame = qr.measure(docs(list(enumerate(TEXTS))).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    runs = [by_id(qr.apply_cascade(frame, order), "kept") for order in (list(qr.RULES), list(qr.RULES)[::-1])]
    assert runs[0] == runs[1]


def test_quality_of_an_empty_table_and_without_python_workers(spark, docs):
    assert judge_quality(docs([])).collect() == []
    plan = judge_quality(docs([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows):
    """The contract's result by dictionaries and all pairs."""
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: sorted((-n[v], v) for v in n if one_edit(v, w)) for w in n}
    form = {w: v[0][1] if v and -v[0][0] >= 2 * n[w] else None for w, v in near.items()}

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def grouped(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def prose(rng, letters, words, length):
    """Texts of words and one-letter slips of them."""
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, length))) for _ in range(words)]
    out = []
    for k, w in enumerate(base):
        texts = [w] * rng.randint(1, 40)
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            texts += [rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])] * rng.randint(1, 9)
        out.append((k, " ".join(texts)))
    return out


@pytest.mark.parametrize("letters,words,box,sample", [
    ("abcdeéÿ", 60, 16384, 1000), ("ab", 40, 7, 1000), ("abc×Z", 60, 20, 5), ("abcdefghijklmnop", 80, 30, 100_000)])
def test_variants_match_all_pairs(spark, docs, letters, words, box, sample):
    rows = prose(random.Random(len(letters) + box), letters, words, 9)
    rows += [(None, "null identified words null identified words"), (7, None), (8, ""), (8, "1 2 !"), (3, rows[3][1])]
    assert grouped(group_variants(docs(rows), box=box, sample=sample)) == variants(rows)


def test_variants_follow_long_chains_and_long_words(spark, docs):
    chain = [("a" * k + "b" * (9 - k), 3 * 2 ** k) for k in range(8)]
    giant = "".join(random.Random(1).choice("abcdefg") for _ in range(2_000))
    rows = [(1, " ".join(w for w, k in chain for _ in range(k))), (2, " ".join([giant] * 8 + [giant[:777] + giant[778:]] * 3))]
    got = grouped(group_variants(docs(rows)))
    assert got == variants(rows) and len({r[2] for r in got if len(r[0]) < 99}) == 1


def test_variants_of_anagrams_do_not_meet_pair_by_pair(spark, docs):
    # all words share two count vectors
    rng = random.Random(2)
    words = ["".join(rng.sample("abcdefgh", 8)) for _ in range(300)] + ["".join(rng.sample("abcdefgx", 8)) for _ in range(300)]
    rows = [(1, " ".join(words * 3)), (2, " ".join(words[:50] * 9))]
    assert grouped(group_variants(docs(rows), box=64)) == variants(rows)


def test_variants_of_nothing(spark, docs):
    assert group_variants(docs([])).collect() == [] and group_variants(docs([(1, None), (2, "a b c")])).collect() == []


def test_tree_reach_equals_a_scan():
    rng = np.random.default_rng(8)
    points = np.unique(rng.integers(0, 3, (400, 8)).astype(np.int32), axis=0)
    queries = rng.integers(0, 3, (60, 8)).astype(np.int32)
    for regions in (False, True):
        tree = KdTree(points, 8, regions)
        assert sorted(np.concatenate(tree.members).tolist()) == list(range(len(points)))
        home = tree.place(points)
        assert all((home[m] == leaf).all() for leaf, m in enumerate(tree.members))
        for up, down in ((1, 1), (1, 0), (0, 1)):
            got = {(int(q), int(r)) for leaf, idx in tree.reach(queries, up, down) for q in idx for r in tree.members[leaf]}
            diff = points[None] - queries[:, None]
            want = (np.maximum(diff, 0).sum(2) <= up) & (np.maximum(-diff, 0).sum(2) <= down)
            assert set(zip(*map(np.ndarray.tolist, np.nonzero(want)))) <= got


def test_near_words_are_exactly_one_edit_apart():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abc") for _ in range(n)) for n in (5, 6, 7) for _ in range(120)})
    by = {n: [w for w in words if len(w) == n] for n in (5, 6, 7)}
    for a, b in ((5, 6), (6, 6), (7, 6)):
        got = [(by[a][i], by[b][j]) for block in near_words(by[a], by[b]) for i, j in block]
        assert sorted(got) == sorted((x, y) for x in by[a] for y in by[b] if one_edit(x, y))
