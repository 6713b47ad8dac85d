"""Personal data, license scans, URL filters and decontamination against brute force."""

import random
import re
from collections import Counter

import pytest
from llm_rows import by_id, docs  # noqa: F401  docs is a fixture
from planekit.llm import url_filter
from planekit.llm.decontaminate import decontaminate, judge
from planekit.llm.license_scan import TEMPLATES, longest_increasing, patience, scan_licenses, words_in
from planekit.llm.pii import find_personal_data, spans_text
from pyspark.sql import functions as F

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_brute(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255
                    or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = find_personal_data(df).select("doc_id", spans_text(F.col("base")).alias("b"), spans_text(F.col("further")).alias("f"))
    return by_id(rows, "b", "f")


def test_base_spans_match_brute_force(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("0123456789.+-@ ()aZ_é😀%\n") for _ in range(rng.randrange(300))) for _ in range(300)]
    texts += [None, "", "300.1.2.3.4.5.6.7", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "x@y", "+1 (456) 555-2186 or +49 30 1234567",
              "4111111111111111 4111-1111-1111-1111 4111111111111112", "000255.0.0.00 256.1.1.1", "1" * 40,
              "a" * 20_000, "1 " * 5_000, " ".join(["4111111111111111x"] * 300), "1.2.3.4," * 500, "😀😀 a@b.cd"]
    got = found(spark, texts)
    assert [t for i, t in enumerate(texts) if got[i][0] != base_brute(t)] == []


def test_further_kinds_need_checksum_or_context(spark):
    got = found(spark, ["GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32", "call 415-555-1234 now",
                        "415-555-1234", "my SSN: 123-45-6789", "SSN 000-45-6789", "123-45-6789", "phone +1 415-555-1234"])
    assert [got[i][1] for i in range(8)] == ["iban:0:27", "", "national_phone:5:17", "", "ssn:8:19", "", "", ""]
    assert got[7][0] == "phone:6:21"


def test_personal_data_empty_table_and_clashes(docs):
    assert find_personal_data(docs([])).collect() == []
    got = find_personal_data(docs([(None, "a@b.cd"), (1, None), (1, "a@b.cd")])).collect()
    assert sorted(len(r.base) for r in got) == [0, 1, 1]


def lis_brute(values):
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] += max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    return max(best, default=0)


def test_longest_increasing_matches_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        values = rng.sample(range(50), rng.randrange(12))
        kept = [values[k] for k in longest_increasing(values)]
        assert kept == sorted(kept) and len(kept) == lis_brute(values)


def test_patience_is_a_common_subsequence_with_all_lis_anchors():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(15))] for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        once, once2 = Counter(a), Counter(b)
        anchors = [b.index(w) for w in a if once[w] == 1 == once2[w]]
        if not pairs or (a[:1] != b[:1] and a[-1:] != b[-1:]):
            assert len(pairs) >= lis_brute(anchors)
        assert patience(a, a) == [(i, i) for i in range(len(a))]


def test_license_scan(docs):
    mit = TEMPLATES["MIT"]
    edited = mit.replace("free of charge", "gratis").replace("without restriction", "with no restriction")
    filler = " ".join(f"word{i}" for i in range(3000)) + " of the and to by under "
    rows = [(1, f"{filler}{mit}\n{filler}"), (2, edited), (3, f"{mit}\n{mit}"), (4, filler), (5, None), (6, ""),
            (7, "LICENSED under the\nApache License, version 2.0!"), (8, " ".join(mit.split()[:12])),
            (9, f"{TEMPLATES['CC-BY-NC-4.0']} {mit}"), (None, mit)]
    got = by_id(scan_licenses(docs(rows)), "license", "coverage", "found")
    assert [got[i][0] for i in (1, 3, 7, 9, None)] == ["MIT", "MIT", "Apache-2.0", "MIT", "MIT"]
    assert got[1][1] == 1.0 and (got[1][2][0]["first"], got[1][2][0]["end"]) == (3006, 3006 + len(words_in(mit)))
    assert got[2][0] == "MIT" and 0.8 <= got[2][1] < 1.0
    assert [f["license"] for f in got[9][2]] == ["MIT", "CC-BY-NC-4.0"]
    assert all(got[i] == (None, 0.0, []) for i in (4, 5, 6, 8))
    assert scan_licenses(docs([])).collect() == []


def urls_brute(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after).group()
    return host.translate(FOLD), re.match(r"[^?#]*", after[len(host):]).group()


def rule_brute(host, path):
    best = None
    for verdict, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(h + p), h + p, verdict))
    return best[1:] if best else (None, None)


def test_hosts_paths_and_rules(spark):
    urls = ["http://a.NET/x", "https://net", "https://net/", "http://xnet/", "ftp://b.example.net/en/1?q#f", "http://example.net/en",
            "http://m.example.com/de/7", "http://example.com/de", "http://w.org/fr/a", "http://org/fr/", "http://É.Org?x/fr/",
            "http://h#f/x", "nourl", "", None, "://", "a://b://c/d", "http://u:p@h.net:80/en/", "http://h//x\ny?z"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns(
        {"host": F.lit("clash"), "form": F.lit("clash"), "node": F.lit("clash")})
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = urls_brute(u)
        rule, verdict = rule_brute(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")


def test_template_tree(spark):
    rows = [("h", f"/shop/{i}", "block") for i in range(12)] + [("h", f"/news/{i}.html", "allow") for i in range(12)]
    rows += [("h", "/shop/999", None), ("h", "/news/888.html", None), ("h", "/misc/deadbeef01", None)]
    rows += [("v", f"/user/{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}x", "block") for i in range(64)] + [("e", "", None)]
    df = spark.createDataFrame(rows, "host string, path string, label string")
    got = {(r.host, r.form): r for r in url_filter.templates(df).collect()}
    assert got["h", "shop/{n}"].rejected and not got["h", "news/{n}.html"].rejected
    assert got["h", "shop/{n}"].template == "/shop/{n}" and got["h", "misc/{x}"].purity == 0.5
    assert {r.template for (h, _), r in got.items() if h == "v"} == {"/user/*"}
    assert not got["e", ""].rejected
    assert url_filter.templates(df.where("false")).collect() == []
    deep = spark.createDataFrame([("h", "/a/b/c/d/e/f/g/h", None)], "host string, path string, label string")
    assert url_filter.templates(deep).first().form == "a/b/c/d/e/**"


def test_labels_spread_to_like_branches_only(spark):
    few = [("few", f"/{'abcdefgh'[i % 8]}{'ijklm'[i // 8]}/{n}", "block" if i == 3 else None)
           for i in range(40) for n in range(10)]
    many = [("many", f"/user/{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}x/{n}", None if i < 3 else "block")
            for i in range(64) for n in range(2)]
    like = [("like", f"/{s}/{n}", label) for s, label in
            (("bad", "block"), ("worse", "block"), ("good", "allow"), ("new", None)) for n in range(20)]
    df = spark.createDataFrame(few + many + like, "host string, path string, label string")
    got = {}
    for r in url_filter.templates(df).collect():
        got.setdefault(r.host, {})[r.form] = (r.template, r.rejected)
    # one blocked section of forty blocks no other
    assert [f for f, (_, rejected) in got["few"].items() if rejected] == ["di/{n}"]
    # sixty-one blocked branches that agree speak for three like them without labels
    assert set(got["many"].values()) == {("/user/*/{n}", True)}
    # the host's other pages do not keep a blocked branch from being rejected, nor is a new one blocked
    assert {f for f, (_, rejected) in got["like"].items() if rejected} == {"bad/{n}", "worse/{n}"}


def test_unlabelled_pages_pull_purity_and_no_depth_is_cut(spark):
    rows = [("h", f"/x/{i}", "block") for i in range(20)] + [("h", f"/x/{i}", None) for i in range(100)]
    got = url_filter.templates(spark.createDataFrame(rows, "host string, path string, label string")).first()
    assert got.purity == 72 / 124 and not got.rejected
    urls = [f"http://m.example.com/{top}/b/c/d/e/f/g/{leaf}" for top in ("de", "a") for leaf in ("p", "q")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert {r.template for r in url_filter.judge_urls(pages).collect()} >= {"/a/b/c/d/e/f/g/p", "/a/b/c/d/e/f/g/q"}


def words_brute(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def judge_brute(rows, bench, width=13):
    windows = {}
    for item, text in bench:
        w = words_brute(text)
        for i in range(max(0, len(w) - width) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    out = {}
    for doc, text in rows:
        w, hit, items = words_brute(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    items |= owners
        ids = sorted(map(str, items))
        out[doc] = (len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_contamination_matches_brute_force(spark, docs, threshold):
    rng = random.Random(9)
    vocab = ["the", "Of", "É", "é", "x1", "ab", "MÜ"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "\n"]) for _ in range(n))
    bench = [(i, text(rng.choice([2, 3, 13, 14, 30]))) for i in range(8)] + [(90, None), (91, "..."), (10, "solo")]
    bench.append((11, bench[3][1]))
    rows = []
    for i in range(40):
        planted = bench[rng.randrange(8)][1]
        rows.append((i, f"{text(20)} {planted if i % 2 else ''} {text(rng.randrange(300))}"))
    rows += [(100, None), (101, ""), (102, "SOLO"), (103, bench[2][1].lower())]
    items = spark.createDataFrame(bench, "item_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = judge(docs(rows), items)
        assert by_id(got, "n_words", "n_hit", "items", "contaminated") == judge_brute(rows, bench)
        stay = {r.doc_id for r in decontaminate(docs(rows), items).collect()}
        assert stay == {i for i, r in judge_brute(rows, bench).items() if not r[3]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_contamination_repeats_null_ids_and_empty_tables(spark, docs):
    passage = " ".join(f"p{i}" for i in range(13))
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(1, passage), (1, "clean text"), (1, passage), (None, passage), (None, "clean")]
    got = judge(docs(rows), items).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in got) == [("1", 0), ("1", 13), ("1", 13), ("None", 0), ("None", 13)]
    assert sorted(r.text for r in decontaminate(docs(rows), items).collect()) == ["clean", "clean text"]
    assert judge(docs([]), items).collect() == []
    assert [r.contaminated for r in judge(docs(rows), items.where("false")).collect()] == [False] * 5
