"""Operators against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, components, decontamination, line_dedup, near_duplicates, nearest, quality, queries, sharding, substring_dedup, token_counts, url_filters
from millrace.llm.common import SplitHashes, window_hashes

DATA = "/root/testdata/sf0.001"
draw = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(40)] + ["Über", "é", "ñandú"]


def words(n):
    return [draw.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    base, shared = words(80), words(30)
    made = [" ".join(base)] * 3
    for _ in range(6):
        copy = list(base)
        copy[draw.randrange(80)] = "changed"
        made.append(" ".join(copy))
    made += ["", " \n\t", "one", "One", None, " ".join([*words(20), *shared, *words(9)]), " ".join([*shared, *words(40)]), " ".join(words(3000)), "x" * 50_000, "a\nb\na"]
    made += [" ".join(words(draw.randrange(1, 60))) for _ in range(30)]
    return list(enumerate(made))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "hash", 7, 1.0) for i, t in texts] + [(None, texts[0][1], "k", 8, 2.0), (0, texts[0][1], "hash", 7, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n_words int, score double").repartition(3)


def split(text):
    return (text or "").encode().split()


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()


def sets(texts, n):
    out = {}
    for i, t in texts:
        w = lowered(t)
        out[i] = {tuple(w[j : j + min(n, len(w))]) for j in range(len(w) - min(n, len(w)) + 1)} if w else set()
    return out


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(docs, texts, n):
    s = sets(texts, n)
    pairs = [(a, b) for a, b in itertools.combinations(s, 2) if 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]) and s[a]]
    want = roots(s, pairs)
    got = near_duplicates.near_duplicates(docs, n).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], len(s[r["doc_id"]]), want[r["doc_id"]] == r["doc_id"])
    kept = near_duplicates.deduplicated(docs, n)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in want if want[i] == i} | {None}


def test_blocks_of_many_small_sets(spark):
    """Many small sets that are all a little alike: blocks are bounded by their number too."""
    rows = [(i, f"thank you {i}") for i in range(2500)] + [(9000 + i, f"thank you {i} thank you") for i in range(3)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert got.where("not kept").count() == 0
    nodes = spark.createDataFrame([(True, 1, i, bytes(8)) for i in range(2500)], "big boolean, root long, node long, shingles binary")
    assert near_duplicates._blocks(nodes, "x").count() == 3


def test_components(spark):
    edges = [(9, 8), (8, 7), (7, 1), (3, 4), (5, 5), (None, 2)] + [(i, i + 1) for i in range(20, 60)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {9: 1, 8: 1, 7: 1, 4: 3} | {i: 20 for i in range(21, 61)}


def test_substring_dedup(docs, texts):
    starts = {}
    for i, t in texts:
        w = split(t)
        for j in range(len(w) - 12):
            starts.setdefault(tuple(w[j : j + 13]), set()).add(i)
    got = {r["doc_id"]: r for r in substring_dedup.without_repeats(docs).collect()}
    for i, t in texts:
        w = split(t)
        gone = {k for j in range(len(w) - 12) if min(starts[tuple(w[j : j + 13])]) < i for k in range(j, j + 13)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    assert got[None]["n_removed"] == 0
    assert substring_dedup.deduplicated(docs).columns == docs.columns


def test_substring_levels(spark, monkeypatch):
    """Levels double, end where nothing is repeated, and windows of equal first hashes are told apart."""
    assert substring_dedup.levels(13) == [7, 13] and substring_dedup.levels(100) == [7, 13, 25, 50, 100] and substring_dedup.levels(3) == [3]
    own = random.Random(4)
    some = lambda n: [f"u{own.randrange(10**9)}" for _ in range(n)]
    shared = some(60)
    texts = [(1, some(30) + shared), (2, shared[:40] + some(80)), (3, some(70)), (4, shared[20:] + some(5)), (5, shared[:8] + some(50))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    for window in (3, 13, 30, 100):
        starts = {}
        for i, w in texts:
            for j in range(len(w) - window + 1):
                starts.setdefault(tuple(w[j : j + window]), set()).add(i)
        want = {i: len({k for j in range(len(w) - window + 1) if min(starts[tuple(w[j : j + window])]) < i for k in range(j, j + window)}) for i, w in texts}
        assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.without_repeats(docs, window).collect()} == want
    seen = []
    monkeypatch.setattr(substring_dedup, "_runs", lambda *a, real=substring_dedup._runs: seen.append(a[-1]) or real(*a))
    apart = docs.where("doc_id in (3, 5)")
    assert {r["n_removed"] for r in substring_dedup.without_repeats(apart, 100).collect()} == {0} and seen == [7]
    # words that are equal modulo 2^64 as polynomials: their first hashes agree
    swap = str.maketrans("ab", "ba")
    x = "a"
    for _ in range(11):
        x += x.translate(swap)
    rest = " ".join(some(12))
    same = spark.createDataFrame([(1, f"{x} {rest}"), (2, f"{x.translate(swap)} {rest}"), (3, f"{x} {rest}")], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.without_repeats(same).orderBy("doc_id").collect()] == [0, 0, 13]


def test_substring_chunks(spark):
    """Windows of long copies are told by chunks, whichever document holds them first; the rest one by one."""
    own = random.Random(9)
    some = lambda n: [f"u{own.randrange(10**9)}" for _ in range(n)]
    a, b = some(300), some(200)
    c = [*a[:90], "new", *a[91:]]  # a near copy
    texts = [(7, a), (2, a + b), (9, c), (4, b[60:] + some(30)), (11, a), (12, c), (13, b + c + b), (14, a[:12]), (15, ["z"] * 400), (16, ["z"] * 90), (17, a[5:60])]
    for window in (3, 13, 60):
        starts = {}
        for i, w in texts:
            for j in range(len(w) - window + 1):
                starts.setdefault(tuple(w[j : j + window]), set()).add(i)
        docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string").repartition(2)
        got = {r["doc_id"]: r for r in substring_dedup.without_repeats(docs, window).collect()}
        for i, w in texts:
            gone = {k for j in range(len(w) - window + 1) if min(starts[tuple(w[j : j + window])]) < i for k in range(j, j + window)}
            kept = " ".join(x for k, x in enumerate(w) if k not in gone)
            assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (len(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = {r["doc_id"]: len(r["windows"]) for r in substring_dedup.repeats(docs.where("doc_id in (2, 11)"), 13).collect()}
    assert set(found) == {11} and found[11] < 60  # of 288 windows


def test_window_hashes_tell_windows_apart():
    h = SplitHashes()
    for n in (1, 2, 5, 7, 13):
        w = words(400)
        got = window_hashes(h.of(" ".join(w).encode()), n).tolist()
        want = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        assert len(got) == len(want) and len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_decontamination(spark, docs, texts, monkeypatch):
    def take(t):
        return decontamination.words_of((t or "").encode())

    items = [(1, texts[14][1]), (2, "one"), (None, " ".join(words(5))), (10, ""), (4, None), (12, texts[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for portion in (decontamination.PORTION, 20):
        got = {r["doc_id"]: r for r in decontamination.contamination(docs, bench, portion=portion).collect()}
        for i, t in texts:
            w, hit, found = take(t), set(), set()
            for item, text in items:
                v = take(text)
                k = min(13, len(v))
                windows = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
                for j in range(len(w) - k + 1):
                    if tuple(w[j : j + k]) in windows:
                        hit |= set(range(j, j + k))
                        found |= {str(item)} - {"None"}
            want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
            assert tuple(got[i])[1:] == want
    built = []
    monkeypatch.setattr(decontamination, "_searcher", lambda *a, real=decontamination._searcher: built.append(len(a[1])) or real(*a))
    kept = decontamination.decontaminated(docs, bench, spans=True)
    cut = {r["doc_id"]: r["text"] for r in kept.collect()}
    for i, t in texts:
        if not got[i]["contaminated"]:
            assert (cut[i] == t) if not got[i]["n_hit"] else (len(take(cut[i])) == got[i]["n_words"] - got[i]["n_hit"])
    assert len(built) == 1 and set(cut) == {i for i in got if not got[i]["contaminated"]}
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if not got[i]["contaminated"]}
    assert decontamination.without_spans("A b, c! d", [1, 3]) == "A ! d"


def test_lines_across_components(spark, monkeypatch):
    """Families of lines whose members are alike only in part: drawn pivots and the last check of all pairs leave no link out."""
    own = random.Random(5)
    lines = []
    for _ in range(6):
        base = "".join(own.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))
        for _ in range(12):
            x = list(base)
            for at in own.sample(range(300), own.randrange(1, 7)):
                x[at] = "#"
            lines.append("".join(x))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = []
    for each, few in ((line_dedup.EACH, 1), (0, 1), (0, 10**9)):  # 0: pivots are drawn first, as long as they link much or anything
        monkeypatch.setattr(line_dedup, "EACH", each)
        monkeypatch.setattr(line_dedup, "FEW", few)
        found.append([r["text"] for r in line_dedup.deduplicated(docs).orderBy("doc_id").collect() if r["text"]])
    # bands may miss a pair at the limit: what is joined is joined in the brute force, and hardly anything more is there
    want = kept_lines(lines)
    assert found[0] == found[1] == found[2] and {*want} <= {*found[0]} and len(found[0]) <= len(want) + 2


def test_line_sets():
    own = random.Random(6)
    lines = ["", "a", "ab", "abcd", "ABCDE", "abcde", "İi", "😀" * 7, "x" * 900, *("".join(own.choice("aB é日😀") for _ in range(own.randrange(1, 40))) for _ in range(200))]
    made = line_dedup.line_sets(lines)
    apart = [{*made[(made >> np.uint64(line_dedup.BITS)) == i].tolist()} for i in range(len(lines))]
    assert all(len(a) == len(every_set(x)) for a, x in zip(apart, lines, strict=True))
    x, y = [own.choice(lines) for _ in range(400)], [own.choice(lines) for _ in range(400)]
    want = [100 * len(every_set(a) & every_set(b)) >= 80 * len(every_set(a) | every_set(b)) for a, b in zip(x, y, strict=True)]
    assert line_dedup.similar_pairs(x, y, 80).tolist() == want and any(want)
    keys = line_dedup.band_keys(made, len(lines))
    assert keys.shape == (len(lines), line_dedup.BANDS) and (keys[4] == keys[5]).all()


def test_short_lines_meet():
    draw, meet = np.random.default_rng(3), []
    for _ in range(600):  # of 11 shingles 9 are common to both
        own = draw.permutation(np.arange(0x4E00, 0x4E00 + 20_000))[:14]
        line = "".join(map(chr, own))
        other = line[:-1] + chr(0x9000)
        _, x = line_dedup.keys_of([line])
        _, y = line_dedup.keys_of([other])
        meet.append(len(np.intersect1d(x >> line_dedup.PAYLOAD, y >> line_dedup.PAYLOAD)) > 0)
    assert np.mean(meet) > 0.98


def test_groups_of_bands():
    low = [0x111111, 0x111222, 0x222222, 0x111111, 0x333333, 0x111111, 0x444444]
    bands = np.array([(g << line_dedup.PAYLOAD) | p for g, p in zip([-5, -5, -5, 3, 3, 9, 9], low)], np.int64)
    k, band, least, most = line_dedup.groups(bands, np.array([7, 4, 9, 1, 2, 6, 6]))
    assert sorted(zip(k.tolist(), least.tolist(), most.tolist())) == [(4, 4, 9), (7, 4, 9), (9, 4, 9)] and len({*band.tolist()}) == 1
    many = np.full(line_dedup.SCREENED + 1, 8 << line_dedup.PAYLOAD, np.int64) | (np.arange(line_dedup.SCREENED + 1) * 0x111111 % (1 << line_dedup.PAYLOAD))
    k, _, least, most = line_dedup.groups(many, np.arange(line_dedup.SCREENED + 1))
    assert len(k) == line_dedup.SCREENED + 1 and {*least.tolist()} == {0} and {*most.tolist()} == {line_dedup.SCREENED}


def test_forest_of_blocks():
    """The links of two blocks join what all similar pairs would join, and none is more than needed."""
    own = random.Random(7)
    base = ["".join(own.choice("abcdefgh ") for _ in range(120)) for _ in range(4)]
    lines = ["", "abc", "ABC", *(b[:at] + "#" + b[at + 1 :] for b in base for at in (own.randrange(120) for _ in range(12)))]
    root = {k: k // 3 * 3 for k in range(len(lines))}
    x, y = ([{"k": k, "root": root[k], "line": lines[k]} for k in ks] for ks in (range(0, len(lines), 2), range(len(lines))))
    same = [(a["root"], b["root"]) for a in x for b in y if 100 * len(every_set(a["line"]) & every_set(b["line"])) >= 80 * len(every_set(a["line"]) | every_set(b["line"]))]
    made = [(root[a], root[b]) for a, b in line_dedup.forest(x, y, 80)]
    want = roots(sorted({*root.values()}), same)
    assert roots(sorted({*root.values()}), made) == want
    assert len(made) == len({*root.values()}) - len({*want.values()}) and made


def test_line_dedup(spark):
    long = " ".join(words(40))
    near = long.rsplit(" ", 1)[0] + " other"
    rows = [(3, f"{long}\nkeep me\n\n{near}"), (1, f"start\n{near}"), (2, None), (None, long), (4, ""), (5, "start\nstart\n"), (6, "ein anderer Satz")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    lines = [(i, p, x) for i, t in rows if i is not None and t is not None for p, x in enumerate(t.split("\n")) if x.strip()]
    same = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if 100 * len(every_set(lines[a][2]) & every_set(lines[b][2])) >= 80 * len(every_set(lines[a][2]) | every_set(lines[b][2]))]
    order = sorted(range(len(lines)), key=lambda k: lines[k][:2])
    place = {k: n for n, k in enumerate(order)}
    root = roots(range(len(lines)), [(place[a], place[b]) for a, b in same])
    gone = {lines[k][:2] for k in range(len(lines)) if root[place[k]] != place[k]}
    want = {(i, t if t is None or i is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone)) for i, t in rows}
    out = line_dedup.deduplicated(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == want
    counts = {r["doc_id"]: r for r in line_dedup.line_counts(docs).collect()}
    assert all(counts[i]["kept_sha256"] == (None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t in want)


def every_set(line):
    low, n = line.lower(), line_dedup.SHINGLE
    return {low[i : i + n] for i in range(max(1, len(low) - n + 1))}


def kept_lines(lines):
    """Brute force: what is left of lines in order, one of each component of those of similarity 0.8."""
    sets = [every_set(x) for x in lines]
    root = roots(range(len(lines)), [(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    return [x for k, x in enumerate(lines) if root[k] == k]


def left_of(spark, lines):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    return [r["text"] for r in line_dedup.deduplicated(docs).orderBy("doc_id").collect() if r["text"]]


def test_lines_are_judged_by_every_position(spark):
    urls = ["https://www.example.com/reports/2019", "https://www.example.org/about", "https://www.example.com/" + "a1b2" * 30, "https://www.example.com/" + "c3d4" * 30]
    lines = [*urls, "order-number-0001 confirmed", "order-number-7392 rejected", "/usr/share/doc/first", "/usr/share/doc/another/file", "x", "y", "xy"]
    assert kept_lines(lines) == lines == left_of(spark, lines)
    long = "".join(draw.choice("abcdefgh") for _ in range(400))
    lines += [long, long[:300] + "#" + long[300:], long[::-1], "#" + long, "😀" * 3 + "é" + long[50:]]
    assert kept_lines(lines) == left_of(spark, lines) != lines


#: Han of the basic block and of extensions A and B, and letters of scripts that are written without spaces.
SCRIPTS = {"Thai": 0x0E01, "Lao": 0x0E94, "Tibetan": 0x0F49, "Burmese": 0x1000, "Khmer": 0x1780, "kana": 0x3042, "half-width kana": 0xFF71, "Han": 0x4E00, "Han A": 0x3400, "Han B": 0x20000}


def test_lines_of_scripts_without_spaces(spark):
    own, lines = random.Random(8), []
    for first in SCRIPTS.values():
        country, one, two = ("".join(chr(first + own.randrange(16)) for _ in range(n)) for n in (12, 80, 80))
        lines += [country + one, country + two, chr(first) + one + two, chr(first + 1) + one + two]
    want = [x for k, x in enumerate(lines) if k % 4 < 3]  # two sentences that begin alike stay, a near copy that begins otherwise goes
    assert kept_lines(lines) == want == left_of(spark, lines)


def test_one_letter_variants_are_linked(spark):
    own, lines = random.Random(9), []
    for n in (10, 15, 19, 25):
        for _ in range(50):
            line = " ".join("".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(own.randrange(3, 9))) for _ in range(n))
            at = own.randrange(len(line))
            lines += [line, line[:at] + "#" + line[at + 1 :]]
    assert len(kept_lines(lines)) <= 201  # nearly all of the 200 pairs have similarity 0.8
    assert len(left_of(spark, lines)) <= 204


def test_line_dedup_runs_no_python(spark, monkeypatch):
    """Sets and bands are column functions; lines of similarity 0.8 share a band whatever the kinds of their bands."""
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(spark.range(0)), name, lambda *a, **k: pytest.fail("Python on the executors"))
    own = random.Random(10)
    lines = ["a", "ABCDE", "é" * 6, "😀" * 7 + "x", *("".join(own.choice("aB é日😀") for _ in range(own.randrange(1, 40))) for _ in range(50))]
    sets = line_dedup.with_sets(spark.createDataFrame([(x,) for x in lines], "line string"))
    assert all(r["n"] == len(every_set(r["line"])) for r in sets.selectExpr("line", "size(set) as n").collect())
    pairs = []
    for n in (9, 15, 16, 17, 20, 22, 51, 60, 64, 72, 80, 90, 200):
        for _ in range(30):
            line = "".join(chr(0x4E00 + own.randrange(20_000)) for _ in range(n + 4))
            pairs.append((line, line[n // 9 :] + "".join(chr(0xAC00 + own.randrange(9_000)) for _ in range(n // 9))))
    rows = [(2 * i + j, x) for i, pair in enumerate(pairs) for j, x in enumerate(pair)]
    bands = line_dedup.bands_of(line_dedup.with_sets(spark.createDataFrame(rows, "k long, line string")))
    of = {}
    for r in bands.collect():
        of.setdefault(r["k"], set()).add(r["band"])
    assert np.mean([bool(of[2 * i] & of[2 * i + 1]) for i in range(len(pairs))]) > 0.98
    docs = spark.createDataFrame([(i, x) for i, pair in enumerate(pairs[-60:]) for x in ["\n".join(pair)]], "doc_id long, text string")
    assert sum(r["n_removed"] for r in line_dedup.line_counts(docs).collect()) >= 58


def test_rows_of_one_doc_id_keep_their_own_lines(spark):
    docs = spark.createDataFrame([(1, "a copy of both\nleft alone"), (2, "a copy of both\nfirst text"), (2, "unique here\nsecond text"), (2, "unique here\nsecond text")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.deduplicated(docs).collect())
    assert got == [(1, "a copy of both\nleft alone"), (2, "first text"), (2, "unique here\nsecond text"), (2, "unique here\nsecond text")]
    assert sorted(r["n_removed"] for r in line_dedup.line_counts(docs).collect()) == [0, 0, 0, 1]


def test_byte_bpe_and_token_counts(docs, texts):
    import tiktoken
    from tokenizers import Tokenizer

    import public_tokenizers as P

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert byte_bpe.PATTERN == P.PATTERN
    got = {r["doc_id"]: r for r in byte_bpe.encode_digests(docs, ranks).collect()}
    for i, t in texts:
        ids = np.array(own.encode_ordinary(t or ""), "<u4").tobytes()
        assert tuple(got[i])[1:] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    bpe = byte_bpe.ByteBpe(ranks)
    for text in ("naïve 日本語 🙂  x\n\n", "<|endoftext|> it's", "\u2028\x85\x1c a"):
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text) and bpe.decode(ids) == text
        at = bpe.offsets(text, ids)
        assert [text.encode()[a:b] for a, b, _, _ in at] == [bpe.table[i] for i in np.frombuffer(ids, "<u4").tolist()]
        assert all(bpe.table[i] in text[c:d].encode() for i, (_, _, c, d) in zip(np.frombuffer(ids, "<u4").tolist(), at, strict=True))
    encoded = byte_bpe.encode(docs, ranks, offsets="at")
    back = byte_bpe.decode(encoded, ranks).select("doc_id", "text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)

    spec = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(spec)
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, spec, limit=50).collect()}
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert tuple(got[i])[1:] == (len((t or "").encode()), n, n > 50)
    counter = token_counts.TokenCounter(spec, token_counts.proven_whole(spec))
    for text in ("I'LL <|endoftext|> go", "ΣΑΣ İi ﬁ 日本", "e\u0301 E\u0301", "a\x85b\x1cc"):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_short_texts():
    """Each text is the first that a counter meets, or meets a memory that is full."""
    import json

    import public_tokenizers as P
    from tokenizers import Tokenizer

    spec = open(P.path("word_bpe_49k.json"), encoding="utf-8").read()
    library, whole, own = Tokenizer.from_str(spec), token_counts.proven_whole(spec), random.Random(3)
    texts = ["hello world", "the", "a b c", "", " ", "it's", "x" * 500, "qqzzxj qqzzxj the", *(" ".join(own.choice(["the", "it's", "zqx", "é", "12", "日", "..."]) for _ in range(own.randrange(1, 6))) for _ in range(60))]
    want = [len(library.encode(x, add_special_tokens=False).ids) for x in texts]
    assert [token_counts.TokenCounter(spec, whole).count(x) for x in texts[:12]] == want[:12]
    for most in (0, 1, 3):
        counter = token_counts.TokenCounter(spec, whole, most)
        assert [counter.count(x) for x in texts] == want and len(counter.known) <= len(counter.whole) + most
    other = json.loads(spec)
    other["normalizer"] = None
    other = json.dumps(other)
    counter, library = token_counts.TokenCounter(other, token_counts.proven_whole(other)), Tokenizer.from_str(other)
    assert [counter.count(x) for x in ("Hello WORLD", "a  B")] == [len(library.encode(x, add_special_tokens=False).ids) for x in ("Hello WORLD", "a  B")]
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    plain, small = byte_bpe.ByteBpe(ranks), byte_bpe.ByteBpe(ranks, most=2)
    assert [small.encode(x) for x in texts] == [plain.encode(x) for x in texts] and len(small.known) <= 2


def test_sharding(spark, docs, texts, tmp_path):
    root = f"file://{tmp_path}/maps"
    rows = sharding.shard(docs, 5, slots=64, keep_at=root).collect()
    assert len(rows) == len(texts) + 2
    load = {}
    for r in rows:
        load.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in load.values())
    for r in rows:
        text = (dict(texts)[r["doc_id"] or 0] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
    first = sharding.SlotMap.load(spark, root, 1)
    sizes = {i: 10 + i % 7 for i in range(64)}
    even = sharding.first_map(sizes, 5, 64)
    loads = [sum(v for k, v in sizes.items() if even.slots[k] == s) for s in range(5)]
    assert max(loads) - min(loads) <= 16
    for shards in (6, 4):
        new = sharding.rebalanced(even, sizes, shards)
        loads = [sum(v for k, v in sizes.items() if new.slots[k] == s) for s in range(shards)]
        assert new.version == 2 and max(loads) - min(loads) <= 40
        assert len(new.moved) <= 64 // min(shards, 5) + 12
    assert first.version == 1 and len(first.slots) == 64


def test_url_filters(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.example.net", "/en/x", "block"), ("com", "", "allow")]
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "example.com", "EXAMPLE.com", "x.org", "badexample.net", "net.org", "", "a..net"]
    urls = [f"http://{h}{p}{q}" for h in hosts for p in ("", "/", "/en", "/en/", "/en/x1", "/de/1", "/fr/") for q in ("", "?a=/x", "#/y")] + [None, "", "no url", "://", "x://net/"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    for ranges in (1, 7):
        got = url_filters.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=ranges).collect()
        assert len(got) == 2 * len(urls)
        for r in got:
            u = urls[r["page_id"]] or ""
            rest = u.split("://", 1)[1] if "://" in u else ""
            host = rest[: min((rest + c).index(c) for c in "/?#")].lower()
            tail = rest[len(host) :]
            path = tail[: min((tail + c).index(c) for c in "?#")]
            fits = sorted((len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p))
            want = (fits[-1][2], fits[-1][3]) if fits else (None, "allow")
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *want), u
    none = url_filters.judge_urls(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "allow")}


def test_quality(spark, docs):
    table = lambda n: spark.read.parquet(f"{DATA}/{n}.parquet")
    model = quality.learn(table("documents"), table("labels"))
    rows = quality.scores(table("documents"), model).join(table("labels"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in bad]) > 0.9
    for r in quality.scores(docs, model).collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert quality.accepted(docs, model).columns == docs.columns
    x = np.array([quality.statistics_of((r["text"] or "").encode()) for r in docs.collect()])
    assert np.allclose(sorted(model.scores(x)), sorted(r["score"] for r in quality.scores(docs, model).collect()))
    assert {r["score"] for r in quality.scores(docs, quality.learn(docs, table("labels").limit(0))).collect()} == {0.5}


def test_nearest(spark):
    g = np.random.default_rng(1)
    x = g.normal(size=(600, 10)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (920, [0.0] * 10), (940, [float("nan")] * 10), (960, [1.0]), (980, [None] * 10), (None, [1.0] * 10)]
    vectors = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<float>, score double")
    got = {}
    for r in nearest.nearest(vectors, per_cell=200).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 600, 20))
    hits, d = 0, x.astype(np.float64)
    for q, found in got.items():
        found.sort()
        s = (d * d[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(600), -s))[:20].tolist()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(abs(s[v] - sc) < 1e-9 for _, v, sc in found)
        hits += len(set(want) & {v for _, v, _ in found})
    assert hits >= 0.9 * 20 * len(got)
    few = {(r["query_id"], r["vec_id"]) for r in nearest.nearest(vectors.where("vec_id in (0, 7, 20)")).collect()}
    assert few == {(0, 7), (0, 20), (20, 0), (20, 7)}


def test_rows_of_nearest():
    held = nearest._Held(nearest.fit(np.random.default_rng(1).normal(size=(300, 8)), 4), 4, 20, 0.2)
    q, x = np.random.default_rng(2).normal(size=(5, 8)), np.random.default_rng(3).normal(size=(300, 8))
    held.ask(q, [1000, 1001, 1002, 1003, 1004])
    cell = held.made.cell_of(x)
    codes = held.made.encode(x, cell)
    for i in range(0, 300, 50):  # six blocks: still k rows a query
        held.scan(x[i : i + 50], [[j] for j in range(i, i + 50)], cell[i : i + 50], [c.tobytes() for c in (codes[i : i + 50, ::2] << 4 | codes[i : i + 50, 1::2])])
    found = held.rows().column(1).to_numpy().reshape(5, 20)
    assert (found == np.argsort(-(q @ x.T), axis=1)[:, :20]).all()



@pytest.mark.parametrize(("n", "most_cells"), [(500, 256), (2000, 256), (4000, 256), (20000, 256)])
def test_recall_of_nearest(spark, n, most_cells):
    """Vectors without clusters, the hardest case: several cells, some of them not probed."""
    g = np.random.default_rng(n)
    x = g.normal(size=(n, 64)).astype(np.float32)
    step = 20 * max(1, n // 2000)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest.nearest(rows, every=step, per_cell=200, most_cells=most_cells).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    d = x.astype(np.float64)
    score = d[::step] @ d.T
    score[np.arange(len(score)), np.arange(0, n, step)] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    hits = sum(len(got[i * step] & set(w.tolist())) for i, w in enumerate(want))
    assert hits >= 0.93 * want.size, hits / want.size


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    import public_tokenizers as P

    ranks = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    made = [
        near_duplicates.near_duplicates(docs), substring_dedup.without_repeats(docs), decontamination.contamination(docs, bench), line_dedup.line_counts(docs), sharding.shard(docs),
        byte_bpe.encode_digests(docs, ranks), quality.scores(docs, quality.learn(docs, labels)), nearest.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        token_counts.token_counts(docs, open(P.path("word_bpe_49k.json"), encoding="utf-8").read()),
        url_filters.judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")),
    ]
    assert [m.count() for m in made] == [0] * len(made)


def test_pipeline(spark):
    import corpus_pipeline

    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    docs = queries.table(spark, DATA, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA)
        assert sorted(after.columns) == sorted(docs.columns), name
        docs = spark.createDataFrame(after.collect(), after.schema)
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(out) == set(left)
    assert all(out[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in left.items())


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Planted copies of lines, near duplicates and benchmark passages, decided again in plain Python."""
    import corpus_pipeline

    own = random.Random(11)
    some = lambda n: ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]
    plain, passage = [some(120) for _ in range(4)], some(40)
    near = [*plain[0][:-1], "changed"]
    lines = [" ".join(some(15)) for _ in range(3)]
    made = [*(" ".join(w) for w in plain), " ".join(near), " ".join([*some(60), *passage]), " ".join([*some(900), *passage[:14]]), "\n".join(lines), lines[0] + "\n" + lines[1][:-1] + "#", "https://www.example.com/reports\nhttps://www.example.org/about"]
    texts = list(enumerate(made))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def stage(name, rows):
        out = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame(rows, docs.schema), str(tmp_path))
        return sorted((r["doc_id"], r["text"]) for r in out.collect())

    flat = [(i, x) for i, t in texts for x in t.split("\n")]
    kept = {id(x) for x in kept_lines([x for _, x in flat])}
    want = [(i, "\n".join(x for j, x in flat if j == i and id(x) in kept)) for i, _ in texts]
    assert stage("line dedup", texts) == want != texts
    s = sets(texts, 5)
    root = roots(s, [(a, b) for a, b in itertools.combinations(s, 2) if s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])])
    want = [(i, t) for i, t in texts if root[i] == i]
    assert stage("MinHash near-dedup", texts) == want != texts
    windows = {tuple(passage[j : j + 13]) for j in range(len(passage) - 12)}
    hits = {i: {k for j in range(len(t.split())) if tuple(t.split()[j : j + 13]) in windows for k in range(j, j + 13)} for i, t in texts}
    want = [(i, t) for i, t in texts if not hits[i] or 20 * len(hits[i]) < len(t.split())]
    assert stage("benchmark decontamination", texts) == want != texts and any(hits[i] for i, _ in want)


def test_registered_sql(spark):
    import os

    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{name}')")
    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, DATA), con.execute(sql)
        columns = [c[0] for c in want.description]
        assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()), name
