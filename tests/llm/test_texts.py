"""Operators on texts, against brute force, with nulls, empty and long texts, repeats, empty tables and clashing columns."""

import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from tributary.llm import bpe, langid, licenses, mixing, quality, simhash
from tributary.llm.common import Sieve, connected_components

WORDS = "the of and licence quick brown fox jumps over lazy dog alpha beta gamma delta".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, copies int, row int, n int, bits double, keep int, whole int, fp int"


def text(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    out = [(i, text(rng, int(rng.integers(1, 60))), ["en", "de", None][i % 3], ["s", "t", None][i % 2 if i % 7 else 2]) for i in range(60)]
    copy = text(rng, 200)
    out += [(100, copy, "en", "s"), (101, copy.replace("fox", "FOX", 1), "en", "t"), (102, copy + " tail", "en", "s"), (103, copy, "en", "s")]
    out += [(104, None, None, None), (105, "", "en", "s"), (106, " \n\t", "de", "t"), (107, "Ünï ñ 漢字 \U0001f600 x", "de", "s"), (None, "no id at all", "en", "s")]
    out += [(108, "Released under the MIT License. mit  license", "en", "s"), (109, "a" * 3000 + " " + text(rng, 5000), "en", "s"), (103, copy, "en", "s")]
    return [(*r, len(r[1] or ""), 1, 2, 3, 4, 5.0, 6, 7, 8) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def own_fingerprint(t, k=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] if w else []
    hs = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(n, linked):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_simhash(docs, rows, empty):
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.components(docs).collect()), key=str)
    fps = [own_fingerprint(r[1]) for r in rows]
    of = groups(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    least = {g: min((rows[i][0] for i in range(len(rows)) if of[i] == g and rows[i][0] is not None), default=None) for g in set(of)}
    assert got == sorted(((r[0], f, least[g]) for r, f, g in zip(rows, fps, of, strict=True)), key=str)
    assert simhash.components(empty).count() == 0


def test_links_split_hot_shards(spark):
    rng = np.random.default_rng(3)
    near = {int(0x123456789ABCDEF ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False))) for _ in range(300)} | {int(x) for x in rng.integers(0, 2**62, 100)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in near)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for size, most in ((1024, 4096), (10, 20), (1, 50), (0.0001, 50)):  # the last takes two of five blocks
        root = {r.node: r.root for r in connected_components(simhash.links(df, 3, size, most)).collect()}
        of = groups(len(fps), lambda i, j: ((fps[i] ^ fps[j]) % 2**64).bit_count() <= 3)
        assert {f: root.get(f, f) for f in fps} == {f: fps[g] for f, g in zip(fps, of, strict=True)}


def test_bk_tree_follows_all_edges():
    rng = np.random.default_rng(4)
    keys = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 500), np.arange(500), np.zeros(70, np.int64)])
    tree, found = simhash.BKTree(keys), set()
    for q, t in tree.search(keys, 5):
        found |= set(zip(q.tolist(), t.tolist(), strict=True))
    u = keys.view(np.uint64)
    assert found == set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(u[:, None] ^ u) <= 5)), strict=True))


def test_bk_tree_leaves_edges_out_of_the_radius_alone():
    rng = np.random.default_rng(14)
    keys = rng.integers(-(2**63), 2**63 - 1, 1000)
    tree, followed, left = simhash.BKTree(keys), 0, 0

    def count(node, q):
        nonlocal followed, left
        if isinstance(node, tuple):
            d = int(np.bitwise_count(tree.keys[node[0]] ^ q))
            for e, child in node[1].items():
                if abs(d - e) <= 3:
                    followed += 1
                    count(child[0], q)
                else:
                    left += 1

    for q in tree.keys[:20]:
        count(tree.root, q)
    assert followed > 1000 and left > 500


def test_sieve_lets_all_keys_pass(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS h")
    rows = spark.range(30_000).selectExpr("id", "xxhash64(id) AS h")
    passed = {r.id for r in rows.filter(Sieve(keys).column("h")).collect()}
    assert set(range(3000)) <= passed and len(passed) < 4500
    assert rows.filter(Sieve(keys.limit(0)).column("h")).count() == 0
    assert set(range(3000)) <= {r.id for r in rows.filter(Sieve(keys, most_bits=1 << 15).column("h")).collect()}


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (3, 1), (7, 8)], [(i, i + 1) for i in range(70)], [(0, i) for i in range(50)] + [(60, 50), (50, 49)]])
def test_connected_components(spark, edges):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    of = groups(len(nodes), lambda i, j: (nodes[i], nodes[j]) in edges or (nodes[j], nodes[i]) in edges)
    assert got == {n: nodes[g] for n, g in zip(nodes, of, strict=True)}


def test_near_duplicates(spark, docs, rows, empty):
    gone = {(r.doc_id, r.keeper) for r in simhash.near_duplicates(docs).collect()}
    assert {(101, 100), (102, 100), (103, 100), (105, 104), (106, 104)} <= gone
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 100 in ids and None in ids and not {101, 102, 103, 105, 106} & set(ids)
    assert simhash.deduplicated(empty).count() == 0
    assert {r.doc_id for r in simhash.near_duplicates(docs, most=2).collect()} == {d for d, _ in gone}


def own_keepers(texts, k=5, similarity=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)})
    return groups(len(texts), lambda i, j: len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]))


def test_near_duplicates_with_repeated_passages(spark):
    rng = np.random.default_rng(11)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 3000, n))
    texts = []
    for n in (1, 10, 30, 60):
        for _ in range(15):
            body, passage = say(300), say(30)
            texts += [f"{body} {passage}", f"{body}{(' ' + passage) * n}", say(200)]
    of = own_keepers(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for most, early in ((512, 4), (2, 4), (512, 1)):
        assert {(r.doc_id, r.keeper) for r in simhash.near_duplicates(df, most=most, early=early).collect()} == {(i, g) for i, g in enumerate(of) if i != g}


def test_near_duplicates_at_the_similarity(spark):
    rng = np.random.default_rng(15)
    texts = []
    for _ in range(40):  # 200 words with a stretch of 1 to 30 exchanged: similarities from 1 to 0.7, many near 0.8
        w = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        n, at = int(rng.integers(1, 30)), int(rng.integers(0, 170))
        texts += [" ".join(w), " ".join(w[:at] + [f"v{x}" for x in rng.integers(0, 5000, n)] + w[at + n :])]
    of = own_keepers(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.keeper) for r in simhash.near_duplicates(df).collect()} == {(i, g) for i, g in enumerate(of) if i != g}
    assert 40 < len(set(of)) < 80


def test_near_duplicates_keep_different_texts_of_one_id(spark):
    rng = np.random.default_rng(12)
    a, b, c, d, e = (" ".join(f"w{x}" for x in rng.integers(0, 3000, 200)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (7, d + " tail"), (8, a + " tail"), (9, b + " tail"), (10, e), (11, c + " tail")]
    kept = [(r.doc_id, r.text) for r in simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == 5 and {(None, a), (None, b), (7, c), (10, e)} <= set(kept)
    assert {t for i, t in kept if i == 7} - {c} < {d, d + " tail"}


RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.VOCABULARY), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_bpe(docs, rows, empty):
    out = bpe.encoded(docs, with_ids=True)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()), key=str)
    want = []
    for r in rows:
        t = r[1] or ""
        ids = TIKTOKEN.encode_ordinary(t)
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encoded(empty).count() == 0
    back = bpe.decoded(out.select("doc_id", "ids"))
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((r[0], r[1] or "") for r in rows), key=str)


CODEC = bpe.Codec(open(P.path(bpe.VOCABULARY), "rb").read(), P.PATTERN, longest=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abtheing 's\n漢é1! "), max_size=80), min_size=1, max_size=8))
def test_codec_is_tiktoken(texts):
    for t, ws in zip(texts, CODEC.learn(texts), strict=True):
        assert list(map(int, CODEC.ids(ws).split())) == TIKTOKEN.encode_ordinary(t) and CODEC.bytes(ws) == t.encode() and not CODEC.odd


def test_language(spark, empty):
    rng = np.random.default_rng(5)
    of = {"aa": "ka lo mi tu re".split(), "bb": "schn pfl auk ung eit".split()}
    word = lambda lang: "".join(rng.choice(of[lang], int(rng.integers(1, 4))))
    say = lambda lang, n: " ".join(word(lang) for _ in range(n))
    rows = [(i, say(x := ["aa", "bb"][i % 2], 1 + i), x) for i in range(120)] + [(200, None, "aa"), (201, "123 !?", "aa"), (202, "", None), (203, say("bb", 20), None), (204, say("aa", 9000), "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    guess = langid.predict(spark, langid.samples(df))
    got = {r.doc_id: r.g for r in df.select("doc_id", guess("text").alias("g")).collect()}
    assert all(got[i].lang_pred == ["aa", "bb"][i % 2] and 0 <= got[i].score <= 1 for i in range(10, 120))
    assert [got[i].lang_pred for i in range(200, 205)] == ["und", "und", "und", "bb", "aa"] and got[200].score == 0
    kept = {r.doc_id: r.lang for r in langid.known(df).collect()}
    assert kept[203] == "bb" and not {200, 201, 202} & set(kept)
    assert langid.samples(empty) == {} and langid.known(empty).count() == 0
    alone = langid.predict(spark, {})
    assert {r.g.lang_pred for r in df.select(alone("text").alias("g")).collect()} == {"und"}


def own_phrases(t, sample):
    count, at = 0, 0
    while at < len(t):
        end = at
        while end < len(t) and t[at : end + 1] in sample:
            end += 1
        if end == at:  # a byte that the sample lacks ends a phrase by itself
            count, at = count + 1, at + 1
        else:
            count, at = count + (end < len(t) and t[end] in sample), end
    return count


def test_automaton_counts_longest_matches_over_whole_texts():
    rng = np.random.default_rng(6)
    sample = "".join(rng.choice(list("abc "), 4000)).encode()
    tried = ["".join(rng.choice(list("abcd "), n)).encode() for n in (1, 255, 256, 257, 5000)]
    tried += [sample[500:2500], sample[100:1500] + b"d" + sample, b"ddd", b"a" * 3000, sample[:256], sample[:512] + sample[:1000]]
    a = langid.Automaton(sample)
    size = langid.SEGMENT
    cuts = [-(-len(t) // size) for t in tried]
    grid = np.frombuffer(b"".join(t.ljust(k * size, b"\xff") for t, k in zip(tried, cuts, strict=True)), np.uint8).reshape(-1, size)
    follows = np.concatenate([np.arange(k) > 0 for k in cuts])
    got = np.bincount(np.repeat(np.arange(len(tried)), cuts), a.phrases(np.ascontiguousarray(grid.T), follows))
    assert [int(n) - k * size + len(t) for n, k, t in zip(got, cuts, tried, strict=True)] == [own_phrases(t, sample) for t in tried]


def test_predictions_are_those_of_brute_force(spark):
    rng = np.random.default_rng(16)
    scripts = {"aa": "kalomiture", "bb": "schnpfleti", "cc": "\u043a\u0438\u043b\u043e\u043c\u0435", "dd": "".join(chr(0x4E00 + i) for i in range(400)), "ee": "".join(chr(0x1E900 + i) for i in range(34)), "ff": "kalmschnet"}
    say = lambda x, n: " ".join("".join(rng.choice(list(scripts[x]), int(rng.integers(1, 6)))) for _ in range(n))
    given = {x: langid.letters(say(x, 150)) for x in scripts}
    model = langid.Model(given)
    truth = [x for x in scripts for _ in range(6)]
    texts = [say(x, int(rng.integers(20, 200))) for x in truth] + ["\u00bd", "12 \u00b2", None, "q"]
    langs, scores, _, _ = model.predict(texts)
    assert all(x == y for x, y in zip(langs, truth, strict=False) if y in ("cc", "dd", "ee")) and langs[-4:-1] == ["und"] * 3 and scores[-4:-1] == [0.0] * 3
    for t, lang, score in zip(texts, langs, scores, strict=True):
        if b := langid.letters(t or ""):
            cost = sorted(((own_phrases(b, s) + 1) * np.log2(len(s)), x) for x, s in given.items())
            assert cost[0][1] == lang and abs(score - (1 - cost[0][0] / cost[1][0])) < 1e-9


def test_language_learns_from_long_rows_and_rejects_noise(spark):
    rng = np.random.default_rng(17)
    of = {"aa": "ka lo mi tu re".split(), "bb": "schn pfl auk ung eit".split()}
    say = lambda x, n: " ".join("".join(rng.choice(of[x], int(rng.integers(1, 4)))) for _ in range(n))
    rows = [(i, ["9" * 5000 + " ", ""][i % 3 > 0] + say(["aa", "bb"][i % 2], 3000), ["aa", "bb"][i % 2]) for i in range(40)]
    noise = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 3000))
    df = spark.createDataFrame(rows + [(100, noise, None), (101, say("aa", 500), None)], "doc_id long, text string, lang string")
    learned = langid.samples(df)
    assert set(learned) == {"aa", "bb"} and all(20_000 < len(x) < 60_000 for x in learned.values())
    kept = {r.doc_id: r.lang for r in langid.known(df).collect()}
    assert set(kept) == {*range(40), 101} and kept[101] == "aa"


def test_quality(spark, docs, empty):
    rng = np.random.default_rng(7)
    good = [(i, text(rng, 80), "en") for i in range(200)]
    junk = [(1000 + i, " ".join(w.upper() + "!!" for w in text(rng, 60).split()), "en") for i in range(20)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, text(rng, 3), "xx"), (0, good[0][1], "en")]
    df = spark.createDataFrame([(*r, 1, 2) for r in good + junk + odd], "doc_id long, text string, lang string, n int, bits int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(1000 + i, 0, 0) for i in range(5)] + [(None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(df, labels).collect()}
    assert sum(got[i].keep for i in range(200)) >= 196 and not any(got[1000 + i].keep for i in range(20))
    assert not got[2000].keep and got[2000].perplexity is None and not got[2001].keep and got[2002].keep
    kept = quality.kept(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}
    none = labels.limit(0)
    assert quality.judged(empty, none).count() == 0 and all(r.keep == (r.n_chars > 0) for r in quality.judged(df, none).collect())


class OwnKneserNey:
    """Brute force, by dictionaries of strings."""

    def __init__(self, texts, order=quality.ORDER):
        pad, self.order = "\ue000" * (order - 1), order
        count = {}
        for t in texts:
            for i in range(len(t)):
                g = (pad + t)[i : i + order]
                count[g] = count.get(g, 0) + 1
        self.level = {order: count}
        for k in range(order - 1, 0, -1):
            low = {}
            for g in self.level[k + 1]:
                low[g[1:]] = low.get(g[1:], 0) + 1
            self.level[k] = low
        self.cut, self.total, self.gone = {}, {}, {}
        for k, grams in self.level.items():
            d = quality.discounts([sum(n == i for n in grams.values()) for i in (1, 2, 3, 4)])
            self.cut[k] = d
            for g, n in grams.items():
                key = (k, g[:-1])
                self.total[key] = self.total.get(key, 0) + n
                self.gone[key] = self.gone.get(key, 0) + d[min(n, 3) - 1]

    def p(self, g):
        if not g:
            return 1 / quality.START
        key, lower = (len(g), g[:-1]), self.p(g[1:])
        if key not in self.total:
            return lower
        n = self.level[len(g)].get(g, 0)
        return ((n - self.cut[len(g)][min(n, 3) - 1] if n else 0) + self.gone[key] * lower) / self.total[key]

    def bits(self, t):
        pad = "\ue000" * (self.order - 1)
        return sum(-np.log2(self.p((pad + t)[i : i + self.order])) for i in range(len(t)))


def test_perplexity_is_that_of_kneser_ney(spark):
    rng = np.random.default_rng(11)
    train = ["abracadabra " * 20, "the cat sat on the mat", "x", "\u6f22\u5b57 \U0001f600", *(text(rng, 30) for _ in range(40))]
    ask = [*train[:4], None, "", "q", "zzz \u00e9\U0001f601", text(rng, 400), "abracadabra", text(rng, 10)[::-1], "the cat sat on the mat"]
    own = OwnKneserNey(train)
    table, floor = quality.model(spark.createDataFrame([(t,) for t in train], "text string"))
    rows = spark.createDataFrame(list(enumerate(ask)), "i int, text string").repartition(3)
    for most, segment in ((1_000_000, 1_000_000), (100, 7)):
        cut = quality.segments.__defaults__
        quality.segments.__defaults__ = (segment,)
        got = {r.i: r for r in quality.scored(rows, table, floor, most).collect()}
        quality.segments.__defaults__ = cut
        for i, t in enumerate(ask):
            assert got[i].n == len(t or "") and abs(got[i].bits - own.bits(t or "")) <= 0.004 * len(t or "") + 1e-9, t
    total = sum(own.p("abra" + chr(c)) for c in range(0x3000)) + own.p("abra\u6f22") + own.p("abra\u5b57") + own.p("abra\U0001f600")
    assert 0.97 < total < 1  # the rest is for the other code points


def test_segments_of_a_text_are_the_whole():
    texts = ["abcdefghij" * 3, None, "", "xy", "\U0001f600" * 9]

    def rows(*most):
        return [(int(o), tuple(k.tolist())) for s, at, owner in quality.segments(texts, *most) for o, k in zip(owner, quality.keys_at(quality.raw_keys(s), at).T, strict=True)]

    assert rows() == rows(4) and len(rows()) == 30 + 2 + 9


def test_quality_trains_on_all_that_is_not_held_out(spark):
    labels = spark.range(40_000).selectExpr("id AS doc_id", "1 AS quality")
    assert 29_000 < quality.trusted_ids(labels).filter("train").count() < 31_000


def test_quality_tells_junk_of_rare_characters(spark):
    rng = np.random.default_rng(13)
    many = [chr(0x4E00 + i) for i in range(120)]
    han = lambda n: "".join(many[x] + many[(x + 1) % 120] for x in rng.integers(0, 120, n))
    good = [(i, text(rng, 80) + ". ", "en") for i in range(300)] + [(500 + i, han(60), "zh") for i in range(100)]
    junk = ["1234567890 " * 40, "\u6f22" * 400, "\U0001f600" * 400, "\u00a7\u00b6" * 200, "\u10d0\u10d1\u10d2 " * 100]
    noise = ["".join(rng.choice(many, 120)) for _ in range(5)]
    rows = good + [(1000 + i, t, "en") for i, t in enumerate(junk)] + [(2000 + i, t, "zh") for i, t in enumerate(noise)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in good], "doc_id long, quality int")
    got = {r.doc_id: r.keep for r in quality.judged(df, labels).collect()}
    assert sum(got[r[0]] for r in good) >= 390
    assert not any(got[1000 + i] for i in range(len(junk))) and not any(got[2000 + i] for i in range(len(noise)))


def test_mixing(spark, docs, rows, empty):
    got = mixing.mixed(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((r[0], size(r[1])) for r in rows), key=str)
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size(r[1])
    want = mixing.targets(list(total.items()))
    taken = {}
    for r in got:
        assert r.source_size == total[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] for s in taken)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs).collect()))
    mix = mixing.repeated(docs)
    assert mix.columns == docs.columns and sum(size(r.text) for r in mix.collect()) == sum(taken.values())
    assert mixing.mixed(empty).count() == 0 and mixing.repeated(empty).count() == 0


def test_mixing_targets():
    assert mixing.targets([("a", 100), ("b", 100), (None, 100)]) == {"a": 50.0, "b": 100.0, None: 150.0}
    out = mixing.targets([("a", 1000), ("b", 10), ("c", 10)])
    assert out["b"] == 30 and out["c"] == 30 and abs(out["a"] - 960) < 1e-9
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


def test_mixing_follows_the_dual(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, " ".join(["w"] * int(rng.integers(1, 200))), "ab"[i % 2]) for i in range(2000)], "doc_id long, text string, source string")
    got = mixing.mixed(df).toPandas()
    for _, g in got.groupby("source"):
        assert abs((g["rate"] * g["size"]).sum() / g["target"].iloc[0] - 1) < 1e-4
        x = np.log(g["rate"][g["rate"] < 3]) / g["size"][g["rate"] < 3]
        assert np.allclose(x, x.iloc[0], rtol=1e-6)
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 1e-4 * g["target"].iloc[0] + 1


def own_scan(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    hits = [(i, v) for k, v in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(k.split())] == k.split()]
    return len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None, ",".join(sorted({v for _, v in hits}))


def test_licenses(spark, docs, empty):
    lines = [None, "", "MIT License", "Released under the MIT License. And the GNU General Public\tLicense; apache-license", "Licensed under CC BY-NC 4.0.", "All rights reserved.", "all rights are reserved", "éMIT License", "licensed under the Apache License, Version 2.0" + " mit license" * 500]
    df = spark.createDataFrame([(500 + i, t, 0, 1, 2) for i, t in enumerate(lines)], "doc_id long, text string, row int, base int, label int").union(docs.select("doc_id", "text", "row", "size", "n"))
    got = licenses.scanned(df).collect()
    want = sorted((str((r.doc_id, *own_scan(r.text))) for r in df.select("doc_id", "text").collect()))
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == want
    label = {r.doc_id: r.labels for r in got if r.doc_id is not None}
    assert label[503] == "apache,gpl,mit" and label[108] == "mit" and label[507] == ""
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.scanned(empty).count() == 0


def test_licenses_add_labels(spark):
    rng = np.random.default_rng(9)
    rows = [(i, text(rng, 40)) for i in range(50)] + [(90, "x Licensed under CC BY-NC 4.0. y"), (91, "All rights reserved."), (92, "all the rights were reserved")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[90][0] == "cc-by-nc" and got[91][0] == "proprietary" and got[92][0] == "" and got[5] == ("", 0.0)


def own_labels(texts, coverage=0.6):
    """Brute force: each template at each place of each text, weighed by document frequencies."""
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    posted = licenses.postings()
    idf = {w: np.log((len(texts) + 2) / (sum(w in set(x) for x in words) + 1)) for w, *_ in posted}
    out = []
    for x in words:
        labels, best = {v for k, v in licenses.PHRASES.items() for i in range(len(x)) if x[i : i + len(k.split())] == k.split()}, 0.0
        base = bool(labels)
        for n, (label, _, _) in enumerate(licenses.TEMPLATES):
            mine = [(w, i, must) for w, t, i, must in posted if t == n]
            for start in range(-max(i for _, i, _ in mine), len(x)):
                there = [(w, must) for w, i, must in mine if 0 <= start + i < len(x) and x[start + i] == w]
                share = sum(idf[w] for w, _ in there) / sum(idf[w] for w, _, _ in mine)
                if sum(m for _, m in there) == sum(m for _, _, m in mine) and share >= coverage:
                    labels.add(label)
                    best = max(best, share)
        out.append((",".join(sorted(labels)), 1.0 if base else min(1.0, best)))
    return out


def test_licenses_are_those_of_brute_force(spark):
    rng = np.random.default_rng(18)
    notices = [n for _, n, _ in licenses.TEMPLATES]
    texts = [None, "", text(rng, 30)]
    for _ in range(60):
        parts = []
        for _ in range(int(rng.integers(1, 4))):
            w = str(rng.choice(notices)).split()
            if rng.random() < 0.6:  # a word exchanged, left out or added
                i = int(rng.integers(0, len(w)))
                w = [w[:i] + ["odd"] + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + ["odd"] + w[i:]][int(rng.integers(0, 3))]
            if rng.random() < 0.3:
                w = w[int(rng.integers(0, len(w))) :]
            parts += [text(rng, int(rng.integers(0, 8))), " ".join(w)]
        texts.append(", ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(df).collect()}
    for i, (labels, score) in enumerate(own_labels(texts)):
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-9, texts[i]


def test_licenses_of_one_text_are_all_found(spark):
    rng = np.random.default_rng(10)
    notices = [n for _, n, _ in licenses.TEMPLATES]
    pairs = [(i, j) for i in range(len(notices)) for j in range(len(notices)) if i != j]
    rows = [(1000 + i, text(rng, 40)) for i in range(50)] + [(0, " . ".join(notices))] + [(1 + k, f"{notices[i]} quick {notices[j]}") for k, (i, j) in enumerate(pairs)]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == {x for x, _, _ in licenses.TEMPLATES}
    assert all({licenses.TEMPLATES[i][0], licenses.TEMPLATES[j][0]} <= got[1 + k] for k, (i, j) in enumerate(pairs))


def own_quantile(values, q):
    return sorted(values)[max(0, int(np.ceil(q * len(values))) - 1)]


def test_quality_decisions_are_those_of_brute_force(spark):
    rng = np.random.default_rng(19)
    rows = [(i, text(rng, int(rng.integers(5, 60))), ["en", "de"][i % 2]) for i in range(120)]
    rows += [(200 + i, "".join(rng.choice(list("abcdefgh xyz.,!"), 120)), ["en", None][i % 2]) for i in range(20)] + [(300, None, "en"), (301, "", "xx"), (302, "fox", "xx"), (None, text(rng, 30), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 120, 2)] + [(i, 1) for i in range(1, 100, 2)], "doc_id long, quality int")
    train = {r.doc_id: r.train for r in quality.trusted_ids(labels).collect()}
    model = OwnKneserNey([t for i, t, _ in rows if t and train.get(i)])
    bits = {n: model.bits(t or "") for n, (_, t, _) in enumerate(rows)}
    fresh = [n for n, (i, t, _) in enumerate(rows) if t and train.get(i) is False]
    mean = lambda ns: sum(bits[n] for n in ns) / sum(len(rows[n][1]) for n in ns)
    by = {x: [n for n in fresh if rows[n][2] == x] for x in {rows[n][2] for n in fresh}}
    excess = lambda n: (bits[n] + 60 * mean(by.get(rows[n][2], fresh))) / (len(rows[n][1]) + 60)
    limit = {x: 1.08 * own_quantile([excess(n) for n in ns], 0.995) for x, ns in by.items()}
    whole = 1.08 * own_quantile([excess(n) for n in fresh], 0.995)
    for n, r in enumerate(sorted(quality.judged(df, labels).collect(), key=lambda r: (r.doc_id is None, r.doc_id))):
        i, t, lang = rows[n]
        assert r.doc_id == i and r.n_chars == len(t or "")
        if t and abs(excess(n) - limit.get(lang, whole)) > 0.01:
            assert r.keep == (excess(n) <= limit.get(lang, whole)) and abs(np.log2(r.perplexity) - bits[n] / len(t)) < 0.01
        elif not t:
            assert not r.keep and r.perplexity is None


def test_language_stage_is_brute_force(spark):
    rng = np.random.default_rng(20)
    say = lambda parts, n: " ".join("".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(n))
    of = {"aa": ["ka", "lo", "mi"], "bb": ["schn", "pfl", "auk"], "cc": ["ка", "ло", "ми"]}
    rows = [(i, say(of[x], int(rng.integers(1, 200))), x) for i, x in enumerate(list(of) * 30)] + [(200 + i, "".join(rng.choice(list("abcdefghijklmnop"), 400)), None) for i in range(5)] + [(300, None, "aa"), (301, "1 2", "bb"), (302, say(of["cc"], 50), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = langid.samples(df)

    def own(t):
        b = langid.letters(t or "")
        return min(((own_phrases(b, s) + 1) * np.log2(len(s)), x) for x, s in sorted(given.items())) + (len(b),) if b else None

    found = [own(t) for _, t, _ in rows]
    told = [f for f, r in zip(found, rows, strict=True) if f and r[2]]
    mean, top = sum(f[0] for f in told) / sum(f[2] for f in told), own_quantile([f[0] / f[2] for f in told], 0.999)
    want = {r[0]: r[2] or f[1] for f, r in zip(found, rows, strict=True) if f and (f[0] + 60 * mean) / (f[2] + 60) <= 1.25 * top}
    assert {r.doc_id: r.lang for r in langid.known(df).collect()} == want and len(want) > 80
