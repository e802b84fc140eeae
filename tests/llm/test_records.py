"""WARC packages, chat examples and vector searches, against brute force."""

import hashlib
import io
import math
import zipfile

import duckdb
import numpy as np
import pytest

from tributary.llm import ann, chat, knn, warc
from tributary.llm.common import written


@pytest.mark.parametrize("wide", [False, True])
def test_zip_members(wide):
    data = [("archive/data.warc.gz", b"abc" * 100), ("indexes/index.cdxj", b""), ("é.txt", b"x")]
    raw = warc.zip_bytes(data, force64=wide)
    members = warc.zip_members(lambda at, n: raw[at : at + n], len(raw))
    assert {k: raw[a : a + n] for k, (a, n) in members.items()} == dict(data)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert {n: z.read(n) for n in z.namelist()} == dict(data) and z.testzip() is None


def test_zip_of_others():
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        z.comment = b"PK\x05\x06 is no end"
        z.writestr("a", b"stored")
        z.writestr("b", b"packed" * 50, zipfile.ZIP_DEFLATED)
    raw = out.getvalue()
    members = warc.zip_members(lambda at, n: raw[at : at + n], len(raw))
    assert set(members) == {"a"} and raw[members["a"][0] :][: members["a"][1]] == b"stored"
    with pytest.raises(ValueError):
        warc.zip_members(lambda at, n: b"no zip"[at : at + n], 6)


def test_warc(spark):
    big = "é" * 700
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/ü\r\nX: y", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "x" * 2_000_000), (9, "u", "a" * 999), (10, "u", "a" * 999), (11, "u", "b\r\n\r\n" * 300), (11, "u", "b\r\n\r\n" * 300)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, payload int, digest string")
    listed = written(warc.packages(warc.with_revisits(df), most=1000), "listed")
    assert listed.count() > 3
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_packages(listed).collect()), key=str)
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        last = max((j for j, _, u in rows if u == t and j is not None), default=None)
        to = last if len(b) >= 1000 and i is not None and last > i else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    assert got == sorted(want, key=str)
    payload = {r.page_id: r.payload for r in warc.read_packages(listed, with_payload=True).collect()}
    assert bytes(payload[3]) == big.encode() and payload[1] is None
    assert warc.read_packages(written(warc.packages(warc.with_revisits(df.limit(0))), "none")).count() == 0


def test_damaged_record():
    raw = warc.record(1, "u", b"payload", None)
    assert warc.parsed(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload\r\n", b"paylaod\r\n"))


HARD = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|<|", "<", "a<\n<|im_end|>\n", None, "", "<\\/", "é\U0001f600$1\\"]


def test_chat(spark):
    rows = [(c, t, ["user", "assistant", "system", None, "us\ner<|"][(c + t) % 5], HARD[(c * 3 + t) % len(HARD)]) for c in range(9) for t in range(c)]
    rows += [(50, 0, "assistant", "x"), (50, 0, "assistant", "x"), (50, None, "user", "first"), (None, 1, "assistant", "null id")]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], "conv_id long, turn long, role string, text string, example int, formatted string")
    made = written(chat.examples(df), "chat")
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    by = {}
    for c, t, role, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        told, loss = "".join(f"{r}\n{x}\n" for _, r, x in turns), "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    one = [r for r in made.collect() if r.conv_id == 50]
    assert len(one) == 2 and all(r.loss_start is not None for r in one) and {r.formatted.count("<|im_start|>") for r in one} == {2, 3}
    assert chat.read_back(written(chat.examples(df.limit(0)), "none")).count() == 0


def test_chat_sql(spark, tmp_path):
    rows = [(c, t, ["user", "assistant", "system"][(c + t) % 3], HARD[(c * 3 + t) % len(HARD)]) for c in range(9) for t in range(c)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = sorted(tuple(r) for r in chat.op7_chat(spark, str(tmp_path)).collect())
    assert got == sorted(tuple(r) for r in db.execute(chat.OP7_SQL).fetchall()) and got[0][0] == -1


def table(spark, n=700, d=8, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)).round(3).tolist()
    v[40:90] = [v[40]] * 50  # ties
    rows = [(i, x, 0, 1) for i, x in enumerate(v)] + [(1000, None, 0, 1), (1001, [0.0] * d, 0, 1), (1002, [1.0, float("nan")] + [0.0] * (d - 2), 0, 1), (1003, [float("inf")] * d, 0, 1), (1004, [None] * d, 0, 1), (1005, [], 0, 1), (50, v[3], 0, 1), (100, v[100], 0, 1), (200, v[7], 0, 1), (None, v[4], 0, 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, leaf int")


def truth(rows, every, k, score, zero):
    """For each query row, the k best (score, vec_id)."""
    use = [(i, np.array(x, float)) for i, x, *_ in rows if i is not None and x and None not in x and np.isfinite(np.array(x, float)).all() and (zero or any(x))]
    return sorted((q, sorted((score(x, y), i) for i, y in use if i != q)[:k]) for q, x in use if q % every == 0)


def answers(got, k, sign=1):
    """The answers by query row: rows of one query_id and rank belong to different rows that ask."""
    by = {}
    for r in got:
        by.setdefault((r.query_id, r.rank), []).append((sign * r.score, r.vec_id))
    assert {n for _, n in by} <= set(range(1, k + 1))
    return by


def test_top_products(spark):
    rows, df = table(spark)
    score = lambda a, b: -sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=True))
    want = {}
    for q, found in truth(rows, 50, 5, score, True):
        for i, x in enumerate(found):
            want.setdefault((q, i + 1), []).append(x)
    assert {len(x) for x in want.values()} == {1, 2}
    for shard, block, first, most in ((8192, 1024, 2, 8192), (100, 3, 1, 30), (40, 1000, 3, 10_000)):
        got = answers(knn.top_products(df, 50, 5, shard, block, first, most=most).collect(), 5, -1)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert knn.top_products(df.limit(0), 50, 5).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1e200, 1.0]), (3, [-1.0, 0.5])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in knn.top_products(few, 50, 5).orderBy("rank").collect()] == [(1, 1), (2, 3)]
    with pytest.raises(ValueError):
        knn.top_products(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0])], "vec_id long, embedding array<double>"), 50, 5)


def test_top_products_sql(spark, tmp_path):
    rows, df = table(spark, n=300)
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(tuple(r) for r in knn.op9_topk(spark, str(tmp_path)).collect()) == sorted(db.execute(knn.OP9_SQL).fetchall())


def test_top_splits_cut_all_rows():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 3, (500, 4)).astype(float)
    for parts in (1, 2, 7, 64):
        splits = knn.top_splits(x, parts)
        home = knn.shard_of(splits, x)
        assert set(home) == set(range(home.max() + 1)) and home.max() < parts
    assert knn.top_splits(np.ones((50, 2)), 8) == []


def test_neighbours(spark):
    rows, df = table(spark, n=900)
    want = truth(rows, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), False)
    got = answers(ann.neighbours(df, 100, 10, leaf_rows=16).collect(), 10)
    hits = {}
    for q, found in want:
        hits.setdefault(q, []).extend(found)
    assert {q for q, _ in got} == set(hits)
    for q, found in hits.items():
        each = len(found) // 10
        mine = sorted(x for n in range(1, 11) for x in got[q, n])
        assert len(mine) == len(found) and len(found) in (10, 20)
        assert all(len(got[q, n]) == each for n in range(1, 11))
    assert sum(len({i for n in range(1, 11) for _, i in got[q, n]} & {i for _, i in f}) for q, f in hits.items()) >= 0.9 * sum(len({i for _, i in f}) for f in hits.values())
    once = [q for q, f in hits.items() if len(f) == 10]
    assert all([x for n in range(1, 11) for x in got[q, n]] == sorted(x for n in range(1, 11) for x in got[q, n]) for q in once)
    assert ann.neighbours(df.limit(0), 100, 10).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.neighbours(two, 100, 10).collect()] == [(0, 1, 1, 1.0)]


def test_hot_leaf_is_cut(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.0] if i < 300 else rng.normal(size=3).tolist()) for i in range(500)]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>")
    tree = ann.fit(np.array([x for _, x in rows]), 32)
    data = written(ann.indexed(v, tree), "index")
    ask = ann.queries(v, 100)
    n = int((tree["count"] == 0).sum())
    got = {}
    for r in sorted(ann.searched(data, ask, tree, n, 10, most=16).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    x = np.array([v for _, v in rows])
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        assert found == sorted((float(s), i) for i, s in enumerate(d) if i != q)[:10]
    assert len(got) == 5


def test_leaves_are_bounded():
    """A broadcast tree has the leaves that it is allowed, and bins of neighbouring leaves hold every row once."""
    x = np.random.default_rng(3).normal(size=(4000, 8))
    tree = ann.fit(x, 2, most=300)
    leaves = (tree["count"] == 0).sum()
    assert 250 < leaves <= 300
    seen = ann.visits(tree, x[:50], 40)
    assert (seen.sum(axis=1) == 40).all() and ann.visits(tree, x[:5], 1000).all()
    size = dict(zip(*(c.tolist() for c in np.unique(ann.home(tree, x), return_counts=True)), strict=True)) | {10**6: 100}
    cut = ann.bins(size, 64)
    assert [c for c in cut if c[0] == 10**6] == [(10**6, 10**6, 0), (10**6, 10**6, 1)]
    whole = [(lo, hi, sum(n for leaf, n in size.items() if lo <= leaf <= hi)) for lo, hi, part in cut if not part]
    assert sum(n for *_, n in whole) == 4100 and all(n <= 64 or lo == hi for lo, hi, n in whole) and len(whole) < len(size)


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_bin_agrees_with_brute_force(kind):
    """Copies, near copies, ties, repeated ids and lengths beyond single precision: the product that rules rows out loses none."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)).astype(kind)
    copies, near = x.copy(), x.copy()
    copies[:2000] = x[0]
    near[:1000] = x[0] + (rng.normal(size=(1000, 16)) * 1e-6).astype(kind)
    once, many = np.arange(3000), rng.integers(0, 60, 3000)
    leaf = np.sort(rng.integers(3, 10, 3000))
    at = rng.choice(3000, 60, replace=False)
    for v, ids in ((x, once), (copies, once), (copies, many), (near, once), (np.round(x), once), (x + kind(1000), once), (x * kind(1e25), once), (x * kind(1e-25), once)):
        asks = rng.random((60, 7)) < 0.6
        got = ann.Bin(leaf, ids, v, 10).near(v[at], ids[at], asks, 3)
        want = []
        for i, p in enumerate(at):
            use = np.flatnonzero(asks[i, leaf - 3] & (ids != ids[p]))
            d = ann.distances(v[use].astype(float), v[p].astype(float))
            want += [(i, int(ids[use[j]]), float(d[j])) for j in np.lexsort((ids[use], d))[:10]]
        assert list(zip(*(c.tolist() for c in got), strict=True)) == want
