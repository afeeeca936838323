"""Fill-in-middle, exact top-k and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from parley.llm import fim, resample, topk

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def example(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_units_and_cuts_of_any_bytes():
    random_ = random.Random(1)
    some = [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x08", "\x0e", "\x1f", "!", "a", "\x00", "\x7f", "é", "€", "😀", "\u0085", "<P>", "<S", "M>"]
    for _ in range(150):
        texts = [None if random_.random() < 0.05 else "".join(random_.choices(some, k=random_.choice([0, 1, 2, 7, 8, 9, 40, 300]))) for _ in range(random_.randint(0, 20))]
        ids = [random_.choice([None, random_.randint(-5, 10**12)]) for _ in texts]
        given = pa.array(["before", *texts], pa.string()).slice(1)  # a slice whose buffer begins elsewhere
        got = [(*x[:5], x[5].decode()) for x in fim._examples(ids, given, 42, 50, 80)]
        assert got == [example(i, t) for i, t in zip(ids, texts, strict=True)]
        assert [fim.rebuild(g[5], g[2]) for g in got] == [t or "" for t in texts]


def test_fill_in_middle_of_awkward_rows(spark):
    long = "x" * (1 << 21) + " é" * 1000
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a <P> b c d"), (5, long), (6, "one two  three\tfour"), (6, "one two  three\tfour"), (None, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id int, text string, output string")
    out = fim.fill_in_middle(docs).collect()
    assert sorted(map(tuple, out), key=str) == sorted((example(i, t) for i, t in rows), key=str)
    digests = {(r.doc_id, r.form): (r.output_sha256, r.restored_sha256) for r in fim.fill_digests(docs).collect()}
    assert digests == {(r.doc_id, r.form): tuple(hashlib.sha256(x.encode()).hexdigest() for x in (r.output, fim.rebuild(r.output, r.form))) for r in out}
    assert fim.fill_digests(docs.limit(0)).count() == 0
    assert all(r.form != "plain" for r in fim.fill_in_middle(docs.filter("doc_id = 6"), rate=100).collect())


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_features_across_texts_and_windows(monkeypatch):
    monkeypatch.setattr(resample, "WINDOW", 37)
    random_ = random.Random(2)
    some = [*"abZ09 .\x00\n_é😀İA", "word", "x" * 70]
    for _ in range(200):
        texts = [None if random_.random() < 0.1 else "".join(random_.choices(some, k=random_.choice([0, 1, 3, 10, 80]))) for _ in range(random_.randint(0, 8))]
        want = sorted((k, zlib.crc32(f.encode()) % 10_000) for k, t in enumerate(texts) for f in features(t)[1])
        got, words = [], 0
        for of_word, of_feature, bucket in resample.hashed(texts, 10_000):
            words += len(of_word)
            got += zip(of_feature.tolist(), bucket.tolist(), strict=True)
        assert sorted(got) == want and words == sum(features(t)[0] for t in texts)


def drawn(docs, target, percent=25, least=20, buckets=10_000):
    counts = []
    for rows in (docs, target):
        c = [0] * buckets
        for _, t in rows:
            for f in features(t)[1]:
                c[zlib.crc32(f.encode()) % buckets] += 1
        counts.append(c)
    s_all, t_all = map(sum, counts)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(*counts, strict=True)]
    out = []
    for i, t in docs:
        n, f = features(t)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    able = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    able = able[: percent * len(able) // 100]
    return out, [x[:4] for x in able]


@pytest.mark.parametrize("percent", [25, 100])
def test_resampling_equals_plain_python(spark, percent):
    random_ = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "né"]
    docs = [(i, " ".join(random_.choices(vocabulary, k=random_.choice([0, 5, 19, 20, 21, 60])))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "x" * 5000), (None, " ".join(vocabulary)), (7, docs[7][1])] + [(900, " ".join(vocabulary[:30]))] * 40
    target = [(1, " ".join(vocabulary[:20] * 3)), (2, None)]
    schema = "doc_id long, text string, rank string, bucket int"
    rows = resample.resample(spark.createDataFrame([(*d, "clash", 1) for d in docs], schema), spark.createDataFrame(target, "item_id long, text string"), percent).collect()
    every, best = drawn(docs, target, percent)
    assert sorted((tuple(r)[:4] for r in rows), key=str) == sorted((x[:4] for x in every), key=str)
    got = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, len(best) + 1))
    assert [tuple(r)[:4] for r in got] == best


def test_resampling_of_nothing_and_towards_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert resample.resample(one, none, percent=100).collect()[0]["rank"] == 1


def top(rows, every, k=5):
    held = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            held[i] = min(held.get(i, v), v)
    ints = {i: [int(x) * 256 if abs(x) >= 2**52 else math.floor(x * 256) for x in v] for i, v in held.items()}
    out = []
    for q, v in ints.items():
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints.items() if i != q and len(w) == len(v))[:k]
            out += [(q, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(best)]
    return sorted(out)


def vectors(seed, n, d, size=1.0, first=0):
    random_ = random.Random(seed)
    return [(first + i, [random_.gauss(0, size) for _ in range(d)]) for i in range(n)]


def tied():
    random_ = random.Random(3)
    rows = [(i, [random_.randint(-1, 1) / 256 for _ in range(3)]) for i in range(400)]
    return rows + [(600, None), (601, [1.0, float("nan"), 0.0]), (None, [1.0] * 3), (602, [None, 1.0, 2.0]), (603, []), (604, []), (650, []), (700, [1.0]), (701, [0.5]), (5, [9.0] * 3), (5, [9.0] * 3)]


def sized():
    random_ = random.Random(4)
    return vectors(1, 100, 5, 1e6) + vectors(2, 80, 5, first=1000) + [(2000 + i, [random_.gauss(0, 10.0 ** random_.choice([20, 160, 300, 307])) for _ in range(5)]) for i in range(40)]


@pytest.mark.parametrize(
    "rows",
    [vectors(7, 500, 7), tied(), [(i, [5.0] * 4) for i in range(300)] + [(i, [5 + x / 100 for x in v]) for i, v in vectors(8, 200, 4, first=300)], sized(), [], [(0, [1.0])]],
    ids=["random", "ties and odd rows", "one common vector and near ones", "large", "none", "one"],
)
def test_top_inner_equals_brute_force(spark, rows):
    given = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, node int")
    got = topk.top_inner(given, every=10, shard=100, block=20)
    assert sorted(map(tuple, got.collect())) == top(rows, 10)


def test_three_parts_on_vectors_far_from_zero(spark):
    rows = [(i, [3.0 + x for x in v]) for i, v in vectors(9, 3000, 16)]
    got = topk.top_inner(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=3)
    assert sorted(map(tuple, got.collect())) == top(rows, 50)
