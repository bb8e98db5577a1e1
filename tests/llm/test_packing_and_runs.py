"""Packing and periodic runs against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from skiagram.llm import packing, queries, runs

P = pytest.importorskip("public_tokenizers")


def texts(seed=5):
    rng = random.Random(seed)
    word = lambda k=3: "".join(rng.choice("abé") for _ in range(rng.randint(1, k)))
    out = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(150)]
    for k in range(60):
        own = [word() for _ in range(rng.randint(1, 12))]
        body = (own * 40)[: rng.randint(2, 90)]
        out.append(" ".join([word() for _ in range(rng.randint(0, 9))] + body + [word() for _ in range(rng.randint(0, 9))]))
    out += ["", " \n\t", "one", "a " * 23, "a " * 24, "\ta  b\n" * 12, "a b c " * 2000, "a a " * 30, "x" * 30_000, None]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en") for k, t in enumerate(texts())] + [(None, "a b " * 30, "en"), (None, "a b " * 30, "en"), (3, "again", None), (7, texts()[7], "en"), (7, texts()[7], "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"n": F.lit("clash"), "_w": F.lit(1), "deal": F.lit(2), "runs": F.lit(3)})


def all_runs(s, least, times):
    """By trying every period: stretches where words p apart agree, without those that a divisor explains."""
    found = []
    for p in range(1, len(s) // times + 1):
        i = 0
        while i + p < len(s):
            a = i
            while i + p < len(s) and s[i] == s[i + p]:
                i += 1
            if i + p - a >= max(least, times * p) and i > a:
                found.append((a, i + p - a, p))
            i = max(i, a + 1)
    return sorted((r for r in found if not any(r[2] % q == 0 and q < r[2] and b <= r[0] and b + m >= r[0] + r[1] for b, m, q in found)), key=lambda r: (r[0], r[2]))


def expected(doc_id, text, planted=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if planted and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = all_runs(w, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, sha("".join(f"{a},{m},{q}\n" for a, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_maximal_runs_by_every_period():
    rng = random.Random(1)
    for _ in range(4000):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 24))]
        s = (s[: rng.randint(1, len(s))] * 9)[: len(s) + 8] if s and rng.random() < 0.4 else s
        assert runs.maximal_runs(s) == all_runs(s, 2, 2), s


@pytest.mark.parametrize("s", [[0] * 4000, [k % 61 for k in range(4000)], list(range(4000)), [int(k % 7 == 0) for k in range(4000)], [x for k in range(90) for x in [0] * k + [1]], [x for k in range(90, 0, -1) for x in [0] * k + [1]]])
def test_words_that_are_scanned_are_no_more_than_those_there_are(s):
    for way in (1, -1):
        t = [max(s) + 2, *(way * x for x in s), -max(s) - 2]
        after, _, right = runs.smaller_suffixes(t)
        assert right <= len(s)
        assert runs.left_matches(t, after)[1] <= len(s)


def test_runs_of_documents(spark, docs):
    for planted in (False, True):
        rows = docs if not planted else runs.with_planted_periods(docs)
        got = sorted(map(tuple, runs.digests(runs.periodic_runs(rows)).collect()), key=str)
        assert got == sorted((expected(r.doc_id, r.text, planted) for r in docs.collect()), key=str)
    whole = {r.doc_id: r for r in runs.periodic_runs(docs).filter("doc_id is not null").collect()}
    assert whole[texts().index("a " * 24)].collapsed == "a" and [tuple(r) for r in whole[texts().index("a " * 24)].runs] == [(0, 24, 1)]
    assert whole[texts().index("a b c " * 2000)].collapsed == "a b c"


def test_runs_cross_no_document_and_empty_tables(spark):
    two = spark.createDataFrame([(1, "a " * 20), (2, "a " * 20)], "doc_id long, text string").coalesce(1)
    assert [r.runs for r in runs.periodic_runs(two).collect()] == [[], []]
    assert runs.digests(runs.periodic_runs(two.limit(0))).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        runs.periodic_runs(two, times=1)


@pytest.mark.parametrize(("length", "least"), [(8, 1), (16, 3), (64, 8)])
def test_pieces_cover_every_document_once(length, least):
    rng = random.Random(length)
    for _ in range(300):
        sizes = [rng.choice([0, 1, length, rng.randint(0, 5 * length)]) for _ in range(rng.randint(0, 40))]
        cover = {d: [] for d in range(len(sizes))}
        padding = 0
        made = packing.packed(sizes, length, least)
        for s in made:
            n = sum(p[2] for p in s)
            assert 0 < n <= length
            padding += 0 if n & (n - 1) == 0 else length - n
            for d, a, m in s:
                assert m > 0
                cover[d].append((a, m))
        for d, c in cover.items():
            assert [a for a, _ in sorted(c)] == [sum(m for b, m in c if b < a) for a, _ in sorted(c)] and sum(m for _, m in c) == sizes[d]
        assert padding <= (least - 1) * len(made)


def test_first_fit_decreasing_by_looking_through_all():
    rng = random.Random(9)
    for _ in range(200):
        pieces = [(k, 0, rng.randint(1, 50)) for k in range(rng.randint(0, 60))]
        plain = []
        for p in sorted(pieces, key=lambda p: -p[2]):
            at = next((s for s in plain if sum(x[2] for x in s) + p[2] <= 50), None)
            plain.append([p]) if at is None else at.append(p)
        assert packing.first_fit_decreasing(pieces, 50) == plain


@pytest.mark.parametrize("group", [1 << 22, 500])
def test_packed_documents(spark, docs, group):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path, 1, partitions=3, group_tokens=group).collect()
    want = sorted((str(r.doc_id), [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect())
    rows = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        rows.setdefault(str(p.doc_id), []).append((p.start, ids, p.doc_tokens))
    got = []
    for d, own in rows.items():  # rows of one id are told apart by what they hold
        texts_of = [w for n, w in want if n == d]
        assert sum(len(x) for _, x, _ in own) == sum(map(len, texts_of))
        assert all(any(len(w) == n and w[a : a + len(x)] == x for w in texts_of) for a, x, n in own)
        got += texts_of
    assert len(got) == len(want)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    padding = 0
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == [sum(x.length for x in s[:k]) for k in range(len(s))]
        n = sum(p.length for p in s)
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding <= 7 * len(sequences)
    again = packing.pack(docs, path, 1, partitions=3, group_tokens=group)
    assert sorted(map(str, again.collect())) == sorted(map(str, pieces))
    joined = packing.sequences(again).collect()
    assert {r.sequence_id: (r.ids, r.n_tokens) for r in joined} == {k: (b"".join(bytes(p.ids) for p in s), sum(p.length for p in s)) for k, s in sequences.items()}
    assert all(r.padded_to == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 2048) for r in joined)


def test_pack_of_nothing(spark, docs):
    assert packing.pack(docs.limit(0), P.path("byte_bpe_50k.json"), 1).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {(r.doc_id, r.length, r.doc_tokens) for r in packing.pack(only, P.path("byte_bpe_50k.json"), 1).collect()} == {(1, 1, 1), (2, 1, 1)}
    assert packing.pack(only, P.path("byte_bpe_50k.json"), None).count() == 0


def test_queries_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, sf).collect()), key=str)
    assert got == sorted((expected(r.doc_id, r.text) for r in docs), key=str)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs}
    pieces = queries.op11_packing(spark, sf)
    assert pieces.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    covered = dict.fromkeys(ids, 0)
    for p in pieces.collect():
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(np.array(own[p.start : p.start + p.length], "<u4").tobytes())
        covered[p.doc_id] += p.length
    assert covered == {d: len(x) for d, x in ids.items()}
