"""Queries with a trained model against plain versions of what they compute, over whole small tables."""

import itertools
import math
import re
import zlib

import numpy as np
import pytest

from skiagram.llm import language, quality, queries, toxicity
from skiagram.llm.shared import U64, mix, prefix_hash, span_hash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").collect()


def trains(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 != 0


def test_languages_by_binding_each_trigram(spark, documents):
    kept = {}

    def vector(three):
        if three not in kept:
            a, b, c = (language.letter_vectors(np.array([ord(x) if x != " " else 0]), language.DIMS)[0].astype(int) for x in three)
            kept[three] = np.roll(a, 2) * np.roll(b, 1) * c
        return kept[three]

    def bundle(text):
        s = re.sub(" +", " ", " " + "".join(x if x.isalpha() else " " for x in text.lower()) + " ")
        return sum((vector(s[k : k + 3]) for k in range(len(s) - 2)), np.zeros(language.DIMS))

    bundles = {r.doc_id: bundle(r.text) for r in documents if r.text and any(x.isalpha() for x in r.text)}
    sums = {}
    for r in documents:
        if r.lang is not None and r.doc_id in bundles and trains(r.doc_id):
            sums[r.lang] = sums.get(r.lang, 0) + bundles[r.doc_id]
    cosine = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    got = {r.doc_id: r for r in queries.op2_language(spark, SF).collect()}
    assert set(got) == {r.doc_id for r in documents} and len(sums) == 4
    for r in documents:
        own = got[r.doc_id]
        assert own.held_out is not trains(r.doc_id)
        if r.doc_id not in bundles:
            assert (own.lang_pred, own.score) == ("und", 0.0)
            continue
        scores = {lang: cosine(bundles[r.doc_id], v) for lang, v in sums.items()}
        assert own.score == pytest.approx(max(0.0, *scores.values()), abs=1e-5)
        assert scores[own.lang_pred] == pytest.approx(max(scores.values()), abs=1e-5)


def plain_features(text):
    """Hashed words, word pairs and pairs with one word between, word by word."""
    found = [w.strip("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()).encode()) or w for w in re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())]
    hashes = []
    for w in found:
        data = np.frombuffer(w, np.uint8)
        hashes.append(span_hash(prefix_hash(data), np.array([0]), np.array([len(w)]))[0])
    pick = lambda x: int(mix(np.array([x], U64))[0] >> U64(64 - toxicity.BITS))
    plus = lambda x, n: U64((int(x) + n) % 2**64)
    pair = lambda x, y, n: U64((int(mix(np.array([plus(x, n)], U64))[0]) + int(y)) % 2**64)
    out = {pick(plus(h, 1)) for h in hashes}
    out |= {pick(pair(a, b, 2)) for a, b in itertools.pairwise(hashes)}
    return out | {pick(pair(a, b, 3)) for a, b in zip(hashes, hashes[2:], strict=False)}


def test_toxicity_by_learning_feature_by_feature(spark, documents, labels):
    features = {r.doc_id: sorted(plain_features(r.text or "")) for r in documents}
    sample = sorted((r.doc_id, int(r.toxic == 1)) for r in labels if r.toxic is not None and trains(r.doc_id) and r.doc_id in features)
    z, n = {}, {}

    def weight(i):
        l1 = 0 if i == "bias" else toxicity.L1
        value = z.get(i, 0.0)
        return 0.0 if abs(value) <= l1 else (math.copysign(l1, value) - value) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for epoch in range(toxicity.EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(sample)).tolist():
            doc_id, label = sample[k]
            own = [*features[doc_id], "bias"]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in own:
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA * w[i]
                n[i] = before + g * g
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, SF).collect()}
    assert set(got) == set(features)
    for d, own in features.items():
        p = 1 / (1 + math.exp(-(weight("bias") + sum(map(weight, own)))))
        assert got[d].score == pytest.approx(p, abs=2e-3) and got[d].predicted == (got[d].score >= 0.5) and got[d].held_out is not trains(d)


def test_kept_by_all_labellings(spark, documents):
    """Of texts of few lines: the best of all labellings, and the share of characters in the lines that it calls content."""
    weights, transition = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    got = {r.doc_id: r for r in queries.op5_quality(spark, SF).collect()}
    seen = set()
    for r in documents:
        own, lines = got[r.doc_id], [w for w in (re.findall(r"[^\x20\x09-\x0D]+", x) for x in (r.text or "").split("\n")) if w]
        if own.base_failed:
            assert own.kept is False
            continue
        if len(lines) > 12:
            continue
        data = np.frombuffer(r.text.encode(), np.uint8)
        e = quality.Chunk(data, np.array([0, len(data)])).x @ weights
        assert len(e) == len(lines)
        score = lambda way: sum(e[k] * b for k, b in enumerate(way)) + sum(transition[a, b] for a, b in itertools.pairwise(way))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(e)), key=score)
        chars = [sum(map(len, w)) for w in lines]
        share = sum(c for c, b in zip(chars, best, strict=True) if b == 0) / max(sum(chars), 1)
        assert own.kept == (share >= quality.CONTENT_SHARE) and own.content_share == pytest.approx(share)
        seen.add(own.kept)
    assert seen == {True, False}
