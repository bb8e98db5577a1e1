"""Operators against brute force on small tables with nulls, empty texts, ties, repeats and extra columns."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skiagram.llm import bpe, html_text, jaccard, language, mixing, quality, repeats, token_files, topk, toxicity
from skiagram.llm.shared import shared_dir

P = pytest.importorskip("public_tokenizers")


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    base = [" ".join(word() for _ in range(rng.randint(1, 90))) for _ in range(n)]
    passage = " ".join(word() for _ in range(40))
    texts = list(base)
    for k in range(0, n, 4):
        w = base[k].split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [base[0], base[0], base[1].upper(), passage + " x", "y " + passage, passage * 3, "", " \n\t", "one", "a" * 500, "a  b\n\n c "]
    rows = [(k, t, "x", "en") for k, t in enumerate(texts)]
    return [*rows, (len(rows), None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, source string, lang string").withColumn("score", F.lit(1)).withColumn("n", F.lit("clash"))


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def components(rows, size, num, den):
    sets = {}
    for d, t, *_ in rows:
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    label = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {d: new if x == old else x for d, x in label.items()}
    return {(d, len(sets[d]), label[d]) for d in sets}


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 80, 100)])
def test_jaccard_components(docs, size, num, den):
    assert {tuple(r) for r in jaccard.components(docs, size, num, den).collect()} == components(corpus(), size, num, den)


def family(n=60, words=120, seed=6):
    """A chain of near copies, each with one word of the one before changed, and texts that share a passage with it."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    w = [word() for _ in range(words)]
    out = []
    for k in range(n):
        w = [*w]
        w[(k * 17) % words] = word()
        out.append(" ".join(w))
    return [*out, *(" ".join([*w[:40], *(word() for _ in range(80))]) for _ in range(20))]


def test_verification_in_blocks_and_without_sketches(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(family())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = components(rows, 3, 90, 100)
    for sets in (2_000, 7):
        monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
        for exact in (False, True):
            assert {tuple(r) for r in jaccard.components(df, 3, 90, 100, exact).collect()} == want


@pytest.mark.parametrize("exact", [False, True])
def test_links_of_a_group_do_not_grow_with_tasks(spark, monkeypatch, exact):
    """Tasks that scan lists make at most ``FEW`` links a text, and few more for each task; copies have one set in the lists."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(200)], []
    for _ in range(150):
        w = [*base]
        for k in rng.sample(range(200), 3):
            w[k] = word()
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate([*texts, *texts])), "doc_id long, text string").repartition(8)
    made, scan = [], jaccard.scan_lists

    def counted(rows, *more, **named):
        with monkeypatch.context() as m:
            m.setattr(type(rows), "distinct", lambda d: d)
            out = jaccard.staged(scan(rows, *more, **named))
        made.append(out.count())
        return out.distinct()

    monkeypatch.setattr(jaccard, "scan_lists", counted)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {tuple(r) for r in jaccard.components(df, 3, 90, 100, exact).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert got == components(list(enumerate([*texts, *texts])), 3, 90, 100)
    assert sum(made) <= 4 * 150 + 32 * 5


def test_agreement_loses_less_than_stated():
    from fractions import Fraction
    from math import comb

    for num in (80, 90):
        t, p = jaccard.Rule(3, num, 100).agree, Fraction(100 + num, 200)
        below = lambda t: sum(comb(jaccard.BITS, k) * p**k * (1 - p) ** (jaccard.BITS - k) for k in range(t))  # noqa: B023, E731
        assert below(t) <= jaccard.LOSS < below(t + 2) and t > jaccard.BITS * 0.6
    rng = np.random.default_rng(0)
    common = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    pairs = [jaccard.sketches([np.append(common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)) for _ in range(2)]) for _ in range(100)]
    agree = [jaccard.BITS - int(np.bitwise_count(a ^ b).sum()) for a, b in pairs]
    assert abs(np.mean(agree) / jaccard.BITS - 0.95) < 0.01 and np.std(agree) < 5


def test_ids_shared_by_texts(spark):
    one, two, three = family(1), "a b c d", "e f g h i"
    rows = [(5, one[0], 1), (3, one[0] + " x", 2), (5, two, 3), (7, two, 4), (5, three, 5), (9, three, 6), (9, three, 7), (None, two, 8), (2, None, 9), (2, "", 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key long")
    got = sorted(tuple(-1 if x is None else x for x in r) for r in jaccard.components(df, 3, 90, 100).collect())
    n = len(one[0].split()) - 2
    assert got == sorted([(5, n, 3), (3, n + 1, 3), (5, 2, 5), (7, 2, 5), (5, 3, 5), (9, 3, 5), (9, 3, 5), (-1, 2, -1), (2, 0, 2), (2, 0, 2)])
    kept = sorted(r.key for r in jaccard.first_of_components(df, 3, 90, 100).collect())
    assert kept == [2, 3, 5, 8, 9, 10]


def test_the_end_of_a_long_list_stays_with_its_first_member(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_ROWS", 4)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(size)
    rows = [(-1, d, 5, 5, 5, 5) for d in range(10)] + [(k, 100 + k, k, k, k, k) for k in range(60)]
    for batch in (1, 3, 4, 7):
        spark.conf.set(size, batch)
        try:
            links = jaccard.scan_lists(spark.createDataFrame(rows, "key long, id long, s0 long, s1 long, s2 long, s3 long"), jaccard.Rule(3, 90, 100)).collect()
        finally:
            spark.conf.set(size, was)
        label = {d: d for d in range(10)}
        for a, b in links:
            label = {d: label[a] if x == label[b] else x for d, x in label.items()}
        assert len(set(label.values())) == 1


def repeats_by_force(rows):
    """What digests should return; rows in the order of their ids, equal ids in any."""
    seen, want = {}, {}
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.setdefault(raw[i : i + 100], d)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        want[d] = (len(raw), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest())
    return want


def repeats_found(df, **more):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digests(df, **more).collect()}


def test_repeats(docs):
    want = repeats_by_force([r[:2] for r in corpus()])
    for most in (repeats.MOST_LEAVES, 2, 1):
        assert repeats_found(docs, most=most) == want
    assert repeats.without_repeats(docs).columns == docs.columns


def test_repeats_of_a_line_in_ever_different_surroundings(spark, monkeypatch):
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    short, long = noise(90), noise(130)
    rows = [(k, noise(rng.randint(0, 80)) + (short if k % 2 else long) + noise(rng.randint(0, 80)) + ("ab" * 120 if k % 7 == 0 else "")) for k in range(90)]
    rows += [(90, rows[3][1]), (91, rows[3][1][:150]), (92, rows[4][1] + rows[6][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = repeats_by_force(rows)
    for most in (repeats.MOST_LEAVES, 8, 1):
        assert repeats_found(df, most=most) == want
    large = repeats.large_anchors
    monkeypatch.setattr(repeats, "large_anchors", lambda *a: [r[0] for r in repeats.anchor_rows(*a).filter("pack >= 0 and anchor % 2 = 0").select("anchor").distinct().collect()])
    assert repeats_found(df) == want
    monkeypatch.setattr(repeats, "large_anchors", large)
    assert large(df.selectExpr("doc_id doc", "cast(text as binary) text"), repeats.GRAM, repeats.MIN_LEN)
    texts = {r.doc_id: r.text for r in repeats.without_repeats(df, most=8).collect()}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in texts.items()} == {d: w[3] for d, w in want.items()}


def test_repeats_of_short_texts_empty_parts_and_clashing_names(spark):
    short = spark.createDataFrame([(1, "x" * 50), (2, "short"), (3, None), (4, "")], "doc_id long, text string")
    for df in (short, short.repartition(8), short.union(short.limit(0)).coalesce(1)):
        assert {d: g[:3] for d, g in repeats_found(df).items()} == {1: (50, 0, 0), 2: (5, 0, 0), 3: (0, 0, 0), 4: (0, 0, 0)}
    line = "".join(chr(97 + k * k % 23) for k in range(120))
    names = ["doc_id", "text", "kept", "doc", "_doc", "_base", "_bytes", "tie", "id", "spans", "n_chars"]
    rows = [(k, line if k < 3 else None, k, k + 1, k + 2, k + 3, k + 4, k + 5, k + 6, k + 7, 120) for k in range(4)]
    for more in ([], [(2, "another", *range(2, 10), 7)]):
        df = spark.createDataFrame(rows + more, ", ".join(f"{n} {'string' if n == 'text' else 'long'}" for n in names))
        got = sorted(tuple(r) for r in repeats.without_repeats(df).collect())
        want = [(r[0], r[1] if r[0] == 0 or r[1] != line else "", *r[2:10], 0 if r[1] == line and r[0] else r[10]) for r in rows + more]
        assert [(r[0], r[1] or "", *r[2:]) for r in got] == sorted((r[0], r[1] or "", *r[2:]) for r in want)


def test_equal_rows_are_no_repeats_of_each_other(spark):
    rng = random.Random(8)
    one, two, three = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    rows = [(1, one), (1, one), (2, two), (2, three), (2, two), (3, one[50:250]), (None, three), (None, three), (4, two[:150] + "x")]
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.digests(docs).collect())
        assert got == [(0, 300, 0), (0, 300, 0), (1, 300, 0), (1, 300, 0), (2, 300, 0), (2, 300, 0), (2, 300, 300), (3, 200, 200), (4, 151, 150)]
        kept = sorted((r.doc_id or 0, r.text) for r in repeats.without_repeats(docs).collect())
        assert kept == sorted([(0, three), (0, three), (1, one), (1, one), (2, ""), (2, two), (2, two), (3, ""), (4, "x")])
    many = spark.createDataFrame([(7, f"{k} {one}") for k in range(40)], "doc_id long, text string")
    assert sum(r.n_removed == 0 for r in repeats.digests(many).collect()) == 1


def test_maximal_intervals_list_all_occurrences():
    assert repeats.maximal_intervals([3, 3, 1], [1, 2, 3, 4]) == [(0, 2, 3), (0, 3, 1)]
    assert repeats.maximal_intervals([3], [7, 7]) == []


def test_token_files_round_trip(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, want = 0, set()
    for d, text, *_ in corpus():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.add((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in token_files.encode_and_read(docs, P.path("byte_bpe_50k.json"), 2).collect()} == want


def test_special_tokens_in_a_text_as_the_library_has_them():
    from tokenizers import Tokenizer

    import pyarrow as pa

    texts = ["a <|endoftext|> b", None, "plain words\nof a text", "<|endoftext|>", "x<|endoftext|>\n\n<|endoftext|> y", ""]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    _, encode = token_files.encoder(P.path("byte_bpe_50k.json"))
    assert [x.tolist() for x in encode(pa.array(texts))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_token_file_reads_only_what_is_asked_and_finds_damage(tmp_path):
    path = str(tmp_path / "a.ids")
    w = token_files.FrameWriter(path, 2)
    for k in range(5):
        w.add(k, np.arange(k * 10, dtype=np.uint32))
    w.close()
    assert [(d, len(i)) for d, _, i in token_files.read_documents(path, [3])] == [(3, 30)]
    raw = bytearray(open(path, "rb").read())
    assert struct.unpack("<I", raw[-4:])[0] == token_files.SEEKABLE_MAGIC
    raw[6] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises(Exception):  # noqa: B017
        list(token_files.read_documents(path, [1]))


def test_byte_bpe(docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = set()
    for d, t, *_ in corpus():
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        want.add((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert {tuple(r) for r in bpe.encode_column(docs, path, P.PATTERN).collect()} == want


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(0)
    doc = np.repeat([0, 2, 3], [4, 1, 6])
    e, t = rng.normal(size=(len(doc), 2)), rng.normal(size=(2, 2))
    got = quality.viterbi(doc, e, t, 4)
    for d in (0, 2, 3):
        own = e[doc == d]
        ways = [tuple(int(c) for c in f"{k:0{len(own)}b}") for k in range(1 << len(own))]
        best = max(ways, key=lambda y: sum(own[i, y[i]] for i in range(len(own))) + sum(t[y[i - 1], y[i]] for i in range(1, len(own))))
        assert tuple(got[doc == d]) == best


def test_minimum_cut_against_all_cuts():
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randint(1, 7)
        terminal = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(n)]
        edges = [(i, j, rng.randint(1, 5)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        cost = lambda y: sum(terminal[i][0] * (not y[i]) + terminal[i][1] * y[i] for i in range(n)) + sum(w for a, b, w in edges if y[a] != y[b])  # noqa: B023, E731
        best = min(cost([k >> i & 1 for i in range(n)]) for k in range(1 << n))
        assert abs(cost(html_text.minimum_cut(n, terminal, edges)) - best) < 1e-6


def test_main_text():
    page = "<html><body><nav><a href=x>Menu</a></nav><div class='cookie-notice'>We use cookies on this site.</div><article><h1>T &amp; U</h1><p>One  sentence\nhere.<p>Two.<div class=comments><p>A reader says things.</div></article><form>Search</form><footer>End</footer>"
    assert html_text.main_text(page) == "T & U One sentence here. Two."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav><!-- open") == ""


@pytest.mark.parametrize("around", ["class='layout has-sidebar'", "class='side-by-side'", "id='social-science'", "class='x top'"])
def test_names_around_an_article_do_not_drop_it(around):
    text = "A sentence of some words stands here. " * 4
    assert html_text.main_text(f"<body><div class=menu><a href=x>Menu</a></div><div {around}><article><p>{text}<p>Two.</article></div>").startswith(text)
    assert html_text.main_text(f"<body><div class=menu><a href=x>Menu</a></div><div {around}><p>{text}<p>{text}</div>").startswith(text)
    assert html_text.main_text(f"<article><p>{text * 9}</article><div class=legal><p>{text * 9}</div>") == f"{text * 9}{text * 9}".strip()
    assert html_text.main_text("<article><p>One.</article><div id=comments><article class=comment><p>A reader says things.</article></div>") == "One."


def test_hidden_is_an_attribute():
    assert html_text.main_text("<article><p>See <a title='the hidden cost'>words</a> <b class='x hidden y'>and</b> <i title='display: none'>more</i>.") == "See words and more."
    assert html_text.main_text("<article><p>One.<p hidden>Two.<p HIDDEN=''>Three.<p style='color: red; display:none'>Four.") == "One."


def test_top_k(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(700, 8)).astype(np.float32)
    v[5], v[6] = v[7], v[7]
    rows = [(k, x.tolist()) for k, x in enumerate(v)] + [(1000, None), (1100, [float("nan")] * 8), (1200, [None, 1.0])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding", F.col("id") % 100 == 0)
    q = np.floor(1024 * v.astype(np.float64)).astype(np.int64)
    want = set()
    for k in range(0, 700, 100):
        best = sorted(((-int(q[k] @ q[j]), j) for j in range(700) if j != k))[:10]
        want |= {(k, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r)[:4] for r in got.collect()} == want


def test_mixing_keeps_rows_and_stays_within_a_block(spark):
    rows = [(k, "a" if k % 3 else "b" if k % 2 else None) for k in range(900)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 0.5, "b": 0.3, None: 0.2}, block=1, period=100).orderBy("mix_order").collect()
    assert sorted(r.doc_id for r in got) == list(range(900)) and len({r.mix_order for r in got}) == 900
    plan = mixing.period_schedule({"a": 50, "b": 30, None: 20})
    for s, share in (("a", 50), ("b", 30), (None, 20)):
        done = np.cumsum([p[0] == s for p in sorted(plan, key=lambda p: p[2])])
        assert np.abs(done - share / 100 * np.arange(1, 101)).max() < 1


def test_mixing_keeps_the_given_weights(spark):
    assert mixing.shares({"a": 0.9, "b": 0.1}, 1000) == {"a": 900, "b": 100}
    many = {"a": 0.5} | {str(k): 0.5 / 249 for k in range(249)}
    for weights, blocks in (({"a": 0.9, "b": 0.1}, 9000), ({"a": 2**0.5, "b": 3**0.5, None: 0.01}, 5000), (many, 4000)):
        slots, length = mixing.source_slots(weights, dict.fromkeys(weights, 1) | {"a": blocks}, 1000)
        t = np.arange(1, 8001)
        for s, w in weights.items():
            own = np.concatenate([np.array(slots[s]) + k * length for k in range(-(-8000 // length))])
            assert np.abs(np.searchsorted(own, t) - w / sum(weights.values()) * t).max() < 1 + 1e-9
    docs = spark.createDataFrame([(k, "a" if k % 2 else "b") for k in range(40)], "doc_id long, source string")
    for weights in ({"a": 1.0}, {"a": 1.0, "b": 0.0}):
        with pytest.raises(ValueError, match="without a weight"):
            mixing.mixed(docs, weights)


def test_words_of_two_toxic_texts_count(spark):
    rng = random.Random(4)
    plain = [" ".join(rng.choice("abcdefgh") for _ in range(20)) for _ in range(300)]
    toxic = [k for k in range(300) if zlib.crc32(str(k).encode()) % 5][10:30:10]
    rows = [(k, f"{t} zork" if k in toxic else t) for k, t in enumerate(plain)]
    labels = spark.createDataFrame([(k, int(k in toxic)) for k in range(300)], "doc_id long, toxic int")
    index, weight = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    zork = next(toxicity.features(np.frombuffer(b"zork", np.uint8), np.array([0, 4])))
    assert weight[np.searchsorted(index, zork[0])] > 0 and zork[0] in index


def test_models_handle_odd_rows_and_empty_tables(spark, docs, empty):
    labels = spark.createDataFrame([(k, k % 2, int(k % 7 == 0)) for k in range(100)] + [(101, None, None)], "doc_id long, quality int, toxic int")
    n = docs.count()
    lang = {r.doc_id: r for r in language.identified(docs).collect()}
    assert len(lang) == n and lang[n - 1].lang_pred == "und" and all(0 <= r.score <= 1 for r in lang.values())
    assert toxicity.toxicity(docs, labels).count() == quality.quality(docs, labels).count() == n
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
    for out in (language.identified(empty), toxicity.toxicity(empty, labels), quality.quality(empty, labels), repeats.digests(empty), jaccard.components(empty, 3, 90, 100), token_files.encode_and_read(empty, P.path("byte_bpe_50k.json"), 2), mixing.mixed(empty)):
        assert out.count() == 0
    assert shared_dir(spark)


def test_patterns_that_cross_spaces_are_split_whole():
    import regex
    import tiktoken

    import pyarrow as pa

    path = P.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.cuts_at_spaces(regex.compile(P.PATTERN).findall)
    for pattern in (r"\S+ \S+|\s+|\S+", r"[a-z ]+|[^a-z ]+"):
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
        texts = ["one two three", "", None, "a b  c 12 d"]
        assert [x.tolist() for x in bpe.RankCodec(path, pattern).pieces.encode_array(pa.array(texts))] == [enc.encode_ordinary(t or "") for t in texts]


def test_base_rules_of_quality(spark, docs, empty):
    import re

    extra = ["w " * 60, "\n".join(["a b c d"] * 20), "x#*$ <|> &%\n\n y\n y\ny", "long " + "word" * 5000 + " é\u00a0ß", "a b c " * 30 + " ".join(map(str, range(60)))]
    rows = [*[r[:2] for r in corpus()], *((1000 + k, t) for k, t in enumerate(extra))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = set()
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(3)}
        n_dup = sum(x in lines[:i] for i, x in enumerate(lines))
        want.add((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), n_dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.quality(df, labels).collect()
    assert {tuple(r)[:7] for r in got} == want and not any(r.kept and r.base_failed for r in got)


def test_field_learns_what_labels_tell(spark):
    rng = random.Random(1)
    good = ["\n".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(12)) + "." for _ in range(6)) for _ in range(80)]
    bad = ["\n".join(" ".join("%$" + rng.choice("ABCD") * 3 + "9|" for _ in range(12)) for _ in range(6)) for _ in range(80)]
    rows = [(k, t) for k, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(k, int(k < 80)) for k in range(160)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert all(got[k] == (k < 80) for k in range(160))


def test_ftrl_against_its_formula():
    rng = np.random.default_rng(3)
    rows = [(np.unique(rng.integers(0, 16, 5)), int(rng.integers(0, 2))) for _ in range(60)]
    model = toxicity.Ftrl(bits=4)
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    z, n = [0.0] * 17, [0.0] * 17
    for i, y in rows * 3:
        own = [*i.tolist(), 16]
        w = {k: 0.0 if abs(z[k]) <= (0 if k == 16 else l1) else -(z[k] - (1 if z[k] > 0 else -1) * (0 if k == 16 else l1)) / ((b + n[k] ** 0.5) / a + l2) for k in own}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for k in own:
            s = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / a
            z[k] += g - s * w[k]
            n[k] += g * g
        model.learn(i, y)
    assert np.allclose(model.z, z, atol=1e-3) and np.allclose(model.n, n, atol=1e-3)


def test_words_lose_all_marks_at_their_ends():
    one = lambda t: next(toxicity.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))).tolist()
    assert one(b"zork") == one(b'"(zork!!!!!)') == one(b"ZORK.....") != one(b"zo-rk")
    assert one(b"a ..... b") != one(b"a b") and one(b".....") != [] and one(b"") == []


def test_clashing_names_are_the_tables_own(spark):
    names = ["doc_id", "text", "source", "score", "raw", "_bytes", "_key", "_rank", "_at", "_part", "mix_order", "key", "n_chars"]
    rows = [(k, f"word {k} of a text" if k % 5 else None, "a" if k % 3 else "b", *[100 + k + j for j in range(9)], 9) for k in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n in ('text', 'source') else 'long'}" for n in names))
    labels = spark.createDataFrame([(k, 0) for k in range(50)], "doc_id long, toxic int")
    for got in (toxicity.without_toxic(df, labels), jaccard.first_of_components(df), mixing.in_mix_order(df)):
        assert got.columns == names and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    placed = mixing.mixed(df)
    assert placed.columns == [*names, "mix_block", "mix_slot", "mix_order_"] and placed.select("mix_order").distinct().count() == 60


def test_ranks_of_sparse_and_repeated_ids(spark):
    rng = random.Random(5)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(300)] + [None] * 9 + [7] * 20
    rows = [(i, "hot" if k % 3 else f"s{k % 7}", k) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, source string, other long").repartition(5)
    got = mixing.mixed(df, block=4, period=50).collect()
    assert len(got) == len(rows) == len({r.mix_order for r in got})
    for s in {r.source for r in got}:
        own = sorted((r for r in got if r.source == s), key=lambda r: r.mix_order)
        assert [r.mix_block for r in own] == [k // 4 for k in range(len(own))]
        order = [-(1 << 63) if r.doc_id is None else r.doc_id for r in own]
        assert order == sorted(order)


def test_output_of_mixing_keeps_the_given_weights(spark):
    sizes = {"a": 600, "b": 300, None: 100}
    df = spark.createDataFrame([(k, s) for s, n in sizes.items() for k in range(n)], "doc_id long, source string")
    got = [r.source for r in mixing.mixed(df, {"a": 0.6, "b": 0.3, None: 0.1}, block=2, period=100).orderBy("mix_order").collect()]
    for s, n in sizes.items():
        done = np.cumsum([x == s for x in got])
        assert np.abs(done - n / 1000 * np.arange(1, 1001)).max() < 2 * 2
    many = spark.createDataFrame([(k, f"s{k % 1000}") for k in range(3000)], "doc_id long, source string")
    weights = {"s0": 0.9} | {f"s{k}": 0.1 / 999 for k in range(1, 1000)}
    slots, length = mixing.source_slots(weights, dict.fromkeys(weights, 1), 1000)
    assert abs(len(slots["s0"]) / length - 0.9) < 1e-3 and mixing.mixed(many, weights).count() == 3000
    with pytest.raises(ValueError, match="less than one slot"):
        mixing.source_slots({"a": 1.0, "b": 1e-9}, {"a": 1, "b": 1}, 1000)


def test_repeated_ids_are_queries_and_candidates_of_their_own(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [0.5, 0.5]), (200, [1.0, 1.0])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", F.col("id") % 100 == 0, scale=2).collect()
    by = {}
    for r in got:
        by.setdefault((r.query_id, r.query_copy), []).append((r.rank, r.vec_id, r.score))
    assert {k: sorted(v) for k, v in by.items()} == {(100, 0): [(1, 200, 4), (2, 1, 2), (3, 100, 0)], (100, 1): [(1, 200, 4), (2, 1, 2), (3, 100, 0)], (200, 0): [(1, 1, 4), (2, 100, 4), (3, 100, 4)]}
    made = topk.visits(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", F.col("id") % 100 == 0).first()
    assert made.made <= made.sent and made.possible == 3


def test_bounds_spare_blocks_of_clustered_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (np.eye(16)[k % 16] * 9 + rng.normal(size=16) * 0.1).tolist()) for k in range(4096)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = topk.visits(df, "vec_id", "embedding", F.col("id") % 100 == 0).first()
    assert made.made * 4 < made.possible and made.sent <= made.possible
    few = topk.visits(df.filter("vec_id % 16 < 4 or vec_id % 100 <> 0"), "vec_id", "embedding", F.col("id") % 1600 == 0).first()
    assert few.sent * 4 < few.possible  # blocks that no query needs aren't sent


def test_top_k_in_many_sets_and_groups(spark, monkeypatch):
    for name, n in (("BLOCK", 16), ("GROUP_BLOCKS", 3), ("GROUP_SUMMARIES", 5), ("SET_QUERIES", 4)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(5)
    v = np.concatenate([np.eye(6)[rng.integers(0, 6, 300)] * 5 + rng.normal(size=(300, 6)) * 0.3, rng.normal(size=(100, 6)), np.zeros((20, 6)), np.full((15, 6), 2.0)])
    rows = [(k, x.tolist() if k % 9 else x[:4].tolist()) for k, x in enumerate(v)]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), "vec_id", "embedding", F.col("id") % 10 == 0, scale=64)
    q = np.floor(64 * np.array([x + [0.0] * (6 - len(x)) for _, x in rows])).astype(np.int64)
    want = set()
    for k in range(0, len(rows), 10):
        best = sorted(((-int(q[k] @ q[j]), j) for j in range(len(rows)) if j != k))[:10]
        want |= {(k, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r)[:4] for r in got.collect()} == want


def test_empty_tables_of_pages_and_vectors(spark, empty):
    assert bpe.encode_column(empty, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0
    assert html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding", F.col("id") % 100 == 0).count() == 0


def test_languages_of_other_alphabets(spark):
    rng = random.Random(9)
    alphabets = {"ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "uk": "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя", "el": "αβγδεζηθικλμνξοπρστυφχψω", "zh": [chr(0x4E00 + 37 * k) for k in range(300)], "ja": [chr(0x3041 + k) for k in range(80)], "en": "abcdefghijklmnopqrstuvwxyz"}
    words = {s: ["".join(rng.choice(a) for _ in range(rng.randint(1, 6))) for _ in range(60)] for s, a in alphabets.items()}
    rows = [(k, " ".join(rng.choice(words[s]) for _ in range(40)), s) for k, s in enumerate(list(alphabets) * 40)]
    got = {r.doc_id: r.lang_pred for r in language.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(got[d] == s for d, _, s in rows) == len(rows)
    v = language.letter_vectors(np.arange(0x410, 0x450), language.DIMS).astype(int)
    assert (np.abs(v @ v.T - language.DIMS * np.eye(len(v))) < 150).all()
    whole = sum(n.sum() for _, n in language.trigrams("ab, c1 é " * 50))
    language_piece, language.PIECE = language.PIECE, 7
    assert sum(n.sum() for _, n in language.trigrams("ab, c1 é " * 50)) == whole
    language.PIECE = language_piece


def test_pages_in_linear_time_and_weights():
    import time

    for page in ("<a " * 60_000, "<a '>' " * 40_000, "<div>word " * 30_000, "<i>" * 30_000 + "<div></div></b>" * 30_000, "</section>" * 50_000, "<!-- " * 50_000, "<script>" * 20_000):
        began = time.time()
        html_text.main_text(page)
        assert time.time() - began < 5
    w = html_text.fit(np.array([[1.0, 0.0], [1.0, 1.0]] * 50), np.array([0.0, 1.0] * 50), np.zeros(2), pull=0.1)
    assert w[0] < -2 and w[0] + w[1] > 2


def test_the_cut_decides_doubtful_blocks():
    long = "A sentence of some words stands here, and goes on for a while. " * 4
    page = f"<div><p>{long}</p><p>no</p><p>{long}</p></div><div><a href=x>More</a></div><div><a href=y>Other</a></div>"
    odds = [a - b for a, b in html_text.costs(html_text.blocks(page))]
    assert odds[1] < 0 and html_text.main_text(page) == f"{long.strip()} no {long.strip()}"


def test_weights_tell_content_without_tags_and_names(spark):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(n))
    inner = lambda: f"<h1>{text(4)}</h1>" + "".join(f"<p>{text(rng.randint(5, 60))}.</p>" for _ in range(rng.randint(2, 6)))
    around = lambda x, tags: f"<{tags[0]}><a href=x>{text(1)}</a><a href=y>{text(1)}</a></{tags[0]}><div{tags[1]}>{text(6)}.</div><{tags[2]}>{x}</{tags[2]}><{tags[3]}>© {text(9)}.</{tags[3]}>"
    marked = [around(inner(), ("nav", " class=ad", "article", "footer")) for _ in range(150)]
    pages = spark.createDataFrame([(k, "u", p) for k, p in enumerate(marked)] + [(900, "u", None), (901, None, "")], "page_id long, url string, html string")
    weights = html_text.train(pages)
    plain = [inner() for _ in range(60)]
    wanted = [" ".join(b.text for b in html_text.blocks(x)) for x in plain]
    assert sum(html_text.main_text(around(x, ("div", "", "div", "div")), weights) == w for x, w in zip(plain, wanted, strict=True)) >= 55
    got = {r.page_id: r for r in html_text.extracted(pages).collect()}
    assert got[900].text == got[901].text == "" and got[900].n_chars == 0
    assert all(got[k].text == " ".join(b.text for b in html_text.blocks(p.split("<article>")[1].split("</article>")[0])) for k, p in enumerate(marked))


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    import tiktoken

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(rng.randint(40, 90))) for _ in range(60)]
    texts += [t + " end" for t in texts[:10]] + texts[10:15] + [f"{word()} {passage} {word()}" for _ in range(6)] + ["", None, "x"]
    toxic = set(range(20, 40, 2))
    texts = [f"{t} zork blarg zork" if k in toxic else t for k, t in enumerate(texts)]
    rows = [(k, t, "en", "s" if k % 3 else None, len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    many = [(k, int(k in toxic), 1) for k in range(60)]
    spark.createDataFrame(many, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert judged >= set(range(len(rows))) - toxic
    kept = [r for r in rows if r[0] in judged]
    first = {d for d, _, c in components(kept, 5, 80, 100) if d == c}
    kept = [r[:2] for r in kept if r[0] in first]
    want = {d: w[3] for d, w in repeats_by_force(kept).items()}
    assert {d: r.decoded_sha256 for d, r in got.items()} == want
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in got.values():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        text = enc.decode(ids)
        assert enc.encode_ordinary(text) == ids and len(ids) == r.n_tokens and hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256


def test_components_of_stars_chains_and_repeated_links(spark):
    from skiagram.llm.components import connected_components, spread_join

    rng = random.Random(6)
    links = [(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(70)] + [(5, 0)] * 3 + [(7, 7)]
    label = {x: x for a, b in links for x in (a, b) if a != b}
    for a, b in links * 8:
        if a != b:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if v == old else v for k, v in label.items()}
    df = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in connected_components(df).collect()} == set(label.items())
    assert connected_components(df.limit(0)).count() == 0
    table = spark.createDataFrame([(k, -k) for k in range(3000)], "a long, x long")
    for n in (0, 50, 10_000):
        assert sorted(map(tuple, spread_join(df, table, "a", n).select("a", "b", "x").collect())) == sorted((a, b, -a) for a, b in links)


def test_long_texts_and_rows_without_an_id(spark):
    import tiktoken

    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    long = "\n".join(" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(2000))
    rows = [(1, long), (2, long + " end"), (None, long[:400]), (None, "a short one"), (None, None), (3, "word " * 9), (4, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("en")})
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = sorted(hashlib.sha256(np.array(enc.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest() for d, t in rows if d != 4)
    got = bpe.encode_column(df.filter("doc_id is null or doc_id <> 4"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert sorted(r.ids_sha256 for r in got.collect()) == want
    n_words = {r.n_words for r in quality.quality(df, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert {60_000, 60_001, 0, 1, 9} <= n_words
    linked = {(r.doc_id, r.component_id) for r in jaccard.components(df, 3, 90, 100).collect()}
    assert linked == {(1, 1), (2, 1), (3, 3), (4, 4), (None, None)}
    assert jaccard.first_of_components(df, 3, 90, 100).filter("doc_id is null").count() == 3
    cut = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.digests(df).collect()}
    # the null id comes first, so the start of the long text is a repeat of it; its copy repeats it whole
    assert cut[None, 400] == 0 and cut[1, len(long)] == 400 and cut[2, len(long) + 4] == len(long) and cut[4, 200_000] == 199_999  # each string but the first starts one byte earlier too, so all bytes but the first are covered
    placed = mixing.mixed(df).orderBy("mix_order").collect()
    assert [r.doc_id for r in placed] == [None, None, None, 1, 2, 3, 4]
    total = sum(r.n_tokens for r in token_files.encode_and_read(df, P.path("byte_bpe_50k.json"), 2).collect())
    assert total > 100_000 and language.identified(df).filter("lang_pred = 'und'").count() == 1
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(df, labels).count() == 7
