"""Operators over documents: results against plain Python on the small table and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from roadlens.llm import bagminhash, bitplane_files, bm25_packing, chunk_dedup, qda_quality, queries, source_mix
from roadlens.llm.common import table, utf8_buffers
from roadlens.llm.token_ids import Encoder

WORD_BPE = public_tokenizers.path(queries.WORD_BPE)
BYTE_BPE = public_tokenizers.path(queries.BYTE_BPE)
AWKWARD = [
    "", " ", "\n", "a", "a  b\n\n c\t d x y 　 z\n", " a\n b", "x\r\n\r\ny  ", "foo'll  it's\n\n\nBar\x1fz", "<|endoftext|> hi",
    "İΣς word", "ab" * 200 + " c", " *** --", "don't !'s x's's ½² 12,5km “q” —", "é ̂x", "\U0001d4b3 y",
]
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with used names."""
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    data = [
        (1, "one two three four five six", "en", "a", 7), (1, "one two three four five six", "en", "a", 7),
        (2, "one two three four five six", "en", "b", None), (3, None, None, None, None), (None, "", "en", "a", 0),
        (None, None, None, None, None), (4, long_text, "en", "a", 1), (5, long_text + " end", "en", "", 1), (6, "", "de", "\U0001f600", 1),
        (7, "é" * 40_000, "fr", "z", 1),
    ]
    df = spark.createDataFrame(data, EMPTY)
    return df.withColumn("row_id", F.lit("x")).withColumn("key", F.lit(1)).withColumn("mix_copies", F.lit(2.5)).withColumn("label", F.lit("q"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], EMPTY)


# -- token ids --------------------------------------------------------------


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_pieces_give_the_ids_of_whole_texts(path, rows):
    encoder = Encoder(path)
    texts = AWKWARD + [r["text"] for r in rows] + AWKWARD
    ids, upto = encoder(*utf8_buffers(pa.array(texts)))
    whole = encoder.encode_whole(texts)
    assert [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:])] == whole
    for text in AWKWARD:
        ids, _ = encoder(*utf8_buffers(pa.array([text])))
        assert ids.tolist() == encoder.encode_whole([text])[0]


def token_ids(path, text, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


# -- packing ----------------------------------------------------------------


def check_packed(pieces, expected, window):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, all_ids in expected.items():
        got = collections.Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id])
        left = collections.Counter()
        for ids in all_ids:
            left[len(ids)] += len(ids)
        for (start, length, crc, n), times in got.items():
            assert any(len(ids) == n and zlib.crc32(ids[start : start + length].tobytes()) == crc for ids in all_ids)
            left[n] -= length * times
        assert not any(left.values())
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == window or at & (at - 1) == 0
    return by_sequence


def test_packing_query(spark, sf_dir, rows):
    pieces = entry.queries()["op2_packing"](spark, sf_dir).collect()
    check_packed(pieces, {r["doc_id"]: [token_ids(WORD_BPE, r["text"], 1)] for r in rows}, bm25_packing.WINDOW)


def test_packing_awkward_rows(awkward, nothing):
    pack = lambda df, window: bm25_packing.pack_documents(df, WORD_BPE, 1, queries.WORD_BPE_SIZE, window)
    expected = collections.defaultdict(list)
    for r in awkward.collect():
        expected[r.doc_id].append(token_ids(WORD_BPE, r.text, 1))
    check_packed(pack(awkward, 64).collect(), expected, 64)
    assert pack(nothing, 64).collect() == []


def test_packing_puts_related_documents_together():
    rng = np.random.default_rng(1)
    texts = [rng.integers(100 * (i % 5), 100 * (i % 5) + 100, 50) for i in range(60)]
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=500)
    index = bm25_packing.ShardIndex(texts, np.log1p((60 - df + 0.5) / (df + 0.5)), 50.0)
    order = bm25_packing.order_by_retrieval(index, [50] * 60, 500, 500)
    assert sorted(order) == list(range(60))
    same = np.mean([order[i] % 5 == order[i + 1] % 5 for i in range(59)])
    assert same > 0.85  # 0.2 if documents came in table order


def test_packing_brings_related_documents_of_all_files_together(spark):
    """Every file holds one document of each of eight subjects."""
    rng = np.random.default_rng(3)
    subjects = [[f"{name}{i}" for i in range(12)] for name in ("harbour", "violin", "granite", "orchard", "cricket", "enzyme", "senate", "glacier")]
    data = [(i, " ".join(rng.choice(subjects[i % 8], 60))) for i in range(320)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 40), "doc_id long, text string")
    held = collections.defaultdict(list)
    for p in bm25_packing.pack_documents(df, WORD_BPE, 1, queries.WORD_BPE_SIZE).collect():
        held[p.sequence_id].append((p.offset, p.doc_id))
    pairs = [(a % 8, b % 8) for own in held.values() for (_, a), (_, b) in zip(sorted(own), sorted(own)[1:])]
    assert np.mean([a == b for a, b in pairs]) > 0.8  # about 0.1 if each file is packed alone


def test_packing_scores_all_terms_of_the_seed():
    texts = [np.repeat(np.arange(40), [3] * 39 + [1]), np.array([39, 39, 41]), np.array([42, 43])]
    index = bm25_packing.ShardIndex(texts, np.ones(50), 50.0)
    index.seed(0)
    assert index.neighbours() == [0, 1]


@pytest.mark.parametrize("common", [2, 8, 10**9])
def test_neighbours_come_in_the_order_of_plain_bm25_to_the_last(monkeypatch, common):
    """All unused documents that share a term, however many: fetched in turns, common terms dense or not."""
    monkeypatch.setattr(bm25_packing, "COMMON", common)
    rng = np.random.default_rng(9)
    texts = [rng.zipf(1.3, rng.integers(1, 80)).clip(0, 399).astype(np.uint16) for _ in range(300)]
    df = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=400)
    idf, mean = np.log1p((300 - df + 0.5) / (df + 0.5)), float(np.mean([len(t) for t in texts]))
    index = bm25_packing.ShardIndex(texts, idf, mean)
    for seed in (0, 17, 250):
        index.seed(seed)
        index.unused[:] = True
        index.unused[[seed, 5, 6]] = False
        plain = {}
        for d, text in enumerate(texts):
            tf = collections.Counter(text.tolist())
            norm = bm25_packing.K1 * (1 - bm25_packing.B + bm25_packing.B * len(text) / mean)
            plain[d] = sum(idf[t] * tf[t] * (bm25_packing.K1 + 1) / (tf[t] + norm) for t in set(texts[seed].tolist()) & set(tf))
        want = [plain[d] for d in sorted(plain, key=lambda d: -plain[d]) if d not in (seed, 5, 6) and plain[d] > 0]
        got = []
        while more := index.neighbours():
            assert len(more) >= min(bm25_packing.NEIGHBOURS, len(want) - len(got))
            got += more
            index.unused[more] = False
        assert len(got) == len(set(got)) == len(want) and np.allclose([plain[d] for d in got], want, rtol=1e-5)


def test_a_seed_fills_its_window_with_all_its_neighbours_first():
    texts = [np.array([1, 2], np.uint16) if i % 2 else np.array([3, 4], np.uint16) for i in range(400)]
    index = bm25_packing.ShardIndex(texts, np.ones(10), 2.0)
    order = bm25_packing.order_by_retrieval(index, [2] * 400, 10_000, 10_000)
    assert [k % 2 for k in order] == [0] * 200 + [1] * 200


# -- token files ------------------------------------------------------------


def test_bitplane_query(spark, sf_dir, rows):
    got = {r.doc_id: r for r in entry.queries()["op3_bitplane"](spark, sf_dir).collect()}
    at = 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = token_ids(BYTE_BPE, r["text"], 0)
        g = got[r["doc_id"]]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_bitplane_awkward_rows(awkward, nothing):
    images = bitplane_files.write_token_files(awkward, BYTE_BPE, 0, bits=False, shard_ids=1000)
    got = bitplane_files.read_token_files(images).orderBy("start").collect()
    assert [g.doc_id for g in got] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert [g.start for g in got] == np.concatenate([[0], np.cumsum([g.n_tokens for g in got])[:-1]]).tolist()
    long_text = awkward.where("doc_id = 4").first().text
    assert next(g for g in got if g.doc_id == 4).ids_crc32 == zlib.crc32(token_ids(BYTE_BPE, long_text, 0).tobytes())
    assert bitplane_files.read_token_files(bitplane_files.write_token_files(nothing, BYTE_BPE, 0)).collect() == []


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("top", [60_000, 1 << 20])
@pytest.mark.parametrize("n", [0, 1, 7, 4096, 10_001])
def test_image_round_trip(bits, top, n):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    image = bitplane_files.Image(bitplane_files.write_image(ids, [None, 5], np.array([0, n]), bits, 4096))
    assert np.array_equal(np.concatenate([np.zeros(0, np.uint32), *image.parts(0, n)]), ids)
    if n > 5000:
        assert np.array_equal(np.concatenate(list(image.parts(4000, 500))), ids[4000:4500])
    if bits and n:
        planes = bitplane_files.to_planes(ids, 4, True)
        for k, plane in enumerate(planes):
            assert np.array_equal(np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:n], (ids >> k) & 1)


# -- near duplicates --------------------------------------------------------


def bag(text):
    words = (text or "").split()
    if not words:
        return collections.Counter()
    return collections.Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def overlap(a, b):
    both = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def classes_by_force(rows):
    bags = [(r["doc_id"], r["text"] or "", bag(r["text"])) for r in rows]
    label = {d: d for d, _, _ in bags}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, s, x) in enumerate(bags):
        for b, t, y in bags[:i]:
            if s == t or (min(len(x), len(y)) and overlap(x, y) >= 0.8):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {d: root(d) for d in label}


def test_near_duplicates_query(spark, sf_dir, rows):
    out = entry.queries()["op4_bagminhash"](spark, sf_dir).collect()
    assert {r.doc_id: r.class_id for r in out} == classes_by_force(rows)
    kept = collections.Counter(r.class_id for r in out if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.class_id for r in out})


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    texts = []
    for _ in range(200):
        base = [f"w{rng.integers(60)}" for _ in range(40)] * int(rng.integers(1, 9))
        other = list(base)
        for _ in range(int(rng.integers(0, 40))):
            other[rng.integers(len(other))] = f"x{rng.integers(99)}"
        texts += [" ".join(base), " ".join(other)]
    found = bagminhash.signatures(*bagminhash.bags(*utf8_buffers(pa.array(texts))), len(texts))
    seen = (found[::2] == found[1::2]).mean(axis=1)
    true = np.array([overlap(bag(a), bag(b)) for a, b in zip(texts[::2], texts[1::2])])
    assert abs((seen - true).mean()) < 0.01
    assert np.sqrt(((seen - true) ** 2).mean()) < 1.3 * np.sqrt((true * (1 - true) / bagminhash.COMPONENTS).mean())


@pytest.mark.parametrize("kind", ["path", "random", "star", "none"])
def test_components_equal_union_find(spark, kind):
    rng = np.random.default_rng(4)
    names = rng.permutation(400) * 7
    edges = {
        "path": [(names[i], names[i + 1]) for i in range(199)], "random": [tuple(rng.choice(names, 2)) for _ in range(260)],
        "star": [(names[0], x) for x in names[1:]], "none": [],
    }[kind]
    edges = [(int(a), int(b)) for a, b in edges if a != b]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = bagminhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(parent) and {r.node: r.label for r in got} == {x: root(x) for x in parent}


def test_near_duplicates_beyond_the_hub(spark):
    """A group of copies edited apart, larger than a block: links between members that are not hubs count too."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    rows, edited = [], list(base)
    for i in range(640):
        if i % 8 == 0:
            edited = list(edited)
            edited[int(rng.integers(300))] = f"e{i}"
        rows.append({"doc_id": i, "text": " ".join([*edited, f"own{i}"])})
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    out = bagminhash.near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in out} == classes_by_force(rows)


def test_near_duplicates_awkward_rows(awkward, nothing):
    out = bagminhash.near_duplicates(awkward).collect()
    classes = collections.defaultdict(list)
    for r in out:
        classes[r.class_id].append(r.doc_id)
    assert {k: sorted(map(str, v)) for k, v in classes.items()} == {
        1: ["1", "1", "2"], 3: ["3", "6", "None", "None"], 4: ["4", "5"], 7: ["7"],
    }
    kept = bagminhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.count() == 4
    assert bagminhash.near_duplicates(nothing).collect() == []


# -- quality ----------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = entry.queries()["op5_quality"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert len(out) == 1000 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_model_equals_densities(spark):
    rng = np.random.default_rng(5)
    d = len(qda_quality.FEATURES)
    x = {0: rng.normal(1, 2, (400, d)), 1: rng.normal(0, 1, (900, d))}
    rows = [(int(k), r.tolist()) for k, own in x.items() for r in own]
    model = qda_quality.fit(spark.createDataFrame(rows, "label long, x array<double>"), shrinkage=0.1, ridge=0.01)
    for k, own in x.items():
        cov = np.cov(own.T, bias=True)
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 0.01 * np.eye(d)
        diff = own[:5] - own.mean(axis=0)
        expected = np.log(len(own) / 1300) - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1]
        assert np.allclose(model[k].log_density(own[:5]), expected)


def test_quality_awkward_rows(spark, awkward, nothing, sf_dir):
    labels = table(spark, sf_dir, "labels")
    stats = qda_quality.described(awkward)
    assert stats.count() == awkward.count()
    model = qda_quality.train(qda_quality.described(table(spark, sf_dir, "documents")), labels)
    scores = qda_quality.scored(stats, model).collect()
    assert len(scores) == awkward.count() and all(np.isfinite(r.score) for r in scores)
    assert qda_quality.keep_good(awkward, labels.limit(0)).collect() == awkward.collect()  # nothing to reject by
    assert qda_quality.keep_good(nothing, labels).collect() == []


# -- exact duplicates -------------------------------------------------------


def groups_by_force(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r["text"] or ""].append(r["doc_id"])
    return out


@pytest.mark.parametrize("hash_bits", [64, 3])
def test_exact_dedup_is_exact_at_any_hash_width(docs, rows, hash_bits):
    groups = groups_by_force(rows)
    out = chunk_dedup.duplicate_groups(docs, hash_bits).collect()
    text = {r["doc_id"]: r["text"] or "" for r in rows}
    for r in out:
        own = groups[text[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))
        assert r.text_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert len(out) == len(rows)


def test_long_texts_share_chunks(spark):
    rng = np.random.default_rng(2)
    text = " ".join(f"w{x}" for x in rng.integers(0, 5000, 40_000))
    df = spark.createDataFrame([(1, text), (2, "inserted " + text), (3, text)], "doc_id long, text string")
    found = chunk_dedup.recipes(df).select("doc_id", "recipe", "bodies").collect()
    by_id = {r.doc_id: r for r in found}
    assert all("".join(r.bodies) == t for r, t in ((by_id[1], text), (by_id[2], "inserted " + text)))
    assert by_id[1].recipe == by_id[3].recipe != by_id[2].recipe
    assert len(set(by_id[1].recipe) & set(by_id[2].recipe)) > 0.9 * len(by_id[1].recipe) > 9


def test_exact_dedup_awkward_rows(awkward, nothing):
    out = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in chunk_dedup.duplicate_groups(awkward).collect())
    assert out == collections.Counter([
        (1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (3, 6, 4, False), (None, 6, 4, False), (None, 6, 4, False),
        (6, 6, 4, True), (4, 4, 1, True), (5, 5, 1, True), (7, 7, 1, True),
    ])
    kept = chunk_dedup.deduplicate(awkward)
    expected = {(r.doc_id, r.text, r.lang, r.label) for r in awkward.where("doc_id in (2, 4, 5, 6, 7)").collect()}
    assert kept.columns == awkward.columns and {(r.doc_id, r.text, r.lang, r.label) for r in kept.collect()} == expected
    assert chunk_dedup.deduplicate(nothing).collect() == []


# -- mixing -----------------------------------------------------------------


def targets_by_force(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Water filling, source by source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, out = share * sum(sizes.values()), set(), {}
    while True:
        level = left / max(1e-12, sum(weight[s] for s in names if s not in full))
        over = [s for s in names if s not in full and weight[s] * level > most * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in names if s not in full}
        for s in over:
            full.add(s)
            out[s] = most * sizes[s]
            left -= out[s]


def test_mix_query(spark, rows):
    sf = "/root/testdata/sf0.01"
    source = {r.doc_id: (r.source, len(r.text.split())) for r in table(spark, sf, "documents").collect()}
    out = entry.queries()["op9_mix"](spark, sf).collect()
    again = entry.queries()["op9_mix"](spark, sf).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in out:
        name, words = source[r.doc_id]
        assert r.size == words and r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        sizes[name] += r.size
        taken[name] += r.taken
    expected = targets_by_force(sizes)
    for r in out:
        name = source[r.doc_id][0]
        assert r.source_size == sizes[name] and r.target == pytest.approx(expected[name])
    for name, words in taken.items():
        assert abs(words - expected[name]) < 0.06 * expected[name]


def test_repeated_rows_of_a_pair_meet_as_one_bag_each(spark):
    base = [f"w{i}" for i in range(100)]
    left, right = " ".join(base), " ".join([*base[:97], "x", "y", "z"])
    df = spark.createDataFrame([(1, left)] * 1000 + [(2, right)] * 1000 + [(3, "something else altogether")], "doc_id long, text string")
    wanted = bagminhash.signed(df).select(F.col("row_id").alias("node"), "digest", "doc_id").dropDuplicates(["digest"])
    assert bagminhash.full_bags(df, wanted).count() == 3
    out = bagminhash.near_duplicates(df).groupBy("doc_id", "class_id", "class_size").agg(F.count(F.lit(1)), F.sum(F.col("kept").cast("int"))).collect()
    assert sorted(map(tuple, out)) == [(1, 1, 2000, 1000, 1), (2, 1, 2000, 1000, 0), (3, 3, 1, 1, 1)]


def test_mix_plain_bernoulli_probability(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    rates = source_mix.mix_rates(df, weights=(1.0, 3.0), share=0.9, calibrate=False)
    counts = source_mix.mix_sources(df, weights=(1.0, 3.0), share=0.9, calibrate=False).groupBy("source").count().collect()
    rate = {r.source: r.rate for r in rates.collect()}
    for r in counts:
        n = 20_000 * (1 if r.source == "x" else 2) / 3
        assert abs(r["count"] / n - rate[r.source]) < 0.02


def test_mix_awkward_rows(awkward, nothing):
    rates = {r.source: r for r in source_mix.mix_rates(awkward).collect()}
    sizes = collections.Counter()
    for r in awkward.collect():
        sizes[r.source] += len((r.text or "").split())
    assert {s: r.source_size for s, r in rates.items()} == dict(sizes)
    for s, target in targets_by_force({s: n for s, n in sizes.items()}).items():
        assert rates[s].target == pytest.approx(target)
    mixed = source_mix.mix_sources(awkward)
    assert mixed.columns == awkward.columns and mixed.count() <= 2 * awkward.count()
    assert source_mix.mix_sources(nothing).collect() == []
