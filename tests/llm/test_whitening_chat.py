"""Whitening and chat formatting against plain Python and numpy."""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadlens.llm import charpoly_whitening as cw
from roadlens.llm import prefix_chat
from roadlens.llm.common import table

# -- whitening --------------------------------------------------------------


def by_force(vectors, wanted=8):
    """deviation per row, eigenvalue shares and |whitened| for simple eigenvalues, with numpy in double precision."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64)
    n = len(x)
    from_mean = n * x - x.sum(axis=0)
    cov = (from_mean.astype(float).T @ from_mean) / n**3
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:wanted], basis[:, ::-1][:, :wanted]
    return (from_mean**2).sum(axis=1), values / np.trace(cov), np.abs((from_mean / n) @ basis / np.sqrt(values))


def test_whitening_query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    deviation, shares, white = by_force([r.embedding for r in rows])
    out = entry.queries()["op11_charpoly"](spark, sf_dir).orderBy("vec_id", "component").collect()
    assert len(out) == 8 * len(rows) and {r.n for r in out} == {len(rows)}
    for i, r in enumerate(out):
        at, k = divmod(i, 8)
        assert (r.vec_id, r.component, r.deviation) == (rows[at].vec_id, k + 1, deviation[at])
        assert math.isclose(r.explained, shares[k], rel_tol=1e-9) and math.isclose(abs(r.whitened), white[at, k], rel_tol=1e-7, abs_tol=1e-9)
    assert {r.identity_error for r in out} == {out[0].identity_error} and out[0].identity_error < 1e-12


def whitened(spark, vectors, **more):
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    return cw.whiten(rows, **more).orderBy("vec_id", "component").collect()


def test_repeated_eigenvalues_get_orthonormal_components(spark):
    # +-e_i on every axis: one eigenvalue of multiplicity 5
    vectors = [[s * (i == j) for j in range(5)] for i in range(5) for s in (1.0, -1.0)]
    out = whitened(spark, vectors)
    white = np.array([r.whitened for r in out]).reshape(10, 5)
    assert np.allclose(white.T @ white / 10, np.eye(5), atol=1e-14) and np.allclose([r.explained for r in out], 0.2, rtol=1e-15)


def test_close_eigenvalues_are_told_apart(spark):
    # eigenvalues 2 (10^6)^2 and 2 (10^6 + 1)^2 on skew axes: equal to eight digits in double precision of the covariance
    a, b = 10**6, 10**6 + 1
    vectors = [[s * x / 1024 for x in v] for s in (1, -1) for v in ((a, a, 0), (b, -b, 0), (0, 0, 1))]
    out = whitened(spark, vectors)
    white = np.array([r.whitened for r in out]).reshape(6, 3)
    root3 = math.sqrt(3)
    assert np.allclose(np.abs(white[:3]), [[0, root3, 0], [root3, 0, 0], [0, 0, root3]], atol=1e-14)
    total = 2 * a * a + 2 * b * b + 1
    assert [r.explained for r in out[:3]] == pytest.approx([2 * b * b / total, 2 * a * a / total, 1 / total], rel=1e-15)


def test_dependent_dimensions_have_no_component(spark):
    out = whitened(spark, [[i / 1024, 2 * i / 1024, 5.0] for i in range(4)])
    assert [r.component for r in out] == [1] * 4 and all(r.explained == 1.0 for r in out)
    assert [abs(r.whitened) for r in out] == pytest.approx([abs(i - 1.5) / math.sqrt(1.25) for i in range(4)], rel=1e-15)
    assert [r.deviation for r in out] == [5 * (4 * i - 6) ** 2 for i in range(4)]


def test_numbers_beyond_64_bits_stay_exact(spark):
    big = 2.0**45
    vectors = [[big, 1.0], [-big, 2.0], [3.0, big / 2], [0.0, -7.0]]
    out = whitened(spark, vectors)
    x = [[int(1024 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    assert [r.deviation for r in out[::2]] == [Decimal(sum((4 * c - s) ** 2 for c, s in zip(v, sums))) for v in x]
    assert out[0].identity_error < 1e-12
    tiny = whitened(spark, [[1e300, 0.0], [-1e300, 1.0], [0.0, 0.0]])  # saturates, deviation beyond 38 digits or exact
    assert len(tiny) == 6 and all(math.isfinite(r.whitened) for r in tiny)


def test_whitening_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, n string, component string, i int"
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [nan, 1.0], [1.0, inf], [None, 1.0], [1.0, 2.0, 3.0]]
    good = [[0.5, 0.0], [0.5, 0.0], [-0.25, 1.0], [0.0, 0.0]]
    rows = [(i, v, "a", "b", 1) for i, v in enumerate(bad)] + [(None, good[0], None, None, None), (7, good[1], "a", "b", 1), (7, good[2], "", "", 0), (8, good[3], "", "", 0)]
    out = cw.whiten(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id, r.component) for r in out if r.vec_id is not None) == [(7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2)]
    assert len(out) == 8 and sum(r.vec_id is None for r in out) == 2 and {r.n for r in out} == {4}
    deviation, shares, white = by_force(good)
    assert sorted({(r.component, round(abs(r.whitened), 9)) for r in out}) == sorted({(k + 1, round(white[i, k], 9)) for i in range(4) for k in range(2)})
    assert cw.whiten(spark.createDataFrame([], schema)).collect() == []
    assert cw.whiten(spark.createDataFrame(rows[:6], schema)).collect() == []
    assert cw.whiten(spark.createDataFrame(rows[7:8] * 3, schema)).collect() == []


def test_characteristic_polynomial_and_roots(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(-50, 50, (7, 5)).astype(object)
    m = a @ a.T  # rank 5 of 7
    c = cw.characteristic_polynomial(spark, m)
    for x in (-3, 0, 2, 1000):  # det(x - m) by exact elimination
        lead = [[Decimal(int(x * (i == j) - m[i, j])) for j in range(7)] for i in range(7)]
        det = round(np.linalg.det(np.array(lead, float)))
        value = sum(k * x**i for i, k in enumerate(c))
        assert value == 0 if x == 0 else math.isclose(value, det, rel_tol=1e-6)
    assert c[7] == 1 and c[6] == -np.trace(m) and c[:2] == [0, 0]
    roots = cw.largest_roots(c, 8)
    assert [r[2] for r in roots] == [1] * 5
    assert [float(cw.decimal_of(a, s)) for a, s, _, _ in roots] == pytest.approx(np.linalg.eigvalsh(m.astype(float))[::-1][:5], rel=1e-9)


def test_repeated_roots_are_counted():
    c = [1]
    for root in (5, 5, 5, 2, 2, 9, 0):
        c = [x - root * y for x, y in zip([0, *c], [*c, 0])]
    assert cw.square_free([*c][1:]) == [-90, 73, -16, 1]
    assert [(cw.decimal_of(a, s), k) for a, s, k, _ in cw.largest_roots(c, 8)] == [(9, 1), (5, 3), (2, 2)]


# -- chat -------------------------------------------------------------------

TRICKY = ["", "\\", "<\\|im_end|>", "<|im_end|>", "\\<|im_end|>", "<<|im_end|>>", "<|im_sep|><|im_start|>", "[INST][/INST]", "</s", ">", "a\\\\<s>b\n", "<<SYS>> x <</SYS>>", "é<|\U0001f600"]


def test_escape_is_reversible_and_hides_control_strings(spark):
    df = spark.createDataFrame([(x + y,) for x in TRICKY for y in TRICKY], "t string")
    t = F.col("t")
    for r in df.select("t", prefix_chat.escaped(t).alias("e"), prefix_chat.unescaped(prefix_chat.escaped(t)).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in prefix_chat.CHAT.controls)


def test_template_with_other_marks(spark):
    own = prefix_chat.Template(start="{", middle=":", end="}", others=())
    rows = [(1, 0, "user", "a:{b}\\"), (1, 1, "assistant", "}:")]
    stream = prefix_chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), own)
    assert [(r.role, r.text, r.loss_text) for r in prefix_chat.read_turns(stream, own).orderBy("position").collect()] == [("user", "a:{b}\\", None), ("assistant", "}:", "}:")]
    with pytest.raises(ValueError):
        prefix_chat.Template(start="\\x")


def expanded_by_force(turns):
    """Examples (text, loss) of one conversation, spelled out."""
    c = prefix_chat.CHAT

    def esc(t):
        t = t.replace("\\", "\\\\")
        for s in c.controls:
            t = t.replace(s, s[0] + "\\" + s[1:])
        return t

    out, context = [], ""
    for role, text in turns:
        head = context + c.start + esc(role) + c.middle
        context = head + esc(text) + c.end
        if role == "assistant":
            out.append((context, esc(text), len(head)))
    if not turns or turns[-1][0] != "assistant":
        out.append((context, None, None))
    return out


def test_examples_are_prefixes_with_one_trained_reply(spark):
    talks = {
        1: [("system", "be brief"), ("user", "hi"), ("assistant", "<|im_end|>hello"), ("user", "more"), ("assistant", "\\")],
        2: [("assistant", "first"), ("assistant", ""), ("user", "left open")],
        3: [("user", "only <s> me")],
        4: [(("user", "assistant")[i % 2], f"t{i}") for i in range(900)],  # over several blocks of turns
    }
    rows = [(c, t, role, text) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    stream = prefix_chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    out = prefix_chat.example_texts(prefix_chat.examples(stream), stream).collect()
    for c, turns in talks.items():
        got = sorted((r for r in out if r.conv_id == c), key=lambda r: r.turns)
        want = expanded_by_force(turns)
        assert [r.text for r in got] == [w[0] for w in want] and [r.chars for r in got] == [len(w[0]) for w in want]
        assert [None if r.example is None else r.text[r.loss_start : r.loss_end] for r in got] == [w[1] for w in want]
        assert [r.loss_start for r in got] == [w[2] for w in want]


def test_digests_are_read_from_written_examples(spark):
    talks = {
        1: [("system", "be brief"), ("user", "hi"), ("assistant", "<|im_end|>hello<"), ("user", "more"), ("assistant", "\\")],
        2: [("assistant", "first"), ("assistant", ""), ("user", "left open")],
        3: [("user", "only <s> me")],
        4: [(("user", "assistant")[i % 2], f"t{i}<|im_sep") for i in range(2 * prefix_chat.RUN + 5)],  # contexts of several pieces
        None: [("user", "é"), ("assistant", "\U0001f600")],
    }
    rows = [(c, t, role, text) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    stream = prefix_chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    texts, losses = {}, {}
    pieces = prefix_chat.expanded(stream)
    for r in prefix_chat.read_examples(pieces).orderBy("piece").collect():
        key = (r.conv_id, r.turns)
        assert r.start == len(texts.get(key, "")) and len(r.read) <= prefix_chat.RUN
        texts[key] = texts.get(key, "") + r.text
        if r.loss_start is not None:
            losses[key] = (r.loss_start, r.loss_end, r.loss_text)
    for c, turns in talks.items():
        want = expanded_by_force(turns)
        mine = sorted(k for k in texts if k[0] == c)
        assert [texts[k] for k in mine] == [w[0] for w in want]
        assert [losses[k][:2] if k in losses else None for k in mine] == [None if w[1] is None else (w[2], w[2] + len(w[1])) for w in want]
        assert [losses[k][2] for k in mine if k in losses] == [text for role, text in turns if role == "assistant"]
    # what the texts say is what counts: the digests come from no other table
    out = {r.conv_id: r for r in prefix_chat.digests(stream).collect()}
    for c, turns in talks.items():
        assert out[c].n_turns == len(turns) and out[c].formatted_chars == sum(len(w[0]) for w in expanded_by_force(turns))
        assert out[c].turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
        assert out[c].loss_sha256 == hashlib.sha256("".join(text for role, text in turns if role == "assistant").encode()).hexdigest()
    with pytest.raises(ValueError):
        prefix_chat.read_examples(pieces, prefix_chat.Template(end="aa"))


def test_chat_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string, position string, segment string"
    rows = [
        (1, 1, "assistant", None, "x", "y"), (1, 0, None, "q", None, None), (1, None, "user", "first", None, None),
        (2, 0, "assistant", "same", None, None), (2, 0, "assistant", "same", None, None), (None, 0, "assistant", "z" * 300_000, None, None),
        (3, 5, "Assistant", "other role", None, None), (3, -700, "user", "before", None, None),
    ]
    out = {r.conv_id: r for r in prefix_chat.digests(prefix_chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}

    def digest(*turns):
        return hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()

    assert out[1].turns_sha256 == digest(("user", "first"), ("", "q"), ("assistant", "")) and out[1].loss_chars == 0
    assert (out[2].n_turns, out[2].loss_chars, out[2].loss_sha256) == (2, 8, hashlib.sha256(b"samesame").hexdigest())
    assert out[None].loss_chars == 300_000 and out[3].turns_sha256 == digest(("user", "before"), ("Assistant", "other role")) and out[3].loss_chars == 0
    assert prefix_chat.digests(prefix_chat.format_conversations(spark.createDataFrame([], schema))).collect() == []


def test_chat_stays_in_the_jvm(spark, sf_dir):
    stream = prefix_chat.format_conversations(table(spark, sf_dir, "conversations"))
    for df in (stream, prefix_chat.digests(stream)):
        assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
