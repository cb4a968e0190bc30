"""Whitening, fill-in-the-middle and packing against plain Python."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from peakloom.llm import bestfit, skiplist, whitening

# --- whitening -------------------------------------------------------------------------------------

ODD = [(None, [0.5] * 5 + [0.0]), (7, None), (8, []), (9, [None] + [0.1] * 5), (10, [float("nan")] + [0.1] * 5),
       (11, [float("-inf")] + [0.1] * 5), (12, [0.1, 0.2]), (13, [2.0 ** 40] + [0.0] * 5), (900, [0.25] * 5 + [0.0]),
       (900, [0.25] * 5 + [0.0])]
VECTORS = "vec_id long, embedding array<float>, n string, x string, component string"


def vector_rows(count=400, d=6, seed=3):
    rng = np.random.default_rng(seed)
    spread = np.array([5.0, 2.0, 2.0, 0.5, 0.1, 0.0])[:d]  # the last dimension is constant
    points = rng.normal(size=(count, d)) * spread
    points[50:200] = points[50]  # one vector is very common
    return [(k, p.astype(np.float32).tolist()) for k, p in enumerate(points)]


def test_whitening_equals_a_dense_decomposition(spark):
    rows = vector_rows() + ODD
    table = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], VECTORS).repartition(5)
    got = whitening.whiten(table).collect()
    good = [(i, np.floor(64 * np.array(v, np.float32).astype(float)) + 1_000_000) for i, v in rows
            if v and len(v) == 6 and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 2.0 ** 34]
    x = np.array([v for _, v in good])
    n, s = len(x), x.sum(axis=0)
    z = (n * x - s) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:5], vectors.T[::-1][:5]
    assert {r.n for r in got} == {n} and len(got) == 5 * n
    white = z @ (vectors / np.sqrt(values)[:, None]).T
    sign = {}
    by = Counter()
    want = {}
    for (i, _), w, dev in zip(good, white, ((n * x - s) ** 2).sum(axis=1)):
        want.setdefault(i, []).append((w, int(dev)))
    for r in got:
        w, dev = want[r.vec_id][0]
        assert r.deviation == dev
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        sign.setdefault(r.component, np.sign(r.whitened * w[r.component - 1]) or 1.0)
        assert r.whitened == pytest.approx(sign[r.component] * w[r.component - 1], abs=1e-7)
        by[r.vec_id, r.component] += 1
    assert by[900, 1] == 2 and by[None, 5] == 1
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    assert set(table.columns) - {"x"} <= {*got[0].asDict()}


def test_whitening_of_little(spark):
    kind = "vec_id long, embedding array<double>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        found = whitening.whiten(spark.createDataFrame(rows, kind))
        assert found.count() == 0 and {"component", "whitened", "identity_error"} <= set(found.columns)
    # fewer vectors than dimensions: as many components as the rank
    rng = np.random.default_rng(0)
    rows = [(k, rng.normal(size=40).tolist()) for k in range(5)]
    found = whitening.whiten(spark.createDataFrame(rows, kind)).collect()
    assert {r.component for r in found} == {1, 2, 3, 4} and found[0].identity_error < 1e-9


def test_decomposition_keeps_small_eigenvalues():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    want = np.logspace(0, -9, 48)
    values, vectors = whitening.decompose((turn * want) @ turn.T)
    assert np.allclose(values, want, rtol=1e-5) and np.allclose(vectors @ vectors.T, np.eye(48), atol=1e-13)
    factor, pivots = whitening.pivoted_cholesky((turn * want) @ turn.T)
    assert np.allclose((factor @ factor.T), ((turn * want) @ turn.T)[np.ix_(pivots, pivots)], atol=1e-14)


def test_deviation_is_exact_or_null():
    x = np.array([[3_000_000_000, 0], [-3_000_000_000, 1]], np.int64)
    assert whitening._deviations(x, 2, x.sum(axis=0)).to_pylist() == [None, None]
    x = np.array([[1_500_000_000, 0], [0, 1]], np.int64)
    assert whitening._deviations(x, 2, x.sum(axis=0)).to_pylist() == [1_500_000_000 ** 2 + 1] * 2


# --- fill in the middle ----------------------------------------------------------------------------

def expected(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    x = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_the_middle_equals_plain_python(spark):
    rng = random.Random(4)
    alphabet = ["a", "é", "日", "😀", "\n", "\n", " ", "\r", " ", "\x0b", "<", "P", "S", "M", ">", "\x00"]
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))) for k in range(400)]
    rows += [(None, "a\nb\nc"), (None, None), (500, ""), (501, "\n"), (502, "\n" * 50), (503, "x <M> y\nz"), (5, rows[5][1]),
             (504, "".join(f"line {k} é\n" for k in range(60_000))), (505, "x" * 1_000_000), (506, "<\n<P\nS>\n>" * 9)]
    kind = "doc_id long, text string, n string, output string, `a.b` map<string,int>"
    docs = spark.createDataFrame([(i, t, "clash", "clash", {"a": 1}) for i, t in rows], kind).repartition(6)
    done = skiplist.restore(skiplist.transform(docs))
    got = [(r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored, r["a.b"])
           for r in done.collect()]
    want = [(i, t, *expected(i, t), t or "", {"a": 1}) for i, t in rows]
    assert Counter(map(repr, got)) == Counter(map(repr, want))
    assert {r[3] for r in got} == {"plain", "psm", "spm"}
    assert skiplist.transform(docs.where("false")).count() == 0
    assert {r.form for r in skiplist.transform(docs, rate=0).collect()} == {"plain"}


def test_skip_list_reaches_every_rank_in_few_steps():
    rng = random.Random(0)
    widths = np.array([rng.randint(1, 80) for _ in range(20_000)])
    units, upto = skiplist.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert len(units.lanes) >= 6 and len(units.lanes[-1][0]) < 40
    assert [units.place(r) for r in range(0, 20_001, 7)] == upto[::7].tolist()
    for count in range(12):
        assert skiplist.SkipList(widths[:count]).place(count) == widths[:count].sum()
    with pytest.raises(IndexError):
        units.place(20_001)


# --- packing ---------------------------------------------------------------------------------------

def best_fit(lengths, capacity):
    """Sequences of plain best-fit decreasing."""
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        n += at == len(gaps)
        gap = (gaps.pop(at) if at < len(gaps) else capacity) - x
        if gap:
            bisect.insort(gaps, gap)
    return n


def packing_rows():
    rng = random.Random(2)
    words = ["alpha", "Beta", "it's", "日本", "x", "<|endoftext|>", "don't", "9", "naïve", " ", "…"]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    rows = [(k, text(rng.choice([0, 1, 3, 8, 20, 50]))) for k in range(300)]
    rows += [(1000 + k, "alpha " * 9) for k in range(200)]  # one length is very common
    return rows + [(None, None), (None, "alpha"), (2000, ""), (2001, " \n\t"), (2002, text(400)), (5, rows[5][1]),
                   (2003, "a\x0bb\x0cc\rd e"), (2004, "﻿é é İ ǅ")]


def test_packing_holds_every_piece_once_and_few_sequences(spark):
    rows, cap = packing_rows(), 64
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, length string").repartition(5)
    got = bestfit.pack(docs, cap).collect()
    library = Tokenizer.from_file(public_tokenizers.path(bestfit.VOCABULARY))
    library.no_truncation()
    want, lengths = Counter(), []
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, start in enumerate(range(0, len(ids), cap)):
            piece = ids[start:start + cap]
            lengths.append(len(piece))
            want[i, p, start, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        ends = 0
        for offset, length in sorted(spans):
            assert offset == ends
            ends += length
        assert ends <= cap
    assert -(-sum(lengths) // cap) <= len(by) <= best_fit(lengths, cap)
    assert bestfit.pack(docs.where("false")).count() == 0
    whole = bestfit.sequences(docs, cap).collect()
    assert len(whole) == len(by) and sum(r.n_tokens for r in whole) == sum(lengths)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole)


def test_words_encode_as_the_whole_text_does():
    rng = random.Random(0)
    letters = "abcXYZ'’019 \n\t\x0b<|>éÉßİΣ日\u0301\x1c😀.,-$\u2003\u3000\xa0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|startoftext|>x<|endoftext|> y", "<|startoftext|>", "a <|endoftext|>b", "ﬁ ǅ K Å", ""]
    own = bestfit.Encoder(public_tokenizers.path(bestfit.VOCABULARY))
    want = [x.ids for x in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for part in (slice(0, 2000), slice(1000, 3005), slice(3000, 3005), slice(3004, 3005)):
        raw = [t.encode() for t in texts[part]]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        ids, ends = own.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want[part]


def test_a_long_text_is_cut_into_whole_sequences(spark):
    docs = spark.createDataFrame([(1, "alpha beta " * 100_000), (2, "one")], "doc_id long, text string")
    got = sorted(bestfit.pack(docs).collect(), key=lambda r: (r.doc_id, r.piece))
    long = [r for r in got if r.doc_id == 1]
    assert [r.start for r in long] == [2048 * k for k in range(len(long))] and long[-1].length <= 2048
    assert all(r.length == 2048 for r in long[:-1]) and len({r.sequence_id for r in got}) == len(long)


@pytest.mark.parametrize("low, high, count, slack", [(1, 256, 4000, 0), (80, 256, 4000, 0), (30, 90, 3000, 0), (1, 20, 5000, 0)])
def test_patterns_use_all_counts_and_beat_best_fit(low, high, count, slack):
    rng = random.Random(low)
    counts = Counter(rng.randint(low, high) for _ in range(count))
    plan, used = bestfit.patterns(counts, 256), Counter()
    for pattern, times in plan:
        assert sum(length * n for length, n in pattern.items()) <= 256
        for length, n in pattern.items():
            used[length] += n * times
    assert used == counts
    assert sum(times for _, times in plan) <= best_fit(counts.elements(), 256) + slack


def test_sums_are_indexed_as_lengths_run_out():
    rng = random.Random(5)
    for _ in range(100):
        counts = Counter(rng.choices(range(1, 31), k=rng.randint(1, 20)))
        index = bestfit.Complements(counts, 30)
        for length in [x for x in counts if rng.random() < 0.5]:
            index.take(Counter({length: 1}))
            del counts[length]
        sums = lambda k: [sum(1 for c in itertools.product(counts, repeat=k) if sum(c) == s)
                          for s in range(31)]
        assert index.singles.tolist() == sums(1) and index.pairs.tolist() == sums(2)
        assert index.triples.tolist() == sums(3)
