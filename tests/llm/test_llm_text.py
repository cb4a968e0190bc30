"""Operators on documents against brute force, on small tables with every odd case."""

import hashlib
import random
import re
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from peakloom.llm import bpe, chaining, mixing, quality, sharding, simhash, substrings, tokens
from peakloom.llm.bwt import smallest_owner

KIND = "doc_id long, text string, source string, n_words string, size string, _id string"
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "Te", "su") for b in ("ra", "no", "é", "vi") for c in ("", "s", "ta")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


TEXTS = [
    (1, prose(1, 120)), (2, prose(1, 120)), (3, None), (4, ""), (5, " \n\t "), (6, prose(2, 3)),
    (7, prose(3, 40) + " " + prose(1, 60) + " " + prose(4, 30)), (8, prose(5, 20) * 30), (9, "x\n" * 400),
    (10, prose(6, 80).replace("ka", "KA")), (11, prose(6, 80)), (12, "$$$ ### " * 20), (13, "日本語 <|endoftext|> 😀 a  b"),
    (14, prose(7, 3000)), (15, prose(7, 3000) + " end"), (None, prose(8, 60)), (None, prose(8, 60)), (2, prose(1, 120)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 0 else f"s{k % 3}", "clash", "clash", "clash") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def measure(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def test_ledger_measures_whole_texts(docs):
    short = docs.where("doc_id is null or doc_id < 14")
    led = quality.apply_policy(quality.ledger(short), "web-2")
    got = [tuple(r) for r in led.select("text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed").collect()]
    assert len(got) == short.count()
    for text, *values, failed in got:
        n, *_, rep = want = measure(text)
        assert tuple(values) == want
        assert failed == (n < 10 or 100 * rep > 20 * n)


def test_policy_and_ablations_follow_from_the_bits(spark):
    led = spark.createDataFrame([(0,), (1,), (3,), (2,), (4,)], "failed long")
    assert [r.kept for r in quality.apply_policy(led, "base-1").collect()] == [True, False, False, False, True]
    found = {r.rule: (r.n_failed, r.n_only) for r in quality.ablations(led, "web-1").collect()}
    assert found["few_words"] == (2, 1) and found["repeated_words"] == (2, 1) and found["symbols"] == (1, 1)


def test_quality_keep_returns_the_columns_of_its_input(docs, empty):
    kept = quality.keep(docs, "web-2")
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} == {"clash"}
    assert quality.keep(empty, "web-2").count() == 0


def test_fingerprints_and_components(docs, empty):
    def brute(text):
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0d]+", words)
        hashes = [xxhash.xxh64(" ".join(words[i:i + 4]).encode(), seed=42).intdigest()
                  for i in range(max(1, len(words) - 3))] if words else []
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        return value - (1 << 64) if value >> 63 else value
    fps = [brute(t) for _, t in TEXTS]
    for tile in (3, 8192):
        got = simhash.near_duplicates(docs, tile=tile).collect()
        assert sorted((r.doc_id or 0, r.fp) for r in got) == sorted((i or 0, f) for (i, _), f in zip(TEXTS, fps))
        group = {f: {f} for f in fps}
        for a in group:
            for b in group:
                if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4 and group[a] is not group[b]:
                    both = group[a] | group[b]
                    group.update({f: both for f in both})
        name = {f: min((i for (i, _), g in zip(TEXTS, fps) if g in group[f] and i is not None), default=None) for f in fps}
        assert all(r.component_id == name[r.fp] for r in got)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(2) == 0 and ids.count(1) == 1 and ids.count(None) == 2
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_tile_forest_connects_what_links_connect(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 40)
    fps = np.unique(np.concatenate([base ^ (1 << int(b)) ^ (1 << int(c)) for b, c in rng.integers(0, 60, (20, 2))]))
    edges = simhash.links(spark.createDataFrame([(int(f),) for f in fps], "fp long"), tile=37).collect()
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for e in edges:
        assert (e.a ^ e.b).bit_count() >= 0
        root[max(find(e.a), find(e.b))] = min(find(e.a), find(e.b))
    got = {f: find(f) for f in root}
    root = {f: f for f in root}
    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {f: find(f) for f in root}


def test_windows_get_their_smallest_owner():
    rng = random.Random(5)
    for length in (3, 8, 50):
        base = bytes(rng.choice(b"abc") for _ in range(200))
        texts = [base[(a := rng.randint(0, 200)):a + rng.randint(0, 120)] + bytes(rng.choice(b"ab") for _ in range(20))
                 for _ in range(12)]
        owner = np.array([rng.randint(0, 9) for _ in texts])
        got, _ = smallest_owner(texts, owner, length)
        least = {}
        for t, o in zip(texts, owner):
            for i in range(len(t) - length + 1):
                least[t[i:i + length]] = min(least.get(t[i:i + length], 99), o)
        assert got.tolist() == [least[t[i:i + length]] for t in texts for i in range(len(t) - length + 1)]


def test_a_bucket_of_passages_takes_little_memory(monkeypatch):
    """Passages of a bucket meet some anchors at a time, never all of them as texts of their own."""
    rng, n, n_blocks = np.random.default_rng(3), 180_000, 3
    letters = np.frombuffer(b"abcdefghij ", np.uint8)
    known = [letters[rng.integers(0, 11, 52)].tobytes() for _ in range(n)]
    rows, least = [], {}
    for block in range(n_blocks):
        some = known[60_000 * block:60_000 * block + 60_000] + known[:9000]
        ids = rng.integers(1, 1000, len(some))
        for text, i in zip(some, ids.tolist()):
            for k in range(len(text) - 49):
                least[text[k:k + 50]] = min(least.get(text[k:k + 50], i), i)
        anchor = np.array([zlib.crc32(x) for x in some], np.uint64)
        rows.append((0, block, np.arange(len(some), dtype=np.uint32).tobytes(), anchor.tobytes(), ids.tobytes(),
                     ids.tobytes(), np.full(len(some), 52).tobytes(), zstandard.compress(b"".join(some)), some, ids))
    names = ["bucket", "block", "entry", "anchor", "least", "most", "size", "bytes"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in list(zip(*rows))[:8]], names)
    sent = SimpleNamespace(repartition=lambda *_: sent, mapInArrow=lambda run, _: run)
    monkeypatch.setattr(substrings, "parts", lambda _: 1)
    tracemalloc.start()
    try:
        out = list(substrings._owners(sent)(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got = {}
    for part in out:
        for block, runs in zip(*part.columns):
            for entry, start, end, doc in np.frombuffer(runs.as_buffer(), substrings._RUN).tolist():
                got |= {(block.as_py(), entry, k): doc for k in range(start, end)}
    want = {(row[1], e, k): least[text[k:k + 50]] for row in rows for e, (text, i) in enumerate(zip(row[8], row[9]))
            for k in range(3) if least[text[k:k + 50]] < i}
    assert got == want
    assert most < 5 * sum(len(x) for row in rows for x in row[8]), most


def test_removed_bytes(docs, empty):
    first = {}
    for i, t in TEXTS:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                first[b[k:k + 50]] = min(first.get(b[k:k + 50], 1 << 62), i)
    want = []
    for i, t in TEXTS:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first.get(b[k:k + 50], 1 << 62) < (1 << 61 if i is None else i):
                gone[k:k + 50] = True
        gone = gone[:-1]
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = substrings.deduplicate(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    stripped = substrings.strip(docs)
    assert stripped.columns == docs.columns and stripped.count() == len(TEXTS)
    assert substrings.deduplicate(empty).count() == 0


def test_fuzzy_passage_is_found_and_clean_text_left_alone(spark, empty):
    words = [f"{w}{k % 7}" for k, w in enumerate(prose(11, 80).split())]
    fuzzy = list(words)
    fuzzy[20], fuzzy[50] = "other", "words"
    del fuzzy[35]
    unique = lambda seed, n: " ".join(f"u{seed}x{k}" for k in range(n))
    rows = [(1, unique(1, 30) + " " + " ".join(words) + " " + unique(2, 20), "a"), (2, unique(3, 90), "a"),
            (3, unique(4, 10) + " " + " ".join(fuzzy), "a"), (4, None, "a"), (5, "", "a"), (None, " ".join(words), "a")]
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, words string")).collect()
    assert [(r.doc_id, r.other_id) for r in got] == [(3, 1)]
    assert (got[0].start_word, got[0].end_word, got[0].other_start, got[0].other_end) == (10, 89, 30, 110)
    assert got[0].aligned_words == 77
    assert chaining.repeated_passages(empty).count() == 0


def coded(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return chaining.word_codes(data, np.array([0, len(data)]))[0]


def fresh(name, n):
    return [f"{name}x{k}" for k in range(n)]


def test_several_passages_of_one_pair():
    one, two = fresh("p", 60), fresh("q", 60)
    both = [(0, 60, 0, 60, 60), (120, 180, 60, 120, 60)]
    assert chaining.passages(coded(one + fresh("n", 60) + two), coded(one + two)) == both
    a, b = fresh("p", 50), fresh("q", 50)
    for n in (40, 80, 115):
        got = chaining.passages(coded(a + fresh("m", n) + b), coded(a + fresh("n", n) + b))
        assert got == [(0, 50, 0, 50, 50), (50 + n, 100 + n, 50 + n, 100 + n, 50)]
    got = chaining.passages(coded(one + two + fresh("n", 90) + two), coded(one + two))
    assert got == [(0, 120, 0, 120, 120), (210, 270, 60, 120, 60)]
    p = fresh("p", 130)
    got = chaining.passages(coded(p), coded(p[80:] + fresh("n", 200) + p[:100]))
    assert got == [(0, 100, 250, 350, 100), (80, 130, 0, 50, 50)]


def test_passages_of_texts_that_repeat_themselves():
    line = fresh("l", 7)
    assert chaining.passages(coded(line * 24), coded(line * 24)) == [(0, 168, 0, 168, 168)]
    got = chaining.passages(coded(line * 24 + fresh("n", 9)), coded(fresh("m", 30) + line * 24))
    assert got == [(0, 168, 30, 198, 168)]
    passage = fresh("p", 50)
    got = chaining.passages(coded(passage), coded(passage[:20] + fresh("n", 300) + passage))
    assert got == [(0, 50, 320, 370, 50)]
    for seed in range(20):
        rng = random.Random(seed)
        one, two = (coded([rng.choice("ab") for _ in range(60)]) for _ in range(2))
        want = [(x, y, n - 4) for x in range(60) for y in range(60)
                if not (x and y and one[x - 1] == two[y - 1])
                and (n := next((k for k in range(60) if max(x, y) + k == 60 or one[x + k] != two[y + k]), 60)) > 4]
        assert chaining.anchors(one, two).tolist() == [list(w) for w in want]


def test_evenly_edited_passages_are_found(spark):
    rows, want, line = [], [], fresh("l", 7)
    for k, (period, n) in enumerate([(6, 60), (6, 300), (7, 42), (10, 40)]):
        one = fresh(f"p{k}", n)
        two = [f"{w}!" if j % period == period - 1 else w for j, w in enumerate(one)]
        rows += [(2 * k, " ".join(fresh(f"m{k}", 30) + one)), (2 * k + 1, " ".join(two + fresh(f"n{k}", 30)))]
        end = n - (n % period == 0)
        want.append((2 * k + 1, 2 * k, 0, end, 30, 30 + end, n - n // period))
    rows += [(i, " ".join(line * 24)) for i in (100, 101)]
    want.append((101, 100, 0, 168, 0, 168, 168))
    want = [w for w in want if w[3] >= 40]
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == want


def test_passage_whose_parts_belong_to_others(spark):
    p = fresh("p", 60)
    texts = [p[:34] + fresh("a", 40), fresh("b", 40) + p[29:], fresh("c", 20) + p, p + fresh("d", 20)]
    rows = [(k + 1, " ".join(t)) for k, t in enumerate(texts)]
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == [(4, 3, 0, 60, 20, 80, 60)]
    rng = random.Random(5)
    lines = [fresh(f"l{k}", 12) for k in range(12)]
    texts = [sum(rng.choices(lines, k=10), []) for _ in range(40)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    inside, first = [set() for _ in texts], {}
    for k, t in enumerate(texts):
        for a in range(len(t) - 39):
            if first.setdefault(tuple(t[a:a + 40]), k) < k:
                inside[k] |= set(range(a, a + 40))
    got = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        inside[r.doc_id] -= set(range(r.start_word, r.end_word))
    assert got and not any(inside)


def test_passages_against_all_pairs(spark, monkeypatch):
    """Every document against every earlier one: the rows found are among theirs, the words covered are the same,
    and documents that share a passage are in one class. Small blocks and buckets, clashing columns, shared ids."""
    monkeypatch.setattr(chaining, "BUCKET_WORDS", 2000)
    rng, rows = random.Random(8), []
    stock = [fresh(f"s{k}", rng.randint(40, 70)) for k in range(6)]
    for k in range(60):
        words = fresh(f"d{k}", rng.randint(0, 60))
        for part in rng.sample(stock, rng.randint(0, 3)):
            part = [w if rng.random() < 0.95 else f"e{k}x{j}" for j, w in enumerate(part)]
            words += part + fresh(f"t{k}{part[1]}", rng.randint(0, 120))
        rows.append((k, " ".join(words), "clash", 1))
    split = fresh("p", 80)
    for k in range(10):
        rows.append((80 + k, " ".join(fresh(f"a{k}", 60) + split[8 * k:8 * k + 7]), "clash", 1))
    for k in (100, 101):
        rows.append((k, " ".join(f"o{k}x{j}" if j % 8 == 7 else w for j, w in enumerate(split)), "clash", 1))
    rows += [(102, rows[3][1], "clash", 1), (102, "Other " + rows[4][1], "clash", 1), (None, rows[5][1], "clash", 1),
             (103, None, "clash", 1), (104, "", "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, owner long")
    got = chaining.with_classes(chaining.repeated_passages(docs.repartition(3))).collect()
    known = [(i, coded((t or "").split())) for i, t, *_ in rows if i is not None and len((t or "").split()) >= 40]
    want = {(i, j, *p) for i, one in known for j, two in known if j < i for p in chaining.passages(one, two)}
    assert {tuple(r)[:7] for r in got} <= want and (101, 100) in {tuple(r)[:2] for r in got}
    cover = lambda found: {(r[0], k) for r in found for k in range(r[2], r[3])}
    assert cover(got) == cover(want)
    group = {i: r.class_id for r in got for i in (r.doc_id, r.other_id)}
    assert all(group[r[0]] == group[r[1]] for r in want)
    assert all(r.class_id == min(i for i in group if group[i] == r.class_id) for r in got)
    links = {(r.doc_id, r.other_id) for r in got}
    assert all(r.n_links == sum(d == r.doc_id for d, _ in links) for r in got)


def test_every_pair_of_different_texts_is_linked(spark, monkeypatch):
    """six texts around one passage, dealt to several blocks, are linked pair by pair; copies have one link each."""
    monkeypatch.setattr(chaining.pack, "__defaults__", (chaining.MIN_WORDS, 150))
    p = fresh("p", 50)
    texts = [fresh(f"a{k}", 30 + k) + p + fresh(f"b{k}", 20) for k in range(6)]
    rows = [(10 * k, " ".join(t)) for k, t in enumerate(texts)]
    rows += [(i, " ".join(texts[2]).upper()) for i in (21, 22, 55)] + [(21, " ".join(texts[2])), (70, " ".join(fresh("c", 90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = chaining.with_classes(chaining.repeated_passages(docs)).collect()
    pairs = {(10 * i, 10 * j): (30 + i, 80 + i, 30 + j, 80 + j, 50) for i in range(6) for j in range(i)}
    copies = {(i, 20): (0, 102, 0, 102, 102) for i in (21, 22, 55)}
    assert {tuple(r)[:2]: tuple(r)[2:7] for r in got} == pairs | copies and len(got) == len(pairs) + 3
    assert {r.doc_id: r.n_links for r in got} == {10: 1, 20: 2, 30: 3, 40: 4, 50: 5, 21: 1, 22: 1, 55: 1}
    assert {r.class_id for r in got} == {0}


@pytest.mark.parametrize("identity", [0.8, 0.6])
def test_texts_without_a_passage_are_set_aside_unread(spark, monkeypatch, identity):
    """Of the pairs that share a seed none with a passage is lost, and few others are compared: edits of every kind
    around the identity, passages far from a seed of their own, stock phrases in every text."""
    monkeypatch.setattr(chaining.pack, "__defaults__", (chaining.MIN_WORDS, 4000))
    rng, stock = random.Random(4), fresh("s", 9)
    parts_ = [fresh(f"p{k}", rng.choice([40, 41, 49, 59, 79, 120])) for k in range(6)]
    texts = []
    for k in range(90):
        words = fresh(f"a{k}", rng.randint(30, 90)) + stock + fresh(f"b{k}", rng.randint(30, 90))
        for part in rng.sample(parts_, k % 3):
            rate = rng.choice([0, 0.05, 0.1, 0.15, 0.2])
            for j, w in enumerate(part):
                kind = rng.choice("sid") if rng.random() < rate else ""
                words += {"s": [f"e{k}x{j}"], "i": [w, f"e{k}x{j}"], "d": [], "": [w]}[kind]
            words += fresh(f"c{k}{part[0]}", rng.randint(0, 60))
        texts.append(words)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    kept, want, every = [], set(), 0
    for row in chaining.tiles(docs)[1].collect():
        one = chaining._Tile(*row[1:5])
        two = one if row[5] == row[0] else chaining._Tile(*row[6:10])
        kept += [(int(one.ids[i]), int(two.ids[j])) for i, j in chaining.near(one, two, 40, identity)]
        for i in range(len(one.ids)):
            for j in range(i + 1 if one is two else 0, len(two.ids)):
                seeds = np.intersect1d(one.shared(i)[2], two.shared(j)[2])
                later = [(one, i), (two, j)][::1 if one.ids[i] > two.ids[j] else -1]
                every += len(seeds) > 0
                if len(seeds) and chaining._compared(*later[0], *later[1], 40, identity):
                    want.add((int(one.ids[i]), int(two.ids[j])))
    assert len(kept) == len(set(kept)) and want and want <= set(kept)
    assert every == 90 * 89 // 2 and (identity < 0.7 or len(kept) < len(want) + every // 4)


def test_a_very_long_text_has_its_passages(spark):
    long, passage = fresh("v", 150_000), fresh("p", 60)
    texts = [long, fresh("a", 50) + passage, long[:70_000] + passage + long[70_000:]]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    got = sorted(map(tuple, chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert (2, 1, 70_000, 70_060, 50, 110, 60) in got
    covered = {k for r in got if r[1] == 0 for k in range(r[2], r[3])}
    assert covered >= {*range(70_000), *range(70_060, 150_060)}


def test_mix_reaches_its_targets(docs, empty):
    got = mixing.mix(docs)
    assert got.columns == [c for c in docs.columns if c != "size"] + mixing.OUT
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert sorted(r["size"] for r in rows) == sorted(measure(t)[0] for _, t in TEXTS)
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * total) < 1e-6 * total
    assert all(t <= 2 * s + 1e-9 for _, t, s in by.values())
    assert rows_of(mixing.mix(docs)) == rows_of(got)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0


def test_shards_fit_their_limit(docs, empty):
    limit = 3000
    got = sharding.assign(docs, limit).collect()
    assert len(got) == len(TEXTS)
    total, hashes = {}, {}
    for r in got:
        total[r.shard] = total.get(r.shard, 0) + r.n_bytes
        hashes.setdefault(r.shard, set()).add(r.hash)
        assert f"{r.hash:032b}".startswith(r.shard) and r.depth == len(r.shard)
    assert all(total[r.shard] == r.shard_bytes for r in got)
    assert all(total[s] <= limit or len(hashes[s]) == 1 for s in total)
    shards = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert sharding.assign(empty, limit).count() == 0


@pytest.mark.parametrize("operator, added", [
    (lambda d: quality.apply_policy(quality.ledger(d), "web-2"), [*quality.MEASURES, "failed", "base_failed", "kept"]),
    (lambda d: quality.keep(d, "web-2"), []), (mixing.mix, mixing.OUT), (mixing.mixed, []),
    (simhash.keep_one, []), (substrings.strip, [])], ids=["ledger", "keep", "mix", "mixed", "keep_one", "strip"])
def test_other_columns_stay(docs, operator, added):
    """Columns that carry the operators' own helper names, dots or maps come back as they were."""
    names = ["_text", "_words", "_lines", "_codes", "_grams", "_pairs", "_starts", "_row", "_key", "_tie", "_null", "_sum",
             "_cum", "_pass", "_s", "_hash", "_n", "_least", "fp", "component_id", "rows", "codes", "_kept0_", "_kept1_", "a.b"]
    rows = docs.select("doc_id", "text", "source").where("doc_id is null or doc_id not in (13, 14, 15)")
    rows = rows.select("*", *[F.concat(F.lit(n), F.coalesce(F.md5("text"), F.lit("-"))).alias(n) for n in names],
                       F.create_map(F.lit(1), F.coalesce("doc_id", F.lit(-1))).alias("m"))
    got = operator(rows)
    assert got.columns == rows.columns + added
    want = {r.doc_id: r for r in rows.collect()}
    found = got.collect()
    assert found
    for r in found:
        assert all(r[n].startswith(n) and r[n][len(n):] == want[r.doc_id][n][len(n):] for n in names)
        assert r.m == {1: -1 if r.doc_id is None else r.doc_id}


def test_shards_leave_other_columns_alone(docs):
    names = ["prefix", "_prefix", "_depth", "a.b", "_kept0_"]
    wide = docs.select("doc_id", "text", *[F.lit(n).alias(n) for n in names], F.create_map(F.lit(1), F.lit(2)).alias("m"))
    got = sharding.assign(wide, 3000)
    assert got.columns == wide.columns + ["hash", "n_bytes", "shard", "depth", "shard_bytes", "oversize"]
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(r[n] == n for r in rows for n in names) and all(r.m == {1: 2} for r in rows)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(0)
    letters = "abcXYZ'’019 \n\t<|>éÉßİΣ日́ \x1c😀.,-$ 　\xa0"
    return [t or "" for _, t in TEXTS] + ["it's don't WE'LL", "ﬁ ǅ K Å", "<|startoftext|>x<|endoftext|>"] + [
        "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]


def test_forced_boundaries_equal_the_library(odd_texts):
    own = bpe.Splitter(public_tokenizers.path(bpe.VOCABULARY))
    whole = own.whole.encode_batch(odd_texts, add_special_tokens=False)
    for text, want in zip(odd_texts, whole):
        ids, decoded = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert decoded == own.whole.decode(want.ids, skip_special_tokens=False)
    piece = next(a + b for a in "qxzj" for b in "qxzj" if (a, b) not in own.inside)
    assert own.cut("the" + piece) == ["the" + piece[0], piece[1]] or len(own.cut("the" + piece)) > 1


def test_bpe_digests(docs, empty):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    got = bpe.digests(docs).collect()
    want = []
    for i, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.digests(empty).count() == 0 and bpe.encode(docs).count() == len(TEXTS)


def test_token_files_round_trip(spark, docs, empty, odd_texts):
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    rows = [(k, t) for k, t in enumerate(odd_texts)] + [(None, "no id"), (7, None)]
    manifest = tokens.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), frame=2000)
    back = tokens.read_tokens(manifest).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    assert len(back) == len(rows)
    place = 0
    for r in sorted(back, key=lambda r: r.start):
        found = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == place and found in ids[r.doc_id]
        place += len(found)
    order = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert order == [None, *sorted(i for i in order if i is not None)]
    some = tokens.read_tokens(manifest, [3, 900]).collect()
    assert sorted(r.doc_id for r in some) == [3, 900]
    reader = tokens.Reader(manifest.first()["file"])
    reader.ids(0)
    assert reader.frames_read == 1 and len(reader.seek) > 1
    got = {(r.doc_id, r.ids_crc32) for r in tokens.digests(docs).collect()}
    assert {(i, zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()))
            for i, t in TEXTS} == got
    assert tokens.digests(empty).count() == 0


def test_rows_without_an_id_fill_several_files(spark):
    """Their texts are still read back whole, in one order, with starts that go on from file to file."""
    rows = [(None, prose(k, 30)) for k in range(200)] + [(7, prose(300, 20)), (9, None)]
    manifest = tokens.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert manifest.count() > 2 and max(r.n_docs for r in manifest.collect()) < 150
    back = sorted(tokens.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert [r.start for r in back] == [sum(len(x.ids) // 4 for x in back[:k]) for k in range(len(back))]
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    want = [(i, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in rows]
    got = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in back]
    assert sorted(map(str, got)) == sorted(map(str, want)) and [i for i, _ in got][-2:] == [7, 9]


def test_a_damaged_frame_is_noticed(spark, tmp_path):
    docs = spark.createDataFrame([(1, prose(1, 400))], "doc_id long, text string")
    uri = tokens.write_tokens(docs, f"file://{tmp_path}").first()["file"]
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[40] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        tokens.Reader(uri).ids(0)


def test_long_text(spark):
    text = prose(9, 200_000)
    docs = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    cut = {r.doc_id: r.n_removed for r in substrings.deduplicate(docs).collect()}
    assert cut[1] == 0 and cut[2] >= len(text.encode())
    assert len({r.component_id for r in simhash.near_duplicates(docs).collect()}) == 1
    assert docs.count() == tokens.digests(docs).count() == bpe.digests(docs).count()
