"""Nearest neighbours, archives and the pipeline on small tables."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from peakloom.llm import bpe, hnsw, warc


def test_neighbours_reach_their_recall(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 24)).astype(np.float32)
    vectors[500:900] = vectors[500]  # one vector is very common
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(10_000, None), (10_050, [0.0] * 24), (10_100, [None] + [1.0] * 23), (10_150, [float("nan")] * 24),
             (10_200, [float("inf")] + [1.0] * 23), (None, [1.0] * 24), (10_250, [1.0, 2.0]), (10_300, [2.0, 4.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = hnsw.vectors(table)
    got = hnsw.search(hnsw.index(good, shard_rows=700), good.where("vec_id % 50 = 0")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == {*range(0, 3000, 50), 10_250, 10_300}
    assert by[10_250] == [(10_300, pytest.approx(1.0))]
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        score = np.round(unit @ unit[q], 12)
        score[q] = -2
        best = np.lexsort((np.arange(3000), -score))[:5]
        hits += len(set(best) & {i for i, _ in by[q]})
        assert [s for _, s in by[q]] == sorted((s for _, s in by[q]), reverse=True)
        assert all(abs(s - unit[i] @ unit[q]) < 1e-9 for i, s in by[q])
    assert hits >= 0.9 * 300
    # ties go to the smaller id
    assert [i for i, _ in by[550]] == [500, 501, 502, 503, 504]
    none = hnsw.vectors(table.where("false"))
    assert hnsw.search(hnsw.index(none), none).count() == 0


def test_neighbours_of_doubles_and_shared_ids(spark):
    """Doubles keep their precision and range; an id that many rows share is spread over the shards; equal rows are
    all candidates; clashing columns are not read."""
    rows = [(0, [0.3, 1.0]), (1, [0.30000001, 1.0]), (2, [1e39, 0.0]), (3, [1e300, 1e300]), (4, [1e-300, 0.0])]
    rows += [(7, [1.0, 0.01 * k]) for k in range(40)] + [(8, [-1.0, 0.5])] * 4
    kind = "vec_id long, embedding array<double>, v string, times string, file string"
    table = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], kind)
    good = hnsw.vectors(table)
    built = hnsw.index(good, shard_rows=12)
    assert built.where("n_nodes > 0").count() > 2
    got = hnsw.search(built, good.where("vec_id in (0, 2, 3, 8)")).collect()
    unit = [(i, *(np.array(v) / max(map(abs, v)) / np.linalg.norm(np.array(v) / max(map(abs, v))))) for i, v in rows]
    for q in (0, 2, 3, 8):
        x, y = next(u[1:] for u in unit if u[0] == q)
        best = sorted((-(x * a + y * b), i) for i, a, b in unit if i != q)[:5]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r.vec_id for r in mine] == [i for _, i in best]
        assert all(abs(r.score + s) < 1e-15 for r, (s, _) in zip(mine, best))
    near = next(r for r in got if r.query_id == 0 and r["rank"] == 1)
    assert near.vec_id == 1 and near.score <= 1.0
    assert [r.vec_id for r in hnsw.search(built, good.where("vec_id = 1")).collect()].count(8) == 0
    away = hnsw.search(built, spark.createDataFrame([(50, [-1.0, 0.5])], "vec_id long, v array<double>")).collect()
    assert sorted(r.vec_id for r in away)[-4:] == [8] * 4


PAGES = [(1, "http://a", "x" * 200), (2, "http://b c", "x" * 200), (3, None, "x" * 200), (4, "u", "short"), (5, "u", "short"),
         (6, "u", None), (None, "n", "x" * 200), (0, "z", "é" * 50), (2, "http://b c", "x" * 200), (8, "v", "a\r\n\r\nb" * 40),
         (9, "w", "WARC/1.0\r\n" * 30), (7, "v", "a\r\n\r\nb" * 40)]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")
    got = warc.read_warc(warc.convert(warc.write_arc(pages.repartition(3)))).collect()
    first = {}
    for i, _, h in PAGES:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    assert len(got) == len(PAGES)
    sha = lambda h: hashlib.sha256((h or "").encode()).hexdigest()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (str(i), len((h or "").encode()), sha(h)) for i, _, h in PAGES)
    digest = {sha(h): i for h, i in first.items()}
    for r in got:
        if r.record_type == "revisit":
            assert r.refers_to == digest[r.payload_digest]
        else:
            assert r.refers_to is None
    responses = [r.page_id for r in got if r.record_type == "response"]
    assert sorted(responses) == [0, 1, 4, 5, 6, 7, 9]
    assert len({r.record_id for r in got}) >= len(PAGES) - 1
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", r.record_id) for r in got)
    assert warc.read_warc(warc.convert(warc.write_arc(pages.where("false")))).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_legacy_header_lines(tmp_path, version):
    chunks = warc.arc_chunks([(1, "http://x/a b", b"body\n\nmore"), (2, "dns:host", b"")], version, "t.arc", "19991231235958")
    uri = warc.write_file(f"file://{tmp_path}", "t", chunks)
    records = list(warc.arc_records(uri))
    assert [h["URL"] for h, _ in records] == ["http://x/a%20b", "dns:host"]
    found = warc.describe(*records[0])
    assert found["date"] == "1999-12-31T23:59:58Z" and found["payload"] == b"body\n\nmore" and found["page_id"] == 1
    plain = warc.describe({**records[0][0], "URL": "ftp://y z"}, b"no http head")
    assert plain["type"] == "resource" and plain["payload"] == b"no http head"
    with pytest.raises(ValueError):
        bad = warc.write_file(f"file://{tmp_path}", "b", [warc._member(b"filedesc://x 0 0 text/plain 6\n9 0 x\n")])
        list(warc.arc_records(bad))


def test_pipeline_keeps_clean_documents_once(spark, tmp_path):
    from test_llm_text import prose
    texts = [prose(k, 150) for k in range(20)]
    rows = [(k, t, "en", f"s{k % 2}", len(t), "own") for k, t in enumerate(texts)]
    rows += [(100, texts[3], "en", "s1", 1, "own"), (101, "!!! " * 50, "en", "s0", 1, "own"), (102, None, "en", "s0", 0, "own"),
             (103, prose(77, 100) + " " + texts[5][:400], "en", None, 1, "own"), (None, prose(90, 100), "en", "s1", 1, "own")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, size string"
    docs, seen = spark.createDataFrame(rows, kind), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append([r.doc_id for r in docs.select("doc_id").collect()])
        if k == 2:
            cut = {r.doc_id: r for r in docs.collect()}
            assert texts[5][60:340] not in cut[103].text and cut[5].text == texts[5]
            assert all(r.n_chars == len(r.text) and r.size == "own" for r in cut.values())
    clean = set(range(20)) | {103, None}
    assert set(seen[0]) == clean | {100} and set(seen[1]) == set(seen[2]) == clean
    assert set(seen[3]) <= clean and max(seen[3].count(i) for i in clean) == 2
    assert sorted(map(str, seen[4])) == sorted(map(str, seen[3]))
    none = spark.createDataFrame([], kind)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0


def by_rules(rows):
    from test_llm_text import measure

    def good(text):
        n, chars, symbols, doubled, repeated = measure(text)
        lines = sum(bool(x.strip(" \t\n\v\f\r")) for x in (text or "").split("\n"))
        return (n >= 10 and 100 * repeated <= 20 * n and 10 * symbols <= 3 * n and 2 * n <= chars <= 15 * n
                and 100 * doubled <= 40 * lines and 10 * (text or "").count("!") <= 5 * n)
    return [r for r in rows if good(r[1])]


def one_of_each(rows):
    def fingerprint(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hashes = [xxhash.xxh64(" ".join(words[k:k + 4]).encode(), seed=42).intdigest()
                  for k in range(max(1, len(words) - 3))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    marks, group = [fingerprint(r[1]) for r in rows], list(range(len(rows)))
    for a, one in enumerate(marks):
        for b, two in enumerate(marks):
            if (one ^ two).bit_count() <= 4:
                group = [group[a] if g == group[b] else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [r for r, g in zip(rows, group) if r[0] is None or r[0] == least[g]]


def without_passages(rows):
    first, out = {}, []
    for i, text, *_ in rows:
        for k in range(len((text or "").encode()) - 49) if i is not None else ():
            piece = text.encode()[k:k + 50]
            first[piece] = min(first.get(piece, i), i)
    for i, text, *rest in rows:
        data = (text or "").encode()
        gone = {k + j for k in range(len(data) - 49) for j in range(50)
                if first.get(data[k:k + 50], 1 << 62) < (1 << 61 if i is None else i)}
        out.append((i, bytes(b for k, b in enumerate(data) if k not in gone).decode("utf-8", "ignore"), *rest))
    return out


def in_mix(rows):
    """Every row as often as it is taken; sources in order weigh 3, 1, 2."""
    place = lambda s: (s is None, s or "")
    size = [len(re.findall(r"[^\x20\x09-\x0d]+", r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=place)
    total = {s: sum(n for r, n in zip(rows, size) if r[3] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    full: set = set()
    while True:
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in full)) / sum(
            weight[s] for s in sources if s not in full)
        more = {s for s in sources if 2 * total[s] <= level * weight[s]}
        if more <= full:
            break
        full |= more
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    visits = []
    for s in sources:
        target, upto = 2.0 * total[s] if s in full else level * weight[s], 0
        keys = sorted((md5(f"mix:{'null' if r[0] is None else r[0]}"), md5(r[1] or ""), k)
                      for k, r in enumerate(rows) if r[3] == s)
        for key, tie, k in keys:
            upto += size[k]
            visits += [((p * total[s] + upto) / target, *place(s), p, key, tie, k) for p in (0, 1) if size[k]]
    out, served = [], 0
    for *_, k in sorted(visits):
        served += size[k]
        if served > 1.5 * sum(total.values()):
            break
        out.append(rows[k])
    return out


def test_pipeline_equals_plain_python(spark, tmp_path):
    """The whole result of `run`, ids and digests included, against the five stages in plain Python."""
    from test_llm_text import prose
    texts = [prose(200 + k, 30 + 11 * k) for k in range(14)]
    rows = [(k, t, "en", ("s0", "s1", "s2", None)[k % 4 if k % 5 else 0], len(t)) for k, t in enumerate(texts)]
    odd = [texts[3], "Intro words. " + texts[9][:500] + " and some more", texts[4].upper(), texts[6] + "!", None, "", "few words",
           "!!! " * 50, prose(240, 4) * 12, "ünï " + texts[11][7:200] + " 日本語 " + prose(241, 40), "$ # " * 30 + prose(242, 20)]
    rows += [(20 + k, t, None, f"s{k % 3}", None) for k, t in enumerate(odd)]
    rows += [(None, prose(250, 50), "en", "s1", 1), (None, texts[2], "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    library, want = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY)), []
    for i, text, *_ in in_mix(without_passages(one_of_each(by_rules(rows)))):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), ids, hashlib.sha256(decoded.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    taken = [r[0] for r in want]
    assert 10 < len(set(taken)) < len(taken) and len(set(taken)) < len(rows) - 5


def test_equal_records_have_ids_of_their_own(spark):
    page = "<p>" + "x" * 200
    rows = [(1, "http://a/", page)] * 2 + [(None, "http://a/", page)] * 3 + [(2, "http://b/", "short")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_warc(warc.convert(warc.write_arc(pages.repartition(2)))).collect()
    assert len({r.record_id for r in got}) == len(rows)
    assert sorted(r.record_type for r in got) == ["response"] * 3 + ["revisit"] * 4
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}
