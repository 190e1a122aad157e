"""Operators 11 to 13 against brute force, and their defined cases."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import AWKWARD
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from livepulse.llm import divergence, vector_codes, warc
from livepulse.session import scratch_dir

# ---- operator 11 ----------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload binary, record_type string"


def pages_of(spark, rows):
    """Pages with further columns named as columns of records are."""
    return spark.createDataFrame([(*r, b"clash", "clash") for r in rows], PAGES)


def expected_pages(rows, least=1000):
    groups = collections.defaultdict(list)
    for p, _, h in rows:
        groups[(h or "").encode()].append(p)
    out = []
    for data, ids in groups.items():
        digest = hashlib.sha1(data).hexdigest()
        best = max(ids, key=lambda p: (p is not None, p or 0))
        response = len(ids) if len(data) < least else 1
        ids.remove(best)
        out.append((best, len(data), digest, "response", None))
        out += [(p, len(data), digest, "response" if response > 1 else "revisit", None if response > 1 else best) for p in ids]
    return collections.Counter(out)


def test_archived_pages_against_brute_force(spark):
    rnd = random.Random(3)
    texts = ["<p>" + "é word " * n for n in (0, 1, 150, 200, 5000)] + ["x" * 999, "x" * 1000, "\r\n\r\nWARC/1.1\r\n" * 90, "", None]
    rows = [(i, f"http://h/{i % 7}", rnd.choice(texts)) for i in range(120)]
    rows += [(5, "http://again", texts[3]), (900, "http://a", texts[4]), (900, "http://a", texts[4]), (900, "http://b", texts[4]),
             (900, None, texts[4]), (None, "u", texts[3]), (None, None, "y" * 1200), (None, None, "y" * 1200), (7, "a\nb: c", "z" * 3000)]
    got = warc.archive_pages(pages_of(spark, rows).repartition(5))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collections.Counter(map(tuple, got.collect())) == expected_pages(rows)


def test_no_pages(spark):
    assert warc.archive_pages(pages_of(spark, [])).collect() == []
    assert warc.read_archives(spark, scratch_dir(spark, "test", "nowhere")).collect() == []


def test_hot_group_of_pages(spark):
    """Above one row in 4096, so joined by broadcast; others by shuffle."""
    rows = [(i, "u", "h" * 1500) for i in range(6000)] + [(10_000 + i, "u", f"{i % 20} " * 600) for i in range(40)]
    got = warc.archive_pages(pages_of(spark, rows), least_bytes=1000)
    assert collections.Counter(map(tuple, got.collect())) == expected_pages(rows)


def test_data_source_pushes_filters_and_skips_payloads(spark):
    folder = scratch_dir(spark, "test", "archive")
    rows = spark.range(300).select(
        F.concat(F.lit("urn:r:"), "id").alias("record_id"), F.when(F.col("id") % 3 == 0, "resource").otherwise("response").alias("record_type"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("http://h/"), "id")).alias("target_uri"),
        F.repeat(F.lit("p"), F.col("id").cast("int")).cast("binary").alias("payload"))
    warc.write_archives(rows, folder, file_bytes=4000)
    back = warc.read_archives(spark, folder)
    assert back.count() == 300
    whole = {r.record_id: (r.record_type, r.target_uri, r.payload_bytes, bytes(r.payload)) for r in back.collect()}
    want = {r.record_id: (r.record_type, r.target_uri, len(r.payload), bytes(r.payload)) for r in rows.collect()}
    assert whole == want
    for condition in ("record_type = 'resource'", "record_type <> 'resource'", "target_uri is null", "target_uri > 'http://h/2'",
                      "record_id in ('urn:r:7', 'urn:r:9', null)", "record_id not in ('urn:r:7', 'urn:r:9')", "target_uri like 'http://h/1%'",
                      "record_type = 'response' and target_uri is not null and content_length < 150",
                      "not (target_uri <=> 'http://h/4')", "target_uri like '%9' or record_type = 'resource'"):
        chosen = back.filter(condition)
        ids = {r.record_id for r in chosen.select("record_id").collect()}
        plain = spark.createDataFrame([(k, *v[:2]) for k, v in whole.items()], "record_id string, record_type string, target_uri string")
        lengths = {r.record_id: r.content_length for r in back.select("record_id", "content_length").collect()}
        plain = plain.withColumn("content_length", F.create_map(*[F.lit(x) for kv in lengths.items() for x in kv])[F.col("record_id")])
        assert ids == {r.record_id for r in plain.filter(condition).collect()}, condition
    plan = back.filter("record_type = 'resource'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan                      # the source answers for it


def archive(rows, compressed, member=1):
    parts = [b"".join((h, b, b"\r\n\r\n")) for h, b in (warc.record_bytes(r, "2026-01-01T00:00:00Z") for r in rows)]
    if not compressed:
        return b"".join(parts)
    groups = [b"".join(parts[i:i + member]) for i in range(0, len(parts), member)]
    if member == 1:
        return b"".join(warc.gzip_member(g, 6) for g in groups)
    return b"".join(zlib.compress(g, 6, 31) for g in groups)      # members from elsewhere: no extra field


@pytest.mark.parametrize("compressed,member", [(False, 1), (True, 1), (True, 3)])
def test_records_of_a_file(compressed, member):
    rnd = random.Random(1)
    rows = [{"record_id": f"r{i}", "record_type": rnd.choice(["response", "resource", "revisit"]),
             "payload": rnd.randbytes(rnd.choice([0, 1, 511, 512, 70_000, 200_000]))} for i in range(30)]
    data = archive(rows, compressed, member)
    seen = {}
    test = warc.Test("eq", "record_type", "response")
    got = list(warc.records(pa.BufferReader(data), "f", compressed, [test], seen=seen))
    want = [r for r in rows if r["record_type"] == "response"]
    assert [(g["record_id"], g["payload"]) for g in got] == [(r["record_id"], r["payload"]) for r in want]
    assert seen == {"decoded": len(want), "skipped": len(rows) - len(want)}
    heads = list(warc.records(pa.BufferReader(data), "f", compressed, want_payload=False))
    assert [h["record_id"] for h in heads] == [r["record_id"] for r in rows] and all("payload" not in h for h in heads)
    assert [h["payload_bytes"] for h in heads] == [len(r["payload"]) for r in rows]
    if compressed and member == 1:
        # of members with a length, no payload is inflated that is not wanted
        source = warc._Gzip(pa.BufferReader(data))
        for r in rows:
            while (lead := source.read(2)) == b"\r\n":
                pass
            source.unread(lead)
            _, head, _ = warc._head(source)
            assert head["warc-record-id"] == f"<{r['record_id']}>"
            source.skip(int(head["content-length"]))
            assert source.taken <= 2 * warc.LEAST
    with pytest.raises(warc.CutOff):
        list(warc.records(pa.BufferReader(data[:-300]), "f", compressed))


def test_lost_tasks_files_do_not_count(spark):
    folder = scratch_dir(spark, "test", "orphan")
    rows = spark.range(10).select(F.col("id").cast("string").alias("record_id"), F.lit("resource").alias("record_type"))
    warc.write_archives(rows, folder)
    (path, _), = warc.archives(folder)[:1]
    with open(path, "rb") as f, open(path.rsplit("/", 1)[0] + "/part-orphan.warc.gz", "wb") as g:
        g.write(f.read())
    assert warc.read_archives(spark, folder).count() == 10
    rows.write.format("warc").mode("overwrite").save(folder)
    assert warc.read_archives(spark, folder).count() == 10
    reader = warc.WarcReader(folder, StructType(), 1 << 30, False)
    assert len(reader.partitions()) == 1               # small files share a task


# ---- operator 12 ----------------------------------------------------------------------------

def coded(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Plain learning in Python integers: {(vec_id, components): (code, error)}, digest."""
    ints = [(v, label, [int(np.floor(np.float64(x) * scale)) for x in e]) for v, e, label in rows
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    ints.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = len(ints[0][2]) // parts
    cut = [[r[2][p * d:(p + 1) * d] for r in ints] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]
    for r in range(rounds + 1):
        best = [[min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p])) for x in cut[p]] for p in range(parts)]
        if r == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x for x, b in zip(cut[p], best[p]) if b[1] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    rows_out = collections.Counter((ints[i][0], "".join(f"{best[p][i][1]:02x}" for p in range(parts)), sum(best[p][i][0] for p in range(parts)),
                                    ints[i][1]) for i in range(len(ints)))
    return rows_out, hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, code string, near int")


@pytest.mark.parametrize("entries", [256, 20, 7])
def test_codes_against_brute_force(spark, entries):
    rnd = np.random.default_rng(entries)
    centres = rnd.normal(0, 0.3, (12, 8))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 12] + rnd.normal(0, 0.05 if i % 2 else 0.3, 8)], None if i % 9 == 0 else int(i % 5))
            for i in rnd.permutation(600)]
    rows += [(i, [0.5] * 8, 3) for i in range(700, 800)] + [(40, rows[3][1], 1), (None, [0.25] * 8, 2), (-3, [0.0] * 8, None)]
    rows += [(1000, None, 1), (1001, [None] + [1.0] * 7, 1), (1002, [float("nan")] + [1.0] * 7, 1), (1003, [float("inf")] * 8, 2)]
    got = vector_codes.code_digest(vectors_of(spark, rows).repartition(4), entries=entries).collect()
    want, digest = coded(rows, entries=entries)
    label_error = collections.Counter()
    for (_, _, error, label), n in want.items():
        label_error[label] += n * error
    assert collections.Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == \
        collections.Counter({(v, c, e, label_error[label]): 0 for v, c, e, label in want}) + \
        sum((collections.Counter({(v, c, e, label_error[label]): n}) for (v, c, e, label), n in want.items()), collections.Counter())
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_bounds_hold_for_every_list_length():
    """Many rounds of one part position, entries moving at random: assignments equal those of
    all distances, bounds stay below the distances they bound, and most parts look at few entries."""
    rnd = np.random.default_rng(5)
    x = rnd.integers(-300, 300, (500, 4))
    x[:60] = x[0]
    book = x[rnd.choice(500, 64)].copy()                # entries that are equal, too
    state, moved = None, None
    for b in (16, 16, 12, 12, 7, 3, 1, 1):
        near, low, outer, error, looked = vector_codes.assign_part(x, book, moved, state, b)
        dist = ((x[:, None, :] - book[None]) ** 2).sum(2)
        assert (near[:, 0] == dist.argmin(1)).all() and (error == dist.min(1)).all()
        root = np.sqrt(dist)
        assert (low <= np.take_along_axis(root, near, 1)).all() and (np.diff(low, axis=1) >= 0).all()
        inside = np.zeros(dist.shape, bool)
        np.put_along_axis(inside, near, True, 1)
        assert (np.where(inside, np.inf, root).min(1) >= outer).all()
        after = book + rnd.integers(-2, 3, book.shape)
        moved = np.nextafter(np.sqrt(((after - book) ** 2).sum(1)).astype(np.float32), np.float32(np.inf))
        book = after
        assert state is None or b < 4 or (looked == 1).mean() > 0.3
        state = near, low, outer
    assert vector_codes.next_b({1: 90, 3: 8, 9: 2}, 16) == 4 and vector_codes.next_b({0: 50, 1: 40, 7: 10}, 16) == 8
    assert vector_codes.next_b({0: 50}, 16) == 16 and vector_codes.next_b({}, 3) == 3


def test_codes_of_few_odd_and_large_vectors(spark):
    none = vectors_of(spark, [])
    assert vector_codes.code_digest(none).collect() == []
    assert vector_codes.code_digest(vectors_of(spark, [(1, None, 1), (2, [None], 1)])).collect() == []
    # lengths that four does not divide are filled up, others than the commonest dropped
    got = vector_codes.code_digest(vectors_of(spark, [(1, [1.0] * 6, 1), (2, [2.0] * 6, 1), (3, [1.0] * 5, 1)])).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00000000", 0), (2, "01010100", 0)]
    big = vectors_of(spark, [(i, [60_000.0 + i, -60_000.0, 0.0, float(i)], None) for i in range(40)])
    got = vector_codes.code_digest(big, entries=8).collect()
    want, digest = coded([(i, [60_000.0 + i, -60_000.0, 0.0, float(i)], None) for i in range(40)], entries=8)
    assert {(r.vec_id, r.code, r.error) for r in got} == {k[:3] for k in want} and got[0].codebooks_sha256 == digest
    with pytest.raises(Exception, match="2\\*\\*26"):
        vector_codes.code_digest(vectors_of(spark, [(1, [1e9] * 4, 1)])).collect()


# ---- operator 13 ----------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(rows, least=3, top=200):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    seen = collections.Counter((lang, t) for lang, _, w in docs for t in set(w))
    kept = collections.defaultdict(set)
    for (lang, t), n in seen.items():
        if n >= least:
            kept[lang].add(t)
    groups = {(lang, source): collections.Counter() for lang, source, _ in docs}
    langs = collections.defaultdict(collections.Counter)
    for lang, source, w in docs:
        groups[lang, source].update(t for t in w if t in kept[lang])
        langs[lang].update(t for t in w if t in kept[lang])

    def share(counts, t, v):
        return 1 + 1_000_000_000 * (counts[t] + 1) // (sum(counts.values()) + v)

    def far(p, q):
        return (p - q) * (p - q) // q

    out = []
    for (lang, source), counts in groups.items():
        v = len(kept[lang])
        pairs = [(o, sum(far(share(counts, t, v), share(other, t, v)) for t in kept[lang]))
                 for (l2, o), other in groups.items() if l2 == lang and o != source]
        terms = [(t, far(p, q)) for t in kept[lang] if counts[t]
                 for p, q in [(share(counts, t, v), share(langs[lang], t, v))] if p > q]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def docs_in(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1) for i, (t, lang, s) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, term string, n int")


def test_audit_against_brute_force(spark):
    rnd = random.Random(8)
    words = ["Été", "été", "naïve", "one", "ONE", "x1y", "a-b", "語", "Ä", "rare"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(" ".join(rnd.choices(words, weights=[50] * 10 + [1] * 60, k=rnd.randint(0, 30))), rnd.choice(["en", "de", None]),
             rnd.choice(["s1", "s2", "s3", None])) for _ in range(150)]
    rows += [("same words here", "en", "s1")] * 300 + [("only twice", "fr", "s1"), ("only twice", "fr", "s2"), ("", "xx", "a"), (None, "xx", "b"),
                                                      ("alone", "yy", "a"), ("\x00\x7f[]^_`{}~ 123", "en", "empty")]
    rows += [(t, "en", "awkward") for _, t in AWKWARD]
    got = sorted(map(tuple, divergence.divergence(docs_in(spark, rows).repartition(3)).collect()))
    assert got == audit(rows)


def test_audit_in_parts_gives_the_same(spark, monkeypatch):
    """Texts split in stretches, counts passed on early, pairs in small blocks."""
    text = "Word other  " * 5000 + "y" * 9000
    whole = divergence.term_counts(text.encode())
    monkeypatch.setattr(divergence, "STRETCH", 1000)
    assert divergence.term_counts(text.encode()) == whole == collections.Counter({b"word": 5000, b"other": 5000, b"y" * 9000: 1})
    rnd = np.random.default_rng(2)
    first = np.array([0, 1, 4, 9, 11, 18])
    gid = np.concatenate([rnd.choice(9, n, replace=False) for n in np.diff(first)]).astype(np.int64) + 100
    p, p0 = rnd.integers(2, 10 ** 9, 18), (gid * 31)

    def sums(most):
        out = collections.Counter()
        for b in divergence._sums_by_pair(gid, p, p0, first, most):
            for a, z, v in zip(*(c.to_pylist() for c in b.columns)):
                out[a, z] += v
        return out
    want = collections.Counter()
    for lo, hi in zip(first, first[1:]):
        for i in range(lo, hi if hi - lo > 1 else lo):
            for j in range(lo, hi):
                f = lambda x, y: int((x - y) * (x - y) // y)
                want[int(gid[i]), int(gid[j])] += f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
    assert {k: v for k, v in sums(1 << 20).items() if v} == {k: v for k, v in want.items() if v}
    assert sums(4) == sums(1 << 20)


def test_audit_of_nothing(spark):
    assert divergence.divergence(docs_in(spark, [])).collect() == []
