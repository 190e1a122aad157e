"""Operator 9, language-model scoring: a log-frequency Bloom filter.

A bigram model with absolute discounting, P(w|h) = max(c(hw) - D, 0) / c(h) + D T(h) / c(h) P(w),
where T(h) counts the distinct followers of h and P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)).
Counts are kept as in Talbot and Osborne: quantised, q(c) = 1 + floor(log_base c), and a
filter holds the pairs (n-gram, 1) .. (n-gram, q(c)); a count is read back by probing levels
1, 2, ... until one is absent. The filter is broadcast and every whole text is scored where it
is read. Its size is proven: ``bits`` per entry, at most ``most_bytes`` in all; beyond
that nothing is dropped, entries share fewer bits and false positives rise.

How counts are gathered, over all training rows: a task hashes the words of a chunk of texts
and sends each *segment* (a range of word hashes) the chunk's distinct words there, with
their training counts, the texts they occur in, and their distinct followers. A segment adds
up its words over all chunks, so a word that holds a third of all tokens is one line per chunk. It
returns its part of the filter and, per text, the sums of exact log counts from which the
unigram base score is made. Nothing is joined token by token, and no text is shuffled.

Tokens: runs of characters outside space and \\t to \\r of the text with A-Z lower-cased,
then one end. Defined cases: null and empty texts are one end token; a null ``doc_id`` is a
training row; repeated rows are scored and counted row by row; without training rows all
scores are those of N = V = 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, hash_spans, id_and_text, lower_ascii, mix, stored, text_blocks, words

END, START = np.uint64(0x00E4D00E4D00E4D1), np.uint64(0x57A2757A2757A271)
CHUNK_BYTES, CHUNK_TEXTS = 16 << 20, 60_000
PART = "kind int, chunk long, segment int, data binary"
WORDS, TEXTS, SUMS, FILTER, TOTALS = range(5)
SCORED = "doc_id long, key long, n_tokens long, score double"
BASE = "doc_id long, key long, n_tokens long, n_known long, log_sum double"
LEVEL = np.uint64(0x9E3779B97F4A7C15)


def pack(*arrays: np.ndarray) -> bytes:
    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
    return len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in arrays)


def unpack(data: bytes) -> list[np.ndarray]:
    at = 4 + int.from_bytes(data[:4], "little")
    out = []
    for kind, n in json.loads(data[4:at]):
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def small_counts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts as single bytes, those of 255 and above listed apart."""
    big = np.flatnonzero(n >= 255)
    return np.minimum(n, 255).astype(np.uint8), big.astype(np.uint32), n[big].astype(np.uint64)


def full_counts(small: np.ndarray, big: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[big] = value
    return out


def token_stream(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, the text of each, and a key of each text's tokens."""
    raw = lower_ascii(raw)
    starts, ends, first = words(raw, off)
    token = np.insert(hash_spans(raw, starts, ends, seed=5), first[1:], END)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first) + 1)
    edge = first + np.arange(len(off))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(token + mix((np.arange(len(token)) - edge[text]).astype(np.uint64))))])
    return token, text, (run[edge[1:]] - run[edge[:-1]]).view(np.int64)


def segment_of(word: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(word) >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def bigram_key(history: np.ndarray, follower: np.ndarray) -> np.ndarray:
    """``follower``: the upper 32 bits of a word hash."""
    return mix(history ^ mix(follower + np.uint64(0xB16)))


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] places each, one after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def _chunk_parts(chunk: int, token: np.ndarray, text: np.ndarray, key: np.ndarray, ids: list, train: np.ndarray,
                 segments: int) -> Iterator[tuple[int, int, int, bytes]]:
    n = len(ids)
    known = np.array([0 if d is None else d for d in ids], np.int64)
    yield TEXTS, chunk, chunk % segments, pack(known, np.array([d is None for d in ids], bool), key,
                                               np.bincount(text, minlength=n).astype(np.int64))
    word, back = np.unique(np.append(token, START), return_inverse=True)
    start_at, back = back[-1], back[:-1]
    count = np.bincount(back, train[text], len(word)).astype(np.int64)
    pair, times = np.unique(back * n + text, return_counts=True)
    pair_first = np.searchsorted(pair, np.arange(len(word) + 1) * n)
    head = np.concatenate([[True], text[1:] != text[:-1]])
    history = np.where(head, start_at, np.concatenate([[0], back[:-1]]))
    learn = train[text]
    gram, gram_n = np.unique((history[learn].astype(np.uint64) << np.uint64(32)) | (token[learn] >> np.uint64(32)),
                             return_counts=True)
    gram_first = np.searchsorted(gram >> np.uint64(32), np.arange(len(word) + 1))
    segment = segment_of(word, segments)
    order = np.argsort(segment, kind="stable")
    cut = np.searchsorted(segment[order], np.arange(segments + 1))
    for s in range(segments):
        own = order[cut[s]:cut[s + 1]]
        if len(own):
            pairs, grams = np.diff(pair_first)[own], np.diff(gram_first)[own]
            at, to = spans(pair_first[own], pairs), spans(gram_first[own], grams)
            yield WORDS, chunk, s, pack(
                word[own], *small_counts(count[own]), *small_counts(pairs), (pair[at] % n).astype(np.uint16),
                *small_counts(times[at]), *small_counts(grams), (gram[to] & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                *small_counts(gram_n[to]))


def _gather(segments: int, fold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        chunk, held = TaskContext.get().partitionId() << 32, []

        def flush() -> Iterator[pa.RecordBatch]:
            base = np.cumsum([0] + [len(h[3]) for h in held])
            ids = [d for h in held for d in h[3]]
            parts = _chunk_parts(chunk, np.concatenate([h[0] for h in held]),
                                 np.concatenate([h[1] + b for h, b in zip(held, base)]),
                                 np.concatenate([h[2] for h in held]), ids,
                                 np.array([not in_fold(d, fold) for d in ids], bool), segments)
            for p in parts:
                yield batch_of(PART, **{c: [v] for c, v in zip(("kind", "chunk", "segment", "data"), p)})

        size = texts = 0
        for part, raw, off in text_blocks(batches):
            if held and (size + len(raw) > CHUNK_BYTES or texts + part.num_rows > CHUNK_TEXTS):
                yield from flush()
                chunk, held, size, texts = chunk + 1, [], 0, 0
            for lo in range(0, part.num_rows, CHUNK_TEXTS):          # very many tiny texts
                hi = min(part.num_rows, lo + CHUNK_TEXTS)
                held.append((*token_stream(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]),
                             part.column("doc_id").slice(lo, hi - lo).to_pylist()))
                if hi < part.num_rows:
                    yield from flush()
                    chunk, held = chunk + 1, []
            size, texts = size + len(raw), texts + part.num_rows
        if held:
            yield from flush()
    return run


def quantise(count: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(count) / math.log(base) + 1e-9).astype(np.int64)


def set_bits(keys: np.ndarray, levels: np.ndarray, n_bits: int, probes: int) -> np.ndarray:
    table = np.zeros(n_bits, np.uint8)
    level = np.arange(int(levels.sum())) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    x = mix(np.repeat(keys, levels) + level.astype(np.uint64) * LEVEL)
    step = mix(x ^ LEVEL) | np.uint64(1)
    for _ in range(probes):
        table[x % np.uint64(n_bits)] = 1
        x = x + step
    return np.packbits(table, bitorder="little")


def _segment_result(s: int, parts: list[tuple[int, bytes]], base: float, bits: float, probes: int,
                    most_bytes: int) -> Iterator[tuple[int, int, int, bytes]]:
    """All chunks' words of one segment: its filter, its totals, and each text's sums."""
    data = [(chunk, unpack(d)) for chunk, d in parts]
    word = np.unique(np.concatenate([d[0] for _, d in data]))
    count = np.zeros(len(word), np.int64)
    grams, gram_n = [], []
    for _, d in data:
        at = np.searchsorted(word, d[0])
        count[at] += full_counts(*d[1:4])
        grams.append((np.repeat(at, full_counts(*d[11:14])).astype(np.uint64) << np.uint64(32)) | d[14])
        gram_n.append(full_counts(*d[15:18]))
    value = np.log10(count + 0.5)
    for chunk, d in data:
        at = np.searchsorted(word, d[0])
        at = np.repeat(at, full_counts(*d[4:7]))
        text, times = d[7].astype(np.int64), full_counts(*d[8:11])
        total = np.bincount(text, times * value[at])
        known = np.bincount(text, times * (count[at] > 0))
        has = np.flatnonzero(np.bincount(text))
        yield SUMS, chunk, s, pack(has.astype(np.uint16), total[has], known[has].astype(np.uint32))
    gram, back = np.unique(np.concatenate(grams), return_inverse=True)
    gram_count = np.bincount(back, np.concatenate(gram_n), len(gram)).astype(np.int64)
    of = (gram >> np.uint64(32)).astype(np.int64)
    followers = np.bincount(of, minlength=len(word))
    seen, leads = count > 0, followers > 0
    keys = np.concatenate([word[seen], word[leads] ^ LEVEL, bigram_key(word[of], gram & np.uint64(0xFFFFFFFF))])
    levels = np.concatenate([quantise(x, base) for x in (count[seen], followers[leads], gram_count)])
    n_bits = max(64, min(int(bits * levels.sum()), most_bytes * 8) // 64 * 64)
    yield TOTALS, 0, s, pack(np.array([count.sum(), seen.sum(), (gram_count == 1).sum(), (gram_count == 2).sum()], np.int64))
    yield FILTER, 0, s, set_bits(keys, levels, n_bits, probes).tobytes()


def _merge_segments(base: float, bits: float, probes: int, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []

        def out(rows) -> Iterator[pa.RecordBatch]:
            for r in rows:
                yield batch_of(PART, **{c: [v] for c, v in zip(("kind", "chunk", "segment", "data"), r)})

        for b in batches:
            for kind, chunk, s, data in zip(*(b.column(c).to_pylist() for c in ("kind", "chunk", "segment", "data"))):
                if s != at:
                    if parts:
                        yield from out(_segment_result(at, parts, base, bits, probes, most_bytes))
                    at, parts = s, []
                if kind == TEXTS:
                    yield from out([(kind, chunk, s, data)])
                else:
                    parts.append((chunk, data))
        if parts:
            yield from out(_segment_result(at, parts, base, bits, probes, most_bytes))
    return run


def _text_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk: the sums of all segments, per text."""
    def out(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
        ids, null, key, n = next(unpack(d) for kind, d in parts if kind == TEXTS)
        total, known = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for kind, d in parts:
            if kind == SUMS:
                text, t, k = unpack(d)
                total[text] += t
                known[text] += k
        return batch_of(BASE, doc_id=pa.array(ids, mask=null), key=key, n_tokens=n, n_known=known, log_sum=total)

    at, parts = None, []
    for b in batches:
        for kind, chunk, data in zip(*(b.column(c).to_pylist() for c in ("kind", "chunk", "data"))):
            if chunk != at and parts:
                yield out(parts)
                parts = []
            at = chunk
            parts.append((kind, data))
    if parts:
        yield out(parts)


@dataclass
class Model:
    filter: np.ndarray          # packed bits of all segments
    first: np.ndarray           # first bit of each segment, the end last
    n: int
    v: int
    texts: int                  # training texts: the count of the start
    base: float
    probes: int
    discount: float

    def counts(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Expected counts: levels probed until one is absent."""
        q = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        size = np.diff(self.first).astype(np.uint64)
        level = 0
        while len(live):
            level += 1
            x = mix(keys[live] + np.uint64(level * int(LEVEL) % (1 << 64)))
            step = mix(x ^ LEVEL) | np.uint64(1)
            at, bits = self.first[segment[live]], size[segment[live]]
            ok = np.arange(len(live))
            for _ in range(self.probes):
                place = at[ok] + (x[ok] % bits[ok]).astype(np.int64)
                hit = (self.filter[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                ok = ok[hit]
                x = x + step
            live = live[ok]
            q[live] = level
        lo, hi = np.ceil(self.base ** (q - 1) - 1e-9), np.ceil(self.base ** q - 1e-9) - 1
        return np.where(q > 0, (lo + np.maximum(lo, hi)) / 2, 0.0)

    def score(self, token: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
        """log10 probability of each text."""
        segments = len(self.first) - 1
        word, back = np.unique(np.append(token, START), return_inverse=True)
        start_at, back = back[-1], back[:-1]
        segment = segment_of(word, segments)
        count = self.counts(word, segment)
        followers = np.minimum(self.counts(word ^ LEVEL, segment), np.where(count > 0, count, np.inf))
        uni = (count + 0.5) / (self.n + 0.5 * (self.v + 1))
        count[start_at] = self.texts
        followers[start_at] = min(followers[start_at], self.texts)
        head = np.concatenate([[True], text[1:] != text[:-1]])
        history = np.where(head, start_at, np.concatenate([[0], back[:-1]]))
        pair, again = np.unique((history.astype(np.uint64) << np.uint64(32)) | back.astype(np.uint64), return_inverse=True)
        h, w = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        both = np.zeros(len(pair))
        ask = np.flatnonzero((count[h] > 0) & (count[w] > 0))       # else the pair was never seen
        both[ask] = np.minimum(self.counts(bigram_key(word[h[ask]], word[w[ask]] >> np.uint64(32)), segment[h[ask]]),
                               np.minimum(count[h[ask]], count[w[ask]]))
        c = np.maximum(count[h], 1e-300)
        p = np.maximum(both - self.discount, 0) / c + self.discount * np.maximum(followers[h], 1) / c * uni[w]
        p = np.where(count[h] > 0, np.minimum(p, 1.0), np.minimum(uni[w], 1.0))
        return np.bincount(text, np.log10(p)[again], texts)


def fit_and_base(docs: DataFrame, fold: tuple[int, int] = (5, 1), base: float = 1.5, bits: float = 10.0,
                 probes: int = 5, most_bytes: int = 1 << 30) -> tuple[Model, DataFrame]:
    """The model of all rows outside ``fold`` (parts, part of the crc32 of doc_id as text), and for
    every row: doc_id, key, n_tokens, n_known, train_tokens, base_score (exact add-half unigram)."""
    spark = docs.sparkSession
    segments = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = id_and_text(docs).mapInArrow(_gather(segments, fold), PART)
    merged = stored(parts.repartition(F.col("segment")).sortWithinPartitions("segment").mapInArrow(
        _merge_segments(base, bits, probes, most_bytes // segments), PART), "lm-segments")
    totals = [unpack(r["data"])[0] for r in merged.filter(F.col("kind") == TOTALS).select("data").collect()]
    n, v, once, twice = (int(sum(t[k] for t in totals)) for k in range(4))
    # one row per segment, of bounded size: most_bytes / segments each
    blocks = {r["segment"]: np.frombuffer(r["data"], np.uint8)
              for r in merged.filter(F.col("kind") == FILTER).select("segment", "data").toLocalIterator()}
    empty = np.zeros(8, np.uint8)
    table = [blocks.get(s, empty) for s in range(segments)]
    first = np.concatenate([[0], np.cumsum([8 * len(t) for t in table])]).astype(np.int64)
    sums = merged.filter(F.col("kind").isin(TEXTS, SUMS)).repartition(F.col("chunk")) \
        .sortWithinPartitions("chunk").mapInArrow(_text_sums, BASE)
    rows = stored(sums, "lm-base")
    train = rows.filter(~held_out("doc_id", fold)).count()
    discount = once / (once + 2 * twice) if once else 0.5           # Kneser and Ney's estimate
    model = Model(np.concatenate(table), first, n, v, train, base, probes, discount)
    each = math.log10(n + 0.5 * (v + 1)) if n + v else math.log10(0.5)
    return model, rows.select("doc_id", "key", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                              (F.col("log_sum") - F.col("n_tokens") * each).alias("base_score"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, key (of its tokens), n_tokens, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_blocks(batches):
            token, text, key = token_stream(raw, off)
            yield batch_of(SCORED, doc_id=part.column("doc_id"), key=key, n_tokens=np.bincount(text, minlength=part.num_rows),
                           score=shared.value.score(token, text, part.num_rows))

    return id_and_text(docs).mapInArrow(run, SCORED)


def in_fold(doc_id: int | None, fold: tuple[int, int]) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % fold[0] == fold[1]


def held_out(name: str, fold: tuple[int, int]) -> Column:
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % fold[0] == fold[1], F.lit(False))


def score_corpus(docs: DataFrame, fold: tuple[int, int] = (5, 1), **options) -> DataFrame:
    """Learn from all rows outside ``fold`` and score every row: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score."""
    model, base = fit_and_base(docs, fold, **options)
    base = base.dropDuplicates(["doc_id", "key"]).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_known", "train_tokens", "base_score")
    return score(docs, model).join(base, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))) \
        .select("doc_id", held_out("doc_id", fold).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                "base_score", "score")
