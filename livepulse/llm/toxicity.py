"""Operator 10, toxicity: nearest labelled examples by exact TF-IDF cosine.

Terms of a text are its lower-cased words (runs of letters and digits) and their
beginnings of 3 to 8 bytes. From a bounded sample of labelled rows (``sample_rows``, drawn
by a hash of doc_id) the terms are kept whose tie to the label is beyond chance
(log-likelihood ratio of at least ``least_ratio``, more frequent among label 1): first
those that hardly occur elsewhere, then others if the texts the first ones leave open
still say so, so that a word's beginning does not repeat what the word says. Texts that
agree in three min-hashes of their words, as copies do, count once. Their
document frequencies are counted over all documents; examples and queries are
(1 + log tf) * idf vectors of length 1 over these terms.

Every whole text is scored where it is read. The examples lie in an inverted index whose
lists are cut into blocks of 64 example numbers, with the largest weight of each
(term, block). A query adds up these maxima, visits the blocks in falling order of that
bound, and stops when the bound is below the k-th best cosine: the k nearest are exact. Their
labels vote with cosine as weight against a vote of the label's share, and a monotone
table learned on the examples themselves (each scored without itself) turns votes into
probabilities. The result carries the evidence: doc_ids and cosines of the nearest.

Defined cases: null, empty and other texts without any kept term have no neighbour and
get the calibrated vote of the label's share; null labels and labels of unknown ids are ignored;
several labels of one id count as their maximum; a null ``doc_id`` is never learned from;
without usable labels of both kinds every score is their share (0 without any); ties in
cosine go to the lower example number; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, hash_spans, mix, padded, stored, text_blocks
from .quality import labelled_sample

BLOCK = 64
STARTS = (3, 4, 5, 6, 7, 8)          # bytes of a word's beginnings that are terms
FOUND = "doc_id long, score double, neighbours array<long>, cosines array<double>"
_INK = np.zeros(256, bool)
_INK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of every text, one after the other, and the text each belongs to."""
    ink = _INK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(ink & (~np.concatenate([[False], ink[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(ink & (~np.concatenate([ink[1:], [False]]) | edge[1:])) + 1
    text = np.searchsorted(off, starts, "right") - 1
    view, size = padded(raw)[starts], ends - starts
    out, of = [hash_spans(raw, starts, ends, seed=7)], [text]
    for n in STARTS:
        long = np.flatnonzero(size > n)
        head = view[long] & np.uint64((1 << 8 * n) - 1 if n < 8 else (1 << 64) - 1)
        out.append(mix(head ^ np.uint64(0xA5A5A5A5 * n)))
        of.append(text[long])
    return np.concatenate(out), np.concatenate(of)


class Vocabulary:
    """Kept terms: place of a term hash, -1 for others."""

    def __init__(self, kept: np.ndarray):
        self.kept = np.unique(kept)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.kept >> np.uint64(48)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.seen[h >> np.uint64(48)]
        at = np.searchsorted(self.kept, h[out])
        at[at == len(self.kept)] = 0
        out[out] = self.kept[at] == h[out] if len(self.kept) else False
        return out

    def count(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times), sorted by text and term."""
        h, text = terms(raw, off)
        at = np.flatnonzero(self.has(h))
        place = np.searchsorted(self.kept, h[at])
        key, n = np.unique(text[at] * np.int64(max(1, len(self.kept))) + place, return_counts=True)
        return key // max(1, len(self.kept)), key % max(1, len(self.kept)), n


def telling_terms(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, least_ratio: float,
                  most: int) -> np.ndarray:
    """Terms more frequent among texts of label 1 than chance allows (at most ``most``, the strongest)."""
    flag = labels.astype(bool)
    groups = [np.zeros(0, np.uint64)]
    for raw, off in texts:                    # texts that agree in three min-hashes are one group
        h, of = terms(raw, off)
        group = np.full(len(off) - 1, 0xFFFFFFFFFFFFFFFF, np.uint64)
        for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B):
            least = np.full(len(off) - 1, 0xFFFFFFFFFFFFFFFF, np.uint64)
            np.minimum.at(least, of, mix(h ^ np.uint64(salt)))
            group = mix(group * np.uint64(3) + least)
        groups.append(group)
    group = np.unique(np.concatenate(groups), return_inverse=True)[1]
    n1, n0 = len(np.unique(group[flag])), len(np.unique(group[~flag]))

    def seen_in(which: np.ndarray, among: Vocabulary | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (term, group) of the chosen texts, of the terms ``among`` only; sorted."""
        key, term, of_group, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for raw, off in texts:
            h, of = terms(raw, off)
            ok = which[at + of]
            if among is not None:
                ok[ok] = among.has(h[ok])
            own = group[at + of[ok]]
            both, first = np.unique(mix(h[ok] + mix(own.astype(np.uint64))), return_index=True)
            key.append(both)
            term.append(h[ok][first])
            of_group.append(own[first])
            at += len(off) - 1
        _, first = np.unique(np.concatenate(key), return_index=True)
        t, g = np.concatenate(term)[first], np.concatenate(of_group)[first]
        order = np.argsort(t, kind="stable")
        return t[order], g[order]

    t1, g1 = seen_in(flag, None)
    kept, c1 = np.unique(t1, return_counts=True)
    kept = kept[c1 >= 3]
    t0, g0 = seen_in(~flag, Vocabulary(kept))
    lo1, hi1 = np.searchsorted(t1, kept), np.searchsorted(t1, kept, "right")
    lo0, hi0 = np.searchsorted(t0, kept), np.searchsorted(t0, kept, "right")

    def ratio(c1, c0, n1, n0):
        share, c = n1 / max(1, n1 + n0), c1 + c0
        with np.errstate(divide="ignore", invalid="ignore"):
            g = 2 * (np.where(c1 > 0, c1 * np.log(c1 / (c * share)), 0) + np.where(c0 > 0, c0 * np.log(c0 / (c * (1 - share))), 0))
        return np.where(c1 > 1.5 * share * c, g, 0.0)

    value = ratio(hi1 - lo1, hi0 - lo0, n1, n0)
    open1, open0 = np.zeros(int(group.max(initial=-1)) + 1, bool), np.zeros(int(group.max(initial=-1)) + 1, bool)
    open1[group[flag]], open0[group[~flag]] = True, True
    chosen: list[int] = []
    pure = (hi1 - lo1) >= 0.95 * (hi1 - lo1 + hi0 - lo0)
    # terms that occur with label 1 alone, then the others, on the texts these leave open
    for i in np.lexsort((-value, ~pure)):
        if value[i] < least_ratio or len(chosen) == most:
            continue
        own1, own0 = g1[lo1[i]:hi1[i]], g0[lo0[i]:hi0[i]]
        if pure[i] or ratio(np.float64(open1[own1].sum()), np.float64(open0[own0].sum()),
                            open1.sum(), open0.sum()) >= least_ratio:
            chosen.append(i)
            open1[own1], open0[own0] = False, False
    return kept[chosen]


@dataclass
class Examples:
    """Block-max inverted index over the examples."""
    vocabulary: Vocabulary
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    share: float
    first: np.ndarray          # of (term, block) in the postings: term * blocks + block
    example: np.ndarray
    weight: np.ndarray
    top: np.ndarray            # largest weight of (term, block)
    steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (over 0): (numbers, cosines)."""
        blocks = self.top.shape[1]
        bound = weight @ self.top[term]
        order = np.argsort(-bound, kind="stable")
        order = order[:np.searchsorted(-bound[order], 0.0)]           # bound over 0
        best, best_id = np.zeros(0), np.zeros(0, np.int64)
        at, batch = 0, 4
        while at < len(order) and not (len(best) == k and bound[order[at]] < best[-1] - 1e-12):
            visit = order[at:at + batch]
            at, batch = at + batch, batch * 2
            cell = (term[:, None] * blocks + visit).ravel()
            n = self.first[cell + 1] - self.first[cell]
            post = np.repeat(self.first[cell] - np.cumsum(n) + n, n) + np.arange(n.sum())
            found, back = np.unique(self.example[post], return_inverse=True)
            score = np.bincount(back, np.repeat(np.repeat(weight, len(visit)), n) * self.weight[post], len(found))
            best_id, best = np.concatenate([best_id, found[found != but]]), np.concatenate([best, score[found != but]])
            keep = np.lexsort((best_id, -best))[:k]
            best, best_id = best[keep], best_id[keep]
        return best_id, best

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        return float((cosine @ self.labels[near] + 0.5 * self.share) / (cosine.sum() + 0.5))

    def vectors(self, raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(terms, weights) of each text."""
        text, term, n = self.vocabulary.count(raw, off)
        cut = np.searchsorted(text, np.arange(len(off)))
        w = (1 + np.log(n)) * self.idf[term] if len(term) else np.zeros(0)
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield term[lo:hi], w[lo:hi] / max(np.sqrt(w[lo:hi] @ w[lo:hi]), 1e-300)

    def score(self, vote: float) -> float:
        return float(np.interp(vote, *self.steps))


def monotone(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression (pool adjacent violators) of label on vote, as a table."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []             # sum of labels, rows, sum of votes
    for v, y in zip(votes[order], labels[order]):
        pools.append([float(y), 1.0, float(v)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    x = np.array([p[2] / p[1] for p in pools])
    y = np.array([(p[0] + 0.05) / (p[1] + 0.1) for p in pools])
    return x, np.maximum.accumulate(y)


def build_examples(kept: np.ndarray, idf: np.ndarray, ids: np.ndarray, labels: np.ndarray,
                   counts: list[tuple[np.ndarray, np.ndarray]], k: int) -> Examples:
    """counts: (term, times) of each example."""
    term = np.concatenate([t for t, _ in counts]).astype(np.int64) if counts else np.zeros(0, np.int64)
    number = np.repeat(np.arange(len(counts)), [len(t) for t, _ in counts]) if counts else np.zeros(0, np.int64)
    weight = (1 + np.log(np.concatenate([n for _, n in counts]))) * idf[term] if len(term) else np.zeros(0)
    length = np.sqrt(np.bincount(number, weight ** 2, len(counts)))
    weight = weight / length[number] if len(term) else weight
    blocks = max(1, -(-len(counts) // BLOCK))
    cell = term * blocks + number // BLOCK
    order = np.lexsort((number, cell))
    first = np.searchsorted(cell[order], np.arange(len(kept) * blocks + 1))
    top = np.zeros(len(kept) * blocks)
    np.maximum.at(top, cell, weight)
    out = Examples(Vocabulary(kept), idf, ids, labels, float(labels.mean()) if len(labels) else 0.0, first,
                   number[order], weight[order], top.reshape(len(kept), blocks))
    cut = np.searchsorted(number, np.arange(len(counts) + 1))
    votes = np.array([out.vote(*out.nearest(term[cut[i]:cut[i + 1]], weight[cut[i]:cut[i + 1]], k, but=i))
                      for i in range(len(counts))])
    if len(votes):
        out.steps = monotone(votes, labels)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None,
        sample_rows: int = 12000, least_ratio: float = 24.0, most_terms: int = 4096, k: int = 15) -> Examples:
    """Terms and examples from the sample, document frequencies from all documents."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, sample_rows) \
        .select("doc_id", "label", F.lower("text").alias("text"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, int(y != 0), t) for b in batches for d, y, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "text")))]
        rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r))
        parts = [x[1:] for x in text_blocks([pa.record_batch({"text": pa.array([r[2] for r in rows], pa.string())})])]
        y = np.array([r[1] for r in rows], np.int64)
        vocabulary = Vocabulary(telling_terms(parts, y, least_ratio, most_terms) if len(set(y.tolist())) == 2 else np.zeros(0, np.uint64))
        yield batch_of(CHOSEN, doc_id=[None], label=[-1], term=[vocabulary.kept.view(np.int64).tolist()], times=[[]])
        at = 0
        for raw, off in parts:
            text, term, n = vocabulary.count(raw, off)
            cut = np.searchsorted(text, np.arange(len(off)))
            own = rows[at:at + len(off) - 1]
            at += len(off) - 1
            yield batch_of(CHOSEN, doc_id=[r[0] for r in own], label=[r[1] for r in own],
                           term=[term[a:b].tolist() for a, b in zip(cut, cut[1:])],
                           times=[n[a:b].tolist() for a, b in zip(cut, cut[1:])])

    chosen = stored(sample.repartition(1).mapInArrow(choose, CHOSEN), "toxicity-examples").collect()   # bounded by sample_rows
    kept = np.array(next((r["term"] for r in chosen if r["label"] == -1), []), np.int64).view(np.uint64)
    rows = sorted([r for r in chosen if r["label"] >= 0], key=lambda r: r["doc_id"])
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(kept))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.kept) + 1, np.int64)
        for part, raw, off in text_blocks(batches):
            total[0] += part.num_rows
            total[1:] += np.bincount(shared.value.count(raw, off)[1], minlength=len(total) - 1)[:len(total) - 1]
        at = np.flatnonzero(total)
        yield batch_of("term long, n long", term=at, n=total[at])

    counted = lowered(docs).mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(len(kept) + 1)
    for r in counted.collect():               # one row per kept term
        df[r["term"]] = r["n"]
    return build_examples(kept, np.log((1 + df[0]) / (1 + df[1:])) + 1, np.array([r["doc_id"] for r in rows]),
                          np.array([r["label"] for r in rows], np.int64),
                          [(np.array(r["term"], np.int64), np.array(r["times"], np.int64)) for r in rows], k)


CHOSEN = "doc_id long, label int, term array<long>, times array<long>"


def lowered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))


def score(docs: DataFrame, examples: Examples, k: int = 15) -> DataFrame:
    """doc_id, score, neighbours (doc_ids of the nearest examples) and their cosines."""
    shared = docs.sparkSession.sparkContext.broadcast(examples)     # bounded by sample_rows and most_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ex = shared.value
        for part, raw, off in text_blocks(batches):
            near = [ex.nearest(t, w, k) for t, w in ex.vectors(raw, off)]
            yield batch_of(FOUND, doc_id=part.column("doc_id"), score=[ex.score(ex.vote(*x)) for x in near],
                           neighbours=[ex.ids[i].tolist() for i, _ in near], cosines=[c.tolist() for _, c in near])

    return lowered(docs).mapInArrow(run, FOUND)
