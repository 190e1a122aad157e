"""Operator 1, n-gram Jaccard join: chosen-path join.

Finds all pairs of different texts whose sets of word n-grams have a Jaccard similarity of
at least ``threshold``, and the groups these links form.

1. Rows with the same words are one *class* (kept as one line from the first shuffle on,
   however many copies there are); only classes are joined.
2. A class carries a sketch of ``TOKENS`` min-hash tokens (position, 24-bit value, kept as 16
   upper and 8 lower bits); two sets share a token with a probability equal to their similarity.
3. Recursion, as in the chosen-path join (Christiani, Pagh, Sivertsen): in a run, a class
   enters a bucket for each of its tokens that a hash drawn for that bucket's path
   samples, 1 / ``sampling`` on average. Similar sets go on sharing sampled tokens level
   after level, others part. A bucket of one is dropped; a bucket of at most ``leaf`` is
   brute-forced by its sketches; a larger one is split again, in the same pass over the sorted buckets.
   Before that, its members, dealt to tasks of at most ``part`` with the leader in each, are
   compared with a leader drawn from the bucket: those near the leader are linked to it, and
   those so close that any partner of theirs is near it as well (triangle inequality of the
   Jaccard distance: 1 - J(leader, partner) is at most 1 - J(leader, member) + 0.2) leave the
   recursion. A group of copies leaves at once, texts that share a passage go on.
4. Independent runs are repeated until a pair at the threshold is found with
   probability ``target`` (the survival of a branching process gives the runs needed).
5. Linked classes form coarse groups. In each, every pair is compared by its full n-gram
   sets: groups are dealt in blocks of at most ``block`` classes, each pair of blocks a task
   of its own, which returns counts and a spanning forest, never the pairs.

Words are maximal runs of non-space characters of the lower-cased text; a text of fewer
than n words has one n-gram, all its words. Defined cases: null and empty texts form one
class without n-grams and link to nothing; a null ``doc_id`` is joined to nothing and comes
back with a null class; several rows with one ``doc_id`` are joined as their texts say, and
each comes back; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, forest, hash_spans, least_labels, mix, stored, stored_with, text_blocks, utf8, words

TOKENS = 128
ROW = "doc_id long, k1 long, k2 long, size long, hi binary, lo binary"
NODE = "node long, rep long"
_MULTIPLIERS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
MAYBE = 0.60        # sketches that agree this far may belong to a linked pair
NEAR = 0.42         # a member that agrees this far with its bucket's leader is linked to it
CLOSE = 0.70        # ... this far: whatever links to the member agrees with the leader by NEAR, too


def ngrams(raw: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all word n-grams (repeats included), where each text's begin; and two 64-bit
    sums over the placed words of each text, which name its class."""
    starts, ends, first = words(raw, off)
    h = hash_spans(raw, starts, ends)
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(h)) - first[text] if len(h) else np.zeros(0, np.int64)
    total = np.zeros(len(h), np.uint64)
    for k in range(n):                                  # a short text: its words, then nothing
        at = np.arange(len(h)) + k
        inside = at < first[text + 1] if len(h) else np.zeros(0, bool)
        word = np.where(inside, h[np.minimum(at, max(len(h) - 1, 0))], np.uint64(k + 1)) if len(h) else h
        total = mix(total * np.uint64(0x100000001B3) + word)
    keep = (place == 0) | (place + n <= count[text]) if len(h) else np.zeros(0, bool)
    grams = total[keep]
    placed = mix(h + mix(place.astype(np.uint64) + np.uint64(77)))
    keys = []
    for salt in (0, 0x51ED270B):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(placed ^ np.uint64(salt)))])
        keys.append((run[first[1:]] - run[first[:-1]]).view(np.int64))
    return grams, np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=len(count)))]), *keys


def _sketches(grams: np.ndarray, first: np.ndarray) -> tuple[list[bytes | None], list[bytes | None]]:
    """Upper 16 and lower 8 bits of each text's min-hash values; None without n-grams."""
    some = np.flatnonzero(np.diff(first))
    hi: list[bytes | None] = [None] * (len(first) - 1)
    lo = hi.copy()
    if len(some):
        values = np.empty((len(some), TOKENS), np.uint32)
        for i, a in enumerate(_MULTIPLIERS):
            values[:, i] = mix(np.minimum.reduceat(grams * a, first[some])) >> np.uint64(40)
        for t, h, v in zip(some, (values >> 8).astype("<u2"), (values & 255).astype(np.uint8)):
            hi[t], lo[t] = h.tobytes(), v.tobytes()
    return hi, lo


def _rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in text_blocks(batches):
            grams, first, k1, k2 = ngrams(raw, off, n)
            hi, lo = _sketches(grams, first)
            yield batch_of(ROW, doc_id=part.column("doc_id"), k1=k1, k2=k2, size=np.diff(off), hi=hi, lo=lo)
    return run


def runs_needed(threshold: float, sampling: float, depth: int, target: float) -> int:
    """Runs after which a pair at the threshold has met in a bucket of that depth with
    probability ``target``: it shares Poisson(threshold / sampling) sampled tokens a level."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive * threshold / sampling)
    return math.ceil(math.log(1 - target) / math.log(1 - alive))


def _lows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TOKENS)


def _tokens(part: pa.RecordBatch) -> np.ndarray:
    hi = np.frombuffer(b"".join(part.column("hi").to_pylist()), "<u2").reshape(-1, TOKENS)
    place = np.arange(1, TOKENS + 1, dtype=np.uint64) << np.uint64(24)
    return mix(place + (hi.astype(np.uint64) << np.uint64(8)) + _lows(part.column("lo")))


def _first_level(runs: int, below: np.uint64):
    seeds = mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                token, rep = _tokens(part), part.column("rep").to_numpy()
                for seed in seeds:
                    row, j = np.nonzero(token * (seed | np.uint64(1)) < below)
                    yield batch_of(NODE, node=mix(token[row, j] + seed).view(np.int64), rep=rep[row])
    return run


def _bucket_forest(rep: np.ndarray, values: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small buckets, one after the other: stars over the pairs whose sketches agree."""
    need = math.ceil(MAYBE * TOKENS)
    start = np.cumsum(size) - size
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lo = 0
    while lo < len(size):                                # about half a million pairs at once
        hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:] * (size[lo:] - 1) // 2), 500_000)))
        x, y = [], []
        for s in np.unique(size[lo:hi]):
            i, j = np.triu_indices(s, 1)
            at = start[lo:hi][size[lo:hi] == s][:, None]
            x.append((at + i).ravel())
            y.append((at + j).ravel())
        x, y = np.concatenate(x), np.concatenate(y)
        for k in range(0, len(x), 1 << 16):
            same = (values[x[k:k + (1 << 16)]] == values[y[k:k + (1 << 16)]]).sum(1) >= need
            p, q = forest(rep[x[k:k + (1 << 16)][same]], rep[y[k:k + (1 << 16)][same]])
            a.append(p)
            b.append(q)
        lo = hi
    return forest(np.concatenate(a), np.concatenate(b))


# edges (a, b) without sketches, rows of the next level (node a, class b) with them
STEP = "a long, b long, hi binary, lo binary"
HELD_EDGES = 1 << 18


def _bucket_pass(leaf: int, below: np.uint64, last: bool, most: int):
    """Rows (node, part, rep, n, leader, hi, lo) sorted by node, part and leader first: every bucket is
    brute-forced or split. A small bucket that goes on in the next batch waits for it; of a large one only
    the leader's sketch is kept. Edges leave the task as stars over what they connect."""
    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.binary())
        return batch_of(STEP, a=a, b=b, hi=none, lo=none)

    def split(part: pa.RecordBatch, group: np.ndarray, first: np.ndarray, held: tuple | None, found: list):
        """Members of large buckets against their leader; edges go to ``found``."""
        rep, leader, node = (part.column(c).to_numpy() for c in ("rep", "leader", "node"))
        low = _lows(part.column("lo"))
        lead = low[first]
        if held is not None:
            lead[0] = held[1]
        agree = (low == lead[group]).mean(1)
        own = rep == leader
        near = ~own & (agree >= (0.0 if last else NEAR))
        found.append(forest(leader[near], rep[near]))
        if not last:
            # the leader goes on once, from its first part
            on = np.flatnonzero(np.where(own, part.column("part").to_numpy() == 0, agree < CLOSE))
            for lo in range(0, len(on), 4096):
                at = on[lo:lo + 4096]
                token, path = _tokens(part.take(pa.array(at))), node[at].view(np.uint64)
                row, j = np.nonzero(token * (mix(path) | np.uint64(1))[:, None] < below)
                yield at[row], mix(path[row] * np.uint64(3) + token[row, j]).view(np.int64)

    def members(ahead: list[tuple[np.ndarray, pa.RecordBatch]], whole: bool) -> Iterator[pa.RecordBatch]:
        """Rows of the next level from one bucket; where all its members were here, a child that only one of
        them enters is a bucket of one."""
        if not ahead:
            return
        nodes = np.concatenate([x for x, _ in ahead])
        _, back, times = np.unique(nodes, return_inverse=True, return_counts=True)
        keep = times[back] > 1 if whole else np.ones(len(nodes), bool)
        at = 0
        for x, rows in ahead:
            here = pa.array(np.flatnonzero(keep[at:at + len(x)]))
            at += len(x)
            rows = rows.take(here)
            if len(here):
                yield batch_of(STEP, a=x[here.to_numpy()], b=rows.column("rep"), hi=rows.column("hi"), lo=rows.column("lo"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.RecordBatch | None = None              # rows of a small bucket that may go on
        held: tuple | None = None                        # (key, sketch) of the large bucket that may go on
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ahead: list[tuple[np.ndarray, pa.RecordBatch]] = []
        open_key: tuple | None = None
        single = True
        for b in batches:
            if len(found) > 1:
                found = [forest(*(np.concatenate(x) for x in zip(*found)))]
                if len(found[0][0]) > HELD_EDGES:        # mostly different classes: pass them on
                    yield edges(*found.pop())
            if carry is not None:
                b = pa.Table.from_batches([carry, b.cast(carry.schema)]).combine_chunks().to_batches()[0]
                carry = None
            if not b.num_rows:
                continue
            node, part, n = (b.column(c).to_numpy() for c in ("node", "part", "n"))
            head = np.concatenate([[True], (node[1:] != node[:-1]) | (part[1:] != part[:-1])])
            first = np.flatnonzero(head)
            size = np.diff(np.concatenate([first, [len(node)]]))
            small = n[first] <= leaf
            if small[-1] and size[-1] < n[first[-1]]:
                cut = int(first[-1])
                carry, first, size, small = b.slice(cut), first[:-1], size[:-1], small[:-1]
            if small.any():
                rows = b.take(pa.array(np.flatnonzero(np.repeat(small, size))))
                found.append(_bucket_forest(rows.column("rep").to_numpy(), _lows(rows.column("lo")), size[small]))
            if not small.all():
                rows = b.take(pa.array(np.flatnonzero(np.repeat(~small, size))))
                sizes = size[~small]
                group = np.repeat(np.arange(len(sizes)), sizes)
                starts = np.cumsum(sizes) - sizes
                key = int(node[first[~small][0]]), int(part[first[~small][0]])
                known = held if held is not None and held[0] == key else None
                # its members' children wait for the end of a bucket
                for at, child in split(rows, group, starts, known, found):
                    for g in np.unique(group[at]):
                        mine = group[at] == g
                        key = int(node[first[~small][g]]), int(part[first[~small][g]])
                        if key != open_key:
                            yield from members(ahead, single)
                            ahead, open_key, single = [], key, bool(n[first[~small][g]] <= most)
                        ahead.append((child[mine], rows.take(pa.array(at[mine])).select(["rep", "hi", "lo"])))
                key = int(node[first[~small][-1]]), int(part[first[~small][-1]])
                if known is None or held is None or held[0] != key:
                    held = key, _lows(rows.column("lo").slice(int(starts[-1]), 1))[0]
        if carry is not None:
            found.append(_bucket_forest(carry.column("rep").to_numpy(), _lows(carry.column("lo")), np.array([carry.num_rows])))
        yield from members(ahead, single)
        if found:
            yield edges(*forest(*(np.concatenate(x) for x in zip(*found))))
    return run


def candidate_edges(reps: DataFrame, runs: int, sampling: float, leaf: int, depth: int, part: int = 100_000) -> DataFrame:
    """The recursion. ``reps``: stored rows (rep, hi, lo). Edges (a, b) that connect all
    classes whose sketches met and agreed. A level is one shuffle of counts, one join and one pass."""
    below = np.uint64(int(2 ** 64 / (sampling * TOKENS)))
    level = reps.mapInArrow(_first_level(runs, below), NODE)
    edges = []
    for d in range(1, depth + 1):
        buckets = level.groupBy("node").agg(
            F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep", "node")).alias("leader")) \
            .filter("n > 1").withColumnRenamed("node", "_node")
        inside = level.join(buckets, F.col("node") == F.col("_node")).drop("_node")
        if d == 1:
            inside = inside.join(reps.select(F.col("rep").alias("_rep"), "hi", "lo"), F.col("rep") == F.col("_rep")).drop("_rep")
        parts = F.ceil(F.col("n") / part).cast("int")
        own = F.col("rep") == F.col("leader")
        dealt = inside.withColumn("part", F.explode(
            F.when(own, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), parts).cast("int")))))
        dealt = dealt.repartition("node", "part").sortWithinPartitions("node", "part", own.desc())
        step, seen = stored_with(
            dealt.select("node", "part", "rep", "n", "leader", "hi", "lo").mapInArrow(_bucket_pass(leaf, below, d == depth, part), STEP),
            "path-step", next=F.count("lo"))
        edges.append(step.filter("lo is null").select("a", "b"))
        if not seen["next"]:
            break
        level = step.filter("lo is not null").select(F.col("a").alias("node"), F.col("b").alias("rep"), "hi", "lo")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def exact_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Matrix: do the two sets reach the threshold? ``right`` None: among ``left``, without the diagonal."""
    sets = left + (right or [])
    size = np.array([len(s) for s in sets], np.float64)
    gram, back, seen = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64),
                                 return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size.astype(np.int64))
    shared = seen[back] > 1                             # an n-gram of one set alone meets nothing
    column = (np.cumsum(seen > 1) - 1)[back[shared]]
    owner = owner[shared]
    n, m = len(left), len(right) if right is not None else len(left)
    both = np.zeros((n, m), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, int((seen > 1).sum()), 4096):
        a, z = np.searchsorted(column, [lo, lo + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:z], column[a:z] - lo] = 1
        both += part[:n] @ (part[n:] if right is not None else part).T
    a = size[:n, None]
    b = size[None, n:] if right is not None else size[None, :]
    ok = (both * (1 + threshold) >= threshold * (a + b) - 1e-6) & (a > 0)
    if right is None:
        np.fill_diagonal(ok, False)
    return ok


LINK = "rep long, links long, root long"


def _verify(n: int, threshold: float):
    def run(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        raw, off = utf8(pa.array(part["text"].tolist(), pa.string()))
        grams, first, k1, k2 = ngrams(raw, off, n)
        # several rows may carry the doc_id of a class; its text is the one with its keys
        own = np.flatnonzero((k1 == part["k1"].to_numpy()) & (k2 == part["k2"].to_numpy()))
        rep, at = np.unique(part["rep"].to_numpy()[own], return_index=True)
        own = own[at]
        side = part["blk"].to_numpy()[own]
        sets = [np.unique(grams[first[i]:first[i + 1]]) for i in own]
        i, j = key[1], key[2]
        left = np.flatnonzero(side == i)
        if i == j:
            ok = exact_links([sets[x] for x in left], None, threshold)
            full = ok
            order = left
        else:
            right = np.flatnonzero(side == j)
            ok = exact_links([sets[x] for x in left], [sets[x] for x in right], threshold)
            order = np.concatenate([left, right])
            full = np.zeros((len(order), len(order)), bool)
            full[:len(left), len(left):] = ok
            full[len(left):, :len(left)] = ok.T
        links = full.sum(1)
        root = np.arange(len(order))
        while True:                                     # least label over the links
            new = np.minimum(root, np.where(full, root[None, :], len(order)).min(1, initial=len(order)))
            if (new == root).all():
                break
            root = new
        ids = rep[order]
        hit = links > 0
        return pd.DataFrame({"rep": ids[hit], "links": links[hit], "root": ids[root[hit]]})
    return run


def _named_rows(docs: DataFrame, n: int = 5, threshold: float = 0.8, target: float = 0.999,
                sampling: float = 0.7, leaf: int = 1024, depth: int = 6, block: int = 512,
                block_bytes: int = 16 << 20) -> DataFrame:
    """Per row: doc_id and class keys k1, k2; the columns of jaccard_groups; and the class of its
    group that stays (stay_k1, stay_k2: of those that hold the least doc_id)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    rows = stored(texts.mapInArrow(_rows(n), ROW), "join-rows")
    classes = stored(rows.filter("doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("copy_id"), F.first("size").alias("size"), F.first("hi").alias("hi"), F.first("lo").alias("lo"))
        .withColumn("rep", F.monotonically_increasing_id()), "join-classes")
    reps = classes.filter("lo is not null")
    edges = candidate_edges(reps.select("rep", "hi", "lo"), runs_needed(threshold, sampling, depth, target),
                            sampling, leaf, depth)
    coarse = least_labels(edges, "coarse-groups")
    sized = coarse.join(reps.select("rep", "copy_id", "size", "k1", "k2"), F.col("id") == F.col("rep"))
    blocks = sized.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / block_bytes))
                                        .cast("int").alias("nb")).withColumnRenamed("label", "grp")
    members = sized.join(blocks, F.col("label") == F.col("grp")) \
        .select("grp", "rep", "copy_id", "k1", "k2", "nb", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int").alias("blk"))
    dealt = texts.join(members, F.col("doc_id") == F.col("copy_id")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .select("grp", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
                "blk", "rep", "k1", "k2", "text")
    links = stored(dealt.groupBy("grp", "i", "j").applyInPandas(_verify(n, threshold), LINK), "join-links")
    labels = stored(least_labels(links.select(F.col("rep").alias("a"), F.col("root").alias("b")), "join-groups"),
                    "join-labels")
    count = links.groupBy("rep").agg(F.sum("links").cast("long").alias("n_links")).withColumnRenamed("rep", "_counted")
    linked = labels.join(classes.select("rep", "copy_id", "k1", "k2"), F.col("id") == F.col("rep"))
    least = linked.groupBy("label").agg(F.min(F.struct("copy_id", "k1", "k2")).alias("_least")).select(
        F.col("label").alias("_label"), F.col("_least.copy_id").alias("class_id"),
        F.col("_least.k1").alias("stay_k1"), F.col("_least.k2").alias("stay_k2"))
    named = classes.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "rep", "copy_id") \
        .join(labels, F.col("rep") == F.col("id"), "left").join(least, F.col("label") == F.col("_label"), "left") \
        .join(count, F.col("rep") == F.col("_counted"), "left") \
        .select("_k1", "_k2", "copy_id", F.coalesce("class_id", "copy_id").alias("class_id"), "n_links",
                F.coalesce("stay_k1", "_k1").alias("stay_k1"), F.coalesce("stay_k2", "_k2").alias("stay_k2"))
    # a null doc_id joins nothing
    keyed = rows.select("doc_id", "k1", F.when(F.col("doc_id").isNotNull(), F.col("k2")).alias("k2"))
    return keyed.join(named, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").select(
        "doc_id", "k1", "k2", "class_id", "copy_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "stay_k1", "stay_k2")


def jaccard_groups(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, class_id (least doc_id of its linked group), copy_id (least doc_id
    with the same words), n_links (other texts at the threshold or above). Options: see _named_rows."""
    return _named_rows(docs, **options).select("doc_id", "class_id", "copy_id", "n_links")


def _with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw, off in text_blocks(batches):
        _, _, k1, k2 = ngrams(raw, off, 1)
        yield pa.RecordBatch.from_arrays([part.column("_row"), part.column("_doc"), pa.array(k1), pa.array(k2)],
                                         names=["_row", "_doc", "_k1", "_k2"])


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group, all columns as they were: one with the least doc_id
    (where several texts or rows carry it, any one of those in the group); rows with a null
    doc_id stay."""
    rows = stored(_named_rows(docs, **options).filter("doc_id is not null").select(
        F.col("doc_id").alias("_id"), F.col("k1").alias("_a"), F.col("k2").alias("_b"),
        ((F.col("doc_id") == F.col("class_id")) & (F.col("k1") == F.col("stay_k1")) & (F.col("k2") == F.col("stay_k2"))
         ).alias("stays")), "near-rows")
    repeated = stored(rows.filter("stays").groupBy("_id", "_a", "_b").agg(F.count("*").alias("n")).filter("n > 1").drop("n"),
                      "near-repeated")
    whole = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                        F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    whole = whole.mapInArrow(_with_keys, whole.select("_row", "_doc", F.lit(0).cast("long").alias("_k1"),
                                                      F.lit(0).cast("long").alias("_k2")).schema)

    def rows_of(which: DataFrame, how: str) -> DataFrame:
        return whole.join(which, (F.col("_doc") == F.col("_id")) & (F.col("_k1") == F.col("_a"))
                          & (F.col("_k2") == F.col("_b")), how)

    lost = rows.filter("not stays").select("_id", "_a", "_b").distinct()
    if repeated.isEmpty():
        return rows_of(lost, "left_anti").select("_row.*")
    # rows that repeat words and doc_id: one of each stays
    return rows_of(lost.unionByName(repeated), "left_anti").select("_row").unionByName(
        rows_of(repeated, "left_semi").groupBy("_doc", "_k1", "_k2").agg(F.first("_row").alias("_row")).select("_row")
    ).select("_row.*")
