"""Operator 2, benchmark decontamination: q-gram lemma filtering.

An item leaks where any ``window`` characters of it (all of it, if it is shorter), beginning
at any place, occur in a text with at most k = ``rate`` * window edits. So the shortest
excerpt that is always found is one of ``window`` characters: 72, about 13 words, with up to
3 edits. A window of m characters that occurs in a text with at most k edits shares at least
m - q + 1 - q*k of its q-grams with the text, on diagonals (text position minus item
position) that differ by at most k. So shared q-grams are put in diagonal bands of
width 2(k + 1) that begin every k + 1 diagonals (any k + 1 neighbouring diagonals lie in
one of them), and every window that holds enough of a band's q-grams is a candidate. Runs
of q-grams on one diagonal are compared character by character, which settles the windows
in them; a banded alignment of window and text decides the others. Nothing is sampled, and
every text is read to its end.

A q-gram that stands at many places of an item, or fills a stretch of a text (rulers, dashes), makes as
many pairs as the product of both. Pairs are therefore taken in overlapping stretches of bounded size, and a
run of one character is read at both its ends, where everything occurs that occurs inside it.

Texts are compared lower-cased, each run of white space as one space. The q-gram index
of the benchmark goes to the tasks in blocks of at most ``block_chars`` characters; a
larger benchmark takes several passes, one per block. Documents are never shuffled.

Defined cases: null or blank texts match nothing; null or blank items match nothing; items
of less than ``2 * q`` characters are found where they stand exactly, and those of less than
``q`` only as whole words (in scripts written with spaces): such an item is little
evidence, and one that is a common word is found in every text that holds it. An item that
is there several times is reported under each of its ids; repeated documents are reported
row by row; an empty table gives an empty result; other columns are kept by
``drop_contaminated`` and ignored by ``find_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, mix, text_blocks

#: White space outside ASCII.
SPACES = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LEAK = "doc_id long, item_id long, first_char long, end_char long, windows int, edits int"
FILTER_BITS = 22
#: Windows aligned at once (bounds the numpy temporaries); the first code point
#: of the scripts written without spaces between words.
ALIGNED, UNSPACED = 1 << 14, 0x0E00
#: Shared q-grams (place in the text, place in an item) taken at once; characters of an item indexed as one.
PAIRS, PIECE = 1 << 20, 4096


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with single spaces, a 0 after each text;
    and where each came from in the lower-cased, 0-terminated sequence."""
    s = "".join([t.replace("\0", " ").lower() + "\0" for t in texts])
    points = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    if (high := points > 127).any():
        blank |= high & np.isin(points, SPACES)
    keep = np.flatnonzero(~blank | ~np.concatenate([[False], blank[:-1]]))
    return np.where(blank[keep], 32, points[keep]).astype(np.uint64), keep


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q code points from each position on, by doubling."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    out, have, step, power = None, 0, mix(points), 1
    mult = base
    while power <= q:
        if q & power:                       # append the block of ``power`` symbols after what is there
            part = step[have:have + n]
            out = part.copy() if out is None else out * mult + part
            have += power
        if power * 2 <= q:
            step = step[:-power] * mult + step[power:]
        mult = np.uint64(int(mult) * int(mult) % (1 << 64))
        power *= 2
    return mix(out)


@dataclass
class Index:
    """Benchmark block: q-grams with their places, and the windows."""
    q: int
    k: int
    keys: np.ndarray          # distinct q-grams, sorted
    first: np.ndarray         # postings of key i: first[i] .. first[i + 1]
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray          # bit table over the upper bits of the q-grams
    ids: np.ndarray           # item ids
    text: np.ndarray          # code points of all items
    start: np.ndarray         # of each item in ``text``
    size: np.ndarray
    window: int
    short: list               # items under q characters: (length, their hashes sorted, their items)
    parent: np.ndarray        # of each item: its place in ``ids``; long items are indexed in pieces
    base: np.ndarray          # ... and where in the whole item it begins
    by_item: np.ndarray       # key * items + item of each posting, sorted


def build_index(items: list[tuple[int, str]], q: int, window: int, rate: float) -> Index:
    points, ids, parent, base = [], [], [], []
    for item_id, text in items:
        p, _ = normalised([text or ""])
        p = p[:-1]
        p = p[(1 if len(p) and p[0] == 32 else 0):(len(p) - 1 if len(p) and p[-1] == 32 else len(p))]
        if len(p):
            # neighbouring pieces share all but one character of a window: each window lies in one piece
            for lo in range(0, max(1, len(p) - window + 1), PIECE - window + 1):
                points.append(p[lo:lo + PIECE])
                parent.append(len(ids))
                base.append(lo)
            ids.append(item_id)
    size = np.array([len(p) for p in points], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1].astype(np.int64)
    g = [grams(p, q) for p in points]
    key = np.concatenate(g) if g else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(g)), [len(x) for x in g]) if g else np.zeros(0, np.int64)
    place = np.concatenate([np.arange(len(x)) for x in g]) if g else np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    short = []
    for length in range(1, q):
        few = np.flatnonzero(size == length)
        if len(few):
            h = np.concatenate([grams(points[x], length) for x in few])
            by = np.argsort(h, kind="stable")
            short.append((length, h[by], few[by]))
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[keys >> np.uint64(64 - FILTER_BITS)] = True
    return Index(q, int(rate * window), keys, np.append(first, len(key)), item[order], place[order], seen, np.array(ids, object),
                 np.concatenate(points) if points else np.zeros(0, np.uint64), start, size, window, short,
                 np.array(parent, np.int64), np.array(base, np.int64),
                 np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key)))) * max(len(size), 1) + item[order])


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, counts[i] rows: (i repeated, 0 .. counts[i] - 1)."""
    i = np.repeat(np.arange(len(counts)), counts)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)


def _align(index: Index, points: np.ndarray, item: np.ndarray, lo: np.ndarray, size: np.ndarray,
           at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignment of each window with the text, all regions at once: its first
    character lies on one of the ``width`` places from ``at`` on. Returns (fewest edits,
    first, end). A cell holds edits * 1024 + the place it began on."""
    one, cols = 1024, np.arange(width)
    cell = np.broadcast_to(cols, (len(at), width))          # any start in the band is free
    best, tail = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for row in range(int(size.max())):
        where = at[:, None] + row + cols
        text = np.where((where >= 0) & (where < len(points)), points[np.clip(where, 0, len(points) - 1)], 0)
        want = index.text[np.minimum(index.start[item] + lo + row, len(index.text) - 1)][:, None]
        same = cell + one * (text != want)                  # same diagonal: match or replace
        drop = np.concatenate([cell[:, 1:] + one, np.full((len(at), 1), 1 << 40)], 1)
        new = np.minimum(same, drop)
        cell = np.minimum.accumulate(new - cols * one, axis=1) + cols * one   # characters the window lacks
        done = np.flatnonzero(size == row + 1)
        best[done] = cell[done].min(1)
        tail[done] = cell[done].argmin(1)
    return best // one, at + best % one, at + size + tail


def _equal(index: Index, points: np.ndarray, item: np.ndarray, lo: np.ndarray, at: np.ndarray,
           size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` characters of each item from ``lo`` on stand at ``at``."""
    i, nth = _spread(size)
    differ = index.text[(index.start[item] + lo)[i] + nth] != points[at[i] + nth]
    return np.bincount(i[differ], minlength=len(size)) == 0


def _exact_windows(index: Index, points: np.ndarray, pair: np.ndarray, item: np.ndarray, place: np.ndarray,
                   text_at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that stand in a text without edits, from runs of shared q-grams on one diagonal:
    (row of the run's first q-gram, first character in the item, in the text)."""
    q, diagonal = index.q, text_at - place
    order = np.lexsort((place, diagonal, pair))
    p, d, at = pair[order], diagonal[order], place[order]
    head = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (d[1:] != d[:-1]) | (at[1:] != at[:-1] + 1)])
                          if len(order) else np.zeros(0, bool))
    run = np.diff(np.append(head, len(order)))
    row = order[head]
    held = run - size[item[row]] + q
    row, run, held = row[held > 0], run[held > 0], held[held > 0]
    same = _equal(index, points, item[row], place[row], text_at[row], run + q - 1)
    i, nth = _spread(held[same])
    row = row[same][i]
    return row, place[row] + nth, text_at[row] + nth


def _short_items(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items under q characters that stand in the text as whole words: (item, first character)."""
    items, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length, keys, item in index.short:
        g = grams(points, length)
        lo, hi = np.searchsorted(keys, g), np.searchsorted(keys, g, "right")
        hit = np.flatnonzero(hi > lo)
        i, nth = _spread((hi - lo)[hit])
        at, it = hit[i], item[lo[hit][i] + nth]
        same = _equal(index, points, it, np.zeros_like(it), at, np.full(len(at), length))
        at, it = at[same], it[same]
        before = np.where(at > 0, points[at - 1], 0)
        joined = _in_a_word(before, points[at]) | _in_a_word(points[at + length - 1], points[at + length])
        items.append(it[~joined])
        places.append(at[~joined])
    return np.concatenate(items), np.concatenate(places)


def _in_a_word(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether no word ends between these two characters."""
    kinds, back = np.unique(np.concatenate([left, right]), return_inverse=True)
    inside = np.array([c < UNSPACED and chr(c).isalnum() for c in kinds.tolist()], bool)[back]
    return inside[:len(left)] & inside[len(left):]


def _shortened(points: np.ndarray, origin: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one character cut to their first and last ``keep``. What occurs inside such a run occurs at
    both its ends as well, so with ``keep`` beyond any occurrence's length the same windows are found, with
    the same edits, first and last place."""
    head = np.flatnonzero(np.concatenate([[True], points[1:] != points[:-1]]) if len(points) else np.zeros(0, bool))
    run = np.diff(np.append(head, len(points)))
    if not len(run) or run.max() <= 2 * keep:
        return points, origin
    nth = np.arange(len(points)) - np.repeat(head, run)
    held = (nth < keep) | (nth >= np.repeat(run, run) - keep)
    return points[held], origin[held]


def _stretches(index: Index, hit: np.ndarray, slot: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of the shared q-grams of about ``PAIRS`` (place in the text, place in an item) each: (from, to,
    first item, last item + 1). Neighbours overlap by more than an occurrence is long, so each lies whole in
    one of them; where a stretch cannot be shorter, it is taken for some items at a time."""
    upto = np.cumsum(index.first[slot + 1] - index.first[slot])
    overlap = index.window + 2 * index.k + index.q
    lo = 0
    while lo < len(hit):
        before = upto[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(upto, before + PAIRS, "right")), int(np.searchsorted(hit, hit[lo] + 3 * overlap)), lo + 1)
        if upto[hi - 1] - before <= 2 * PAIRS:
            yield lo, hi, 0, len(index.size)
        else:
            some, times = np.unique(slot[lo:hi], return_counts=True)
            i, nth = _spread(index.first[some + 1] - index.first[some])
            load = np.cumsum(np.bincount(index.item[index.first[some][i] + nth], times[i], len(index.size)))
            cuts = np.unique(np.concatenate([[0], 1 + np.searchsorted(load, np.arange(PAIRS, load[-1], PAIRS)), [len(index.size)]]))
            yield from ((lo, hi, int(x), int(y)) for x, y in zip(cuts[:-1], cuts[1:]))
        if hi >= len(hit):
            return
        lo = max(lo + 1, int(np.searchsorted(hit, hit[hi - 1] - overlap)))


def find_in_block(index: Index, texts: list[str]) -> dict[str, np.ndarray]:
    """Verified leaks in a block of texts: doc (place in the block), item, first and end
    character, windows, edits. One row per (doc, item)."""
    points, origin = normalised(texts)
    q = index.q
    points, origin = _shortened(points, origin, 2 * (index.window + 2 * index.k + q))
    g = grams(points, q)
    hit = np.flatnonzero(index.seen[g >> np.uint64(64 - FILTER_BITS)])
    slot = np.searchsorted(index.keys, g[hit])
    real = slot < len(index.keys)
    real[real] = index.keys[slot[real]] == g[hit[real]]
    hit, slot = hit[real], slot[real]
    ends = np.flatnonzero(points == 0)
    begin = np.concatenate([[0], ends[:-1] + 1])
    found = [_one_each(*_windows_found(index, points, begin, ends, hit[lo:hi], slot[lo:hi], x, y))
             for lo, hi, x, y in _stretches(index, hit, slot)]
    item, at = _short_items(index, points)
    found.append((np.searchsorted(ends, at), item, np.zeros_like(at), at, at + index.size[item], np.zeros_like(at)))
    doc, item, lo, start, stop, edits = (np.concatenate(x) for x in zip(*found))
    item, lo = index.parent[item], lo + index.base[item]     # of the whole item
    doc, item, lo, start, stop, edits = _one_each(doc, item, lo, start, stop, edits)
    if not len(doc):
        return {c: np.zeros(0, np.int64) for c in ("doc", "item", "first", "end", "windows", "edits")}
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]))
    first = np.maximum(np.minimum.reduceat(start, head), begin[doc[head]])
    end = np.minimum(np.maximum.reduceat(stop, head), ends[doc[head]])
    base = origin[begin[doc[head]]]
    return {"doc": doc[head], "item": item[head], "first": origin[first] - base, "end": origin[end - 1] + 1 - base,
            "windows": np.diff(np.append(head, len(doc))), "edits": np.minimum.reduceat(edits, head)}


def _one_each(doc, item, lo, start, stop, edits) -> tuple[np.ndarray, ...]:
    """One row for each window (doc, item, lo): its first place, last end and fewest edits."""
    if not len(doc):
        return doc, item, lo, start, stop, edits
    order = np.lexsort((lo, item, doc))
    doc, item, lo, start, stop, edits = (x[order] for x in (doc, item, lo, start, stop, edits))
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (lo[1:] != lo[:-1])]))
    return (doc[head], item[head], lo[head], np.minimum.reduceat(start, head), np.maximum.reduceat(stop, head),
            np.minimum.reduceat(edits, head))


def _windows_found(index: Index, points: np.ndarray, begin: np.ndarray, ends: np.ndarray, hit: np.ndarray, slot: np.ndarray,
                   low_item: int, high_item: int) -> list[np.ndarray]:
    """Windows of the items from ``low_item`` on that occur where the q-grams ``hit`` are shared:
    (doc, item, first character in the item, first and end in the text, edits)."""
    q, k, n_items = index.q, index.k, len(index.size)
    if high_item - low_item == n_items:
        first, last = index.first[slot], index.first[slot + 1]
    else:
        first, last = (np.searchsorted(index.by_item, slot * n_items + x) for x in (low_item, high_item))
    i, nth = _spread(last - first)
    text_at, post = hit[i], first[i] + nth
    item, place = index.item[post], index.place[post]
    doc = np.searchsorted(ends, text_at)
    size = np.minimum(index.size, index.window)              # of a window of each item
    most = np.minimum(k, (size - q) // q)                    # edits
    least = size - q + 1 - q * most
    # a pair of document and item needs as many shared q-grams in all
    _, pair, n = np.unique(doc * n_items + item, return_inverse=True, return_counts=True)
    enough = n[pair] >= least[item]
    text_at, item, place, doc, pair = (x[enough] for x in (text_at, item, place, doc, pair))
    row, exact_lo, exact_at = _exact_windows(index, points, pair, item, place, text_at, size)
    exact = [doc[row], item[row], exact_lo, exact_at, exact_at + size[item[row]], np.zeros(len(row), np.int64)]
    # each shared q-gram counts in two bands, once in each
    longest = int(index.size.max(initial=0))
    shift = text_at - begin[doc] - place + longest           # never negative
    top = (len(points) + longest) // (k + 1) + 2
    band = shift // (k + 1) + 1
    exact_group = pair[row] * top + band[row]
    group, place, item, doc = (np.concatenate(x) for x in ((pair * top + band, pair * top + band - 1), (place, place),
                                                           (item, item), (doc, doc)))
    order = np.lexsort((place, group))
    group, place, item, doc = (x[order] for x in (group, place, item, doc))
    once = np.concatenate([[True], (group[1:] != group[:-1]) | (place[1:] != place[:-1])]) if len(group) else \
        np.zeros(0, bool)
    group, place, item, doc = (x[once] for x in (group, place, item, doc))
    # from each q-gram to the one that makes enough: the windows that hold both, each begun once
    far = np.arange(len(group)) + least[item] - 1
    last = np.minimum(far, len(group) - 1)
    near = (far < len(group)) & (group[last] == group) & (place[last] - place <= size[item] - q)
    group, item, doc, low, high = (x[near] for x in (group, item, doc, np.maximum(0, place[last] + q - size[item]),
                                                     np.minimum(place, index.size[item] - size[item])))
    if len(group):
        low[1:] = np.where(group[1:] == group[:-1], np.maximum(low[1:], high[:-1] + 1), low[1:])
    i, nth = _spread(np.maximum(0, high - low + 1))
    group, item, doc, lo = group[i], item[i], doc[i], low[i] + nth
    # windows in a band that holds them without edits are settled
    groups = np.unique(group)
    settled = np.concatenate([np.searchsorted(groups, exact_group - b) * (longest + 1) + exact_lo for b in (0, 1)])
    known = np.concatenate([np.isin(exact_group - b, groups) for b in (0, 1)])
    todo = ~np.isin(np.searchsorted(groups, group) * (longest + 1) + lo, settled[known])
    group, item, doc, lo = (x[todo] for x in (group, item, doc, lo))
    at = begin[doc] + lo + (group % top - 1) * (k + 1) - longest - k
    found = [exact]
    for b in range(0, len(at), ALIGNED):
        part = slice(b, b + ALIGNED)
        edits, start, stop = _align(index, points, item[part], lo[part], size[item[part]], at[part], 2 * (k + 1) + 2 * k)
        good = edits <= most[item[part]]
        found.append([x[good] for x in (doc[part], item[part], lo[part], start, stop, edits)])
    return [np.concatenate(x) for x in zip(*found)]


def _indexes(benchmark: DataFrame, q: int, window: int, rate: float, block_chars: int) -> Iterator[Index]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for b in range(blocks):       # each block is bounded: block_chars, or one item where that is longer
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield build_index([(r["item_id"], r["text"]) for r in part.toLocalIterator()], q, window, rate)


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = 12, window: int = 72,
               rate: float = 0.05, block_chars: int = 16 << 20) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, first_char and
    end_char (span in the lower-cased text), windows (found) and edits (fewest of a window)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for index in _indexes(benchmark, q, window, rate, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part, _, _ in text_blocks(batches):
                got = find_in_block(index, [t or "" for t in part.column("text").to_pylist()])
                if len(got["doc"]):
                    yield batch_of(LEAK, doc_id=part.column("doc_id").take(pa.array(got["doc"])),
                                   item_id=index.ids[got["item"]].tolist(), first_char=got["first"],
                                   end_char=got["end"], windows=got["windows"], edits=got["edits"])

        found = rows.mapInArrow(find, LEAK)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = 12, window: int = 72,
                      rate: float = 0.05, block_chars: int = 16 << 20) -> DataFrame:
    """The documents no benchmark item is found in, all columns as they were."""
    spark = docs.sparkSession
    for index in _indexes(benchmark, q, window, rate, block_chars):
        shared = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, _, _ in text_blocks(batches):
                keep = np.ones(part.num_rows, bool)
                keep[find_in_block(shared.value, [t or "" for t in part.column("text").to_pylist()])["doc"]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
