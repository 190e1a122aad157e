"""Operator 13, source divergence audit: how far the words of each source lie from those of the
other sources and of the whole language.

Translate-table tokenizer: one ``bytes.translate`` over a text's UTF-8 bytes lowers A-Z and blanks
every other ASCII byte, ``bytes.split`` gives the terms (runs of letters A-Z, a-z and of characters
beyond ASCII), a ``Counter`` per document their frequencies. A task adds the counters of its
documents up by (lang, source) and passes (term, occurrences, documents) on when it holds
``TASK_TERMS`` terms, so what is shuffled is the vocabulary of tasks and not the words of texts.

Aggregation stays sparse. With V kept terms a language has V lines for each source, most of them
zero counts, and a source's zero lines all have one share. Written with f(p, q) = floor((p-q)^2/q),
p0 the share of a zero count:

    sum over V terms of f(pA, pB) = V f(p0A, p0B)
        + sum over terms A has  of f(pA, p0B) - f(p0A, p0B)             (by counts of equal shares of A)
        + sum over terms B has  of f(p0A, pB) - f(p0A, p0B)             (by counts of equal shares of B)
        + sum over terms both have of f(pA, pB) - f(pA, p0B) - f(p0A, pB) + f(p0A, p0B)

The last sum is taken in numpy tasks, each over whole terms, that return sums by pair of sources and
no pair of rows. All numbers are integers; shares are divided in base 1000, so products stay below
2**63 for counts up to 9 * 10**15.

Defined cases: null text, lang and source are ''; a group (lang, source) without a term, or of a
language without a kept term, has its pairs (value 0 where the language keeps none) and no term
lines; rows are documents whatever their doc_id, repeated rows count each; a text of any length is
read whole, in stretches that end at a separator; an empty table gives an empty result; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, stored

#: One pass: A-Z to a-z, other ASCII bytes to a space, bytes beyond ASCII as they are.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TASK_TERMS = 200_000           # terms a task holds before it passes its counts on
TASK_BYTES = 16 << 20          # ... or bytes of them
STRETCH = 1 << 22              # bytes of a text split at once
COUNTS = "lang binary, source binary, term binary, n long, docs long"
SALTS = 32


def term_counts(text: bytes) -> Counter:
    """The terms of one text (UTF-8) and how often each occurs."""
    plain = text.translate(TABLE)
    if len(plain) <= STRETCH:
        return Counter(plain.split())
    out: Counter = Counter()
    lo = 0
    while lo < len(plain):
        hi = plain.find(b" ", lo + STRETCH)
        hi = len(plain) if hi < 0 else hi
        out.update(plain[lo:hi].split())
        lo = hi
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[bytes, bytes], tuple[dict, Counter]] = {}
    held = size = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = list(n)
            for lo in range(0, len(terms), 1 << 15):
                part = terms[lo:lo + (1 << 15)]
                yield batch_of(COUNTS, lang=[lang] * len(part), source=[source] * len(part), term=part,
                               n=[n[t] for t in part], docs=[docs[t] for t in part])

    for b in batches:
        for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("_lang", "_source", "_text"))):
            # every group has a line without a term, which says that it occurs
            n, docs = groups.setdefault((lang, source), ({b"": 0}, Counter()))
            counts = term_counts(text)
            before = len(n)
            for term, c in counts.items():
                n[term] = n.get(term, 0) + c
            docs.update(counts.keys())
            held += len(n) - before
            size += sum(map(len, counts)) if len(text) > 1 << 16 else 0
            if held >= TASK_TERMS or size >= TASK_BYTES:
                yield from passed_on()
                groups, held, size = {}, 0, 0
    yield from passed_on()


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10**9 * count / total) for 1 <= count <= total, digit by digit in base 1000."""
    total = F.greatest(total, F.lit(1).cast("long"))
    whole, rest = F.lit(0).cast("long"), count.cast("long")
    for _ in range(3):
        whole = whole * 1000 + _div(rest * 1000, total)
        rest = (rest * 1000) % total
    return whole + 1


def _far(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


BOTH = "a long, b long, v long"


def _far_np(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _sums_by_pair(gid: np.ndarray, p: np.ndarray, p0: np.ndarray, first: np.ndarray,
                  most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows sorted by term, ``first`` where each term begins and the end. About ``most`` pairs
    are held at once; a term of more sources than fit is taken in stretches of its rows."""
    ids, at = np.unique(gid, return_inverse=True)
    size = np.diff(first)
    dense = len(ids) ** 2 <= 1 << 22
    total = np.zeros(len(ids) ** 2, np.int64) if dense else None
    for k in np.unique(size[size > 1]):
        starts = first[:-1][size == k]
        rows = max(1, most // int(k * k))                   # terms at once
        part = max(1, most // int(k)) if k * k > most else int(k)
        for lo in range(0, len(starts), rows):
            col = starts[lo:lo + rows, None] + np.arange(k)
            for r in range(0, int(k), part):
                a, b = col[:, r:r + part, None], col[:, None, :]
                v = _far_np(p[a], p[b]) - _far_np(p[a], p0[b]) - _far_np(p0[a], p[b]) + _far_np(p0[a], p0[b])
                key = (at[a] * len(ids) + at[b]).ravel()
                if dense:
                    np.add.at(total, key, v.ravel())
                else:
                    key, back = np.unique(key, return_inverse=True)
                    add = np.zeros(len(key), np.int64)
                    np.add.at(add, back, v.ravel())
                    yield batch_of(BOTH, a=ids[key // len(ids)], b=ids[key % len(ids)], v=add)
    if dense and len(ids):
        key = np.flatnonzero(total)
        yield batch_of(BOTH, a=ids[key // len(ids)], b=ids[key % len(ids)], v=total[key])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gid, term key, p, p0) sorted by term: sums over the terms two groups share. The last
    term of a batch waits for the next one."""
    carry = None
    for b in batches:
        whole = pa.Table.from_batches([b] if carry is None else [carry, b]).combine_chunks()
        if not whole.num_rows:
            continue
        key = whole.column("term").combine_chunks().cast(pa.binary())
        lang = whole.column("lang").combine_chunks().cast(pa.binary())
        new = np.ones(len(key), bool)
        if len(key) > 1:
            new[1:] = pc.or_(pc.not_equal(key[1:], key[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        cut = int(first[-1])
        carry = whole.slice(cut).to_batches()[0]
        if cut:
            yield from _sums_by_pair(*(whole.column(c).to_numpy()[:cut] for c in ("gid", "p", "p0")), first)
    if carry is not None:
        yield from _sums_by_pair(*(carry.column(c).to_numpy() for c in ("gid", "p", "p0")), np.array([0, carry.num_rows]))


def _beside(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row (gid, lang, ...) beside each other group (gid2, zero2) of its language, dealt by
    language and salt, as a language may hold most rows."""
    other = groups.select(F.col("lang").alias("lang2"), F.col("gid").alias("gid2"), F.col("p0").alias("zero2"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt2"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return salted.join(other, (F.col("lang") == F.col("lang2")) & (F.col("salt") == F.col("salt2"))
                       & (F.col("gid") != F.col("gid2"))).drop("salt", "salt2", "lang2")


def kept_counts(docs: DataFrame, least_docs: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows, groups), both stored. rows: lang, gid, term, n, lang_n, one for each kept term that
    occurs in a group. groups: gid, lang, source, n (occurrences of kept terms), v (kept terms of
    the language), lang_total, p0 (the share of a zero count)."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(f"_{c}") for c in ("lang", "source", "text")]
    counts = stored(docs.select(*text).mapInArrow(_count_terms, COUNTS).groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = stored(counts.filter(F.octet_length("term") > 0).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least_docs).drop("docs"),
        "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    own = counts.filter("docs > 0").join(kept, ["lang", "term"])
    named = stored(counts.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id()),
                   "lang-sources")
    rows = stored(own.join(named, ["lang", "source"]).select("lang", "gid", "term", "n", "lang_n"), "kept-counts")
    totals = rows.groupBy("gid").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    groups = named.join(totals, "gid", "left").join(langs, "lang", "left").select(
        "gid", "lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"),
        F.coalesce("lang_total", zero).alias("lang_total"))
    groups = groups.withColumn("p0", _share(F.lit(1), F.col("n") + F.col("v")))
    return rows, stored(groups, "lang-groups")


def divergence(docs: DataFrame, least_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: each other source of the language and
    the summed distance to it; part ``term``: the ``top_terms`` terms that a source has more of
    than its language, by their distance."""
    rows, groups = kept_counts(docs, least_docs)
    sized = groups.select(F.col("gid").alias("_gid"), F.col("n").alias("total"), "v", "lang_total", "p0")
    shares = rows.join(sized, F.col("gid") == F.col("_gid")).withColumn(
        "p", _share(F.col("n") + 1, F.col("total") + F.col("v")))

    # pairs: what all terms add, what the terms of either side add, what shared terms add
    zeros = _beside(groups.select("lang", "gid", "v", "p0"), groups).select(
        F.col("gid").alias("a"), F.col("gid2").alias("b"), (F.col("v") * _far(F.col("p0"), F.col("zero2"))).alias("v"))
    equal = shares.groupBy("lang", "gid", "p", "p0").agg(F.count("*").alias("terms"))
    sides = _beside(equal, groups).groupBy("gid", "gid2").agg(
        F.sum(F.col("terms") * (_far(F.col("p"), F.col("zero2")) - _far(F.col("p0"), F.col("zero2")))).alias("to"),
        F.sum(F.col("terms") * (_far(F.col("zero2"), F.col("p")) - _far(F.col("zero2"), F.col("p0")))).alias("back"))
    sides = sides.select(F.explode(F.array(
        F.struct(F.col("gid").alias("a"), F.col("gid2").alias("b"), F.col("to").alias("v")),
        F.struct(F.col("gid2").alias("a"), F.col("gid").alias("b"), F.col("back").alias("v")))).alias("r")).select("r.*")
    both = shares.select("lang", "gid", "term", "p", "p0").repartition("lang", "term") \
        .sortWithinPartitions("lang", "term").mapInArrow(_together, BOTH).filter("a <> b")
    sums = zeros.unionByName(sides).unionByName(both).groupBy("a", "b").agg(F.sum("v").alias("value"))
    names = groups.select(F.col("gid"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    item = names.select(F.col("gid").alias("_b"), F.col("source").alias("item"))
    pairs = sums.join(names, F.col("a") == F.col("gid")).join(item, F.col("b") == F.col("_b")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = [F.col("value").desc(), F.col("item")]
    # one row for each source of the language
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))

    # terms: the first of each salt, then the first of those
    q = _share(F.col("lang_n") + 1, F.col("lang_total") + F.col("v"))
    terms = shares.withColumn("q", q).filter("p > q").select(
        "gid", F.col("term").cast("string").alias("item"), _far(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
    first = F.row_number().over(Window.partitionBy("gid", "salt").orderBy(*order))
    terms = terms.withColumn("rank", first).filter(F.col("rank") <= top_terms).drop("salt", "rank")
    last = F.row_number().over(Window.partitionBy("gid").orderBy(*order))
    terms = terms.withColumn("rank", last).filter(F.col("rank") <= top_terms).join(
        names, "gid").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
