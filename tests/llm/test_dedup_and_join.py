import collections
import hashlib
import itertools
import random

from livepulse.llm import exact_dedup, near_join

from llm_fixtures import AWKWARD, make_texts


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_duplicates_against_brute_force(docs_of):
    texts = make_texts(1, 60)
    rows = AWKWARD + [(100 + i, random.Random(i).choice(texts).upper() if i % 3 else texts[i % 60]) for i in range(300)]
    rows += [(5000 + i, "the hot copy") for i in range(400)]
    for keep, best in (("max", max), ("min", min)):
        got = exact_dedup.exact_duplicates(docs_of(rows), keep=keep, fan_in=4).collect()
        assert len(got) == len(rows)
        groups = collections.defaultdict(list)
        for d, t in rows:
            groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(d)
        kept = collections.Counter()
        for r in got:
            ids = groups[r.text_sha256]
            known = [d for d in ids if d is not None]
            assert r.group_size == len(ids) and r.keep_id == (best(known) if known else None)
            assert not r.kept or r.doc_id == r.keep_id
            kept[r.text_sha256] += r.kept
        assert set(kept.values()) == {1}


def test_drop_exact_duplicates_keeps_rows_whole(docs_of):
    rows = AWKWARD + [(50, "one two"), (51, "ONE two")]
    df = docs_of(rows)
    out = exact_dedup.drop_exact_duplicates(df, keep="max")
    assert out.schema == df.schema
    got = out.collect()
    assert len(got) == len({lower(t) for _, t in rows})
    assert {r.doc_id for r in got if lower(r.text) == "one two"} == {51}
    assert sum(lower(r.text) == "one" for r in got) == 1


def test_empty_tables(docs_of):
    empty = docs_of([]).limit(0)
    assert exact_dedup.exact_duplicates(empty).collect() == []
    assert exact_dedup.drop_exact_duplicates(empty).collect() == []
    assert near_join.jaccard_groups(empty).collect() == []


def shingles(t):
    w = (t or "").lower().split()
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows):
    classes = {}
    for d, t in rows:
        if d is not None:
            classes.setdefault(tuple((t or "").lower().split()), []).append(d)
    reps = [(min(v), shingles(" ".join(k))) for k, v in classes.items()]
    links, root = collections.Counter(), {k: k for k in range(len(reps))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(reps)), 2):
        x, y = reps[a][1], reps[b][1]
        if x and y and len(x & y) >= 0.8 * len(x | y):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k in range(len(reps)):
        least[find(k)] = min(least.get(find(k), 1 << 60), reps[k][0])
    return {key: (least[find(k)], reps[k][0], links[k]) for k, key in enumerate(classes)}


def near_rows(seed, groups, size, edits):
    rnd, rows = random.Random(seed), []
    for g, base in enumerate(make_texts(seed, groups, 150)):
        for c in range(size):
            w = base.split()
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = f"edit{rnd.randrange(10**6)}"
            rows.append((g * 1000 + c, " ".join(w)))
    return rows


def check_groups(docs_of, rows, **options):
    want = brute_groups(rows)
    got = near_join.jaccard_groups(docs_of(rows), **options).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(list)
    for d, t in rows:
        by_id[d].append(want.get(tuple((t or "").lower().split())) if d is not None else (None, None, 0))
    for r in got:
        assert (r.class_id, r.copy_id, r.n_links) in by_id[r.doc_id]


def test_join_against_brute_force(docs_of):
    rows = AWKWARD + near_rows(3, 40, 4, 3) + [(90_000 + i, "a b c d e f g h") for i in range(300)]
    check_groups(docs_of, rows)


def test_large_near_group_is_split_into_blocks(docs_of):
    """One group larger than a leaf and a block: deeper levels, leaders, block pairs."""
    rows = near_rows(5, 1, 150, 2) + near_rows(6, 20, 2, 2)[0:0] + [(70_000 + d, t) for d, t in near_rows(7, 20, 2, 2)]
    check_groups(docs_of, rows, leaf=8, depth=4, block=32)


def test_shared_passage_links_nothing(docs_of):
    """A passage in a third of the texts must not join them."""
    passage = " ".join(make_texts(11, 1, 60)[0].split()[:40])
    rows = [(i, t + " " + passage) for i, t in enumerate(make_texts(12, 120, 200))]
    check_groups(docs_of, rows, leaf=8)


def test_drop_near_duplicates(docs_of):
    rows = near_rows(9, 10, 3, 1) + [(None, "no id"), (None, "no id")]
    out = near_join.drop_near_duplicates(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    want = brute_groups(rows)
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted({w[0] for w in want.values()})
    assert sum(r.doc_id is None for r in out.collect()) == 2


def test_drop_near_duplicates_with_repeated_ids(docs_of):
    base = make_texts(31, 4, 90)
    long = [t for t in make_texts(32, 60, 90) if len(t.split()) > 60]
    near = lambda t: t + " tail"                                # noqa: E731
    rows = [(1, long[0]), (7, near(long[0])), (7, base[0] + " only here"),    # 7: one near copy, one clean text
            (8, long[1]), (8, near(long[1])),                                 # near copies under one id
            (9, long[2]), (9, long[2]), (9, long[2].upper()),                 # copies under one id
            (10, long[3]), (10, long[4])]                                     # one id, unlike texts
    got = sorted((r.doc_id, " ".join(r.text.lower().split())) for r in near_join.drop_near_duplicates(docs_of(rows)).collect())
    assert [d for d, _ in got] == [1, 7, 8, 9, 10, 10]
    assert got[0][1] == long[0] and got[1][1] == base[0] + " only here" and got[2][1] in (long[1], near(long[1]))
    assert got[3][1] == long[2] and {got[4][1], got[5][1]} == {long[3], long[4]}


def test_runs_reach_the_target():
    assert near_join.runs_needed(0.8, 0.7, 8, 0.999) > near_join.runs_needed(0.8, 0.7, 2, 0.999)
    assert near_join.runs_needed(0.9, 0.7, 8, 0.999) < near_join.runs_needed(0.8, 0.7, 8, 0.999)
