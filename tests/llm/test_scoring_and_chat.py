import collections
import json
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import AWKWARD, make_texts
from pyspark.sql import functions as F

from livepulse.llm import decontaminate, lm_score, quality, tool_calls, toxicity
from livepulse.llm.common import text_blocks, utf8, words
from livepulse.llm.queries import TURN_SCHEMAS

# ---------------------------------------------------------------- decontamination


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks_are_found_with_edits_and_spans(spark, docs_of):
    items = make_texts(21, 12, 60)
    items = [t for t in items if len(t) > 150]
    rnd, rows, want = random.Random(3), [], set()
    for i, t in enumerate(make_texts(22, 60, 120)):
        if i % 4 == 0:
            leak = list(items[i % len(items)])
            for _ in range(i // 4 % 4):                        # 0 to 3 edits
                leak[rnd.randrange(len(leak))] = "#"
            t = t + "\n " + "".join(leak).replace(" ", "  \n", 3).upper() + " " + t
            want.add((i, i % len(items)))
        rows.append((i, t))
    found = decontaminate.find_leaks(docs_of(rows + [(900 + k, r[1]) for k, r in enumerate(AWKWARD)]),
                                     bench_of(spark, list(enumerate(items)))).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    for r in found:
        span = " ".join(rows[r.doc_id][1].lower()[r.first_char:r.end_char].split())
        if r.edits == 0 and r.doc_id // 4 % 4 == 0:
            assert span == " ".join(items[r.item_id].split())


def test_part_of_an_item_is_a_leak(spark, docs_of):
    item = " ".join(make_texts(23, 8, 40))
    rows = [(0, "clean text " * 20), (1, "before " + item[30:230] + " after"), (2, "before " + item[30:90] + " after")]
    assert {r.doc_id for r in decontaminate.find_leaks(docs_of(rows), bench_of(spark, [(1, item)])).collect()} == {1}


def leaks_in(items, texts):
    index = decontaminate.build_index(list(enumerate(items)), 12, 72, 0.05)
    got = decontaminate.find_in_block(index, texts)
    return {(d, index.ids[i]): (f, e, w, n) for d, i, f, e, w, n in zip(*(got[c].tolist() for c in ("doc", "item", "first", "end", "windows", "edits")))}


def test_an_excerpt_of_72_characters_is_found_wherever_it_begins():
    item = " ".join(" ".join(make_texts(23, 8, 40)).split())[:400]
    for edits in (0, 3):
        texts = []
        for at in range(len(item) - 71):
            piece = list(item[at:at + 72])
            for e in range(edits):
                piece[20 + 16 * e] = "#"
            texts.append("%%%%%%%%" + "".join(piece).strip() + "%%%%%%%%")
        whole = [t for t, x in enumerate(texts) if len(x) == 88]
        got = leaks_in([item], texts)
        assert {(t, 0) for t in whole} <= set(got) and all(got[t, 0][3] == edits for t in whole if edits == 0)


def test_windows_equal_brute_force():
    def fewest(window, text):                                # edits of the window at the best place of the text
        row = [0] * (len(text) + 1)
        for i, c in enumerate(window, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    rnd, item = random.Random(5), " ".join(make_texts(26, 6, 30))[:140].strip()
    texts = []
    for n in range(14):
        t = list(item[n * 3:n * 3 + 60 + n * 2])
        for _ in range(n % 5):
            at = rnd.randrange(len(t))
            t[at:at + 1] = rnd.choice([["#"], [], [t[at], "#"]])
        texts.append("%% " + "".join(t).strip() + " %%")
    got = leaks_in([item], texts)
    for n, t in enumerate(texts):
        edits = [fewest(item[lo:lo + 72], t) for lo in range(len(item) - 71)]
        assert (got[n, 0][2:] if (n, 0) in got else None) == ((sum(e <= 3 for e in edits), min(edits)) if min(edits) <= 3 else None)


def test_a_replaced_word_in_every_96_characters_and_short_items():
    item = " ".join(" ".join(make_texts(27, 20, 40)).split())[:600]
    copied = list(item)
    for at in range(40, 600, 90):
        copied[at:at + 7] = "#######"
    assert (0, 0) in leaks_in([item], ["x " + "".join(copied) + " y"])
    items = ["one two three", "Yes it is", "hi", "", None, "42"]
    got = leaks_in(items, ["say one  TWO three now", "yes it\nis so", "this hill", "hi", "4242 42nd", "", "a (42)", "once two three"])
    assert set(got) == {(0, 0), (1, 1), (3, 2), (6, 5)} and got[0, 0][:2] == (4, 18) and got[6, 5][:2] == (3, 5)


def test_blocks_of_the_benchmark_and_filter(spark, docs_of):
    items = [t for t in make_texts(24, 30, 60) if len(t) > 120]
    rows = [(i, "x y z " + t + " u v w") for i, t in enumerate(items)] + [(100 + i, t) for i, t in enumerate(make_texts(25, 40))]
    bench = bench_of(spark, list(enumerate(items)) + [(77, None), (78, ""), (79, "short")])
    one = decontaminate.find_leaks(docs_of(rows), bench).collect()
    many = decontaminate.find_leaks(docs_of(rows), bench, block_chars=1000).collect()
    assert sorted(one) == sorted(many) and {r.doc_id for r in one} == set(range(len(items)))
    df = docs_of(rows + AWKWARD)
    kept = decontaminate.drop_contaminated(df, bench, block_chars=1000)
    assert kept.schema == df.schema and kept.count() == len(rows) + len(AWKWARD) - len(items)


def test_empty_sides(spark, docs_of):
    none = bench_of(spark, []).limit(0)
    assert decontaminate.find_leaks(docs_of(AWKWARD), none).collect() == []
    assert decontaminate.drop_contaminated(docs_of(AWKWARD), none).count() == len(AWKWARD)
    assert decontaminate.find_leaks(docs_of([]).limit(0), bench_of(spark, [(1, "a" * 100)])).collect() == []


# ---------------------------------------------------------------- words and hashes

def test_words_are_those_of_the_pattern():
    texts = ["", " a  b\tc ", "é\nß", "x", "\x0b\x0c", "a b c", "abcdefghij" * 5 + " k"]
    raw, off = utf8(pa.array(texts))
    starts, ends, first = words(raw, off)
    got = [[bytes(raw[s:e]).decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]


def test_blocks_cover_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (5, 0, 100, 3, 3, 50)] + [None])}).slice(1)
    parts = list(text_blocks([batch], most=10))
    assert [t or "" for p, _, _ in parts for t in p.column("text").to_pylist()] == ["", "a" * 100, "aaa", "aaa", "a" * 50, ""]


# ---------------------------------------------------------------- quality, toxicity

def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def labelled(seed, n):
    rnd, rows, labels = random.Random(seed), [], []
    for i, t in enumerate(make_texts(seed, n, 120)):
        bad = rnd.random() < 0.3
        if bad:
            w = t.split()
            t = " ".join(x + rnd.choice(["###", "%%%"]) for x in w) if i % 2 else " ".join([w[0]] * 80)
        toxic = rnd.random() < 0.25
        if toxic:
            w = t.split()
            for word in rnd.sample(["vilething", "grubmouth", "snarlhead", "grubface"], 2):
                w.insert(rnd.randrange(len(w)), word)
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_quality_on_held_out_rows(spark, docs_of):
    rows, labels = labelled(31, 700)
    df = docs_of(rows + [(10_000 + k, t) for k, (_, t) in enumerate(AWKWARD)])
    known = labels_of(spark, labels + [(5, None, None), (999_999, 1, 1), (None, 1, 0)])
    model = quality.fit(df, known, "quality", learn=~quality.held_out(F.col("doc_id"), 5, 0))
    score = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert len(score) == len(rows) + len(AWKWARD) and all(0 <= s <= 1 for s in score.values())
    held = [(score[i], q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((s >= 0.3) == (q == 1) for s, q in held) >= 0.97 * len(held)
    kept = quality.keep_good(df, model)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()} == {d for d, s in score.items() if s >= 0.3}


def test_quality_without_labels(spark, docs_of):
    model = quality.fit(docs_of(AWKWARD), labels_of(spark, []).limit(0), "quality")
    assert {r.score for r in quality.score(docs_of(AWKWARD), model).collect()} == {0.5}
    assert quality.score(docs_of([]).limit(0), model).collect() == []


def test_scores_do_not_depend_on_blocks():
    texts = [t or "" for _, t in AWKWARD] + make_texts(33, 20)
    shape = quality.Shape()
    model = np.random.default_rng(0).normal(size=(1 << shape.bits) + 1).astype(np.float32)
    together = quality.score_block(model, *utf8(pa.array(texts)), shape)
    alone = [quality.score_block(model, *utf8(pa.array([t])), shape)[0] for t in texts]
    assert np.allclose(together, alone)


def test_toxicity_on_held_out_rows(spark, docs_of):
    rows, labels = labelled(32, 900)
    df = docs_of(rows + [(10_000 + k, t) for k, (_, t) in enumerate(AWKWARD)])
    examples = toxicity.fit(df, labels_of(spark, labels), "toxic", learn=~quality.held_out(F.col("doc_id"), 4, 2))
    got = {r.doc_id: r for r in toxicity.score(df, examples).collect()}
    held = [(got[i].score, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((s >= 0.3) == (t == 1) for s, t in held) >= 0.98 * len(held)
    for i, _, t in labels[:200]:
        assert len(got[i].neighbours) == len(got[i].cosines) <= 15
        assert got[i].cosines == sorted(got[i].cosines, reverse=True)


def test_nearest_examples_equal_brute_force():
    rnd = np.random.default_rng(4)
    n, v = 400, 30
    counts = [(np.sort(rnd.choice(v, rnd.integers(0, 8), replace=False)), None) for _ in range(n)]
    counts = [(t, rnd.integers(1, 5, len(t))) for t, _ in counts]
    ex = toxicity.build_examples(np.arange(v, dtype=np.uint64), rnd.uniform(0.5, 3, v), np.arange(n), rnd.integers(0, 2, n), counts, 10)
    dense = np.zeros((n, v))
    for i, (t, c) in enumerate(counts):
        dense[i, t] = (1 + np.log(c)) * ex.idf[t]
    dense /= np.maximum(np.linalg.norm(dense, axis=1), 1e-300)[:, None]
    for i in range(0, n, 7):
        term = np.flatnonzero(dense[i])
        _, cosine = ex.nearest(term, dense[i, term], 10, but=i)
        others = np.delete(dense @ dense[i], i)
        want = np.sort(others[others > 1e-12])[::-1][:10]
        assert np.allclose(cosine, want)


def test_toxicity_without_labels(spark, docs_of):
    examples = toxicity.fit(docs_of(AWKWARD), labels_of(spark, []).limit(0), "toxic")
    assert all(r.score == 0 for r in toxicity.score(docs_of(AWKWARD), examples).collect())


# ---------------------------------------------------------------- language model

def test_base_score_is_exact_and_model_beats_it(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(make_texts(41, 25, 200) * 12)] + [(1000 + k, t) for k, (_, t) in enumerate(AWKWARD)] + \
        [(None, "a null id"), (5, "Of of OF")] + [(2000 + i, "of " * 50) for i in range(100)]
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    toks = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["<end>"]) for d, t in rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = collections.Counter(w for d, ws in toks if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    want = collections.defaultdict(list)
    for d, ws in toks:
        want[d].append((held(d), len(ws), sum(c[w] > 0 for w in ws), n,
                        round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 4)))
    got = lm_score.score_corpus(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) in want[r.doc_id]
        assert math.isfinite(r.score) and r.score <= 0
    own = [r for r in got if r.held_out and r.n_tokens > 20]
    assert own and sum(r.score > r.base_score for r in own) > 0.95 * len(own)
    assert lm_score.score_corpus(docs_of([]).limit(0)).collect() == []


def test_filter_returns_counts():
    keys = np.random.default_rng(2).integers(0, 2**63, 3000).astype(np.uint64)
    counts = np.random.default_rng(3).zipf(1.6, 3000).clip(1, 10**6)
    table = lm_score.set_bits(keys, lm_score.quantise(counts, 1.5), int(10 * lm_score.quantise(counts, 1.5).sum()) // 64 * 64, 5)
    model = lm_score.Model(table, np.array([0, 8 * len(table)]), 1, 1, 1, 1.5, 5, 0.5)
    got = model.counts(keys, np.zeros(3000, np.int64))
    assert (got >= counts / 1.3).all()                       # no n-gram is lost, counts within the quantum
    assert np.mean(np.abs(np.log(got / counts)) < 0.3) > 0.97
    absent = model.counts(keys + np.uint64(1), np.zeros(3000, np.int64))
    assert np.mean(absent > 0) < 0.03


# ---------------------------------------------------------------- tool calls

def test_links_order_and_checks(spark):
    schema = {"type": "object", "required": ["q"], "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1}},
              "additionalProperties": False}
    calls = spark.createDataFrame([
        (1, 4, "c", "search", '{"q": "ü", "n": 2}', ["b"], 0), (1, 2, "b", "search", '{"n": 0, "x": 1}', ["a", "zz"], 0),
        (1, 0, "a", "search", '{"q": 5}', None, 0), (1, 0, "a", "search", '{"q": 5}', None, 0),
        (1, 6, "x", "search", "no json", ["y"], 0), (1, 7, "y", "other", "{}", ["x"], 0), (1, 8, None, "search", None, None, 0),
        (None, 1, "a", "search", '{"q":"z"}', [], 0)],
        "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level int")
    results = spark.createDataFrame([(1, 1, "a", "first"), (1, 3, "a", "second"), (1, 5, "lone", None), (1, 9, None, "r"), (2, 0, "q", "")],
                                    "conv_id long, turn long, call_id string, content string")
    got = tool_calls.link_calls(calls, results, {"search": schema}).collect()
    assert len(got) == 10
    one = {r.call_id: r for r in got if r.conv_id == 1 and r.call_id}
    assert [one[k].level for k in "abcxy"] == [0, 1, 2, None, None]
    order = [r.call_id for r in sorted((r for r in got if r.conv_id == 1), key=lambda r: r.place)]
    assert order.index("a") < order.index("b") < order.index("c") < order.index("x")
    assert sorted(r.place for r in got if r.conv_id == 1) == list(range(8))
    assert one["a"].copies == 2 and one["a"].linked and not one["b"].linked
    line = {k: json.loads(r.line) for k, r in one.items()}
    assert line["a"]["result"] == "first" and line["a"]["problems"] == ["arguments.q: not of type string", "several results"]
    assert line["b"]["problems"] == ["arguments.q: missing", "arguments.x: unknown", "arguments.n: breaks minimum", "missing dependency zz"]
    assert one["c"].valid and one["c"].line == '{"arguments":{"n":2,"q":"ü"},"call_id":"c","depends_on":["b"],"name":"search","problems":[]}'
    assert line["x"]["problems"] == ["arguments: no JSON", "cycle"] and "unknown tool" in line["y"]["problems"]
    assert line["lone"]["problems"] == ["result without a call"]
    assert next(r for r in got if r.conv_id is None).valid


def test_messages_are_read(spark):
    text = json.dumps({"tool_calls": [{"id": "a", "name": "user", "arguments": '{"text":"hi"}'},
                                      {"id": "b", "name": "user", "arguments": "{}", "after": ["a"]}]})
    rows = [(1, 0, "user", "plain"), (1, 1, "assistant", text), (1, 2, "tool", '{"tool_call_id":"a","content":"ok"}'), (1, 3, "assistant", None)]
    calls, results = tool_calls.read_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.call_id: r for r in tool_calls.link_calls(calls, results, TURN_SCHEMAS).collect()}
    assert got["a"].linked and got["a"].valid and not got["b"].valid and got["b"].level == 1


@pytest.mark.parametrize("empty_results", [True, False])
def test_empty_tables_of_calls(spark, empty_results):
    calls = spark.createDataFrame([], "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    rows = [] if empty_results else [(1, 0, "a", "r")]
    results = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, content string")
    assert tool_calls.link_calls(calls, results, {}).count() == len(rows)


def test_no_text_of_a_repeated_identifier_is_lost(spark):
    calls = spark.createDataFrame([(1, 0, "a", "s", "{}", []), (1, 2, "a", "s", '{"q":1}', []), (1, 4, "a", "s", '{"q":1}', []),
                                   (1, 0, "a", None, "{}", []), (1, 0, "b", "s", "{}", ["a"]), (None, 0, "a", "s", None, None),
                                   (None, 0, "a", "s", "", None), (None, 0, "a", "s", "", None)],
                                  "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([(1, 1, "a", "one"), (1, 5, "a", None), (1, 3, "a", "two"), (2, 0, "z", "x"), (2, 1, "z", "y")],
                                    "conv_id long, turn long, call_id string, content string")
    got = [(r, json.loads(r.line)) for r in tool_calls.link_calls(calls, results, {"s": {"type": "object"}}).collect()]
    a = sorted(((r.turn, r.copies, r.linked, r.level, v["name"], v["arguments"]) for r, v in got if r.conv_id == 1 and r.call_id == "a"), key=str)
    assert a == [(0, 1, False, None, None, {}), (0, 4, True, 0, "s", {}), (2, 2, False, None, "s", {"q": 1})]
    assert [(v["result"], v["further_results"]) for r, v in got if r.linked] == [("one", ["two", None])]
    assert [v["further_results"] for r, v in got if r.call_id == "z"] == [["y"]]
    assert all("several calls" in v["problems"] for r, v in got if r.call_id == "a" and r.level is None)
    assert sorted(r.copies for r, v in got if r.conv_id is None) == [1, 3]


def test_a_turn_without_a_role_is_a_call_of_an_unknown_tool(spark):
    from livepulse.llm import queries
    from livepulse.session import scratch_dir
    folder = scratch_dir(spark, "test-null-role")
    spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "r"), (1, 2, None, "kept")],
                          "conv_id long, turn int, role string, text string").write.parquet(folder + "/conversations.parquet")
    got = {r.call_id: json.loads(r.line) for r in queries.op7_tool_calls(spark, folder).collect()}
    assert set(got) == {"c1-0", "c1-2"} and got["c1-2"]["problems"] == ["unknown tool"]
    assert got["c1-2"]["arguments"] == {"text": "kept"} and got["c1-2"]["name"] is None


@pytest.mark.parametrize("arguments,schema,problem", [
    ('{"n": 1e400}', {"properties": {"n": {"type": "integer"}}}, "arguments.n: not of type integer"),
    ('{"n": 1e400}', {"properties": {"n": {"type": "number"}}}, "arguments: a number out of range"),
    ('{"n": NaN}', {"properties": {"n": {"type": "integer"}}}, "arguments: no JSON"),
    ('{"n": -Infinity}', {}, "arguments: no JSON"),
    ('{"t": "cut \\ud83d"}', {}, None),
    ('{"\\udc00": "\\ud83d\\ude00"}', {"additionalProperties": False}, "arguments.\udc00: unknown"),
    ("[" * 100_000 + "]" * 100_000, {}, "arguments: nested too deeply"),
    ('{"n": 5, "s": "x"}', {"properties": {"n": {"minLength": 1, "maxLength": 0}, "s": {"minimum": 3}}}, None),
    ('{"n": null, "s": 1.0}', {"properties": {"n": {"type": ["string", "null"]}, "s": {"type": ["integer", "string"]}}}, None),
    ('{"n": 1.5}', {"properties": {"n": {"type": ["string", "integer"]}}}, "arguments.n: not of type string or integer"),
    ('{"n": 1}', {"properties": {"n": {"type": "unheard-of"}}}, "arguments.n: not of type unheard-of"),
    ("9" * 5000, {}, "arguments: no JSON"),
])
def test_hard_arguments_are_problems_not_crashes(spark, arguments, schema, problem):
    value, problems = tool_calls.read_arguments(arguments, schema)
    if problem is None:
        assert problems == []
    else:
        assert problem in problems or problem == "arguments.n: not of type integer" and problems
    tool_calls.canonical({"value": value, "problems": problems}).encode()      # a line that UTF-8 can hold


def test_hard_arguments_give_lines(spark):
    texts = ['{"n": 1e400}', '{"n": NaN}', '{"t": "cut \\ud83d"}', "[" * 50_000, '{"n": 5}']
    calls = spark.createDataFrame([(1, i, f"c{i}", "f", t, []) for i, t in enumerate(texts)],
                                  "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: r for r in tool_calls.link_calls(calls, results, {"f": {"properties": {"n": {"type": "integer", "minLength": 2}}}}).collect()}
    assert [got[f"c{i}"].valid for i in range(5)] == [False, False, True, False, True]
    assert json.loads(got["c2"].line)["arguments"] == {"t": "cut \ud83d"} and json.loads(got["c0"].line)["arguments"] is None


def rows_found(index, texts):
    got = decontaminate.find_in_block(index, texts)
    return sorted(zip(*(got[c].tolist() for c in ("doc", "item", "windows", "edits", "first", "end"))))


def test_stretches_and_shortened_runs_find_the_same(monkeypatch):
    """Few pairs at once, pieces of items, cut runs: the windows that one pass over everything finds (a
    window with edits may end a character or two elsewhere)."""
    rnd = random.Random(12)
    items = [(i, t) for i, t in enumerate(make_texts(5, 8, 60) + ["-" * 60 + "=" * 40 + "|---" * 10, "-" * 130, "-" * 73 + "x" + "-" * 20, "." * 12])]
    texts = ["".join(rnd.choice([items[rnd.randrange(len(items))][1][rnd.randrange(40):], "-" * rnd.randrange(300), " word %d " % rnd.randrange(99),
                                 "=" * 500]) for _ in range(4)) for _ in range(6)]
    build = lambda: decontaminate.build_index(items, 12, 72, 0.05)
    monkeypatch.setattr(decontaminate, "_shortened", lambda points, origin, keep: (points, origin))
    monkeypatch.setattr(decontaminate, "PAIRS", 1 << 40)
    want = rows_found(build(), texts)
    assert len(want) > 5
    monkeypatch.undo()
    assert rows_found(build(), texts) == want
    for pairs, piece in ((3000, 4096), (1, 75)):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        got = rows_found(build(), texts)
        assert [g[:4] for g in got] == [w[:4] for w in want]
        assert all(abs(x - y) <= 3 for g, w in zip(got, want) for x, y in zip(g[4:], w[4:]))


def test_repeated_characters_stay_small():
    import tracemalloc
    index = decontaminate.build_index([(1, "-" * 500), (2, "ab" * 100)], 12, 72, 0.05)
    for text in ("-" * 200_000, "ab" * 2_000 + "-" * 50_000):
        tracemalloc.start()
        got = decontaminate.find_in_block(index, [text])
        assert len(got["doc"]) and tracemalloc.get_traced_memory()[1] < 500e6
        tracemalloc.stop()
