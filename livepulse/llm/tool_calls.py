"""Operator 7, chat formatting: tool-call linking.

Calls (conv_id, turn, call_id, name, arguments as JSON text, depends_on) are hash-joined with
results (conv_id, turn, call_id, content) by identifier, put into topological order of their
dependencies, checked against the schema of their tool, and written as canonical JSON
(keys sorted, no spaces, characters as they are), one line per call. A conversation may be
of any length: lines are numbered by one range sort and never gathered.

Order: a call's level is one more than the largest level it depends on. Levels are found in
rounds, each settling the calls whose dependencies are all settled (as many rounds as
the deepest chain of dependencies); calls that no round settles lie on or behind a cycle.

Defined cases: of calls under one identifier the first by turn, then by arguments, is linked
and has all of them counted as ``copies``; each further one that differs from it in name,
arguments or dependencies is a line of its own, unlinked, with a problem (``copies``: how many
are alike). Of several results the first by turn is linked; the line has the others, in this
order, as ``further_results``, and a problem. A result without a call is a line of its
own; a dependency that does not exist is a problem but holds nothing up; a null identifier
links to nothing; a null conv_id is a conversation like others; arguments that are null or
no JSON object are a problem, as are NaN, Infinity, numbers beyond a double and nesting beyond what the
reader holds (such arguments are written as null); empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, number_rows, stored

LINE = "conv_id long, call_id string, level int, turn long, copies long, linked boolean, valid boolean, line string"
_HALF = re.compile("[\ud800-\udfff]")
_KINDS = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}


def _is_number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _of_type(value, kind: str) -> bool:
    if kind == "number":
        return _is_number(value)
    if kind == "integer":
        return _is_number(value) and math.isfinite(value) and value == int(value)
    return kind in _KINDS and isinstance(value, _KINDS[kind])


def violations(value, schema: dict, at: str = "arguments") -> list[str]:
    """Where ``value`` breaks the schema (type or a list of types, enum, required, properties,
    additionalProperties, items; minLength and maxLength of strings, minimum and maximum of numbers)."""
    kind = schema.get("type")
    kinds = [kind] if isinstance(kind, str) else kind
    if kinds is not None and not any(_of_type(value, k) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not an allowed value")
    for limit, applies, wrong in (
            ("minLength", isinstance(value, str), lambda n: len(value) < n), ("maxLength", isinstance(value, str), lambda n: len(value) > n),
            ("minimum", _is_number(value), lambda n: value < n), ("maximum", _is_number(value), lambda n: value > n)):
        if applies and limit in schema and wrong(schema[limit]):
            out.append(f"{at}: breaks {limit}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(set(value) - set(known))]
        for k in sorted(set(value) & set(known)):
            out += violations(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return out


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, characters as they are; half of a cut character pair, which
    UTF-8 cannot hold, stays an escape. A number that is not finite is a ValueError."""
    text = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
    return _HALF.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def _refuse(constant: str):
    raise ValueError(f"{constant} is no JSON")


def read_arguments(text: str | None, schema: dict | None) -> tuple[object, list[str]]:
    """(value, problems) of a call's arguments; the value is None where there is none to write."""
    try:
        value = json.loads(text or "", parse_constant=_refuse)
    except ValueError:
        return None, ["arguments: no JSON"]
    except RecursionError:
        return None, ["arguments: nested too deeply"]
    try:
        problems = ["unknown tool"] if schema is None else violations(value, schema)
        canonical(value)
    except ValueError:
        return None, ["arguments: a number out of range"]
    except RecursionError:
        return None, ["arguments: nested too deeply"]
    return value, problems


def read_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of messages (conv_id, turn, role, text): a text that is a JSON object with
    ``tool_calls`` [{id, name, arguments, after}] holds calls, one of role ``tool`` with
    ``tool_call_id`` and ``content`` is a result. Other messages hold neither."""
    call = F.from_json("text", "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>")
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    calls = rows.filter(F.col("role") == "assistant").select("conv_id", "turn", F.explode(call["tool_calls"]).alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"), F.coalesce("c.after", F.array().cast("array<string>")).alias("depends_on"))
    got = F.from_json("text", "tool_call_id string, content string")
    results = rows.filter(F.col("role") == "tool").select("conv_id", "turn", got["tool_call_id"].alias("call_id"), got["content"].alias("content"))
    return calls, results


def _levels(calls: DataFrame) -> DataFrame:
    """(_conv, _id, level, missing): level null on or behind a cycle; missing: dependencies that do not exist."""
    ids = calls.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_id"))
    wants = calls.select("conv_id", "call_id", F.explode(F.array_distinct("depends_on")).alias("dep"))
    found = stored(wants.join(ids, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("dep") == F.col("_id")), "left")
                   .select("conv_id", "call_id", "dep", F.col("_id").isNotNull().alias("exists")), "call-wants")
    edges = found.filter("exists").select("conv_id", "call_id", "dep")
    counts = found.groupBy("conv_id", "call_id").agg(
        F.count_if("exists").alias("n"), F.sort_array(F.collect_set(F.when(~F.col("exists"), F.col("dep")))).alias("missing"))
    state = ids.join(counts, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_id") == F.col("call_id")), "left").select(
        "_conv", "_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))
    done = stored(state.withColumn("level", F.when(F.col("n") == 0, 0)), "call-levels")
    while True:
        settled = done.filter("level is not null").select(F.col("_conv").alias("_c"), F.col("_id").alias("_i"), F.col("level").alias("_l"))
        ready = edges.join(settled, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("dep") == F.col("_i"))) \
            .groupBy("conv_id", "call_id").agg(F.count("*").alias("m"), (F.max("_l") + 1).alias("next"))
        done2 = stored(done.join(ready, F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_id") == F.col("call_id")), "left").select(
            "_conv", "_id", "n", "missing", F.coalesce("level", F.when(F.col("n") == F.col("m"), F.col("next"))).cast("int").alias("level")), "call-levels")
        if done2.filter("level is null").count() == done.filter("level is null").count():
            return done2.drop("n")
        done = done2


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call or lone result: conv_id, place (0, 1, ... in the conversation), call_id,
    level, turn, copies, linked, valid, line (canonical JSON)."""
    calls = calls.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("call_id").cast("string").alias("call_id"), F.col("name").cast("string").alias("name"),
                         F.col("arguments").cast("string").alias("arguments"), F.col("depends_on").cast("array<string>").alias("depends_on"))
    results = results.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.col("call_id").cast("string").alias("call_id"), F.col("content").cast("string").alias("content"))
    first_turn = F.struct(F.col("turn").isNull().alias("n"), F.col("turn").alias("t"), F.coalesce("arguments", F.lit("")).alias("a"))
    order = F.struct(F.col("o").alias("o"), F.col("name").isNull().alias("p"), F.col("name").alias("name"),
                     F.col("depends_on").isNull().alias("d"), F.col("depends_on").alias("depends_on"),
                     F.col("arguments").isNull().alias("a"))
    # equal calls of one identifier are one row from here on
    alike = stored(calls.filter("call_id is not null").withColumn("o", first_turn).groupBy(
        "conv_id", "call_id", "name", "arguments", "depends_on").agg(
        F.min("o").alias("o"), F.min("turn").alias("turn"), F.count("*").alias("copies")).withColumn("o", order), "alike-calls")
    first = alike.groupBy("conv_id", "call_id").agg(
        F.min_by(F.struct("turn", "name", "arguments", "depends_on"), "o").alias("c"), F.sum("copies").alias("copies"),
        F.min("o").alias("o"), F.count("*").alias("kinds"))
    one = stored(first.select("conv_id", "call_id", "c.*", "copies", "o", "kinds"), "calls")
    heads = one.filter("kinds > 1").select(F.col("conv_id").alias("_hc"), F.col("call_id").alias("_hi"), F.col("o").alias("_ho"))
    further = alike.join(heads, F.col("conv_id").eqNullSafe(F.col("_hc")) & (F.col("call_id") == F.col("_hi"))
                         & (F.col("o") != F.col("_ho"))).select("conv_id", "call_id", "turn", "name", "arguments", "depends_on",
                                                                "copies", F.lit(True).alias("further"))
    one = one.drop("o", "kinds")
    answer = results.filter("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min_by(F.struct("turn", "content"), F.struct(F.col("turn").isNull(), "turn", F.coalesce("content", F.lit("")))).alias("r"),
        F.count("*").alias("answers"),
        F.sort_array(F.collect_list(F.struct(F.col("turn").isNull().alias("n"), F.col("turn").alias("t"),
                                             F.coalesce("content", F.lit("")).alias("c"), F.col("content").alias("text")))).alias("all")
    ).select(F.col("conv_id").alias("_rc"), F.col("call_id").alias("_ri"), "r", "answers",
             F.when(F.col("answers") > 1, F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(1)))["text"]).alias("others"))
    levels = _levels(one)
    linked = one.join(levels, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("call_id") == F.col("_id"))) \
        .join(answer, F.col("conv_id").eqNullSafe(F.col("_rc")) & (F.col("call_id") == F.col("_ri")), "full").select(
        F.coalesce("conv_id", "_rc").alias("conv_id"), F.coalesce("call_id", "_ri").alias("call_id"),
        F.coalesce("turn", "r.turn").alias("turn"), F.col("_id").isNotNull().alias("is_call"), "name", "arguments",
        "depends_on", "copies", "level", "missing", F.col("r.content").alias("content"), "answers", "others",
        F.lit(False).alias("further"))
    kind = {f.name: f.dataType for f in linked.schema}

    def as_line(df: DataFrame, is_call: bool) -> DataFrame:   # rows without an identifier link to nothing
        has = set(df.columns)
        return df.select(*[F.lit(is_call).alias(c) if c == "is_call" else
                           F.col(c) if c in has else
                           F.lit(1 if (c == "copies") == is_call and c in ("copies", "answers") else None).cast(kind[c]).alias(c)
                           for c in linked.columns])

    every = linked.unionByName(as_line(calls.filter("call_id is null"), True)).unionByName(as_line(further, True)) \
        .unionByName(as_line(results.filter("call_id is null"), False))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {f.split()[0]: [] for f in LINE.split(", ")}
            for r in b.to_pylist():
                problems, value = [], None
                if r["call_id"] is None:
                    problems.append("no identifier")
                if r["is_call"]:
                    value, found = read_arguments(r["arguments"], schemas.get(r["name"]))
                    problems += found
                    problems += [f"missing dependency {d}" for d in r["missing"] or []]
                    if r["further"]:
                        problems.append("several calls")
                    elif r["level"] is None and r["call_id"] is not None:
                        problems.append("cycle")
                    if (r["answers"] or 0) > 1:
                        problems.append("several results")
                else:
                    problems.append("result without a call")
                got = bool(r["is_call"] and r["answers"])
                line = {"call_id": r["call_id"], "problems": problems}
                if r["is_call"]:
                    line |= {"name": r["name"], "arguments": value, "depends_on": sorted(r["depends_on"] or [])}
                if got or not r["is_call"]:
                    line["result"] = r["content"]
                if r["others"]:
                    line["further_results"] = r["others"]
                for k, v in (("conv_id", r["conv_id"]), ("call_id", r["call_id"]), ("level", r["level"]), ("turn", r["turn"]),
                             ("copies", r["copies"] or 0), ("linked", got), ("valid", not problems), ("line", canonical(line))):
                    out[k].append(v)
            yield batch_of(LINE, **out)

    lines = every.mapInArrow(write, LINE).withColumn("_last", F.col("level").isNull())
    return number_rows(lines, ["conv_id"], ["_last", "level", "turn", "call_id", "line"], "place").drop("_last")
