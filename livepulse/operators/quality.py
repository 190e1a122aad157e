"""Data-quality checks as Spark aggregates, and the gate that acts on them.

Each check yields one result row (table, check, metric, column, value, passed).
All column metrics of a table (row count, missing, min, max, invalid values,
failed-row conditions) and its referential checks are computed in ONE aggregate
pass over the table; each duplicate check needs a shuffle of its own. Only the result
rows (one per check) ever reach the driver, in ``gate``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

RESULT_COLUMNS = ["table", "check", "metric", "column", "value", "passed"]


@dataclass(frozen=True)
class Check:
    metric: str                     # row_count | missing_count | min | max | invalid_count | failed_rows
    column: str | None = None
    op: str = "="                   # comparison of the metric with ``threshold``
    threshold: float = 0
    name: str | None = None
    valid_values: tuple = ()
    condition: str | None = None    # SQL fail condition for failed_rows

    def label(self) -> str:
        if self.name:
            return self.name
        inner = self.column or ""
        return f"{self.metric}({inner}) {self.op} {self.threshold:g}"


@dataclass(frozen=True)
class Duplicates:
    """``by_hash``: count 64-bit hashes of the key first and group only rows whose hash repeats by the key itself. Two
    reads of the table for a shuffle of eight bytes a row; worth it for wide keys that seldom repeat."""
    columns: tuple
    name: str | None = None
    by_hash: bool = False

    def label(self) -> str:
        return self.name or f"duplicate_count({', '.join(self.columns)}) = 0"


@dataclass(frozen=True)
class Orphans:
    column: str
    dimension: DataFrame = field(compare=False)
    dim_column: str | None = None
    name: str | None = None

    def label(self) -> str:
        return self.name or f"orphans({self.column})"


def row_count_positive(name=None):
    return Check("row_count", None, ">", 0, name)


def missing(col, name=None):
    return Check("missing_count", col, "=", 0, name)


def min_at_least(col, v, name=None):
    return Check("min", col, ">=", v, name)


def max_at_most(col, v, name=None):
    return Check("max", col, "<=", v, name)


def invalid(col, values, name=None):
    return Check("invalid_count", col, "=", 0, name, tuple(values))


def failed_rows(condition, name):
    return Check("failed_rows", None, "=", 0, name, (), condition)


# for columns, and for plain numbers of ``watch_checks``
_OPS: dict[str, Callable] = {
    "=": lambda v, t: v == t, ">": lambda v, t: v > t, ">=": lambda v, t: v >= t,
    "<=": lambda v, t: v <= t, "<": lambda v, t: v < t,
}


def _metric(c: Check) -> Column:
    if c.metric == "row_count":
        return F.count(F.lit(1))
    if c.metric == "missing_count":
        return F.count_if(F.col(c.column).isNull())
    if c.metric == "min":
        return F.min(c.column)
    if c.metric == "max":
        return F.max(c.column)
    if c.metric == "invalid_count":
        col = F.col(c.column)
        return F.count_if(col.isNotNull() & ~col.isin(list(c.valid_values)))
    if c.metric == "failed_rows":
        return F.count_if(F.coalesce(F.expr(c.condition), F.lit(False)))
    raise ValueError(c.metric)


def _result(table: str, label: str, metric: str, column: str | None, value: Column, passed: Column) -> list[Column]:
    return [F.lit(table).alias("table"), F.lit(label).alias("check"), F.lit(metric).alias("metric"),
            F.lit(column).cast("string").alias("column"), value.cast("double").alias("value"),
            passed.alias("passed")]


def run_checks(table: str, df: DataFrame, checks: Sequence[Check | Duplicates | Orphans]) -> DataFrame:
    """Evaluate the checks of one table; returns one row per check.

    Column metrics and referential checks share one pass over the table: the
    table is left-joined to the distinct keys of each dimension (row count
    unchanged, since the keys are distinct), and an orphan is a row whose key
    found no match, a null key included. Duplicate checks each group the table
    once more.
    """
    simple = [c for c in checks if isinstance(c, Check)]
    orphans = [c for c in checks if isinstance(c, Orphans)]
    parts: list[DataFrame] = []
    if simple or orphans:
        base = df
        for i, c in enumerate(orphans):
            k = f"_k{i}"
            keys = c.dimension.select(F.col(c.dim_column or c.column).alias(k)).where(F.col(k).isNotNull()).distinct()
            base = base.join(keys, F.col(c.column) == F.col(k), "left")
        row = base.agg(*[_metric(c).alias(f"m{i}") for i, c in enumerate(simple)],
                       *[F.count_if(F.col(f"_k{i}").isNull()).alias(f"o{i}") for i in range(len(orphans))])
        structs = []
        for i, c in enumerate(simple):
            v = F.col(f"m{i}").cast("double")
            # an empty table has no min/max: a missing metric fails its check
            ok = F.coalesce(_OPS[c.op](v, F.lit(float(c.threshold))), F.lit(False))
            structs.append(F.struct(*_result(table, c.label(), c.metric, c.column, v, ok)))
        for i, c in enumerate(orphans):
            v = F.col(f"o{i}")
            structs.append(F.struct(*_result(table, c.label(), "orphans", c.column, v, v == 0)))
        parts.append(row.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for c in checks:
        if isinstance(c, Duplicates):
            cols = list(c.columns)
            keys = df.select(*cols)
            if c.by_hash:
                hashed = keys.withColumn("_hash", F.xxhash64(*cols))
                repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                keys = hashed.join(repeated, "_hash", "left_semi")
            n = (keys.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                 .agg(F.count(F.lit(1)).alias("v")))
            parts.append(n.select(*_result(table, c.label(), "duplicate_count", ", ".join(cols),
                                           F.col("v"), F.col("v") == 0)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def watch_checks(table: str, checks: Sequence[Check | Duplicates | Orphans]) -> tuple[
        Callable[[DataFrame], DataFrame], Callable[[], list[dict]]]:
    """The column metrics among ``checks`` (I1, I2, I4 to I6) taken while a frame is written, without a scan
    of their own: (watch, results). Write ``watch(df)``; ``results()`` then has the rows ``run_checks`` would
    give, as dictionaries. An empty frame has no minimum or maximum to break, so those pass here.

    Watch a frame behind its last shuffle: the tasks of a job's last stage count once each, however
    often a lost executor makes earlier stages run again."""
    simple = [c for c in checks if isinstance(c, Check)]
    seen = Observation(f"{table}-{uuid.uuid4().hex}")

    def watch(df: DataFrame) -> DataFrame:
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[_metric(c).alias(f"m{i}") for i, c in enumerate(simple)])

    def results() -> list[dict]:
        got = seen.get
        out = []
        for i, c in enumerate(simple):
            value = None if got[f"m{i}"] is None else float(got[f"m{i}"])
            nothing = not got["rows"] and c.metric in ("min", "max")
            out.append({"table": table, "check": c.label(), "metric": c.metric, "column": c.column, "value": value,
                        "passed": nothing or value is not None and bool(_OPS[c.op](value, float(c.threshold)))})
        return out

    return watch, results


class QualityError(Exception):
    pass


def raise_failed(failed: Sequence[dict]) -> None:
    """Raise for failed checks (rows as ``run_checks`` gives them), if there are any."""
    if failed:
        lines = "; ".join(f"{r['table']}: {r['check']} (value {r['value']})" for r in failed)
        raise QualityError(f"data quality checks failed: {lines}")


def gate(results: DataFrame, halt: bool = True) -> list[dict]:
    """Collect the failed checks (at most one row per check); raise when ``halt``."""
    failed = [r.asDict() for r in results.where(~F.col("passed")).collect()]
    if halt:
        raise_failed(failed)
    return failed


def run_gated(validate_before: Callable[[], DataFrame], load: Callable[[], object],
              validate_after: Callable[[], DataFrame]) -> list[dict]:
    """Validate inputs (halts on failure) → load → validate outputs (report only)."""
    gate(validate_before(), halt=True)
    load()
    return gate(validate_after(), halt=False)


# --- the rule sets of the pipeline -------------------------------------------------

def _between(column: str, low: float, high: float) -> list[Check]:
    return [min_at_least(column, low, f"{column} not below {low:g}"),
            max_at_most(column, high, f"{column} not above {high:g}")]


def silver_stream_checks() -> list[Check]:
    return [
        row_count_positive("snapshots exist"),
        missing("stream_id", "every snapshot names its stream"),
        missing("user_name"), missing("ingestion_ts"), missing("started_at"),
        min_at_least("viewer_count", 0, "no viewer count under zero"),
        min_at_least("stream_time_seconds", 0, "no stream polled before it started"),
        *_between("started_hour", 0, 23),
    ]


def tag_checks() -> list[Check]:
    return [missing("stream_id"), missing("tag_name")]


def game_checks() -> list[Check]:
    return [missing("game_id"), missing("game_name")]


def transition_checks() -> list[Check]:
    return [
        missing("stream_id"), missing("event_ts"),
        invalid("event_type", ["GAME_CHANGE", "TITLE_CHANGE"], "only the two known kinds of change"),
        missing("new_value", "a change says what it changed to"),
    ]


def dim_game_checks() -> list:
    return [missing("game_id"), missing("game_name"), Duplicates(("game_id",)), *_between("total_rating", 0, 100)]


def dim_date_checks() -> list:
    return [missing("date_id"), Duplicates(("date_id",)), *_between("date_month", 1, 12), *_between("date_day", 1, 31)]


def dim_streamer_checks() -> list:
    return [missing("streamer_id"), Duplicates(("streamer_id",)), missing("user_name")]


def dim_language_checks() -> list:
    return [missing("language_id"), Duplicates(("language_id",)), missing("language")]


DIMENSION_CHECKS = {"dim_game": dim_game_checks, "dim_date": dim_date_checks,
                    "dim_streamer": dim_streamer_checks, "dim_language": dim_language_checks}


def fact_checks(dims: dict[str, DataFrame] | None = None) -> list:
    keys = ("game_id", "date_id", "streamer_id", "language_id", "time_hour")
    checks: list = [missing(k) for k in keys] + [
        Duplicates(keys),
        *_between("time_hour", 0, 23),
        min_at_least("count_observations", 1, "every fact row was observed"),
        min_at_least("max_viewers", 0, "no peak under zero"),
        min_at_least("sum_viewers", 0, "no viewer sum under zero"),
        failed_rows("sum_viewers < max_viewers", "the sum holds the peak"),
    ]
    for dim_name, col in (("dim_game", "game_id"), ("dim_date", "date_id"),
                          ("dim_streamer", "streamer_id"), ("dim_language", "language_id")):
        if dims and dim_name in dims:
            checks.append(Orphans(col, dims[dim_name], name=f"{col} known to {dim_name}"))
    return checks


def run_gold_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """All gold rules: each dimension's own and the fact's, with its dimensions."""
    dims = {k: v for k, v in tables.items() if k.startswith("dim_")}
    out = run_checks("fact_stream_hourly_final", tables["fact_stream_hourly"], fact_checks(dims))
    for name, df in dims.items():
        out = out.unionByName(run_checks(f"{name}_final", df, DIMENSION_CHECKS[name]()))
    return out
