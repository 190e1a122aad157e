"""Tables that change together, by whole batches: a reader sees a batch in every table or in none.

A batch writes each table into a folder of its own and then, last, one commit record that names the
folders. Readers read what committed records name and nothing else, so a writer that dies between two
tables, or is repeated, leaves folders nobody reads until ``vacuum`` removes them.

Rows of a key that several batches hold are merged when read. For that every batch is stored bucketed
and sorted by its table's merge keys, in one number of buckets fixed with the first batch: rows of one
key lie in one bucket of each batch, and a merge grouped by the keys needs no shuffle. ``fold`` merges
all committed batches into one generation, bucket by bucket, and its record replaces theirs.

Layout under the root: ``<table>/query_id=Q/batch_id=N/attempt=A``, ``_generations/<n>-A/<table>``, and the
records ``_commits/layout.json``, ``batch-Q-N.json``, ``fold-<n>.json``. Records appear by a rename. One
writer and one fold may run at a time; readers need no lock. Bucketed files are read through tables of
the session's catalog, named after what they hold, which only point at the folders.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from livepulse.session import drop_dir, list_dir, path_exists, read_small, write_small


@dataclass(frozen=True)
class Committed:
    """What a reader sees: the folders of each table, and which batches they stand for."""
    folders: dict[str, tuple[str, ...]] = field(default_factory=dict)
    generation: int = 0
    through: dict[str, int] = field(default_factory=dict)           # of each query, the last batch in the generation
    batches: tuple[tuple[str, int], ...] = ()                       # committed after it

    def holds(self, query_id: str, batch_id: int) -> bool:
        return batch_id <= self.through.get(query_id, -1) or (query_id, batch_id) in self.batches

    def queries(self) -> set[str]:
        return {*self.through, *(q for q, _ in self.batches)}


class CommittedTables:
    """``keys``: the merge keys of each table. ``buckets`` counts only for the first batch of a root
    (None: the session's shuffle partitions); size it for the data expected, not for a batch."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, Sequence[str]], buckets: int | None = None):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), {t: list(k) for t, k in keys.items()}
        self._buckets = buckets

    # --- records -----------------------------------------------------------------------------

    def _record(self, name: str) -> str:
        return f"{self.root}/_commits/{name}.json"

    def layout(self) -> dict | None:
        """{"buckets": n, "schemas": {table: schema}}; None before the first batch."""
        path = self._record("layout")
        return json.loads(read_small(self.spark, path)) if path_exists(self.spark, path) else None

    def begin(self, schemas: dict[str, StructType]) -> dict:
        """Fix the layout with the first batch; later batches must have its columns."""
        have = self.layout()
        if have is None:
            n = self._buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            have = {"buckets": n, "schemas": {t: s.jsonValue() for t, s in schemas.items()}}
            write_small(self.spark, self._record("layout"), json.dumps(have))
        for t, s in schemas.items():
            want = StructType.fromJson(have["schemas"][t])
            if [(f.name, f.dataType) for f in s] != [(f.name, f.dataType) for f in want]:
                raise ValueError(f"{t}: columns {s.simpleString()} are not those of the root, {want.simpleString()}")
        return have

    def state(self) -> Committed:
        names = list_dir(self.spark, f"{self.root}/_commits")
        folds = [n for n in names if n.startswith("fold-")]
        got = Committed()
        if folds:
            r = json.loads(read_small(self.spark, f"{self.root}/_commits/{folds[-1]}"))
            got = Committed({t: (f,) for t, f in r["folders"].items()}, r["generation"], r["through"])
        folders = {t: list(f) for t, f in got.folders.items()}
        batches = []
        for n in names:
            if not n.startswith("batch-"):
                continue
            q, _, b = n.removeprefix("batch-").removesuffix(".json").rpartition("-")
            if int(b) <= got.through.get(q, -1):
                continue
            batches.append((q, int(b)))
            for t, f in json.loads(read_small(self.spark, f"{self.root}/_commits/{n}"))["folders"].items():
                folders.setdefault(t, []).append(f)
        return Committed({t: tuple(f) for t, f in folders.items()}, got.generation, got.through, tuple(sorted(batches)))

    # --- batches -----------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, query_id: str, batch_id: int,
              watch: Callable[[DataFrame], DataFrame] | None = None) -> str:
        """Write one table of a batch; its folder, for ``commit``. ``watch`` may observe the rows as they
        are written: behind the last shuffle, where a repeated task does not count twice."""
        folder = f"{table}/query_id={query_id}/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
        n = self.layout()["buckets"]
        dealt = df.repartition(n, *self.keys[table]).sortWithinPartitions(*self.keys[table])
        self._write_buckets(table, watch(dealt) if watch else dealt, folder, n)
        return folder

    def _write_buckets(self, table: str, df: DataFrame, folder: str, buckets: int) -> None:
        """Bucketed writes go through a table name; the name is dropped, the files stay."""
        name = f"livepulse_write_{uuid.uuid4().hex}"
        keys = self.keys[table]
        try:
            (df.write.format("parquet").bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
             .option("path", f"{self.root}/{folder}").saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def commit(self, query_id: str, batch_id: int, folders: dict[str, str], report: Sequence[dict] = ()) -> None:
        """The last step of a batch: from here on readers see it. ``report`` is kept with the record."""
        write_small(self.spark, self._record(f"batch-{query_id}-{batch_id:020d}"), json.dumps(
            {"query_id": query_id, "batch_id": batch_id, "folders": folders, "report": list(report)}))

    def report(self, query_id: str, batch_id: int) -> list[dict]:
        """What the commit of a batch was given as its report."""
        return json.loads(read_small(self.spark, self._record(f"batch-{query_id}-{batch_id:020d}")))["report"]

    # --- reading -----------------------------------------------------------------------------

    def read(self, table: str, state: Committed | None = None) -> DataFrame:
        """All committed rows of a table, partitioned by its keys (partial rows not yet merged)."""
        layout = self.layout()
        if layout is None:
            raise ValueError(f"{self.root} holds no committed batch")
        schema = StructType.fromJson(layout["schemas"][table])
        folders = (state or self.state()).folders.get(table, ())
        if not folders:
            return self.spark.createDataFrame([], schema)
        name = "livepulse_" + hashlib.sha1("\n".join((self.root, table, *folders)).encode()).hexdigest()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in self.keys[table])
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `_folder` INT) USING parquet PARTITIONED BY (`_folder`) "
                           f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout['buckets']} BUCKETS LOCATION '{self.root}/{table}'")
        # added again if an earlier reader stopped halfway
        for lo in range(0, len(folders), 500):
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
                f"PARTITION (`_folder` = {lo + i}) LOCATION '{self.root}/{f}'" for i, f in enumerate(folders[lo:lo + 500])))
        return self.spark.table(name).drop("_folder")

    # --- generations -------------------------------------------------------------------------

    def fold(self, merges: dict[str, Callable[[DataFrame], DataFrame]]) -> bool:
        """Merge everything committed into one generation. False if there is nothing to fold."""
        state = self.state()
        if not state.batches or len(state.batches) + (state.generation > 0) < 2:
            return False
        generation = state.generation + 1
        n = self.layout()["buckets"]
        place = f"_generations/{generation:010d}-{uuid.uuid4().hex}"
        for t in self.keys:
            rows = self.read(t, state)
            self._write_buckets(t, merges[t](rows).select(*rows.columns), f"{place}/{t}", n)
        through = dict(state.through)
        for q, b in state.batches:
            through[q] = max(b, through.get(q, -1))
        write_small(self.spark, self._record(f"fold-{generation:010d}"), json.dumps(
            {"generation": generation, "through": through, "folders": {t: f"{place}/{t}" for t in self.keys}}))
        return True

    def vacuum(self) -> int:
        """Remove folders and records no reader of the present state needs; no writer, fold or reader of
        an older state may be running. Returns how many folders went."""
        state = self.state()
        needed = {f for folders in state.folders.values() for f in folders}
        gone = 0
        for t in self.keys:
            for q in list_dir(self.spark, f"{self.root}/{t}"):
                for b in list_dir(self.spark, f"{self.root}/{t}/{q}"):
                    for a in list_dir(self.spark, f"{self.root}/{t}/{q}/{b}"):
                        if a.startswith("attempt=") and f"{t}/{q}/{b}/{a}" not in needed:
                            drop_dir(self.spark, f"{self.root}/{t}/{q}/{b}/{a}")
                            gone += 1
                    if not list_dir(self.spark, f"{self.root}/{t}/{q}/{b}"):
                        drop_dir(self.spark, f"{self.root}/{t}/{q}/{b}")
        for g in list_dir(self.spark, f"{self.root}/_generations"):
            if not any(f.startswith(f"_generations/{g}/") for f in needed):
                drop_dir(self.spark, f"{self.root}/_generations/{g}")
                gone += 1
        for n in list_dir(self.spark, f"{self.root}/_commits"):
            q, _, b = n.removeprefix("batch-").removesuffix(".json").rpartition("-")
            old = n.startswith("batch-") and int(b) <= state.through.get(q, -1) or \
                n.startswith("fold-") and n != f"fold-{state.generation:010d}.json"
            if old:
                drop_dir(self.spark, f"{self.root}/_commits/{n}")
        return gone
