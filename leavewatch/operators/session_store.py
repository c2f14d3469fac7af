"""A log that arrives in chunks: mergeable session parts, and a user table kept up to date.

Every session measure is a maximum, minimum, sum or count. A chunk is reduced
to its parts per session and browser string, stored by hash bucket of the user,
under the chunk's name. Chunks may come in any order, cut through sessions, and
come again: a name that is there already is left out. The user table is stored
by the same buckets. Bringing it up to date reads the new chunks' users, the
parts of these users' buckets, and rewrites those buckets alone; features are
computed anew for the users that the new chunks touch, all others are copied.
Chunks and buckets are named by one manifest, so readers and other writers see
whole steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leavewatch.functions.numeric import stable_hash
from leavewatch.operators.sessions import browser_rollup, merged_sessions
from leavewatch.operators.users import features_from_sessions
from leavewatch.sources.manifest import Manifest, State
from leavewatch.sources.shared_storage import cut_lineage


class SessionStore:
    """Parts by chunk and the user table, below a path.

    ``buckets`` is a property of the stored table: take about one per 128 MB
    of it, and the same for the table's life.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, signup_pages: bool = False):
        self.spark, self.buckets, self.signup_pages = spark, buckets, signup_pages
        self.manifest = Manifest(spark, path)

    def _bucket(self):
        return (stable_hash(F.col("userId")) % self.buckets).cast("int")

    def add_chunk(self, name: str, log: DataFrame) -> bool:
        """Store the parts of a clean log; False if a chunk of that name is there."""
        if name in self.manifest.read()[1].get("chunks", {}):
            return False
        folder = self.manifest.fresh_folder("chunk")
        parts = browser_rollup(log, self.signup_pages).withColumn("bucket", self._bucket())
        parts.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(self.manifest.full(folder))
        # Nothing is stored of a chunk without rows.
        has_rows = any(n.startswith("bucket=") for n in self.manifest.names(folder))

        def add(state: State) -> State | None:
            chunks = state.get("chunks", {})
            if name in chunks:
                return None
            return state | {"chunks": chunks | {name: folder if has_rows else None}, "buckets": self.buckets}

        return self.manifest.change(add)[1]["chunks"][name] == (folder if has_rows else None)

    def _parts(self, folders: list[str]) -> DataFrame:
        reader = self.spark.read.option("basePath", self.manifest.full("data"))
        return reader.parquet(*[self.manifest.full(f) for f in folders])

    def _sound(self, state: State) -> None:
        if state.get("buckets", self.buckets) != self.buckets:
            raise ValueError(f"the table is stored in {state['buckets']} buckets")

    def refresh(self) -> list[int]:
        """Bring the user table up to date with all chunks; the buckets that were rewritten."""
        version, state = self.manifest.read()
        self._sound(state)
        chunks, seen = state.get("chunks", {}), set(state.get("seen", []))
        news = [f for n, f in chunks.items() if n not in seen and f]
        tables = dict(state.get("tables", {}))
        touched: list[int] = []
        if news:
            users = cut_lineage(self._parts(news).select("userId", "bucket").distinct())
            touched = sorted(r["bucket"] for r in users.select("bucket").distinct().collect())  # a number per bucket
            parts = self._parts([f for f in chunks.values() if f]).where(F.col("bucket").isin(touched))
            own = parts.join(users.select("userId"), "userId", "left_semi")
            fresh = features_from_sessions(merged_sessions(own, signup_pages=self.signup_pages), signup_pages=self.signup_pages)
            kept = [tables[str(b)] for b in touched if str(b) in tables]
            if kept:
                old = self.spark.read.parquet(*[self.manifest.full(f) for f in kept]).select(*fresh.columns)
                fresh = fresh.unionByName(old.join(users.select("userId"), "userId", "left_anti"))
            folder = self.manifest.fresh_folder("users")
            (fresh.withColumn("bucket", self._bucket()).hint("rebalance", F.col("bucket"))
             .write.partitionBy("bucket").parquet(self.manifest.full(folder)))
            tables |= {str(b): f"{folder}/bucket={b}" for b in touched}

        def swap(latest: State) -> State | None:
            if latest.get("seen", []) != state.get("seen", []):
                raise RuntimeError("another writer has brought the table up to date meanwhile")
            return latest | {"tables": tables, "seen": sorted(chunks)}

        if set(chunks) != seen:
            self.manifest.change(swap)
        return touched

    def features(self) -> DataFrame:
        """The user table as last brought up to date."""
        _, state = self.manifest.read()
        folders = list(state.get("tables", {}).values())
        if not folders:
            raise FileNotFoundError("no chunk with rows has been brought in")
        return self.spark.read.parquet(*[self.manifest.full(f) for f in folders])
