"""A stored inverted index of the places.

The index lives in a folder of its own and outlives sessions; deliveries of
places are added to it, and every pass and run looks up in the same tables:

* ``postings`` (token, place, signature), bucketed and sorted by token;
* ``tokens`` (token, number of places that hold it), bucketed by token, as
  signed changes that add up to document frequencies;
* ``places`` (place, group, its tokens), bucketed by place;
* ``changed`` (place), the places that a delivery replaced or removed.

Tokens are 64-bit hashes in ``postings`` and ``tokens``; the tokens themselves
are compared when a candidate is verified, so a collision costs a candidate,
never a wrong answer. Rows carry the number of the delivery that wrote them
and count once the manifest names it: an update that died is not seen. A
replaced place keeps its old postings, which no longer lead anywhere, until
``compact`` writes the index anew.

A lookup is relational division. Every query probes the pair of its two rarest
tokens (a place that holds all its tokens holds that pair). Of the postings
only those of probed tokens are read on, as bucketed joins without a shuffle
of the postings; pairs are formed per place from what is left, only from
tokens that are the rarest of some query with tokens that are the second of
some. A pair meets its queries, and in that join the places whose signature
(64 bits set by the tokens) lacks a bit of the query's are dropped. What
remains is verified against the place's tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage, together
from ..sources import bucketed
from ..sources.manifest import Manifest

#: stands for a missing place id or group id (one place, one group)
MISSING = "\u0000missing"

#: table -> (columns, column it is bucketed by)
_TABLES = {
    "places": ("pid STRING, place_id STRING, group_id STRING, pt ARRAY<STRING>, gen INT", "pid"),
    "postings": ("th BIGINT, pid STRING, sig BIGINT, gen INT", "th"),
    "tokens": ("th BIGINT, n BIGINT, gen INT", "th"),
    "changed": ("pid STRING, gen INT", "pid"),
}


def hashes(tokens: str) -> str:
    """SQL: distinct 64-bit hashes of an array of tokens."""
    return f"array_distinct(transform({tokens}, t -> xxhash64(t)))"


def signature(token_hashes: str) -> str:
    """SQL: 64 bits, one set by each token."""
    return f"aggregate({token_hashes}, 0L, (s, h) -> s | shiftleft(1L, CAST(pmod(h, 64) AS INT)))"


class PlaceIndex:
    def __init__(self, spark: SparkSession, root: str, state: dict):
        self.spark, self.root, self.state = spark, root.rstrip("/"), state

    # ------------------------------------------------------------------ life
    @classmethod
    def create(cls, spark: SparkSession, root: str, buckets: int | None = None) -> PlaceIndex:
        """A new, empty index. ``buckets`` (default: the session's shuffle
        partitions) stays with it until it is compacted."""
        n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        index = cls(spark, root, {"buckets": n, "data": "data-1", "gens": [], "replaced": False})
        if Manifest(spark, f"{index.root}/_state").newest() is not None:
            raise ValueError(f"there is an index in {root} already")
        Manifest(spark, f"{index.root}/_state").commit(index.state)
        return index

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> PlaceIndex:
        state = Manifest(spark, f"{root.rstrip('/')}/_state").newest()
        if state is None:
            raise FileNotFoundError(f"no index in {root}")
        return cls(spark, root, state)

    def _place(self, part: str, state: dict | None = None) -> tuple:
        columns, key = _TABLES[part]
        state = state or self.state
        return f"{self.root}/{state['data']}/{part}", T.StructType.fromDDL(columns), [key], state["buckets"]

    def _add(self, rows: DataFrame, part: str, state: dict | None = None) -> None:
        bucketed.add(rows, *self._place(part, state))

    def read(self, part: str, gens: list[int] | None = None) -> DataFrame:
        """Rows of the deliveries that count."""
        return bucketed.rows_of(self.spark, *self._place(part)).where(F.col("gen").isin(self.state["gens"] if gens is None else gens))

    def live(self, rows: DataFrame) -> DataFrame:
        """Rows (pid, gen) whose place no later delivery replaced or removed."""
        if not self.state["replaced"]:
            return rows
        later = self.read("changed").select(F.col("pid").alias("__pid"), F.col("gen").alias("__gen"))
        return rows.join(later, (F.col("pid") == F.col("__pid")) & (F.col("__gen") > F.col("gen")), "left_anti")

    # ------------------------------------------------------------------ updates
    def update(self, places: DataFrame, removed: DataFrame | None = None) -> None:
        """Add analysed places (place_id, group_id, pt), replacing all rows
        of the same place_id, and take out the place_ids of ``removed``."""
        gen = Manifest(self.spark, f"{self.root}/_attempts").commit({})
        pid = F.coalesce(F.col("place_id").cast("string"), F.lit(MISSING)).alias("pid")
        self._add(places.select(pid, "place_id", "group_id", "pt", F.lit(gen).alias("gen")), "places")
        new = self.read("places", [gen])
        change = self._frequencies(new)
        replaced = self.state["replaced"]
        if self.state["gens"]:
            gone = new.select("pid")
            if removed is not None:
                gone = gone.unionAll(removed.select(pid))
            old = self.live(self.read("places")).join(gone.distinct(), "pid", "left_semi")
            self._add(old.select("pid").distinct().withColumn("gen", F.lit(gen)), "changed")
            change = change.unionAll(self._frequencies(old).withColumn("n", -F.col("n")))
            replaced = replaced or not self.read("changed", [gen]).isEmpty()
        together(lambda: self._add(self._postings(new), "postings"), lambda: self._add(change.withColumn("gen", F.lit(gen)), "tokens"))
        self._commit({**self.state, "gens": [*self.state["gens"], gen], "replaced": replaced})

    def compact(self, buckets: int | None = None) -> None:
        """Write the live rows anew, as one delivery. Readers that opened
        the index before go on with the old tables, which stay in place."""
        gen = Manifest(self.spark, f"{self.root}/_attempts").commit({})
        new = PlaceIndex(self.spark, self.root, {"buckets": int(buckets or self.state["buckets"]), "data": f"data-{gen}", "gens": [gen], "replaced": False})
        new._add(self.live(self.read("places")).withColumn("gen", F.lit(gen)), "places")
        rows = new.read("places")
        together(lambda: new._add(self._postings(rows), "postings"), lambda: new._add(self._frequencies(rows).withColumn("gen", F.lit(gen)), "tokens"))
        self._commit(new.state)

    def _commit(self, state: dict) -> None:
        Manifest(self.spark, f"{self.root}/_state").commit(state)
        self.state = state

    @staticmethod
    def _postings(places: DataFrame) -> DataFrame:
        h = places.selectExpr("pid", "gen", f"{hashes('pt')} AS h")
        return h.selectExpr("pid", "gen", f"{signature('h')} AS sig", "explode(h) AS th").distinct()

    @staticmethod
    def _frequencies(places: DataFrame) -> DataFrame:
        each = places.selectExpr("pid", f"explode({hashes('pt')}) AS th").distinct()
        return each.groupBy("th").agg(F.expr("count(1) AS n"))

    # ------------------------------------------------------------------ lookups
    def frequencies(self) -> DataFrame:
        """(th, n): places per token; a bucket's rows add up where they lie."""
        return self.read("tokens").groupBy("th").agg(F.expr("sum(n) AS n")).where("n > 0")

    def probes(self, keys: DataFrame) -> DataFrame:
        """(key, sig, a, b, pair) of every query all of whose tokens occur:
        its rarest token and the next one (itself if there is no other), each
        with its frequency."""
        h = keys.selectExpr("key", f"{hashes("split(key, ' ')")} AS h").selectExpr("key", "h", f"{signature('h')} AS sig")
        known = h.selectExpr("key", "sig", "size(h) AS size", "explode(h) AS th").join(self.frequencies(), "th")
        met = known.groupBy("key", "sig", "size").agg(F.expr("count(1) AS k"), F.expr("array_sort(collect_list(struct(n, th))) AS t")).where("k = size")
        return met.selectExpr("key", "sig", "t[0] AS a", "coalesce(get(t, 1), t[0]) AS b").selectExpr("*", "xxhash64(a.th, b.th) AS pair")

    def pairs(self, probes: DataFrame) -> DataFrame:
        """(pair, pid, gen, sig): of every place the pairs that some query may probe."""
        role = """inline(array(named_struct('th', a.th, 'n', a.n, 'first', a.th <> b.th, 'second', false, 'alone', a.th = b.th),
                               named_struct('th', b.th, 'n', b.n, 'first', false, 'second', a.th <> b.th, 'alone', a.th = b.th)))"""
        asked = probes.selectExpr(role).groupBy("th", "n").agg(*[F.expr(f"max({c}) AS {c}") for c in ("first", "second", "alone")])
        left = self.read("postings").join(asked, "th")
        have = left.groupBy("pid", "gen", "sig").agg(F.expr("array_sort(collect_list(struct(n, th, first, second, alone))) AS t"))
        # a token that some query probes alone, and each first with every second behind it
        alone = "transform(filter(t, x -> x.alone), x -> xxhash64(x.th, x.th))"
        behind = "filter(t, y -> y.second AND (y.n > x.n OR (y.n = x.n AND y.th > x.th)))"
        two = f"flatten(transform(filter(t, x -> x.first), x -> transform({behind}, y -> xxhash64(x.th, y.th))))"
        return have.selectExpr("pid", "gen", "sig", f"explode(concat({alone}, {two})) AS pair")

    def candidates(self, keys: DataFrame) -> DataFrame:
        """(key, pid, gen): places that may hold all tokens of a query."""
        probes = stage(self.probes(keys), "probes")               # read twice: for the tokens asked and the pairs met
        places = self.pairs(probes).withColumnRenamed("sig", "held")
        met = probes.select("pair", "key", "sig").join(places, "pair").where("held & sig = sig")
        return self.live(met.select("key", "pid", "gen"))

    def lookup_keys(self, keys: DataFrame, collapse: bool) -> DataFrame:
        """(key, place_id) of every accepted query, for distinct ``keys``
        (sorted distinct tokens joined by blanks)."""
        rows = self.read("places").select("pid", "gen", "place_id", "group_id", "pt")
        hits = self.candidates(keys).join(rows, ["pid", "gen"]).where("forall(split(key, ' '), t -> array_contains(pt, t))")
        hits = hits.withColumn("g", F.coalesce(F.col("group_id"), F.lit(MISSING)))
        agg = hits.groupBy("key").agg(*[F.expr(e) for e in ("count(1) AS n_hits", "min(g) AS lo", "max(g) AS hi", "min(place_id) AS place_id")])
        return agg.where("lo = hi" if collapse else "n_hits = 1").select("key", "place_id")


class PassingIndex(PlaceIndex):
    """The same lookups over analysed places that are not kept: what a stored
    index holds is derived from the rows whenever it is read. With ``kept``
    several lookups share what the first one derived."""

    def __init__(self, places: DataFrame, kept: bool = False):
        super().__init__(places.sparkSession, "", {"buckets": 0, "data": "", "gens": [0], "replaced": False})
        pid = F.coalesce(F.col("place_id").cast("string"), F.lit(MISSING)).alias("pid")
        self._rows = places.select(pid, "place_id", "group_id", "pt", F.lit(0).alias("gen"))
        self._kept: dict[str, DataFrame] | None = {} if kept else None

    def read(self, part: str, gens: list[int] | None = None) -> DataFrame:
        if part not in ("tokens", "postings"):
            return self._rows
        derive = self._frequencies if part == "tokens" else self._postings
        if self._kept is None:
            return derive(self._rows)
        if part not in self._kept:
            self._kept[part] = stage(derive(self._rows), part)
        return self._kept[part]
