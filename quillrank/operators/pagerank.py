"""PageRank over (src, dst) arcs, in the three variants of the original jobs.

Semantics kept on purpose (they differ from textbook PageRank):

* ranks start at 1.0 for every node with an out-link and are never
  normalised; each round a node's new rank is ``base + damping * sum of
  rank/out_degree`` over its in-links, so a node without in-links leaves the
  rank vector after the first round;
* variants A and B add a share of dangling mass to every ranked node. The
  mass is the sum of this round's damped ranks over the *label* rows whose id
  has no out-link (a dangling node without a label adds nothing). A divides it
  by the number of distinct (target, contribution) pairs of the round, B by
  the number of distinct label rows; C adds nothing.

Plan, per round (checked in ``tests/test_plans.py``):

* ``links`` (src, salt, dst, deg, source and target attributes) is built
  once, in one job, and written bucketed on (src, salt) under the shared
  checkpoint folder.
* The **rank vector has the same buckets**. A round sums contributions by
  (dst, dst_salt), and that one exchange already deals its result the way the
  next round's join needs it: it is written bucketed on (id, salt), and links
  and ranks are joined in place. Nothing but the partial sums moves. Each round
  replaces the one before.
* The first round counts in-links. Where no target has over ``hub_degree`` of
  them, the other rounds move each contribution to its target as it is, in one
  exchange in all variants, and take all sums there: on their way few would
  share a target, and combining them costs more than it spares.
* Variant A's distinct pairs need a target's contributions in one place: they
  move by target, once and uncombined. With hot targets (in the first round,
  when they aren't known, too) a target of more than ``hub_degree`` in-links is
  split by the contribution's hash, which keeps equal contributions together,
  and only the sums of the targets move again.
* There are as many buckets as the links need (``bucket_count``), ``partitions``
  at most: a round writes a block per pair of buckets, which for buckets of
  few links is most of its time.
* A hub (out-degree above ``hub_degree``) has its out-links spread over
  several salt buckets. The ranks have salt 0 only, so links of other salts
  are joined apart, with the hubs' ranks replicated once per salt; only these
  few rows move in addition, and only where the graph has hubs.
* A target's dst_salt is 0, or less by its dangling multiplicity where it has
  one: it is no source then, so its rank row meets no link, and the mass needs
  neither a join nor a column that moves in every round. The targets' salt
  counts move along only in a graph with hubs.
* Contributions to hot targets are summed with a two-phase aggregate (they
  combine map-side). Round outputs are written to the checkpoint folder, which cuts
  the lineage and survives lost executors: every round for A and B, whose
  scalars (mass, normalizer) are observed while that output is written, and
  every fifth round for C. A round's folder is deleted once the next one is
  written, the link table in :meth:`PageRank.close`.
* The join is sorted, so it can spill; where a bucket's share of the ranks is
  below ``spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold`` (the
  setting that lets adaptive execution do the same for shuffled joins; 64 MB
  where it is not set), it is hashed, which spares sorting the links in every round.
* With ``state`` a run is **resumable**: the link table, the last round and a
  manifest stay in that folder, and the same call goes on from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillrank.operators.graph import (
    HUB_DEGREE,
    dangling_nodes,
    distinct_arcs,
    label_count,
    out_degree,
    salt_count,
    salt_of,
)
from quillrank.operators.progress import Manifest, fingerprint
from quillrank.session import delete_path, scratch_path
from quillrank.sinks.bucketed import open_bucketed, write_bucketed

DISTINCT_CONTRIBS = "distinct_contribs"
DISTINCT_LABELS = "distinct_labels"
# Contributions are compared at 12 significant digits when counting distinct
# ones, so the count does not depend on the summation order of the previous
# round, however small they are.
CONTRIB_DIGITS = 12
# Bytes that a rank row takes in a hash table, about.
RANK_BYTES = 128
HASH_CONF = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASH_LIMIT = "64m"
#: How links and ranks are written; a state of another layout is not gone on with.
LAYOUT = 2
# Links of a bucket, about, and the least buckets: a round's files and blocks grow with the square of the
# buckets, so a small graph has fewer than ``partitions``.
BUCKET_LINKS, LEAST_BUCKETS = 500_000, 32


def significant(c: Column, digits: int = CONTRIB_DIGITS) -> Column:
    """A positive number at so many significant digits (others as they are)."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.when(c > 0, c))))
    # as a whole number, which spares the decimal arithmetic of round()
    whole = 10.0 ** (digits - 1)
    return F.coalesce(F.rint(c / scale * whole) / whole * scale, c)


def bucket_count(links: int, partitions: int) -> int:
    """The least divisor of ``partitions`` that gives buckets of ``BUCKET_LINKS`` links at most, or all of them.

    A divisor, so that what is dealt to ``partitions`` tasks has one bucket a task, too."""
    least = max(LEAST_BUCKETS, -(-links // BUCKET_LINKS))
    return next((n for n in range(least, partitions) if partitions % n == 0), partitions)


class PageRank:
    """A prepared graph that runs rounds of one PageRank variant."""

    def __init__(self, arcs: DataFrame, labels: DataFrame | None = None, *,
                 dangling: bool = False, normalizer: str = DISTINCT_LABELS,
                 base: float = 0.15, damping: float = 0.85,  # fixed values of the original jobs
                 hub_degree: int = HUB_DEGREE, partitions: int | None = None):
        if dangling and labels is None:
            raise ValueError("dangling mass needs the label table")
        if normalizer not in (DISTINCT_LABELS, DISTINCT_CONTRIBS):
            raise ValueError(f"unknown normalizer {normalizer!r}")
        self.spark = arcs.sparkSession
        # An arc without one of its ends is none. Said once here, the filter is the
        # same in every branch of the build, which then share their shuffles.
        self.arcs = arcs.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
        self.id_type = dict(self.arcs.dtypes)["src"]
        self.labels = labels.select("id", "name") if labels is not None else None
        self.dangling = dangling
        self.normalizer = normalizer
        self.base = float(base)
        self.damping = float(damping)
        self.hub_degree = int(hub_degree)
        self.partitions = int(partitions or self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = self.partitions  # of links and ranks; fewer once the links are counted and are few
        self._distinct: DataFrame | None = None  # the distinct arcs, where they are written
        self._links: DataFrame | None = None
        self._links_path: str | None = None
        self._hubs = True  # as long as the built links have not been seen to have none
        self._pairs = dangling and normalizer == DISTINCT_CONTRIBS  # whether distinct pairs are counted
        self._nodes: int | None = None
        self._label_rows: int | None = None
        self._spread = True  # as long as a round has not shown that no target has over hub_degree in-links
        self._seek = False  # whether a round counts in-links to find that out

    # ------------------------------------------------------------------ build
    def links(self) -> DataFrame:
        """The loop-invariant link table (built and written on first use):
        (src, salt, dst, dst_salt, deg, nsalt, dst_nsalt), and dst_parts where distinct
        pairs are counted. dst_salt is the salt of the target's rank row: 0, or less by
        the target's dangling multiplicity."""
        if self._links is None:
            self._links = self._build(scratch_path(self.spark, "links"))
        return self._links

    def distinct_arcs(self) -> DataFrame:
        return distinct_arcs(self.arcs) if self._distinct is None else self._distinct

    def nodes(self) -> DataFrame:
        """(id, deg, nsalt, dmult) for every source (dmult 0) and every
        dangling label id (deg null)."""
        deg = out_degree(self.distinct_arcs())
        deg = deg.withColumn("nsalt", salt_count(F.col("deg"), self.hub_degree, self.partitions))
        nodes = deg.select(F.col("src").alias("id"), "deg", "nsalt", F.lit(0).cast("long").alias("dmult"))
        if self.dangling:
            # Sources and dangling ids are disjoint, so a union replaces a join.
            # An id that is none of the arcs' type can't be ranked, so it has no mass.
            ids = self.labels.select(F.col("id").try_cast(self.id_type).alias("id")).where("id IS NOT NULL")
            dm = dangling_nodes(ids, deg).groupBy("id").agg(F.count(F.lit(1)).alias("dmult"))
            nodes = nodes.unionByName(
                dm.select("id", F.lit(None).cast("long").alias("deg"), F.lit(1).alias("nsalt"), "dmult")
            )
        return nodes

    def hot_targets(self) -> DataFrame:
        """(dst, dst_parts) of targets with more than ``hub_degree`` in-links."""
        indeg = self.distinct_arcs().groupBy("dst").agg(F.count(F.lit(1)).alias("indeg"))
        return indeg.where(F.col("indeg") > self.hub_degree).select("dst", salt_count(F.col("indeg"), self.hub_degree).alias("dst_parts"))

    def unwritten_links(self) -> DataFrame:
        """The link rows before they are written, dealt as they are written."""
        # One job: every branch reads the degree, so the distinct-arc and degree
        # shuffles are shared (ReusedExchange) and the arcs are read once.
        # Hubs are arcs / hub_degree at most, and so are hot targets: they are broadcast.
        nodes = self.nodes()
        sources = nodes.where("deg > 0").select(F.col("id").alias("src"), "deg", "nsalt")
        hubs = sources.where(F.col("deg") > self.hub_degree)
        links = self.distinct_arcs()
        if self.dangling:
            marked = nodes.where("dmult > 0").select(F.col("id").alias("dst"), "dmult")
            links = links.join(marked, "dst", "left")
        else:
            links = links.withColumn("dmult", F.lit(0).cast("long"))
        links = links.join(F.broadcast(hubs.select("src", F.col("nsalt").alias("hub"))), "src", "left")
        links = links.join(F.broadcast(hubs.select(F.col("src").alias("dst"), F.col("nsalt").alias("dst_hub"))), "dst", "left")
        if self._pairs:
            links = links.join(F.broadcast(self.hot_targets()), "dst", "left")
        links = links.select(
            "src", salt_of(F.col("dst"), F.coalesce("hub", F.lit(1))).cast("long").alias("salt"), "dst",
            F.negative(F.coalesce("dmult", F.lit(0).cast("long"))).alias("dst_salt"), F.coalesce("dst_hub", F.lit(1)).alias("dst_nsalt"),
            *([F.coalesce("dst_parts", F.lit(1)).alias("dst_parts")] if self._pairs else []),
        ).repartition(self.buckets, "src", "salt")
        attr = sources.select("src", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nsalt") - 1)).alias("salt"), "deg", "nsalt").repartition(self.buckets, "src", "salt")
        return links.join(attr, ["src", "salt"]).select(
            "src", "salt", "dst", "dst_salt", "deg", "nsalt", "dst_nsalt", *(["dst_parts"] if self._pairs else []))

    def _build(self, path: str) -> DataFrame:
        self._links_path = path
        # The distinct arcs are written first: every branch of the links then reads them as
        # they are, and their number says how many buckets there are.
        arcs, count, obs = scratch_path(self.spark, "arcs"), Observation(), Observation()
        rows = distinct_arcs(self.arcs)
        try:
            rows.observe(count, F.count(F.lit(1)).alias("n")).write.parquet(arcs)
            self._distinct = self.spark.read.schema(rows.schema).parquet(arcs)
            self.buckets = bucket_count(count.get["n"], self.partitions)
            links = self.unwritten_links().observe(
                obs, F.coalesce(F.max("nsalt"), F.lit(1)).alias("salts"), F.approx_count_distinct("src").alias("nodes"))
            # The links are dealt: one writer task per bucket, one file per bucket.
            out = write_bucketed(links, path, self.buckets, "src", "salt")
        finally:
            self._distinct = None
            delete_path(self.spark, arcs)
        self._hubs, self._nodes = obs.get["salts"] > 1, obs.get["nodes"]
        return out

    def initial(self) -> DataFrame:
        """(id, salt, rank, nsalt, dmult): 1.0 for every node with an out-link."""
        links = self.links()  # says whether there are hubs
        # without them (src, salt) is the source, and its buckets are read in place
        per_src = links.groupBy("src", *([] if self._hubs else ["salt"])).agg(F.max("nsalt").alias("nsalt"))
        dmult = [F.lit(0).cast("long").alias("dmult")] if self.dangling else []
        salt = F.lit(0).cast("long").alias("salt") if self._hubs else F.col("salt")
        return per_src.select(F.col("src").alias("id"), salt, F.lit(1.0).alias("rank"), "nsalt", *dmult)

    # ------------------------------------------------------------------ round
    def _hashed(self, rows: DataFrame) -> DataFrame:
        """``rows`` marked to be hashed in a join where a bucket of them is small."""
        limit = self.spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(self.spark.conf.get(HASH_CONF, HASH_LIMIT))
        small = self._nodes is not None and self._nodes * RANK_BYTES < limit * self.buckets
        return rows.hint("shuffle_hash") if small else rows

    def _joined(self, ranks: DataFrame) -> DataFrame:
        """Links joined with the rank rows, one row per link: in place for
        salt 0, with replicated hub ranks for the other salts."""
        links = self.links()
        rows = ranks.select(F.col("id").alias("src"), "salt", "rank", F.col("nsalt").alias("src_nsalt"))
        if not self._hubs:
            return links.join(self._hashed(rows.select("src", "salt", "rank")), ["src", "salt"])
        home = links.where("salt = 0").join(self._hashed(rows.select("src", "salt", "rank")), ["src", "salt"])
        spread = rows.where("src_nsalt > 1").select("src", F.explode(F.sequence(F.lit(1).cast("long"), F.col("src_nsalt") - 1)).alias("salt"), "rank")
        return home.unionByName(links.where("salt > 0").join(spread, ["src", "salt"]))

    def contributions(self, ranks: DataFrame) -> DataFrame:
        """(dst, contrib): rank / out-degree along each link."""
        return self._joined(ranks).select("dst", (F.col("rank") / F.col("deg")).alias("contrib"))

    def intermediate(self, ranks: DataFrame) -> DataFrame:
        """(id, salt, rank, nsalt, dmult[, ndist][, indeg]): damped sums of one round.

        Few DataFrame calls, so the driver spends little time analysing each
        round's plan. Rows that move have what their sums need, and no more.
        Where no target has over ``hub_degree`` in-links, each contribution moves
        to its target as it is, and all its sums are taken there."""
        contrib = F.col("rank") / F.col("deg")
        split = self._pairs and self._spread
        parts = F.col("dst_parts") if "dst_parts" in self.links().columns else F.lit(1)
        rows = self._joined(ranks).select(
            F.col("dst").alias("id"), F.col("dst_salt").alias("salt"), contrib.alias("contrib"),
            *([F.col("dst_nsalt").alias("nsalt")] if self._hubs else []), *([parts.alias("dst_parts")] if split else []))
        total = F.sum("contrib")
        nsalt = [F.max("nsalt").alias("nsalt")] if self._hubs else []
        ndist, indeg = [], [F.count(F.lit(1)).alias("indeg")] if self._seek else []
        digits = significant(F.col("contrib"))
        if not self._spread:
            rows = rows.repartition(self.buckets, "id", "salt")
        if split:
            # equal contributions of a split target have one part
            part = F.when(F.col("dst_parts") > 1, F.pmod(F.xxhash64(digits), F.col("dst_parts"))).otherwise(F.lit(0).cast("long"))
            rows = rows.withColumn("part", part).drop("dst_parts").repartition("id", "salt", "part")
        if self._pairs:
            rows = rows.groupBy("id", "salt", *(["part"] if split else []), digits.alias("digits")).agg(total.alias("contrib"), *nsalt, *indeg)
            ndist, indeg = [F.count("digits").alias("ndist")], [F.sum("indeg").alias("indeg")] if self._seek else []
        sums = rows.groupBy("id", "salt").agg((F.lit(self.base) + F.lit(self.damping) * total).alias("rank"), *nsalt, *ndist, *indeg)
        return sums.select(
            "id", "salt", "rank", "nsalt" if self._hubs else F.lit(1).alias("nsalt"),
            *([F.greatest(F.negative("salt"), F.lit(0).cast("long")).alias("dmult")] if self.dangling else []),
            *(["ndist"] if ndist else []), *(["indeg"] if indeg else []))

    def label_rows(self) -> int:
        if self._label_rows is None:
            self._label_rows = int(label_count(self.labels).first()["n"])
        return self._label_rows

    def _scalar_columns(self) -> list[Column]:
        cols = [F.coalesce(F.sum(F.col("rank") * F.col("dmult")), F.lit(0.0)).alias("mass")]
        if self.normalizer == DISTINCT_CONTRIBS:
            cols.append(F.coalesce(F.sum("ndist"), F.lit(0)).cast("double").alias("normalizer"))
        return cols

    def _normalizer(self, row) -> float:
        if self.normalizer == DISTINCT_CONTRIBS:
            return float(row["normalizer"])
        return float(self.label_rows())

    def round_scalars(self, inter: DataFrame) -> DataFrame:
        """One row (mass, normalizer, share) for a round's intermediate ranks."""
        row = inter.agg(*self._scalar_columns())
        if self.normalizer != DISTINCT_CONTRIBS:
            row = row.withColumn("normalizer", F.lit(float(self.label_rows())))
        return row.select(
            "mass", "normalizer", F.coalesce(F.try_divide("mass", "normalizer"), F.lit(0.0)).alias("share")
        )

    @staticmethod
    def share(mass: float, normalizer: float) -> float:
        """The dangling share; a zero normaliser gives no share."""
        return mass / normalizer if normalizer else 0.0

    def _described(self) -> dict:
        """What a manifest must agree with: the input and everything that the ranks depend on."""
        labels = fingerprint(self.labels) if self.dangling else None
        return {"layout": LAYOUT, "arcs": fingerprint(self.arcs), "labels": labels, "dangling": self.dangling, "normalizer": self.normalizer if self.dangling else None,
                "base": self.base, "damping": self.damping, "hub_degree": self.hub_degree, "partitions": self.partitions, "id": self.id_type}

    def _resume(self, manifest: Manifest, said: dict) -> DataFrame:
        """The ranks of the last finished round; the link table is opened, not built."""
        kind = {k: T.StructType.fromJson(said[k + "_schema"]) for k in ("links", "ranks")}
        self._links_path = None  # the state's own, so close() leaves it
        self.buckets = said.get("buckets", self.partitions)
        self._links = open_bucketed(self.spark, said["links"], kind["links"], self.buckets, "src", "salt")
        self._hubs, self._nodes, self._label_rows = said["hubs"], said["nodes"], said["label_rows"]
        self._spread = said.get("spread", True)
        return open_bucketed(self.spark, said["ranks"], kind["ranks"], self.buckets, "id", "salt")

    def run(self, iterations: int = 10, write_every: int | None = None, state: str | None = None) -> DataFrame:
        """(id, rank) after ``iterations`` rounds.

        Round outputs are written under the checkpoint folder, which cuts the
        lineage. The dangling variants write every round: the mass and
        normaliser are observed while the round is written, so no second
        pass is needed. Variant C needs no scalar, so by default it chains
        five rounds per job (a lost executor recomputes at most those). The first
        round is written in any case: it counts each target's in-links, which says
        how the others move; with hot targets every round is. Only the folder that
        the result reads is left.

        ``state`` names a folder (one run's own, on a file system that every
        executor reaches) in which the run keeps its link table, its last
        written round and a manifest. The same call on the same input and
        settings goes on after the last round of the manifest, also in another
        session and for more iterations; other input or settings raise
        ``ValueError``, and so does a number of iterations already passed. The
        input is read once more for its fingerprint. The folder is the caller's to delete.
        """
        if write_every is None:
            write_every = 1 if self.dangling else 5
        if self.dangling and write_every != 1:
            raise ValueError("the dangling variants need every round written")
        manifest, run, share, done, described = None, None, 0.0, 0, {}
        ranks = before = None
        if state:
            manifest, described = Manifest(self.spark, state), self._described()
            said = manifest.last()
            if said:
                if said["input"] != described:
                    raise ValueError(f"{state} holds a run over other input or settings")
                if said["round"] > iterations:
                    raise ValueError(f"{state} has passed round {iterations}: it holds round {said['round']}")
                ranks, share, done, before = self._resume(manifest, said), said["share"], said["round"], said["ranks"]
            elif self._links is None:
                links = manifest.path("links")
                delete_path(self.spark, links)  # of a build that did not end
                self._links = self._build(links)
                self._links_path = None
            run = manifest.path("ranks")
        else:
            run = scratch_path(self.spark, "ranks")
        if ranks is None:
            ranks = self.initial()
        ranks = self._shared(ranks, share)
        if self.dangling and self.normalizer == DISTINCT_LABELS:
            self.label_rows()
        if not iterations:  # the result must not read the link table, which close() deletes
            path = f"{run}/round-0000"
            ranks.write.mode("overwrite").parquet(path)
            ranks = self.spark.read.schema(ranks.schema).parquet(path)
        for i in range(done, iterations):
            self._seek = self._spread and i == 0 and iterations > 1
            inter = self.intermediate(ranks)
            if (i + 1) % write_every and i + 1 < iterations and not self._spread:
                ranks = inter
                continue
            ranks, path, share, scalars = self._written(inter, f"{run}/round-{i + 1:04d}")
            if manifest:
                manifest.add(i + 1, {
                    "input": described, "links": manifest.path("links"), "links_schema": self.links().schema.jsonValue(),
                    "ranks": path, "ranks_schema": ranks.schema.jsonValue(), "share": share, **scalars,
                    "hubs": self._hubs, "nodes": self._nodes, "label_rows": self._label_rows, "spread": self._spread, "buckets": self.buckets})
            elif before:
                delete_path(self.spark, before)
            before = path
            ranks = self._shared(ranks, share)
        return ranks.select("id", "rank")

    @staticmethod
    def _shared(ranks: DataFrame, share: float) -> DataFrame:
        return ranks.withColumn("rank", F.col("rank") + F.lit(share)) if share else ranks

    def _written(self, inter: DataFrame, path: str) -> tuple[DataFrame, str, float, dict]:
        """A round's ranks as written in the links' buckets, their folder, the dangling share and what it comes from."""
        obs = Observation()
        scalars = self._scalar_columns() if self.dangling else []
        most = [F.coalesce(F.max("indeg"), F.lit(0)).alias("indeg")] if "indeg" in inter.columns else []
        delete_path(self.spark, path)  # of a write that did not end
        ranks = write_bucketed(inter.observe(obs, F.count("*").alias("nodes"), *scalars, *most).drop("indeg"), path, self.buckets, "id", "salt")
        got = obs.get
        self._nodes = got["nodes"]
        if most:
            self._spread = got["indeg"] > self.hub_degree
        if not self.dangling:
            return ranks, path, 0.0, {}
        mass, normalizer = float(got["mass"]), self._normalizer(got)
        return ranks, path, self.share(mass, normalizer), {"mass": mass, "normalizer": normalizer}

    def close(self) -> None:
        """Delete the link table, unless it is a state's; what :meth:`run` returned does not read it."""
        if self._links_path:
            delete_path(self.spark, self._links_path)
        self._links = self._links_path = None


def pagerank(arcs: DataFrame, labels: DataFrame | None = None, *, iterations: int = 10,
             dangling: bool = False, normalizer: str = DISTINCT_LABELS, state: str | None = None, **kw) -> DataFrame:
    """(id, rank) after ``iterations`` rounds of the chosen variant; ``state`` as in :meth:`PageRank.run`."""
    pr = PageRank(arcs, labels, dangling=dangling, normalizer=normalizer, **kw)
    try:
        return pr.run(iterations, state=state)
    finally:
        pr.close()  # the result reads the written rounds, not the link table


def rank_labels(ranks: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, name, rank): inner join, so unlabelled nodes drop out and a node
    with several labels appears once per label. A label id that is none of the
    ranks' type matches nothing."""
    lab = labels.select(F.col("id").try_cast(dict(ranks.dtypes)["id"]).alias("id"), "name")
    return ranks.join(lab, "id").select("id", "name", "rank")
