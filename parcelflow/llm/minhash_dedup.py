"""MinHash near-duplicates with sequential Bayesian verification.

1. Every whole text becomes its set of distinct word shingles and a MinHash
   signature.  Texts with equal sets collapse into a class (grouped minimum),
   so a group of exact copies costs one row from here on.
2. Signatures are cut into bands; so many that a pair at the threshold shares
   no band with probability at most ``miss`` / 2.  Small buckets give all their
   pairs; of the least members of its large buckets, a class first meets the
   ``FIRST_LINKS`` smallest.
3. Candidates are compared a batch of hashes at a time.  With a uniform prior,
   P(similarity >= threshold | matches so far) is a Beta tail; a pair goes as
   soon as that falls below a bound, so low that a pair at the threshold goes in
   any batch with probability at most ``miss`` / 2.
4. Survivors are verified on their full shingle sets.
5. Members of a large bucket that are still in different components are then
   all compared, tile by tile: blocks of at most ``TILE`` members and about
   ``TILE_BYTES`` of shingle sets, so no task holds a bucket.  A pair is compared
   in the first band it shares, by signature as in 3, and a survivor is verified
   in the tile on the full sets, likeliest first.  What is verified is united at
   once, pairs inside one component are passed over, and a tile gives at most
   one link per member: its output is linear, however alike the members are.

Blank-separated words, A-Z lower-cased.  A text of fewer words than a shingle
is one shingle; without words (or null) it has none and links with nothing.
Rows with the same doc_id are one node; a row with a null doc_id stands alone
(component_id null, kept).  Of equally likely partners the one of lower place
comes first, which changes no component.  An empty table gives no rows.  Only
doc_id and text are read; ``deduplicate`` gives back all columns as they were.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize, only_ids
from parcelflow.llm.graph import components
from parcelflow.llm.textbatch import BLANK_WORDS, Words, hash_runs, mix, slices, windows

SMALL_BUCKET = 12
TILE = 2048
TILE_BYTES = 16 << 20
CENTRE_ROWS = 1000
FIRST_LINKS = 3
BATCH = 16


@dataclass(frozen=True)
class Plan:
    """Shingle length, threshold in percent and the miss probability of a pair
    at the threshold, by bands and all batches together."""
    words: int = 5
    percent: int = 85
    rows: int = 5
    miss: float = 1e-5

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss / 2) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def _least_matches(self, bound: float) -> list[tuple[int, int]]:
        """The posterior P(s >= t | m of h) = sum_{j<=m} C(h+1, j) t^j (1-t)^(h+1-j)."""
        t, out = self.percent / 100, []
        for h in [*range(BATCH, self.hashes, BATCH), self.hashes]:
            p, m = (1 - t) ** (h + 1), 0
            while p < bound:
                m += 1
                p += math.comb(h + 1, m) * t ** m * (1 - t) ** (h + 1 - m)
            out.append((h, m))
        return out

    @cache
    def least_matches(self) -> list[tuple[int, int]]:
        """After so many hashes, the fewest matches that keep a pair."""
        bound = self.miss
        while pruned(least := self._least_matches(bound), self.percent / 100) > self.miss / 2:
            bound /= 2
        return least


def pruned(least: list[tuple[int, int]], s: float) -> float:
    """The probability that a pair of similarity s has too few matches after
    some batch."""
    alive, done, gone = np.ones(1), 0, 0.0
    for h, m in least:
        step = np.array([math.comb(h - done, j) * s ** j * (1 - s) ** (h - done - j) for j in range(h - done + 1)])
        alive, done = np.convolve(alive, step), h
        gone += alive[:m].sum()
        alive[:m] = 0
    return float(gone)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per document its sorted distinct shingle hashes."""
    w = Words(data, offsets, BLANK_WORDS)
    got, at = windows(w, k)
    cut = np.searchsorted(at, w.first)
    out = []
    for d, n in enumerate(w.count.tolist()):
        if n >= k:
            out.append(np.unique(got[cut[d]:cut[d + 1]]))
        else:
            out.append(hash_runs(w.hash, w.first[d:d + 1], n) if n else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """Least 32-bit value of each hash function over each set; empty sets get
    the largest value."""
    out = np.full((len(sets), hashes), 0xFFFFFFFF, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    x = np.concatenate([sets[i] for i in full])
    starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
    seed = mix(np.arange(1, 2 * hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    y, high = np.empty_like(x), np.empty(len(x), np.uint32)
    for h in range(hashes):
        np.multiply(x, seed[2 * h], out=y)
        y += seed[2 * h + 1]
        high[:] = y >> np.uint64(32)
        out[full, h] = np.minimum.reduceat(high, starts)
    return out


def _long(name: str):
    return F.col(name).cast("long").alias(name)


def describe(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                sets = shingle_sets(data, offsets, plan.words)
                prints = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8") for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0]),
                     pa.array(prints[:, 1]), pa.array([r.tobytes() for r in signatures(sets, plan.hashes)])],
                    ["doc_id", "n_shingles", "p", "q", "sig"])

    return (docs.select(_long("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_shingles long, p long, q long, sig binary"))


def _bucket(part: bytes, band: int) -> int:
    return xxhash.xxh3_64_intdigest(part, band)


def _buckets(classes: DataFrame, plan: Plan) -> DataFrame:
    width = 4 * plan.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep = batch.column(0).to_numpy()
            sig = batch.column(1).to_pylist()
            hashes = [_bucket(s[b * width:(b + 1) * width], b) for b in range(plan.bands) for s in sig]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(np.tile(rep, plan.bands)),
                 pa.array(np.repeat(np.arange(plan.bands, dtype=np.int32), len(rep)))], ["bucket", "rep", "band"])

    return classes.select("rep", "sig").mapInArrow(run, "bucket long, rep long, band int")


def _survive(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    """Which rows of two signature matrices pass every batch's bound."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for h, least in plan.least_matches():
        matches = matches + (a[alive, done:h] == b[alive, done:h]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], h
        if not len(alive):
            break
    return alive


def prune(pairs: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) whose signatures leave the threshold possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, plan.hashes)
                          for i in (2, 3))
                yield batch.select([0, 1]).take(pa.array(_survive(sa, sb, plan)))

    sig = classes.select("rep", "sig")
    both = (pairs.join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def alike(x: np.ndarray, y: np.ndarray, plan: Plan) -> bool:
    """Whether two full sets reach the threshold."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small) or 100 * len(small) < plan.percent * len(large):
        return False
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= plan.percent * (len(small) + len(large) - both)


def verify(pairs: DataFrame, docs: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their full
    sets.  Texts meet at a; a text with many partners is sent to several
    groups of about ``CENTRE_ROWS`` of them.  One set is held at a time."""
    salts = (F.floor(F.count("*") / CENTRE_ROWS) + 1).cast("int")
    centres = pairs.groupBy("a").agg(salts.alias("salts"))
    member = F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")
    needed = (pairs.join(centres, "a")
              .select(F.col("b").alias("doc_id"), F.col("a").alias("centre"), member.alias("salt"), F.lit(1).alias("role"))
              .union(centres.select("a", "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)), F.lit(0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for part, data, offsets in slices(batch):
                sets, found = shingle_sets(data, offsets, plan.words), []
                rows = zip(*(part.column(i).to_pylist() for i in range(4)), sets)
                for doc, centre, salt, role, own in rows:
                    if role == 0:
                        if at != (centre, salt):
                            at, held = (centre, salt), []
                        held.append(own)
                        continue
                    found += [(centre, doc) for other in held if alike(own, other, plan)]
                a, b = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    needed = materialize(needed, "needed")
    texts = docs.select(_long("doc_id"), F.col("text").cast("string").alias("text"))
    texts = only_ids(texts, needed.select("doc_id"))
    return (needed.join(texts, "doc_id")
            .select("doc_id", "centre", "salt", "role", "text")
            .repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role")
            .mapInArrow(run, "a long, b long"))


def _compare_tile(plan: Plan):
    """Of two blocks of a bucket (or one): verified links between members of
    different components, so many as join what the pairs join."""
    def run(rows: pa.Table) -> pa.Table:
        block = rows["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        rows, block = rows.take(pa.array(order)), block[order]
        rep, n = rows["rep"].to_numpy(), len(order)
        sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint32).reshape(n, plan.hashes)
        sets = [np.frombuffer(x, np.uint64) for x in rows["set"].to_pylist()]
        size = np.array([len(x) for x in sets])
        _, part = np.unique(rows["root"].to_numpy(), return_inverse=True)  # component of each row, by what is known here
        band = int(rows["band"][0].as_py())
        earlier = sig[:, :band * plan.rows].reshape(n, band, plan.rows)
        two = rows["i"][0].as_py() != rows["j"][0].as_py()
        middle = int(np.searchsorted(block, block[-1])) if two else 0
        found: list[tuple[int, int]] = []
        for x in range(middle if two else n - 1):
            other = np.arange(middle if two else x + 1, n)
            other = other[part[other] != part[x]]
            other = other[100 * np.minimum(size[other], size[x]) >= plan.percent * np.maximum(size[other], size[x])]
            if not len(other):
                continue
            other = other[_survive(np.broadcast_to(sig[x], (len(other), plan.hashes)), sig[other], plan)]
            other = other[~(earlier[other] == earlier[x]).all(axis=2).any(axis=1)]
            other = other[np.argsort(-(sig[other] == sig[x]).sum(axis=1), kind="stable")]
            for y in other.tolist():
                if part[y] != part[x] and alike(sets[x], sets[y], plan):
                    found.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                    part[part == part[y]] = part[x]
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _sets(docs: DataFrame, ids: DataFrame, plan: Plan) -> DataFrame:
    """The full shingle set of each class in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                sets = [x.tobytes() for x in shingle_sets(data, offsets, plan.words)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["rep", "set"])

    texts = docs.select(_long("doc_id"), F.col("text").cast("string").alias("text"))
    own = only_ids(texts, ids.select(F.col("rep").alias("doc_id")))
    return (own.mapInArrow(run, "rep long, set binary").dropDuplicates()
            .withColumn("bytes", F.octet_length("set")))


def _mixed(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of the large buckets that hold more than one
    component."""
    placed = (large.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("root", F.coalesce("root", "rep")))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("m"), F.max("root").alias("n")).where("m < n")
    return placed.join(mixed.select("bucket"), "bucket", "left_semi")


def _residual(placed: DataFrame, classes: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Verified links (a, b) between the components in each bucket."""
    placed = materialize(placed.join(sets.select("rep", "bytes"), "rep"), "placed")
    blocks = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("bytes") / TILE_BYTES)).cast("int")
    rows = (placed.join(placed.groupBy("bucket").agg(blocks.alias("blocks")), "bucket")
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"i": F.least("block", "x"), "j": F.greatest("block", "x")}))
    rows = rows.join(classes.select("rep", "sig"), "rep").join(sets.select("rep", "set"), "rep")
    return (rows.select("bucket", "band", "i", "j", "block", "rep", "root", "sig", "set")
            .groupBy("bucket", "i", "j").applyInArrow(_compare_tile(plan), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id
    reachable over links), kept.  Rows of one doc_id with different texts are
    one node; a class is led by the least doc_id that has its set."""
    described = materialize(describe(docs, plan), "described")
    named = described.where("n_shingles > 0 and doc_id is not null")
    classes = (named.groupBy("p", "q").agg(F.min(F.struct("doc_id", "sig")).alias("x"))
               .select("p", "q", F.col("x.doc_id").alias("rep"), F.col("x.sig").alias("sig")))
    classes = materialize(classes, "classes")

    buckets = _buckets(classes, plan)
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("members"), F.min("rep").alias("low")).where("members > 1")
    shared = materialize(buckets.join(shared, "bucket"), "buckets")
    large = shared.where(F.col("members") > SMALL_BUCKET)
    small = (shared.where(F.col("members") <= SMALL_BUCKET).groupBy("bucket")
             .agg(F.sort_array(F.collect_set("rep")).alias("r")).select(F.col("r"), F.posexplode("r").alias("i", "a"))
             .select("a", F.explode(F.slice("r", F.col("i") + 2, F.lit(SMALL_BUCKET))).alias("b")))
    nearest = Window.partitionBy("b").orderBy("a")  # a row per band at most
    star = (large.select(F.col("low").alias("a"), F.col("rep").alias("b")).where("a < b").distinct()
            .withColumn("i", F.row_number().over(nearest)).where(F.col("i") <= FIRST_LINKS).drop("i"))
    pairs = small.union(star).distinct()
    links = materialize(verify(materialize(prune(pairs, classes, plan), "candidates"), docs, plan), "links")
    roots = components(links)
    large = large.select("bucket", "band", "rep")
    placed = _mixed(large, roots)
    sets = materialize(_sets(docs, placed.select("rep").distinct(), plan), "sets")
    more = materialize(_residual(placed, classes, sets, plan), "residual")
    if not more.isEmpty():
        roots = components(links.union(more))

    least = (classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select("p", "q", F.coalesce("root", "rep").alias("least")))
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("least"))
    return (described.select("doc_id", "n_shingles", "p", "q").join(least, ["p", "q"], "left")
            .select("doc_id", "n_shingles", F.coalesce(linked, "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def deduplicate(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents without those whose component has a smaller doc_id.
    Repeated rows of one doc_id stay."""
    gone = near_duplicates(docs, plan).where("not kept").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti").select(*docs.columns)
