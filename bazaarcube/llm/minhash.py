"""Near-duplicate documents by min-max hashing, with exact confirmation.

A document's set is its distinct shingles of five words. Equal sets become one class.
Of each class, the minimum AND the maximum of its hashed shingles under each of
``PERMUTATIONS`` permutations are kept: two signature values for one evaluation. They
are banded by ``BAND`` values; a pair of similarity 0.75 misses all 64 bands with
probability 3e-8.

A bucket of m documents is not expanded into its pairs. Its most central document (the
one in the fullest buckets) is its leader, and only pairs of leader and member are
compared, which links nearly all of a dense group. Any pair that is left must lie in a
bucket that holds several components. The documents of such buckets are compared by a prefix
filter: with all shingles in one global order, rarest first, two sets that reach the
threshold share a shingle among the first of both, and only pairs of different
components that do, at ranks that leave enough shingles, are candidates. The order comes
from a table of counts of fixed size; any order gives the same links.

Candidates pass if their signatures agree as often as a pair of similarity 0.75 does
to within six standard deviations, and are then confirmed on the full sets of both
whole texts. Shingles are compared by 48-bit hashes. Components are found by Spark.

Defined cases: a text without words, or null, has an empty set, is linked with nothing
and is a component of its own; fewer than five words are one shingle. A row without an
id is linked with nothing, has no component and is kept. Rows of one id are one vertex;
all rows of a kept id are kept. Extra columns are carried along by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarcube.llm.components import components
from bazaarcube.llm.tables import Shared, fresh_names
from bazaarcube.llm.textops import mix, shingles, slices
from bazaarcube.session import new_folder, remove_folder, stage, stage_at

PERMUTATIONS, BAND = 160, 5
VALUES = 2 * PERMUTATIONS
N_BANDS = VALUES // BAND
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Signature values that must agree for a pair to be confirmed on the sets: the mean
#: at the threshold (with chance agreement of 8-bit values) less six deviations.
_P = PERCENT / 100 + (1 - PERCENT / 100) / 256
AGREE = int(VALUES * _P - 6 * (VALUES * _P * (1 - _P)) ** 0.5)
#: Ids sent to all executors to fetch or drop documents; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Bits of the table of shingle counts that orders shingles.
COUNT_BITS = 20
#: Counts in one row on their way to the sum over all tasks.
COUNT_CHUNK = 1 << 10
#: Shingles handled at once when pairs are confirmed.
STEP = 1 << 20

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_WEIGHT = _rng.integers(1, 1 << 63, BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set size, two set hashes, band keys and 8-bit signature of each text."""
    x, first = shingles(text)
    n = np.diff(first)
    has = np.flatnonzero(n)
    at = first[:-1][has]
    h1, h2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    values = np.zeros((len(has), VALUES), np.uint32)
    if len(has):
        h1[has] = np.add.reduceat(mix(x), at)
        h2[has] = np.add.reduceat(mix(x + np.uint64(1 << 50)), at)
        small = (mix(x) >> np.uint64(32)).astype(np.uint32)
        for lo in range(0, len(has), 2000):  # some sets at a time stay in the cache
            hi = min(lo + 2000, len(has))
            start, end = at[lo], first[has[hi - 1] + 1]
            part, inner = small[start:end], at[lo:hi] - start
            for i in range(PERMUTATIONS):
                y = part * _A[i] + _B[i]
                values[lo:hi, 2 * i] = np.minimum.reduceat(y, inner)
                values[lo:hi, 2 * i + 1] = np.maximum.reduceat(y, inner)
    wide = values.reshape(len(has), N_BANDS, BAND).astype(np.uint64)
    keys = mix((wide * _WEIGHT).sum(2, dtype=np.uint64) + np.arange(N_BANDS, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    all_keys = np.zeros((len(n), N_BANDS), np.uint64)
    all_keys[has] = keys
    short = np.zeros((len(n), VALUES), np.uint8)
    short[has] = (values >> np.uint32(11)).astype(np.uint8)
    return n, h1, h2, all_keys, short


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n, h1, h2, keys, short = signatures(batch.column("text"))
        has = n > 0
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(has * N_BANDS)]).astype(np.int32)), pa.array(keys[has].ravel().view(np.int64))
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                lists, pa.array([row.tobytes() for row in short], pa.binary()),
            ],
            names=["doc_id", "n", "h1", "h2", "keys", "sig"],
        )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(s).to_pylist()), np.uint8).reshape(batch.num_rows, VALUES) for s in ("sig_a", "sig_b"))
        enough = pa.array((a == b).sum(1) >= AGREE)
        yield batch.select(["a", "b"]).filter(enough)


def similar(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether each pair of whole texts reaches the threshold."""
    out = np.zeros(len(a), bool)
    sets = []
    for texts in (a, b):  # a text that occurs in many pairs is cut into shingles once
        coded = texts.fill_null("").dictionary_encode()
        x, first = shingles(coded.dictionary)
        sets.append((x, first, coded.indices.to_numpy(zero_copy_only=False)))
    sizes = [(first[1:] - first[:-1])[index] for _, first, index in sets]
    total = np.cumsum(sizes[0] + sizes[1])
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + STEP, "right")))
        hi = min(hi, lo + 60_000)
        keys = []
        for (x, first, index), size in zip(sets, sizes, strict=True):
            n = size[lo:hi]
            at = np.arange(n.sum()) + np.repeat(first[index[lo:hi]] - (np.cumsum(n) - n), n)
            keys.append(np.repeat(np.arange(hi - lo, dtype=np.uint64), n) << np.uint64(48) | x[at])
        both = np.sort(np.concatenate(keys))
        equal = both[1:][both[1:] == both[:-1]]
        common = np.bincount((equal >> np.uint64(48)).astype(np.int64), minlength=hi - lo)
        union = sizes[0][lo:hi] + sizes[1][lo:hi] - common
        out[lo:hi] = (100 * common >= PERCENT * union) & (union > 0)
        lo = hi
    return out


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.select(["a", "b"]).filter(pa.array(similar(batch.column("text_a"), batch.column("text_b"))))


def _alike_in_size(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _slot(x: np.ndarray) -> np.ndarray:
    return (x & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)


def packed(counts: np.ndarray) -> pa.RecordBatch:
    """Counts in chunks, each as its bytes by place: the high ones are mostly zero and
    take no room once compressed. Chunks without counts are left out."""
    chunks = counts.reshape(-1, COUNT_CHUNK)
    used = np.flatnonzero(chunks.any(1))
    planes = [chunks[i].view(np.uint8).reshape(-1, 8).T.tobytes() for i in used]
    return pa.RecordBatch.from_arrays([pa.array(used), pa.array(planes, pa.binary())], names=["chunk", "counts"])


def add_packed(counts: np.ndarray, batch: pa.RecordBatch | pa.Table) -> None:
    chunks = counts.reshape(-1, COUNT_CHUNK)
    for chunk, planes in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
        chunks[chunk] += np.frombuffer(planes.as_buffer(), np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in slices(batches):
        counts += np.bincount(_slot(shingles(batch.column("text"))[0]), minlength=1 << COUNT_BITS)
    yield packed(counts)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in batches:
        add_packed(counts, batch)
    yield packed(counts)


def _prefixes(shared: Shared):
    """The first shingles of each set in the global order, with their ranks: as many as
    a pair with any set of admissible size may need to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.get()
        for batch in slices(batches):
            x, first = shingles(batch.column("text"))
            n = np.diff(first)
            doc = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((x, counts[_slot(x)], doc))
            rank = np.arange(len(x)) - first[doc]
            keep = 100 * (n[doc] - rank) >= PERCENT * n[doc]
            rows = doc[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(x[order][keep].view(np.int64)), pa.array(rank[keep]), pa.array(n[rows].astype(np.int64)),
                    batch.column("doc_id").take(pa.array(rows)), batch.column("component").take(pa.array(rows)),
                ],
                names=["x", "rank", "n", "doc_id", "component"],
            )

    return run


class _Search:
    """The stages of one run over ``docs`` (doc_id, text). ``scratch``: a folder that ``docs``
    is read from and nothing else; it is removed once the candidates' texts are stored."""

    def __init__(self, docs: DataFrame, scratch: str | None = None) -> None:
        self.spark, self.kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
        wide = new_folder(self.spark, "signed")
        signed = stage_at(docs.mapInArrow(_sign, f"doc_id {self.kind}, n long, h1 long, h2 long, keys array<long>, sig binary"), wide)
        same, compared = ["h1", "h2", "n"], "n > 0 AND doc_id IS NOT NULL"
        classes = new_folder(self.spark, "classes")
        reps = stage_at(
            signed.filter(compared).groupBy(*same).agg(F.min("doc_id").alias("doc_id"), F.min_by(F.struct("keys", "sig"), "doc_id").alias("x"))
            .select("doc_id", *same, "x.keys", "x.sig"),
            classes,
        )
        # from here on signatures are those of the classes
        self.signed = stage(signed.select("doc_id", *same), "sets")
        remove_folder(self.spark, wide)
        filled = self.signed.filter(compared)
        heads = filled.groupBy(*same).agg(F.min("doc_id").alias("b"))
        self.copies = filled.select(F.col("doc_id").alias("a"), *same).join(heads, same).select("a", "b").filter("a <> b")
        bands = reps.select("doc_id", "n", F.explode("keys").alias("key"))
        shared = reps.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
        self.buckets = new_folder(self.spark, "buckets")
        self.members = stage_at(bands.join(shared, "key"), self.buckets)
        ids = stage(self.members.select("doc_id").distinct(), "candidates")
        few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        # and only those that share a bucket are looked at again
        self.sigs = stage(reps.join(few, "doc_id", "left_semi").select("doc_id", "sig"), "signatures")
        remove_folder(self.spark, classes)
        self.texts = stage(docs.join(few, "doc_id", "left_semi"), "candidate-texts")
        if scratch:
            remove_folder(self.spark, scratch)
        self.tested: DataFrame | None = None
        self.found: DataFrame | None = None

    def leaders(self, path: str) -> DataFrame:
        """The most central document of each bucket."""
        score = self.members.groupBy("doc_id").agg(F.sum("m").alias("score"))
        first = F.max_by(F.struct(F.col("doc_id").alias("leader"), F.col("n").alias("leader_n")), F.struct("score", -F.col("doc_id")))
        return stage_at(self.members.join(score, "doc_id").groupBy("key").agg(first.alias("x")).select("key", "x.*"), path)

    def compare(self, pairs: DataFrame) -> None:
        """Confirms candidate pairs (a, b), adds their links, and joins the components."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        sig = self.sigs
        met = pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a")
        met = met.join(sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b")
        ids = f"a {self.kind}, b {self.kind}"
        close = stage(met.mapInArrow(_agreeing, ids), "close")
        text = lambda side: self.texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
        met = close.join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
        links = stage(met.mapInArrow(_confirmed, ids).distinct(), "links")
        self.tested = close if self.tested is None else self.tested.union(close)
        if self.found is not None:  # what is connected already is one star
            links = links.union(self.found.select(F.col("id").alias("a"), F.col("component").alias("b")))
        self.found = stage(components(links, "a", "b"), "components")

    def open_members(self) -> DataFrame:
        """The members of buckets that hold several components, with these."""
        placed = self.members.join(self.found, F.col("doc_id") == F.col("id"), "left")
        placed = placed.select("key", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
        several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
        return stage(placed.join(several.select("key"), "key"), "open-members")

    def prefix_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of different components that the prefix filter cannot rule out."""
        docs = stage(members.select("doc_id", "component").distinct(), "open-documents")
        few = F.broadcast(docs) if docs.count() <= BROADCAST_IDS else docs
        kind, counts = "chunk long, counts binary", np.zeros(1 << COUNT_BITS, np.int64)
        counted = self.texts.select("text").mapInArrow(_count, kind)
        add_packed(counts, counted.repartition("chunk").mapInArrow(_totals, kind).toArrow())
        rows = self.texts.join(few, "doc_id").select("doc_id", "component", "text")
        schema = f"x long, rank long, n long, doc_id {self.kind}, component {self.kind}"
        prefix = stage(rows.mapInArrow(_prefixes(Shared(self.spark, counts)), schema), "prefixes")
        # of each shingle's documents those outside its most common component meet all
        per = prefix.groupBy("x", "component").agg(F.count("*").alias("c"))
        main = per.groupBy("x").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count("*").alias("k")).filter("k > 1")
        one = prefix.join(main, "x").filter("component <> main").alias("one")
        two = prefix.alias("two")
        # enough must be left from this rank on: (100 + PERCENT) common >= PERCENT (n1 + n2)
        needed = (F.col("one.n") + F.col("two.n")) * PERCENT
        left = [(F.col(f"{s}.n") - F.col(f"{s}.rank")) * (100 + PERCENT) >= needed for s in ("one", "two")]
        met = one.join(two, (F.col("one.x") == F.col("two.x")) & (F.col("one.component") != F.col("two.component")) & left[0] & left[1])
        return met.select(F.col("one.doc_id").alias("a"), F.col("two.doc_id").alias("b"))

    def run(self) -> DataFrame:
        """(id, component) of every document that is linked."""
        leaders = new_folder(self.spark, "leaders")
        met = self.members.join(self.leaders(leaders), "key").filter("doc_id <> leader").filter(_alike_in_size("n", "leader_n"))
        self.compare(met.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")))
        left = self.open_members()
        for used in (leaders, self.buckets):
            remove_folder(self.spark, used)
        self.compare(self.prefix_pairs(left))
        return components(self.found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(self.copies), "a", "b")


def near_duplicates(docs: DataFrame, scratch: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    search = _Search(docs.select("doc_id", "text"), scratch)
    found = search.run()
    sets = search.signed.select("doc_id", "n")
    joined = sets.filter(F.col("doc_id").isNotNull()).join(found, F.col("doc_id") == F.col("id"), "left")
    component = F.coalesce("component", "doc_id")
    with_id = joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (component == F.col("doc_id")).alias("kept")
    )
    return with_id.union(sets.filter(F.col("doc_id").isNull()).select("doc_id", "n", F.col("doc_id"), F.lit(True)))


def keep_one(docs: DataFrame, compared: DataFrame | None = None, scratch: str | None = None) -> DataFrame:
    """The documents with the smallest id of each group of near-duplicates, with their
    own columns; documents without an id stay. ``compared``: the texts to compare (doc_id,
    text) in place of those of ``docs``, where a document has had other forms too; it is
    linked to what any of its forms is linked to. ``scratch``: a folder that only
    ``compared`` reads; it is removed once it is not needed any more."""
    found = near_duplicates(docs if compared is None else compared, scratch)
    (gone,) = fresh_names(docs, ["gone_id"])
    dropped = stage(found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct(), "dropped")
    if dropped.count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, F.col("doc_id") == F.col(gone), "left_anti")
