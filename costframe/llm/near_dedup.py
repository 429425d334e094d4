"""MinHash near-deduplication by an inverted join of signature coordinates.

1. Beside the scan, each text becomes its set of word shingles (64-bit hashes),
   a 128-bit digest of the set, and a signature: its least value under each of
   ``COORDS`` hash functions.  Texts with one digest are one class.
2. Each class is posted under its (coordinate, value) pairs.  Two classes are
   candidates if they agree in ``MATCHES`` or more coordinates.  Such a pair
   agrees in at least one of the ``COORDS - MATCHES + 1`` rarest pairs of each
   (rare first, one order for all), so only those are posted: values that
   nobody shares use up the prefix first, which keeps texts that merely contain
   a widespread passage out of its long list.
3. Of lists with the same members one is kept.  Lists are merged in blocks that
   are compared with each other by whole columns of signatures, skipping pairs
   whose sizes can't reach the similarity and pairs that an earlier list holds.
4. Candidates are confirmed on the full shingle sets where the sets of a pair of
   blocks have come together; pairs that links have already united are skipped,
   so a large family costs about one comparison a member if it is close.
5. Components come from alternating large-star and small-star rounds.

The block comparison also asks a finer 256-byte sketch of the posted classes.
With 32 coordinates and 14 matches a pair at similarity 0.8 is missed with a
probability of about 4e-6 (binomial tail); pairs above are missed less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import (U, bitmap_of, gram_hashes, hash_spans, in_bitmap, lower_ascii, mix, saved, table,
                                  text_slices, word_spans)

WORDS = 4
COORDS = 32
MATCHES = 14
#: Similarity as a fraction of integers, so that the border is exact.
PERCENT = 80
#: Members of one list that are compared with one other block at once.
BLOCK = 512
#: Bits of the bitmap of posted documents: fixed, and only sparing work.
BITS = 1 << 25
#: Seeds of the hash functions.
_RNG = np.random.default_rng(20240229)
MULTIPLIERS = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64) * U(2) + U(1)
OFFSETS = _RNG.integers(0, 1 << 63, COORDS, dtype=np.uint64)
#: Bytes of the sketch, and how many must agree (0.8 of them do on average at similarity 0.8; 170 is 5.5 deviations less).
SKETCH = 256
SKETCH_MATCHES = 170
SKETCH_MULTIPLIERS = _RNG.integers(0, 1 << 63, SKETCH, dtype=np.uint64) * U(2) + U(1)
SKETCH_OFFSETS = _RNG.integers(0, 1 << 63, SKETCH, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text has its whole sequence as one."""
    starts, ends, bounds = word_spans(buf, off)
    h = hash_spans(lower_ascii(buf), starts, ends)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            yield np.unique(gram_hashes(h[a:b], words))
        elif b > a:
            yield mix(gram_hashes(h[a:b], int(b - a)) + U(b - a))
        else:
            yield h[:0]


def digest(shingles: np.ndarray) -> bytes:
    return np.array([shingles.sum(dtype=U), mix(shingles ^ OFFSETS[0]).sum(dtype=U)], U).tobytes()


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(shingles), 4096):
        part = (shingles[lo:lo + 4096, None] ^ OFFSETS) * MULTIPLIERS
        out = np.minimum(out, (part.min(0) >> U(32)).astype(np.uint32))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The low bytes of ``SKETCH`` further least values: a finer estimate for the classes that are posted."""
    out = np.full(SKETCH, 0xFFFFFFFFFFFFFFFF, U)
    for lo in range(0, len(shingles), 1024):
        out = np.minimum(out, ((shingles[lo:lo + 1024, None] ^ SKETCH_OFFSETS) * SKETCH_MULTIPLIERS).min(0))
    return (out >> U(40)).astype(np.uint8)


def profiles(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, node, sig): node is the 16-byte digest of the shingle set, sig the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column(1)):
                n, node, sig = [], [], []
                for s in shingle_sets(buf, off, words):
                    n.append(len(s))
                    node.append(digest(s))
                    sig.append(signature(s).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                     pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "node", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, node binary, sig binary")


def coordinate_keys(sig: str = "sig") -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(COORDS - 1)),
                       lambda k: F.xxhash64(k, F.substring(F.col(sig), k * 4 + 1, F.lit(4))))


def postings(classes: DataFrame) -> DataFrame:
    """(key, node): each class under its rarest coordinate values, as far as the prefix goes."""
    every = classes.select("node", F.explode(coordinate_keys()).alias("key"))
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    ranked = (every.join(shared, "key").groupBy("node")
              .agg(F.array_sort(F.collect_list(F.struct("many", "key"))).alias("c")).where(F.size("c") >= MATCHES))
    return ranked.select("node", F.explode(F.expr(f"slice(c, 1, size(c) - {MATCHES - 1})")).alias("c")).select("c.key", "node")


def distinct_lists(posted: DataFrame) -> DataFrame:
    """(key, node, m) of the lists with m > 1 members, one list for each set of members.

    Copies share most of their coordinates, hence lists with the same members;
    whatever pair one of them holds, the kept one holds too.
    """
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).where("m > 1")
    return posted.join(lists.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m"), "key")


def _padded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lists of longs as one matrix, and where it holds their values."""
    size = np.diff(lists.offsets.to_numpy())
    there = np.arange(max(1, size.max())) < size[:, None]
    out = np.zeros(there.shape, np.int64)
    out[there] = lists.flatten().to_numpy()
    return out, there


def _compared(sides: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (two arrays of row numbers) in one (key, i, j) group, the likest first.

    A pair that shares several lists is taken in the one with the least key.
    """
    key, i, j = (sides.column(c)[0].as_py() for c in ("key", "i", "j"))
    sub, n = sides.column("sub").to_numpy(), sides.column("n").to_numpy()
    sig = np.frombuffer(b"".join(sides.column("sig").to_pylist()), np.uint32).reshape(len(n), COORDS)
    fine = np.frombuffer(b"".join(sides.column("sketch").to_pylist()), np.uint8).reshape(len(n), SKETCH)
    keys, there = _padded(sides.column("keys"))
    left, right = np.flatnonzero(sub == i), np.flatnonzero(sub == j)
    found: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, len(left), BLOCK):
        x = left[lo:lo + BLOCK]
        for ro in range(0, len(right), BLOCK):
            y = right[ro:ro + BLOCK]
            fits = np.minimum(n[x][:, None], n[y]) * 100 >= np.maximum(n[x][:, None], n[y]) * PERCENT
            if not fits.any():
                continue
            same = np.zeros(fits.shape, np.int16)
            for k in range(COORDS):
                same += sig[x, k][:, None] == sig[y, k]
            p, q = np.nonzero(fits & (same >= MATCHES))
            p, q = x[p], y[q]
            if i == j:
                p, q = p[p < q], q[p < q]
            for at in range(0, len(p), 4096):
                u, v = p[at:at + 4096], q[at:at + 4096]
                like = (fine[u] == fine[v]).sum(1)
                near = like >= SKETCH_MATCHES
                u, v, like = u[near], v[near], like[near]
                shared = ((keys[u][:, :, None] == keys[v][:, None, :]) & there[v][:, None, :]).any(2) & there[u]
                first = np.where(shared, keys[u], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max) == key
                found.append((u[first], v[first], like[first]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v, like = (np.concatenate(f) for f in zip(*found))
    order = np.argsort(-like, kind="stable")
    return u[order], v[order]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of rows with equal (key, i, j), one batch each, from sorted rows."""
    held, mark = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.column_stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
        cuts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1, [len(ids)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if held and mark != tuple(ids[lo]):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(lo, hi - lo))
            mark = tuple(ids[lo])
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _united(a: np.ndarray, b: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The least member of each member's component under the candidates that are links.

    Candidates come likest first.  First each member tries its likest partner;
    then the rest is compared, save pairs that have already been united.
    """
    size = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.concatenate([[0], np.cumsum(size)])
    root = np.arange(len(sets))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    best = np.zeros(len(a), bool)
    best[np.unique(a, return_index=True)[1]] = True
    best[np.unique(b, return_index=True)[1]] = True
    mark = np.zeros(int(at[-1]), bool)
    for turn in (np.flatnonzero(best), np.flatnonzero(~best)):
        now = -1
        for k in turn[np.argsort(a[turn], kind="stable")]:
            p, q = top(a[k]), top(b[k])
            if p == q:
                continue
            if a[k] != now:
                if now >= 0:
                    mark[ids[at[now]:at[now + 1]]] = False
                now = a[k]
                mark[ids[at[now]:at[now + 1]]] = True
            both = int(np.count_nonzero(mark[ids[at[b[k]]:at[b[k] + 1]]]))
            if 100 * both >= PERCENT * (size[a[k]] + size[b[k]] - both):
                root[max(p, q)] = min(p, q)
        if now >= 0:
            mark[ids[at[now]:at[now + 1]]] = False
    return np.array([top(x) for x in range(len(sets))])


def linked_groups(posted: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): edges that connect what confirmed links connect, from lists compared block by block.

    Candidates stay packed, one row for each pair of blocks that has any; the
    sets of their members come to that row, so no row is made for a mere
    candidate, and one edge a member says what the links of a group unite.
    """
    group = ["key", "i", "j"]
    rows = (posted.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
            .withColumn("sub", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int"))
            .select("key", "node", "sub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("t"))
            .select("key", "node", "sub", F.least("sub", "t").alias("i"), F.greatest("sub", "t").alias("j"))
            .join(classes.select("node", "n", "sig", "keys").join(sets.select("node", "sketch"), "node"), "node"))
    rows = (rows.select(*group, "node", "sub", "n", "sig", "sketch", "keys").repartition(*group)
            .sortWithinPartitions(*group, "node"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            a, b = _compared(g)
            if len(a):
                used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                at = at.astype(np.int32)
                nodes = g.column("node").take(pa.array(used)).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [g.column(c).slice(0, 1) for c in group] + [pa.array([nodes], pa.list_(pa.binary())), pa.array(
                        [at[:len(a)].tobytes()], pa.binary()), pa.array([at[len(a):].tobytes()], pa.binary())],
                    names=[*group, "nodes", "left", "right"])

    packs = saved(rows.mapInArrow(candidates, "key long, i int, j int, nodes array<binary>, left binary, right binary"), "candidates")
    members = (packs.select(*group, F.posexplode("nodes").alias("pos", "node"))
               .join(sets.select("node", "shingles"), "node")
               .select(*group, "pos", "node", "shingles", F.lit(None).cast("binary").alias("other")))
    both = (members.unionByName(packs.select(*group, F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("node"),
                                             F.col("left").alias("shingles"), F.col("right").alias("other")))
            .repartition(*group).sortWithinPartitions(*group, "pos"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            a = np.frombuffer(g.column("shingles")[0].as_buffer(), np.int32)
            b = np.frombuffer(g.column("other")[0].as_buffer(), np.int32)
            root = _united(a, b, [np.frombuffer(x.as_buffer(), U) for x in g.column("shingles")[1:]])
            nodes, other = g.column("node").slice(1), np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(root[other])), nodes.take(pa.array(other))], names=["a", "b"])

    return both.mapInArrow(confirm, "a binary, b binary")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles, sketch): the sets of the wanted classes, from the text of one document of each.

    A bitmap of fixed size spares most other documents the work and the shuffle;
    the join decides.
    """
    told = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select(F.xxhash64("doc")), BITS))
    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("at"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).filter(pa.array(in_bitmap(told.value, batch.column(0).to_numpy())))
            for _, _, buf, off in text_slices(texts):
                sets = [s for s in shingle_sets(buf, off, words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([sketch(s).tobytes() for s in sets], pa.binary())], names=["node", "shingles", "sketch"])

    found = rows.mapInArrow(run, "node binary, shingles binary, sketch binary")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of (a, b): alternating large-star and small-star."""
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        then = saved(small, "stars")
        # done when each node has one edge, to a root that has none: two partial counts, no comparison of edge sets
        loose = then.join(then.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        torn = then.groupBy("u").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
        if loose.isEmpty() and torn.isEmpty():
            return then.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = then


def linked(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(profiles, classes with their component ``comp``) of ``docs``."""
    prof = saved(profiles(docs, words), "profiles")
    classes = saved(prof.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"), F.max("sig").alias("sig")), "classes")
    lists = saved(distinct_lists(saved(postings(classes), "postings")), "lists")
    keys = lists.groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    some = saved(classes.join(keys, "node"), "posted-classes")
    sets = saved(full_sets(docs, some, words), "sets")
    roots = components(saved(linked_groups(lists, some, sets), "links"))
    return prof, classes.join(roots, "node", "left").select("node", "doc", F.coalesce("root", "node").alias("comp"))


def near_dedup(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased; a text with fewer
    than ``words`` words has its whole sequence as one shingle; null, empty and
    blank texts have none, are linked with nothing and stay.  component_id is the
    smallest doc_id reachable over links of similarity 0.8 or more.  Rows with a
    null doc_id take part, never give the id, and are kept only if all of their
    component is null; repeated rows have a row each.  Other columns are
    ignored; an empty table gives an empty result.
    """
    prof, classes = linked(docs, words)
    roots = classes.groupBy("comp").agg(F.min("doc").alias("component_id"))
    by_class = classes.select("node", "comp").join(roots, "comp").select("node", "component_id")
    out = (prof.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
           .join(by_class, "node", "left"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def op5_coordinate_join(spark, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))
