"""Phrase collocation mining on count streams in prefix and suffix order.

All n-grams up to ``longest`` words are counted per language, the empty one too
(its count is that of all words).  The counts are then laid out as one stream of
all orders, twice: sorted by their words from the left, so that each n-gram
follows its own beginnings, and sorted from the right, so that it follows its
own endings.  One walk over each stream reads all orders in lockstep and hands
every n-gram the counts of its beginnings (endings), and to every n-gram the
largest count of those that extend it by a word.  Nothing is looked up by hash.

The streams are cut into ranges of (language, words), wherever that falls: a
frequent word or language is cut like any other.  A range that begins inside an
n-gram's extensions asks for the counts of the few n-grams that it lies in
(``longest`` at most for a range), and what it knows of these goes to their rows.

Only n-grams that occur ``least`` times go into the streams.  That loses nothing:
a part of an n-gram, and so each of the counts that its score needs, occurs as
often as the n-gram itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costframe.llm.common import BASE, U, hash_spans, lower_ascii, mix, packed, saved, table, text_slices

LONGEST = 3
LEAST = 10
TOP = 2000
#: Longer candidates with this share (percent) of a phrase's count make it redundant.
COVERED = 50
#: Bytes of text counted together, bytes of packed counts handed on at once, rows merged at once, rows of a batch.
COUNT_BYTES = 1 << 21
PACKET_BYTES = 1 << 21
MERGE_ROWS = 1 << 18
ROWS = 50_000
#: Partitions of the counts for each shuffle partition: a task holds the distinct n-grams of one.
SPREAD = 4
#: Groups of the levels in which the best of a language are found; none reads more than the best of 64 groups.
GROUPS = (4096, 64, 1)

# Bytes that end a piece, and those that end a word inside one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

COUNTS = "lang string, phrase string, f long"
ORDERED = "part int, mine boolean, lang string, path array<string>, f long, above array<long>, longer long"


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def gram_counts(buf: np.ndarray, off: np.ndarray, lang: np.ndarray, lang_hash: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """(language, phrase, count, spread) arrays of the n-grams of some adjacent texts, one for each order from 0.

    ``lang`` has a number for each text, ``lang_hash`` a hash for each number.
    n-grams are told apart by the numbers of their words, never by hashes;
    ``spread`` is a hash of language and phrase that only deals the counts out.
    """
    low = lower_ascii(buf)
    stop = _flags(PIECE_ENDS)[low]
    word = ~(stop | _flags(WORD_ENDS)[low])
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(last) + 1
    row = np.searchsorted(off, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(stop), starts)
    next_too = np.zeros(len(starts), bool)
    next_too[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])

    ends = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(low[word])]).dictionary_encode()
    number, words = words.indices.to_numpy().astype(np.int64), words.dictionary
    size = max(len(words), 1)
    word_hash = np.zeros(size, U)
    word_hash[number] = hash_spans(low, starts, stops)

    of, count = np.unique(lang[row], return_counts=True)
    phrase, spread = pa.array([""] * len(of), pa.large_string()), mix(lang_hash[of])
    yield of, phrase, count, spread
    at = np.arange(len(starts))
    gram = np.searchsorted(of, lang[row])
    for n in range(1, longest + 1):
        key, gram, count = np.unique(gram * size + number[at + n - 1], return_inverse=True, return_counts=True)
        head, end = key // size, key % size
        spread = mix(spread[head] * U(BASE) + word_hash[end])
        of, tail = of[head], words.take(pa.array(end))
        phrase = tail if n == 1 else pc.binary_join_element_wise(phrase.take(pa.array(head)), tail, pa.scalar(" ", pa.large_string()))
        yield of, phrase, count, spread
        keep = next_too[at + n - 1]
        at, gram = at[keep], gram[keep]


def _packets(names: pa.Array, grams: list[tuple], parts: int) -> Iterator[pa.RecordBatch]:
    """The counts of a slice of texts as one packed run for each of ``parts``."""
    phrase = pa.chunked_array([g[1] for g in grams]).combine_chunks()
    lang, count, spread = (np.concatenate([g[k] for g in grams]) for k in (0, 2, 3))
    part = (spread % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    ready, runs, held = [], [], 0
    for k in np.flatnonzero(np.diff(bounds)):
        some = order[bounds[k]:bounds[k + 1]]
        run = pa.RecordBatch.from_arrays([names.take(pa.array(lang[some])), phrase.take(pa.array(some)).cast(pa.string()), pa.array(count[some].astype(np.int64))],
                                         names=["lang", "phrase", "f"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, run.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(run)
        ready.append(k)
        runs.append(sink.getvalue().to_pybytes())
        held += len(runs[-1])
        if held > PACKET_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(ready, pa.int32()), pa.array(runs, pa.binary())], names=["part", "run"])
            ready, runs, held = [], [], 0
    if ready:
        yield pa.RecordBatch.from_arrays([pa.array(ready, pa.int32()), pa.array(runs, pa.binary())], names=["part", "run"])


def _sums(tables: list[pa.Table]) -> pa.Table:
    got = pa.concat_tables(tables).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return pa.table([got.column("lang"), got.column("phrase"), got.column("f_sum")], names=["lang", "phrase", "f"])


def count_stream(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): how often each n-gram of up to ``longest`` words occurs, if ``least`` times or more;
    the empty one counts all words and is always there.

    A task packs its counts into one run for each partition of the shuffle, which
    merges the runs that it gets; a frequent phrase is one entry of a run.
    """
    parts = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            number, names = names.indices.to_numpy(zero_copy_only=False).astype(np.int64), names.dictionary
            chars, bounds = packed(names)
            hashes = hash_spans(chars, bounds[:-1], bounds[1:])
            for lo, hi, buf, off in text_slices(batch.column(1), COUNT_BYTES):
                yield from _packets(names, list(gram_counts(buf, off, number[lo:hi], hashes, longest)), parts)
            pa.default_memory_pool().release_unused()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, new, rows = None, [], 0
        for batch in batches:
            for data in batch.column(1):
                new.append(pa.ipc.open_stream(data.as_buffer()).read_all())
                rows += len(new[-1])
                if rows >= MERGE_ROWS + (len(sums) if sums is not None else 0):
                    sums, new, rows = _sums([*new, sums] if sums is not None else new), [], 0
        if new or sums is not None:
            sums = _sums([*new, sums] if sums is not None else new)
            sums = sums.filter((pc.field("f") >= least) | (pc.field("phrase") == ""))
            pa.default_memory_pool().release_unused()
            yield from sums.to_batches(ROWS)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "part int, run binary").repartitionById(parts, F.col("part")).mapInArrow(merge, COUNTS)


class _Walk:
    """The n-grams that a walk is inside of, from the language's empty one on."""

    def __init__(self, part: int):
        self.part = part
        self.held: list[list] = []  # [lang, path, f or None, largest count of one word more]

    def _pop(self):
        lang, path, f, longer = self.held.pop()
        if f is None:
            return (self.part, False, lang, path, None, None, longer)
        return (self.part, True, lang, path, f, [h[2] for h in self.held], longer)

    def step(self, lang: str, path: list[str], f: int) -> Iterator[tuple]:
        """Moves to ``path``; yields the rows that it leaves."""
        while self.held and (self.held[-1][0] != lang or self.held[-1][1] != path[:len(self.held) - 1]):
            yield self._pop()
        for n in range(len(self.held), len(path)):  # begun in an earlier range
            self.held.append([lang, path[:n], None, None])
        if self.held:
            above = self.held[-1]
            above[3] = max(f, above[3] or 0)
        self.held.append([lang, path, f, None])

    def end(self) -> Iterator[tuple]:
        while self.held:
            yield self._pop()


def walked(counts: DataFrame, from_the_right: bool) -> DataFrame:
    """Each n-gram of ``counts`` (lang, path, f) with the counts of its beginnings (``above``, from the
    empty one on) and the largest count of one word more (``longer``).

    Rows that aren't ``mine`` carry a range's share of ``longer`` for an n-gram of an earlier range.
    """
    path = F.reverse("path") if from_the_right else F.col("path")
    rows = counts.select("lang", path.alias("path"), "f").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(TaskContext.get().partitionId())
        kinds = [pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64()]
        names = ["part", "mine", "lang", "path", "f", "above", "longer"]
        pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)
        out: list[tuple] = []
        for batch in batches:
            for lang, words, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.extend(walk.step(lang, words, f))
                if len(out) >= ROWS:
                    yield pack(out)
                    out = []
        out.extend(walk.end())
        if out:
            yield pack(out)

    got = saved(rows.mapInArrow(run, ORDERED), "phrases-" + ("suffix" if from_the_right else "prefix"))
    # The n-grams that ranges begin inside of: `longest` rows for a range at most.
    heads = got.where(~F.col("mine")).join(got.where("mine").select("lang", "path", F.col("f").alias("own")), ["lang", "path"])
    heads = heads.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(F.size("path"), "own"))).alias("known"))
    got = got.join(F.broadcast(heads), "part", "left")
    above = F.transform("above", lambda x, k: F.coalesce(x, F.col("known")[k]))
    own = F.reverse("path") if from_the_right else F.col("path")
    return got.select("lang", own.alias("path"), "f", above.alias("above"), "longer")


def best(rows: DataFrame, by: str, key: str, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each ``by`` in ``order``, with their ``rank``: the best of hashed groups, then of these."""
    rows = rows.withColumn("group", F.pmod(F.xxhash64(key), F.lit(GROUPS[0])))
    for groups in GROUPS:
        w = Window.partitionBy(by, F.pmod("group", F.lit(groups))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return rows.drop("group")


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """The ``top`` collocations of each language of ``docs`` (lang, text; other columns are ignored):
    lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null lang is ``und``; texts without words give
    nothing; repeated rows count each time; a language without candidates, and an
    empty table, give no rows.  Ties in score go to the larger count, then to the
    lesser phrase, so no two rows share a rank.  Scores are exact up to counts of 10**16.
    """
    counts = count_stream(docs, longest, least)
    path = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    counts = saved(counts.select("lang", path.alias("path"), "f"), "phrases-counts")
    left = walked(counts, False).withColumnRenamed("above", "left").withColumn("right", F.lit(None).cast("array<long>"))
    right = walked(counts, True).withColumnRenamed("above", "right").withColumn("left", F.lit(None).cast("array<long>"))
    rows = (left.unionByName(right).where(F.size("path") > 1).groupBy("lang", "path")
            .agg(F.max("f").alias("a"), F.max("left").alias("left"), F.max("right").alias("right"), F.max("longer").alias("longer")))
    rows = rows.where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    size = F.size("path")
    cut = F.expr("""array_min(transform(sequence(1, size(path) - 1), k -> named_struct(
        'score', (CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * 1000000BD)
                 div (CAST(left[k] AS DECIMAL(16,0)) * CAST(right[size(path) - k] AS DECIMAL(16,0))),
        'k', k, 'l', left[k], 'r', right[size(path) - k])))""")
    rows = rows.withColumn("cut", cut).select("lang", F.array_join("path", " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                                              F.col("left")[0].alias("n"), F.col("cut.score").alias("score"), size.alias("words"))
    out = best(rows, "lang", "phrase", [F.col("score").desc(), F.col("a").desc(), "phrase"], top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words")


def op11_count_streams(spark, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), counts AS (
  SELECT lang, 1 AS words, phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS phrase FROM pieces) GROUP BY ALL
  UNION ALL SELECT lang, 2, phrase, count(*) FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM pieces) GROUP BY ALL
  UNION ALL SELECT lang, 3, phrase, count(*)
  FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase FROM pieces) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS p FROM counts WHERE words > 1 AND f >= 10
), cuts AS (
  SELECT lang, words, phrase, a, k, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, h.f AS l, t.f AS r, (1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f))::BIGINT AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f), k) AS pick
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.rest
), longer AS (
  SELECT lang, part, max(a) AS f FROM (SELECT lang, a, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS part FROM candidates WHERE words = 3) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored s LEFT JOIN longer x ON x.lang = s.lang AND x.part = s.phrase
  WHERE pick = 1 AND (x.f IS NULL OR 100 * x.f < 50 * s.a)
)
SELECT lang, rank, phrase, a, l, r, n, score, words::INTEGER AS words FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
