"""Operator 13, audit of how filters overlap, by sorted posting lists.

Five filters judge each whole text (words: maximal runs without white space,
case-sensitive):

- A: under 200 words; B: 100 * distinct words < 50 * words;
- C: 100 * ``[A-Z]`` characters > 2 * code points; D: holds any of ``#$%&*|``;
- E: identical to the text of a smaller doc_id anywhere in the table.

Documents are sorted by (part, doc_id) and cut into id ranges; ``postings``
keeps, per part and range, the ascending ids and for each filter (and for the
labels quality=1 and toxic=1) the sorted list of the failing ones. ``audit``
unites each set of filters by a galloping k-way merge of its lists, takes the
differences of a filter's list and the union before it, and sums the sizes of
all ranges; the 120 orders are then read off those sums. A large part is many
ranges in many tasks, and ranges of one part are added up map-side first.

Rows without doc_id name no document; a null text is empty (it fails A, and E
if a smaller doc_id is empty too); a null source is the part ''. Rows that share
a doc_id are one document each and never repeats of one another; a doc_id with
several label rows has quality or toxic 1 if any of them says so. Further
columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm import common as C

FILTERS = "ABCDE"
#: Fixed values of the filters.
MIN_WORDS, DISTINCT_PCT, CAPITALS_PCT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
WORD_GAP = r"[\x20\x09-\x0D]+"

RANGE = 1 << 16                                              # documents of one range at most
LISTS = [*FILTERS, "good", "toxic"]
POSTINGS = "part string, ids array<bigint>, " + ", ".join(f"{x} array<int>" for x in LISTS)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, A .. E, good, toxic: booleans) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    judged = (docs.where(F.col("doc_id").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                      F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
                      F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("distinct"),
                      (100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITALS_PCT * F.char_length(text)).alias("C"),
                      text.rlike(SYMBOLS).alias("D"))
              .withColumn("A", F.col("n") < MIN_WORDS)
              .withColumn("B", 100 * F.col("distinct").cast("long") < DISTINCT_PCT * F.col("n").cast("long"))
              .drop("n", "distinct"))
    judged = C.stage(judged, "judged")
    # a text's first document is found by its digest, then told by its own id: copies never meet
    first = judged.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to)
                    for c, to in (("quality", "good"), ("toxic", "toxic"))]))
    none = F.lit(False)
    return (judged.join(first, ["doc_id", "key"], "left").join(marks, "doc_id", "left")
            .select("part", "doc_id", "A", "B", "C", "D", F.col("first").isNull().alias("E"),
                    F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")))


def postings(failed: DataFrame) -> DataFrame:
    """POSTINGS rows, one for each part and id range: the ascending ``ids`` and, for
    each list, the places in them (rows that share a doc_id have a place each)."""
    failed = C.stage(failed, "failures")
    spark = failed.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), failed.count() // (8 * RANGE))

    def run(batches):
        part, held = None, []

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            at = {x: pa.array([np.flatnonzero(np.asarray(rows.column(x).combine_chunks().cast(pa.uint8())))],
                              pa.list_(pa.int32())) for x in LISTS}
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.string()), pa.array([rows.column("doc_id").to_numpy()], pa.list_(pa.int64())),
                 *at.values()], names=["part", "ids", *LISTS])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                name = batch.column(0)[at].as_py()
                room = RANGE - sum(b.num_rows for b in held)
                if held and (name != part or not room):
                    yield flush()
                    room = RANGE
                part = name
                end, step = at, batch.num_rows - at
                while step:                                  # last row of this part in the batch
                    while end + step <= batch.num_rows and batch.column(0)[end + step - 1].as_py() == name:
                        end += step
                    step //= 2
                end = min(end, at + room)
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield flush()

    C.small_batches(spark, 10_000)
    return (failed.repartitionByRange(tasks, "part", "doc_id").sortWithinPartitions("part", "doc_id")
            .mapInArrow(run, POSTINGS))


# ------------------------------------------------------------ sorted lists

BLOCK = 1024


def gallop(a: np.ndarray, at: int, x) -> int:
    """Number of values of ``a`` up to x, searched from place ``at`` on by doubled steps."""
    lo, step = at, 1
    while lo + step <= len(a) and a[lo + step - 1] <= x:
        lo += step
        step *= 2
    return lo + int(np.searchsorted(a[lo:lo + step], x, side="right"))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """K-way merge: each round takes the id range up to the least end of the lists'
    next blocks; all lists gallop there, and a range that one list alone holds is
    taken as it is."""
    live = [[a, 0] for a in lists if len(a)]
    out = []
    while len(live) > 1:
        pivot = min(a[min(at + BLOCK, len(a)) - 1] for a, at in live)
        here = []
        for x in live:
            end = gallop(x[0], x[1], pivot)
            if end > x[1]:
                here.append(x[0][x[1]:end])
                x[1] = end
        out.append(here[0] if len(here) == 1 else np.unique(np.concatenate(here)))
        live = [x for x in live if x[1] < len(x[0])]
    out += [a[at:] for a, at in live]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def held_by(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each value of ``a``: is it in ``b``? ``b`` is galloped through, a block of ``a`` at a time."""
    out, at = np.zeros(len(a), dtype=bool), 0
    for lo in range(0, len(a), BLOCK):
        block = a[lo:lo + BLOCK]
        first = gallop(b, at, block[0] - 1)
        at = gallop(b, first, block[-1])
        near = b[first:at]
        if len(near):
            place = np.minimum(np.searchsorted(near, block), len(near) - 1)
            out[lo:lo + BLOCK] = near[place] == block
    return out


# ----------------------------------------------------------------- the audit

SETS = 1 << len(FILTERS)
#: (filter, set of filters before it, as bits)
CELLS = [(f, s) for f in range(len(FILTERS)) for s in range(SETS) if not s >> f & 1]


def sizes(n: int, lists: dict[str, np.ndarray]) -> np.ndarray:
    """Of one range: its documents; |union| of each set; for each of CELLS, the size of
    the difference, and its documents in the lists good and toxic."""
    fails = [lists[x] for x in FILTERS]
    unions = [union([a for f, a in enumerate(fails) if s >> f & 1]) for s in range(SETS)]
    gone = []
    for f, s in CELLS:
        d = fails[f][~held_by(fails[f], unions[s])]
        gone.append((len(d), int(held_by(d, lists["good"]).sum()), int(held_by(d, lists["toxic"]).sum())))
    return np.concatenate([[n], [len(u) for u in unions], np.array(gone).T.ravel()]).astype(np.int64)


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _orders(part: str, total: np.ndarray) -> dict[str, list]:
    """The rows of one part from its summed sizes."""
    n, unions = int(total[0]), total[1:1 + SETS].tolist()
    removed, good, toxic = total[1 + SETS:].reshape(3, len(CELLS)).tolist()
    cell = {c: k for k, c in enumerate(CELLS)}
    orders = list(permutations(range(len(FILTERS))))
    out: dict[str, list] = {c.split()[0]: [] for c in AUDIT.split(", ")}
    shapley = [0] * len(FILTERS)
    for order in orders:
        before = 0
        for step, f in enumerate(order):
            k = cell[f, before]
            shapley[f] += removed[k]
            before |= 1 << f
            alone = cell[f, SETS - 1 - (1 << f)]
            row = (part, "".join(FILTERS[x] for x in order), step + 1, n - unions[before], removed[k],
                   unions[1 << f] - removed[k], removed[alone], good[k], toxic[k])
            for c, x in zip(out, row):
                out[c].append(x)
    out["shapley"] = [shapley[f] for order in orders for f in order]
    return out


def audit(lists: DataFrame) -> DataFrame:
    """AUDIT rows, 600 a part, from POSTINGS rows."""
    def measure(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = {x: batch.column(x)[i].values.to_numpy() for x in LISTS}
                got = sizes(len(batch.column("ids")[i]), held)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("part")[i], len(got)), pa.array(np.arange(len(got), dtype=np.int32)),
                     pa.array(got)], names=["part", "cell", "size"])

    def read_off(batches):
        schema = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
                            for c in AUDIT.split(", ")])
        for batch in batches:
            for i in range(batch.num_rows):
                total = np.array([x["size"] for x in batch.column("sizes")[i].as_py()], dtype=np.int64)
                yield pa.RecordBatch.from_pydict(_orders(batch.column("part")[i].as_py(), total), schema=schema)

    summed = (lists.mapInArrow(measure, "part string, cell int, size long")
              .groupBy("part", "cell").agg(F.sum("size").alias("size"))
              .groupBy("part").agg(F.array_sort(F.collect_list(F.struct("cell", "size"))).alias("sizes")))
    return summed.select("part", "sizes").mapInArrow(read_off, AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley counts."""
    return audit(C.stage(postings(failures(docs, labels)), "postings"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL),
w AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part,
         (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN first_id < w.doc_id THEN 16 ELSE 0 END) AS mask,
         coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, s.step, bits[s.step] AS bit, coalesce(list_sum(bits[1:s.step - 1]), 0)::INTEGER AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
