"""Ranked lexical search by norm buckets of impact vectors.

An impact vector holds, for each term of the queries that a document has, the whole number the
term adds to a score; a query adds up the coordinates of its terms. Documents are ordered by the
length of their vectors and searched in runs of that order, long ones first, in waves of growing
size; after each wave a query knows the score its last hit has to beat. In a run

* Cauchy-Schwarz, with the longest vector of the run, passes over queries that cannot reach
  their limit there;
* of the other queries, the heaviest terms are added up until the rest, again by Cauchy-Schwarz,
  cannot reach the limit alone, so that only documents with one of these terms are looked at;
* what such a document holds on these coordinates bounds the rest of its score: the remaining
  coordinates are no longer than its length allows;
* documents that may still reach the limit are scored exactly, in integers, over all terms.

Bounds never drop a document that ties with the limit, and with no limit yet all documents with
a term are scored, so the result is that of scoring everything. Queries come in blocks of
bounded size; a block is searched against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.common import running_sums, small_batches, text_bytes
from kerbside.session import broadcast_if, forget, store

HITS = 50
BLOCK = 4_000_000     # bytes of query texts that are searched at once, and travel to the tasks
FIRST, GROWTH = 16_384, 16   # documents of the first wave, and how waves grow
RUN = 16_384          # documents of a run
STEP = 0.9            # vectors of one level of length differ by this factor at most
SLACK = 1e-9          # relative error allowed for in bounds

# term characters are ASCII letters and digits and all bytes beyond ASCII; A-Z become a-z
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text given as UTF-8, in order, with repeats."""
    return text.translate(_TABLE).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _lists(values, ends, kind):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def counted(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(key, n, terms, tf): each document's number of terms, and how often it has those of the
    vocabulary; documents without any term are left out."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = vocabulary.get
        for batch in batches:
            rows, sizes, found, often, ends = [], [], [], [], [0]
            for row, text in enumerate(batch["text"]):
                words = terms(text.as_py())
                if not words:
                    continue
                ids, tf = np.unique(np.array([v for v in map(known, words) if v is not None], "i4"), return_counts=True)
                rows.append(row)
                sizes.append(len(words))
                found.append(ids)
                often.append(tf)
                ends.append(ends[-1] + len(ids))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].take(pa.array(rows, pa.int32())), pa.array(sizes, pa.int64()),
                     _lists(np.concatenate(found), ends, pa.int32()), _lists(np.concatenate(often), ends, pa.int64())],
                    ["key", "n", "terms", "tf"])

    kind = docs.schema[id_column].dataType.simpleString()
    given = small_batches(docs).select(F.col(f"`{id_column}`").alias("key"), text_bytes(f"`{text_column}`").alias("text"))
    return given.mapInArrow(count, f"key {kind}, n long, terms array<int>, tf array<bigint>")


def impacts(found: DataFrame, weights: list[int], documents: int, length: int) -> DataFrame:
    """(key, terms, impacts, norm, level): the impact vectors, and the level of their length, the
    longest lowest. Vectors without a coordinate above zero score nowhere and are left out."""
    def weighed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        w = np.array(weights, "i8")
        for batch in batches:
            ids, tf = batch["terms"].flatten().to_numpy(), batch["tf"].flatten().to_numpy()
            sizes = np.diff(batch["terms"].offsets.to_numpy())
            m = 50 + 50 * batch["n"].to_numpy() * documents // length
            value = w[ids] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, sizes)))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            norm = np.sqrt(np.bincount(owner, value.astype("f8") ** 2, len(sizes)))
            kept = np.flatnonzero(norm > 0)
            held = (value > 0) & (norm[owner] > 0)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[held], minlength=len(sizes))[kept])])
            level = np.floor(np.log(norm[kept]) / math.log(STEP)).astype("i4")
            yield pa.RecordBatch.from_arrays(
                [batch["key"].take(pa.array(kept)), _lists(ids[held], ends, pa.int32()),
                 _lists(value[held], ends, pa.int64()), pa.array(norm[kept]), pa.array(level)],
                ["key", "terms", "impacts", "norm", "level"])

    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(weighed, f"key {kind}, terms array<int>, impacts array<bigint>, norm double, level int")


class Run:
    """Documents of a run with the postings of their terms."""

    def __init__(self, batches: list, size: int) -> None:
        import numpy as np
        import pyarrow as pa

        table = pa.Table.from_batches(batches).combine_chunks()
        self.keys = table["key"].combine_chunks() if table["key"].num_chunks != 1 else table["key"].chunk(0)
        lists = [table[c].combine_chunks() for c in ("terms", "impacts")]
        lists = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in lists]
        ids, value = (c.flatten().to_numpy() for c in lists)
        self.norm = table["norm"].to_numpy()
        self.longest = float(self.norm.max())
        owner = np.repeat(np.arange(len(self.norm)), np.diff(lists[0].offsets.to_numpy()))
        order = np.argsort(ids, kind="stable")
        self.owner, self.value = owner[order], value[order]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=size))])

    def postings(self, ids):
        import numpy as np

        parts = [slice(self.ends[t], self.ends[t + 1]) for t in ids]
        return np.concatenate([self.owner[p] for p in parts]), np.concatenate([self.value[p] for p in parts])

    def scored(self, ids, limit: int):
        """(documents, scores): all whose score is above zero and not below ``limit``; the ids
        are those of the query's terms, the heaviest first."""
        import numpy as np

        none = np.zeros(0, "i8"), np.zeros(0, "i8")
        reach = limit / (self.longest * (1 + SLACK))
        if not len(ids) or math.sqrt(len(ids)) < reach:
            return none
        focus = len(ids) if limit <= 0 else min(len(ids), max(1, math.floor(len(ids) - reach * reach) + 1))
        owner, value = self.postings(ids[:focus])
        n = len(self.norm)
        if focus == len(ids):
            rows = np.unique(owner)
        else:
            held, squares = np.bincount(owner, value, n), np.bincount(owner, value.astype("f8") ** 2, n)
            rows = np.flatnonzero(held)
            # what is lost in subtracting squares is small against the length itself
            rest = np.sqrt(np.maximum(0, self.norm[rows] ** 2 * (1 + SLACK) - squares[rows]))
            rows = rows[(held[rows] + math.sqrt(len(ids) - focus) * rest) * (1 + SLACK) >= limit]
            owner, value = self.postings(ids)
        if not len(rows):
            return none
        place = np.full(n, -1)
        place[rows] = np.arange(len(rows))
        at = place[owner]
        scores = np.zeros(len(rows), "i8")
        np.add.at(scores, at[at >= 0], value[at >= 0])
        good = (scores > 0) & (scores >= limit)
        return rows[good], scores[good]


def _best(scores, keys, missing, hits: int):
    """Positions of the best: high scores, then low keys, null last."""
    import numpy as np

    if len(scores) > 4 * hits:   # far below the last hit nothing needs sorting
        least = np.partition(scores, -hits)[-hits]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    order = np.lexsort((keys[some], missing[some], -scores[some]))
    return some[order[:hits]]


def search(vectors: DataFrame, queries: list[list[int]], limits: list[int], size: int, hits: int = HITS) -> DataFrame:
    """(item, key, score): per task the best ``hits`` documents of each query that reach its limit."""
    def found(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        least = list(limits)
        best: list = [None] * len(queries)
        ids = [np.array(q, "i8") for q in queries]
        kind = None

        def take(run: Run) -> None:
            texts = pa.types.is_string(run.keys.type) or pa.types.is_large_string(run.keys.type)
            missing = run.keys.is_null().to_numpy(zero_copy_only=False)
            keys = run.keys.fill_null("" if texts else 0).to_numpy(zero_copy_only=False)
            for item, q in enumerate(ids):
                rows, scores = run.scored(q, least[item])
                if not len(rows):
                    continue
                mine = scores, keys[rows], missing[rows]
                if best[item] is not None:
                    mine = tuple(np.concatenate([a, b]) for a, b in zip(best[item], mine))
                top = _best(*mine, hits)
                best[item] = tuple(part[top] for part in mine)
                if len(top) == hits:
                    least[item] = max(least[item], int(best[item][0][-1]))

        held, rows = [], 0
        for batch in batches:
            kind = batch.schema.field("key").type
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN:
                take(Run(held, size))
                held, rows = [], 0
        if rows:
            take(Run(held, size))
        for item, hit in enumerate(best):
            if hit is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hit[0]), item), pa.int64()), pa.array(hit[1], kind, mask=hit[2]), pa.array(hit[0])],
                    ["item", "key", "score"])

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.select("key", "terms", "impacts", "norm").mapInArrow(found, f"item long, key {kind}, score long")


def _ranked(rows: DataFrame, hits: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= hits)


def _waves(levels: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of levels, the longest vectors first, that hold about FIRST documents, then GROWTH
    times as many each."""
    waves, begin, held, wanted = [], None, 0, FIRST
    for level, n in sorted(levels):
        begin = level if begin is None else begin
        held += n
        if held >= wanted:
            waves.append((begin, level))
            begin, held, wanted = None, 0, wanted * GROWTH
    return waves + ([(begin, max(level for level, _ in levels))] if begin is not None else [])


def _search_block(docs: DataFrame, texts: list[str], hits: int, id_column: str, text_column: str) -> DataFrame | None:
    """(item, key, score, rank) for a block of query texts, ``item`` their position."""
    vocabulary: dict[bytes, int] = {}
    queries = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms(text.encode()))] for text in texts]
    found = store(counted(docs, vocabulary, id_column, text_column))
    documents, length = found.agg(F.count("*"), F.sum("n")).first()
    if not documents or not vocabulary:
        forget(found)
        return None
    holding = [0] * len(vocabulary)
    # one row for each term of the block
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[row["term"]] = row["count"]
    weights = [weight(documents, df) for df in holding]
    queries = [sorted(q, key=lambda t: (-weights[t], t)) for q in queries]
    vectors = store(impacts(found, weights, documents, length).sortWithinPartitions("level"))
    forget(found)
    levels = [(r["level"], r["count"]) for r in vectors.groupBy("level").count().collect()]
    best, limits = None, [0] * len(queries)
    for low, high in _waves(levels):
        rows = search(vectors.where(F.col("level").between(low, high)), queries, limits, len(vocabulary), hits)
        if best is not None:
            rows = rows.unionByName(best.drop("rank"))
        before, best = best, store(_ranked(rows, hits))
        if before is not None:
            forget(before)
        for row in best.where(F.col("rank") == hits).select("item", "score").collect():   # a row for each query
            limits[row["item"]] = row["score"]
    forget(vectors)
    return best


def ranked(docs: DataFrame, items: DataFrame, hits: int = HITS, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``hits`` best documents of every item, score above zero.

    Null and empty texts have no terms: such documents do not count, such items find nothing.
    Repeated documents are documents of their own; of equal scores low ids come first, null last.
    Repeated items are one; items that share an id but not a text are ranked each. Null item ids
    stay. Ids are integers or strings. Other columns are not read. An empty table of either kind
    gives an empty one.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_column}`").alias("id"), F.col(f"`{item_text_column}`").cast("string").alias("text"))
    asked = asked.where("text IS NOT NULL").distinct().withColumn("size", F.octet_length("text").cast("long") + 1)
    keyed = asked.withColumn("all", F.lit(0)).withColumn("key", F.xxhash64("id", "text"))
    placed = store(running_sums(keyed, "all", "size", ["key", "id", "text"], "begin").withColumn(
        "block", F.expr(f"begin div {BLOCK}")))
    kinds = [docs.schema[id_column].dataType.simpleString(), items.schema[item_column].dataType.simpleString()]
    empty = spark.createDataFrame([], f"{item_column} {kinds[1]}, rank int, {id_column} {kinds[0]}, score long")
    result = empty
    for block in range((placed.agg(F.max("block")).first()[0] or 0) + 1):
        rows = placed.where(F.col("block") == block).orderBy("begin").select("id", "text").collect()
        best = _search_block(docs, [r["text"] for r in rows], hits, id_column, text_column) if rows else None
        if best is None:
            continue
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(rows)], f"item long, id {kinds[1]}")
        result = result.unionByName(best.join(broadcast_if(names, len(rows)), "item").select(
            F.col("id").alias(item_column), F.col("rank").cast("int").alias("rank"),
            F.col("key").alias(id_column), "score"))
    return result
