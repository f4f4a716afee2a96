"""Ranked search, sharding and clustering against plain versions, with odd rows in every table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import centroids, ranking, sharding

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_ranking(docs, items, hits):
    """Every document scored for every item."""
    found = [(i, Counter(words(t))) for i, t in docs if words(t)]
    total, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, counts in found:
            m = 50 + 50 * sum(counts.values()) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * counts[t] // (1000 * counts[t] + 20 * m)) for t in set(words(text)) if counts[t])
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:hits], 1)]
    return out


def corpus(rows, seed=1):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "日本語", "ÀÉ"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(pick.choices(vocabulary, weights, k=pick.choice([1, 3, 10, 40, 300]))) for _ in range(rows)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (5, texts[9]), (None, texts[7]), (900, None), (901, ""), (902, "!?")]
    docs += [(1000 + i, "w1 W2, w3 tie") for i in range(30)] + [(2000, "w5 " * 30000)]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([1, 4, 12])))) for i in range(12)]
    items += [(50, "tie"), (51, None), (52, ""), (53, "w1 w1 W1"), (53, "w2"), (None, "w3 absent"), (50, "tie"), (54, "absent")]
    return docs, items


def frames(spark, docs, items, kind="long"):
    docs = [(i if kind == "long" or i is None else f"k{i}", t, 1, "t", 2, 3) for i, t in docs]
    return (spark.createDataFrame(docs, f"doc_id {kind}, text string, item long, `key` string, score int, rank int").repartition(3),
            spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id int, `key` string"))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ranking_equals_scoring_everything(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "FIRST", 20)
    monkeypatch.setattr(ranking, "GROWTH", 2)
    monkeypatch.setattr(ranking, "BLOCK", 120)
    docs, items = corpus(200)
    got = ranking.ranked(*frames(spark, docs, items, kind), hits=7).collect()
    named = [(i if kind == "long" or i is None else f"k{i}", t) for i, t in docs]
    plain = plain_ranking([(i if i is not None else None, t) for i, t in docs], items, 7) if kind == "long" else None
    if plain is None:   # string ids order as text
        found = {}
        for item, rank, doc, score in plain_ranking([(n, t) for n, (_, t) in enumerate(named)], items, 10_000):
            found.setdefault((item, rank is None, score), []).append(named[doc][0])
        plain_scores = Counter((item, score) for item, _, doc, score in plain_ranking(docs, items, 7))
        assert Counter((r["item_id"], r["score"]) for r in got) == plain_scores
        for r in got:
            assert any(item == r["item_id"] and s == r["score"] and r["doc_id"] in ids for (item, _, s), ids in found.items())
    else:
        assert Counter(map(tuple, got)) == Counter(plain)
    assert not {51, 52, 54} & {r["item_id"] for r in got}


def test_a_run_keeps_all_that_reach_the_limit():
    import pyarrow as pa

    pick = np.random.default_rng(3)
    docs = [np.unique(pick.integers(0, 40, pick.integers(1, 12))) for _ in range(300)]
    value = [pick.integers(1, 1000, len(d)) * 10 ** pick.integers(0, 4) for d in docs]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(300)), pa.array([d.tolist() for d in docs]), pa.array([v.tolist() for v in value]),
         pa.array([float(np.sqrt((v.astype(float) ** 2).sum())) for v in value])], ["key", "terms", "impacts", "norm"])
    run = ranking.Run([batch], 40)
    for _ in range(200):
        query = pick.permutation(40)[:pick.integers(1, 10)]
        exact = np.array([v[np.isin(d, query)].sum() for d, v in zip(docs, value)])
        for limit in (0, 1, int(np.sort(exact)[-3]), int(exact.max()), int(exact.max()) + 1):
            rows, scores = run.scored(query, limit)
            want = {(i, s) for i, s in enumerate(exact.tolist()) if s > 0 and s >= limit}
            assert set(zip(rows.tolist(), scores.tolist())) == want


def test_ranking_of_empty_tables(spark):
    docs, items = frames(spark, *corpus(20))
    none = docs.where(F.lit(False))
    for result in (ranking.ranked(none, items), ranking.ranked(docs, items.where(F.lit(False))),
                   ranking.ranked(docs.withColumn("text", F.lit(None).cast("string")), items)):
        assert result.columns == ["item_id", "rank", "doc_id", "score"] and result.count() == 0


def shard_rows(n=3000):
    pick = random.Random(5)
    sources = ["hot"] * 12 + ["b"] * 5 + ["c"] * 2 + ["", None]
    rows = [(i, f"text {i} é" * pick.randint(0, 20), pick.choice(sources)) for i in range(n)]
    rows += [(7, "copy", "b")] * 40 + [(None, None, None), (None, "", "single"), (8, None, "alone")]
    return rows


def shard_frame(spark, rows):
    named = [(i, t, s, 9, "x", {"a": i}, 1) for i, t, s in rows]
    return spark.createDataFrame(
        named, "doc_id long, text string, source string, size int, `row` string, extra map<string,long>, shard int")


def test_shards_follow_fractional_ranks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "INTERVAL", 100)
    rows = shard_rows()
    docs = shard_frame(spark, rows)
    got = sharding.interleaved(docs.repartition(5), carry=["extra", "shard", "row"]).collect()
    # the plain version sorts everything at once by the same hashes
    hashed = docs.select(
        "doc_id", "text", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"),
        F.xxhash64(F.lit(sharding.SEED), "doc_id", "text").alias("key"),
        F.xxhash64("key", F.xxhash64(F.lit(0), "doc_id", "text", F.to_json(F.struct("extra")), "row")).alias("part")).collect()
    counts, ranks, places = Counter(r["source"] for r in hashed), Counter(), []
    offsets = {s: spark.sql(f"SELECT pmod(xxhash64('{s}', {sharding.SEED}), {1 << 40}) / {float(1 << 40)}D").first()[0] for s in counts}
    for r in sorted(hashed, key=lambda r: (r["part"] % 4096, r["key"])):
        places.append(((ranks[r["source"]] + offsets[r["source"]]) / counts[r["source"]], r["source"], r["doc_id"], r["text"]))
        ranks[r["source"]] += 1
    places.sort(key=lambda p: p[:2])
    n, begins = len(places), Counter()
    want = []
    for number, (_, _, doc, text) in enumerate(places):
        shard = number * 40 // n
        data = (text or "").encode()
        want.append((doc, len(data) + 16, zlib.crc32(data), shard, begins[shard]))
        begins[shard] += 1
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    assert got[0].asDict().keys() == {"doc_id", "size", "text_crc32", "shard", "slot", "extra", "row"}
    assert all(r["extra"] == {"a": r["doc_id"]} for r in got)


def test_shards_match_the_mixture(spark):
    rows = shard_rows(8000)
    docs = shard_frame(spark, rows)
    got = sharding.interleaved(docs).collect()
    again = sharding.interleaved(docs.repartition(7).orderBy(F.desc("doc_id"))).collect()
    assert Counter(got) == Counter(again) and Counter(got) != Counter(sharding.interleaved(docs, seed=1).collect())
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    source = {**{i: s for i, _, s in rows}, 7: "b"}
    shares, total = Counter((r["shard"], source.get(r["doc_id"])) for r in got), Counter(source.get(r["doc_id"]) for r in got)
    names = len(set(source.values()))
    for (shard, name), n in shares.items():
        assert abs(n - total[name] / 40) <= 3 + names * total[name] / len(got)


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = shard_frame(spark, shard_rows(300))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("shard").distinct().count() == 6
    def texts(df):
        return Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())
    assert texts(back) == texts(docs)


def test_sharding_of_small_and_empty_tables(spark):
    docs = shard_frame(spark, shard_rows(5)[:3])
    rows = sharding.interleaved(docs).collect()
    assert len(rows) == 3 and all(r["slot"] == 0 for r in rows) and len({r["shard"] for r in rows}) == 3
    assert sharding.interleaved(docs.where(F.lit(False))).count() == 0


def plain_clusters(rows, k, rounds, length, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in hashed[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        labels = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            own = [x for (_, x), label in zip(kept, labels) if label == j]
            if own:
                centres[j] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *nearest(x)) for i, x in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, d, j in found)


def vectors(n, length, seed=2):
    pick = np.random.default_rng(seed)
    centre = pick.normal(0, 1, (5, length))
    rows = [(int(i), (centre[i % 5] + pick.normal(0, .4, length)).astype("f4").astype(float).tolist()) for i in range(n)]
    rows += [(3, rows[3][1])] * 4 + [(None, rows[4][1]), (None, rows[5][1]), (900, None), (901, []), (902, rows[0][1][:-1])]
    rows += [(903, [None] + rows[0][1][1:]), (904, [float("nan")] + rows[0][1][1:]), (905, [float("inf")] + rows[0][1][1:])]
    return rows + [(906, [0.0] * length), (907, [0.0] * length), (908, [-0.0005] * length)]


def vector_frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, cluster int, x int, scans string").repartition(3)


RESULT = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("k,rounds,kind", [(8, 10, "float"), (3, 4, "double"), (40, 6, "float")])
def test_clusters_equal_plain_rounds(spark, k, rounds, kind):
    rows = vectors(400, 6)
    got = centroids.summary(vector_frame(spark, rows, kind), k=k, rounds=rounds, length=6, scale=50).select(*RESULT).collect()
    assert Counter(map(tuple, got)) == plain_clusters(rows, k, rounds, 6, 50)


def test_bounds_spare_distances(spark):
    labelled, _ = centroids.clusters(vector_frame(spark, vectors(2000, 16)), length=16, rounds=10)
    scans, n = labelled.agg(F.sum("scans"), F.count("*")).first()
    assert n * 8 <= scans < n * 8 * 11 / 2


def test_clusters_of_few_equal_and_no_vectors(spark):
    few = [(i, [1.0, 2.0]) for i in range(3)]
    got = centroids.summary(vector_frame(spark, few), length=2).select(*RESULT).collect()
    assert Counter(map(tuple, got)) == plain_clusters(few, 8, 10, 2, 1024)
    assert {r["cluster"] for r in got} == {0}
    none = centroids.summary(vector_frame(spark, few), length=5)
    assert none.count() == 0 and set(RESULT) <= set(none.columns)
    with pytest.raises(Exception, match="exceeds"):
        centroids.summary(vector_frame(spark, [(1, [1e30, 0.0])]), length=2).collect()
