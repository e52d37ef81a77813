"""Mixing, manifest and divergence audit against brute force."""

import collections
import os
import re
import sys
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF_SMALL  # noqa: E402
from test_entry import normal  # noqa: E402

from streamlens.llm import divergence, manifest, mixing, queries  # noqa: E402

Q, SQL = queries.queries(), queries.oracle_sql()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, g string, row int"
ODD = [
    *[(i, f"Word{i % 9} wörd Ünd and t{i % 4}' " * (i % 6), None if i % 3 == 0 else f"l{i % 40:02d}", f"s{i % 7}", i, "x", "y", 1) for i in range(400)],
    *[(None, None, None, None, None, None, None, None)] * 12,
    *[(5, "same text twice same text", "é", "", None, None, None, None)] * 9,
    (900, "", "en", None, 0, None, None, None), (901, "lorem IPSUM " * 40_000, "l01", "s1", 5, None, None, None),
    (902, "日本語 naïve 🙂 naïve \t\n", "l01", "s2", 5, None, None, None), (903, "x" * 60_000, "l01", None, 1, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    odd.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_divergence"])
@pytest.mark.parametrize("where", ["tables", "odd"])
def test_equals_sql(spark, folder, name, where):
    base = SF_SMALL if where == "tables" else folder
    con = duckdb.connect()
    files = f"{base}/documents.parquet" if where == "tables" else f"{base}/documents.parquet/*.parquet"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
    got, want = Q[name](spark, base).toPandas(), con.execute(SQL[name]).df()
    assert normal(got) == normal(want) and len(got)


# ---- manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        b = i // 8 * 8
        out.append((nodes[b:i], nodes[i + 1 : b + 8]))
        i //= 8
    return out


def leaf_of(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def manifest_by_loop(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r.doc_id, r.text), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = tree([x[2] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[g]):
            path = way(trees[g], i) + way(top, k)
            node = leaf_of(r.doc_id, "changed" if r.doc_id == 7 else r.text)
            for left, right in path:
                node = h(*left, node, *right)
            yield r.doc_id, leaf, trees[g][-1][0], top[-1][0], h(*[x for a, b in path for x in a + b]), node, node == top[-1][0]


@pytest.mark.parametrize("height", [0, 1, 4])
def test_manifest_of_any_height(odd, height):
    from pyspark.sql import functions as F

    fields = [F.col("doc_id"), F.col("text")]
    other = [F.col("doc_id"), F.when(F.col("doc_id") == 7, "changed").otherwise(F.col("text"))]
    got = manifest.manifest(odd, "doc_id", "lang", fields, other, height).drop("lang")
    order = [str(x) for x in map(tuple, got.collect())]
    assert sorted(order) == sorted(map(str, manifest_by_loop(odd.collect())))


def test_butterfly_sends_a_row_per_part_and_round(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(manifest, "pin", lambda df, label, real=manifest.pin: sent.append((label, p := real(df, label))) or p)
    rows = spark.range(600).selectExpr("id", "'1' AS g", "sha2(cast(id AS string), 256) AS leaf").coalesce(1)
    out = manifest.butterfly(manifest.tops(manifest.placed(rows, ["id"], 0), 0))
    rounds = [p.count() for label, p in sent if label == "parts"]
    assert rounds == [600] * 5  # the parts, then log8(600) rounds
    assert out.select("node").distinct().count() == 1


def test_manifest_of_nothing(none):
    assert manifest.manifest(none, "doc_id", "lang", [none["text"]]).count() == 0


# ---- mixing


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 1000])
def test_permutation(n):
    assert sorted(mixing.permuted(np.arange(n), n, 7)) == list(range(n))


def targets_by_loop(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, rest, free = {}, float(sum(sizes.values())), set(names)
    while True:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / whole > 3 * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / whole for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            rest -= out[s]
        free -= set(over)


@pytest.mark.parametrize("block, shard, max_rows", [(64, 4096, 1_000_000), (4, 50, 1_000_000), (4, 4096, 30)])
def test_mix(odd, block, shard, max_rows):
    mix = mixing.Mix(odd, block=block, shard=shard, max_rows=max_rows)
    got = mix.taken().collect()
    assert len(got) == len(ODD)
    want = collections.Counter((r[0], r[3], len(re.findall(r"[^\x20\x09-\x0d]+", r[1] or ""))) for r in ODD)
    assert collections.Counter((r.key, r.source, r["size"]) for r in got) == want
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    goal = targets_by_loop(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
    shards = -(-sum(goal.values()) // (block * shard)) + 2
    for s in goal:
        assert abs(taken[s] - goal[s]) <= block * (4 + 2 * shards)
    # no block of a source is used twice as often as another, give or take one
    uses = collections.defaultdict(list)
    for r in mix.slots.groupBy("source", "block").count().collect():
        uses[r.source].append(r["count"])
    assert all(max(u) - min(u) <= 1 for u in uses.values())
    places = mix.slots.groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
    assert all(r["max(slot)"] < shard for r in places) and mix.slots.select("shard", "slot").distinct().count() == mix.slots.count()


def test_mix_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a, b = (sorted(map(tuple, mixing.Mix(d, block=16).slots.collect())) for d in (docs, docs.repartition(5)))
    assert a == b


def test_mix_texts_and_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    mix = mixing.Mix(docs, block=16)
    texts = {(r.shard, r.slot): r.text for r in mix.texts(docs).collect()}
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0d]+", r.text or "") for r in docs.collect()}
    spans = collections.defaultdict(list)
    for r in mix.order().collect():
        spans[r.shard, r.slot].append((r.key, r.start, r.words))
    assert texts == {k: " ".join(w for d, a, n in sorted(v) for w in words[d][a : a + n]) for k, v in spans.items()}
    assert sum(len(t.split(" ")) for t in texts.values()) == sum(r.taken for r in mix.taken().collect())


def test_mix_of_many_sources_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TILE", 8)
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('w ', 40) AS text", "concat('s', id % 100) AS source")
    by = collections.Counter()
    for r in mixing.Mix(docs, block=4).taken().collect():
        by[r.source] += r.taken - r.target / 5
    assert len(by) == 100 and all(abs(v) <= 40 for v in by.values())


def test_mix_of_nothing(none, odd):
    assert mixing.Mix(none).taken().count() == 0
    assert [r.taken for r in mixing.Mix(odd.where("text IS NULL OR text = ''")).taken().collect()] == [0] * 80


# ---- divergence


def test_terms_in_windows(monkeypatch):
    texts = ["Ab ab,AB x'é " * 50, "", None, "日本 " + "y" * 300 + "1y", "tail", "head"]
    want = {(i, t.lower() if t.isascii() else t): n for i, s in enumerate(texts)
            for t, n in collections.Counter(x.lower() if x.isascii() else x for x in re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", s or "")).items()}
    for window in (1 << 20, 40, 7):
        monkeypatch.setattr(divergence, "WINDOW", window)
        found = divergence.terms(pa.array([t or "" for t in texts])).to_pylist()
        assert {(r["text"], r["term"]): r["n"] for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("tile, rows, listed, held", [(256, 200_000, 1000, 400_000), (3, 50, 2, 100)])
def test_small_tiles_blocks_and_lists_give_the_same(spark, folder, monkeypatch, tile, rows, listed, held):
    for name, value in (("TILE", tile), ("BLOCK_ROWS", rows), ("LIST", listed), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = divergence.Audit(spark.read.parquet(f"{folder}/documents.parquet")).report().toPandas()
    assert normal(got) == normal(con.execute(SQL["op13_divergence"]).df())


def test_counts_beyond_a_long_product(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share(F.lit(10**13), F.lit(3 * 10**13), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (10**13 + 1) // (3 * 10**13 + 7)


def test_audit_of_nothing(none):
    assert divergence.Audit(none).report().count() == 0


def test_new_queries_are_registered():
    assert {"op11_mixing", "op12_merkle_manifest", "op13_divergence"} <= set(Q)


def test_tampered_rows_are_found(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in Q["op12_merkle_manifest"](spark, SF_SMALL).collect():
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and re.search("[A-Z]", docs[r.doc_id] or "")
        assert r.verified == (not hit)
