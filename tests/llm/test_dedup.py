import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from episoda.llm import exact_dedup, queries, simhash
from tests.llm.helpers import SF, awkward_rows, components_by_force, docs_of


def slow_fingerprint(text: str | None) -> int:
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    fps = [slow_fingerprint(t) for _, t in docs]
    root = components_by_force(fps, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash_near_dedup(spark, SF).collect()}
    assert got == {d: (f"{f:016x}", docs[k][0]) for (d, _), f, k in zip(docs, fps, root, strict=True)}


def test_simhash_awkward_rows_and_small_buckets(spark):
    rows = awkward_rows()
    got = simhash.near_duplicates(docs_of(spark, rows), bucket_rows=2).collect()
    want = {(-1 if r[0] is None else r[0], slow_fingerprint(r[1])) for r in rows}
    assert len(got) == len(rows) and {(-1 if r.doc_id is None else r.doc_id, r.fp % 2**64) for r in got} == want
    by = defaultdict(set)
    for r in got:
        by[r.fp].add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("bucket_rows", [4096, 16])
def test_links_lose_no_component(spark, bucket_rows):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(350):  # chains of near copies, and many around one centre
        f = rng.choice(fps[-60:] + fps[:1] * 40)
        for _ in range(rng.randint(0, 3)):
            f ^= 1 << rng.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, bucket_rows)
    assert {v for r in edges.collect() for v in (r.u, r.v)} <= set(signed)
    found = simhash.components(edges)
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))
    for r in found.collect():
        root[at[r.node]] = at[r.root]
    same = lambda x: {frozenset(i for i in range(len(x)) if x[i] == k) for k in set(x)}
    assert same(root) == same(components_by_force(fps, 2))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 11, 28, 63])
def test_bit_sliced_comparison(radius):
    """Groups of one to hundreds in shared planes: exactly the pairs within the radius, whatever the size of a group."""
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 2**63, 300, dtype=np.uint64)
    fps = np.concatenate([fps, fps[:150] ^ (np.uint64(1) << rng.integers(0, 63, 150, dtype=np.uint64)), fps[:90] ^ np.uint64(0b11), fps[:30] ^ np.uint64(0b111)])
    for sizes in ([len(fps)], [2, 3, 1, 64, 65, 0, 130, 305], [1] * 570, [2] * 285):
        starts = np.concatenate([[0], np.cumsum(sizes)])
        mixed = rng.permutation(fps)
        got = [x for a, b in simhash.near_pairs(mixed, starts, radius, jobs=500) for x in zip(a.tolist(), b.tolist())]
        want = [(i, j) for lo, hi in zip(starts, starts[1:]) for i in range(lo, hi) for j in (np.flatnonzero(np.bitwise_count(mixed[i + 1 : hi] ^ mixed[i]) <= radius) + i + 1).tolist()]
        assert sorted(got) == want


def test_every_link_comes_from_the_counters(monkeypatch):
    """Small and large buckets alike: without the bit-sliced comparison there is no link."""
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted((0, rng.randrange(40), 0, rng.getrandbits(6)) for _ in range(200))
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["band", "bucket", "chunk", "fp"])
    made, whole = [], simhash.near_pairs
    monkeypatch.setattr(simhash, "near_pairs", lambda *a, **k: ((made.append(len(x)), (x, y))[1] for x, y in whole(*a, **k)))
    out = [r for b in simhash._buckets(iter([batch.slice(0, 77), batch.slice(77)]), 2, 30) for r in b.to_pylist()]
    assert out and sum(made) >= len(out)
    monkeypatch.setattr(simhash, "near_pairs", lambda *a, **k: iter(()))
    assert not list(simhash._buckets(iter([batch]), 2))


def groups_by_force(rows):
    import re

    by = defaultdict(list)
    for r in rows:
        by[re.sub("[ \t-\r]+", " ", r[1] or "")].append(r[0])
    return by


@pytest.mark.parametrize("budget", [64 << 20, 3000])
def test_exact_groups(spark, budget):
    rows = awkward_rows() * 2
    got = exact_dedup.duplicate_groups(docs_of(spark, rows).repartition(3), budget).collect()
    want = []
    for text, ids in groups_by_force(rows).items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(str(i), str(keep), len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == sorted(want)
    assert sum(r.kept for r in got) == len(groups_by_force(rows)) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_drop_keeps_columns_and_one_row(spark):
    rows = awkward_rows() * 2
    out = exact_dedup.drop_duplicates(docs_of(spark, rows))
    assert out.columns == docs_of(spark, []).columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert len(kept) == len(groups_by_force(rows)) == len(groups_by_force(kept))
    assert exact_dedup.drop_duplicates(docs_of(spark, [])).count() == 0


def test_exact_drop_keeps_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([(1, "a  b", "mine", "yours"), (2, "a b", "mine", "yours"), (2, "a b", "mine", "yours")], "doc_id long, text string, _own_sha string, _SHA string")
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [(1, "a  b", "mine", "yours")]


def test_exact_oracle_on_the_small_table(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op5_exact_dedup"]).fetchall())
    assert sorted(tuple(r) for r in queries.op5_exact_dedup(spark, SF).collect()) == want


def test_trie_spills_by_subtree_and_closes_files():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [b"p" * 50_000, b"p" * 50_000 + b"q", b"p" * 60_000]
    trie = exact_dedup.Trie(4000)
    for i, t in enumerate(texts):
        trie.add(t, [i, i, 1, [i]], exact_dedup._merge)
    assert trie.files
    owners = list(trie.owners(exact_dedup._merge))
    want = defaultdict(list)
    for i, t in enumerate(texts):
        want[t].append(i)
    assert sorted((o[0], o[2], sorted(o[3])) for o in owners) == sorted((v[0], len(v), v) for v in want.values())
    assert all(f.closed for f in trie.files.values())
