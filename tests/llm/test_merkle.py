"""Merkle manifests and their proofs against a plain tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from specfold.llm import merkle, queries
from specfold.llm.common import work_dir

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return hashlib.sha256(b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in row)).hexdigest()


def climbed(nodes, arity):
    """The root of nodes and each one's path: (place, siblings) per level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, path in enumerate(paths):
            run = level[at[k] // arity * arity : at[k] // arity * arity + arity]
            path.append((at[k] % arity, run[: at[k] % arity] + run[at[k] % arity + 1 :]))
            at[k] //= arity
        level = [H("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
    return level[0], paths


def plain(rows, arity=8):
    """Per row: doc_id, leaf, subroot, root, path, and the root that the tampered text gives."""
    parts = defaultdict(list)
    if not rows:
        return
    for r in rows:
        parts["" if r[2] is None else "=" + r[2]].append(r)
    subs = {}
    for part, own in parts.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[part] = climbed([leaf(r) for r in own], arity)
    order = sorted(parts, key=lambda p: p.encode())
    root, above = climbed([subs[p][0] for p in order], arity)
    for p, over in zip(order, above, strict=True):
        for r, path in zip(parts[p], subs[p][1], strict=True):
            path = path + over
            lower = r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))) if lower else leaf(r)
            for at, others in path:
                node = H("".join(others[:at] + [node] + others[at:]))
            yield r[0], leaf(r), subs[p][0], root, path, node


def digests(found):
    return Counter((d, lf, sub, root, H("".join("".join(s) for _, s in path)), node, node == root) for d, lf, sub, root, path, node in found)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    text = lambda: rng.choice([None, "", "Some Text", "ÄÖ é漢", "plain " * rng.randint(1, 9)])
    out = [(i, rng.choice(["a", None, "b"]), "hot", rng.choice([None, 4]), text()) for i in range(700)]
    out += [(i, "s", f"l{i % 90}", 3, text()) for i in range(1_000, 1_300)] + [(i, "s", rng.choice([None, "", "é", "Z"]), 3, text()) for i in range(2_000, 2_100)]
    return out + [(None, None, None, None, None), (None, "x", "hot", 1, "A"), (5, "s", "hot", 1, "A"), (5, "s", "hot", 1, "A"), (5, "s", "hot", 1, "B"), (9_999, "s", "one", 9, "Long TEXT " * 50_000)] + [(7, "s", "hot", 1, "Same ROW")] * 200


def test_query(spark, rows, tmp_path):
    clashes = ("part", "doc", "row", "digest", "idx", "n", "level", "beside", "path", "root")
    for some in (rows, rows[:1], [], rows[-1:] * 9):
        spark.createDataFrame(some, SCHEMA).withColumns({c: F.lit("clash") for c in clashes}).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert Counter(map(tuple, queries.op13_manifest(spark, str(tmp_path)).collect())) == digests(plain(some))


@pytest.mark.parametrize("arity", [2, 3])
def test_proofs_of_deep_trees(spark, rows, arity):
    """Several rounds and several cogroups from root to leaf, over parts and over the subroots."""
    folder = work_dir(spark)
    merkle.write(spark.createDataFrame(rows, SCHEMA).repartition(5), folder, arity=arity)
    found = merkle.proofs(spark, folder).withColumn("again", merkle.folded(F.col("path"), F.col("digest"))).collect()
    got = Counter((r["doc"], r["digest"], r["subroot"], r["root"], str([(s["at"], s["siblings"]) for s in r["path"]])) for r in found)
    assert got == Counter((d, lf, sub, root, str(path)) for d, lf, sub, root, path, _ in plain(rows, arity))
    assert all(r["again"] == r["root"] for r in found)


def test_events_in_any_order_give_the_same_links():
    """Children that come in any order and in any batches complete the same parents; what is short of siblings waits."""
    import pyarrow as pa

    rng, n = random.Random(4), 61
    events = [("p", n, 0, i, H(str(i))) for i in range(n)]
    batch = lambda some: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some, strict=True)], ["part", "n", "level", "idx", "digest"])
    run = lambda some: [r for b in merkle.combine(8)(batch(some[i : i + 7]) for i in range(0, len(some), 7)) for r in b.to_pylist()]
    want = run(events)
    assert sum(r["kind"] == merkle.LINK for r in want) == 8 + 1 and [r["digest"] for r in want if r["kind"] == merkle.ROOT] == [climbed([e[4] for e in events], 8)[0]]
    for _ in range(5):
        rng.shuffle(events)
        one, two = run(events[:30]), run(events[30:])
        waiting = [tuple(r[c] for c in ("part", "n", "level", "idx", "digest")) for r in one + two if r["kind"] == merkle.OPEN]
        rng.shuffle(waiting)
        done = [r for r in one + two + run(waiting) if r["kind"] != merkle.OPEN]
        assert sorted(map(str, done)) == sorted(map(str, want))


def test_against_sql(spark):
    from oracle import check

    check(spark, queries.op13_manifest, merkle.ORACLE, "/root/testdata/sf0.001")
