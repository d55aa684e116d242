"""The ten operators against brute force, and on odd tables."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specfold.llm import components as llm_components
from specfold.llm import chosenpath, curriculum, encode, feistel, fm, imatch, multiindex, packing, queries, records, trigrams, warc
from specfold.llm.common import staged, work_dir
from specfold.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns with the names that operators add.
CLASHES = ("size", "taken", "copies", "spans", "score", "sig", "sequence_id", "offset", "fingerprint", "key", "row", "group_id", "kept", "tokens", "start", "n", "position", "words", "epoch", "target")


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(800)]


@pytest.fixture(scope="module")
def odd(spark, words):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and clashing columns."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, base = text(30_000), text(200)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n ", None, None, 3), (4, long, "en", "b", len(long)), (5, base, "en", "b", len(base)), (6, base, "en", "b", len(base)),
        (7, base + " zz", "en", None, len(base) + 3), (None, "no id here at all", "en", "c", 17), (8, "one two", "de", "c", 7), (9, "one two", "de", "c", None), (10, "x" * 300_000, "de", "c", 300_000), (5, base, "en", "b", len(base)),
        *[(20 + i, text(rng.randint(1, 120)), "en", rng.choice("abcd"), 1) for i in range(60)],
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def local(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path(name))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(docs, name):
    import pyarrow as pa

    texts = [t for _, t in local(docs)] + ["", " ", "  a  b ", "\n\n a\tb  c", "x\x00y z", "a <|endoftext|> b", " ´ é ́a", "a  b", "İ i̇ Σς ΑΣ x", "a.\nB a.b,c!?", "×. ÷, é."]
    coder = encode.PieceEncoder(queries.tokenizer_path(name))
    plain = tokenizer(name)
    for part in (texts[:100], texts[100:], texts[-11:]):
        ids, ends = coder.encode(pa.array(part))
        begin = 0
        for text, end in zip(part, ends, strict=True):
            assert ids[begin:end].tolist() == plain.encode(text, add_special_tokens=False).ids
            begin = end
    encode.MOST_PIECES, old = 50, encode.MOST_PIECES
    try:
        for part in (texts[:50], texts[50:100]):
            ids, ends = coder.encode(pa.array(part))
            assert ids.tolist() == [i for t in part for i in plain.encode(t, add_special_tokens=False).ids]
    finally:
        encode.MOST_PIECES = old


def test_only_known_tokenizers_are_cut(tmp_path):
    import json

    import pyarrow as pa

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        with open(queries.tokenizer_path(name)) as f:
            spec = json.load(f)
        assert encode.can_cut(spec)
        for change in ({"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"post_processor": {"type": "x"}}):
            assert not encode.can_cut(spec | change)
    spec["pre_tokenizer"] = None  # words of many texts are one: pieces would give other ids
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    coder = encode.PieceEncoder(str(path))
    text = "some words, and some more of them"
    assert coder.encode(pa.array([text]))[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs):
    plain = tokenizer("byte_bpe_50k.json")
    length, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        length[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in length.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == 1024 or at & (at - 1) == 0 and at < 1024
    want = Counter()
    for doc, text in docs:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want[doc, ids.tobytes()] += 1
    got = Counter()
    for doc, parts in by_doc.items():
        pieces = sorted(parts, key=lambda r: (r["start"]))
        if len({r["doc_tokens"] for r in pieces}) == 1 and len([r for r in pieces if r["start"] == 0]) == 1:
            raw = b"".join(bytes(r["tokens"]) for r in pieces)
            assert len(raw) == 4 * pieces[0]["doc_tokens"]
            got[doc, raw] += 1
        else:
            got[doc, None] += 1
    single = {k: n for k, n in want.items() if sum(m for (d, _), m in want.items() if d == k[0]) == 1}
    assert all(got[k] == 1 for k in single)
    assert sum(r["length"] for r in rows) == sum(len(b) // 4 * n for (_, b), n in want.items())


def test_packing(docs, odd, spark):
    check_packing(packing.pack(docs, queries.tokenizer_path("byte_bpe_50k.json")).collect(), local(docs))
    check_packing(packing.pack(odd, queries.tokenizer_path("byte_bpe_50k.json"), group_tokens=4096).collect(), local(odd))
    assert packing.pack(docs.limit(0), queries.tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_packing_balances_cost():
    rng = random.Random(3)
    rests = [(i, 0, rng.randint(1, 1000)) for i in range(2000)]
    pieces = packing.assign(list(rests), 1024, 1.0, 1 / 4096)
    fill = Counter()
    for _, _, n, seq, _ in pieces:
        fill[seq] += n
    assert sum(fill.values()) == sum(r[2] for r in rests) and all(n == 1024 or n & (n - 1) == 0 for n in fill.values())
    assert len(pieces) < 2.2 * len(rests)
    # against the plain form: each rest, longest first, to the cheapest sequence that has room, cut where that ends
    total = sum(r[2] for r in rests)
    room, cost, plain = [1024] * (total // 1024), [0.0] * (total // 1024), Counter()
    for doc, _, n in sorted(rests, key=lambda r: (-r[2], r[0])):
        while n and any(room):
            seq = min((s for s in range(len(room)) if room[s]), key=lambda s: (cost[s], s))
            take = min(n, room[seq])
            plain[seq, doc] += take
            room[seq], cost[seq], n = room[seq] - take, cost[seq] + take + take * take / 4096, n - take
    got = Counter()
    for doc, _, n, seq, _ in pieces:
        if seq < total // 1024:
            got[seq, doc] += n
    assert got == plain
    assert max(cost) - min(cost) < 0.25 * max(cost)
    assert packing.assign([], 1024, 1, 1) == []


def test_imatch(docs, odd):
    for df in (docs, odd):
        rows = imatch.fingerprint_edits(df).collect()
        texts = local(df)
        assert len(rows) == len(texts)
        order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))
        if df is docs:
            after = dict(zip([d for d, _ in order], [t for _, t in order[1:]] + [order[0][1]], strict=True))
            edited = {d: t[: len(t) - len(t) // 4] + after[d][: len(t) // 4] for d, t in texts}
            assert all(r["edited_sha256"] == hashlib.sha256(edited[r["doc_id"]].encode()).hexdigest() and r["n_chars"] == len(dict(texts)[r["doc_id"]]) for r in rows)
            assert np.mean([r["near_edited"] for r in rows]) > 0.3 and np.mean([r["near_next"] for r in rows]) < 0.1
        else:
            assert Counter(r["n_chars"] for r in rows) == Counter(len(t) for _, t in texts)
        prints = defaultdict(set)
        known = defaultdict(list)
        for d, t in texts:
            known[d].append(t)
        for r in rows:
            if len(set(known[r["doc_id"]])) == 1:
                prints[known[r["doc_id"]][0]].add(r["fingerprint"])
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert all(len(p) == 1 for p in prints.values())
    assert imatch.fingerprint_edits(docs.limit(0)).count() == 0
    assert imatch.fingerprint_edits(docs.limit(1)).first()["near_next"] == 1.0


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        over = [s for s in free if left * weight[s] / sum(weight[f] for f in free) > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        capped |= set(over)


def test_mixing(docs, odd):
    for df in (docs, odd):
        rows = curriculum.plan(df).collect()
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
        sizes = Counter()
        for r in rows:
            assert r["size"] == size(r["text"] or "")
            sizes[r["source"]] += r["size"]
        want = plain_targets(sizes)
        taken = Counter()
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
            taken[r["source"]] += r["taken"]
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
        mixed = curriculum.mix(df).collect()
        assert sum(size(r["text"]) for r in mixed) == sum(taken.values()) == sum(r["words"] for r in mixed)
        assert [r["position"] for r in mixed] == sorted(r["position"] for r in mixed) and all(0 <= r["position"] <= 1 for r in mixed)
    assert curriculum.plan(docs.limit(0)).count() == 0 and curriculum.mix(docs.where("text is null")).count() == 0


def test_schedules_are_inverted(spark):
    for knots in curriculum.SCHEDULES:
        got = spark.range(101).select(curriculum.inverse_demand(F.col("id") / 100, knots).alias("t")).toPandas().t.to_numpy()
        x = np.linspace(0, 1, 200_001)
        demand = np.concatenate([[0], np.cumsum(np.interp(x, *zip(*knots, strict=True)))[:-1]])
        assert np.allclose(got, np.interp(np.arange(101) / 100, demand / demand[-1], x), atol=1e-4)


def test_warc(spark, tmp_path):
    rows = [(3, "http://a/1", "same"), (1, "http://a/\r\n2", "same"), (2, None, None), (5, "u", ""), (4, "v", "é" * 2000), (None, "w", "same"), (6, "x", "q"), (3, "http://a/1", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("copies", F.lit(1)).repartition(3)
    warc.write(pages, str(tmp_path / "a"))
    got = warc.read(spark, str(tmp_path / "a"), salt_rows=2).collect()
    assert len(got) == len(rows)
    first = {"same": 1, "": 2, "é" * 2000: 4, "q": 6}
    for r in got:
        text = bytes(r["payload"]).decode()
        digest = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        assert f"WARC-Payload-Digest: sha1:{digest}\r\n" in r["header"] and r["header"].startswith("WARC/1.1\r\n") and r["header"].endswith("\r\n\r\n")
        if r["record_type"] == "response":
            assert r["page_id"] == first[text] and r["refers_to"] is None and f"Content-Length: {len(bytes(r['payload']))}\r\n" in r["header"]
        else:
            assert r["refers_to"] == first[text] and "Content-Length: 0\r\n" in r["header"]
        block = b"" if r["record_type"] == "revisit" else bytes(r["payload"])
        assert bytes(r["record"]) == r["header"].encode() + block + b"\r\n\r\n" and r["digest"] == digest
    assert Counter(r["record_type"] for r in got) == {"response": 4, "revisit": 4}
    ids = {re.search(r"WARC-Record-ID: (\S+)", r["header"])[1]: r for r in got}
    assert len(ids) == len(rows)  # repeated and null page_ids too
    for r in got:
        if r["record_type"] == "revisit":
            to = ids[re.search(r"WARC-Refers-To: (\S+)", r["header"])[1]]
            assert to["record_type"] == "response" and to["page_id"] == r["refers_to"] and to["payload"] == r["payload"]
    heads = spark.read.parquet(str(tmp_path / "a" / "headers"))
    heads.withColumn("header", F.regexp_replace("header", "Content-Length: 4\r", "Content-Length: 5\r")).write.parquet(str(tmp_path / "d" / "headers"))
    spark.read.parquet(str(tmp_path / "a" / "payloads")).write.parquet(str(tmp_path / "d" / "payloads"))
    with pytest.raises(Exception, match="does not match its header"):
        warc.read(spark, str(tmp_path / "d")).collect()
    assert spark.read.parquet(str(tmp_path / "a" / "payloads")).count() == 4
    warc.write(pages, str(tmp_path / "b"), min_bytes=3)
    assert Counter(r["record_type"] for r in warc.read(spark, str(tmp_path / "b")).collect()) == {"response": 5, "revisit": 3}
    warc.write(pages.limit(0), str(tmp_path / "c"))
    assert warc.read(spark, str(tmp_path / "c")).count() == 0


def plain_vectors(rows, cosine=0.9):
    """Links counted and components by comparing all pairs, each length by itself; scaled by exact fractions."""
    out = {}
    for size in {len(v) for _, v in rows if v}:
        good = [(i, np.array(v)) for i, v in rows if i is not None and v and len(v) == size and all(c is not None and math.isfinite(c) for c in v) and any(v)]
        if not good:
            continue
        x = np.stack([v / np.abs(v).max() for _, v in good])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = x @ x.T >= cosine
        np.fill_diagonal(link, False)
        part = np.array([i for i, _ in good])
        while True:
            new = np.array([min([part[i], *part[link[i]]]) for i in range(len(part))])
            if (new == part).all():
                break
            part = new
        out |= {g[0]: (int(link[i].sum()), int(part[i])) for i, g in enumerate(good)}
    return out


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    rows = [(i, (centers[i % 40] + rng.normal(0, 0.12, 16)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] * 16), (2005, [float("inf")] + [1.0] * 15), (2006, [1.0] * 5), (None, rows[7][1]), (2007, (np.array(rows[9][1]) * 3).tolist())]
    unlike = rng.normal(size=(6, 5)).tolist()  # another length, and very large and small ones that point the same way
    rows += [(3000 + i, v) for i, v in enumerate(unlike + unlike[:2])] + [(3100, [1e200] * 3), (3101, [1e-200] * 3), (3102, [3e300, -3e300, 1e299]), (3103, [3.0, -3.0, 0.1]), (3104, [5e-324, 5e-324, 5e-324]), (3105, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("sig", "copies", "label", "component_id", "kept", "size", "row", "cid", "n_links", "vec")})
    want = plain_vectors(rows)
    got = multiindex.near_duplicates(df, block=64).collect()
    assert len(got) == len(rows)
    for r in got:
        n, part = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (n, part, r["vec_id"] == part)
    assert multiindex.near_duplicates(df.limit(0)).count() == 0
    assert multiindex.near_duplicates(df.where("vec_id = 2000")).count() == 1


def test_multi_sequence_walk_is_sorted():
    rng = np.random.default_rng(5)
    grid = multiindex.Grid(rng.normal(size=(6, 4)), rng.normal(size=(7, 4)))
    a, b = rng.uniform(size=6), rng.uniform(size=7)
    walk = grid.walk([a[None], b[None]], 42)[0].tolist()
    cost = [a[c // 7] + b[c % 7] for c in walk]
    assert sorted(walk) == list(range(42)) and cost == sorted(cost)
    x = rng.normal(size=(50, 8)) * 0.3
    squares = grid.squares(x)
    own = grid.cells(squares)
    every = squares[0][:, :, None] + squares[1][:, None, :]
    for most in (1, 2, 5, 17, 41, 42):  # the nearest cells, whatever their number
        seen = grid.walk(squares, most)
        assert np.allclose(np.take_along_axis(every.reshape(50, 42), seen, 1), np.sort(every.reshape(50, 42), axis=1)[:, :most])
    assert (grid.rank(squares, own) == 1).all()
    for place in (3, 20):
        assert (grid.rank(squares, grid.walk(squares, 42)[:, place]) == place + 1).all()
    a, b = grid.bounds(squares)
    for i in range(50):  # no cell with a near enough vector is passed over
        near = np.flatnonzero(((x - x[i]) ** 2).sum(1) <= 0.5)
        assert (a[i, own[near] // 7] + b[i, own[near] % 7] <= 0.5 + 1e-9).all()


def test_visits_reach_the_recall():
    """Of pairs at the threshold cosine that the calibration has not seen, the traversal of a fine grid misses next to none; it visits few cells."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = multiindex.Grid(multiindex.kmeans(x[:, :16], 128), multiindex.kmeans(x[:, 16:], 128, seed=12))
    most = multiindex.visits(grid, x[:2_000], 0.9, 0.999)
    assert most < 128 * 128 / 4
    for one, other in multiindex.partners(x[3_000:], 0.9, seed=99):
        a, b = grid.squares(one), grid.squares(other)
        met = (grid.rank(a, grid.cells(b)) <= most) & (grid.rank(b, grid.cells(a)) <= most)
        assert np.allclose((one * other).sum(1), 0.9) and met.mean() > 0.995
    line = np.ones((5, 1))
    assert multiindex.visits(multiindex.Grid(line, line), line, 0.9, 0.999) == 25  # no direction to go: all cells


def test_pii(odd, spark):
    key = b"k"
    text = "Mail und.34@mail7.example.com, card 4845168114407329 or 4845-1681-1440-7329, not 4845168114407328; +1 (017) 555-7713 on 97.51.17.173, born 1999-02-28 (28.02.1999, 12/31/1999), GB82 WEST 1234 5698 7654 32, 123-45-6789; id 999.999.1.1, 2021-02-30, v1.2.3.4.5"
    spans = feistel.found(text, key)
    assert [k for *_, k, _ in spans] == ["email", "card", "card", "phone", "ip", "date", "date", "date", "iban", "ssn"]
    new = feistel.replaced(text, spans)
    assert all(text[a:b] not in new for a, b, *_ in spans) and "4845168114407328" in new and "2021-02-30" in new and "999.999.1.1" in new
    by = {k: [n for *_, kk, n in spans if kk == k] for *_, k, _ in spans}
    assert feistel.luhn(by["card"][0]) and by["card"][1].replace("-", "") == by["card"][0] and by["phone"][0].startswith("+1 (")
    a, b = by["date"][:2]
    assert "-".join(reversed(b.split("."))) == a
    assert feistel.replaced(new, feistel.found(new, key, True)) == text
    for size in (2, 10, 97, 1000):
        assert sorted(feistel.permute(key, "t", i, size) for i in range(size)) == list(range(size))
        assert all(feistel.permute(key, "t", feistel.permute(key, "t", i, size), size, back=True) == i for i in range(size))
    got = feistel.pseudonymize(odd, key)
    assert got.columns == ["doc_id", "text", "spans"] and Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect())
    assert feistel.pseudonymize(odd.limit(0), key).count() == 0
    two = spark.createDataFrame([(1, "a@b1.com x"), (2, "y a@b1.com")], "doc_id long, text string")
    assert len({re.search(r"\S+@\S+", r["text"])[0] for r in feistel.pseudonymize(two, key).collect()}) == 1


def test_records(docs, odd, spark, tmp_path):
    plain = tokenizer("word_bpe_49k.json")
    for i, df in enumerate((docs, odd)):
        folder = str(tmp_path / str(i))
        records.write(df, folder, queries.tokenizer_path("word_bpe_49k.json"), file_bytes=20_000)
        got = records.read(spark, folder).collect()
        want = Counter((d, np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for d, t in local(df))
        assert Counter((r["doc_id"], bytes(r["tokens"])) for r in got) == want
        at = 0
        ordered = sorted(got, key=lambda r: r["start"])
        for r in ordered:
            assert r["start"] == at and r["n_tokens"] == len(r["tokens"]) // 4
            at += r["n_tokens"]
        ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in ordered]
        assert ids == sorted(ids)
        index = records.index(spark, folder).collect()
        assert Counter((r["doc_id"], r["start"], r["n_tokens"]) for r in index) == Counter((r["doc_id"], r["start"], r["n_tokens"]) for r in got)
        mixed = [(r["doc_id"], bytes(r["tokens"])) for r in records.read_shuffled(spark, folder, 5).collect()]
        assert Counter(mixed) == want and mixed != [(r["doc_id"], bytes(r["tokens"])) for r in ordered]
        some = [(r["doc_id"], bytes(r["tokens"])) for r in records.read_shuffled(spark, folder, 5, share=0.3).collect()]
        assert some == mixed[: len(some)] and 0 < len(some) < len(mixed)
    records.write(docs.limit(0), str(tmp_path / "none"), queries.tokenizer_path("word_bpe_49k.json"))
    assert records.read(spark, str(tmp_path / "none")).count() == 0
    data = bytearray(records.frame(b"abc") + b"\n")
    assert [bytes(p) for _, p in records.frames(memoryview(data))] == [b"abc"]
    for at in (0, 13, 16):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(memoryview(broken)))
    with pytest.raises(ValueError):
        list(records.frames(memoryview(data[:-2])))


def test_quality(odd, spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fm.train(docs, labels)
    scored = fm.score(docs, model).join(labels, "doc_id").where(fm.held_out()).toPandas()
    assert ((scored.score >= 0.3) == scored.quality).mean() > 0.97
    rows = fm.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    again = fm.train(docs, labels)
    assert np.array_equal(again.factors, model.factors) and again.bias == model.bias
    assert fm.score(odd.limit(0), model).count() == 0
    assert 0.4 < fm.score(odd, fm.train(docs, labels.limit(0))).first()["score"] < 0.6
    one = fm.train(odd, spark.createDataFrame([(20, 1), (21, 1), (None, 0), (22, None)], "doc_id long, quality int"))
    assert fm.score(odd, one).agg(F.min("score")).first()[0] > 0.5


def test_factorised_pairs_equal_the_double_sum():
    rng = np.random.default_rng(6)
    model = fm.Model(0.5, rng.normal(size=fm.SIZE).astype("f4"), rng.normal(size=(fm.SIZE, 3)).astype("f4"), None, None)
    idx, val = rng.integers(0, fm.SIZE, 7).astype("i4"), rng.normal(size=7).astype("f4")
    want = 0.5 + sum(val * model.linear[idx]) + sum(val[i] * val[j] * (model.factors[idx[i]] @ model.factors[idx[j]]) for i in range(7) for j in range(i))
    assert np.isclose(model.raw(fm.Rows(np.array([0, 7]), idx, val))[0][0], want, rtol=1e-4)


def test_secrets(docs, odd, spark):
    extra = ['my PassWD = "abc123" and api-key: x', "API_KEY:abcdefg apikey='1234567'", "token=abc", "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "deadbeef" * 3, "deadbeef" * 2, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36, "xoxb-" + "1a" * 6, "pass\nword=abcdef", "secret : sſcret=abcdef"]
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    for df in (docs, odd, more):
        got = Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in trigrams.scan(df).collect())
        want = Counter()
        for d, t in local(df):
            found = sorted((a, n, b) for n, r in enumerate(trigrams.BASE + trigrams.MORE) for a, b in trigrams.spans_of(r, r.compiled(), t))
            want[d, tuple(((trigrams.BASE + trigrams.MORE)[n].kind, a, b) for a, n, b in found)] += 1
        assert got == want
    assert sum(len(s) for _, s in got) >= 8 and trigrams.scan(docs.limit(0)).count() == 0


def test_trigram_queries():
    q = {r.kind: trigrams.query_of(r) for r in trigrams.BASE}
    assert q["hex"] is None and q["access"] == ("and", (b"aki", b"kia")) and q["assign"][0] == "or"
    index = trigrams.Index([b"abc", b"bcd"])
    raw = np.frombuffer(b"xABCDab" + b"cdabc" + b"bcd", np.uint8)
    index.fill(raw, np.array([0, 7, 12, 15]))
    assert index.postings[b"abc"].tolist() == [0, 1] and index.candidates(("and", (b"abc", b"bcd"))).tolist() == [0] and index.candidates(("or", (b"abc", b"bcd"))).tolist() == [0, 1, 2]


def plain_join(docs, similarity=0.8):
    def grams(t):
        w = [x for x in re.split(r"[ \t\n\r\x0b\x0c]+", t.lower()) if x]
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [(i, d, grams(t)) for i, (d, t) in enumerate(docs) if d is not None]
    sets = [x for x in sets if x[2]]
    links, part = Counter(), {i: d for i, d, _ in sets}
    pairs = [(a, b) for n, a in enumerate(sets) for b in sets[:n] if len(a[2] & b[2]) >= similarity * len(a[2] | b[2]) - 1e-9]
    for a, b in pairs:
        links[a[0]] += 1
        links[b[0]] += 1
    while True:
        moved = False
        for a, b in pairs:
            low = min(part[a[0]], part[b[0]])
            moved |= part[a[0]] != low or part[b[0]] != low
            part[a[0]] = part[b[0]] = low
        if not moved:
            return Counter((d, links[i], part.get(i, d)) for i, (d, _) in enumerate(docs))


def test_jaccard_join(odd, spark, words, docs):
    rng = random.Random(7)
    base = [rng.choice(words) for _ in range(150)]
    rows = [(i, " ".join(base)) for i in range(30)]
    for i in range(30, 200):  # one large group of near copies
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(w)))
    shared = " ".join(rng.choice(words) for _ in range(40))
    rows += [(i, shared + " " + " ".join(rng.choice(words) for _ in range(100))) for i in range(200, 330)]  # a passage in many documents
    many = spark.createDataFrame(rows, "doc_id long, text string")
    for df, how in ((many, {"small": 16, "most": 60, "block": 32}), (many, {"small": 16}), (odd, {}), (docs, {"small": 4, "most": 20, "block": 8})):
        got = chosenpath.join(df, **how).collect()
        assert Counter((r["doc_id"], r["n_links"], r["group_id"]) for r in got) == plain_join(local(df))
        leaders = Counter(r["group_id"] for r in got if r["kept"] and r["doc_id"] is not None)
        assert all(n == 1 for n in leaders.values())
    assert chosenpath.join(docs.limit(0)).count() == 0


def near_copies(n, words, seed=12):
    """n texts, each one text with a few words changed."""
    rng = random.Random(seed)
    base = [rng.choice(words) for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(150)] = f"{rng.choice(words)}{i}"
        out.append((i, " ".join(w)))
    return out


def test_jaccard_join_of_one_large_group_grows_in_proportion(spark, words):
    """Candidates and the rows that are verified, for a group four times as large."""
    made = []
    for n in (1_000, 4_000):
        rows = near_copies(n, words)
        folder = work_dir(spark)
        classes = chosenpath.sketch(spark.createDataFrame(rows, "doc_id long, text string"), 5).select(F.col("doc_id").alias("cid"), "sig", "n", "sketch", "short")
        classes = staged(classes.dropDuplicates(["sig"]), folder, "classes")
        found = chosenpath.candidates(classes, folder, 8, 128, 16_384, 4_096, 0.8)
        made.append(found.count() / classes.count())
        stars = components(found, f"{folder}/c")
        assert stars.count() == classes.count() - 1  # one group
    assert made[1] < 1.3 * made[0]


def test_shared_grams():
    rng = np.random.default_rng(14)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 120))) for _ in range(150)]
    grams, doc = np.concatenate(sets).astype(np.uint64), np.repeat(np.arange(150), [len(x) for x in sets])
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    everything = np.arange(150)
    got = chosenpath.shared_grams(grams, doc, everything, everything, rare=30)
    np.fill_diagonal(want, 0)
    assert (got == want).all()
    left, right = rng.permutation(150)[:60], np.setdiff1d(everything, rng.permutation(150)[:60])
    left = np.setdiff1d(everything, right)
    assert (chosenpath.shared_grams(grams, doc, left, right, rare=30) == want[np.ix_(left, right)]).all()


def test_components(spark, monkeypatch):
    monkeypatch.setattr(llm_components, "EDGES", 10)  # so that rounds are needed

    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(200)] + [(rng.randint(300, 500), rng.randint(300, 500)) for _ in range(120)] + [(600, i) for i in range(601, 700)]
    part = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4), work_dir(spark)).collect()}
    assert got == {n: p for n, p in part.items() if n != p}
    monkeypatch.undo()
    assert got == {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4), work_dir(spark)).collect()}
    assert components(spark.createDataFrame([], "a long, b long"), work_dir(spark)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    import sys

    sys.path.insert(0, "tests")
    from oracle import check

    if name in queries.ORACLES:
        check(spark, queries.QUERIES[name], queries.ORACLES[name], SF)
    else:
        assert queries.QUERIES[name](spark, SF).count() > 0


def test_pipeline(spark, odd):
    import corpus_pipeline

    odd = odd.withColumns({c: F.lit("clash") for c in ("_c", "_start", "_size", "_hash", "_tie", "_source", "carried", "class_id", "n_links")})
    for start in (spark.read.parquet(f"{SF}/documents.parquet"), odd, odd.limit(0)):
        frames, now = {}, start
        folder = work_dir(spark)
        for name, f in corpus_pipeline.STAGES:
            now = frames[name] = staged(f(spark, now, SF), folder, name)
            if name != "packing":
                assert now.columns == start.columns
                extra = [c for c in start.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
                assert not extra or now.where(" or ".join(f"`{c}` is distinct from 'clash'" for c in extra)).count() == 0
        ids = lambda n: Counter(r["doc_id"] for r in frames[n].select("doc_id").collect())
        assert ids("near_duplicates") <= ids("quality") and ids("pii") == ids("near_duplicates")
        assert set(ids("mixing")) <= set(ids("pii")) and set(ids("packing")) == set(ids("mixing"))
        kept = frames["quality"]
        want = {d for (d, _, g) in plain_join(local(kept)) if d == g}
        assert set(ids("near_duplicates")) == want
        plain = tokenizer("byte_bpe_50k.json")
        assert frames["packing"].agg(F.sum("length")).first()[0] == (sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for _, t in local(frames["mixing"])) or None)
        for r in frames["pii"].collect():
            assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_embeddings_sparse_links_in_a_fine_grid(spark):
    """Few links near the threshold, none of them in a probe of some hundred vectors, none lost."""
    rng = np.random.default_rng(17)
    x = rng.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(60):
        c = 0.9005 + 0.02 * i / 60
        u = rng.normal(size=64)
        u -= (u @ x[i]) * x[i]
        x[10_000 + i] = c * x[i] + math.sqrt(1 - c * c) * u / np.linalg.norm(u)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in multiindex.near_duplicates(df).where("n_links > 0").collect()}
    assert got == {v: (1, i) for i in range(60) for v in (i, 10_000 + i)}


def test_embeddings_of_a_chain(spark):
    """Many vectors of one component with few links each."""
    n, step = 5_000, math.acos(0.95)
    rows = []
    for i in range(n):  # each next vector turns by less than the limit into a direction of its own
        v = np.zeros(40)
        turn = i * step
        v[i // 40 % 38] = 1e-3
        v[38], v[39] = math.cos(turn), math.sin(turn)
        rows.append((i, v.tolist()))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in multiindex.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == plain_vectors(rows)


def test_blocks_of_cells():
    first, parts = multiindex.packed(np.array([0, 3, 4, 25, 0, 2, 9, 1]), 10)
    assert first[[1, 2, 3, 5, 6, 7]].tolist() == [0, 0, 1, 4, 5, 5] and parts.tolist() == [1, 1, 1, 3, 1, 1, 1, 1]


def test_pii_against_plain_validators(docs):
    """Values found by plain means are all replaced by values of their format, one to one; all else stays."""

    def plain(text):
        for m in re.finditer(r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?!\w)", text):
            yield "email", m.span()
        for m in re.finditer(r"(?<![\w.,-])\d{4}-\d{2}-\d{2}(?![\w-])(?![.,]\d)", text):
            y, mo, d = map(int, m[0].split("-"))
            if 1900 <= y <= 2099 and 1 <= mo <= 12 and 1 <= d <= [31, 28 + (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)), 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][mo - 1]:
                yield "date", m.span()
        for m in re.finditer(r"(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w])(?!\.\d)", text):
            if all(p == str(int(p)) and int(p) < 256 for p in m[0].split(".")):
                yield "ip", m.span()

    new_of, old_of, seen = {}, {}, Counter()
    for r in feistel.pseudonymize(docs, b"k").join(docs.select("doc_id", F.col("text").alias("old")), "doc_id").collect():
        old, new = r["old"] or "", r["text"] or ""
        spans = [(s["start"], s["end"], s["kind"]) for s in r["spans"]]
        if any(k == "ip" for *_, k in spans):  # the only format whose length may change
            count = lambda t: Counter(k for k, _ in plain(t))
            assert count(old)["ip"] == count(new)["ip"] and count(old)["email"] == count(new)["email"]
            seen["ip"] += 1
            continue
        assert len(old) == len(new)
        inside = {i for a, b, _ in spans for i in range(a, b)}
        assert all(x == y for i, (x, y) in enumerate(zip(old, new, strict=True)) if i not in inside)
        for kind, (a, b) in plain(old):
            assert any(x <= a and b <= y for x, y, _ in spans)
            if (a, b, kind) in spans:
                seen[kind] += 1
                assert (kind, (a, b)) in list(plain(new))
        for a, b, kind in spans:
            if kind in ("email", "ip", "ssn", "iban"):
                assert new_of.setdefault((kind, old[a:b]), new[a:b]) == new[a:b] and old_of.setdefault((kind, new[a:b]), old[a:b]) == old[a:b]
    assert seen["email"] > 3


def test_pii_key(spark):
    spark.conf.unset("spark.specfold.pii.key")
    key = queries.pii_key(spark)
    assert len(key) == 64 and queries.pii_key(spark) == key
    spark.conf.set("spark.specfold.pii.key", "own")
    assert queries.pii_key(spark) == b"own"
    spark.conf.unset("spark.specfold.pii.key")


def test_quality_learns_from_one_row_a_doc_id(spark):
    """Rows that share a doc_id reach the driver once, and texts within the byte limit only."""
    docs = spark.createDataFrame([(i % 40, f"word{i % 40} common", "l", "s", 5) for i in range(4_000)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    plain = docs.dropDuplicates(["doc_id"])
    assert np.array_equal(fm.train(docs, labels).factors, fm.train(plain, labels).factors)
    few = fm.train(docs, labels, fit_bytes=100)
    assert np.count_nonzero(few.linear) < np.count_nonzero(fm.train(docs, labels).linear)


def test_imatch_of_a_hot_doc_id(spark, words):
    """Rows of one doc_id are split over parts; each is followed by the next in order."""
    rng = random.Random(21)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 40))) for _ in range(60)]
    rows = [(7, rng.choice(texts)) for _ in range(400)] + [(None, texts[0])] * 200 + [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt, parts = imatch.with_next(df)
    sizes = dealt.where("not _ahead").groupBy("_part").count().collect()
    assert len(sizes) == parts and max(r["count"] for r in sizes) < 2 * len(rows) / parts
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in imatch.fingerprint_edits(df).collect())
    tie = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for t in texts], "text string").withColumn("h", F.xxhash64("text")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    want = Counter()
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        want[d, len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + after[: len(t) // 4]).encode()).hexdigest()] += 1
    assert got == want


def test_pii_candidates_that_run_on():
    """Valid numbers followed by more digits or words, which alone make no valid number."""
    key = b"k"
    for text, want in (
        ("4111111111111111 123", ["4111111111111111"]),
        ("card 4111 1111 1111 1111 12/27 ok", ["4111 1111 1111 1111"]),
        ("4111-1111-1111-1111-123", ["4111-1111-1111-1111"]),
        ("4111111111111111 4845168114407329", ["4111111111111111", "4845168114407329"]),
        ("pay AT61 1904 3002 3457 3201 BIC now", ["AT61 1904 3002 3457 3201"]),
        ("no card 4111 1111 1111 1112 123", []),
    ):
        spans = feistel.found(text, key)
        assert [text[a:b] for a, b, *_ in spans] == want
        new = feistel.replaced(text, spans)
        assert len(new) == len(text) and not any(w in new for w in want)
