"""Fill-in-the-middle arrangements against a plain version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from specfold.llm import infill, queries

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain(doc_id, text, seed=42, rate=50, spm=80, marks=infill.SENTINELS):
    text = text or ""
    units = UNIT.findall(text)
    h = [int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    a, b, c = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    p, s, m = marks
    return (len(units), "spm", a, b, c, s + c + p + a + m + b) if h[3] % 100 < spm else (len(units), "psm", a, b, c, p + a + s + c + m + b)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    white = [" ", "  ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]
    word = lambda: "".join(rng.choice("ab<PSM>é漢😀  ") for _ in range(rng.randint(1, 5)))
    text = lambda n: "".join(rng.choice(white) + word() for _ in range(n)) + rng.choice(["", " ", "\n\n"])
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (None, "no id at all"), (5, "has <M> inside"), (6, text(60_000)), (7, "x" * 400_000), (8, "a b"), (8, "a b"), (9, "<<P<S<M< S> P> M> ><")]
    rows += [(i, text(rng.randint(1, 30))) for i in range(20, 220)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("n", "form", "output", "prefix", "_text", "_units", "_h1", "_n")}).repartition(3)


def test_arrangements_and_the_way_back(odd):
    for seed, rate, spm, marks in ((42, 50, 80, infill.SENTINELS), (7, 100, 50, ("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>"))):
        got = infill.arrange(odd, seed, rate, spm, marks).withColumn("back", infill.restored(F.col("output"), F.col("form"), marks)).collect()
        key = lambda r: (r[0] is None, r[0] or 0)
        want = sorted(((r["doc_id"], *plain(r["doc_id"], r["text"], seed, rate, spm, marks), r["text"] or "") for r in odd.collect()), key=key)
        assert sorted(map(tuple, got), key=key) == want
        assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_sentinels_that_text_could_hide():
    for bad in (("<P>", "<S>"), ("<P>", "", "<M>"), ("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<", "<S>", "<M>"), ("<a<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            infill.checked(bad)


def test_query(spark, tmp_path, odd):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    size = lambda t: None if t is None else len(t)
    want = []
    for r in odd.collect():
        n, form, pre, mid, _, out = plain(r["doc_id"], r["text"])
        want.append((r["doc_id"], n, form, size(pre), size(mid), sha(out), sha(r["text"] or "")))
    got = [tuple(r) for r in queries.op11_infill(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    odd.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_infill(spark, str(tmp_path)).count() == 0


def test_units_are_cut_once_and_nothing_moves(spark):
    plan = queries.op11_infill(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Exchange" not in plan and "Python" not in plan
