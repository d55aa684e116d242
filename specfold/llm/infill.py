"""Fill-in-the-middle arrangements of documents, in native Spark SQL.

A text is cut into units, each a word with the white space before it (white space at the end is a unit of its own), so
that the units joined are the text. Two cut points come from the SHA-256 of seed and doc_id; they part the units into
prefix, middle and suffix. A sentinel marks each part, and the arrangement is psm (prefix, suffix, middle)
or spm (suffix, prefix, middle); the hash also says which, and which documents stay plain. restored() parses the
sentinels of an output and gives the text back, exactly.

A null text is the empty text; an empty text, and one that holds a sentinel, stays plain. A null doc_id is hashed as
no digits. Texts of any length are cut as wholes; rows of one doc_id and text, repeated or not, come out alike; an empty table gives
no rows. Further columns are not read, whatever their names.

One projection: nothing is shuffled, and no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"\x20\x09-\x0D"
#: A word with the white space before it, or white space at the end.
UNIT = f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+"
#: Of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")


def checked(sentinels: Sequence[str]) -> tuple[str, str, str]:
    """Three sentinels that can be found again in any text without them: no first character of one stands further on in one, and none begins another."""
    if len(sentinels) != 3 or not all(sentinels):
        raise ValueError("three sentinels are needed: of prefix, suffix and middle")
    if any(a[0] in b[1:] for a in sentinels for b in sentinels) or any(i != k and b.startswith(a) for i, a in enumerate(sentinels) for k, b in enumerate(sentinels)):
        raise ValueError(f"sentinels could not be told from text: {list(sentinels)}")
    return tuple(sentinels)


def _draw(digest: Column, i: int) -> Column:
    """The i-th group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def arrange(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """docs: doc_id, text. `rate` per cent are rearranged, `spm` per cent of these as spm.

    Gives doc_id, n (units), form (plain, psm, spm), prefix, middle, suffix (null if plain) and output.
    """
    p, s, m = checked(sentinels)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"), digest.alias("_digest"))
    rows = rows.select("doc_id", "_text", F.regexp_extract_all("_text", F.lit(UNIT), F.lit(0)).alias("_units"), *[_draw(F.col("_digest"), i).alias(f"_h{i + 1}") for i in range(4)])
    held = F.lit(False)
    for mark in (p, s, m):
        held = held | F.contains("_text", F.lit(mark))
    form = F.when((F.col("_text") == "") | held | (F.col("_h3") % 100 >= rate), "plain").when(F.col("_h4") % 100 < spm, "spm").otherwise("psm")
    cuts = [F.col(h) % (F.size("_units") + 1) for h in ("_h1", "_h2")]
    rows = rows.select("doc_id", "_text", "_units", F.size("_units").alias("_n"), form.alias("form"), F.least(*cuts).cast("int").alias("_from"), F.greatest(*cuts).cast("int").alias("_to"))
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("_units", start, length), ""))
    rows = rows.select(
        "doc_id",
        "_text",
        F.col("_n").cast("long").alias("n"),
        "form",
        part(F.lit(1), F.col("_from")).alias("prefix"),
        part(F.col("_from") + 1, F.col("_to") - F.col("_from")).alias("middle"),
        part(F.col("_to") + 1, F.col("_n") - F.col("_to")).alias("suffix"),
    )
    psm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle")
    spm_ = F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")
    return rows.select("doc_id", "n", "form", "prefix", "middle", "suffix", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm_).otherwise(F.col("_text")).alias("output"))


def _after(text: Column, head: Column, mark: str) -> Column:
    """What follows a head and the mark behind it."""
    return F.substring(text, F.char_length(head) + len(mark) + 1, F.char_length(text))


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text of an output, by its sentinels."""
    p, s, m = checked(sentinels)
    head = F.substring_index(output, m, 1)
    middle = _after(output, head, m)

    def unordered(first: str, second: str) -> tuple[Column, Column]:
        body = F.substring(head, len(first) + 1, F.char_length(head))
        one = F.substring_index(body, second, 1)
        return one, _after(body, one, second)

    prefix, suffix = unordered(p, s)
    late_suffix, late_prefix = unordered(s, p)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(late_prefix, middle, late_suffix)).otherwise(output)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS a,
             CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, a, len(a) AS n, least(h1 % (len(a) + 1), h2 % (len(a) + 1)) AS lo, greatest(h1 % (len(a) + 1), h2 % (len(a) + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, array_to_string(list_slice(a, 1, lo), '') AS pre,
             array_to_string(list_slice(a, lo + 1, hi), '') AS mid,
             array_to_string(list_slice(a, hi + 1, n), '') AS suf FROM c),
o AS (SELECT doc_id, t, n, form, coalesce(pre, '') AS pre, coalesce(mid, '') AS mid, coalesce(suf, '') AS suf FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o
"""
