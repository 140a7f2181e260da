import hashlib
import random

import pytest

from topicloom.llm import fingerprints as fp


def _dp(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_edit_distance_equals_table():
    rnd = random.Random(3)
    for _ in range(400):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 70)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 70)))
        assert fp.edit_distance(a, b) == _dp(a, b)


def test_fingerprint_properties():
    rnd = random.Random(5)
    words = [f"w{rnd.randint(0, 3000)}" for _ in range(4000)]
    text = " ".join(words)
    assert fp.fingerprint(text) == fp.fingerprint(str(text))
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(text)) == 1.0
    changed = text[:9000] + " inserted words here " + text[9000:]
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(changed)) > 0.8
    other = " ".join(f"z{rnd.randint(0, 3000)}" for _ in range(4000))
    assert fp.likeness(fp.fingerprint(text), fp.fingerprint(other)) < 0.3
    assert fp.fingerprint(None) == fp.fingerprint("") == "3::"
    long = " ".join(f"v{rnd.randint(0, 10**6)}" for _ in range(150_000))
    block, sig, sig2 = fp.fingerprint(long).split(":")
    assert int(block) * fp.SIG_LENGTH >= len(long) // 2 and 32 <= len(sig) <= 64 and len(sig2) <= 32
    # One repeated byte never triggers: the block size falls back to the least, one sign covers all.
    block, sig, _ = fp.fingerprint("x" * 1_000_000).split(":")
    assert block == "3" and 1 <= len(sig) <= fp.WINDOW


def _brute(rows):
    """Sequential version of the contract: sort, next row, edit, hash."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        t = text or ""
        nxt = order[(i + 1) % len(order)][1] or ""
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        f, e, g = fp.fingerprint(t), fp.fingerprint(edited), fp.fingerprint(nxt)
        out.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e,
                    fp.likeness(f, e), fp.likeness(f, g)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def _spark_rows(df):
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


@pytest.mark.parametrize("parts", ["1", "5"])
def test_spark_equals_sequential(spark, edge_docs, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = _spark_rows(fp.fingerprint_edits(edge_docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got == _brute(rows)
    assert all(0.0 <= r[5] <= 1.0 and 0.0 <= r[6] <= 1.0 for r in got)


def test_table_of_documents(spark):
    rnd = random.Random(9)
    rows = [(i * 7 % 101, " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "é"]) for _ in range(rnd.randint(0, 300))))
            for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _spark_rows(fp.fingerprint_edits(df)) == _brute(rows)


def test_empty_and_single(spark, no_docs):
    assert fp.fingerprint_edits(no_docs).count() == 0
    one = spark.createDataFrame([(4, "only one text here")], "doc_id long, text string")
    (row,) = fp.fingerprint_edits(one).collect()
    assert row.near_next == 1.0 and row.n_chars == 18
