import pytest
from pyspark.sql import functions as F

from topicloom.functions.prompts import fill
from topicloom.functions.text import (
    bullets,
    clean_label,
    display_label,
    leading_bytes,
    strip,
    too_long,
    truncate,
    word_count,
)
from topicloom.functions.vectors import cosine, mean_pool, norm, normalise
from topicloom.operators.cleaning import clean_documents, drop_blank
from topicloom.workspace import global_index, keep, range_placed, running_sum


def one(spark, schema, *values, **columns):
    return spark.createDataFrame([values], schema).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_word_count(spark):
    texts = ["a b", "  a\t\nb c ", "", "   ", None, "\x1cx\x1dy"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", word_count(F.col("t")).alias("n")).collect()}
    assert got == {i: None if t is None else len(t.split()) for i, t in enumerate(texts)}


def test_clean_label(spark):
    cases = {
        'Topic: "A"': "A",
        "x [/INST]\nB": "B",
        "A: B: C": "B",
        "D\nE": "D",
        "no colon": "no colon",
        ' "quoted" ': "quoted",
        "Label:\n  Deep seas \n more": "Deep seas",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.l for r in df.select("t", clean_label(F.col("t")).alias("l")).collect()}
    assert got == cases


def test_text_formats(spark):
    t = F.col("t")
    row = one(
        spark, "t string, a array<string>", "x" * 201, ["b", "y" * 201],
        cut=truncate(t, 200), same=truncate(t, 201), list=bullets(F.col("a"), 200),
        shown=display_label(F.lit("Sea"), F.lit(12345)), long=too_long(F.lit("a  b c d e f g h i j")),
        short=too_long(F.lit("a b c d e f g h i j")), bare=strip(F.lit("  a \n")),
    )
    assert row.cut == "x" * 200 + "..." and row.same == "x" * 201
    assert row.list == "- b\n- " + "y" * 200 + "..."
    assert row.shown == "Sea (12,345)" and row.long and not row.short and row.bare == "a"


def test_leading_bytes(spark):
    text = "aé" * 10  # 30 bytes
    row = one(spark, "t string", text, cut=leading_bytes(F.col("t"), 5), all=leading_bytes(F.col("t"), 30))
    assert row.cut == "aéa" and row.all == text


def test_fill_does_not_touch_inserted_text(spark):
    row = one(spark, "a string, b string", "{b}", "B", out=fill("1 {a} 2 {b} 3", a=F.col("a"), b=F.col("b")))
    assert row.out == "1 {b} 2 B 3"


def test_vectors(spark):
    row = one(
        spark, "v array<double>, w array<double>, t array<array<double>>, m array<int>",
        [3.0, 4.0], [0.0, 0.0], [[1.0, 2.0], [3.0, 4.0]], [0, 0],
        unit=normalise(F.col("v")), zero=normalise(F.col("w")), n=norm(F.col("v")),
        self=cosine(F.col("v"), F.col("v")), none=mean_pool(F.col("t"), F.col("m")),
        half=mean_pool(F.col("t"), F.array(F.lit(0), F.lit(1))),
    )
    assert row.unit == pytest.approx([0.6, 0.8]) and row.zero == [0.0, 0.0] and row.n == 5.0
    assert row.self == pytest.approx(1.0) and row.none == [0.0, 0.0] and row.half == [3.0, 4.0]


def test_cleaning(spark):
    long = " ".join(["w"] * 19)
    rows = [
        (1, None, None), (2, "t", None), (3, "", "a b"), (4, "t", " ".join(["w"] * 18)),
        (5, "t", long), (6, "t\tu", "\n".join(["w"] * 18)),
    ]
    df = spark.createDataFrame(rows, "id int, title string, abstract string")
    assert {r.id for r in drop_blank(df).collect()} == {2, 4, 5, 6}
    kept = {r.id: r for r in clean_documents(df).collect()}
    assert set(kept) == {5, 6} and kept[5].text == "t " + long and kept[6].length == 20


def test_ordered_positions(spark):
    # One key holds most rows, so it spans many range buckets.
    rows = [(0 if i % 5 else i % 3 + 1, i, i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    placed = range_placed(df, "k", "o", "t")
    got = {(r.k, r.o): r.s for r in running_sum(placed, "k", "o", F.col("v"), "s").collect()}
    totals, want = {}, {}
    for k, o, v in sorted(rows):
        totals[k] = totals.get(k, 0) + v
        want[k, o] = totals[k]
    assert got == want
    numbered = global_index(df, [F.col("k"), F.col("o").desc()], "n").collect()
    assert [(r.k, r.o) for r in sorted(numbered, key=lambda r: r.n)] == sorted(
        ((k, o) for k, o, _ in rows), key=lambda x: (x[0], -x[1])
    )
    assert sorted(r.n for r in numbered) == list(range(1000))


def test_mean_pool_running_sum_equals_numpy(spark):
    import numpy as np

    from topicloom.functions.vectors import mean_pool

    rnd = np.random.default_rng(1)
    rows = []
    for i in range(30):
        t = rnd.normal(size=(int(rnd.integers(1, 9)), 64))
        m = rnd.integers(0, 2, size=len(t)).astype(float)
        rows.append((i, t.tolist(), m.tolist()))
    df = spark.createDataFrame(rows, "id long, tokens array<array<double>>, mask array<double>")
    got = {r.id: r.v for r in df.select("id", mean_pool(F.col("tokens"), F.col("mask")).alias("v")).collect()}
    for i, t, m in rows:
        t, m = np.array(t), np.array(m)
        want = (t * m[:, None]).sum(axis=0) / max(m.sum(), 1e-9)
        assert np.allclose(got[i], want)


def test_leading_bytes_keeps_genuine_replacement_mark(spark):
    import random

    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a", "é", "€", "😀", "�"]) for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    texts.append("ab�cdef")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (1, 3, 5, 7):
        got = [r[0] for r in df.select(leading_bytes(F.col("t"), limit)).collect()]
        for t, g in zip(texts, got):
            want = ""
            for c in t:
                if len((want + c).encode()) > limit:
                    break
                want += c
            assert g == want, (t, limit)
