import random
import re
import zlib
from collections import Counter

import numpy as np

from topicloom.llm import spelling as sp


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(sp.UPPER, sp.LOWER))
            key = "" if doc_id is None else str(doc_id)
            h = zlib.crc32(f"{key}:{run}".encode())
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def test_one_error_search_equals_brute_force():
    rnd = random.Random(2)
    for _ in range(40):
        m = rnd.randint(5, 9)
        words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.choice([m, m + 1]))) for _ in range(60)})
        queries = sorted(w for w in words if len(w) == m)
        alphabet = {c: i + 2 for i, c in enumerate(sorted(set("".join(words))))}
        for exact in (m - m // 2, m // 2):
            got = set()
            # Scheme on the words (right part exact) or on the reversed words (left part exact).
            rev = exact == m // 2 and exact != m - m // 2
            ws = [w[::-1] for w in words] if rev else words
            qs = [w[::-1] for w in queries] if rev else queries
            index = sp.FMIndex(ws, alphabet)
            qi, wi = sp.one_error_matches(index, qs, exact, alphabet)
            got = {(queries[i], words[ws.index(ws[j])] if not rev else ws[j][::-1]) for i, j in zip(qi, wi)}
            for q, w in got:
                assert _near(q, w)
            k = m - exact  # errors allowed in the first k (or, reversed, last k) positions
            want = set()
            for q in queries:
                for w in words:
                    if not _near(q, w):
                        continue
                    if (not rev and w.endswith(q[k:])) or (rev and w.startswith(q[: m - k])):
                        want.add((q, w))
            assert got == want


def test_suffix_array_sorted():
    rnd = np.random.default_rng(4)
    codes = rnd.integers(0, 4, 500)
    sa = sp.suffix_array(codes)
    suffixes = [tuple(codes[i:]) for i in sa]
    assert suffixes == sorted(suffixes)


def test_variants_equal_brute_force(spark):
    rnd = random.Random(7)
    base = ["colour", "color", "colours", "organise", "organize", "realise", "realize", "theatre", "theater",
            "Analyse", "analyze", "naïve", "naive", "café", "cafe", "ÉCOLE", "ecole", "école"]
    rows = []
    for i in range(300):
        # The first of each pair of spellings is met far more often, so it becomes the form.
        words = rnd.choices(base, weights=[8 if j % 2 == 0 else 1 for j in range(len(base))], k=rnd.randint(0, 12))
        if i % 7 == 0:
            words.append("x" * 300)  # a very long run
        rows.append((i, " ".join(words) + " 12ab-cd"))
    rows += [(None, "colour colour colour"), (5, None), (6, ""), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in sp.variant_groups(df).collect())
    assert got == _brute(rows)
    assert any(r[1] is not None for r in got)


def test_sharded_groups_equal_unsharded(spark, monkeypatch):
    rnd = random.Random(11)
    rows = [(i, " ".join("".join(rnd.choice("ab") for _ in range(6)) for _ in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(tuple(r) for r in sp.variant_groups(df).collect())
    monkeypatch.setattr(sp, "SHARD_CHARS", 40)
    assert sorted(tuple(r) for r in sp.variant_groups(df).collect()) == whole == _brute(rows)


def test_empty_and_clashing(edge_docs, no_docs):
    assert sp.variant_groups(no_docs).count() == 0
    out = sp.variant_groups(edge_docs)
    assert out.columns[:3] == ["word", "form", "root"]
    assert sorted(tuple(r) for r in out.collect()) == _brute([(r.doc_id, r.text) for r in edge_docs.collect()])
