import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers

from topicloom.llm import alignment as al

A, B = public_tokenizers.path(al.A_FILE), public_tokenizers.path(al.B_FILE)


def _groups_brute(ea, eb):
    cuts = sorted(set(ea.tolist()) & set(eb.tolist()))
    out, i, j, lo = [], 0, 0, 0
    for c in cuts:
        i2 = int(np.searchsorted(ea, c)) + 1
        j2 = int(np.searchsorted(eb, c)) + 1
        out.append((i, i2, j, j2))
        i, j = i2, j2
    return out


def test_align_equals_common_ends():
    rnd = random.Random(1)
    for _ in range(300):
        total = rnd.randint(1, 200)
        ca = sorted(rnd.sample(range(1, total), min(total - 1, rnd.randint(0, total - 1)))) + [total]
        cb = sorted(rnd.sample(range(1, total), min(total - 1, rnd.randint(0, total - 1)))) + [total]
        ea, eb = np.array(ca), np.array(cb)
        groups = al.groups_of(*al.align(ea, eb))
        assert groups == _groups_brute(ea, eb)
        starts_a, starts_b = np.concatenate(([0], ea[:-1])), np.concatenate(([0], eb[:-1]))
        brute = {(p, q) for p in range(len(ea)) for q in range(len(eb))
                 if max(starts_a[p], starts_b[q]) < min(ea[p], eb[q])}
        assert sorted(zip(*(x.tolist() for x in al.links(ea, eb)))) == sorted(brute)


def test_byte_table_is_a_bijection():
    table = al.byte_level_table()
    assert sorted(table.values()) == list(range(256)) and table["Ġ"] == 32


def _brute(texts):
    tok = al._loaded(A, B)
    per, counter = [], Counter()
    for t in texts:
        pair = tok.tokens([t or ""])[0]
        if pair is None:
            per.append(None)
            continue
        a, b = pair
        ea, eb = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
        sa, sb = ea - tok.a_len[a], eb - tok.b_len[b]
        links = [(int(a[p]), int(b[q])) for p in range(len(a)) for q in range(len(b)) if max(sa[p], sb[q]) < min(ea[p], eb[q])]
        groups = _groups_brute(ea, eb)
        text = ";".join(",".join(map(str, a[x:y])) + "|" + ",".join(map(str, b[u:v])) for x, y, u, v in groups)
        per.append((len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
        counter.update(links)
    top = {}
    for (x, y), c in counter.items():
        top[y] = max(top.get(y, 0), c)
    out = []
    for p in per:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        na, nb, ng, links, digest = p
        out.append((na, nb, ng, len(links), sum(counter[l] == top[l[1]] for l in links),
                    sum(counter[l] for l in links), digest))
    return out


def test_documents_equal_brute_force(spark, edge_docs):
    texts = ["Hello wörld, this is a test.", "Hello there <|endoftext|> and <s> too",
             "naïve café déjà vu — “quotes” 中文 text", "", None, "x" * 500, "tab\there  two  spaces",
             "Hello wörld, this is a test.", "▁ literal piece mark"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in al.align_documents(df, A, B).collect()}
    want = _brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert got[3] == (0, 0, 0, 0, 0, 0, "") and got[4] == got[3] and got[8][0] == 0


def test_edges(spark, edge_docs, no_docs):
    out = al.align_documents(edge_docs, A, B)
    assert out.count() == edge_docs.count()
    assert out.columns[0] == "doc_id"
    assert al.align_documents(no_docs, A, B).count() == 0


def test_parts_equal_whole_texts_and_are_tokenized_once(monkeypatch):
    rnd = random.Random(3)
    pieces = ["a", "foo", " ", "  ", "\n", "\t", "\xa0", "\x1f", "é", "中文", "▁", "<|endoftext|>", "<0x41>", "'s", "12", "!", "x " * 40]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    texts += [" ", "a ", " a", "a \n b", "a\n  b", "▁ a", "one two three " * 30, "y" * 300 + " z"]
    parts, whole = al.Tokenizers(A, B), al.Tokenizers(A, B)
    assert parts.cuts
    whole.cuts = False

    def plain(found):
        return [f and (*f[:5], *(x.tolist() for x in f[5:])) for f in found]

    for kept in (8, 100_000):  # forgotten parts come back the same
        monkeypatch.setattr(al, "CACHE_PARTS", kept)
        for few in (texts[i : i + 40] for i in range(0, len(texts), 40)):
            assert plain(parts.documents(few)) == plain(whole.documents(few))
    assert max(map(len, parts._known)) <= al.LONGEST_KEPT
    # A text of known parts asks neither tokenizer for anything.
    monkeypatch.setattr(parts, "a", None)
    monkeypatch.setattr(parts, "b", None)
    assert parts.documents(["three two one " * 9 + "two"])[0][0] == 28
