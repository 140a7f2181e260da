import random
import re

from topicloom.llm import pii_crf as pii

PLAIN = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (
                True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(2)
    for _ in range(30_000):
        text = "".join(rnd.choice("0123456789.@ab-+ ()% é_٣") for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("4111 1111 1111 1111 x 4111111111111112") == [(0, 2, 19)]


def trained():
    rows = []
    for i in range(200):
        rows += pii.training_rows(f"mail joe.b{i}@ex.com, host 10.1.2.{i % 250}; call +1 988 555 {1000 + i} or id {5550000 + i}.").items()
    return pii.Field().fit([(*k, float(n)) for k, n in rows])


def test_field_carries_labels_over_distance():
    field = trained()
    text = "Call +1 (988) 555-2485 now. " + "x " * 500 + "or 988 555 2485; id 1234567, mail joe.b77@ex.com, joe.b77 (at) ex (dot) com, joe.b77."
    base, every = pii.all_spans(text, field)
    assert [text[s:e] for s, k, e in every if (s, k, e) not in base] == ["988 555 2485", "joe.b77 (at) ex (dot) com", "joe.b77"]
    assert set(base) <= set(every) and every == sorted(every)
    clean = "Order 1234567 of 2024, joe writes 988 555 2485 times"
    assert pii.all_spans(clean, field) == ([], [])


def test_redaction_and_ties():
    assert pii.redact("a 1@b.c d", [(2, 0, 7)]) == "a [EMAIL] d"
    # A card inside a phone number: both stay as spans, the text is replaced once.
    text = "+4111 1111 1111 111 "
    spans = [(0, 3, 19), (1, 2, 19)]
    assert pii.redact(text, spans) == "[PHONE] "
    assert pii.digest(spans) == "phone:0:19,card:1:19"


def test_edges(edge_docs, no_docs):
    rows = pii.find_pii(edge_docs, carry=("source",), redacted=True).collect()
    assert len(rows) == edge_docs.count()
    (hit,) = [r for r in rows if r["doc_id"] == 9]
    assert (hit["n_email"], hit["n_phone"], hit["redacted"]) == (1, 1, "mail [EMAIL] or [PHONE] now")
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (1, 2, 3, 4))
    assert next(r for r in rows if r["doc_id"] == 1)["redacted"] is None
    assert pii.find_pii(no_docs).count() == 0


def test_many_mentions_stay_fast():
    text = "a1b2c@x.com " + "555 123 4567 " * 3000
    base, every = pii.all_spans(text, trained())
    assert len(base) == 1 and len(every) >= 1


def test_one_base_mention_labels_hundreds_of_weak_ones():
    weak = ("w " * 30 + "988 555 2485; ") * 300
    for text in ("Call +1 988 555 2485. " + weak, weak + "Call +1 988 555 2485. ", "joe.b7@x.com +1 988 555 2485; " + "988 555 2485; " * 300):
        base, every = pii.all_spans(text, trained())
        added = [text[s:e] for s, k, e in every if (s, k, e) not in base]
        assert added == ["988 555 2485"] * 300
