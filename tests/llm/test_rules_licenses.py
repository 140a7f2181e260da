import re
from collections import Counter

import pytest

from topicloom.llm import licenses, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
    }


def test_metrics_match_plain_code(spark, edge_docs):
    texts = [(i, t) for i, t in enumerate(["a b c d e " * 3, "x\ny\nx\n\n \n", "a b c d e f a b c d e", "#*a| <b>$%&", "é\x0bü\x0c z", "a b c d e", "a b c d e f"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    got = quality_rules.apply_rules(docs).collect()
    want = [(r["doc_id"], plain_counts(r["text"])) for r in docs.collect()]
    key = lambda item: (item[0] is None, item[0] or 0, sorted(item[1].items()))
    found = [(r["doc_id"], {k: r[k] for k in want[0][1]}) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    for row in got:
        failed = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_rules_empty_and_thresholds(spark, no_docs):
    assert quality_rules.apply_rules(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "the cat and the dog of a house in the wood " + "x")], "doc_id long, text string")
    assert quality_rules.apply_rules(docs).first()["kept"]
    strict = (quality_rules.Rule("words", "n_words", 100, None),)
    assert not quality_rules.apply_rules(docs, rules=strict).first()["kept"]
    plan = quality_rules.apply_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


MIT = """ * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software. The above copyright notice and this permission notice shall be included.
 * THE SOFTWARE IS PROVIDED "AS IS". IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
BSD = """Redistribution and use in source and binary forms are permitted:\n\nRedistributions of source code must retain it.
Redistributions in binary form must reproduce it.\n\n"""


@pytest.mark.parametrize(
    "text, want",
    [
        (MIT, ["MIT"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + "Neither the name of X nor its staff may be used to endorse or promote it.", ["BSD-3-Clause"]),
        ("Text. Licensed under CC BY-NC 4.0. More", ["CC-BY-NC"]),
        ("This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.", ["GPL-3.0-only", "MIT"]),
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", ["Apache-2.0"]),
        ("nothing here", []), (None, []), ("", []),
    ],
)
def test_license_rules(spark, text, want):
    docs = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, sentences string")
    assert licenses.scan(docs).first()["licenses"] == want


def test_license_edges(edge_docs, no_docs):
    assert licenses.scan(edge_docs).where("size(licenses) = 0").count() == edge_docs.count()
    assert licenses.scan(no_docs).count() == 0


EXAMPLES = {
    "SpdxMit": "SPDX-License-Identifier: MIT", "SpdxApache2": "SPDX-License-Identifier: Apache-2.0",
    "SpdxBsd3": "SPDX-License-Identifier: BSD-3-Clause", "SpdxBsd2": "SPDX-License-Identifier: BSD-2-Clause",
    "SpdxGpl3": "SPDX-License-Identifier: GPL-3.0", "SpdxGpl2": "SPDX-License-Identifier: GPL-2.0",
    "SpdxMpl2": "SPDX-License-Identifier: MPL-2.0", "SpdxOther": "SPDX-License-Identifier: Zlib",
    "MitGrant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "MitNotice": "The above copyright notice and this permission notice shall be included",
    "IscGrant": "Permission to use, copy, modify, and/or distribute this software for any purpose",
    "AsIs": "The software is\nprovided \"as\nis\"", "NoLiability": "In no event shall the authors be liable",
    "BsdGrant": "Redistribution and use in source and binary forms", "BsdSource": "Redistributions of source code must retain it",
    "BsdBinary": "Redistributions in binary form must reproduce it",
    "BsdEndorse": "Neither the name of X may be used to endorse or promote it", "ApacheGrant": "Licensed under the Apache License",
    "ApacheRefuse": "You may not use this file except in compliance with the License", "ApacheObtain": "You may obtain a copy of the License at x",
    "ApacheDisclaim": "Unless required by applicable law or agreed to in writing", "ApacheRef": "the Apache Software License",
    "AgplRef": "AGPL", "LgplRef": "LGPL-2.1", "GplLater": "General Public License, version 2, or any later version",
    "Gpl3Ref": "GPLv3", "Gpl2Ref": "gpl-2", "GplRef": "distributed under the GPL", "MplRef": "Mozilla Public License",
    "GplHope": "in the hope that it will be useful, but without any warranty", "EplRef": "Eclipse Public License",
    "Cc0Ref": "Creative\nCommons Zero", "CcByNcNd": "CC-BY-NC-ND 4.0", "CcByNcSa": "CC-BY-NC-SA", "CcByNc": "CC-BY-NC",
    "CcByNd": "CC-BY-ND", "CcBySa": "CC-BY-SA 4.0", "CcBy": "CC-BY", "MitRef": "under the MIT license", "BsdRef": "under the BSD license",
    "IscRef": "the ISC license", "UnlicenseRef": "free and unencumbered software released into the public domain",
    "PublicDomain": "in the public\n domain", "AllRights": "All rights\n reserved", "Copyright": "Copyright (c) 2020 X",
}


def test_every_sentence_passes_the_gate(spark):
    assert list(EXAMPLES) and set(EXAMPLES) == {name for name, _ in licenses.SENTENCES}
    docs = spark.createDataFrame([(f"Text. {text}. More.", name) for name, text in EXAMPLES.items()], "text string, doc_id string")
    got = {r["doc_id"]: r["sentences"] for r in licenses.scan(docs).collect()}
    assert got == {name: [name] for name in EXAMPLES}
