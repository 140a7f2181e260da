"""License scans by sentence rules.

A text that mentions licensing at all is cut into sentences; each is normalised and mapped to
the identifier of the first known licence sentence it contains.  The sequence of identifiers is
then matched against ordered rules: a rule names the licence for a run of identifiers, longer
and more specific rules come first and use up what they match.  Both tables become built-in
expressions, so the scan is one projection without shuffles or user functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.text import inputs, let

# Gate of the scan, over raw text: each pattern of SENTENCES needs one of these words.  A space of
# the normalised text stands for a run of other signs here, line breaks too.
GATE = (
    "licen[sc]e|copyright|permission|redistribut|warrant|spdx|liable|endorse|commons|cc0|gpl|unencumbered|"
    "is[^a-z0-9]+provided|cc[^a-z0-9]+(by|attribution)|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved|"
    "required[^a-z0-9]+by[^a-z0-9]+applicable"
)
# Identifier and pattern, over lower-case text with single spaces; the first that is found counts.
SENTENCES = (
    ("SpdxMit", "spdx-license-identifier mit( |$)"),
    ("SpdxApache2", "spdx-license-identifier apache-2.0"),
    ("SpdxBsd3", "spdx-license-identifier bsd-3-clause"),
    ("SpdxBsd2", "spdx-license-identifier bsd-2-clause"),
    ("SpdxGpl3", "spdx-license-identifier gpl-3.0"),
    ("SpdxGpl2", "spdx-license-identifier gpl-2.0"),
    ("SpdxMpl2", "spdx-license-identifier mpl-2.0"),
    ("SpdxOther", "spdx-license-identifier [a-z0-9]"),
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("MitNotice", "above copyright notice and this permission notice shall be included"),
    ("IscGrant", "permission to use copy modify and/?( |-)?or distribute this software for any purpose"),
    ("AsIs", "(software|library|program|material) is provided .{0,60}as is"),
    ("NoLiability", "in no event shall .{0,200}liable"),
    ("BsdGrant", "redistribution and use in source and binary forms"),
    ("BsdSource", "redistributions of source code must retain"),
    ("BsdBinary", "redistributions in binary form must reproduce"),
    ("BsdEndorse", "(neither the name|may not be used|names? of .{0,80}contributors) .{0,120}endorse or promote"),
    ("ApacheGrant", "licensed under the apache license"),
    ("ApacheRefuse", "may not use this file except in compliance with the license"),
    ("ApacheObtain", "may obtain a copy of the license at"),
    ("ApacheDisclaim", "unless required by applicable law or agreed to in writing"),
    ("ApacheRef", "apache (license|licence|software license)"),
    ("AgplRef", "(affero general public licen[sc]e|agpl)"),
    ("LgplRef", "(lesser|library) general public licen[sc]e|lgpl"),
    ("GplLater", "general public licen[sc]e .{0,80}(or .{0,20}any later version|or later)"),
    ("Gpl3Ref", "general public licen[sc]e( as published by .{0,40})? (either )?v(ersion )?3|gplv3|gpl-3"),
    ("Gpl2Ref", "general public licen[sc]e( as published by .{0,40})? (either )?v(ersion )?2|gplv2|gpl-2"),
    ("GplRef", "gnu general public licen[sc]e|under the gpl"),
    ("GplHope", "hope that it will be useful but without any warranty"),
    ("MplRef", "mozilla public licen[sc]e"),
    ("EplRef", "eclipse public licen[sc]e"),
    ("Cc0Ref", "cc0|creative commons zero"),
    ("CcByNcNd", "(cc |commons )(by-nc-nd|attribution-?( )?noncommercial-?( )?noderiv)"),
    ("CcByNcSa", "(cc |commons )(by-nc-sa|attribution-?( )?noncommercial-?( )?sharealike)"),
    ("CcByNc", "(cc |commons )(by-nc|attribution-?( )?noncommercial)"),
    ("CcByNd", "(cc |commons )(by-nd|attribution-?( )?noderiv)"),
    ("CcBySa", "(cc |commons )(by-sa|attribution-?( )?sharealike)"),
    ("CcBy", "(cc |commons )(by|attribution)"),
    ("MitRef", "(under|the) (the )?(terms of the )?(mit|expat) licen[sc]e"),
    ("BsdRef", "(under|the) (a |the )?(terms of the )?([23]-clause )?bsd licen[sc]e"),
    ("IscRef", "(under|the) (the )?isc licen[sc]e"),
    ("UnlicenseRef", "free and unencumbered software released into the public domain|the unlicense"),
    ("PublicDomain", "public domain"),
    ("AllRights", "all rights reserved"),
    ("Copyright", "copyright .{0,10}(19|20)[0-9][0-9]"),
)
# Licence for a run of identifiers, tried in this order.
RULES = (
    ("MIT", ("MitGrant", "MitNotice", "AsIs", "NoLiability")),
    ("MIT", ("MitGrant", "MitNotice", "AsIs")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "AsIs", "NoLiability")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "AsIs", "NoLiability")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("Apache-2.0", ("ApacheGrant", "ApacheRefuse", "ApacheObtain", "ApacheDisclaim")),
    ("Apache-2.0", ("ApacheGrant", "ApacheObtain", "ApacheDisclaim")),
    ("ISC", ("IscGrant", "AsIs", "NoLiability")),
    ("ISC", ("IscGrant", "AsIs")),
    ("ISC", ("IscGrant",)),
    ("GPL-2.0-or-later", ("GplLater", "GplHope")),
    ("GPL-3.0-only", ("Gpl3Ref", "GplHope")),
    ("GPL-2.0-only", ("Gpl2Ref", "GplHope")),
    ("MIT", ("SpdxMit",)),
    ("Apache-2.0", ("SpdxApache2",)),
    ("BSD-3-Clause", ("SpdxBsd3",)),
    ("BSD-2-Clause", ("SpdxBsd2",)),
    ("GPL-3.0-only", ("SpdxGpl3",)),
    ("GPL-2.0-only", ("SpdxGpl2",)),
    ("MPL-2.0", ("SpdxMpl2",)),
    ("Apache-2.0", ("ApacheGrant",)),
    ("Apache-2.0", ("ApacheRef",)),
    ("MIT", ("MitRef",)),
    ("MIT", ("MitGrant",)),
    ("BSD", ("BsdRef",)),
    ("ISC", ("IscRef",)),
    ("AGPL-3.0", ("AgplRef",)),
    ("LGPL", ("LgplRef",)),
    ("GPL-2.0-or-later", ("GplLater",)),
    ("GPL-3.0-only", ("Gpl3Ref",)),
    ("GPL-2.0-only", ("Gpl2Ref",)),
    ("GPL", ("GplRef",)),
    ("MPL-2.0", ("MplRef",)),
    ("EPL", ("EplRef",)),
    ("CC0-1.0", ("Cc0Ref",)),
    ("CC-BY-NC-ND", ("CcByNcNd",)),
    ("CC-BY-NC-SA", ("CcByNcSa",)),
    ("CC-BY-NC", ("CcByNc",)),
    ("CC-BY-ND", ("CcByNd",)),
    ("CC-BY-SA", ("CcBySa",)),
    ("CC-BY", ("CcBy",)),
    ("Unlicense", ("UnlicenseRef",)),
    ("LicenseRef-public-domain", ("PublicDomain",)),
    ("LicenseRef-other", ("SpdxOther",)),
)


def normalise(sentence: Column) -> Column:
    """Lower case, comment signs and punctuation as single spaces."""
    plain = F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+/-]+|[.]+(?: |$)|(?:^| )[./*#-]+(?: |$)", " "))
    # CC-BY-SA as CC BY-SA
    return F.regexp_replace(plain, "(cc|commons)-(?=by|attribution)", "$1 ")


def sentence_ids(text: Column) -> Column:
    """Identifiers of the licence sentences of a text, in order."""
    # A sentence ends at its stop or at an empty line; a line break alone is white space.
    cut = F.regexp_replace(text, r"([.;!?])\s+|\n\s*\n", "$1\u0001")
    parts = F.filter(F.split(cut, "\u0001", -1), lambda s: s.rlike(f"(?i){GATE}"))

    def identify(sentence: Column) -> Column:
        chain = F.when(F.lit(False), F.lit(""))
        for name, pattern in SENTENCES:
            chain = chain.when(sentence.rlike(pattern), F.lit(name))
        return chain

    return F.array_compact(F.transform(parts, lambda s: let(normalise(s), identify)))


def match_rules(ids: Column, rules=RULES) -> Column:
    """Identifiers -> struct of ``licenses`` (sorted, distinct) and ``unmatched`` identifiers."""
    # " A  B " : every identifier between two spaces, a matched run becomes "=licence".
    sequence = F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" "))
    for name, run in rules:
        sequence = F.replace(sequence, F.lit("".join(f" {i} " for i in run)), F.lit(f" ={name} "))

    def split(done: Column) -> Column:
        items = F.array_remove(F.split(done, " +", -1), "")
        names = F.transform(F.filter(items, lambda i: i.startswith("=")), lambda i: F.substr(i, F.lit(2)))
        return F.struct(
            F.array_sort(F.array_distinct(names)).alias("licenses"),
            F.filter(items, lambda i: ~i.startswith("=")).alias("unmatched"),
        )

    return let(sequence, split)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``sentences`` (identifiers in order), ``licenses``, ``unmatched`` of every row.

    Null and empty texts have empty arrays; null ids and repeated rows are scanned like others;
    further columns are ignored.
    """
    rows = inputs(docs, _id=id_col, _text=text_col)
    mentions = F.col("_text").rlike(f"(?i){GATE}")
    ids = F.when(mentions, sentence_ids(F.col("_text"))).otherwise(F.array().cast("array<string>"))
    found = rows.select("_id", let(ids, lambda s: F.struct(s.alias("s"), match_rules(s).alias("m"))).alias("_f"))
    return found.select(
        F.col("_id").alias(id_col), F.col("_f.s").alias("sentences"),
        F.col("_f.m.licenses").alias("licenses"), F.col("_f.m.unmatched").alias("unmatched"),
    )
