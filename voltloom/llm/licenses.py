"""Licence scans by sentence rules.

A text is cut into sentences twice, once ending them at line ends too and once
letting them run on over single line ends (wrapped notices, comment marks at line
starts).  A normalised sentence that is known has an identifier, and a licence is
recognised where the identifiers of its rule occur in its order.  Everything is
expressions on the row: no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltloom.llm.base import query, table

# Sentences of published licences and their usual notices, by identifier.
SENTENCES = {
    "mit_notice": "Released under the MIT License",
    "mit_notice2": "Licensed under the MIT License",
    "mit_title": "MIT License",
    "mit_title2": "The MIT License",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit_keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "isc_title": "ISC License",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "apache_notice": "Licensed under the Apache License, Version 2.0",
    "apache_full": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache_use": "you may not use this file except in compliance with the License",
    "apache_copy": "You may obtain a copy of the License at",
    "bsd_grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3_notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl_free": "This program is free software",
    "gpl2_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    "gpl3_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "mpl_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "ccby_notice": "Licensed under CC BY 4.0",
    "ccby_full": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ccbysa_notice": "Licensed under CC BY-SA 4.0",
    "ccbync_notice": "Licensed under CC BY-NC 4.0",
    "all_rights": "All rights reserved",
}
# Licence, class, the ordered rules of which any one suffices, licences whose rule it contains.
RULES = [
    ("Apache-2.0", "permissive", (("apache_notice",), ("apache_full", "apache_use", "apache_copy")), ()),
    ("BSD-2-Clause", "permissive", (("bsd_grant", "bsd_source", "bsd_binary"),), ()),
    ("BSD-3-Clause", "permissive", (("bsd_grant", "bsd_source", "bsd_binary", "bsd_names"),), ("BSD-2-Clause",)),
    ("CC-BY-4.0", "permissive", (("ccby_notice",), ("ccby_full",)), ()),
    ("CC-BY-NC-4.0", "restricted", (("ccbync_notice",),), ()),
    ("CC-BY-SA-4.0", "copyleft", (("ccbysa_notice",),), ()),
    ("CC0-1.0", "permissive", (("cc0",),), ()),
    ("GPL-2.0-or-later", "copyleft", (("gpl_free", "gpl2_terms"),), ()),
    ("GPL-3.0", "copyleft", (("gpl3_notice",),), ()),
    ("GPL-3.0-or-later", "copyleft", (("gpl_free", "gpl3_terms"),), ()),
    ("ISC", "permissive", (("isc_grant",),), ()),
    ("MIT", "permissive", (("mit_notice",), ("mit_notice2",), ("mit_grant", "mit_keep")), ()),
    ("MPL-2.0", "copyleft", (("mpl_notice",),), ()),
    ("Unlicense", "permissive", (("unlicense",),), ()),
]
WORST_FIRST = ("restricted", "copyleft", "permissive")

_VERSION = r"(?<![\p{L}\p{M}\p{N}])([vV])\.(?=[^\p{L}\p{M}\p{N}]+[0-9])"  # the full stop of "v. 2.0" ends no sentence
_MARK = r"[^\p{L}\p{M}\p{N}]+"
BY_LINE = r"[.!?;:][^\p{L}\p{M}\p{N}\s]*\s+|\n"
RUN_ON = r"[.!?;:][^\p{L}\p{M}\p{N}\s]*\s+|\n[^\p{L}\p{M}\p{N}\n]*\n"


def _plain(sentence: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


def _ids(text: Column, ends: str) -> Column:
    known = F.create_map(*[F.lit(x) for k, s in SENTENCES.items() for x in (_plain(s), k)])
    return F.array_compact(F.transform(F.split(text, ends, -1), lambda s: known[F.trim(F.regexp_replace(F.lower(s), _MARK, " "))]))


def _rule(ids: tuple[str, ...]) -> str:
    return "(^| )" + " (.* )?".join(ids) + "( |$)"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, license_class, n_sentences``: documents with any known licence sentence.

    ``licenses`` is an array in alphabetical order, empty when no rule is complete;
    ``license_class`` is the strictest among them, null when there is none.
    ``n_sentences`` counts known sentences in the reading that has more of them.
    Null and empty texts have none; repeated rows each get a row.
    """
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), _VERSION, "$1")
    both = docs.select("doc_id", _ids(text, BY_LINE).alias("a"), _ids(text, RUN_ON).alias("b"))
    both = both.where((F.size("a") > 0) | (F.size("b") > 0)).select(
        "doc_id", F.greatest(F.size("a"), F.size("b")).cast("long").alias("n_sentences"), F.array(F.array_join("a", " "), F.array_join("b", " ")).alias("seq"))
    fits = lambda rules: F.exists("seq", lambda s: F.expr("false") if not rules else s.rlike("|".join(map(_rule, rules))))
    over = {inner: [name for name, _, _, contains in RULES if inner in contains] for inner, *_ in RULES}
    rules_of = {name: rules for name, _, rules, _ in RULES}
    hits = []
    for name, _, rules, _ in RULES:
        hit = fits(rules)
        for outer in over[name]:
            hit = hit & ~fits(rules_of[outer])
        hits.append(F.when(hit, F.lit(name)))
    named = both.withColumn("licenses", F.array_compact(F.array(*hits)))
    strict = F.coalesce(*[F.when(F.arrays_overlap("licenses", F.array(*[F.lit(n) for n, k, *_ in RULES if k == kind])), F.lit(kind)) for kind in WORST_FIRST])
    return named.select("doc_id", "licenses", strict.alias("license_class"), "n_sentences")


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = "MAP {" + ", ".join(f"{quote(_plain(s))}: {quote(k)}" for k, s in SENTENCES.items()) + "}"

    def ids(ends: str) -> str:
        return (f"list_filter(list_transform(string_split_regex(coalesce(text, ''), {quote(ends)}), "
                f"lambda s: (k[trim(regexp_replace(lower(s), {quote(_MARK)}, ' ', 'g'))])), lambda x: x IS NOT NULL)")

    fits = lambda rules: "(" + " OR ".join(f"regexp_matches({c}, {quote(_rule(r))})" for r in rules for c in ("a", "b")) + ")"
    rules_of = {name: rules for name, _, rules, _ in RULES}
    cases = []
    for name, _, rules, _ in RULES:
        inner = [fits(rules_of[o]) for o, _, _, contains in RULES if name in contains]
        cases.append(f"CASE WHEN {fits(rules)}{''.join(f' AND NOT {x}' for x in inner)} THEN {quote(name)} END")
    kinds = "\n".join(f"WHEN list_has_any(l, [{', '.join(quote(n) for n, k, *_ in RULES if k == kind)}]) THEN {quote(kind)}" for kind in WORST_FIRST)
    return f"""
WITH s AS (SELECT doc_id, {ids(BY_LINE)} x, {ids(RUN_ON)} y FROM documents, (SELECT {known} k)),
q AS (SELECT doc_id, greatest(len(x), len(y)) n_sentences, array_to_string(x, ' ') a, array_to_string(y, ' ') b FROM s WHERE len(x) > 0 OR len(y) > 0),
r AS (SELECT doc_id, n_sentences, list_filter([{', '.join(cases)}], lambda v: v IS NOT NULL) l FROM q)
SELECT doc_id, array_to_string(l, ',') licenses, CASE {kinds} END license_class, n_sentences FROM r
"""


@query("op3_license_scan", _sql())
def op3_license_scan(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("licenses", F.array_join("licenses", ","))
