"""License scans by sentence rules; DataFrame operations only.

Normalised sentences of a text are mapped to the identifiers of known licence sentences; the
sequence of identifiers is then matched against rules, each an ordered list of identifiers that
must stand in this order. All of it happens within a row: nothing is shuffled, whatever the size.

Defined results: null and empty texts know no sentence and no licence; a sentence may be hard
wrapped over lines or stand on a line of its own; rows are scanned each by itself, repeated and
null ids included; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import once, text_of
from fareledger.llm.line_dedup import LOWER, UPPER

_MIT_GRANT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
              'associated documentation files (the "Software"), to deal in the Software without restriction, including '
              "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
              "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
              "following conditions:")
_ENDORSE = ("Neither the name of the {} nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission")
_GNU = [("gpl", "General", {"2": "Version 2, June 1991", "3": "Version 3, 29 June 2007"}),
        ("lgpl", "Lesser General", {"2.1": "Version 2.1, February 1999", "3": "Version 3, 29 June 2007"}),
        ("agpl", "Affero General", {"3": "Version 3, 19 November 2007"})]
_GNU_TERMS = ("you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the "
              "Free Software Foundation")
_LATER = "either version {} of the License, or (at your option) any later version"
_WORKS = ("program", "library", "software")
#: SPDX tags and the licence they name.
_SPDX = {
    "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-3.0-or-later": "GPL-3.0",
    "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3.0",
    "LGPL-3.0-or-later": "LGPL-3.0", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0",
    **{x: x for x in ("BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
                      "ISC", "MPL-2.0", "Unlicense")},
}


def _gnu_rules() -> list[tuple[str, list[str]]]:
    """A version is named in the sentence of the terms, in the next one, or by the date of the text."""
    rules = []
    for kind, _, versions in _GNU:
        for version in versions:
            licence = f"{kind.upper()}-{version if '.' in version else version + '.0'}"
            date = "gpl3-text" if (kind, version) == ("lgpl", "3") else f"{kind}{version}-text"
            rules += [(licence, [f"{kind}{version}-{how}"]) for how in ("terms", *_WORKS)]
            rules += [(licence, [f"{kind}-{how}", f"gnu-{version}-later"])
                      for how in ("terms", *(f"{what}-terms" for what in _WORKS))]
            rules.append((licence, [f"{kind}-title", date]))
    return rules


# Sentences of well-known licences and notices.
SENTENCES = {
    "mit-released": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "MIT License",
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or "
                     "substantial portions of the Software",
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-spdx": "SPDX-License-Identifier: Apache-2.0",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3",
    "gpl3-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "gpl2-licensed": "Licensed under the GNU General Public License, version 2",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program",
    "by-nc-licensed": "Licensed under CC BY-NC 4.0",
    "by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "by-licensed": "Licensed under CC BY 4.0",
    "by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-retain": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution",
    "reserved": "All rights reserved",
    # Standard headers and texts, cut where their own punctuation cuts them; some end as lines.
    "mit-begin": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "mit-portions": "copies or substantial portions of the Software",
    "mit-grant": _MIT_GRANT,
    "mit-text": f"{_MIT_GRANT} The above copyright notice and this permission notice shall be included in all "
                "copies or substantial portions of the Software",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
                 "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-use": "you may not use this file except in compliance with the License",
    **{f"apache-header-copy-{web}": f"You may obtain a copy of the License at {web}://www.apache.org/licenses/"
       "LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License "
       'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'
       for web in ("http", "https")},
    "apache-copy-https": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache-title": "Apache License",
    "apache-version": "Version 2.0, January 2004",
    "bsd-endorse": _ENDORSE.format("copyright holder"),
    "bsd-endorse-university": _ENDORSE.format("University"),
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                 "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "isc-notice": "copyright notice and this permission notice appear in all copies",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
                 "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "isc-title": "ISC License",
    "mpl-source": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    **{f"mpl-copy-{web}": "If a copy of the MPL was not distributed with this file, You can obtain one at "
       f"{web}://mozilla.org/MPL/2.0/" for web in ("http", "https")},
    "mpl-title": "Mozilla Public License Version 2.0",
    "cc0-dedicated": "To the extent possible under law, the author(s) have dedicated all copyright and related and "
                     "neighboring rights to this software to the public domain worldwide",
    "cc0-copy": "You should have received a copy of the CC0 Public Domain Dedication along with this software",
    "cc0-title": "CC0 1.0 Universal",
    "by-sa-licensed": "Licensed under CC BY-SA 4.0",
    "by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "boost-distributed": "Distributed under the Boost Software License, Version 1.0",
    **{f"{kind}-title": f"GNU {title} Public License" for kind, title, _ in _GNU},
    **{f"{kind}-terms": _GNU_TERMS.format(title) for kind, title, _ in _GNU},
    **{f"{kind}-{what}-terms": f"This {what} is free software: {_GNU_TERMS.format(title)}"
       for kind, title, _ in _GNU for what in _WORKS},
    **{f"gnu-{version}-later": _LATER.format(version) for version in ("2", "2.1", "3")},
    **{f"{kind}{version}-terms": f"{_GNU_TERMS.format(title)}, {_LATER.format(version)}"
       for kind, title, versions in _GNU for version in versions},
    **{f"{kind}{version}-{what}": f"This {what} is free software: {_GNU_TERMS.format(title)}, {_LATER.format(version)}"
       for kind, title, versions in _GNU for version in versions for what in _WORKS},
    **{f"{kind}{version}-text": date for kind, _, versions in _GNU for version, date in versions.items()
       if (kind, version) != ("lgpl", "3")},  # dated as version 3 of the GPL is
    **{f"spdx-{name.lower()}": f"SPDX-License-Identifier: {name}" for name in _SPDX},
}
#: Ordered rules: licence, and identifiers that stand in this order with anything between them.
RULES = [
    ("Apache-2.0", ["apache-licensed", "apache-copy"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("Apache-2.0", ["apache-spdx"]),
    ("BSD-2-Clause", ["bsd-retain", "bsd-binary"]),
    ("CC-BY-4.0", ["by-licensed"]),
    ("CC-BY-4.0", ["by-work"]),
    ("CC-BY-NC-4.0", ["by-nc-licensed"]),
    ("CC-BY-NC-4.0", ["by-nc-work"]),
    ("GPL-2.0", ["gpl2-licensed"]),
    ("GPL-3.0", ["gpl3-work", "gpl-copy"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("GPL-3.0", ["gpl3-licensed"]),
    ("GPL-3.0", ["gpl3-spdx"]),
    ("MIT", ["mit-title", "mit-condition"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-spdx"]),
    ("MIT", ["mit-text"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("MIT", ["mit-begin", "mit-portions"]),
    ("MIT", ["mit-title", "mit-as-is"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-header", "apache-use"]),
    ("Apache-2.0", ["apache-header-copy-http"]),
    ("Apache-2.0", ["apache-header-copy-https"]),
    ("Apache-2.0", ["apache-licensed", "apache-copy-https"]),
    ("Apache-2.0", ["apache-title", "apache-version"]),
    ("BSD-3-Clause", ["bsd-retain", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-retain", "bsd-binary", "bsd-endorse-university"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-notice", "isc-as-is"]),
    ("ISC", ["isc-title"]),
    ("MPL-2.0", ["mpl-source", "mpl-copy-http"]),
    ("MPL-2.0", ["mpl-source", "mpl-copy-https"]),
    ("MPL-2.0", ["mpl-title"]),
    ("CC0-1.0", ["cc0-dedicated"]),
    ("CC0-1.0", ["cc0-copy"]),
    ("CC0-1.0", ["cc0-title"]),
    ("CC-BY-SA-4.0", ["by-sa-licensed"]),
    ("CC-BY-SA-4.0", ["by-sa-work"]),
    ("Unlicense", ["unlicense-free"]),
    ("BSL-1.0", ["boost-title"]),
    ("BSL-1.0", ["boost-distributed"]),
    *_gnu_rules(),
    *[(licence, [f"spdx-{name.lower()}"]) for name, licence in _SPDX.items()],
    ("All-rights-reserved", ["reserved"]),
]
ENDS = r"[.!?;]+([ \t\n\x0B\f\r]|\z)"
OTHER = "[^a-z0-9]+"


def plain(sentence: str) -> str:
    """A sentence as lower-case letters and digits with single spaces."""
    return re.sub(OTHER, " ", sentence.lower()).strip()


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), OTHER, " "))


def sentences_of(text: Column) -> Column:
    """Sentences in order; one over several lines is followed by its lines."""
    return F.flatten(F.transform(F.split(text, ENDS, -1), lambda s: F.when(
        F.instr(s, "\n") > 0, F.concat(F.array(s), F.split(s, "\n", -1))).otherwise(F.array(s))))


def licence_scan(docs: DataFrame, sentences: dict[str, str] | None = None,
                 rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per document: its licences, the rules met and the sequence of known sentences."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = F.create_map(*[F.lit(x) for name, s in sentences.items() for x in (plain(s), name)])
    found = F.transform(sentences_of(text_of()), lambda s: F.element_at(known, normalised(s)))
    rows = docs.select("doc_id", once(F.filter(found, lambda x: x.isNotNull())).alias("ids"))
    # The sequence as text with each identifier between bars, so a rule is one pattern.
    rows = rows.withColumn("sequence", F.array_join(F.transform("ids", lambda x: F.concat(F.lit("|"), x, F.lit("|"))), ""))
    met = [(licence, "+".join(ids), ".*".join(rf"\|{re.escape(i)}\|" for i in ids)) for licence, ids in rules]
    hits = F.filter(F.array(*[F.when(F.col("sequence").rlike(pattern), F.struct(
        F.lit(licence).alias("licence"), F.lit(rule).alias("rule"))) for licence, rule, pattern in met]),
        lambda x: x.isNotNull())
    kind = "array<struct<licence:string,rule:string>>"
    hits = F.when(F.col("sequence") == "", F.array().cast(kind)).otherwise(hits)
    return rows.withColumn("hits", hits).select(
        "doc_id", F.array_join(F.array_distinct(F.col("hits.licence")), ",").alias("licences"),
        F.array_join(F.col("hits.rule"), ",").alias("rules"), F.size("ids").cast("long").alias("n_known"),
        "sequence")


def _sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    names = ", ".join(f"{quote(plain(s))}: {quote(n)}" for n, s in SENTENCES.items())
    hit = lambda ids: f"regexp_matches(sequence, {quote('.*'.join(rf'\|{i}\|' for i in ids))})"
    rules = ", ".join(f"CASE WHEN {hit(ids)} THEN {quote('+'.join(ids))} END" for _, ids in RULES)
    licences = ", ".join(
        f"CASE WHEN {' OR '.join(hit(ids) for x, ids in RULES if x == licence)} THEN {quote(licence)} END"
        for licence in dict.fromkeys(x for x, _ in RULES))
    return f"""
WITH s AS (SELECT doc_id, flatten(list_transform(
    string_split_regex(coalesce(text, ''), '{ENDS}'),
    lambda x: CASE WHEN contains(x, chr(10)) THEN [x] || string_split(x, chr(10)) ELSE [x] END)) AS a FROM documents),
k AS (SELECT doc_id, list_filter(list_transform(a, lambda x: MAP {{{names}}}[
    trim(regexp_replace(translate(x, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids FROM s),
q AS (SELECT doc_id, len(ids) AS n_known, coalesce(array_to_string(list_transform(ids, lambda x: '|' || x || '|'), ''), '')
    AS sequence FROM k)
SELECT doc_id, coalesce(array_to_string(list_filter([{licences}], lambda x: x IS NOT NULL), ','), '') AS licences,
  coalesce(array_to_string(list_filter([{rules}], lambda x: x IS NOT NULL), ','), '') AS rules, n_known, sequence FROM q"""


SQL = _sql()
