from fareledger.llm import licenses
from tests.llm.cases import awkward, frame


def test_sequences_and_rules(spark):
    texts = {
        1: "Some words.\nReleased under the MIT License.\nMore words.",
        2: "LICENSED under the  Apache License, Version 2.0. And then. You may obtain a copy of the License at\n"
           "http://www.apache.org/licenses/LICENSE-2.0\n",
        3: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Licensed under the "
           "Apache License, Version 2.0.",
        4: "It is not released under the MIT License",
        5: "This work is licensed under the GNU General\nPublic License, version 3.\nLicensed under CC BY-NC 4.0.",
    }
    got = {r.doc_id: (r.licences, r.rules, r.n_known) for r in licenses.licence_scan(frame(spark, list(texts.items()))).collect()}
    assert got[1] == ("MIT", "mit-released", 1)
    assert got[2] == ("Apache-2.0", "apache-licensed+apache-copy,apache-licensed", 2)
    assert got[3] == ("Apache-2.0", "apache-licensed", 2)  # in the other order the longer rule is not met
    assert got[4] == ("", "", 0)
    assert got[5] == ("CC-BY-NC-4.0,GPL-3.0", "by-nc-licensed,gpl3-work", 2)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = licenses.licence_scan(docs).collect()
    assert len(rows) == docs.count() and {(r.licences, r.n_known) for r in rows} == {("", 0)}
    assert licenses.licence_scan(docs.limit(0)).count() == 0


def test_nothing_is_shuffled(spark):
    plan = licenses.licence_scan(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.
"""
BSD = """Copyright (c) 2019, The Authors

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GNU = """This {what} is free software{a} you can redistribute it and/or
modify it under the terms of the GNU {title} Public License as published by
the Free Software Foundation{b} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""


def gnu(title, version, what="program", a=":", b=","):
    return GNU.format(title=title, version=version, what=what, a=a, b=b)


TEXTS = {
    "All-rights-reserved": ["Words.\nAll rights reserved.\nMore words.", "Copyright 2020 A. Author. All rights reserved."],
    "Apache-2.0": ["""# Copyright 2021 The Authors
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
""", """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""],
    "MIT": ["""Copyright (c) 2020 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

""" + AS_IS],
    "GPL-3.0": [gnu("General", "3"), gnu("General", "3", a=";", b=";"),
                "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n Copyright (C) 2007 the Foundation"],
    "GPL-2.0": [gnu("General", "2", a=";", b=";"), gnu("General", "2", a=";"), "// SPDX-License-Identifier: GPL-2.0-or-later"],
    "LGPL-2.1": [gnu("Lesser General", "2.1", "library", ";", ";")],
    "LGPL-3.0": [gnu("Lesser General", "3", "library")],
    "AGPL-3.0": [gnu("Affero General", "3")],
    "MPL-2.0": ["/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL "
                "was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"],
    "ISC": ["""Copyright (c) 2018, A. Author

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""],
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring "
                "rights to this software to the public domain\nworldwide. This software is distributed without any warranty."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy."],
    "BSD-2-Clause": [BSD],
}


def test_full_texts_of_the_common_families(spark):
    rows = [(licence, text) for licence, texts in TEXTS.items() for text in texts]
    found = licenses.licence_scan(frame(spark, [(i, text) for i, (_, text) in enumerate(rows)]))
    assert {r.doc_id: r.licences for r in found.collect()} == {i: licence for i, (licence, _) in enumerate(rows)}


def test_three_clauses_are_named(spark):
    third = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    found = licenses.licence_scan(frame(spark, [(1, BSD), (2, BSD + third)]))
    named = {r.doc_id: r.licences.split(",") for r in found.collect()}
    assert "BSD-3-Clause" not in named[1] and "BSD-3-Clause" in named[2]
