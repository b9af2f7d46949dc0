"""Licence scans: public licence texts and notices, order, and the query against plain search."""

import pytest

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.licences import SENTENCES, identified, licence_scan, licences, sentences
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.01"
MIT = """
 * Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
 * associated documentation files (the "Software"), to deal in the Software without restriction.
 *
 * The above copyright notice and this permission notice shall be included in all copies or
 * substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS BE LIABLE.
"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.
"""
BSD_3 = BSD + "3. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products.\n"
GPL = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation; either version 2 of the License,
or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without more.
See the GNU General Public License for more details."""

# The openings of public licence texts.
GPL_3_TEXT = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
APACHE_TEXT = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""


@pytest.mark.parametrize(
    ("text", "names"),
    [
        (MIT, ["MIT"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD_3, ["BSD-3-Clause"]),
        (GPL, ["GPL-2.0-or-later"]),
        (MIT + BSD_3, ["MIT", "BSD-3-Clause"]),
        ("Released under the MIT License.", ["MIT"]),
        ("prose without an end Released under the MIT License. More.", ["MIT"]),
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
        ("Licensed under the GNU Lesser General Public License v2.1 or later.", ["LGPL-2.1-or-later"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Available under a Creative Commons Attribution-ShareAlike 3.0 licence", ["CC-BY-SA-3.0"]),
        ("// SPDX-License-Identifier: mit", ["MIT"]),
        ("Copyright 2020 A. All rights reserved.", []),
        ("a driving license and a copyright", []),
        (GPL.replace("as published", "version 2 as published").replace("either version 2 of the License,\nor (at your option) any later version.", ""), ["GPL-2.0-only"]),
        (GPL.replace("the GNU\nGeneral", "version 3 of the GNU\nGeneral").split(";\n")[0], ["GPL-3.0-only"]),
        (GPL.replace("either version 2 of the License,\nor (at your option) any later version", "version 2 of the License"), ["GPL-2.0-only"]),
        (GPL.replace("either version 2 of the License,", "either version 3,"), ["GPL-3.0-or-later"]),
        ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 2.1 or later.", ["LGPL-2.1-or-later"]),
        ("Released under AGPL-3.0-or-later.", ["AGPL-3.0-or-later"]),
        ("Licensed under the GPLv2.", ["GPL-2.0-only"]),
        ("Licensed under the Mozilla Public License, version 2.0.", ["MPL-2.0"]),
        ("Licensed under the Boost Software License.", ["BSL-1.0"]),
        (GPL_3_TEXT, ["GPL-3.0"]),
        (GPL_3_TEXT.replace("GENERAL", "LESSER GENERAL"), ["LGPL-3.0"]),
        (APACHE_TEXT, ["Apache-2.0"]),
        ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n--------------\n", ["MPL-2.0"]),
        ("Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM", ["EPL-2.0"]),
        ("Creative Commons Attribution-ShareAlike 4.0 International Public License", ["CC-BY-SA-4.0"]),
        ("Creative Commons Legal Code\n\nCC0 1.0 Universal\n", ["CC0-1.0"]),
    ],
)
def test_notices(text, names):
    assert licences(identified(sentences(text)))[0] == names


def test_query_equals_plain_search(spark):
    lines = {
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
    }
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    wanted = {}
    for r in rows:
        found = sorted((at, name) for line, name in lines.items() if (at := (r["text"] or "").find(line)) >= 0)
        if found:
            wanted[r["doc_id"]] = {name for _, name in found}
    got = {r["doc_id"]: set(r["licences"].split(",")) for r in LLM_QUERIES["op5_licence_scan"](spark, SF).collect()}
    assert wanted and got == wanted


def test_awkward_rows(spark, awkward, no_documents):
    assert licence_scan(awkward).count() == licence_scan(no_documents).count() == 0
    long = spark.createDataFrame([(1, "filler. " * 50_000 + MIT), (1, "filler. " * 50_000 + MIT), (None, "Released under the MIT License")], "doc_id long, text string")
    assert [r["licences"] for r in licence_scan(long).collect()] == ["MIT"] * 3


ALONE = {
    "spdx={1}": "SPDX-License-Identifier: MIT",
    "mit-grant": MIT.split(", to deal")[0],
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": "The software is provided as is.",
    "no-liability": "In no event shall the authors be liable.",
    "bsd-grant": BSD.split(":")[0],
    "bsd-source": "Redistributions of source code must retain the above copyright notice.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice.",
    "bsd-endorse": "Neither the name of X may be used to endorse or promote products.",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display this.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "zlib-as-is": "This software is provided as-is, without any express or implied warranty.",
    "zlib-origin": "The origin of this software must not be misrepresented.",
    "zlib-altered": "Altered source versions must be plainly marked as such.",
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-use": "You may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at example.",
    "apache-law": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis.",
    "gnu-free={1}": "You can redistribute it and/or modify it under the terms of the GNU General Public License.",
    "gnu-fixed={1}={2}+": "You can redistribute it and/or modify it under the terms of the GNU General Public License v2 or later.",
    "gnu-fixed={1}={2}": "You can redistribute it and/or modify it under the terms of the GNU General Public License version 2.",
    "gnu-fixed={2}={1}": "You can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License.",
    "gnu-only={1}": "Version 2 of the License.",
    "gnu-title={1}={2}": "GNU General Public License Version 2, June 1991",
    "gnu-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document.",
    "gpl-short={1}={2}+": "Released under the LGPL v2.1 or later.",
    "gpl-short={1}={2}": "Available under GPLv3.",
    "apache-title": "Apache License Version 2.0, January 2004",
    "apache-terms": "Terms and conditions for use, reproduction, and distribution",
    "mpl-name={1}": "Mozilla Public License Version 2.0",
    "epl-name={1}": "Eclipse Public License - v 2.0",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "cc-title={1}={2}": "Creative Commons Attribution 4.0 International",
    "cc0-title": "CC0 1.0 Universal",
    "gnu-version={1}+": "Either version 2 of the License, or (at your option) any later version.",
    "gnu-hope": "Distributed in the hope that it will be useful, but without any warranty.",
    "gnu-see": "See the GNU General Public License for more details.",
    "gnu-copy": "You should have received a copy of the GNU text.",
    "gnu-line={1}={2}+": "Licensed under the GNU General Public License v2 or later.",
    "gnu-line={1}={2}": "Released under the GNU General Public License, version 3.",
    "mpl-notice={1}": "This is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at example.",
    "epl-notice={1}": "Made available under the terms of the Eclipse Public License v2.0.",
    "boost-line": "Distributed under the Boost Software License, Version 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "public-domain": "Dedicated to the public domain.",
    "cc0-line": "Available under CC0.",
    "cc-line={1}={2}": "Released under CC BY-SA 4.0.",
    "cc-long={1}={2}": "Licensed under Creative Commons Attribution 4.0.",
    "short-line={1}": "Available under the MIT license.",
    "bsd-line={1}": "Distributed under the BSD 3-clause.",
    "all-rights": "Copyright 2020 A, all rights reserved.",
}


def test_each_sentence_alone_and_wrapped_passes_the_filter(spark):
    assert set(ALONE) == {name for name, _ in SENTENCES}
    texts = [t for line in ALONE.values() for t in (line, line.upper(), "\n * ".join(line.split(" ")), "\n".join(line.split(" ")))]
    assert all(identified(sentences(t)) for t in texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in licence_scan(rows).collect()} == set(range(len(texts)))


def test_standard_mpl_header():
    header = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
    assert licences(identified(sentences(header))) == (["MPL-2.0"], 0)
    assert sentences("See v. Two ends.") == ["see v", "two ends"]
