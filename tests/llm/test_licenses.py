import pytest

from textloom.llm import licenses

MIT = """/*
 * Copyright (c) 2020 Jo Doe
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
 * documentation files (the "Software"), to deal in the Software without restriction, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.
 */"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {kind}General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU {kind}General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice.
2. Redistributions in binary form must reproduce the above copyright notice.
{extra}
THIS SOFTWARE IS PROVIDED BY THE AUTHOR "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
ENDORSE = "3. Neither the name of the owner nor the names of its contributors may be used to endorse or promote products."
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://example.org/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS.
See the License for the specific language governing permissions and limitations under the License."""
CASES = [
    (MIT, ["MIT"]),
    (GPL.format(kind=""), ["GPL-3.0-or-later"]),
    (GPL.format(kind="Lesser "), ["LGPL-3.0-or-later"]),
    (GPL.format(kind="Affero "), ["AGPL-3.0-or-later"]),
    (BSD.format(extra=""), ["BSD-2-Clause"]),
    (BSD.format(extra=ENDORSE), ["BSD-3-Clause"]),
    (APACHE, ["Apache-2.0"]),
    (f"{MIT}\n\n{APACHE}", ["Apache-2.0", "MIT"]),
    ("prose here.\nLicensed under CC BY-NC 4.0.\nmore prose", ["CC-BY-NC-4.0"]),
    ("| a | b |\nThis work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("Released under the MIT License.", ["MIT"]),
    ("All rights reserved.", ["all-rights-reserved"]),
    ("// SPDX-License-Identifier: GPL-2.0-only OR MIT\nint x;", ["gpl-2.0-only or mit"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed", ["MPL-2.0"]),
    ("It was released into the public domain.", ["public-domain"]),
    ("Available under the terms of the Creative Commons Attribution-ShareAlike 3.0 licence.", ["CC-BY-SA-3.0"]),
    ("We granted them permission. He commits; the driver's licence expired.", []),
    ("Plain words only.", []),
    ("", []),
]


@pytest.mark.parametrize(("text", "names"), CASES)
def test_recognised(text, names):
    assert sorted(licenses.match_rules(licenses.licence_sequence(text.encode()))) == sorted(names)


def test_every_known_sentence_is_critical():
    """The first filter cannot hide a sentence: each pattern holds a critical word."""
    for name, pattern in licenses.SENTENCES:
        plain = pattern.pattern.replace("[cs]", "c").replace("\\", "").encode()
        assert any(w in plain for w in licenses.CRITICAL), name


def test_order_of_rules():
    seq = ["BSD-GRANT", "BSD-SOURCE", "UNKNOWN", "BSD-BINARY", "BSD-ENDORSE", "NAMED:MIT", "ALL-RIGHTS"]
    assert licenses.match_rules(seq) == ["BSD-3-Clause", "MIT", "all-rights-reserved"]
    assert licenses.match_rules(["BSD-BINARY", "BSD-GRANT"]) == []


def test_long_text_whole():
    text = "word " * 300_000 + "\n\nReleased under the MIT License.\n" + "tail " * 1000
    assert licenses.match_rules(licenses.licence_sequence(text.encode())) == ["MIT"]


def test_table(spark, make):
    rows = [(1, "Released under the MIT License.", "x"), (None, None, "x"), (2, "", "x"), (3, "a copyright matter? Unclear.", "x")]
    got = licenses.scan_licences(make(rows, "doc_id long, text string, licences string")).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.licences, r.sentence_ids, r.n_unknown) for r in got) == [
        (-1, "", "", 0), (1, "MIT", "NAMED:MIT", 0), (2, "", "", 0), (3, "", "COPYRIGHT", 0),
    ]
    assert licenses.scan_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# An example of every entry of NAMES, and of the CC pattern, without a critical word where the entry allows it.
NAMED = [
    ("AGPLv3", "AGPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("GPLv3", "GPL-3.0"), ("the GPL", "GPL"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0"),
    ("EPL-2.0", "EPL-2.0"), ("CDDL-1.0", "CDDL-1.0"), ("the Artistic License 2.0", "Artistic-2.0"), ("the Boost Software License 1.0", "BSL-1.0"),
    ("the Academic Free License 3.0", "AFL-3.0"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"), ("the new BSD", "BSD-3-Clause"),
    ("BSD-4-Clause", "BSD-4-Clause"), ("a BSD-style license", "BSD"), ("MIT", "MIT"), ("ISC", "ISC"), ("the zlib license", "Zlib"),
    ("the Python Software Foundation License 2.0", "PSF-2.0"), ("the WTFPL", "WTFPL"), ("the Unlicense", "Unlicense"), ("CC0", "CC0"),
    ("Creative Commons Zero", "CC0"), ("CC BY-SA 4.0", "CC-BY-SA-4.0"), ("CC-BY 4.0", "CC-BY-4.0"), ("Creative\nCommons Attribution 4.0", "CC-BY-4.0"),
]


@pytest.mark.parametrize(("text", "name"), NAMED)
@pytest.mark.parametrize("start", ["Released", "Distributed", "Available", "Published"])
def test_every_name_passes_the_filter(start, text, name):
    assert licenses.match_rules(licenses.licence_sequence(f"Words before.\n\n{start} under {text}.".encode())) == [name]


def test_every_entry_has_an_example():
    plain = [licenses.normalise(text) for text, _ in NAMED]
    for pattern, name in licenses.NAMED:
        assert any(pattern.search(t) for t in plain), name
    assert any(licenses.CC.search(t) for t in plain)


@pytest.mark.parametrize("text", ["Published by researchers at MIT.", "Das Buch mit Bildern ist available.", "The ISC released a report.", "An Apache helicopter.", "The emitted light"])
def test_names_that_state_nothing(text):
    assert licenses.licence_sequence(text.encode()) == []
