"""Unaltered standard licence texts are recognised."""

from filingspark.llm import licenses

from .conftest import make_docs

APACHE = """Copyright 2024 Some Author

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """The MIT License (MIT)

Copyright (c) 2024 Some Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
LGPL21 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ISC = """ISC License

Copyright (c) 2024 Some Author

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
APACHE_FULL = """
                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
GPL3_FULL = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
"""


def scan(spark, texts):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    return [r.licenses for r in licenses.license_scan(make_docs(spark, rows)).orderBy("doc_id").collect()]


def test_standard_texts(spark):
    stars = lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */\n"
    lines = lambda mark: lambda t: "".join(f"{mark} {x}\n" for x in t.splitlines())
    want = {APACHE: "Apache-2.0", MIT: "MIT", BSD2: "BSD-2-Clause", BSD3: "BSD-3-Clause", MPL: "MPL-2.0", GPL3: "GPL-3.0-or-later", LGPL21: "LGPL-2.1-or-later", UNLICENSE: "Unlicense", APACHE_FULL: "Apache-2.0", GPL3_FULL: "GPL-3.0-only"}
    want |= {shape(t): name for t, name in list(want.items()) for shape in (stars, lines("//"), lines("#"), lines("--"), lines(";;"))}
    want |= {BSD3.replace("met:\n\n", "met:\n"): "BSD-3-Clause", MIT.replace("conditions:\n\n", "conditions:\n"): "MIT", "/* " + MPL + " */": "MPL-2.0", APACHE.replace("Author\n\n", "Author\n"): "Apache-2.0", f"<!-- {MPL} -->": "MPL-2.0"}
    got = scan(spark, want)
    assert {t: g for t, g in zip(want, got) if set(g.split(",")) != {want[t]}} == {}
    assert scan(spark, [ISC]) == ["ISC"]


def test_notices_with_lead_ins(spark):
    want = {
        "This file is licensed under the MIT License.": "MIT",
        "Some text.\nThe source code in this is released under the Apache License, Version 2.0.": "Apache-2.0",
        "All documentation here is available under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
        "distributed under GPLv3": "GPL-3.0-only",
        "This project is covered by the ISC license.": "ISC",
        "We talked about the MIT License and the licensed premises.": "",
    }
    assert scan(spark, want) == list(want.values())


def test_every_known_sentence_can_be_cut():
    assert [s for s in licenses.KNOWN if licenses.pieces(s) != [s]] == []
    ids = set(licenses.KNOWN.values())
    assert all(set(needed) <= ids for _, needed in licenses.RULES)
