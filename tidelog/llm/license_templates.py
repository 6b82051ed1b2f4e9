"""Licence wording as templates: [[...]] may be left out, {{a..b}} stands for a to b words of any text.

Fixed values: the published wording of the licences, their notices and their usual short forms.
"""

from __future__ import annotations

#: Words that count as one in licence wording.
EQUIVALENT = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "noninfringment": "noninfringement"}

#: Phrases and labels that are found word by word wherever they stand.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_REDISTRIBUTION = """
    Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
    conditions are met: [[1]] Redistributions of source code must retain the above copyright notice, this list of conditions and the
    following disclaimer[[.]] [[2]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions
    and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """
    THIS SOFTWARE IS PROVIDED BY {{1..20}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
    WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{1..20}} BE LIABLE FOR ANY
    DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
    CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
    ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_COPYRIGHT = "[[Copyright [[c]] {{1..20}} [[All rights reserved]]]]"
_GNU = """
    [[This {{1..6}} is free software[[:]]]] you can redistribute it and/or modify it under the terms of the GNU {name} as published by the
    Free Software Foundation[[,]] either version {version} of the License, or (at your option) any later version."""
_SHORT = "[[This {{1..4}} is]] [[Released]] [[Distributed]] [[Published]] [[Made]] [[Available]] [[Licensed]] under [[the terms of]] [[the]] {name}"

#: (label, template); a licence may have several.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", f"""[[The]] [[MIT License [[MIT]]]] {_COPYRIGHT}
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice [[(including the next paragraph)]] shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL {{{{1..12}}}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
        OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", f"""[[The]] [[ISC License]] {_COPYRIGHT}
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND {{{{1..8}}}} DISCLAIMS ALL WARRANTIES
        WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{{{1..8}}}} BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
        OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-2", f"{_COPYRIGHT} {_REDISTRIBUTION} {_BSD_DISCLAIMER}"),
    ("bsd-3", f"""{_COPYRIGHT} {_REDISTRIBUTION} [[3]] Neither the name of {{{{1..20}}}} nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}"""),
    ("apache-2", f"""{_COPYRIGHT} Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at [[http]] [[https]] [[www]] apache.org/licenses/LICENSE-2.0 [[html]] [[txt]] Unless required by applicable
        law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("apache-2", _SHORT.format(name="Apache License, [[Version]] 2.0")),
    ("mit", _SHORT.format(name="MIT License")),
    ("gpl-2", _GNU.format(name="General Public License", version="2")),
    ("gpl-3", _GNU.format(name="General Public License", version="3")),
    ("lgpl-3", _GNU.format(name="Lesser General Public License", version="3")),
    ("lgpl-2.1", _GNU.format(name="Lesser General Public License", version="2.1")),
    ("agpl-3", _GNU.format(name="Affero General Public License", version="3")),
    ("gpl-3", _SHORT.format(name="GNU General Public License[[,]] [[GPL]] version 3[[.0]] [[or [[any]] later [[version]]]]")),
    ("gpl-2", _SHORT.format(name="GNU General Public License[[,]] [[GPL]] version 2[[.0]] [[or [[any]] later [[version]]]]")),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
        file, You can obtain one at [[http]] [[https]] [[www]] mozilla.org/MPL/2.0"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", _SHORT.format(name="CC BY [[4.0]] [[3.0]] [[2.0]] [[International]]")),
    ("cc-by-sa", _SHORT.format(name="CC BY SA [[4.0]] [[3.0]] [[2.0]] [[International]]")),
    ("cc-by-nc", _SHORT.format(name="CC BY NC [[4.0]] [[3.0]] [[2.0]] [[International]]")),
    ("cc-by-nc-sa", _SHORT.format(name="CC BY NC SA [[4.0]] [[3.0]] [[2.0]] [[International]]")),
    ("cc-by-nc-nd", _SHORT.format(name="CC BY NC ND [[4.0]] [[3.0]] [[2.0]] [[International]]")),
    ("cc-by", "[[This {{1..4}} is]] licensed under [[a]] [[the]] Creative Commons Attribution [[4.0]] [[3.0]] [[International]] License"),
    ("cc-by-sa", "[[This {{1..4}} is]] licensed under [[a]] [[the]] Creative Commons Attribution ShareAlike [[4.0]] [[3.0]] [[International]] License"),
    ("cc-by-nc", "[[This {{1..4}} is]] licensed under [[a]] [[the]] Creative Commons Attribution NonCommercial [[4.0]] [[3.0]] [[International]] License"),
    ("cc0", "To the extent possible under law, {{1..20}} has waived all copyright and related or neighboring rights to [[this work]] [[{{1..12}}]]"),
    *((label, f"SPDX License Identifier {name}") for label, name in [
        ("mit", "MIT"), ("apache-2", "Apache-2.0"), ("bsd-2", "BSD-2-Clause"), ("bsd-3", "BSD-3-Clause"), ("isc", "ISC"), ("mpl-2", "MPL-2.0"),
        ("gpl-2", "GPL-2.0 [[only]] [[or later]]"), ("gpl-3", "GPL-3.0 [[only]] [[or later]]"), ("lgpl-2.1", "LGPL-2.1 [[only]] [[or later]]"),
        ("lgpl-3", "LGPL-3.0 [[only]] [[or later]]"), ("agpl-3", "AGPL-3.0 [[only]] [[or later]]"), ("unlicense", "Unlicense"), ("cc0", "CC0-1.0"),
        ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"), ("cc-by-nc", "CC-BY-NC-4.0"),
    ]),
]
