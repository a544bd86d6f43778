import re

from gridloom.llm import licenses
from gridloom.llm.queries import op3_licenses

from ..conftest import agrees
from .helpers import CLASHES, documents, empty

MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def test_rules(spark):
    texts = [
        f"intro. {MIT}", "Released under the MIT License.\nThis work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
        "a license to nothing", "", None, "word. " * 50_000 + "Licensed under CC BY-NC 4.0.", "All rights reserved", "Released under the MIT License. Released under the MIT License.",
    ]
    rows = licenses.scan(documents(spark, texts, CLASHES)).orderBy("doc_id").collect()
    assert [r.licenses for r in rows] == [["MIT"], ["GPL-3.0-only", "MIT"], ["Apache-2.0"], [], [], [], ["CC-BY-NC-4.0"], ["LicenseRef-Proprietary"], ["MIT"]]
    assert rows[0].sentence_ids == ["mit-grant", "mit-notice-kept", "mit-as-is"] and rows[0].score == "x"
    assert licenses.scan(empty(spark)).count() == 0


def test_every_sentence_has_an_anchor_and_every_rule_known_names():
    anchor = re.compile(licenses.HAS_ANCHOR)
    assert all(anchor.search(s) for s in licenses.SENTENCES)
    assert all(re.sub("[^a-z0-9]+", " ", s) == s for s in [*licenses.SENTENCES, *licenses.NAMES])
    known = {*licenses.SENTENCES.values(), *licenses._notices().values(), *licenses._tags().values()}
    assert {n for name, ids in licenses.RULES for n in ids if not n.endswith(("-notice", "-tag"))} <= known
    assert known - {"gnu-warranty", "gnu-merchantability", "gnu-details", "gnu-free"} <= {n for _, ids in licenses.RULES for n in ids}
    assert len({name for name, _ in licenses.RULES}) >= 60


def test_no_python_in_the_plan(spark):
    text = licenses.scan(documents(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text) and "Exchange" not in text


def test_query(spark, duck):
    agrees(spark, duck, op3_licenses, licenses.oracle())


MIT_WRAPPED = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_WRAPPED = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL_WRAPPED = """# This program is free software{0} you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation{1} either version {2} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details."""


def test_official_texts_wrapped_at_a_line_width(spark):
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."
    apache = '   Licensed under the Apache License, Version 2.0 (the "License");\n   you may not use this file except in compliance with the License.\n   You may obtain a copy of the License at\n\n       http://www.apache.org/licenses/LICENSE-2.0\n\n   Unless required by applicable law or agreed to in writing, software\n   distributed under the License is distributed on an "AS IS" BASIS,\n   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n   See the License for the specific language governing permissions and\n   limitations under the License.\n'
    texts = [MIT_WRAPPED, BSD_WRAPPED, BSD_WRAPPED[: BSD_WRAPPED.index("3.")], isc, GPL_WRAPPED.format(":", ",", 3), GPL_WRAPPED.format(";", ";", 2), mpl, apache, "some words\nAll rights\nreserved", "we said all rights reserved to nobody"]
    rows = licenses.scan(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r.licenses for r in rows] == [["MIT"], ["BSD-3-Clause"], ["BSD-2-Clause"], ["ISC"], ["GPL-3.0-or-later"], ["GPL-2.0-or-later"], ["MPL-2.0"], ["Apache-2.0"], ["LicenseRef-Proprietary"], []]
    assert rows[0].sentence_ids == ["mit-grant", "mit-notice-kept", "mit-as-is", "mit-liability"] and len(rows[4].sentence_ids) == 5 == len(rows[5].sentence_ids)
    assert rows[7].sentence_ids == ["apache-2.0-notice", "apache-2-compliance", "apache-2-copy", "apache-2-as-is", "apache-2-limits"]


GNU_HEADER = """/* This {0} is free software; you can redistribute it and/or
 * modify it under the terms of the GNU {1}General Public
 * License as published by the Free Software Foundation; {2}
 *
 * This {0} is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * {1}General Public License for more details.
 */"""


def test_more_licences(spark):
    later = "either\n * version {} of the License, or (at your option) any later version."
    bsd = "Copyright (c) 1998, The Regents. All rights reserved.\n\n" + BSD_WRAPPED.replace("copyright holder nor", "University nor")
    cases = [
        (GNU_HEADER.format("library", "Lesser ", later.format("2.1")), ["LGPL-2.1-or-later"]), (GNU_HEADER.format("program", "Affero ", later.format("3")), ["AGPL-3.0-or-later"]), (GNU_HEADER.format("program", "", "version 2 of the License."), ["GPL-2.0-only"]),
        (bsd, ["BSD-3-Clause"]), (bsd.replace("3. Neither", "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n   This product includes software developed by the University.\n\n4. Neither"), ["BSD-4-Clause"]),
        ("x = 1\n# SPDX-License-Identifier: (MIT OR Apache-2.0)\ny = 2", ["Apache-2.0", "MIT"]), ("// SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]), ("/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */", ["GPL-2.0-only"]), ("SPDX-License-Identifier: nothing-known", []),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", ["0BSD"]), ("This project is licensed under the terms of the MIT license.", ["MIT"]), ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:", ["Zlib"]),
        ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.", ["Unlicense"]),
        ("This program and the accompanying materials are made\n available under the terms of the Eclipse Public License 2.0\n which is available at https://www.eclipse.org/legal/epl-2.0/", ["EPL-2.0"]), ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", ["CC-BY-SA-3.0"]), ("(c) 2020 A. All rights reserved. Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
        ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", []), ("he was released under the bridge license", []), ("Released under the GNU AGPL v3.", ["AGPL-3.0-only"]),
    ]
    rows = licenses.scan(documents(spark, [t for t, _ in cases])).orderBy("doc_id").collect()
    assert [r.licenses for r in rows] == [x for _, x in cases]
    assert rows[17].sentence_ids == ["apache-2-copy"]
