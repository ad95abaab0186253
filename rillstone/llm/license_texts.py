"""Known licence texts and the rule for notices. Fixed values; they are normalized before use.

Long texts stand in the folder ``licenses``, by identifier; only the driver reads them. No whole text is known of
AGPL-3.0-only, CC-BY-4.0, CC-BY-NC-4.0, CC-BY-ND-4.0, CC-BY-NC-SA-4.0 and CC-BY-NC-ND-4.0: these are found by notices alone.
"""

from importlib.resources import files

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
ISC_TERM = """, provided that the above copyright notice and this permission notice appear in all copies."""
ISC_WARRANTY = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: (identifier, whole text). Titles may or may not stand above a text.
TEXTS: list[tuple[str, str]] = [
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("ISC", ISC_GRANT + ISC_TERM + ISC_WARRANTY),
    ("ISC", "ISC License\n\n" + ISC_GRANT + ISC_TERM + ISC_WARRANTY),
    ("0BSD", ISC_GRANT + "." + ISC_WARRANTY),
    ("0BSD", "BSD Zero Clause License\n\n" + ISC_GRANT + "." + ISC_WARRANTY),
    ("BSD-2-Clause", BSD_GRANT + BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_GRANT + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_GRANT + BSD_THIRD + BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_GRANT + BSD_THIRD + BSD_WARRANTY),
    ("Zlib", ZLIB),
    ("Zlib", "zlib License\n\n" + ZLIB),
    ("Apache-2.0", APACHE_NOTICE),
]
_END = "END OF TERMS AND CONDITIONS"
for _file in sorted(files("rillstone.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
    _text = _file.read_text(encoding="utf-8")
    TEXTS.append((_file.name.removesuffix(".txt"), _text))
    if _END in _text:  # without the advice on how to apply the licence
        TEXTS.append((_file.name.removesuffix(".txt"), _text[: _text.index(_END) + len(_END)]))

#: Identifier -> names in notices.
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT", "MIT License"],
    "ISC": ["ISC", "ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause", "BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause", "BSD 3-Clause License"],
    "Apache-2.0": ["Apache 2.0", "Apache License 2.0", "Apache License, Version 2.0"],
    "MPL-2.0": ["MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"],
    "GPL-2.0-only": ["GPL 2.0", "GPLv2", "GNU General Public License, version 2", "GNU GPL, version 2"],
    "GPL-3.0-only": ["GPL 3.0", "GPLv3", "GNU General Public License, version 3", "GNU GPL, version 3"],
    "LGPL-2.1-only": ["LGPL 2.1", "GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0-only": ["LGPL 3.0", "GNU Lesser General Public License, version 3"],
    "AGPL-3.0-only": ["AGPL 3.0", "GNU Affero General Public License, version 3"],
    "CC0-1.0": ["CC0", "CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
SUBJECTS = ["", "This work is ", "This file is ", "This software is ", "This document is "]
VERBS = ["licensed under ", "released under ", "distributed under ", "available under "]


def notices() -> list[tuple[str, str]]:
    """(identifier, notice) for every subject, verb, article and name, and the identifier lines."""
    made = [(i, f"{s}{v}{a}{n}") for i, names in NAMES.items() for n in names for s in SUBJECTS for v in VERBS for a in ("", "the ")]
    return made + [(i, f"SPDX-License-Identifier: {i}") for i in NAMES]
