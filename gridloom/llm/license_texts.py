"""License texts and notices that documents are aligned to.

Long texts are the files of ``license_full``, named by their SPDX identifier.  Of AGPL-3.0,
EPL-2.0 and the Creative Commons licenses other than CC0-1.0 there are notices only.
"""

import pkgutil

# Wording of public licenses; names are SPDX identifiers.  Placeholders
# for years, holders and program names are left out, since they differ per use.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        "General Public License for more details. You should have received a copy of the GNU General Public License "
        "along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        'materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS '
        '"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        'this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ],
    "BSL-1.0": [
        "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any "
        "person or organization obtaining a copy of the software and accompanying documentation covered by this license "
        '(the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare '
        "derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
        "subject to the following: The copyright notices in the Software and this entire statement, including the above "
        "license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in "
        "whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in "
        "the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
        "Distributed under the Boost Software License, Version 1.0.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
}


def _between(text: str, start: str, end: str) -> tuple[str, str]:
    """``text`` up to ``start`` and from ``end`` on."""
    return text[: text.index(start)], text[text.index(end) :]


_GRANT, _DISCLAIMER = _between(TEMPLATES["MIT"][-1], ", subject to the following", "THE SOFTWARE IS")
TEMPLATES["MIT-0"] = [f"{_GRANT}. {_DISCLAIMER}"]
_GRANT, _DISCLAIMER = _between(TEMPLATES["ISC"][-1], ", provided that", "THE SOFTWARE IS")
TEMPLATES["0BSD"] = [f"{_GRANT}. {_DISCLAIMER}"]
_GRANT, _DISCLAIMER = _between(TEMPLATES["BSD-2-Clause"][-1], "THIS SOFTWARE IS", "THIS SOFTWARE IS")
TEMPLATES["BSD-3-Clause"] = [
    f"{_GRANT}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    f"products derived from this software without specific prior written permission. {_DISCLAIMER}"
]

# Notices of the GNU licenses, at the web address and at the postal one, and one line.
for _id, _name, _version, _kind in [
    ("GPL-2.0", "General", "2", "program"), ("GPL-3.0", "General", "3", "program"),
    ("LGPL-2.1", "Lesser General", "2.1", "library"), ("LGPL-3.0", "Lesser General", "3", "program"),
    ("LGPL-3.0", "Lesser General", "3", "library"), ("AGPL-3.0", "Affero General", "3", "program"),
]:
    _notice = (
        f"This {_kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {_name} Public "
        f"License as published by the Free Software Foundation, either version {_version} of the License, or (at your option) "
        f"any later version. This {_kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {_name} Public License "
        f"for more details. You should have received a copy of the GNU {_name} Public License along with this {_kind}"
    )
    _ends = [". If not, see https://www.gnu.org/licenses/.", "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"]
    _line = f"This work is licensed under the GNU {_name} Public License, version {_version}."
    for _text in [_line, *[_notice + _end for _end in _ends]]:
        if _text not in TEMPLATES.setdefault(_id, []):
            TEMPLATES[_id].append(_text)

# Creative Commons: the line of the deed and the short names, per variant and version.
_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _variant in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
    _name = "-".join(_PARTS[_part] for _part in _variant.split("-"))
    for _version, _scope in (("4.0", "International"), ("3.0", "Unported")):
        if _version == "3.0":
            _name = _name.replace("NoDerivatives", "NoDerivs")
        _forms = TEMPLATES.setdefault(f"CC-{_variant}-{_version}", [])
        for _text in (
            f"Licensed under CC {_variant} {_version}.",
            f"This work is licensed under a Creative Commons {_name} {_version} {_scope} License.",
            f"Licensed under the Creative Commons {_name} {_version} {_scope} License.",
        ):
            if _text not in _forms:
                _forms.append(_text)

# One line of the others; a name that goes on, as with a further word before License, is another one.
for _id, _name in [
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("EPL-2.0", "Eclipse Public License 2.0"), ("Zlib", "zlib License"),
    ("CC0-1.0", "CC0 1.0 Universal License"), ("Unlicense", "Unlicense"), ("Apache-2.0", "Apache License 2.0"),
]:
    TEMPLATES.setdefault(_id, []).extend(f"{_verb} under the {_name}." for _verb in ("Released", "Licensed"))
TEMPLATES["Apache-2.0"].append("Released under the Apache License, Version 2.0.")

for _id in "Apache-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MPL-1.1 MPL-2.0 CC0-1.0 Artistic-1.0-Perl GFDL-1.3".split():
    TEMPLATES.setdefault(_id, []).append((pkgutil.get_data(__package__, f"license_full/{_id}.txt") or b"").decode("utf-8"))

# What tells a license from its relatives: a phrase of its texts, the words of it that have
# to be there, and words that do not stand in it but in that place of a relative.  At least
# half of a phrase has to be matched, at one of its places.
TELLING: dict[str, list[tuple[str, str, str]]] = {
    "MIT": [
        ("The above copyright notice and this permission notice shall be included in all copies", "", ""),
        ("portions of the Software. THE SOFTWARE IS PROVIDED", "", "good evil"),
    ],
    "Apache-2.0": [("Apache License, Version 2.0", "2 0", "1")],
    "GPL-2.0": [
        ("GNU General Public License", "", "lesser affero"),
        ("either version 2 of the License", "2", "1 3"),
        ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "2", "lesser library affero"),
    ],
    "GPL-3.0": [
        ("GNU General Public License", "", "lesser library affero"),
        ("version 3 of the License", "3", "1 2"),
        ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "3", "lesser affero november"),
    ],
    "LGPL-2.1": [
        ("GNU Lesser General Public License", "lesser", "affero"),
        ("either version 2.1 of the License", "2 1", "3"),
    ],
    "LGPL-3.0": [
        ("GNU Lesser General Public License", "lesser", "affero"),
        ("either version 3 of the License", "3", "1 2"),
    ],
    "AGPL-3.0": [
        ("GNU Affero General Public License", "affero", "lesser"),
        ("either version 3 of the License", "3", "1 2"),
    ],
    "ISC": [("provided that the above copyright notice and this permission notice appear in all copies", "", "")],
    "BSD-2-Clause": [("with the distribution. THIS SOFTWARE IS PROVIDED", "", "neither endorse advertising")],
    "0BSD": [("is hereby granted. THE SOFTWARE IS PROVIDED", "", "that notice copies")],
    "MIT-0": [("furnished to do so. THE SOFTWARE IS PROVIDED", "", "conditions notice copies")],
    "BSD-3-Clause": [("with the distribution. 3. Neither the name of", "neither", "advertising")],
    "MPL-2.0": [("Mozilla Public License, v. 2.0", "2 0", "1")],
    "EPL-2.0": [("Eclipse Public License 2.0", "2 0", "1")],
}
