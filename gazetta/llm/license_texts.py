"""Public license texts and notices that the scan looks for; longer texts can be read from a folder."""

from __future__ import annotations

import re
from pathlib import Path

# Public license texts, without title and copyright line.

_BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

TEXTS = (
    (
        "MIT",
        """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    ),
    (
        "ISC",
        """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
""",
    ),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
    (
        "Zlib",
        """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    ),
    (
        "Unlicense",
        """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    ),
    (
        "BSL-1.0",
        """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
""",
    ),
)

# Versions and short names of well-known licenses, from which notices are made.
GNU = {"GPL": ("General", ("1", "2", "3")), "LGPL": ("Lesser General", ("2.1", "3")), "AGPL": ("Affero General", ("3",))}
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMED = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "Apache-1.1": "Apache License, Version 1.1", "Apache-2.0": "Apache License, Version 2.0", "MPL-1.1": "Mozilla Public License, Version 1.1", "MPL-2.0": "Mozilla Public License, Version 2.0", "EPL-1.0": "Eclipse Public License, Version 1.0", "EPL-2.0": "Eclipse Public License, Version 2.0", "BSL-1.0": "Boost Software License, Version 1.0", "Zlib": "zlib License"}
OTHER = (
    ("GPL-2.0-or-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0-or-later", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1-or-later", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("AGPL-3.0-or-later", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide"),
)
#: Words that tell one notice from another; numbers do too.
TELLING = frozenset(
    "by sa nc nd attribution sharealike noncommercial noderivatives general lesser library affero mit isc bsd apache mozilla eclipse boost clause later gpl lgpl agpl cc cc0 mpl epl bsl zlib unlicense".split()
)
#: Numbers, with the marks of versions that notices write to them ("v2", "gplv3").
NUMBER = re.compile(r"(?:[al]?gpl)?v?\d+")

#: Names of the folder's files as license names; files that are links to others are left out.
FILES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


def gnu_notices(name: str, kind: str, v: str) -> list[tuple[str, str]]:
    """Notices of one version of a GNU license: spelled out, by initials, with "version 2", "v2", "v2.0" or "GPLv2", and with later versions allowed."""
    spdx = f"{name}-{v if '.' in v else v + '.0'}"
    long = (f"GNU {kind} Public License", f"GNU {kind} Public License ({name})", f"GNU {name}", name)
    out = [f"{start} under the {long[0]}, version {v}." for start in ("This work is licensed", "Released")]
    for x in dict.fromkeys((v, spdx.rpartition("-")[2])):
        out += [f"{who} {how}{x}" for who in long for how in ("version ", "v")] + [f"{long[0]} {x}"]
        out += [f"{start} {name} v{x}" for start in ("under", "under the", "Licensed under", "Released under", "Distributed under")]
        out += [f"{start} {name}v{x}" for start in ("under the", "Licensed under", "Released under", "Distributed under", "terms of the")] + [f"the {name}v{x} license"]
    later = [f"{who} {how}{v} {end}" for who in long for how in ("version ", "v") for end in ("or later", "or any later version", "or (at your option) any later version")]
    return [(spdx, t) for t in out] + [(f"{spdx}-or-later", t) for t in later]


def spdx_notices(ids: list[str]) -> list[tuple[str, str]]:
    """The tag that source files carry, and an identifier after "under"."""
    return [(x, f"{start} {x}") for x in ids for start in ("SPDX-License-Identifier:", "under", "under the", "Licensed under", "Released under")]


def notices() -> list[tuple[str, str]]:
    """Short notices by license, in the usual wordings; those of fewer than three words, which no fingerprint has, are left out."""
    out = []
    for name, x in NAMED.items():
        for said in dict.fromkeys((x, x.replace(", Version", ""))):
            out += [(name, f"{start} {said}") for start in ("Released under the", "Licensed under the", "under the", "under", "the", "under the terms of the", "")]
    ids = [*NAMED, "Unlicense", "CC0-1.0"]
    for name, (kind, versions) in GNU.items():
        for v in versions:
            out += gnu_notices(name, kind, v)
            plain = f"{name}-{v if '.' in v else v + '.0'}"
            ids += [plain, f"{plain}-only", f"{plain}-or-later"]
    for kind, long in CREATIVE.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            spdx = f"CC-{kind}-{v}"
            ids.append(spdx)
            out += [(spdx, f"Licensed under CC {kind} {v}."), (spdx, f"This work is licensed under a Creative Commons {long} {v} {'International' if v == '4.0' else 'Unported'} License.")]
    return [n for n in (*out, *spdx_notices(ids), *OTHER) if len(re.findall(r"\w+", n[1])) >= 3]


def templates(folder: str | None = None) -> tuple[tuple[str, str], ...]:
    """(license, text) of all notices and of the texts above; with a folder of public license texts on the driver, of its files too."""
    files = [(name, Path(folder, f)) for f, name in FILES.items()] if folder else []
    return (*notices(), *TEXTS, *((name, p.read_text(errors="replace")) for name, p in files if p.is_file()))
