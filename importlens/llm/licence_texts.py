"""Known licence texts and notices, and spellings that count as equal."""

import re
from pathlib import Path

#: Public licence texts (without their copyright lines) and common notices, by SPDX identifier.
TEXTS = {
    "0BSD": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public "
        "License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This work is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ],
}

#: Titles that may stand above a licence's text.
TITLES = {
    "0BSD": "BSD Zero Clause License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "ISC": "ISC License",
    "MIT": "MIT License",
    "Zlib": "zlib License",
}

#: Spellings that count as equal, as a pattern and what replaces it. Words have two spaces between them.
SPELLINGS = [
    (r" (un|sub)?licenc(e|es|ed|ing|or|ors|ee|ees) ", r" \1licens\2 "),
    (r" sub  licen[sc](e|es|ed|ing|or|ors|ee|ees|able) ", r" sublicens\1 "),
    (r" (acknowledg|judg)ement(s?) ", r" \1ment\2 "),
    (r" (analog|catalog)ue(s?) ", r" \1\2 "),
    (r" (author|capital|categor|custom|emphas|initial|maxim|optim|organ|real|recogn|util)is(e|es|ed|ing|ation|ations) ",
     r" \1iz\2 "),
    (r" (fav|lab|neighb)our(s|ed|ing|able|ite)? ", r" \1or\2 "),
    (r" (cancel|label|model|signal)l(ed|ing) ", r" \1\2 "),
    (r" fulfil(s|ment)? ", r" fulfill\1 "),
    (r" (of|de)fence(s?) ", r" \1fense\2 "),
    (r" centre(s?) ", r" center\1 "),
    (r" artefact(s?) ", r" artifact\1 "),
    (r" programme(s?) ", r" program\1 "),
    (r" practis(e|es|ed|ing) ", r" practic\1 "),
    (r" whilst ", r" while "),
    (r" wilful ", r" willful "),
    (r" non  commercial ", r" noncommercial "),
    (r" per  cent ", r" percent "),
    (r" copyright  owner(s?) ", r" copyright  holder\1 "),
    (r" https ", r" http "),
]


def _whole(name: str) -> list[str]:
    """A licence's whole text (files in ``licences/``), and the same without the instructions at its end."""
    text = (Path(__file__).parent / "licences" / f"{name}.txt").read_text(encoding="utf-8")
    end = re.search(r"^\W*(APPENDIX: )?How to Apply (the|these)\b", text, re.I | re.M)
    return [text, text[:end.start()]] if end else [text]


def _general_bsd(text: str) -> str:
    """The three clauses without the name of the University of California."""
    text = text.replace("the University nor", "the copyright holder nor")
    text = text.replace("REGENTS AND CONTRIBUTORS", "COPYRIGHT HOLDERS AND CONTRIBUTORS")
    return text.replace("REGENTS OR CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS")


for _id, _name in {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1",
                   "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}.items():
    TEXTS[_id] = TEXTS.get(_id, []) + _whole(_name)
TEXTS["BSD-3-Clause"] = [f(x) for x in _whole("BSD") for f in (_general_bsd, str)]
TITLES["BSD-3-Clause"] = "BSD 3-Clause License"
