"""Notices and texts of license families, as their authors publish them.

Long licenses stand here with the notices that they ask to be attached to works; short ones
stand whole.
"""

_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
]


def _gnu(what: str, name: str, version: str) -> list[str]:
    """The notice that asks to be attached to a work under a license of this family."""
    return [
        f"{what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"{what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
        f"{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.",
        f"You should have received a copy of the {name} along with this program. If not, see https://www.gnu.org/licenses/.",
        f"This work is licensed under the {name}, version {version}.",
        f"Licensed under the {name} version {version}.",
        f"Released under the {name} v{version}.",
    ]


def _commons(code: str, name: str) -> list[str]:
    return [
        f"Licensed under CC {code} 4.0.",
        f"CC {code} 4.0",
        f"SPDX-License-Identifier: CC-{code}-4.0",
        f"This work is licensed under a Creative Commons {name} 4.0 International License.",
        f"This work is licensed under the Creative Commons {name} 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/{code.lower()}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
    ]


def _tags(*names: str) -> list[str]:
    return [f"SPDX-License-Identifier: {n}" for n in names]


TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to you under the Apache License, Version 2.0",
        *_tags("Apache-2.0"),
    ],
    "gpl-2.0": [*_gnu("This program", "GNU General Public License", "2"), "GPLv2", *_tags("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later")],
    "gpl-3.0": [*_gnu("This program", "GNU General Public License", "3"), "GPLv3", *_tags("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later")],
    "lgpl": [
        *_gnu("This library", "GNU Lesser General Public License", "2.1"), *_gnu("This library", "GNU Lesser General Public License", "3"), "LGPLv2.1", "LGPLv3",
        *_tags("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    ],
    "agpl-3.0": [*_gnu("This program", "GNU Affero General Public License", "3"), "AGPLv3", *_tags("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later")],
    "mit": [
        "Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)", *_tags("MIT"),
        _GRANT, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", _AS_IS,
        f"MIT License {_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}",
    ],
    "isc": [
        "ISC License", "Licensed under the ISC License.", *_tags("ISC"),
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "bsd-2-clause": ["Licensed under the BSD 2-Clause License.", "Simplified BSD License", *_tags("BSD-2-Clause"), *_BSD],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License.", "New BSD License", *_tags("BSD-3-Clause"), *_BSD,
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        " ".join([*_BSD[:3], "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", *_BSD[3:]]),
    ],
    "cc-by-nc-4.0": _commons("BY-NC", "Attribution-NonCommercial"),
    "cc-by-sa-4.0": _commons("BY-SA", "Attribution-ShareAlike"),
    "cc-by-4.0": _commons("BY", "Attribution"),
    "cc0-1.0": [
        "Licensed under CC0 1.0.", *_tags("CC0-1.0"),
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is marked with CC0 1.0 Universal. To view a copy of this license, visit http://creativecommons.org/publicdomain/zero/1.0/",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, v. 2.0.", *_tags("MPL-2.0"),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "proprietary": [
        "All rights reserved.", "Copyright. All rights reserved.", "Proprietary and confidential.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}

#: Words too common in any English text to point to a license by themselves.
STOP = (
    "a about above after all also an and any are as at be been but by can could do for from had has have he her his how i if in into is it its may more most no nor not "
    "of on one only or other our out over part she should so some such than that the their them then there these they this to under up use was we were what when which "
    "who will with without would you your"
).split()
