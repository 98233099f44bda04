"""Wording by which licenses are known: notices, and the whole text where it is short."""

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def gnu_notices() -> list[tuple[str, str]]:
    """The notice that the GNU licenses ask for, with and without later versions."""
    names = {
        "GPL": ("General", ("2", "3")),
        "LGPL": ("Lesser General", ("2.1", "3")),
        "AGPL": ("Affero General", ("3",)),
    }
    rows = [("LGPL-2.0-or-later", _gnu("Library General", "either version 2 of the License, or (at your option) any later version."))]
    for short, (name, versions) in names.items():
        for v in versions:
            full = f"{short}-{v if '.' in v else v + '.0'}"
            rows.append((f"{full}-or-later", _gnu(name, f"either version {v} of the License, or (at your option) any later version.")))
            rows.append((f"{full}-only", _gnu(name, f"version {v} of the License.")))
            rows.append((f"{full}-only", _gnu(name, f"version {v} of the License only.")))
            rows.append((full, f"This work is licensed under the GNU {name} Public License, version {v}."))
    return rows


def _gnu(name: str, versions: str) -> str:
    return f"you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published by the Free Software Foundation, {versions}"


def creative_commons() -> list[tuple[str, str]]:
    """The sentences of the Creative Commons licenses, short and long."""
    kinds = {
        "BY": "Attribution",
        "BY-SA": "Attribution-ShareAlike",
        "BY-ND": "Attribution-NoDerivatives",
        "BY-NC": "Attribution-NonCommercial",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
        "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }
    rows = []
    for kind, name in kinds.items():
        for v, scope in (("4.0", "International"), ("3.0", "Unported")):
            rows.append((f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {name} {v} {scope} License."))
            rows.append((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}."))
    return rows


# The wording of the licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT-0", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"""),
    ("BSD-2-Clause", BSD_HEAD + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_HEAD + BSD_THIRD + BSD_DISCLAIMER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("MPL-1.1", """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"""),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    *gnu_notices(),
    *creative_commons(),
    ("all-rights-reserved", "All rights reserved."),
)
