"""License templates: the public wording of notices and headers, by SPDX identifier.

The strings are fixed values: they must be the published wording to match. Short notices that differ only in a name or a
version are made by rule.
"""

from __future__ import annotations

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""

BSD_3 = (
    BSD_2
    + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
)

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

CC0 = """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this
work."""

GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name}
as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""

GNU = (
    ("GPL", "General Public License", ("2", "3")),
    ("LGPL", "Lesser General Public License", ("2.1", "3")),
    ("AGPL", "Affero General Public License", ("3",)),
)
COMMONS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND", "0")
COMMONS_VERSIONS = ("3.0", "4.0")
NAMED = (
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("Unlicense", "Unlicense license"),
)


def templates() -> list[tuple[str, str]]:
    """``(SPDX id, wording)``."""
    out = [
        ("MIT", MIT), ("Apache-2.0", APACHE_HEADER), ("BSD-2-Clause", BSD_2), ("BSD-3-Clause", BSD_3), ("ISC", ISC),
        ("MPL-2.0", MPL), ("Unlicense", UNLICENSE), ("CC0-1.0", CC0),
    ]
    for spdx, name in NAMED:
        out += [(spdx, f"Licensed under the {name}"), (spdx, f"Released under the {name}")]
    for short, name, versions in GNU:
        for version in versions:
            spdx = f"{short}-{version if '.' in version else version + '.0'}"
            out.append((spdx, GNU_HEADER.format(name=name, version=version)))
            out.append((spdx, f"This work is licensed under the GNU {name}, version {version}"))
            out.append((spdx, f"Released under the GNU {name}, version {version}"))
    for kind in COMMONS:
        for version in COMMONS_VERSIONS if kind != "0" else ("1.0",):
            spdx = f"CC0-{version}" if kind == "0" else f"CC-{kind}-{version}"
            name = "CC0" if kind == "0" else f"CC {kind}"
            out += [(spdx, f"Licensed under {name} {version}"), (spdx, f"This work is licensed under {name} {version}")]
    return out
